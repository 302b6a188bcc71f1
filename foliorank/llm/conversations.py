"""Structure repair of conversations: faults, cheapest edits and the repaired rows.

``damage`` is the seeded fault injector of the check; ``repair`` takes any table of
conversation rows. Identical rows are collapsed first and duplicates found by a
pre-aggregated join, then rows are dealt by ranges of (conversation, turn, role, text),
so a conversation of any length is spread over tasks. Each task cuts its range into
segments of at most ``SEGMENT`` rows. A conversation inside one segment is aligned
at once (``turn_edits``). One that spans more is aligned segment by segment from every
state in which it may be entered: a scan over 4 x 4 costs a segment gives each segment
the cost of what follows it, and with that its edits are exactly those of the whole.

Rows of one conversation stand by turn, nulls first, then by role and text. A null role,
text or turn counts as one space in texts and keys; a null ``conv_id`` is a conversation
of its own. Rows that repeat are duplicates, an empty table gives no rows, and extra
columns are ignored. Texts of any length are carried whole, one segment (or one longer
row) at a time. The SHA-256 of a conversation's text is a chain by definition: its
segments pass through one task as a stream, of which one is held.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from . import turn_edits
from .common import Scratch

SEGMENT = 512
SEGMENT_BYTES = 4 << 20
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
_LEGAL = {"su", "ua", "au"}
_STATS = (
    "turns bigint, low bigint, high bigint, first_turn bigint, last_turn bigint, "
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint"
)


def _spaced(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(turns: DataFrame) -> DataFrame:
    """Rows with seeded faults and ``copies``: how often each stands (0: dropped).

    The fault is crc32("conv_id:turn") mod 20: 0 drops the row, 1 empties its text,
    2 removes ``.!?`` from it, 3 repeats it, 4 makes it the user's.
    """
    code = F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", _spaced("role").alias("role"), _spaced("text").alias("text"), code.alias("code"))
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(F.col("code") == 0, 0).when(F.col("code") == 3, 2).otherwise(1).cast("bigint").alias("copies"),
    )


def _symbols(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per standing row, with its symbol and its fault."""
    rows = scratch.write(
        turns.groupBy("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")
        .agg(F.sum("copies").alias("copies"))
        .where("copies > 0")
        .withColumn("same", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))),
        "rows",
    )
    first = (
        rows.groupBy("conv_id", "same")
        .agg(F.count("*").alias("places"), F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("unknown"))
        .where("places > 1")
        .select(F.col("conv_id").alias("of"), F.col("same").alias("as"), "first", "unknown")
    )
    marked = rows.join(first, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("same") == F.col("as")), "left")
    seen = F.when(F.col("unknown"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("first"))
    last = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    initial = F.substring("role", 1, 1)
    symbol = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    return (
        marked.withColumn("seen", F.coalesce(seen, F.lit(False)))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
        .withColumn(
            "fault",
            F.when(last == "", 1)
            .when(F.col("seen") | (F.col("copy") > 1), 2)
            .when(~last.isin(".", "!", "?"), 3)
            .otherwise(0),
        )
        .withColumn(
            "symbol",
            F.when(F.col("fault").isin(1, 2), "-").when(F.col("fault") == 3, F.upper(symbol)).otherwise(symbol),
        )
        .select("conv_id", "turn", "role", "text", "copy", "fault", "symbol")
    )


class _Segment:
    def __init__(self, conversation, part: int, number: int):
        self.conversation, self.part, self.number = conversation, part, number
        self.symbols, self.roles, self.texts, self.bytes = [], [], [], 0
        self.turns, self.low, self.high, self.last, self.begun = 0, None, None, None, False
        self.first_turn = None
        self.faults, self.illegal, self.initial = [0, 0, 0, 0], 0, None
        self.first_initial = None

    def add(self, turn, role, text, fault, symbol) -> None:
        if not self.begun:
            self.first_turn, self.first_initial = turn, role[:1]
        elif self.initial + role[:1] not in _LEGAL:
            self.illegal += 1
        if turn is not None:
            self.turns += not self.begun or turn != self.last
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.begun, self.last, self.initial = True, turn, role[:1]
        self.faults[fault] += 1
        self.symbols.append(symbol)
        self.roles.append(role)
        self.texts.append("" if symbol == "-" else text)
        self.bytes += len(self.texts[-1])

    def row(self, whole: bool) -> dict:
        return {
            "conv_id": self.conversation, "part": self.part, "number": self.number, "whole": whole,
            "symbols": "".join(self.symbols), "roles": self.roles, "texts": self.texts,
            "turns": self.turns, "low": self.low, "high": self.high,
            "first_turn": self.first_turn, "last_turn": self.last,
            "blank": self.faults[1], "duplicate": self.faults[2], "truncated": self.faults[3],
            "illegal": self.illegal, "first_initial": self.first_initial, "last_initial": self.initial,
        }


def _cut(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        done, held, segment, single, number = [], 0, None, False, 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault", "symbol")]
            for conversation, turn, role, text, fault, symbol in zip(*columns):
                if segment is None or segment.conversation != conversation:
                    if segment is not None:
                        done.append(segment.row(whole=single))
                    # The first and the last conversation of a range may go on in another one.
                    single, number = segment is not None, number + 1
                    segment = _Segment(conversation, part, number)
                elif len(segment.symbols) >= SEGMENT or segment.bytes + len(text) > SEGMENT_BYTES:
                    done.append(segment.row(whole=False))
                    single, number = False, number + 1
                    segment = _Segment(conversation, part, number)
                segment.add(turn, role, text, fault, symbol)
                held += len(text)
                if held > SEGMENT_BYTES:
                    yield pa.RecordBatch.from_pylist(done, schema)
                    done, held = [], 0
        if segment is not None:
            done.append(segment.row(whole=False))
        yield pa.RecordBatch.from_pylist(done, schema)

    return run


def _costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        symbols = batch.column("symbols").to_pylist()
        inner = [turn_edits.Alignments(s, False, turn_edits.OPEN_SLACK).costs() for s in symbols]
        last = [turn_edits.closing_costs(s) for s in symbols]
        names = [n for n in batch.schema.names if n != "symbols"]
        arrays = [batch.column(n) for n in names] + [pa.array(x, pa.list_(pa.int64())) for x in (inner, last)]
        yield pa.RecordBatch.from_arrays(arrays, names=[*names, "inner", "last"])


def _onward(frame):
    """Of one conversation's segments: the cost of what follows each, by state."""
    import pandas as pd

    frame = frame.sort_values(["part", "number"]).reset_index(drop=True)
    follows, rows = list(turn_edits.ACCEPT), []
    for k in range(len(frame) - 1, -1, -1):
        closing = k == len(frame) - 1
        rows.append((frame["part"][k], frame["number"][k], closing, follows))
        inner = frame["inner"][k]
        follows = (
            [int(x) for x in frame["last"][k]]
            if closing
            else [min(min(int(inner[4 * p + q]) + follows[q] for q in range(4)), turn_edits.INFINITE) for p in range(4)]
        )
    return pd.DataFrame(rows, columns=["in_part", "in_number", "closing", "onward"])


def _finish(schema: pa.Schema):
    """Results from segments in order: one conversation is a stream of segments."""

    def begin(conversation):
        return {
            "conv_id": conversation, "turns": 0, "low": None, "high": None, "blank": 0, "duplicate": 0, "truncated": 0,
            "illegal": 0, "audit": [], "state": turn_edits.START, "sha": hashlib.sha256(), "lines": 0, "last": None,
        }

    def add(found, row) -> None:
        if row["whole"]:
            audit = turn_edits.whole_audit(row["symbols"])[1]
        else:
            state, closing = found["state"], row["closing"]
            audit = turn_edits.segment_audits(row["symbols"], list(row["onward"]), closing)[0][state]
        repaired, found["state"] = turn_edits.apply_audit(audit, list(zip(row["roles"], row["texts"])), found["state"])
        for role, text in repaired:
            found["sha"].update((("\n" if found["lines"] else "") + f"{role}:{text}").encode())
            found["lines"] += 1
        found["audit"].append(audit)
        found["cost"] = found.get("cost", 0) + _price(audit, row["symbols"])
        last = found["last"]
        if last is not None:
            found["illegal"] += last[1] + row["first_initial"] not in _LEGAL
            if row["first_turn"] is not None and last[0] == row["first_turn"]:
                found["turns"] -= 1
        for name in ("turns", "blank", "duplicate", "truncated", "illegal"):
            found[name] += row[name]
        found["low"] = row["low"] if found["low"] is None else found["low"]
        found["high"] = found["high"] if row["high"] is None else row["high"]
        found["last"] = (row["last_turn"], row["last_initial"])

    def end(found) -> dict:
        gaps = 0 if found["low"] is None else found["high"] - found["low"] + 1 - found["turns"]
        counts = {n: found[n] for n in ("conv_id", "blank", "duplicate", "truncated", "illegal", "cost")}
        return counts | {"gaps": gaps, "audit": "".join(found["audit"]), "repaired_sha256": found["sha"].hexdigest()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if found is None or row["whole"] or found["conv_id"] != row["conv_id"]:
                    if found is not None:
                        done.append(end(found))
                    found = begin(row["conv_id"])
                add(found, row)
            yield pa.RecordBatch.from_pylist(done, schema)
        if found is not None:
            yield pa.RecordBatch.from_pylist([end(found)], schema)

    return run


def _price(audit: str, symbols: str) -> int:
    cost, i = 0, 0
    for edit in audit:
        cost += {"D": turn_edits.DELETE, "I": turn_edits.INSERT, "K": 0, "R": turn_edits.REROLE}[edit]
        if edit in "KR" and symbols[i].isupper():
            cost += turn_edits.CUT
        i += edit != "I"
    return cost


def repair(turns: DataFrame, copies: str | None = None) -> DataFrame:
    """Per conversation: its faults, the cheapest repair and the SHA-256 of the repaired rows.

    ``turns`` has conv_id, turn, role, text; ``copies`` names a column saying how often
    a row stands. Conversations whose rows all stand 0 times are reported with zeros, an
    empty audit and the hash of the empty string.
    """
    scratch = Scratch(turns.sparkSession, "conversations")
    base = turns.select(
        "conv_id", "turn", _spaced("role").alias("role"), _spaced("text").alias("text"),
        (F.lit(1) if copies is None else F.col(copies)).cast("bigint").alias("copies"),
    )
    kind = base.schema["conv_id"].dataType.simpleString()
    wide = (
        f"conv_id {kind}, part int, number bigint, whole boolean, symbols string, roles array<string>, texts array<string>, "
        f"{_STATS}, first_initial string, last_initial string"
    )
    order = ["conv_id", "turn", "role"]
    dealt = (
        _symbols(base, scratch)
        .repartitionByRange(*order, F.substring("text", 1, 64))
        .sortWithinPartitions(*order, "text", "copy")
    )
    segments = scratch.write(dealt.mapInArrow(_cut(_arrow(wide)), wide), "segments")
    opened = segments.where("NOT whole")
    costs = opened.select("conv_id", "part", "number", "symbols").mapInArrow(
        _costs, f"conv_id {kind}, part int, number bigint, inner array<bigint>, last array<bigint>"
    )
    # One narrow row per segment meets the others of its conversation.
    onward = costs.groupBy("conv_id").applyInPandas(
        _onward, "in_part int, in_number bigint, closing boolean, onward array<bigint>"
    )
    chained = (
        opened.join(onward, (F.col("part") == F.col("in_part")) & (F.col("number") == F.col("in_number")))
        .drop("in_part", "in_number")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "number")
    )
    narrow = (
        f"conv_id {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
        "audit string, repaired_sha256 string"
    )
    finish = _finish(_arrow(narrow))
    found = segments.where("whole").mapInArrow(finish, narrow).unionByName(chained.mapInArrow(finish, narrow))
    every = base.groupBy(F.col("conv_id").alias("of")).agg(F.sum("copies").alias("standing")).where("standing = 0")
    empty = every.select(
        F.col("of").alias("conv_id"),
        *[F.lit(0).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.lit("").alias("audit"),
        F.sha2(F.lit(""), 256).alias("repaired_sha256"),
    )
    return found.unionByName(empty)


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


# The same contract row by row: costs and audits of the rest of a conversation, from its last row back,
# for the four states in which it may be entered.
REPAIR_SQL = r"""
WITH RECURSIVE
codes AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step),
coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(
               coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT))),
             lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS code
  FROM conversations, codes),
damaged AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN code = 1 THEN '' WHEN code = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy
  FROM coded WHERE code <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM damaged),
marked AS (
  SELECT *, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS final,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY n) AS before
  FROM placed),
faults AS (
  SELECT *, final = '' AS blank, final <> '' AND again AS duplicate,
         final <> '' AND NOT again AND final NOT IN ('.', '!', '?') AS truncated
  FROM marked),
counts AS (
  SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (before || role[1] NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS rows
  FROM faults GROUP BY conv_id),
walk AS (
  SELECT conv_id, rows + 1 AS n, {'c': 0, 'a': ''} AS b, {'c': 10, 'a': 'II'} AS s, {'c': 5, 'a': 'I'} AS u, {'c': 0, 'a': ''} AS a
  FROM counts
  UNION ALL
  SELECT conv_id, n,
         list_min([gb, {'c': gu.c + 5, 'a': 'I' || gu.a}, {'c': ga.c + 10, 'a': 'II' || ga.a}]) AS b,
         list_min([gs, {'c': gu.c + 5, 'a': 'I' || gu.a}, {'c': ga.c + 10, 'a': 'II' || ga.a}]) AS s,
         list_min([gu, {'c': ga.c + 5, 'a': 'I' || ga.a}, {'c': gu.c + 10, 'a': 'II' || gu.a}]) AS u,
         list_min([ga, {'c': gu.c + 5, 'a': 'I' || gu.a}, {'c': ga.c + 10, 'a': 'II' || ga.a}]) AS a
  FROM (
    SELECT w.conv_id, r.n,
           list_min([{'c': b.c + 2, 'a': 'D' || b.a}, CASE WHEN stays THEN {'c': u.c + more + off_u, 'a': kr_u || u.a} ELSE {'c': 1000000, 'a': ''} END,
                     CASE WHEN stays AND initial = 's' THEN {'c': s.c + more, 'a': 'K' || s.a} ELSE {'c': 1000000, 'a': ''} END]) AS gb,
           list_min([{'c': s.c + 2, 'a': 'D' || s.a}, CASE WHEN stays THEN {'c': u.c + more + off_u, 'a': kr_u || u.a} ELSE {'c': 1000000, 'a': ''} END]) AS gs,
           list_min([{'c': u.c + 2, 'a': 'D' || u.a}, CASE WHEN stays THEN {'c': a.c + more + off_a, 'a': kr_a || a.a} ELSE {'c': 1000000, 'a': ''} END]) AS gu,
           list_min([{'c': a.c + 2, 'a': 'D' || a.a}, CASE WHEN stays THEN {'c': u.c + more + off_u, 'a': kr_u || u.a} ELSE {'c': 1000000, 'a': ''} END]) AS ga
    FROM walk w JOIN (
      SELECT conv_id, n, NOT blank AND NOT duplicate AS stays, CASE WHEN truncated THEN 5 ELSE 0 END AS more, role[1] AS initial,
             CASE WHEN role[1] = 'u' THEN 0 ELSE 1 END AS off_u, CASE WHEN role[1] = 'u' THEN 'K' ELSE 'R' END AS kr_u,
             CASE WHEN role[1] = 'a' THEN 0 ELSE 1 END AS off_a, CASE WHEN role[1] = 'a' THEN 'K' ELSE 'R' END AS kr_a
      FROM faults) r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.n = w.n - 1)),
audits AS (SELECT conv_id, b.c AS cost, b.a AS audit FROM walk WHERE n = 1),
edits AS (
  SELECT conv_id, place, audit[place] AS edit, len(regexp_replace(left(audit, place), 'I', '', 'g')) AS n,
         len(regexp_replace(left(audit, place), 'D', '', 'g')) AS kept
  FROM (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS place FROM audits)),
repaired AS (
  SELECT e.conv_id, kept, edit, CASE WHEN edit = 'I' THEN '' ELSE text END AS text, role,
         max(CASE WHEN kept = 1 AND edit = 'K' AND role[1] = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS led
  FROM edits e LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.n = e.n AND edit <> 'I'
  WHERE edit <> 'D'),
texts AS (
  SELECT conv_id, string_agg((CASE WHEN edit = 'K' THEN role WHEN (kept - led) % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || text,
                             chr(10) ORDER BY kept) AS text
  FROM repaired GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(t.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts k ON k.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN audits d ON d.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
"""
