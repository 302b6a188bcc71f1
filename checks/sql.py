"""The SQL that gives the rows of each query in ``queries``.

Steps shared by several statements are named once and put in front of a
statement as common table expressions, in the order they need each other.
"""

import re

from foliorank.functions.stem_rules import stem_sql
from foliorank.functions.stopwords import ENGLISH_STOPWORDS
from foliorank.operators.interactions import STRIDES
from foliorank.schemas import PAPERS_SCHEMA

_STOP = ", ".join(f"'{w}'" for w in ENGLISH_STOPWORDS)
_SPLIT = "regexp_split_to_array(lower({}), '[^A-Za-z_-]')"
_TEXT = "concat_ws(' ', title, abstract)"


def _tokens(text: str) -> str:
    return f"list_filter({_SPLIT.format(text)}, lambda x: length(x) >= 3)"


def _without_stop(words: str) -> str:
    return f"list_filter({words}, lambda x: x NOT IN ({_STOP}))"


def _stripped(words: str) -> str:
    return f"list_transform({words}, lambda x: regexp_replace(x, '[-_]', '', 'g'))"


def _draw(seed: int, *columns: str) -> str:
    keys = ", ".join(f"CAST({c} AS VARCHAR)" for c in columns)
    return f"md5(concat_ws('|', '{seed}', {keys}))"


def _split_of(source: str) -> str:
    return f"""
        SELECT user_id, paper_id,
               row_number() OVER (PARTITION BY user_id ORDER BY {_draw(7, 'user_id', 'paper_id')}, paper_id)
                 <= (count(*) OVER (PARTITION BY user_id) + 4) // 5 AS is_test
        FROM {source}"""


def _sampled(source: str, n: int) -> str:
    return f"""
        SELECT * FROM {source} WHERE user_id IN (
          SELECT user_id FROM (SELECT DISTINCT user_id FROM {source})
          ORDER BY {_draw(7, 'user_id')}, user_id LIMIT {n})"""


_VECTOR_SIZE_SUM = "sqrt(list_sum(list_transform({}, lambda x: x * x)))"

# name: (names it needs, statement)
_STEPS: dict[str, tuple[tuple[str, ...], str]] = {
    "papers": ((), """
        SELECT doc_id AS paper_id,
               split_part(text, chr(10), 1) AS title,
               CASE WHEN contains(text, chr(10)) THEN substr(text, instr(text, chr(10)) + 1) END AS abstract
        FROM documents"""),
    "pairs": ((), """
        SELECT DISTINCT o_custkey AS user_id, l_partkey AS paper_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "metadata": ((), """
        SELECT p_partkey AS paper_id,
               CASE WHEN NOT starts_with(p_name, 'hot ') THEN p_type END AS type,
               CASE WHEN p_brand <> 'Brand#10' THEN CAST(p_size AS DOUBLE) END AS pages,
               CAST(regexp_extract(p_brand, '[0-9]+') AS DOUBLE) + 1980 AS year
        FROM part"""),
    "vectors": ((), """
        SELECT vec_id AS paper_id, label, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings"""),
    "lines": ((), """
        SELECT CAST(o_custkey AS VARCHAR) AS user_id,
               list(CAST(l_partkey AS VARCHAR) ORDER BY l_linenumber, l_partkey) AS paper_ids
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        GROUP BY l_orderkey, o_custkey"""),
    # text
    "tokens": (("papers",), f"SELECT paper_id, {_tokens(_TEXT)} AS words FROM papers"),
    "conservative": (("tokens",), f"SELECT paper_id, {_stripped('words')} AS words FROM tokens"),
    "words": (("tokens",), f"SELECT paper_id, {_stripped(_without_stop('words'))} AS words FROM tokens"),
    "term_rows": (("words",), "SELECT paper_id, unnest(words) AS term FROM words"),
    "term_sets": (("term_rows",), "SELECT DISTINCT paper_id, term FROM term_rows"),
    "frequencies": (("term_sets",), "SELECT term, count(*) AS df FROM term_sets GROUP BY term"),
    "n_papers": (("papers",), """
        SELECT count(*) AS n FROM (SELECT DISTINCT paper_id, title, abstract FROM papers)"""),
    "band": (("frequencies", "n_papers"), """
        SELECT term, df FROM frequencies
        WHERE df >= 20 AND df / (SELECT CAST(n AS DOUBLE) FROM n_papers) <= 0.1"""),
    "vocabulary": (("band",), """
        SELECT term, df, row_number() OVER (ORDER BY df DESC, term) - 1 AS term_id
        FROM band ORDER BY df DESC, term LIMIT 1000"""),
    "tf": (("term_rows", "vocabulary"), """
        SELECT paper_id, term_id, count(*) AS tf
        FROM term_rows JOIN vocabulary USING (term) GROUP BY paper_id, term_id"""),
    "idf": (("tf",), """
        SELECT term_id, count(*) AS df,
               ln(((SELECT count(DISTINCT paper_id) FROM tf) + 1) / CAST(count(*) + 1 AS DOUBLE)) AS idf
        FROM tf GROUP BY term_id"""),
    "weights": (("tf", "idf"), """
        SELECT paper_id, term_id, tf * idf AS weight FROM tf JOIN idf USING (term_id)
        WHERE tf * idf <> 0"""),
    # term recommender
    "split20": (("pairs",), _split_of(f"({_sampled('pairs', 20)})")),
    "train20": (("split20",), "SELECT user_id, paper_id FROM split20 WHERE NOT is_test"),
    "term_profiles": (("train20", "weights"), """
        SELECT user_id, term_id, sum(weight) AS weight
        FROM train20 JOIN weights USING (paper_id) GROUP BY user_id, term_id"""),
    "term_scores": (("term_profiles", "weights", "train20"), """
        SELECT d.user_id, d.paper_id, round(d.dot / (u.norm * p.norm), 6) AS similarity
        FROM (SELECT a.user_id, w.paper_id, sum(a.weight * w.weight) AS dot
              FROM term_profiles a JOIN weights w USING (term_id) GROUP BY a.user_id, w.paper_id) d
        JOIN (SELECT user_id, sqrt(sum(weight * weight)) AS norm FROM term_profiles GROUP BY user_id) u
          ON u.user_id = d.user_id
        JOIN (SELECT paper_id, sqrt(sum(weight * weight)) AS norm FROM weights GROUP BY paper_id) p
          ON p.paper_id = d.paper_id
        WHERE NOT EXISTS (SELECT 1 FROM train20 t WHERE t.user_id = d.user_id AND t.paper_id = d.paper_id)"""),
    "all_term_scores": (("term_profiles", "weights", "train20", "term_scores"), """
        SELECT u.user_id, p.paper_id, coalesce(s.similarity, 0) AS similarity
        FROM (SELECT DISTINCT user_id FROM term_profiles) u
        CROSS JOIN (SELECT DISTINCT paper_id FROM weights) p
        LEFT JOIN term_scores s ON s.user_id = u.user_id AND s.paper_id = p.paper_id
        WHERE NOT EXISTS (SELECT 1 FROM train20 t
                          WHERE t.user_id = u.user_id AND t.paper_id = p.paper_id)"""),
    # metadata features
    "library_pages": (("pairs", "metadata"), """
        SELECT user_id, pages, 1 AS count FROM pairs JOIN metadata USING (paper_id)"""),
    "stats": (("library_pages",), """
        SELECT user_id, avg(pages) AS user_pages, CAST(sum(count) AS BIGINT) AS user_papers
        FROM library_pages GROUP BY user_id"""),
    "catalogue": (("metadata",), """
        SELECT paper_id, row_number() OVER (ORDER BY md5(CAST(paper_id AS VARCHAR)), paper_id) - 1 AS place,
               count(*) OVER () AS n
        FROM metadata"""),
    "walks": (("pairs", "catalogue"), f"""
        SELECT user_id, size, step,
               (start + step * (CAST({list(STRIDES)} AS BIGINT[])[pick] % n)) % n AS place
        FROM (SELECT user_id, size, n, unnest(range(least(2 * size, n))) AS step,
                     CAST('0x' || substr(key, 1, 8) AS BIGINT) % n AS start,
                     CAST('0x' || substr(key, 9, 8) AS BIGINT) % {len(STRIDES)} + 1 AS pick
              FROM (SELECT user_id, count(*) AS size, any_value({_draw(7, 'user_id')}) AS key,
                           (SELECT max(n) FROM catalogue) AS n
                    FROM pairs GROUP BY user_id))"""),
    "negatives": (("walks", "catalogue", "pairs"), """
        SELECT user_id, paper_id, 0 AS label
        FROM (SELECT w.user_id, c.paper_id, w.size,
                     row_number() OVER (PARTITION BY w.user_id ORDER BY w.step) AS position
              FROM walks w JOIN catalogue c ON c.place = w.place
              WHERE NOT EXISTS (SELECT 1 FROM pairs p
                                WHERE p.user_id = w.user_id AND p.paper_id = c.paper_id))
        WHERE position <= size"""),
    "positive_rows": (("pairs", "metadata", "stats"), """
        SELECT user_id, paper_id, 1 AS label, pages, year, type, user_pages, user_papers
        FROM pairs JOIN metadata USING (paper_id) JOIN stats USING (user_id)"""),
    "mixed_rows": (("pairs", "negatives", "metadata", "stats"), """
        SELECT user_id, paper_id, label, pages, year, type, user_pages, user_papers
        FROM (SELECT user_id, paper_id, 1 AS label FROM pairs UNION ALL SELECT * FROM negatives)
        JOIN metadata USING (paper_id) JOIN stats USING (user_id)"""),
    # vectors
    "label_sums": (("vectors",), """
        SELECT label, list(total ORDER BY place) AS total
        FROM (SELECT label, place, sum(vector[place]) AS total
              FROM vectors, unnest(range(1, len(vector) + 1)) AS p(place) GROUP BY label, place)
        GROUP BY label"""),
    "with_sum": (("vectors", "label_sums"), """
        SELECT paper_id AS vec_id, label, vector, total FROM vectors JOIN label_sums USING (label)"""),
    # word vectors numbered like the vocabulary
    "embedded": (("words", "vocabulary", "vectors"), """
        SELECT paper_id, n_tokens,
               list_transform(vector, lambda x: CASE WHEN n_tokens > 0 THEN x / n_tokens ELSE 0 END) AS vector
        FROM (SELECT paper_id, any_value(len(words)) AS n_tokens,
                     list(coalesce(total, 0.0) ORDER BY place) AS vector
              FROM words
              CROSS JOIN (SELECT unnest(range(1, len(vector) + 1)) AS place FROM (SELECT vector FROM vectors LIMIT 1))
              LEFT JOIN (SELECT t.paper_id, place, sum(t.n * v.vector[place]) AS total
                         FROM (SELECT paper_id, term, count(*) AS n FROM term_rows GROUP BY paper_id, term) t
                         JOIN vocabulary USING (term) JOIN vectors v ON v.paper_id = term_id,
                         unnest(range(1, len(v.vector) + 1)) AS p(place)
                         GROUP BY t.paper_id, place) USING (paper_id, place)
              GROUP BY paper_id)"""),
}
# The same steps over stems.
_STEPS["stem_of"] = (("conservative",), stem_sql("(SELECT unnest(words) AS term FROM conservative)", "term"))


def _stem_lists(source: str) -> str:
    """Token lists with every token replaced by its stem, in order."""
    return f"""
        SELECT w.paper_id, coalesce(stems, []) AS words
        FROM {source} w
        LEFT JOIN (SELECT paper_id, list(stem ORDER BY place) AS stems
                   FROM (SELECT paper_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM {source})
                   JOIN stem_of USING (word) GROUP BY paper_id) USING (paper_id)"""


_STEPS["stem_bags"] = (("words", "stem_of"), _stem_lists("words"))
_STEPS["unstopped"] = (("conservative",), f"SELECT paper_id, {_without_stop('words')} AS words FROM conservative")
_STEPS["intensive_stems"] = (("unstopped", "stem_of"), _stem_lists("unstopped"))
_OVER_TERMS = "term_rows term_sets frequencies band vocabulary tf idf weights term_profiles term_scores".split()
for _name in _OVER_TERMS:
    _needs, _statement = _STEPS[_name]
    _named = {n: f"stem_{n}" for n in _OVER_TERMS} | {"words": "stem_bags"}
    _STEPS[f"stem_{_name}"] = (
        tuple(_named.get(n, n) for n in _needs),
        re.sub(rf"\b({'|'.join(_OVER_TERMS)})\b", r"stem_\1", _statement).replace("FROM words", "FROM stem_bags"),
    )
_STEPS["embedded"] = (("words", "term_rows", "vocabulary", "vectors"), _STEPS["embedded"][1])
_STEPS["table_vectors"] = (
    ("vectors",),
    "SELECT paper_id, 1 AS n_tokens, vector FROM vectors",
)


def _vector_recommender(name: str, source: str, needs: tuple[str, ...], vectors: str, n: int) -> None:
    """Steps of a dense recommender: split, train, profiles and scores."""
    _STEPS[f"split_{name}"] = (needs, _split_of(f"({_sampled(source, n)})"))
    _STEPS[f"train_{name}"] = (
        (f"split_{name}",), f"SELECT user_id, paper_id FROM split_{name} WHERE NOT is_test"
    )
    _STEPS[f"profiles_{name}"] = ((f"train_{name}", vectors), f"""
        SELECT user_id, list(mean ORDER BY place) AS vector
        FROM (SELECT user_id, place, sum(n_tokens * vector[place]) / sum(n_tokens) AS mean
              FROM train_{name} JOIN {vectors} USING (paper_id),
                   unnest(range(1, len(vector) + 1)) AS p(place)
              WHERE n_tokens > 0
              GROUP BY user_id, place)
        GROUP BY user_id""")
    _STEPS[f"scores_{name}"] = ((f"profiles_{name}", f"train_{name}", vectors), f"""
        SELECT * FROM (
          SELECT u.user_id, v.paper_id,
                 CASE WHEN {_VECTOR_SIZE_SUM.format('u.vector')} * {_VECTOR_SIZE_SUM.format('v.vector')} > 0
                      THEN round(list_cosine_similarity(u.vector, v.vector), 6) + 0 END AS similarity
          FROM profiles_{name} u CROSS JOIN {vectors} v
          WHERE NOT EXISTS (SELECT 1 FROM train_{name} t
                            WHERE t.user_id = u.user_id AND t.paper_id = v.paper_id))
        WHERE similarity IS NOT NULL""")


_STEPS["active"] = (("pairs",), """
        SELECT * FROM pairs WHERE user_id IN (
          SELECT user_id FROM pairs GROUP BY user_id HAVING count(*) > 20)""")
_STEPS["one_user"] = (("pairs",), "SELECT * FROM pairs WHERE user_id = 1")
_vector_recommender("v50", "pairs", ("pairs",), "table_vectors", 50)
_vector_recommender("active", "active", ("active",), "table_vectors", 50)
_vector_recommender("one", "one_user", ("one_user",), "table_vectors", 1)
_vector_recommender("words", "pairs", ("pairs",), "embedded", 50)


def _topic_steps(tf: str, k: int = 40, steps: int = 10, inner: int = 5) -> str:
    """Steps of the topic model over a table of term counts; the name of the (paper_id, vector) step."""
    prior, name = 1.0 / k, f"{tf}_topics"

    def each(what: str) -> str:
        return "[" + ", ".join(what.replace("#", str(i + 1)) for i in range(k)) + "]"

    _STEPS[f"{name}_counts0"] = ((tf,), f"""
        SELECT term_id, list(CAST('0x' || substr({_draw(7, 'term_id', 'topic')}, 1, 8) AS BIGINT) / 4294967296.0 ORDER BY topic) AS n
        FROM (SELECT term_id, unnest(range({k})) AS topic FROM (SELECT DISTINCT term_id FROM {tf})) GROUP BY term_id""")
    for step in range(steps + 1):
        _STEPS[f"{name}_shares{step}"] = ((f"{name}_counts{step}",), f"""
            SELECT term_id, {each(f'(n[#] + {prior}) / (total[#] + {prior} * size)')} AS share
            FROM {name}_counts{step}, (SELECT {each('sum(n[#])')} AS total, count(*) AS size FROM {name}_counts{step})""")
        _STEPS[f"{name}_papers{step}_0"] = ((tf,), f"""
            SELECT paper_id, {each(repr(prior))} AS share, CAST(sum({tf}) AS DOUBLE) AS length FROM {tf} GROUP BY paper_id""")
        for turn in range(inner + 1):
            met = f"""
                (SELECT paper_id, term_id, p.share AS share, length, t.share AS term, c.{tf} / list_dot_product(t.share, p.share) AS w
                 FROM {tf} c JOIN {name}_shares{step} t USING (term_id) JOIN {name}_papers{step}_{turn} p USING (paper_id))"""
            needs = (tf, f"{name}_shares{step}", f"{name}_papers{step}_{turn}")
            if turn < inner:
                _STEPS[f"{name}_papers{step}_{turn + 1}"] = (needs, f"""
                    SELECT paper_id, {each(f'(any_value(share)[#] * sum(w * term[#]) + {prior}) / (any_value(length) + 1)')} AS share,
                           any_value(length) AS length
                    FROM {met} GROUP BY paper_id""")
            elif step < steps:
                _STEPS[f"{name}_counts{step + 1}"] = (needs, f"""
                    SELECT term_id, {each('sum(w * term[#] * share[#])')} AS n FROM {met} GROUP BY term_id""")
    _STEPS[name] = ((f"{name}_papers{steps}_{inner}",), f"""
        SELECT paper_id, 1 AS n_tokens, share AS vector FROM {name}_papers{steps}_{inner}""")
    return name


_topic_steps("tf")
_topic_steps("stem_tf")
_vector_recommender("topics", "pairs", ("pairs",), "stem_tf_topics", 20)


def _dense(scores: str, k: int) -> str:
    return f"""
        SELECT user_id, rank, paper_id, similarity
        FROM (SELECT *, dense_rank() OVER (PARTITION BY user_id ORDER BY similarity DESC) AS rank FROM {scores})
        WHERE rank <= {k}"""


def _exact(scores: str, k: int) -> str:
    return f"""
        SELECT user_id, rank, paper_id, similarity
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY similarity DESC, paper_id) AS rank
              FROM {scores})
        WHERE rank <= {k}"""


def _metrics(name: str, lists: str, split: str, ndcg: str, no_hit: str) -> None:
    """Steps of the metrics per user and cut-off over the exact lists."""
    _STEPS[f"metrics_{name}"] = ((lists, split), f"""
        SELECT user_id, k, hits / CAST(k AS DOUBLE) AS precision, hits / CAST(n_test AS DOUBLE) AS recall,
               CASE WHEN hits > 0 THEN 1.0 / first ELSE {no_hit} END AS mrr, {ndcg} AS ndcg
        FROM (SELECT l.user_id, k, any_value(n_test) AS n_test,
                     count(t.paper_id) AS hits, min(CASE WHEN t.paper_id IS NOT NULL THEN l.rank END) AS first,
                     coalesce(sum(CASE WHEN t.paper_id IS NOT NULL THEN 1 / log2(l.rank + 1) END), 0) AS gain
              FROM (SELECT unnest([5, 10, 30]) AS k)
              JOIN {lists} l ON l.rank <= k
              LEFT JOIN (SELECT * FROM {split} WHERE is_test) t
                ON t.user_id = l.user_id AND t.paper_id = l.paper_id
              JOIN (SELECT user_id, count(*) AS n_test FROM {split} WHERE is_test GROUP BY user_id) n
                ON n.user_id = l.user_id
              GROUP BY l.user_id, k)""")


_IDEAL = "list_sum(list_transform(range(1, least(n_test, k) + 1), lambda i: 1 / log2(i + 1)))"
_NDCG = f"gain / {_IDEAL}"
_NDCG_AS_WRITTEN = """(hits / log2(k + 1)) / (1 + CASE WHEN hits > 0 THEN hits / log2(hits + 1) ELSE 0 END)"""
_STEPS["lists50"] = (("scores_v50",), _exact("scores_v50", 35))
_STEPS["lists20"] = (("term_scores",), _exact("term_scores", 40))
_metrics("v50", "lists50", "split_v50", _NDCG, "0")
_metrics("v50w", "lists50", "split_v50", _NDCG_AS_WRITTEN, "1.0 / k")
_metrics("t20", "lists20", "split20", _NDCG, "0")


def _averages(name: str) -> str:
    columns = ", ".join(f"round(avg({m}), 6) AS {m}" for m in ("precision", "recall", "mrr", "ndcg"))
    return f"SELECT CAST(k AS BIGINT) AS k, {columns} FROM {name} GROUP BY k"


def _at_10(metric: str) -> str:
    return f"""
        SELECT user_id, CAST(k AS BIGINT) AS k, round({metric}, 6) AS {metric}_at_k
        FROM metrics_v50 WHERE k = 10"""


def _joined(source: str, column: str = "words") -> str:
    return f"SELECT paper_id, array_to_string({column}, ' ') AS {column} FROM {source}"


def _first_places(source: str) -> str:
    """Lists without repeats, in the order of first places, as text."""
    return f"""
        SELECT w.paper_id, coalesce(words, '') AS words
        FROM (SELECT paper_id FROM {source}) w
        LEFT JOIN (SELECT paper_id, string_agg(word, ' ' ORDER BY place) AS words
                   FROM (SELECT paper_id, word, min(place) AS place
                         FROM (SELECT paper_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM {source})
                         GROUP BY paper_id, word)
                   GROUP BY paper_id) USING (paper_id)"""


def _list_facts(train: str, k: int) -> str:
    """Full lists without gaps or seen papers, all of their scores right."""
    return f"""
        SELECT DISTINCT user_id, {k}::BIGINT AS levels, {k}::BIGINT AS last, 0::BIGINT AS seen, 0::BIGINT AS wrong
        FROM {train} JOIN conservative USING (paper_id) WHERE len(words) > 0"""


def _type_index(source: str) -> str:
    return f"""
        (SELECT type, row_number() OVER (ORDER BY count(*) DESC, type) - 1 AS type_index,
                count(*) OVER () AS n_types
         FROM {source} WHERE type IS NOT NULL GROUP BY type)"""


def _feature_rows(source: str) -> str:
    return f"""
        SELECT user_id, paper_id, label,
               round(coalesce(pages, avg(pages) OVER ()), 6) AS pages,
               round(coalesce(year, avg(year) OVER ()), 6) AS year,
               max(n_types) OVER () AS places, coalesce(type_index, -1) AS place,
               round(user_pages, 6) AS user_pages, round(CAST(user_papers AS DOUBLE), 6) AS user_papers
        FROM {source} LEFT JOIN {_type_index(source)} USING (type)"""


def _place_rows(source: str, key: str, vector: str) -> str:
    return f"""
        SELECT {key}, place - 1 AS place, round(value, 6) + 0 AS value
        FROM (SELECT {key}, unnest({vector}) AS value, unnest(range(1, len({vector}) + 1)) AS place FROM {source})"""


_TESTED = """
        SELECT user_id, paper_id, label, true AS valid FROM mixed_rows
        WHERE CAST('0x' || substr(md5(concat_ws('|', '7', CAST(user_id AS VARCHAR), CAST(paper_id AS VARCHAR))), 1, 8) AS BIGINT)
              >= 0.8 * 4294967296"""

_PAPER_COLUMNS = ", ".join(
    {
        "paper_id": "paper_id",
        "type": """'a "type", ' || paper_id % 3 AS type""",
        "pages": "CASE WHEN paper_id % 10 <> 0 THEN paper_id % 500 END AS pages",
        "year": "CASE WHEN paper_id % 7 <> 0 THEN CAST(1990 + paper_id % 30 AS VARCHAR) END AS year",
        "title": "coalesce(title, '') AS title",
        "abstract": "coalesce(abstract, '') AS abstract",
    }.get(name, f"'{name} ' || paper_id AS {name}")
    for name in PAPERS_SCHEMA.names
)


_MARKED_COLUMNS = ", ".join(
    {
        "paper_id": "paper_id",
        "pages": "paper_id % 500 AS pages",
        "title": """translate(coalesce(title, ''), 'aei', '"\\,') AS title""",
        "abstract": """'"' || translate(coalesce(abstract, ''), 'tn ', '\\"' || chr(10)) || '\\"' AS abstract""",
    }.get(name, f"""'{name} "\\" \\\\ ' || chr(10) || paper_id AS {name}""")
    for name in PAPERS_SCHEMA.names
)


_SYNONYM = """(SELECT vector FROM vectors WHERE paper_id = {})"""


def _plus(u: str, v: str, sign: str = "+") -> str:
    return f"list_transform(list_zip({u}, {v}), lambda p: p[1] {sign} p[2])"


_ANALOGY = _plus(
    _plus(_plus(_SYNONYM.format(3), _SYNONYM.format(11)), _SYNONYM.format(5), "-"),
    _plus(_SYNONYM.format(8), _SYNONYM.format(21)),
)


def _nearest(query: str, n: int) -> str:
    return f"""
        SELECT paper_id AS word, round(list_cosine_similarity(vector, {query}), 6) + 0 AS similarity
        FROM vectors ORDER BY similarity DESC, word LIMIT {n}"""


# query: (steps it needs, statement)
_STATEMENTS: dict[str, tuple[tuple[str, ...], str]] = {
    # sources and sinks
    "scan_papers_csv": (("papers",), """
        SELECT paper_id, CAST(NULL AS VARCHAR) AS type,
               translate(concat_ws(' ', title, abstract), chr(13) || chr(10), '  ') AS title,
               CAST(NULL AS VARCHAR) AS abstract
        FROM papers"""),
    "scan_libraries_text": (("lines",), """
        SELECT user_id, array_to_string(paper_ids, ',') AS paper_ids FROM lines"""),
    "explode_library": (("lines",), "SELECT user_id, unnest(paper_ids) AS paper_id FROM lines"),
    "nested_library_size": (("lines",), """
        SELECT user_id, array_to_string(paper_ids, ',') AS paper_ids, len(paper_ids) AS library_size
        FROM lines"""),
    "scan_stopwords_text": (("conservative", "n_papers"), """
        , frequent AS (
          SELECT term FROM (SELECT DISTINCT paper_id, unnest(words) AS term FROM conservative)
          GROUP BY term HAVING count(*) > (SELECT n FROM n_papers) / 3.0),
        listed AS (SELECT list(term) AS stop FROM frequent)
        SELECT paper_id,
               array_to_string(list_filter(words, lambda x: NOT list_contains(stop, x)), ' ') AS words
        FROM conservative, listed"""),
    "save_and_reload_tables": (("weights",), """
        SELECT paper_id, term_id, round(weight, 6) AS weight FROM weights"""),
    "save_text": (("metadata",), "SELECT * FROM metadata"),
    # projections and filters
    "project_papers": (("papers",), "SELECT * FROM papers"),
    "rename_and_drop": (("metadata",), """
        SELECT paper_id AS paper_idx, pages, CAST(floor(year / 10) * 10 AS BIGINT) AS decade FROM metadata"""),
    "concat_text": (("papers",), f"SELECT paper_id, {_TEXT} AS title_abstract FROM papers"),
    "cast_paper_id": ((), """
        SELECT p_retailprice AS price,
               TRY_CAST(CASE WHEN p_size > 40 THEN p_name ELSE CAST(p_partkey AS VARCHAR) END AS INTEGER) AS paper_id
        FROM part"""),
    "constant_column": (("library_pages",), """
        SELECT user_id, CAST(sum(count) AS BIGINT) AS papers FROM library_pages GROUP BY user_id"""),
    "filter_user": (("pairs",), "SELECT * FROM pairs WHERE user_id = 1"),
    "filter_library_size": (("pairs",), """
        SELECT user_id, count(*) AS library_size FROM pairs GROUP BY user_id HAVING count(*) > 20"""),
    "exclude_seen": (("pairs",), f"""
        , split AS ({_split_of('pairs')})
        SELECT user_id, paper_id FROM pairs p WHERE NOT EXISTS (
          SELECT 1 FROM split s WHERE s.user_id = p.user_id AND s.paper_id = p.paper_id AND NOT is_test)"""),
    "keep_vocabulary_terms": (("term_sets", "vocabulary"), """
        SELECT paper_id, term FROM term_sets WHERE term IN (SELECT term FROM vocabulary)"""),
    "document_frequency_band": (("band",), "SELECT * FROM band"),
    # text
    "tokenize": (("tokens",), _joined("tokens")),
    "remove_stopwords": (("tokens",), f"""
        SELECT paper_id, array_to_string({_without_stop('words')}, ' ') AS words FROM tokens"""),
    "strip_marks": ((), f"""
        SELECT page_id, array_to_string({_stripped(_tokens("concat_ws(' ', url, html)"))}, ' ') AS words
        FROM pages"""),
    "merge_token_lists": (("pairs", "conservative"), """
        SELECT user_id, 0 AS part,
               array_to_string(flatten(list(words ORDER BY paper_id)), ' ') AS words
        FROM pairs JOIN conservative USING (paper_id) GROUP BY user_id"""),
    "collect_user_words": (("pairs", "conservative"), """
        SELECT user_id, CAST(sum(len(words)) AS BIGINT) AS tokens
        FROM pairs JOIN conservative USING (paper_id) GROUP BY user_id"""),
    # explode, nest, ids
    "explode_terms": (("term_sets",), "SELECT * FROM term_sets"),
    "nest_terms": (("words",), """
        SELECT paper_id, array_to_string(list_sort(words), ' ') AS terms FROM words"""),
    "nest_term_rows": (("term_rows",), """
        SELECT paper_id, string_agg(term, ' ' ORDER BY term) AS terms FROM term_rows GROUP BY paper_id"""),
    "collect_ranked": (("profiles_v50", "train_v50", "vectors"), f"""
        , coarse AS (SELECT paper_id, list_transform(vector, lambda x: round(x, 1)) AS vector FROM vectors)
        , scored AS (
          SELECT u.user_id, v.paper_id,
                 CASE WHEN {_VECTOR_SIZE_SUM.format('u.vector')} * {_VECTOR_SIZE_SUM.format('v.vector')} > 0
                      THEN round(list_cosine_similarity(u.vector, v.vector), 1) + 0 END AS similarity
          FROM profiles_v50 u CROSS JOIN coarse v
          WHERE NOT EXISTS (SELECT 1 FROM train_v50 t WHERE t.user_id = u.user_id AND t.paper_id = v.paper_id))
        , ranked AS (
          SELECT *, dense_rank() OVER (PARTITION BY user_id ORDER BY similarity DESC) AS rank
          FROM scored WHERE similarity IS NOT NULL)
        , placed AS (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rank, paper_id) AS place FROM ranked WHERE rank <= 35)
        SELECT user_id, (place - 1) // 20 AS part, string_agg(CAST(paper_id AS VARCHAR), ',' ORDER BY place) AS recommendations
        FROM placed GROUP BY user_id, part"""),
    "merged_lists_in_parts": (("pairs", "conservative"), """
        SELECT user_id, part, array_to_string(flatten(list(words ORDER BY paper_id)), ' ') AS words
        FROM (SELECT user_id, paper_id, words,
                     CAST(coalesce(sum(len(words)) OVER (PARTITION BY user_id ORDER BY paper_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 1000 AS BIGINT) AS part
              FROM pairs JOIN conservative USING (paper_id))
        GROUP BY user_id, part"""),
    "assign_user_ids": (("pairs",), """
        SELECT user_id, row_number() OVER (ORDER BY md5(CAST(user_id AS VARCHAR)), user_id) - 1 AS user_idx
        FROM (SELECT DISTINCT user_id FROM pairs)"""),
    "library_size": (("pairs",), "SELECT user_id, count(*) AS library_size FROM pairs GROUP BY user_id"),
    # joins
    "join_library_vectors": (("train20", "weights"), """
        SELECT user_id, paper_id, term_id, round(weight, 6) AS weight
        FROM train20 JOIN weights USING (paper_id)"""),
    "join_profile_split": (("term_profiles", "split20"), """
        SELECT * FROM (SELECT user_id, count(*) AS n_terms, round(sum(weight), 6) AS weight
                       FROM term_profiles GROUP BY user_id)
        JOIN (SELECT user_id, count(*) FILTER (NOT is_test) AS n_train, count(*) FILTER (is_test) AS n_test
              FROM split20 GROUP BY user_id) USING (user_id)"""),
    "join_profile_sample": (("split_v50", "profiles_v50"), f"""
        SELECT user_id, paper_id, round({_VECTOR_SIZE_SUM.format('vector')}, 6) AS length
        FROM split_v50 JOIN profiles_v50 USING (user_id) WHERE is_test"""),
    "join_user_words": (("pairs", "conservative"), """
        SELECT user_id, paper_id, len(words) AS tokens FROM pairs JOIN conservative USING (paper_id)"""),
    "join_paper_features": (("pairs", "metadata"), """
        SELECT user_id, paper_id, 1 AS label, type, pages, year FROM pairs JOIN metadata USING (paper_id)"""),
    "join_library_metadata": (("library_pages",), "SELECT * FROM library_pages"),
    "join_user_features": (("pairs", "stats"), """
        SELECT user_id, paper_id, 1 AS label, round(user_pages, 6) AS user_pages, user_papers
        FROM pairs JOIN stats USING (user_id)"""),
    "restrict_profiles": (("active", "vectors"), """
        SELECT user_id, round(sqrt(sum(total * total)), 6) AS length
        FROM (SELECT user_id, place, sum(vector[place]) AS total
              FROM active JOIN vectors USING (paper_id), unnest(range(1, len(vector) + 1)) AS p(place)
              GROUP BY user_id, place)
        GROUP BY user_id"""),
    "score_pairs_by_terms": (("term_scores",), "SELECT * FROM term_scores"),
    "score_all_pairs_by_terms": (("all_term_scores",), "SELECT * FROM all_term_scores"),
    "score_pairs_by_vectors": (("scores_v50",), "SELECT * FROM scores_v50"),
    # aggregations
    "count_distinct_papers": (("n_papers",), "SELECT n AS n_papers FROM n_papers"),
    "document_frequency": (("frequencies",), "SELECT * FROM frequencies"),
    "profile_sum_sparse": (("term_profiles",), """
        SELECT user_id, term_id, round(weight, 6) AS weight FROM term_profiles"""),
    "profile_sum_dense": (("pairs", "vectors"), """
        SELECT user_id, place - 1 AS place, round(sum(vector[place]), 6) + 0 AS value
        FROM pairs JOIN vectors USING (paper_id), unnest(range(1, len(vector) + 1)) AS p(place)
        GROUP BY user_id, place"""),
    "user_profile_stats": (("stats",), """
        SELECT user_id, round(user_pages, 6) AS user_pages, user_papers FROM stats"""),
    "collect_recommendations": (("lists50",), """
        SELECT user_id, string_agg(CAST(paper_id AS VARCHAR), ',' ORDER BY rank) AS recommendations
        FROM lists50 GROUP BY user_id"""),
    "average_metric": (("metrics_v50",), """
        SELECT CAST(k AS BIGINT) AS k, round(avg(precision), 6) AS precision FROM metrics_v50 GROUP BY k"""),
    # ranking, sampling, splitting, union
    "topk_dense_rank": (("vectors",), f"""
        , scored AS (SELECT CAST(label AS BIGINT) AS user_id, paper_id, round(vector[1], 1) + 0 AS similarity
                     FROM vectors)
        {_dense('scored', 3)}"""),
    "topk_row_number": ((), _exact("""(
        SELECT l_suppkey AS user_id, l_orderkey * 10 + l_linenumber AS paper_id, l_quantity AS similarity
        FROM lineitem)""", 5)),
    "topk_terms": (("frequencies",), """
        SELECT term, df, row_number() OVER (ORDER BY df DESC, term) - 1 AS term_id
        FROM frequencies ORDER BY df DESC, term LIMIT 1000"""),
    "topk_terms_by_summary": (("frequencies",), """
        SELECT term, df, row_number() OVER (ORDER BY df DESC, term) - 1 AS term_id
        FROM frequencies ORDER BY df DESC, term LIMIT 1000"""),
    "sample_users": (("pairs",), f"SELECT DISTINCT user_id FROM ({_sampled('pairs', 20)})"),
    "split_train_test": (("pairs",), f"""
        SELECT user_id, paper_id, CAST(is_test AS INTEGER) AS is_test FROM ({_split_of('pairs')})"""),
    "random_split_rows": (("pairs",), f"""
        SELECT user_id, paper_id,
               CASE WHEN CAST('0x' || substr({_draw(7, 'user_id', 'paper_id')}, 1, 8) AS BIGINT) < 0.8 * 4294967296
                    THEN 'train' ELSE 'test' END AS part
        FROM pairs"""),
    "sample_negatives": (("negatives",), "SELECT * FROM negatives"),
    "union_interactions": (("pairs", "negatives"), """
        SELECT user_id, label, count(*) AS pairs, CAST(sum(paper_id) AS BIGINT) AS id_sum
        FROM (SELECT user_id, paper_id, 1 AS label FROM pairs UNION ALL SELECT * FROM negatives)
        GROUP BY user_id, label"""),
    "distinct_rows": (("papers",), "SELECT DISTINCT title, abstract FROM papers"),
    # vectors
    "cosine_similarity": (("with_sum",), """
        SELECT vec_id, round(list_cosine_similarity(vector, total), 6) + 0 AS similarity FROM with_sum"""),
    "cosine_of_zero_vectors": (("with_sum",), """
        SELECT vec_id, CASE WHEN label > 0 THEN round(list_cosine_similarity(vector, total), 6) + 0 END AS similarity
        FROM with_sum"""),
    "dense_to_sparse": (("vectors",), """
        SELECT paper_id, place - 1 AS term_id, round(value, 2) AS weight
        FROM (SELECT paper_id, unnest(vector) AS value, unnest(range(1, len(vector) + 1)) AS place FROM vectors)
        WHERE round(value, 2) <> 0"""),
    "vector_add_subtract": (("with_sum",), _place_rows(
        "with_sum", "vec_id", _plus(_plus("vector", "total", "-"), "vector"))),
    # features
    "term_frequency": (("tf",), "SELECT * FROM tf"),
    "count_vectors": (("tf",), "SELECT * FROM tf"),
    "inverse_document_frequency": (("idf",), "SELECT term_id, df, round(idf, 6) AS idf FROM idf"),
    "tf_idf": (("weights",), "SELECT paper_id, term_id, round(weight, 6) AS weight FROM weights"),
    "find_synonyms": (("vectors",), f"""
        SELECT paper_id AS word, round(list_cosine_similarity(vector, {_SYNONYM.format(7)}), 6) + 0 AS similarity
        FROM vectors WHERE paper_id <> 7 ORDER BY similarity DESC, word LIMIT 10"""),
    "find_synonyms_of_vector": (("vectors",), _nearest(_ANALOGY, 10)),
    "analogy": (("vectors",), f"""
        SELECT * FROM ({_nearest(_ANALOGY, 5)}) WHERE word NOT IN (3, 11, 5, 8, 21)
        ORDER BY similarity DESC, word LIMIT 1"""),
    "document_embedding": (("embedded",), f"""
        SELECT paper_id, n_tokens, place - 1 AS place, round(value, 6) + 0 AS value
        FROM (SELECT paper_id, n_tokens, unnest(vector) AS value, unnest(range(1, len(vector) + 1)) AS place
              FROM embedded)"""),
    "index_type": (("pairs", "metadata"), f"""
        , typed AS (SELECT user_id, paper_id, type FROM pairs JOIN metadata USING (paper_id))
        SELECT user_id, paper_id, type,
               CAST(coalesce(type_index, (SELECT count(DISTINCT type) FROM typed)) AS DOUBLE) AS type_index
        FROM typed LEFT JOIN {_type_index('typed')} USING (type)"""),
    "impute_mean": (("positive_rows",), f"""
        SELECT user_id, paper_id, round(coalesce(pages, avg(pages) OVER ()), 6) AS pages,
               round(coalesce(year, avg(year) OVER ()), 6) AS year,
               CAST(coalesce(type_index, (SELECT count(DISTINCT type) FROM positive_rows)) AS DOUBLE) AS type_index
        FROM positive_rows LEFT JOIN {_type_index('positive_rows')} USING (type)"""),
    "one_hot": (("positive_rows",), f"""
        SELECT user_id, paper_id, places, place FROM ({_feature_rows('positive_rows')})"""),
    "assemble_features": (("positive_rows",), _feature_rows("positive_rows")),
    "rmse": ((), """
        SELECT round(sqrt(avg((quality - CAST(toxic AS DOUBLE)) ** 2)), 6) AS rmse FROM labels"""),
    # metrics
    "precision_at_k": (("metrics_v50",), _at_10("precision")),
    "recall_at_k": (("metrics_v50",), _at_10("recall")),
    "mrr_at_k": (("metrics_v50",), _at_10("mrr")),
    "ndcg_at_k": (("metrics_v50",), _at_10("ndcg")),
    "evaluate_metrics": (("metrics_v50",), _averages("metrics_v50")),
    "evaluate_metrics_as_written": (("metrics_v50w",), _averages("metrics_v50w")),
    "evaluate_tfidf": (("metrics_t20",), _averages("metrics_t20")),
    # recommenders
    "recommend_tfidf_with_zeros": (("all_term_scores",), _dense("all_term_scores", 900)),
    "recommend_tfidf": (("term_scores",), _dense("term_scores", 40)),
    "recommend_from_vectors": (("scores_v50",), _dense("scores_v50", 35)),
    "recommend_from_balls": (("scores_v50",), _dense("scores_v50", 35)),
    "recommend_user_from_vectors": (("scores_one",), _dense("scores_one", 10)),
    "recommend_active_from_vectors": (("scores_active",), _dense("scores_active", 35)),
    "recommend_from_word_table": (("scores_words",), _dense("scores_words", 35)),
    "build_vocabulary": (("vocabulary",), "SELECT * FROM vocabulary"),
    "classification_dataset": (("mixed_rows",), _feature_rows("mixed_rows")),
    "preprocess_conservative": (("conservative",), _joined("conservative")),
    "preprocess_intensive": (("conservative",), f"""
        SELECT paper_id, array_to_string({_without_stop('words')}, ' ') AS words FROM conservative"""),
    # facts of trained results
    "lda_topic_facts": (("tf",), "SELECT DISTINCT paper_id, 40 AS places, 1.0::DOUBLE AS total FROM tf"),
    "word2vec_vocabulary": (("conservative",), """
        SELECT word, 100 AS places FROM (SELECT unnest(words) AS word FROM conservative)
        GROUP BY word HAVING count(*) >= 5"""),
    "recommend_embedding_facts": (("train_v50", "conservative"), _list_facts("train_v50", 35)),
    "recommend_embedding_active_facts": (("train_active", "conservative"), _list_facts("train_active", 35)),
    "recommend_embedding_user_facts": (("train_one", "conservative"), _list_facts("train_one", 10)),
    "skipgram_vocabulary": (("conservative",), """
        SELECT word, 20 AS places FROM (SELECT unnest(words) AS word FROM conservative)
        GROUP BY word HAVING count(*) >= 5"""),
    "skipgram_pair_counts": (("conservative",), """
        , placed AS (SELECT paper_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM conservative)
        , met AS (
          SELECT least(x.word, y.word) AS a, greatest(x.word, y.word) AS b, CAST(sum(6 - (y.place - x.place)) AS BIGINT) AS n
          FROM placed x JOIN placed y ON x.paper_id = y.paper_id AND y.place BETWEEN x.place + 1 AND x.place + 5
          GROUP BY 1, 2)
        SELECT a, count(*) AS pairs, CAST(sum(n) AS BIGINT) AS n FROM met GROUP BY a"""),
    "linear_svm_facts": (("mixed_rows",), _TESTED),
    "random_forest_facts": (("mixed_rows",), _TESTED),
    "scan_papers_multi_line": (("papers",), f"SELECT {_PAPER_COLUMNS} FROM papers"),
    "scan_papers_all_columns": (("papers",), f"SELECT {_MARKED_COLUMNS} FROM papers"),
    # topics by steps
    "lda_topics": (("tf_topics",), _place_rows("tf_topics", "paper_id", "vector")),
    "join_library_topics": (("train20", "tf_topics"), """
        SELECT user_id, paper_id, place - 1 AS place, round(value, 6) + 0 AS value
        FROM (SELECT user_id, paper_id, unnest(vector) AS value, unnest(range(1, len(vector) + 1)) AS place
              FROM train20 JOIN tf_topics USING (paper_id))"""),
    "recommend_lda": (("scores_topics",), _dense("scores_topics", 40)),
    # stems
    "stem_bag": (("stem_bags",), _joined("stem_bags")),
    "stem_distinct": (("stem_bags",), _first_places("stem_bags")),
    "stem_word_rows": (("term_rows", "stem_of"), """
        SELECT paper_id, term, stem, count(*) AS places FROM term_rows JOIN stem_of ON word = term
        GROUP BY paper_id, term, stem"""),
    "build_vocabulary_stemmed": (("stem_vocabulary",), "SELECT * FROM stem_vocabulary"),
    "preprocess_intensive_stemmed": (("intensive_stems",), _first_places("intensive_stems")),
    "recommend_tfidf_stemmed": (("stem_term_scores",), _dense("stem_term_scores", 40)),
    "scan_papers_with_floats": (("papers",), """
        SELECT paper_id, 'a "type", ' || paper_id % 3 AS type,
               CASE WHEN paper_id % 10 <> 0 THEN CAST(paper_id % 500 AS DOUBLE) END AS pages,
               CASE WHEN paper_id % 7 <> 0 THEN CAST(1990 + paper_id % 30 AS DOUBLE) END AS year
        FROM papers"""),
}


def _with_steps(needs: tuple[str, ...], statement: str) -> str:
    ordered: list[str] = []

    def place(name: str) -> None:
        if name not in ordered:
            for needed in _STEPS[name][0]:
                place(needed)
            ordered.append(name)

    for name in needs:
        place(name)
    statement = statement.strip()
    if not ordered:
        return statement
    steps = ",\n".join(f"{name} AS MATERIALIZED ({_STEPS[name][1]})" for name in ordered)
    return f"WITH {steps}\n{statement}"


ORACLES: dict[str, str] = {
    name: _with_steps(needs, statement) for name, (needs, statement) in _STATEMENTS.items()
}
