"""Edits that turn a sequence of conversation rows into the grammar ``(s?(ua)+)?``.

A row is one symbol: the initial of its role (``s u a``, ``x`` for any other), in upper
case if its text is truncated, or ``-`` if it has to be deleted. Edits are Delete (2),
Insert user/assistant (5), Keep (0) and Rerole to user/assistant (1); a truncated row
that stays costs 5 more. An audit is the initials of the edits in order; the audit and
the rows before it fix the repaired roles.

Targets of every length are aligned by the Wagner-Fischer recurrence. Targets that end
alike share their last symbols, so one table over (row, symbols left) holds the tables
of all lengths, and each length is backtraced from its own cell. Ukkonen's bound from
the cost of a first, greedy repair keeps the cells near the diagonal: a cell off it by
d needs d deletions or d insertions.
"""

INFINITE = 1 << 60
DELETE, INSERT, REROLE, CUT = 2, 5, 1, 5  # fixed values of the contract
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = "uuau"  # the symbol after each state, after a possible leading s
STATE = {"u": USER, "a": ASSISTANT}
ROLES = {"u": "user", "a": "assistant"}
_OTHER = {"u": "a", "a": "u"}


def greedy_cost(symbols: str, state: int = START) -> int:
    """Cost of a first repair that never looks ahead: an upper bound."""
    cost = 0
    for symbol in symbols:
        if symbol == "-" or symbol.isupper():
            cost += DELETE
        elif symbol == "s" and state == START:
            state = SYSTEM
        else:
            cost += symbol != NEXT[state]
            state = STATE[NEXT[state]]
    cost += {START: 0, SYSTEM: 2 * INSERT, USER: INSERT, ASSISTANT: 0}[state]
    return cost


class Table:
    """Cheapest edits of rows i.. to the last r symbols of an alternating string that ends with ``end``.

    ``closing`` allows insertions behind the last row.
    """

    def __init__(self, symbols: str, end: str, bound: int, closing: bool):
        self.symbols, self.end, self.closing = symbols, end, closing
        down, up = bound // DELETE, bound // INSERT
        n = len(symbols)
        self.low = [max(0, n - i - down) for i in range(n + 1)]
        self.lines = [[]] * n + [[INSERT * r if closing or not r else INFINITE for r in range(up + 1)]]
        for i in range(n - 1, -1, -1):
            symbol, below, shift = symbols[i], self.lines[i + 1], self.low[i] - self.low[i + 1]
            stays, want = symbol != "-", symbol.lower()
            extra = CUT if symbol.isupper() else 0
            line, left = [], INFINITE
            for k in range(n - i + up - self.low[i] + 1):
                r, at = self.low[i] + k, k + shift
                best = below[at] + DELETE if at < len(below) else INFINITE
                if left + INSERT < best:
                    best = left + INSERT
                if stays and r and 0 <= at - 1 < len(below):
                    kept = below[at - 1] + extra + (want != self.symbol(r))
                    if kept < best:
                        best = kept
                line.append(best)
                left = best
            self.lines[i] = line

    def symbol(self, r: int) -> str:
        return self.end if r % 2 else _OTHER[self.end]

    def cost(self, i: int, r: int) -> int:
        k = r - self.low[i]
        return min(self.lines[i][k], INFINITE) if 0 <= k < len(self.lines[i]) else INFINITE

    def lengths(self, i: int) -> range:
        return range(max(1, self.low[i]), self.low[i] + len(self.lines[i]))

    def audit(self, i: int, r: int) -> str:
        """The ASCII-least of the cheapest edits from one cell, greedily: D, I, K, R."""
        out, n = [], len(self.symbols)
        while i < n or r:
            here = self.cost(i, r)
            if i < n and self.cost(i + 1, r) + DELETE == here:
                out.append("D")
                i += 1
            elif r and (i < n or self.closing) and self.cost(i, r - 1) + INSERT == here:
                out.append("I")
                r -= 1
            else:
                out.append("K" if self.symbols[i].lower() == self.symbol(r) else "R")
                i, r = i + 1, r - 1
        return "".join(out)


class Alignments:
    """All targets of a run of rows from each entering state."""

    def __init__(self, symbols: str, closing: bool, slack: int = 0):
        bound = max(greedy_cost(symbols), 0) + slack
        ends = "a" if closing else "ua"
        self.symbols = symbols
        self.tables = [Table(symbols, end, bound, closing) for end in ends]

    def targets(self, state: int):
        """(cost, end state, how) of every feasible length from ``state``."""
        n = len(self.symbols)
        yield DELETE * n, state, (None, n, 0)
        starts = [(0, 0)]
        if state == START:
            for i, symbol in enumerate(self.symbols):
                if symbol in "sS":
                    cost = DELETE * i + (CUT if symbol == "S" else 0)
                    yield cost + DELETE * (n - i - 1), SYSTEM, (None, i, 1)
                    starts.append((cost, i + 1))
        for table in self.tables:
            for before, i in starts:
                for r in table.lengths(i):
                    first = table.symbol(r)
                    if first == NEXT[state] and table.cost(i, r) < INFINITE:
                        yield before + table.cost(i, r), STATE[table.end], (table, i, r)

    def audit(self, how) -> str:
        table, i, r = how
        n = len(self.symbols)
        if table is None:
            return "D" * i + ("K" + "D" * (n - i - 1) if r else "")
        return ("D" * (i - 1) + "K" if i else "") + table.audit(i, r)

    def best(self, state: int, onward: list[int]) -> tuple[int, int, str]:
        """(cost with what follows, end state, audit): cheapest, then the ASCII-least audit of all lengths."""
        found = [(cost + onward[end], end, how) for cost, end, how in self.targets(state)]
        least = min(cost for cost, _, _ in found)
        audit, end = min((self.audit(how), end) for cost, end, how in found if cost == least)
        return least, end, audit

    def costs(self) -> list[int]:
        """The cheapest way from each state to each: 16 numbers."""
        least = [INFINITE] * 16
        for state in range(4):
            for cost, end, _ in self.targets(state):
                least[4 * state + end] = min(least[4 * state + end], cost)
        return least


ACCEPT = [0, INFINITE, INFINITE, 0]
OPEN_SLACK = 4 * INSERT  # entering and leaving in another state costs at most an insertion and a rerole each


def whole_audit(symbols: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    cost, _, audit = Alignments(symbols, closing=True).best(START, ACCEPT)
    return cost, audit


def closing_costs(symbols: str) -> list[int]:
    """The cheapest way to the end of the conversation from each state."""
    aligned = Alignments(symbols, closing=True, slack=OPEN_SLACK)
    return [min(cost + ACCEPT[end] for cost, end, _ in aligned.targets(state)) for state in range(4)]


def segment_audits(symbols: str, onward: list[int], closing: bool) -> tuple[list[str], list[int]]:
    """The audit and the end state from each entering state, given the costs of what follows."""
    aligned = Alignments(symbols, closing, OPEN_SLACK)
    found = [aligned.best(state, ACCEPT if closing else onward) for state in range(4)]
    return [audit for _, _, audit in found], [end for _, end, _ in found]


def apply_audit(audit: str, rows: list[tuple[str, str]], state: int = START) -> tuple[list[tuple[str, str]], int]:
    """The repaired (role, text) rows and the state after them."""
    out, i = [], 0
    for edit in audit:
        if edit == "D":
            i += 1
            continue
        if edit == "K" and state == START and rows[i][0][:1] == "s":
            state = SYSTEM
        else:
            state = STATE[NEXT[state]]
        name = ROLES["u" if state == USER else "a"]
        if edit == "I":
            out.append((name, ""))
            continue
        out.append(rows[i] if edit == "K" else (name, rows[i][1]))
        i += 1
    return out, state
