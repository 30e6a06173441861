"""Operator 12: conversation structure repair over a suffix-shared automaton.

Every row of a conversation is one symbol: its role initial and its first fault. A conversation
is then a word, and the cheapest edits that make its role initials match ``(s?(ua)+)?`` depend on
the word alone. Words are shared from their end: the automaton has one node for each distinct
suffix, whose cost-to-go and best next edit are computed once for each grammar state, whatever
number of conversations run through it. The distinct words are range-partitioned and sorted by
their reversed text, so a task meets words with common suffixes one after the other: nodes of the
common suffix stay on a stack, only the rest is new. A node's four costs are its base cost and one
of a few difference patterns, so a node takes ten bytes and a step is one table look-up.

Ties: in a grammar state each edit letter leads to one continuation only, so the ASCII-least of
the cheapest edit strings takes the least letter among the cheapest edits at every step.

Scale: one shuffle of slim rows (no texts) to conversations, one exchange of distinct words, one
shuffle of the texts for the repair; all are streamed in sorted order, never collected. A
conversation is read by one task (SHA-256 over its rows and its edit string, one value of the
result, are sequential), which holds one byte of it per row, not its texts.

Defined results: null conv_id: a conversation of its own; null turns come first; null role or
text counts as one space; rows of one turn follow by role and digest of the text; repeated rows
are rows (all but the first are duplicates); empty and blank texts are blank whatever their
length; a role with another initial than s, u, a is kept nowhere; a conversation without rows:
zeros, empty audit, the empty string's hash; further columns, whatever their names, are ignored;
an empty table gives no rows.
"""
from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BATCH_BYTES, BATCH_ROWS, stored, take

SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1        # costs
# The grammar (s?(ua)+)?: states 0 nothing yet, 1 after s, 2 after u, 3 after a.
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
WANTED = (2, 2, 3, 2)              # state after the user or assistant that a state lets follow
ROLE_OF = {2: "user", 3: "assistant"}
ACCEPTING = (0, 3)
MUST_DELETE = "x"                  # symbols: x, or the role's s u a o; upper case if truncated

RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")


# ------------------------------------------------------------------ rows and faults (Spark side)
def rows_of(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, lost): null roles and texts are one space."""
    d = take(df, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    return d.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                    F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), F.lit(False).alias("lost"))


def damage(rows: DataFrame, of: int = 20) -> DataFrame:
    """The contract's damage by crc32(conv_id:turn) % 20. A dropped row stays as a mark (lost),
    so that its conversation is still returned."""
    def key(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(key("conv_id"), F.lit(":"), key("turn"))) % of
    return (rows.withColumn("kind", kind).select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), F.lit("")).when(F.col("kind") == 2, F.translate("text", ENDS, ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("lost") | (F.col("kind") == 0)).alias("lost"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
        .drop("copy"))


def _digest(c: str) -> Column:
    return F.unhex(F.sha2(F.col(c), 256))


def _in_order() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def symbols(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, symbol, lost) in order within hash partitions of conv_id; no texts."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    first = F.substring("role", 1, 1)
    slim = rows.select("conv_id", "turn", "role", "lost", _digest("text").alias("digest"),
                       (trimmed == "").alias("blank"), (~F.substring(trimmed, -1, 1).isin(*ENDS)).alias("cut"),
                       F.when(first.isin("s", "u", "a"), first).otherwise("o").alias("initial"))
    w = Window.partitionBy("conv_id", "role", "digest", "lost").orderBy(F.col("turn").asc_nulls_first())
    fault = (F.when(F.col("blank"), "b").when(F.col("nth") > 1, "d").when(F.col("cut"), "t").otherwise("-"))
    return (slim.repartition("conv_id").withColumn("nth", F.row_number().over(w))
            .sortWithinPartitions(*_in_order(), "lost", "nth")
            .select("conv_id", "turn", "lost", F.concat("initial", fault).alias("symbol")))


def _conf(df: DataFrame) -> None:
    conf = df.sparkSession.conf
    rows = conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    if int(rows) > BATCH_ROWS or int(rows) <= 0:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


class _Out:
    """Rows gathered into record batches."""
    def __init__(self, names: list[str], types: list[pa.DataType]):
        self.names, self.types, self.rows, self.size = names, types, [], 0

    def add(self, *row) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += sum(len(v) for v in row if isinstance(v, str))
        if len(self.rows) >= BATCH_ROWS or self.size >= BATCH_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*self.rows), self.types)], self.names)
            self.rows, self.size = [], 0


def words(symbol_rows: DataFrame) -> DataFrame:
    """(conv_id, word, gaps, blank, duplicate, truncated, illegal), one row per conversation."""
    legal = {"su", "ua", "au"}

    def run(batches):
        out = _Out(["conv_id", "word", "gaps", "blank", "duplicate", "truncated", "illegal"],
                   [pa.int64(), pa.string()] + [pa.int64()] * 5)
        started, conv = False, None
        word = low = high = last_turn = last = None
        turns = illegal = 0
        faults = {}

        def done():
            gaps = 0 if low is None else high - low + 1 - turns
            return out.add(conv, word.decode(), gaps, faults["b"], faults["d"], faults["t"], illegal)
        for b in batches:
            for c, t, lost, sym in zip(*[b[k].to_pylist() for k in ("conv_id", "turn", "lost", "symbol")]):
                if not started or c != conv:
                    if started:
                        yield from done()
                    started, conv, word, low, high, last_turn, last = True, c, bytearray(), None, None, None, None
                    turns = illegal = 0
                    faults = {"b": 0, "d": 0, "t": 0, "-": 0}
                if lost:
                    continue
                role, fault = sym[0], sym[1]
                faults[fault] += 1
                word += (MUST_DELETE if fault in "bd" else role.upper() if fault == "t" else role).encode()
                if last is not None and last + role not in legal:
                    illegal += 1
                last = role
                if t is not None:
                    if low is None:
                        low = t
                    if t != last_turn:
                        turns += 1
                    high = last_turn = t
        if started:
            yield from done()
        yield from out.flush()
    _conf(symbol_rows)
    return symbol_rows.mapInArrow(run, "conv_id long, word string, gaps long, blank long, duplicate long, "
                                       "truncated long, illegal long")


# ------------------------------------------------------------------ the automaton
class Nodes:
    """Cost-to-go of automaton nodes. A node is (base cost, pattern); pattern p holds, for each
    grammar state, the cost above the base, the best next edit and the state after it."""

    def __init__(self):
        self.patterns: list[tuple] = []
        self.known: dict[tuple, int] = {}
        self.steps: dict[tuple[int, str], tuple[int, int]] = {}
        ends = [(0, "", q) if q in ACCEPTING else None for q in range(4)]
        self.end_base, self.end = self._intern(ends)

    def _intern(self, consumed: list) -> tuple[int, int]:
        """consumed: per state the best (cost, letter, next state) without an insertion first."""
        inf = 1 << 60
        cost = [c[0] if c else inf for c in consumed]
        for _ in range(4):
            cost = [min(c, INSERT + cost[WANTED[q]]) for q, c in enumerate(cost)]
        best = []
        for q in range(4):
            options = [(INSERT + cost[WANTED[q]], "I", WANTED[q])]
            if consumed[q]:
                options.append(consumed[q])
            best.append(min(options))
        base = min(cost)
        pattern = tuple((c - base, letter, to) for c, letter, to in best)
        if pattern not in self.known:
            self.known[pattern] = len(self.patterns)
            self.patterns.append(pattern)
        return base, self.known[pattern]

    def before(self, symbol: str, pattern: int) -> tuple[int, int]:
        """(added base cost, pattern) of the node that reads ``symbol`` and goes on at ``pattern``."""
        got = self.steps.get((pattern, symbol))
        if got is None:
            rest = [c[0] for c in self.patterns[pattern]]
            role, extra = symbol.lower(), TRUNCATED if symbol.isupper() else 0
            consumed = []
            for q in range(4):
                options = [(DELETE + rest[q], "D", q)]
                if symbol != MUST_DELETE:
                    options.append((REROLE + extra + rest[WANTED[q]], "R", WANTED[q]))
                    if role in STEP[q]:
                        options.append((KEEP + extra + rest[STEP[q][role]], "K", STEP[q][role]))
                consumed.append(min(options))
            got = self.steps[pattern, symbol] = self._intern(consumed)
        return got


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def solve(sorted_reversed: Iterator[str]) -> Iterator[tuple[str, int, str]]:
    """(word, cost, audit) of words that come reversed and sorted; the stack holds the nodes of
    the last word, from its end."""
    nodes = Nodes()
    stack, bases, last = array("i", [nodes.end]), array("q", [nodes.end_base]), ""
    for r in sorted_reversed:
        shared = _common(last, r)
        del stack[shared + 1:], bases[shared + 1:]
        for symbol in r[shared:]:
            add, pattern = nodes.before(symbol, stack[-1])
            bases.append(bases[-1] + add)
            stack.append(pattern)
        last = r
        audit, state, at = [], 0, len(r)
        while True:
            _, letter, to = nodes.patterns[stack[at]][state]
            if not letter:
                break
            audit.append(letter)
            state = to
            if letter != "I":
                at -= 1
        yield r[::-1], bases[len(r)] + nodes.patterns[stack[len(r)]][0][0], "".join(audit)


def audits(conversations: DataFrame) -> DataFrame:
    """(word, cost, audit) of every distinct word."""
    distinct = conversations.select("word").distinct().select(F.reverse("word").alias("r"))

    def run(batches):
        out = _Out(["word", "cost", "audit"], [pa.string(), pa.int64(), pa.string()])
        for row in solve(r for b in batches for r in b["r"].to_pylist()):
            yield from out.add(*row)
        yield from out.flush()
    _conf(conversations)
    return distinct.repartitionByRange("r").sortWithinPartitions("r").mapInArrow(run, "word string, cost long, audit string")


# ------------------------------------------------------------------ repair
HEAD = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def plan(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation."""
    per = stored(words(symbols(rows)), "conversation-words")
    return per.join(stored(audits(per), "conversation-audits"), "word").select("conv_id", *HEAD)


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) rows, one after the other."""
    state = 0
    for letter in audit:
        if letter == "I":
            state = WANTED[state]
            yield ROLE_OF[state], ""
            continue
        role, text = next(rows)
        if letter == "K":
            state = STEP[state][role[:1]]
            yield role, text
        elif letter == "R":
            state = WANTED[state]
            yield ROLE_OF[state], text


def _apply(rows: DataFrame, plans: DataFrame, emit, schema: str) -> DataFrame:
    """Streams each conversation's plan and then its rows, in order, through ``emit``."""
    texts = rows.where(~F.col("lost")).select("conv_id", F.lit(1).alias("part"), "turn", "role", _digest("text").alias("digest"),
                                              "text", *[F.lit(None).cast("long").alias(c) for c in HEAD[:-1]],
                                              F.lit(None).cast("string").alias("audit"))
    heads = plans.select("conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                         F.lit(b"").alias("digest"), F.lit("").alias("text"), *HEAD)
    order = _in_order()
    both = texts.unionByName(heads).repartition("conv_id").sortWithinPartitions(order[0], "part", *order[1:]) \
        .select("conv_id", "part", "role", "text", *HEAD)

    def run(batches):
        def flat():
            for b in batches:
                yield from zip(*[b[k].to_pylist() for k in ("conv_id", "part", "role", "text", *HEAD)])
        source = flat()
        ahead = next(source, None)
        while ahead is not None:
            head = ahead
            ahead = next(source, None)

            def own():
                nonlocal ahead
                while ahead is not None and ahead[1] == 1:
                    row = ahead
                    ahead = next(source, None)
                    yield row[2], row[3]
            mine = own()
            yield from emit(head[0], dict(zip(HEAD, head[4:])), edited(head[-1], mine))
            for _ in mine:                       # rows that trailing edits did not read: none
                pass
        yield from emit(None, None, None)
    _conf(rows)
    return both.mapInArrow(run, schema)


def repaired_rows(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv_id, position, role, text): the repaired conversations."""
    def maker():
        out = _Out(["conv_id", "position", "role", "text"], [pa.int64(), pa.int64(), pa.string(), pa.string()])

        def emit(conv, head, fixed):
            if head is None:
                yield from out.flush()
                return
            for i, (role, text) in enumerate(fixed):
                yield from out.add(conv, i, role, text)
        return emit
    return _apply(rows, plans, maker(), "conv_id long, position long, role string, text string")


def summary(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The plan's columns and the SHA-256 of the repaired ``role:text`` rows."""
    def maker():
        out = _Out(["conv_id", *HEAD, "repaired_sha256"], [pa.int64()] * 7 + [pa.string(), pa.string()])

        def emit(conv, head, fixed):
            if head is None:
                yield from out.flush()
                return
            h, sep = hashlib.sha256(), ""
            for role, text in fixed:
                h.update(f"{sep}{role}:{text}".encode())
                sep = "\n"
            yield from out.add(conv, *head.values(), h.hexdigest())
        return emit
    return _apply(rows, plans, maker(), RESULT)


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """The contract's columns: the damaged table, examined and repaired."""
    rows = damage(rows_of(conversations))
    return summary(rows, plan(rows))
