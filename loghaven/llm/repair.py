"""Repair of conversations by a grammar-compressed dynamic program.

A message is one symbol, its role's initial and its fault. Conversations are cut, in order and over
all partitions, into segments of symbols; the distinct segments of all conversations are compressed
by Re-Pair, whose rules replace the pairs of symbols that are most frequent everywhere. What a run of
messages can do to the order of roles is a min-plus matrix between the states of that order, each
entry with the audit of its cheapest edits. Matrices of rules are products of those of their two
sides, so each is evaluated once, bottom up, for all conversations; audits are ropes that share their
sides. A segment is a short product of rules, and a conversation a product of its segments.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loghaven.lake import stored

BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
INITIALS = "sua"
OTHER = len(INITIALS)
FINE, TRUNCATED, DUPLICATE, BLANK = range(4)
#: Initials that may follow one another.
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
#: Symbols of a segment, rules added in a round, rounds, least count of a pair that gets a rule.
SEGMENT, ROUND_RULES, ROUNDS, LEAST_PAIRS = 1024, 64, 6, 2

#: The order (s?(ua)+)? as states: nothing yet, after s, after u, after a; by state and initial.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES = 4
STEPS = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
ACCEPTED = (START, AFTER_A)

SYMBOLS = [chr(65 + 4 * fault + role) for fault in range(4) for role in range(4)]


class Rope:
    """A text as the concatenation of two, with its length and a hash by which equal parts are skipped."""

    __slots__ = ("size", "hash", "power", "text", "left", "right")
    MOD, BASE = (1 << 61) - 1, 1_000_003

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if left is None:
            self.size, self.hash = len(text), 0
            for c in text.encode():
                self.hash = (self.hash * self.BASE + c) % self.MOD
            self.power = pow(self.BASE, self.size, self.MOD)
        else:
            self.size = left.size + right.size
            self.hash = (left.hash * right.power + right.hash) % self.MOD
            self.power = left.power * right.power % self.MOD

    def __add__(self, other: Rope) -> Rope:
        if not other.size or not self.size:
            return self if self.size else other
        if self.size + other.size <= 16:
            return Rope(str(self) + str(other))
        return Rope("", self, other)

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if x.left is None:
                out.append(x.text)
            else:
                todo += [x.right, x.left]
        return "".join(out)

    def __lt__(self, other: Rope) -> bool:
        """By text; equal parts that stand at the same place are passed over whole."""
        a, b = [self], [other]
        while a and b:
            x, y = a.pop(), b.pop()
            if x.size == y.size and x.hash == y.hash:
                continue
            if x.left is not None and x.size >= y.size or x.left is not None and y.left is None:
                a += [x.right, x.left]
                b.append(y)
            elif y.left is not None:
                b += [y.right, y.left]
                a.append(x)
            else:
                n = min(len(x.text), len(y.text))
                if x.text[:n] != y.text[:n]:
                    return x.text[:n] < y.text[:n]
                if len(x.text) > n:
                    a.append(Rope(x.text[n:]))
                if len(y.text) > n:
                    b.append(Rope(y.text[n:]))
        return not a and bool(b)


Entry = tuple[int, Rope]
#: By state before and after: cost and audit of the cheapest edits, the least audit among these.
Matrix = list[list[Entry | None]]
NOTHING = Rope()


def better(a: Entry | None, b: Entry | None) -> Entry | None:
    if a is None or b is None:
        return a or b
    return b if b[0] < a[0] or b[0] == a[0] and b[1] < a[1] else a


def product(a: Matrix, b: Matrix) -> Matrix:
    """Two edits of equal cost over the same messages are never one a prefix of the other, as the
    longer would hold one more insertion. So the least audits of both sides make the least whole."""
    out: Matrix = []
    for row in a:
        ways: list[Entry | None] = [None] * STATES
        for mid, x in enumerate(row):
            if x is not None:
                for to, y in enumerate(b[mid]):
                    if y is not None and (ways[to] is None or x[0] + y[0] <= ways[to][0]):
                        ways[to] = better(ways[to], (x[0] + y[0], x[1] + y[1]))
        out.append(ways)
    return out


def _matrix(entries: list[tuple[int, int, int, str]]) -> Matrix:
    out: Matrix = [[None] * STATES for _ in range(STATES)]
    for before, after, cost, audit in entries:
        out[before][after] = better(out[before][after], (cost, Rope(audit)))
    return out


_STAY = [(q, q, 0, "") for q in range(STATES)]
_ONE = _matrix(_STAY + [(q, to, INSERT_COST, INSERT) for (q, c), to in STEPS.items() if c in "ua"])
#: Any number of insertions: after two, a third only leads back.
INSERTIONS = product(_ONE, _ONE)


def symbol_matrix(symbol: str) -> Matrix:
    """Insertions before a message, then the message kept, given another role or deleted."""
    fault, role = divmod(SYMBOLS.index(symbol), 4)
    edits = [(q, q, DELETE_COST, DELETE) for q in range(STATES)]
    if fault in (FINE, TRUNCATED):
        more = TRUNCATED_COST if fault == TRUNCATED else 0
        for (q, initial), to in STEPS.items():
            if initial == (INITIALS + "?")[role]:
                edits.append((q, to, more, KEEP))
            if initial in "ua":
                edits.append((q, to, REROLE_COST + more, REROLE))
    return product(INSERTIONS, _matrix(edits))


def final(row: list[Entry | None]) -> Entry:
    """The cheapest way to an accepted order from the states reached, with insertions at the end."""
    last = product([row], INSERTIONS)[0]
    return reduce(better, [last[q] for q in ACCEPTED])


def compressed(symbols: str, rules: list[str]) -> str:
    """A segment with the pairs of all rules replaced, in the order in which they were made."""
    for i, pair in enumerate(rules):
        symbols = symbols.replace(pair, chr(0x100 + i))
    return symbols


def matrices_of(rules: list[str]) -> dict[str, Matrix]:
    """The matrix of every symbol and rule, bottom up."""
    out = {s: symbol_matrix(s) for s in SYMBOLS}
    for i, pair in enumerate(rules):
        out[chr(0x100 + i)] = product(out[pair[0]], out[pair[1]])
    return out


def grammar(shapes: DataFrame) -> list[str]:
    """Re-Pair rules over all distinct segments, as pairs of symbols or earlier rules.

    In each round tasks count the pairs of their segments, and the most frequent ones get rules; one
    that an earlier pair of the round broke up is counted again in the next round. The driver holds
    ROUNDS * ROUND_RULES rules at most.
    """
    rules: list[str] = []
    for _ in range(ROUNDS):

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: Counter[str] = Counter()
            for batch in batches:
                for symbols in batch.column(0).to_pylist():
                    short = compressed(symbols, rules)
                    found.update(a + b for a, b in zip(short, short[1:], strict=False))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["pair", "n"])

        counts = shapes.select("symbols").mapInArrow(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        top = counts.where(F.col("n") >= LEAST_PAIRS).orderBy(F.col("n").desc(), "pair").limit(ROUND_RULES).collect()
        if not top:
            break
        rules = rules + [r["pair"] for r in top]
    return rules


def evaluated(shapes: DataFrame, rules: list[str]) -> DataFrame:
    """symbols and what they come to: faults, breaks of the order, first and last role, the whole
    repair (cost, audit) of a conversation that is just this segment, and the matrix (costs, audits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices = matrices_of(rules)
        for batch in batches:
            out = []
            for symbols in batch.column(0).to_pylist():
                m = reduce(product, [matrices[x] for x in compressed(symbols, rules)])
                cost, audit = final(m[START])
                entries = [x for row in m for x in row]
                faults = Counter((ord(x) - 65) // 4 for x in symbols)
                roles = [(INITIALS + "?")[(ord(x) - 65) % 4] for x in symbols]
                out.append(
                    {
                        "symbols": symbols,
                        "blank": faults[BLANK],
                        "duplicate": faults[DUPLICATE],
                        "truncated": faults[TRUNCATED],
                        "illegal": sum(x not in LEGAL for x in zip(roles, roles[1:], strict=False)),
                        "first": roles[0],
                        "last": roles[-1],
                        "cost": cost,
                        "audit": str(audit),
                        "costs": [None if x is None else x[0] for x in entries],
                        "audits": [None if x is None else str(x[1]) for x in entries],
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema)

    longs, strings = ("blank", "duplicate", "truncated", "illegal", "cost"), ("symbols", "first", "last", "audit")
    order = ("symbols", "blank", "duplicate", "truncated", "illegal", "first", "last", "cost", "audit")
    schema = pa.schema([(c, pa.int64() if c in longs else pa.string()) for c in order] + [("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
    ddl = ", ".join(f"{c} {'string' if c in strings else 'long'}" for c in order)
    return shapes.select("symbols").mapInArrow(run, ddl + ", costs array<long>, audits array<string>")


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: the rows after a fault for 5 in 20 of them, by crc32 of
    ``conv_id:turn``: dropped, emptied, without its ends of sentences, repeated, or of the user. Nulls
    in the key, in role and in text stand as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"))
    kind = F.pmod(F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))), F.lit(20))
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(kind == 3, F.lit(2)).otherwise(F.lit(1)).cast("long")
    return rows.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))


def _last(text: Column) -> Column:
    return F.right(F.rtrim(text, F.lit(BLANKS)), F.lit(1))


def _ordered(rows: DataFrame, *more: str) -> DataFrame:
    """Rows with the columns that order a conversation: turn (null first), role, and a digest of the
    text for those that are equal in both."""
    return rows.select("conv_id", F.col("turn").isNotNull().alias("dated"), "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), "copies", *more)


ORDER = ("dated", "turn", "role", "digest")


def symbol_rows(rows: DataFrame) -> DataFrame:
    """One row per conversation and distinct message, without its text: its symbol, that of its
    further copies, and their number. Copies are added up before they are shuffled."""
    last = _last(F.col("text"))
    state = F.when(last == "", BLANK).when(last.isin(*".!?"), FINE).otherwise(TRUNCATED)
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    each = _ordered(rows, "text").withColumns({"state": state.cast("int"), "class": role.cast("int")})
    each = stored(each.groupBy("conv_id", *ORDER, "state", "class").agg(F.sum("copies").alias("copies")), "repair-rows")
    first = each.groupBy(F.col("conv_id").alias("of"), F.col("digest").alias("same"), F.col("role").alias("by")).agg(
        F.min(F.struct("dated", "turn")).alias("first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("same")) & (F.col("role") == F.col("by"))
    both = each.join(first, same)
    later = ~F.struct("dated", "turn").eqNullSafe(F.col("first"))
    of = lambda state: F.char(65 + 4 * state + F.col("class"))
    own = F.when((F.col("state") != BLANK) & later, DUPLICATE).otherwise(F.col("state"))
    more = F.when(F.col("state") == BLANK, BLANK).otherwise(DUPLICATE)
    return both.select("conv_id", *ORDER, of(own).alias("symbol"), of(more).alias("copy"), "copies")


def segments(symbols: DataFrame) -> DataFrame:
    """conv_id, part, number, symbols, whole: runs of a conversation's symbols in order.

    Rows are sorted by range over all partitions, so a long conversation goes over several of them.
    ``whole`` marks a segment that is known to be all of its conversation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, conv, held, cut, leading = TaskContext.get().partitionId(), 0, None, "", False, True
        out: list[tuple] = []

        def emit(symbols: str, ends: bool) -> None:
            nonlocal number, cut
            out.append((conv, part, number, symbols, ends and not cut and not leading))
            number += 1
            cut = True

        for batch in batches:
            out.clear()
            for at, symbol, copy, n in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "symbol", "copy", "copies")], strict=True):
                if held and at != conv:
                    emit(held, True)
                    held, cut, leading = "", False, False
                elif at != conv:
                    cut, leading = False, leading and conv is None and not number
                conv = at
                held += symbol
                n -= 1
                while n or len(held) >= SEGMENT:
                    more = min(n, SEGMENT - len(held))
                    held += copy * more
                    n -= more
                    if len(held) == SEGMENT:
                        emit(held, False)
                        held = ""
            yield table(out, batch.schema)
        if held:
            out.clear()
            emit(held, False)  # the next partition may go on
            yield table(out, batch.schema)

    def table(out: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        kinds = (schema.field("conv_id").type, pa.int32(), pa.int64(), pa.string(), pa.bool_())
        columns = [pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "part", "number", "symbols", "whole"])

    ordered = symbols.repartitionByRange("conv_id", *ORDER).sortWithinPartitions("conv_id", *ORDER)
    kind = symbols.schema["conv_id"].dataType.simpleString()
    return ordered.mapInArrow(run, f"conv_id {kind}, part int, number long, symbols string, whole boolean")


class Conversation:
    """One conversation as its rows stream by: segments first, then its messages in order."""

    COUNTS = ("blank", "duplicate", "truncated", "illegal")

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.counts = dict.fromkeys(self.COUNTS, 0)
        self.row: list[Entry | None] = [(0, NOTHING), None, None, None]
        self.result: tuple[int, str] | None = (0, "")
        self.last, self.at, self.n_out, self.odd = None, 0, 0, False
        self.low = self.high = self.turn = None
        self.n_turns = 0
        self.sha = hashlib.sha256()

    def segment(self, r: dict) -> None:
        for c in self.COUNTS:
            self.counts[c] += r[c]
        if self.last is not None and (self.last, r["first"]) not in LEGAL:
            self.counts["illegal"] += 1
        self.last = r["last"]
        if r["audits"] is None:
            self.result = r["cost"], r["audit"]
            return
        self.result = None
        entries = [None if a is None else (c, Rope(a)) for c, a in zip(r["costs"], r["audits"], strict=True)]
        matrix = [entries[i : i + STATES] for i in range(0, len(entries), STATES)]
        self.row = product([self.row], matrix)[0]

    def audit(self) -> str:
        if self.result is None:
            cost, rope = final(self.row)
            self.result = cost, str(rope)
        return self.result[1]

    def _message(self, role: str | None, text: str) -> dict:
        """The next message of the repair; without a role, that of its place."""
        if self.n_out == 0:
            self.odd = (len(self.audit()) - self.audit().count(DELETE)) % 2 == 1
        role = role if role is not None else ("user", "assistant")[(self.n_out + self.odd) % 2]
        self.sha.update(f"{'' if self.n_out == 0 else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.n_out += 1
        return {"conv_id": self.conv_id, "position": self.n_out - 1, "role": role, "text": text}

    def message(self, r: dict) -> Iterator[dict]:
        if r["turn"] is not None:
            self.low = r["turn"] if self.low is None else self.low
            self.n_turns += r["turn"] != self.high
            self.high = r["turn"]
        audit = self.audit()
        for _ in range(r["copies"]):
            yield from self.insertions()
            edit = audit[self.at]
            self.at += 1
            if edit != DELETE:
                yield self._message(r["role"] if edit == KEEP else None, r["text"])

    def insertions(self) -> Iterator[dict]:
        audit = self.audit()
        while self.at < len(audit) and audit[self.at] == INSERT:
            self.at += 1
            yield self._message(None, "")

    def summary(self) -> dict:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.n_turns, (1 << 63) - 1)
        audit = self.audit()
        return {"conv_id": self.conv_id, "gaps": gaps, **self.counts, "cost": self.result[0], "audit": audit, "repaired_sha256": self.sha.hexdigest()}


SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _repaired(rows: DataFrame, conv_ids: DataFrame, summaries: bool) -> DataFrame:
    cut = stored(segments(symbol_rows(rows)), "repair-segments")
    shapes = stored(cut.select("symbols").distinct(), "repair-shapes")
    known = stored(evaluated(shapes, grammar(shapes)), "repair-matrices")
    inner = F.col("whole")
    parts = cut.join(known, "symbols").withColumns(
        {c: F.when(~inner, F.col(c)) for c in ("costs", "audits")} | {"audit": F.when(inner, F.col("audit"))}
    )
    more = {"dated": "boolean", "turn": "long", "role": "string", "digest": "binary", "copies": "long", "text": "string"}
    of_parts = parts.drop("symbols", "whole").withColumn("kind", F.lit(1))
    of_rows = _ordered(rows, "text").withColumn("kind", F.lit(2))
    of_ids = conv_ids.select("conv_id").distinct().withColumn("kind", F.lit(0))
    both = of_ids.unionByName(of_parts, allowMissingColumns=True).unionByName(of_rows, allowMissingColumns=True)
    keys = ["conv_id", "kind", "part", "number", *ORDER]
    columns = keys + [c for c in both.columns if c not in keys and c not in more] + ["copies", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Conversation | None = None
        schema = None
        for batch in batches:
            if schema is None:
                conv = batch.schema.field("conv_id").type
                if summaries:
                    kinds = [pa.string() if x.endswith("string") else pa.int64() for x in SUMMARY.split(", ")]
                    schema = pa.schema([("conv_id", conv), *zip([x.split()[0] for x in SUMMARY.split(", ")], kinds, strict=True)])
                else:
                    schema = pa.schema([("conv_id", conv), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])
            done: list[dict] = []
            for r in batch.to_pylist():
                if r["kind"] == 0:
                    done += _close(now, summaries)
                    now = Conversation(r["conv_id"])
                elif r["kind"] == 1:
                    now.segment(r)
                else:
                    messages = now.message(r)
                    if summaries:
                        for _ in messages:
                            pass
                    else:
                        done += messages
            yield pa.RecordBatch.from_pylist(done, schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist(_close(now, summaries), schema)

    kind = rows.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, " + (SUMMARY if summaries else "position long, role string, text string")
    return both.select(*columns).repartition("conv_id").sortWithinPartitions(*keys).mapInArrow(run, ddl)


def _close(now: Conversation | None, summaries: bool) -> list[dict]:
    if now is None:
        return []
    rest = list(now.insertions())
    return [now.summary()] if summaries else rest


def repair_summaries(rows: DataFrame, conv_ids: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 per conversation.

    ``rows`` has conv_id, turn (long), role, text and copies (equal rows that stand together); ``conv_ids``
    every conversation to report, also those without rows. A conversation is ordered by turn (null
    first), role and a digest of the text; rows equal in all are adjacent, and all but the first are
    duplicates. Edits: keep 0; other role (user or assistant) 3; delete 4, the only edit of blank and
    duplicate messages; insert an empty one 3; truncated messages that stay add 3. The audit has one
    initial per edit and leads to roles ``(s?(ua)+)?``, the cheapest and then the ASCII-least. A null
    conv_id is a conversation of its own; without rows all counts are 0, audit and repair are empty.

    All but the digest of the repaired text is computed in pieces spread over all tasks. SHA-256 takes
    its input in order, so the messages of one conversation stream through one task, sorted by Spark.
    """
    return _repaired(rows, conv_ids, True)


def repaired_messages(rows: DataFrame) -> DataFrame:
    """conv_id, position, role, text: the repaired conversations, as ``repair_summaries`` digests them."""
    return _repaired(rows, rows, False)
