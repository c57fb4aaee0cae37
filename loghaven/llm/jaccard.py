"""N-gram Jaccard join with a token-group matrix.

Equal sets are one node. Every set is cut into parts by hash, one more than the number of
shingles in which similar sets of its size class can differ, so similar sets have an equal
part. Sets with an equal part fall into groups around the least of them. A set is a query for
its own group and the groups of the sets that it shares a part with. A group's token union
bounds the overlap with any member; only where that bound reaches the threshold is the group
opened and the members counted exactly. Large groups are cut into chunks, and pairs of chunks are the
unit of work. A unit emits a forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, exp, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loghaven.lake import stored
from loghaven.llm.common import same_or_null
from loghaven.llm.components import Union, connected
from loghaven.llm.shingles import Hasher, mixed, shingles
from loghaven.operators.intel import fits_broadcast

WORDS = 5
SIMILARITY = (80, 100)
#: Size classes grow by this ratio; a set belongs to its own class and, near the upper border,
#: to the next.
RATIO = 1.25
#: Shingles of a chunk, on average.
CHUNK_TOKENS = 1 << 17
#: Hits of queries and members counted at once in a unit.
HITS = 1 << 21
#: Marks or tokens of a batch that a task hands on.
ROWS = 1 << 17
_LOW48 = np.uint64((1 << 48) - 1)


class Classes:
    """Size classes of sets and the number of parts for each, for J >= share / whole."""

    def __init__(self, share: int, whole: int):
        self.share, self.whole = share, whole
        self.borders = [1]
        self.known: dict[int, tuple[int, int]] = {}

    def parts(self, k: int) -> tuple[int, int]:
        """(differences, parts): sets of class k that link differ in so many shingles at most.

        Parts exceed them by 1 and by what is empty in most of the smallest sets, since two
        empty parts show nothing.
        """
        if k in self.known:
            return self.known[k]
        most = 2 * (self.borders[k + 1] - 1) * (self.whole - self.share) // (self.whole + self.share)
        least = max(1, ceil(self.borders[k] * self.share / self.whole))
        n = most + 1
        while n - most - 1 < (empty := n * exp(-least / n)) + 2 * sqrt(empty) and n < 2 * most + 4:
            n += 1
        self.known[k] = most, n
        return most, n

    def of(self, size: int) -> list[int]:
        """Classes in which a set of that size meets all that it can link with."""
        while self.borders[-1] <= size * self.whole // self.share + 1:
            self.borders.append(max(self.borders[-1] + 1, ceil(self.borders[-1] * RATIO)))
        lo = int(np.searchsorted(self.borders, size, "right")) - 1
        out = []
        for k in range(lo, len(self.borders) - 1):
            if k > lo and self.borders[k] * self.share > size * self.whole:
                break
            out.append(k)
        return out


def part_marks(tokens: np.ndarray, classes: Classes) -> tuple[np.ndarray, int]:
    """64-bit marks of a set, and how many of them any other set that it links with has too.

    Of the parts of a class, all but ``most`` are equal in both sets; those that are empty here
    have no mark.
    """
    out, need = [], []
    spread = mixed(tokens + np.uint64(1))
    for k in classes.of(len(tokens)):
        most, n = classes.parts(k)
        if not most:
            continue  # only equal sets link
        part = (spread >> np.uint64(20)) % np.uint64(n)
        order = np.argsort(part, kind="stable")
        part = part[order]
        first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        sums = np.add.reduceat(spread[order], first)
        out.append(mixed(sums * np.uint64(2 * k + 3) + part[first] + np.uint64(k << 40)))
        need.append(len(first) - most)
        if len(first) <= most:
            # All equal parts of two such sets may be empty ones. Then any so many of their
            # shingles, taken in one order, have one in common.
            prefix = len(spread) - -(-classes.share * len(spread) // classes.whole) + 1
            out.append(mixed(np.partition(spread, prefix - 1)[:prefix] + np.uint64((k << 40) + (1 << 39))))
    return np.concatenate([*out, np.zeros(0, np.uint64)]), max(1, min(need, default=1))


def _packed(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").view(np.uint16).reshape(-1, 4)[:, :3].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    cells = np.zeros((len(data) // 6, 4), np.uint16)
    cells[:, :3] = np.frombuffer(data, np.uint16).reshape(-1, 3)
    return cells.view("<u8").ravel()


def set_node(tokens: np.ndarray) -> int:
    """The name of a set, equal for equal sets."""
    return int(mixed(np.add.reduce(mixed(tokens), keepdims=True) + np.uint64(len(tokens))).view(np.int64)[0])


def set_nodes(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, node (null for an empty set) of every row, and __mark where docs have it."""
    marked = "__mark" in docs.columns

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            sets = [shingles(hasher.words(text.as_py()), words) for text in batch.column(1)]
            sizes = pa.array([len(s) for s in sets], pa.int64())
            names = pa.array([set_node(s) if len(s) else None for s in sets], pa.int64())
            columns, names_of = [batch.column(0), sizes, names], ["doc_id", "n_shingles", "node"]
            if marked:
                columns, names_of = [*columns, batch.column(2)], [*names_of, "__mark"]
            yield pa.RecordBatch.from_arrays(columns, names_of)

    kind = docs.schema["doc_id"].dataType.simpleString()
    more = ["__mark"] if marked else []
    return docs.select("doc_id", F.col("text").cast("string"), *more).mapInArrow(
        nodes, f"doc_id {kind}, n_shingles long, node long" + ", __mark long" * marked
    )


def _distinct_sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[int, np.ndarray]]:
    """Node and tokens (the low 48 bits of the shingles) of a task's sets, equal ones once."""
    hasher, seen = Hasher(), set()
    for batch in batches:
        for text in batch.column(0):
            found = shingles(hasher.words(text.as_py()), words)
            if len(found) and (node := set_node(found)) not in seen:
                seen.add(node)
                yield node, np.unique(found & _LOW48)


def set_marks(docs: DataFrame, words: int, share: int, whole: int) -> DataFrame:
    """mark, node, need for every mark of every set."""

    def all_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, names, found, needs, held = Classes(share, whole), [], [], [], 0

        def rows() -> pa.RecordBatch:
            sizes = [len(f) for f in found]
            node, need = np.repeat(np.array(names, np.int64), sizes), np.repeat(np.array(needs, np.int32), sizes)
            mark = np.concatenate([*found, np.zeros(0, np.uint64)]).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(mark), pa.array(node), pa.array(need)], ["mark", "node", "need"])

        for node, tokens in _distinct_sets(batches, words):
            marks, need = part_marks(tokens, classes)
            names.append(node)
            found.append(marks)
            needs.append(need)
            held += len(marks)
            if held >= ROWS:
                yield rows()
                names, found, needs, held = [], [], [], 0
        yield rows()

    return docs.select(F.col("text").cast("string")).mapInArrow(all_marks, "mark long, node long, need int")


def set_tokens(docs: DataFrame, words: int) -> DataFrame:
    """node, tokens of the sets of some documents."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, sets, held = [], [], 0

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sets, pa.binary())], ["node", "tokens"])

        for node, found in _distinct_sets(batches, words):
            names.append(node)
            sets.append(_packed(found))
            held += len(found)
            if held >= ROWS:
                yield rows()
                names, sets, held = [], [], 0
        yield rows()

    return docs.select(F.col("text").cast("string")).mapInArrow(tokens, "node long, tokens binary")


def unit_links(units: pd.DataFrame, share: int, whole: int) -> pd.DataFrame:
    """Links between the queries and the members of one unit, as a forest.

    ``units`` has node, tokens, query (bool). The union of the members' tokens bounds every
    overlap; queries beyond the bound are dropped before members are counted.
    """
    out = []
    member = units[~units["query"]].drop_duplicates("node")
    query = units[units["query"]].drop_duplicates("node")
    sets = [_unpacked(t) for t in member["tokens"]]
    asks = [_unpacked(t) for t in query["tokens"]]
    if sets and asks:
        sizes = np.array([len(s) for s in sets])
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        names, asked = member["node"].tolist(), query["node"].tolist()
        number = {x: i for i, x in enumerate(dict.fromkeys(names + asked))}
        union = Union(len(number))

        def opened(batch: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
            counts = np.concatenate([c for _, _, c in batch])
            first = np.concatenate([f for _, f, _ in batch])
            row = np.repeat(np.arange(len(batch)), [len(c) for _, _, c in batch])
            hits = np.repeat(first - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
            common = np.bincount(np.repeat(row, counts) * len(sets) + owner[hits], minlength=len(batch) * len(sets))
            common = common.reshape(len(batch), len(sets))
            n = np.array([len(asks[q]) for q, _, _ in batch])[:, None]
            for r, m in zip(*np.nonzero(whole * common >= share * (n + sizes[None, :] - common)), strict=True):
                a, b = asked[batch[r][0]], names[m]
                if a != b and union.join(number[a], number[b]):
                    out.append((a, b))

        batch, held = [], 0
        for q, tokens in enumerate(asks):
            first, last = np.searchsorted(flat, tokens, "left"), np.searchsorted(flat, tokens, "right")
            counts = last - first
            if whole * np.count_nonzero(counts) < share * len(tokens):
                continue  # |query and union| < threshold * |query|
            batch.append((q, first, counts))
            held += int(counts.sum()) + len(sets)
            if held > HITS:
                opened(batch)
                batch, held = [], 0
        if batch:
            opened(batch)
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def set_links(docs: DataFrame, nodes: DataFrame, words: int, share: int, whole: int) -> DataFrame:
    """a, b: a forest of the links between different sets; ``nodes`` as from set_nodes.

    Marks go from the texts straight into their exchange, and tokens are made again for the sets
    that share a mark, so neither is stored for all documents.
    """
    by_mark = Window.partitionBy("mark")
    least, most = F.min("node").over(by_mark), F.max("node").over(by_mark)

    def met_again(marks: DataFrame) -> DataFrame:
        return marks.select("mark", "node", "need", least.alias("least"), most.alias("most")).where("least < most").drop("most")

    met = stored(met_again(set_marks(docs, words, share, whole)).distinct(), "marks")
    # A set that links shares enough marks with one other set, so with all others together.
    enough = met.groupBy("node").agg(F.count("*").alias("common"), F.max("need").alias("need")).where("common >= need")
    shared = stored(met_again(met.drop("least").join(enough.select("node"), "node", "left_semi")), "marks")
    # The group of a set: the least set that it meets, and once more the least which that meets.
    near = shared.groupBy("node").agg(F.min("least").alias("least"))
    further = near.select(F.col("node").alias("least"), F.col("least").alias("further"))
    homes = stored(near.join(further, "least", "left").select("node", F.coalesce("further", "least").alias("home")), "homes")
    ids = stored(nodes.join(homes, "node").groupBy("node").agg(F.min("doc_id").alias("__id")).select("__id").distinct(), "ids")
    ids = F.broadcast(ids) if fits_broadcast(ids) else ids
    chosen = docs.select("doc_id", "text").join(ids, same_or_null(F.col("doc_id"), F.col("__id")), "left_semi")
    wanted = stored(
        set_tokens(chosen, words).join(homes, "node").groupBy("node", "home").agg(F.first("tokens").alias("tokens")), "sets"
    )
    room = wanted.groupBy("home").agg(
        F.ceil(F.sum(F.octet_length("tokens") / 6) / CHUNK_TOKENS).cast("int").alias("chunks"), F.count("*").alias("sets")
    )
    members = stored(
        wanted.select("node", "home").join(room, "home").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")),
        "members",
    )
    # Queries and groups that share marks enough; each pair of groups is asked from the lesser one.
    marked = shared.select("mark", "node", "need").join(members.select("node", "home"), "node")
    targets = marked.select("mark", F.col("home").alias("target")).distinct()
    pairs = (
        marked.join(targets, "mark")
        .where("home <= target")
        .groupBy("node", "target")
        .agg(F.count("*").alias("common"), F.max("need").alias("need"))
        .where("common >= need")
        .select("node", "target")
    )
    asked = (
        pairs.join(members.select("node", "home", "chunk", "sets"), "node")
        .where("home < target or sets > 1")
        .join(room.select(F.col("home").alias("target"), F.col("chunks").alias("target_chunks")), "target")
        .withColumn("target_chunk", F.explode(F.sequence(F.lit(0), F.col("target_chunks") - 1)))
        .where("home < target or chunk <= target_chunk")
    )
    unit = ["home", "chunk", "target", "target_chunk"]
    asked = stored(asked.select("node", *unit), "asked")
    opened = asked.select(*unit).distinct()
    answers = opened.join(
        members.select("node", F.col("home").alias("target"), F.col("chunk").alias("target_chunk")), ["target", "target_chunk"]
    )
    rows = (
        asked.withColumn("query", F.lit(True))
        .unionByName(answers.select("node", *unit).withColumn("query", F.lit(False)))
        .join(wanted.select("node", "tokens"), "node")
    )
    return rows.groupBy(*unit).applyInPandas(lambda u: unit_links(u, share, whole), "a long, b long")


def jaccard_classes(
    docs: DataFrame, words: int = WORDS, similarity: tuple[int, int] = SIMILARITY
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; needs doc_id and text.

    Two documents link when their sets of distinct ``words``-word shingles have a Jaccard
    similarity of similarity[0] / similarity[1] or more. Texts of fewer words are one shingle.
    Null texts and texts without words have an empty set, link with nothing and are their own
    component. component_id is the smallest doc_id reachable by links; a null id is never
    the smallest unless there is no other. Repeated rows link as equal texts do. Other columns
    are not read, and an empty table gives no rows.
    """
    share, whole = similarity
    nodes = stored(set_nodes(docs, words), "nodes")
    roots = connected(set_links(docs, nodes, words, share, whole))
    rows = nodes.join(roots, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "node").alias("root")
    )
    # Stored, so that the join has an exchange of its own, which can split a large component.
    least = stored(rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    return rows.join(least, "root", "left").select(
        "doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def without_near_copies(
    docs: DataFrame, words: int = WORDS, similarity: tuple[int, int] = SIMILARITY, one_row: bool = False
) -> DataFrame:
    """One document of each component, that of the smallest id (null is the largest) and then of
    the smallest text hash; all columns stay. Rows go by id and text, so rows of the same id, or
    without one, that are not similar do not go with each other. Rows that repeat a document, id
    (or none) and text, stay or go together; with ``one_row`` one of them stays."""
    share, whole = similarity
    mark = F.xxhash64(F.col("text").cast("string"))
    nodes = stored(set_nodes(docs.select("doc_id", "text", mark.alias("__mark")), words).where("node is not null"), "nodes")
    roots = connected(set_links(docs, nodes.drop("__mark"), words, share, whole))
    rows = nodes.join(roots, "node", "left").select("doc_id", "__mark", F.coalesce("root", "node").alias("root"))
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("__mark").alias("mark"))
    least = stored(rows.groupBy("root").agg(F.min(key).alias("stays")), "least")
    stays = same_or_null(F.col("doc_id"), F.col("stays.doc_id")) & (F.col("__mark") == F.col("stays.mark"))
    gone = rows.join(least, "root").where(~stays).select(F.col("doc_id").alias("__gone"), F.col("__mark").alias("__gone_mark")).distinct()
    same_text = F.xxhash64(docs["text"].cast("string")) == F.col("__gone_mark")
    kept = docs.join(gone, same_or_null(docs["doc_id"], F.col("__gone")) & same_text, "left_anti")
    if not one_row:
        return kept
    repeated = nodes.groupBy("doc_id", "__mark").count().where("count > 1")
    repeated = stored(repeated.select(F.col("doc_id").alias("__id"), F.col("__mark").alias("__copy")), "repeated")
    if repeated.isEmpty():
        return kept
    rows = kept.withColumn("__mark", mark)
    same = same_or_null(F.col("doc_id"), F.col("__id")) & (F.col("__mark") == F.col("__copy"))
    once = rows.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "__mark"])
    return rows.join(repeated, same, "left_anti").unionByName(once).drop("__mark")
