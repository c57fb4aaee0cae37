"""Near-duplicate vectors by navigable small-world graphs, one per shard.

Equal vectors of a label are one node. The nodes of a label are cut into shards; each shard's
graph is built by a task and written. Every shard is asked by its own nodes and by those of
all later shards of the label. The beam is widened until audits against brute force pass.
Cosines are verified in double precision, and links are joined into components.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loghaven.lake import stored
from loghaven.llm.common import same_or_null
from loghaven.llm.components import Union, connected

COSINE = 0.98
#: How far below the threshold a walk among near nodes still goes on.
MARGIN = 0.03
NEIGHBOURS = 12
BUILD_BEAM = 48
BEAM = 24
#: Nodes of a shard, on average.
SHARD_NODES = 8192
AUDITS = 64
RECALL = 0.995


class Graph:
    """A hierarchical navigable small-world graph over unit vectors."""

    def __init__(self, vectors: np.ndarray, seed: int = 5):
        self.vectors = vectors
        n = len(vectors)
        rng = np.random.default_rng(seed)
        self.level = np.minimum((-np.log(1 - rng.random(n)) / np.log(NEIGHBOURS)).astype(int), 8)
        self.links: list[list[list[int]]] = [[[] for _ in range(top + 1)] for top in self.level]
        self.entry = 0
        for i in range(1, n):
            self._insert(i)

    def _beam(self, q: np.ndarray, entries: list[int], beam: int, layer: int) -> list[tuple[float, int]]:
        """The nearest nodes found on a layer, the nearest first."""
        vectors, links = self.vectors, self.links
        seen = set(entries)
        near = [(float(s), e) for s, e in zip(vectors[entries] @ q, entries, strict=True)]
        ahead = [(-s, e) for s, e in near]
        heapq.heapify(ahead)
        heapq.heapify(near)
        while ahead:
            s, at = heapq.heappop(ahead)
            if len(near) >= beam and -s < near[0][0]:
                break
            new = [x for x in links[at][layer] if x not in seen]
            if not new:
                continue
            seen.update(new)
            for s, x in zip((vectors[new] @ q).tolist(), new, strict=True):
                if len(near) < beam:
                    heapq.heappush(near, (s, x))
                elif s > near[0][0]:
                    heapq.heapreplace(near, (s, x))
                else:
                    continue
                heapq.heappush(ahead, (-s, x))
        return sorted(near, reverse=True)

    def _diverse(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours that are nearer to the node than to each other, then the nearest others."""
        ids = [x for _, x in found]
        own = self.vectors[ids] @ self.vectors[ids].T
        kept: list[int] = []
        for r, (s, _) in enumerate(found):
            if len(kept) < most and (not kept or own[r, kept].max() < s):
                kept.append(r)
        rest = [r for r in range(len(ids)) if r not in set(kept)]
        return [ids[r] for r in kept + rest[: most - len(kept)]]

    def _descend(self, q: np.ndarray, to: int) -> list[int]:
        at = [self.entry]
        for layer in range(self.level[self.entry], to, -1):
            at = [self._beam(q, at, 1, layer)[0][1]]
        return at

    def _insert(self, i: int) -> None:
        q, top = self.vectors[i], int(self.level[i])
        at = self._descend(q, top)
        for layer in range(min(top, int(self.level[self.entry])), -1, -1):
            found = self._beam(q, at, BUILD_BEAM, layer)
            at = [x for _, x in found]
            most = NEIGHBOURS * (2 if layer == 0 else 1)
            self.links[i][layer] = self._diverse(found, NEIGHBOURS)
            for x in self.links[i][layer]:
                own = self.links[x][layer]
                own.append(i)
                if len(own) > most + NEIGHBOURS:  # pruned in batches
                    sims = (self.vectors[own] @ self.vectors[x]).tolist()
                    self.links[x][layer] = self._diverse(sorted(zip(sims, own, strict=True), reverse=True), most)
        if top > self.level[self.entry]:
            self.entry = i

    def near(self, q: np.ndarray, beam: int, cosine: float) -> list[int]:
        """Nodes of that cosine or more: a beam search, then a walk over all near nodes."""
        found = dict((x, s) for s, x in self._beam(q, self._descend(q, 0), beam, 0))
        ahead = [x for x, s in found.items() if s >= cosine - MARGIN]
        while ahead:
            new = [x for x in self.links[ahead.pop()][0] if x not in found]
            if new:
                sims = (self.vectors[new] @ q).tolist()
                found.update(zip(new, sims, strict=True))
                ahead += [x for x, s in zip(new, sims, strict=True) if s >= cosine - MARGIN]
        return [x for x, s in found.items() if s >= cosine]

    def audited_beam(self, queries: np.ndarray, cosine: float, beam: int = BEAM) -> int:
        """The beam, doubled until evenly spaced queries reach the recall of brute force."""
        some = queries[np.unique(np.linspace(0, len(queries) - 1, AUDITS).astype(int))]
        true = (some @ self.vectors.T >= cosine).sum()
        while beam < len(self.vectors):
            if sum(len(self.near(q, beam, cosine)) for q in some) >= RECALL * true:
                break
            beam *= 2
        return beam


def unit_vectors(rows: pd.Series) -> np.ndarray:
    x = np.array(rows.tolist(), np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    """One shard's rows -> its graph, vectors, nodes and copies, as one row."""
    rows = rows.sort_values("node")
    vectors = unit_vectors(rows["embedding"])
    graph = Graph(vectors)
    return pd.DataFrame(
        {
            "label": rows["label"].iloc[:1].to_numpy(),
            "dim": rows["dim"].iloc[:1].to_numpy(),
            "shard": rows["shard"].iloc[:1].to_numpy(),
            "graph": [pickle.dumps((graph.links, graph.level, graph.entry))],
            "vectors": [vectors.tobytes()],
            "nodes": [rows["node"].to_numpy(np.int64).tobytes()],
            "copies": [rows["copies"].to_numpy(np.int64).tobytes()],
        }
    )


def ask_shard(r, cosine: float) -> pd.DataFrame:
    """Links between a shard and the queries of one shard: (a, null, n) for the copies that a
    links to, and (a, b, 0) for a forest of the links."""
    graph = Graph.__new__(Graph)
    graph.links, graph.level, graph.entry = pickle.loads(r.graph)
    graph.vectors = np.frombuffer(r.vectors).reshape(-1, r.dim)
    nodes, copies = np.frombuffer(r.nodes, np.int64), np.frombuffer(r.copies, np.int64)
    own = r.asked_nodes is None
    queries = graph.vectors if own else np.frombuffer(r.asked_vectors).reshape(-1, r.dim)
    asked = nodes if own else np.frombuffer(r.asked_nodes, np.int64)
    asked_copies = copies if own else np.frombuffer(r.asked_copies, np.int64)
    beam = graph.audited_beam(queries, cosine)
    found = [graph.near(q, beam, cosine) for q in queries]
    a = np.repeat(np.arange(len(asked)), [len(f) for f in found])
    b = np.array([x for f in found for x in f], np.int64)
    if own:  # a link found from either side counts for both
        pairs = np.unique(np.minimum(a, b) * len(nodes) + np.maximum(a, b))
        a, b = pairs // len(nodes), pairs % len(nodes)
        a, b = a[a != b], b[a != b]
    n_asked = np.bincount(a, copies[b], len(asked)).astype(np.int64)
    n_nodes = np.bincount(b, asked_copies[a], len(nodes)).astype(np.int64)
    names = nodes if own else np.r_[nodes, asked]
    links = n_asked + n_nodes if own else np.r_[n_nodes, n_asked]
    shift = 0 if own else len(nodes)
    union = Union(len(names))
    forest = [(names[x + shift], names[y]) for x, y in zip(a.tolist(), b.tolist(), strict=True) if union.join(x + shift, y)]
    linked = np.flatnonzero(links)
    return pd.DataFrame(
        {
            "a": np.r_[names[linked], np.array([x for x, _ in forest], np.int64)],
            "b": pd.array([None] * len(linked) + [y for _, y in forest], dtype="Int64"),
            "n": np.r_[links[linked], np.zeros(len(forest), np.int64)],
        }
    )


def vector_classes(vectors: DataFrame, cosine: float = COSINE, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row; needs vec_id, embedding, label.

    Two vectors link when their labels are equal and not null, their lengths are equal and
    their cosine is ``cosine`` or more. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing, as do those without a label. Repeated rows and
    equal vectors link with each other. component_id is the smallest vec_id reachable, a null
    id only where there is no other. Other columns are not read; an empty table gives no rows.
    """
    value = F.col("embedding").cast("array<double>")
    finite = F.forall(value, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    usable = F.coalesce(finite & F.exists(value, lambda x: x != 0) & F.col("label").isNotNull(), F.lit(False))
    keyed = vectors.select(
        "vec_id", "embedding", "label", F.when(usable, F.xxhash64("label", F.size("embedding"), "embedding")).alias("node")
    )
    rows = stored(keyed, "vectors")
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count("*").alias("copies")
    ).withColumn("dim", F.size("embedding"))
    shards = nodes.groupBy("label", "dim").agg(F.ceil(F.count("*") / shard_nodes).cast("int").alias("shards"))
    placed = nodes.join(shards, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")).cast("int"))
    kind = vectors.schema["label"].dataType.simpleString()
    graphs = stored(
        placed.groupBy("label", "dim", "shard").applyInPandas(
            build_shard, f"label {kind}, dim int, shard int, graph binary, vectors binary, nodes binary, copies binary"
        ),
        "graphs",
    )
    later = graphs.select(
        "label", "dim", F.col("shard").alias("asked"), *[F.col(c).alias(f"asked_{c}") for c in ("vectors", "nodes", "copies")]
    )
    none = F.lit(None).cast("binary")
    units = graphs.withColumns({f"asked_{c}": none for c in ("vectors", "nodes", "copies")}).withColumn("asked", F.col("shard"))
    units = units.unionByName(graphs.join(later, ["label", "dim"]).where("asked > shard"))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                yield ask_shard(r, cosine)

    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = stored(units.repartition(tasks, "label", "dim", "shard", "asked").mapInPandas(ask, "a long, b long, n long"), "links")
    links = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    roots = connected(found.where("b is not null").select("a", "b"))
    least_of = nodes.select("node", "copies").join(links, "node", "left").join(roots, "node", "left").select(
        "node", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root")
    )
    all_rows = rows.select("vec_id", "node").join(least_of, "node", "left")
    # Stored, so that the join has an exchange of its own, which can split a large component.
    least = stored(all_rows.where("root is not null").groupBy("root").agg(F.min("vec_id").alias("least")), "least")
    component = F.when(F.col("root").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return all_rows.join(least, "root", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")
    ).withColumn("kept", same_or_null(F.col("vec_id"), F.col("component_id")))
