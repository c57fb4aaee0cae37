"""Language-model scores by a weighted backoff automaton.

States are the root and all training words. A state's arcs are the word pairs seen twice or
more from it, with absolute discounting; its failure arc leads to the root with the weight that
the arcs leave. The root has an arc for every word, smoothed by an added count.

Texts are cut into blocks. Each block sends its distinct pairs, by their sorted hashes and cut into
parts of the range of hashes, to be counted over the whole corpus, and gets just their totals back,
in the order in which it sent them: the part of the automaton that its texts can reach. Then it sends
its words with what their arcs take, and gets counts and failure weights back the same way. So
the counts grow with the corpus, no task and not the driver holds them all, and a frequent word or
pair is one number of each block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loghaven.lake import stored
from loghaven.llm.common import id_remainder
from loghaven.llm.shingles import Hasher, mixed

HELD_OUT_MODULUS = 10
ADDED = 0.1
DISCOUNT = 0.75
#: Words of at least this share of the training words are states, and arcs lead from states to
#: states; at 0 there is no limit.
STATE_SHARE = 0.0
MIN_PAIR = 2
#: Characters and documents of a block, unless one document is longer.
BLOCK_CHARS, BLOCK_DOCS = 8_000_000, 4000
#: Keys that one task adds up, on average, if all blocks held different ones.
PART_KEYS = 1_000_000
END = np.uint64(0x5851F42D4C957F2D)


def text_blocks(docs: DataFrame) -> DataFrame:
    """block, doc_id[], held_out[], sizes (tokens per text), words (sorted distinct hashes, packed) and
    tokens (places in words, compressed; every text ends with END), from doc_id, text, held_out."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, number = Hasher(), TaskContext.get().partitionId() << 32

        def block(ids: list, held: list, rows: list[np.ndarray]) -> pa.RecordBatch:
            nonlocal number
            words, tokens = np.unique(np.concatenate(rows), return_inverse=True)
            sizes = np.array([len(r) for r in rows], np.int64)
            number += 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([ids], schema.field("doc_id").type),
                    pa.array([held], pa.list_(pa.bool_())),
                    pa.array([sizes.tobytes()], pa.binary()),
                    pa.array([_packed(words)], pa.binary()),
                    pa.array([zlib.compress(np.ascontiguousarray(tokens.astype(np.int32).view(np.uint8).reshape(-1, 4).T).tobytes(), 1)], pa.binary()),
                    pa.array([len(tokens)], pa.int64()),
                    pa.array([len(words)], pa.int64()),
                ],
                ["block", "doc_id", "held_out", "sizes", "words", "tokens", "n", "n_words"],
            )

        schema, ids, held, rows, chars = None, [], [], [], 0
        for batch in batches:
            schema = pa.schema([pa.field("doc_id", pa.list_(batch.schema.field(0).type))])
            for doc_id, text, out in zip(*[batch.column(i) for i in range(3)], strict=True):
                whole = text.as_py() or ""
                ids.append(doc_id.as_py())
                held.append(out.as_py())
                rows.append(np.append(hasher.words(whole), END))
                chars += len(whole)
                if chars >= BLOCK_CHARS or len(rows) >= BLOCK_DOCS:
                    yield block(ids, held, rows)
                    ids, held, rows, chars = [], [], [], 0
        if rows:
            yield block(ids, held, rows)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string"), "held_out").mapInArrow(
        blocks, f"block long, doc_id array<{kind}>, held_out array<boolean>, sizes binary, words binary, tokens binary, n long, n_words long"
    )


def _parts(sizes: bytes, tokens: bytes, held: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, the size of each text, and for each token whether its text trains."""
    n = np.frombuffer(sizes, np.int64)
    planes = np.frombuffer(zlib.decompress(tokens), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.int32).ravel(), n, np.repeat(~np.asarray(held, bool), n)


def _states_of(words: bytes, states: np.ndarray) -> np.ndarray:
    """For each word of a block the number of its state, or -1."""
    words = np.frombuffer(words, np.uint64)
    if not len(states):
        return np.full(len(words), -1)
    at = np.minimum(np.searchsorted(states, words), len(states) - 1)
    return np.where(states[at] == words, at, -1)


def _pairs(tokens: np.ndarray, sizes: np.ndarray, state: np.ndarray, n: int) -> np.ndarray:
    """For each token but the first of a text: state before * n + state of the token, or -1."""
    s = state[tokens]
    pair = np.full(len(s), -1)
    pair[1:] = np.where((s[:-1] >= 0) & (s[1:] >= 0), s[:-1] * n + s[1:], -1)
    pair[np.r_[0, np.cumsum(sizes)[:-1]]] = -1
    return pair


def _packed(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys by their differences, whose high bytes, all alike, stand together."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    return zlib.compress(np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _numbers(x: np.ndarray) -> bytes:
    """64-bit numbers, by planes of their bytes."""
    return zlib.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _read(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _blocks(rows: pa.RecordBatch | pa.Table) -> Iterator[dict]:
    """Blocks with their words unpacked."""
    for r in rows.to_pylist():
        r["words"] = _unpacked(r["words"]).tobytes()
        yield r


ASKED = "part long, block long, keys binary, counts binary, masses binary"
TOTALS = "part long, block long, totals binary, masses binary, once binary, n long, v long"


def _asked(block: int, keys: np.ndarray, counts: np.ndarray, masses: np.ndarray | None, parts: int) -> pa.RecordBatch:
    """Sorted keys with a block's counts (and masses), cut into the parts that add them up."""
    part = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.r_[np.ones(min(len(part), 1), bool), part[1:] != part[:-1]])
    cuts = list(zip(first, np.r_[first[1:], len(part)][: len(first)], strict=True))
    pack = lambda x: pa.array([_numbers(x[a:b]) for a, b in cuts], pa.binary()) if x is not None else pa.nulls(len(cuts), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(part[first], pa.int64()), pa.array(np.full(len(cuts), block), pa.int64()), pa.array([_packed(keys[a:b]) for a, b in cuts], pa.binary()), pack(counts), pack(masses)],
        ["part", "block", "keys", "counts", "masses"],
    )


def added_up(asked: DataFrame) -> DataFrame:
    """For each part that a block sent: the totals (and sums of masses) of its keys in their order,
    which of them it is the first to hold, and over these the sum of totals and how many are not 0."""

    def run(rows: pa.Table) -> pa.Table:
        order = np.argsort(rows.column("block").to_numpy())
        at = [rows.slice(int(i), 1).to_pylist()[0] for i in order]
        keys = [_unpacked(r["keys"]) for r in at]
        ends = np.cumsum([len(k) for k in keys])
        distinct, first, place = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        total, mass = np.zeros(len(distinct), np.int64), np.zeros(len(distinct))
        weighted = at[0]["masses"] is not None
        for r, here in zip(at, np.split(place, ends[:-1]), strict=True):
            total[here] += _read(r["counts"], np.int64)  # the keys of a block are distinct
            if weighted:
                mass[here] += _read(r["masses"], np.float64)
        once = np.zeros(len(place), bool)
        once[first] = True
        out = []
        for r, here, own in zip(at, np.split(place, ends[:-1]), np.split(once, ends[:-1]), strict=True):
            t = total[here]
            out.append(
                {
                    "part": r["part"], "block": r["block"], "totals": _numbers(t), "masses": _numbers(mass[here]) if weighted else None,
                    "once": zlib.compress(np.packbits(own).tobytes(), 1), "n": int(t[own].sum()), "v": int((t[own] > 0).sum()),
                }
            )
        return pa.Table.from_pylist(out, schema)

    schema = pa.schema([(x.split()[0], {"long": pa.int64(), "binary": pa.binary()}[x.split()[1]]) for x in TOTALS.split(", ")])
    return asked.groupBy("part").applyInArrow(run, TOTALS)


def _answers(rows: pa.Table, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Totals, masses and first holder of a block's n keys in order, from the rows of its parts."""
    at = sorted(rows.to_pylist(), key=lambda r: r["part"])
    totals = [_read(r["totals"], np.int64) for r in at]
    masses = [_read(r["masses"], np.float64) if r["masses"] is not None else np.zeros(len(t)) for r, t in zip(at, totals, strict=True)]
    once = [np.unpackbits(np.frombuffer(zlib.decompress(r["once"]), np.uint8), count=len(t)).astype(bool) for r, t in zip(at, totals, strict=True)]
    if not at:
        return np.zeros(n, np.int64), np.zeros(n), np.zeros(n, bool)
    return np.concatenate(totals), np.concatenate(masses), np.concatenate(once)


def _pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """64-bit keys of ordered pairs of word hashes."""
    return mixed(mixed(first) * np.uint64(3) + second).view(np.int64)


def _pairs_of(tokens: np.ndarray, sizes: np.ndarray, words: bytes, states: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """A block's states, the tokens that end a pair (numbers in these states), its distinct pairs, which
    of these each such token ends, and their keys; ``states`` None makes every word of the block one."""
    mine = np.frombuffer(words, np.uint64)
    if states is not None:
        mine = mine[_states_of(words, states) >= 0]
    pair = _pairs(tokens, sizes, _states_of(words, mine), len(mine))
    ends = np.flatnonzero(pair >= 0)
    seen, of = np.unique(pair[ends], return_inverse=True)  # without the inverse, numpy hashes instead of sorting, far slower
    n = max(1, len(mine))
    return mine, ends, seen, of, _pair_keys(mine[seen // n], mine[seen % n])


def _of_block(r: dict, states: np.ndarray | None) -> tuple:
    """A block's tokens, sizes, which tokens train, states, distinct pairs, which of these each training
    token that ends one ends, and the pairs' distinct keys in order with the place of each pair's key."""
    tokens, sizes, trains = _parts(r["sizes"], r["tokens"], r["held_out"])
    mine, ends, seen, of, keys = _pairs_of(tokens, sizes, r["words"], states)
    ordered, place = np.unique(keys.view(np.uint64), return_inverse=True)
    return tokens, sizes, trains, mine, seen, of[trains[ends]], ordered, place


def pair_counts(blocks: DataFrame, states: np.ndarray | None, parts: int) -> DataFrame:
    """The distinct pairs of each block with their counts in its training texts, also 0."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _blocks(batch):
                _, _, _, _, _, of, ordered, place = _of_block(r, states)
                yield _asked(r["block"], ordered, np.bincount(place[of], minlength=len(ordered)).astype(np.int64), None, parts)

    return blocks.select("block", "held_out", "sizes", "words", "tokens").mapInArrow(count, ASKED)


def word_counts(blocks: DataFrame, pairs: DataFrame, states: np.ndarray | None, parts: int) -> DataFrame:
    """The words of each block with their counts, and what the arcs that it is the first to hold take
    from their states."""

    def count(rows: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for r in _blocks(rows):
            tokens, _, trains, mine, seen, _, ordered, place = _of_block(r, states)
            words = np.frombuffer(r["words"], np.uint64)
            totals, _, once = _answers(answers, len(ordered))
            arc = once & (totals >= MIN_PAIR)
            taken = np.where(arc, totals - DISCOUNT, 0.0)[place]
            of_state = np.bincount(seen // max(1, len(mine)), taken, minlength=len(mine))
            mass = np.zeros(len(words))
            mass[np.searchsorted(words, mine)] = of_state
            out.append(_asked(r["block"], words, np.bincount(tokens[trains], minlength=len(words)).astype(np.int64), mass, parts))
        return pa.Table.from_batches(out) if out else schema.empty_table()

    schema = pa.schema([(x.split()[0], {"long": pa.int64(), "binary": pa.binary()}[x.split()[1]]) for x in ASKED.split(", ")])
    blocks = blocks.select("block", "held_out", "sizes", "words", "tokens")
    return blocks.groupBy("block").cogroup(pairs.groupBy("block")).applyInArrow(count, ASKED)


def frequent_words(blocks: DataFrame, share: float) -> np.ndarray:
    """Sorted hashes of the words that hold the share of the training words; 1 / share at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _blocks(batch):
                tokens, _, trains = _parts(r["sizes"], r["tokens"], r["held_out"])
                words = np.frombuffer(r["words"], np.int64)
                counts = np.bincount(tokens[trains], minlength=len(words))
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(counts, pa.int64())], ["key", "count"])

    counts = blocks.select("held_out", "sizes", "words", "tokens").mapInArrow(count, "key long, count long")
    totals = stored(counts.groupBy("key").agg(F.sum("count").alias("total")), "lm-totals")
    n = totals.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    found = totals.where((F.col("total") >= share * max(n, 1)) & (F.col("total") > 0)).select("key").collect()
    return np.sort(np.array([r["key"] for r in found], np.int64).view(np.uint64))


def _text_sums(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, np.r_[0, np.cumsum(sizes)[:-1]])


class Automaton:
    """What a block can reach: root weights of its words, arcs of its pairs, failure weights."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, pairs: np.ndarray, pair_counts: np.ndarray, model: dict):
        order = np.argsort(words)
        self.words, self.count = words[order], counts[order]
        self.root = (self.count + ADDED) / (model["n"] + ADDED * (model["v"] + 1))
        kept = pair_counts >= MIN_PAIR
        order = np.argsort(pairs[kept])
        self.pairs, self.pair_count = pairs[kept][order], pair_counts[kept][order]
        self.states, self.state_count, self.failure = model["states"], model["state_counts"], model["failure"]

    def read(self, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """count, log10 root probability and log10 model probability of each token.

        The state after a word is the word's own or the root, whatever came before, so the
        traversal of all texts is one vectorised step per table.
        """
        state = _states_of(self.words.tobytes(), self.states)
        pair = _pairs(tokens, sizes, state, len(self.states))
        before = np.full(len(tokens), -1)
        before[1:] = state[tokens[:-1]]
        before[np.r_[0, np.cumsum(sizes)[:-1]]] = -1
        root = self.root[tokens]
        p = root.copy()
        inside = before >= 0
        p[inside] *= self.failure[before[inside]]
        if len(self.pairs):
            distinct, of = np.unique(pair, return_inverse=True)
            at = np.minimum(np.searchsorted(self.pairs, distinct), len(self.pairs) - 1)[of]
            arc = (pair >= 0) & (self.pairs[at] == pair)
            p[arc] += (self.pair_count[at[arc]] - DISCOUNT) / self.state_count[before[arc]]
        return self.count[tokens], np.log10(root), np.log10(p)


def lm_scores(docs: DataFrame, modulus: int = HELD_OUT_MODULUS, state_share: float = STATE_SHARE) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Needs doc_id and text; other columns are not read. Texts whose crc32(doc_id as text) modulo
    ``modulus`` is not 0 train; a null id counts as an empty text. Tokens are the words, A-Z in
    lower case, and one end. Null and empty texts have just the end. base_score is the root's
    log10 probability, score the automaton's. Repeated rows train and are scored each; an empty
    table gives no rows, and without training texts every token has the same probability. A
    ``state_share`` above 0 is a smaller model: only words that hold it are states, and arcs lead
    from states to states.
    """
    held = docs.select("doc_id", "text", (id_remainder(F.col("doc_id"), modulus) == 0).alias("held_out"))
    blocks = stored(text_blocks(held), "lm-blocks")
    states = frequent_words(blocks, state_share) if state_share > 0 else None
    size = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    pairs = stored(added_up(pair_counts(blocks, states, max(1, int(size[1]) // PART_KEYS))), "lm-pairs")
    words = stored(added_up(word_counts(blocks, pairs, states, max(1, int(size[0]) // PART_KEYS))), "lm-words")
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(rows: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        of_pairs = pc.field("pair")
        for r in _blocks(rows):
            tokens, sizes, _, mine, seen, _, ordered, place = _of_block(r, states)
            names = np.frombuffer(r["words"], np.uint64)
            totals, _, _ = _answers(answers.filter(of_pairs), len(ordered))
            sums, masses, _ = _answers(answers.filter(~of_pairs), len(names))
            at = np.searchsorted(names, mine)
            left = 1.0 - masses[at] / np.maximum(sums[at], 1)
            model = {"n": n, "v": v, "states": mine, "state_counts": sums[at].astype(np.float64), "failure": left}
            automaton = Automaton(names, sums, seen, totals[place] if len(seen) else seen, model)
            count, root, p = automaton.read(tokens, sizes)
            out.append(
                pa.table(
                    [
                        pa.array(r["doc_id"], rows.schema.field("doc_id").type.value_type),
                        pa.array(r["held_out"], pa.bool_()),
                        pa.array(sizes, pa.int64()),
                        pa.array(_text_sums((count > 0).astype(np.int64), sizes), pa.int64()),
                        pa.array(np.full(len(sizes), n), pa.int64()),
                        pa.array(_text_sums(root, sizes)),
                        pa.array(_text_sums(p, sizes)),
                    ],
                    names=names_out,
                )
            )
        empty = [pa.array([], t) for t in (rows.schema.field("doc_id").type.value_type, pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
        return pa.concat_tables(out) if out else pa.table(empty, names=names_out)

    names_out = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    columns = ["block", "part", "totals", "masses", "once"]
    answers = words.select(*columns, F.lit(False).alias("pair")).unionByName(pairs.select(*columns, F.lit(True).alias("pair")))
    return blocks.drop("n", "n_words").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score,
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
