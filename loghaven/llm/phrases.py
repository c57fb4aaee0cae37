"""Phrase collocations by prefix-free parsing.

Pieces of text are cut into chunks where a window of three words triggers it by content alone, so
copied passages are cut alike wherever they stand. A chunk ends with the window that begins the
next one; a phrase of up to four words belongs to the chunk in which it starts before that
window, so overlaps count once. Equal chunks of the whole corpus are one entry of a dictionary with
its frequency in the parse, and phrases are counted inside distinct chunks, weighted by it.

Blocks of the dictionary count in two rounds, words and pairs first, then phrases of three and four
words whose pairs are all frequent. A block sends its distinct phrases as 64-bit hashes to be summed
and gets back those that are frequent. Only these are spelled, and summed by their text, so a
collision of hashes lets a phrase through but changes no count.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loghaven.lake import stored
from loghaven.llm.shingles import LOWER, mixed

LEAST = 30
LONGEST = 4
#: Words of a trigger and of an overlap; a window of this many words triggers once in PERIOD.
WINDOW, PERIOD = LONGEST - 1, 16
NO_LANG = "und"
#: A candidate inside a longer one of at least this percentage of its count is dropped.
INSIDE_PERCENT = 80
SCORE_SCALE = 2_000_000
TOP = 2000
#: Bytes parsed at once, bytes of chunks merged in a task, characters of a block, hashes of a part.
SLICE, MERGED, BLOCK_CHARS, PART_HASHES = 1_000_000, 8_000_000, 3_000_000, 500_000

#: 1: between words, 2: between pieces.
_BREAK = np.zeros(256, np.int8)
_BREAK[list(b" \t")] = 1
_BREAK[list(b".,;:!?\n\v\f\r")] = 2
_ENDS = [bytes([b]) for b in np.flatnonzero(_BREAK == 2)]


def _slices(texts: list[bytes]) -> Iterator[bytes]:
    """The texts one after another, cut between pieces, about SLICE bytes at once."""
    held, size = [], 0
    for text in texts:
        at = 0
        while len(text) - at > SLICE:
            end = max(text.rfind(b, at, at + SLICE) for b in _ENDS)
            if end < 0:  # one piece longer than a slice
                end = min((x for x in (text.find(b, at) for b in _ENDS) if x >= 0), default=len(text) - 1)
            yield text[at : end + 1]
            at = end + 1
        held.append(text[at:])
        size += len(text) - at
        if size >= SLICE:
            yield b"\n".join(held)
            held, size = [], 0
    if size:
        yield b"\n".join(held)


def words_of(data: bytes) -> tuple[pa.StringArray, np.ndarray]:
    """The words of some bytes and, for each, the number of its piece."""
    raw = np.frombuffer(data, np.uint8)
    kind = _BREAK[raw]
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = kind == 0
    step = np.diff(inside)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    offsets = np.r_[0, np.cumsum(end - start)].astype(np.int32)
    letters = raw[inside[1:-1].astype(bool)]
    words = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets.tobytes()), pa.py_buffer(letters.tobytes()))
    return words, np.cumsum(kind == 2)[start] if len(start) else np.zeros(0, np.int64)


def _encoded(words: pa.StringArray) -> tuple[np.ndarray, pa.StringArray, np.ndarray]:
    """Tokens, the distinct words, and the words' hashes."""
    coded = words.dictionary_encode()
    distinct = coded.dictionary
    hashes = pd.util.hash_array(distinct.to_numpy(zero_copy_only=False).astype(object), categorize=False)
    return coded.indices.to_numpy(), distinct, hashes.astype(np.uint64)


def chunks_of(data: bytes) -> tuple[pa.StringArray, np.ndarray]:
    """The chunks of some bytes, words joined by one space, and which of them go on."""
    words, piece = words_of(data)
    n = len(words)
    if not n:
        return pa.array([], pa.string()), np.zeros(0, bool)
    tokens, _, hashes = _encoded(words)
    h = hashes[tokens]
    starts = np.r_[True, piece[1:] != piece[:-1]]
    if n >= WINDOW:
        window = np.zeros(n - WINDOW + 1, np.uint64)
        for i in range(WINDOW):
            window = mixed(window * np.uint64(3) + h[i : n - WINDOW + 1 + i])
        starts[: n - WINDOW + 1] |= (window % np.uint64(PERIOD) == 0) & (piece[: n - WINDOW + 1] == piece[WINDOW - 1 :])
    first = np.flatnonzero(starts)
    after = np.r_[first[1:], n]
    goes_on = np.r_[piece[first[1:]] == piece[first[:-1]], False]
    sizes = np.diff(np.frombuffer(words.buffers()[1], np.int32)[: n + 1])
    spaced = np.r_[0, np.cumsum(sizes + 1)]
    text = np.full(spaced[-1], 0x20, np.uint8)
    letters = np.frombuffer(words.buffers()[2], np.uint8)
    text[np.arange(len(letters)) + np.repeat(np.arange(n), sizes)] = letters
    begin, end = spaced[first], spaced[after + WINDOW * goes_on] - 1
    offsets = np.r_[0, np.cumsum(end - begin)]
    taken = text[np.repeat(begin - offsets[:-1], end - begin) + np.arange(offsets[-1])]
    buffers = pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(taken.tobytes())
    return pa.StringArray.from_buffers(len(first), *buffers), goes_on


def parse(docs: DataFrame) -> DataFrame:
    """lang, chunk, goes_on, n: the parse of all texts, equal chunks merged within tasks."""

    def merged(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        if held:
            rows = pa.concat_tables(held).group_by(["lang", "chunk", "goes_on"]).aggregate([([], "count_all")])
            rows = rows.rename_columns(["lang", "chunk", "goes_on", "n"])
            yield from rows.to_batches(max_chunksize=100_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        texts: dict[str, list[bytes]] = {}
        waiting: Counter[str] = Counter()

        def cut(lang: str) -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            for data in _slices(texts.pop(lang)):
                chunks, goes_on = chunks_of(data)
                held.append(pa.table({"lang": pa.array([lang] * len(chunks), pa.string()), "chunk": chunks, "goes_on": goes_on}))
                size += len(data)
                if size >= MERGED:
                    yield from merged(held)
                    held, size = [], 0
            del waiting[lang]

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if text.is_valid:
                    texts.setdefault(lang, []).append(text.as_buffer().to_pybytes().translate(LOWER))
                    waiting[lang] += len(texts[lang][-1])
                    if waiting[lang] >= SLICE:
                        yield from cut(lang)
        for lang in list(texts):
            yield from cut(lang)
        yield from merged(held)

    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)), F.col("text").cast("string"))
    return texts.mapInArrow(run, "lang string, chunk string, goes_on boolean, n long")


def dictionary(docs: DataFrame) -> DataFrame:
    """Distinct chunks of the corpus with their frequencies, in blocks that tasks can hold."""
    distinct = parse(docs).groupBy("lang", "chunk", "goes_on").agg(F.sum("n").alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column(1).nbytes
            if size >= BLOCK_CHARS:
                yield _block(pa.Table.from_batches(held))
                held, size = [], 0
        if size:
            yield _block(pa.Table.from_batches(held))

    blocks = distinct.mapInArrow(run, "n_words long, langs array<string>, words binary, tokens binary, chunks binary")
    return blocks.withColumn("block", F.monotonically_increasing_id())


def _pack(x: np.ndarray) -> bytes:
    return zlib.compress(x.tobytes(), 1)


def _block(rows: pa.Table) -> pa.RecordBatch:
    words, chunk = words_of("\n".join(rows.column("chunk").to_pylist()).encode())
    tokens, distinct, _ = _encoded(words)
    langs = rows.column("lang").combine_chunks().dictionary_encode()
    chunks = np.stack(
        [
            np.bincount(chunk, minlength=rows.num_rows),
            langs.indices.to_numpy().astype(np.int64),
            rows.column("goes_on").to_numpy().astype(np.int64),
            rows.column("n").to_numpy(),
        ]
    )
    return pa.RecordBatch.from_arrays(
        [
            pa.array([len(tokens)], pa.int64()),
            pa.array([langs.dictionary.to_pylist()], pa.list_(pa.string())),
            pa.array([zlib.compress("\n".join(distinct.to_pylist()).encode(), 1)], pa.binary()),
            pa.array([_pack(tokens.astype(np.int32))], pa.binary()),
            pa.array([_pack(chunks)], pa.binary()),
        ],
        ["n_words", "langs", "words", "tokens", "chunks"],
    )


class Block:
    """A block's chunks laid end to end: for each word its token, its weight if its chunk counts
    it, and how many words of the chunk follow."""

    def __init__(self, r: dict):
        self.langs = r["langs"]
        self.words = np.array(zlib.decompress(r["words"]).decode().split("\n"), object)
        self.tokens = np.frombuffer(zlib.decompress(r["tokens"]), np.int32)
        sizes, lang, goes_on, n = np.frombuffer(zlib.decompress(r["chunks"]), np.int64).reshape(4, -1)
        self.left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(self.tokens))
        self.counted = self.left > WINDOW * np.repeat(goes_on, sizes)
        self.lang, self.n = np.repeat(lang, sizes), np.repeat(n, sizes)
        of_lang = pd.util.hash_array(np.array(self.langs, object), categorize=False).astype(np.uint64)
        of_word = pd.util.hash_array(self.words, categorize=False).astype(np.uint64)
        self.hash = [mixed(of_word[self.tokens] + of_lang[self.lang])]
        for size in range(1, LONGEST):  # past the end of a chunk they mean nothing, and are not used
            self.hash.append(mixed(self.hash[-1] * np.uint64(3) + np.roll(self.hash[0], -size)))

    def counts(self, size: int, alive: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes and counts of the phrases of a size; ``alive`` marks the places where a
        frequent pair starts. Pairs in an overlap count 0 here, but longer phrases ask for them."""
        at = self.left >= size
        if size != 2:
            at &= self.counted
        if alive is not None:
            for i in range(size - 1):
                at &= np.roll(alive, -i)
        at = np.flatnonzero(at)
        return _summed(self.hash[size - 1][at], self.n[at] * self.counted[at])

    def alive(self, size: int, frequent: np.ndarray) -> np.ndarray:
        """Places where a frequent phrase of a size starts."""
        if not len(frequent):
            return np.zeros(len(self.tokens), bool)
        h = self.hash[size - 1]
        at = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
        return (frequent[at] == h) & (self.left >= size)

    def spelled(self, size: int, alive: np.ndarray) -> pa.Table:
        """lang, size, phrase, count of the frequent phrases as they stand in the block."""
        at = np.flatnonzero(alive & self.counted)
        order = np.argsort(self.hash[size - 1][at], kind="stable")
        at = at[order]
        same = np.ones(max(len(at) - 1, 0), bool)  # as the place before, in every word and not by hash alone
        for i in range(size):
            token = self.tokens[at + i]
            same &= token[1:] == token[:-1]
        same &= self.lang[at[1:]] == self.lang[at[:-1]]
        first = np.flatnonzero(np.r_[np.ones(min(len(at), 1), bool), ~same])
        count = np.add.reduceat(self.n[at], first) if len(first) else np.zeros(0, np.int64)
        parts = [self.words[self.tokens[at[first] + i]] for i in range(size)]
        phrases = [" ".join(x) for x in zip(*parts, strict=True)]
        langs = [self.langs[x] for x in self.lang[at[first]]]
        return _spelled(langs, size, phrases, count)

    def totals(self) -> pa.Table:
        """The number of words of each lang, as a phrase of no words."""
        n = np.zeros(len(self.langs), np.int64)
        np.add.at(n, self.lang[self.counted], self.n[self.counted])
        return _spelled(self.langs, 0, [""] * len(n), n)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.r_[np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(n, first) if len(first) else n


FIELDS = "lang string, size int, phrase string, count long, part long, block long, hashes binary, counts binary"
_SCHEMA = pa.schema(
    [("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("count", pa.int64())]
    + [("part", pa.int64()), ("block", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())]
)


def _table(n: int, **columns) -> pa.Table:
    return pa.table([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in _SCHEMA], schema=_SCHEMA)


def _spelled(langs: list, size: int, phrases: list, count: np.ndarray) -> pa.Table:
    return _table(
        len(phrases), lang=pa.array(langs, pa.string()), size=pa.array([size] * len(phrases), pa.int32()),
        phrase=pa.array(phrases, pa.string()), count=pa.array(count, pa.int64()),
    )


def _counted(block: int, size: int, hashes: np.ndarray, n: np.ndarray, parts: int) -> pa.Table:
    """Sorted hashes and counts, cut into the parts of the range of hashes that sum them."""
    part = ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.r_[np.ones(min(len(part), 1), bool), part[1:] != part[:-1]])
    ends = np.r_[first[1:], len(part)][: len(first)]
    return _table(
        len(first), size=pa.array([size] * len(first), pa.int32()), part=pa.array(part[first], pa.int64()), block=pa.array([block] * len(first), pa.int64()),
        hashes=pa.array([hashes[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary()),
        counts=pa.array([n[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary()),
    )


def frequent(rows: DataFrame, least: int) -> DataFrame:
    """size, block, frequent (sorted hashes of the block that all blocks together hold often)."""

    def run(rows: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("hashes")]
        keys = np.concatenate(hashes)
        distinct, place = np.unique(keys, return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, place, np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in rows.column("counts")]))
        kept = np.split((total >= least)[place], np.cumsum([len(x) for x in hashes])[:-1])
        found = pa.array([h[k].tobytes() for h, k in zip(hashes, kept, strict=True)], pa.binary())
        return pa.table({"size": rows.column("size"), "block": rows.column("block"), "frequent": found})

    counts = rows.where("part is not null").select("size", "part", "block", "hashes", "counts")
    return counts.groupBy("size", "part").applyInArrow(run, "size int, block long, frequent binary")


def _block_sums(r: dict, parts: int) -> pa.Table:
    block = Block(r)
    return pa.concat_tables([_counted(r["block"], size, *block.counts(size), parts) for size in (1, 2)])


def _next_round(blocks: pa.Table, found: pa.Table, sizes: tuple[int, ...], after: tuple[int, ...], parts: int) -> pa.Table:
    """Spell a block's frequent phrases of some sizes and count those of the sizes after."""
    if not blocks.num_rows:
        return _SCHEMA.empty_table()
    r = blocks.to_pylist()[0]
    block = Block(r)
    of_size = found.column("size").to_numpy()
    hashes = [np.frombuffer(x.as_buffer(), np.uint64) for x in found.column("frequent")]
    alive = {}
    for size in sizes:
        mine = [h for h, s in zip(hashes, of_size, strict=True) if s == size]
        alive[size] = block.alive(size, np.sort(np.concatenate(mine)) if mine else np.zeros(0, np.uint64))
    out = [block.spelled(size, alive[size]) for size in sizes]
    if 1 in sizes:
        out.append(block.totals())
    out += [_counted(r["block"], size, *block.counts(size, alive[2]), parts) for size in after]
    return pa.concat_tables(out)


def phrase_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, size, phrase, count: words and phrases of up to four words that are found ``least``
    times or more, and with size 0 the number of words of each lang."""
    blocks = stored(dictionary(docs), "phrase-blocks")
    n_words = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    parts = max(1, -(-n_words // PART_HASHES))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield from _block_sums(r, parts).to_batches()

    def following(sizes: tuple[int, ...], after: tuple[int, ...]):
        return lambda block, found: _next_round(block, found, sizes, after, parts)

    pairs = stored(frequent(blocks.mapInArrow(first, FIELDS), least), "phrase-pairs")
    by_block = blocks.groupBy("block")
    second = stored(by_block.cogroup(pairs.groupBy("block")).applyInArrow(following((1, 2), (3, 4)), FIELDS), "phrase-round")
    longer = stored(frequent(second, least), "phrase-longer")
    third = by_block.cogroup(longer.groupBy("block")).applyInArrow(following((3, 4), ()), FIELDS)
    spelled = second.unionByName(third).where("part is null").groupBy("lang", "size", "phrase").agg(F.sum("count").alias("count"))
    return spelled.where((F.col("count") >= least) | (F.col("size") == 0))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each lang.

    Needs lang and text; other columns are not read. A-Z is lower-cased, texts are split into pieces
    and these into words. Candidates are phrases of two to four words found ``least`` times or more (a).
    The lowest-scoring cut counts, with its parts' counts l and r and the score
    floor(2000000 a / (l + r)), exact beyond 64 bits. A candidate whose words lie inside a longer
    one of at least 80 % of its count is dropped. Null texts are empty, a null lang is ``und``, repeated
    rows count each, ties go by a and then by the phrase's bytes; an empty table gives no rows.
    """
    counts = stored(phrase_counts(docs, least), "phrases")
    words = F.split("phrase", " ")
    big = lambda c: F.col(c).cast("decimal(20,0)")
    candidates = counts.where("size > 1").select("lang", "size", "phrase", F.col("count").alias("a"), words.alias("words"))
    join = lambda x: F.array_join(x, " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", join(F.slice("words", 1, F.col("k"))).alias("first"), join(F.slice("words", F.col("k") + 1, F.col("size"))).alias("rest"))
    part = lambda name, n: counts.where("size > 0").select("lang", F.col("phrase").alias(name), F.col("count").alias(n))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    cuts = cuts.withColumns({"big_a": big("a"), "big_l": big("l"), "big_r": big("r")})
    cuts = cuts.withColumn("score", F.expr(f"(cast({SCORE_SCALE} as decimal(7,0)) * big_a) div (big_l + big_r)"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = candidates.where("size > 2").withColumn("inner", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("inner") + 1)))
    inner = inner.select("lang", join(F.slice("words", F.col("at"), F.col("inner"))).alias("phrase"), "a")
    longest = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(longest, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (big("longer") * 100 < big("a") * INSIDE_PERCENT)
    )
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    n = counts.where("size = 0").select("lang", F.col("count").alias("n"))
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
