"""SentencePiece encoding and decoding by a shared-prefix Viterbi.

A text becomes marked words (a space is the mark, and no piece goes beyond a word). The new
distinct words of a batch are sorted, which is the depth-first order of their trie; each word
goes on from the forward table of the prefix that it shares with the word before.

The forward table holds for each prefix the last piece of its best segmentation. For unigram
models that is the piece of the highest total score. Models of merged pairs have no such sum:
there, a segmentation is the one the merges give if and only if each pair of neighbours stays
apart when merged alone, so every prefix has exactly one last piece that fits the one before.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
BPE, UNIGRAM = "bpe", "unigram"
NONE = float("-inf")
#: Bytes of all that a task remembers. Half of it is for words, of which those not met since it was
#: last half full go; when endings, whole pieces, pairs and other characters fill the rest, all of
#: these are forgotten.
MEMORY = 112 << 20
#: Estimated bytes of a word besides its text, of another entry, and of a first piece of pairs.
ENTRY, OTHER, FIRST = 240, 160, 300
#: Texts, and characters unless one text has more, whose new words are sorted together.
TEXTS, TEXT_CHARS = 500, 1 << 20
#: Characters beyond which a word's prefixes do not carry their ids; they are traced back once.
LONG = 128


class Pieces:
    """A vocabulary: piece -> (id, score), bytes, the unknown id, and the kind of model."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int], unknown: int, kind: str):
        self.score = {p: s for p, (_, s) in pieces.items()}
        self.byte_ids, self.unknown, self.kind = byte_ids, unknown, kind
        #: Ids of a piece as bytes; other characters are added when they are met.
        self.code = {p: array("i", [i]).tobytes() for p, (i, _) in pieces.items()}
        joining = set(chain.from_iterable(p for p in pieces if len(p) > 1))
        alone = "" if "\n" in joining else "\n"
        self.words = re.compile(f"{alone or '(?!)'}|{MARK}*[^{MARK}{alone}]+|{MARK}+")
        self.worst = min(self.score.values(), default=0.0) - 10.0
        #: Whether two pieces stay apart when merged alone, by the first and the second.
        self.apart: dict[str, dict[str, bool]] = {}
        #: Characters outside the vocabulary that were met.
        self.others: list[str] = []
        #: Ids of the words met, of those met before, and the bytes of the first and of the rest.
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.held_words = self.held = 0
        lengths: dict[str, set[int]] = {}
        for p in pieces:
            if len(p) > 1:
                lengths.setdefault(p[-4:], set()).add(len(p))
        #: For four characters, or a shorter piece, the lengths of the pieces that end so, the longest first.
        self.lengths = {ending: tuple(sorted(n, reverse=True)) for ending, n in lengths.items()}
        #: For three characters the lengths of up to three that a last piece can have there, the longest first.
        self.options: dict[str, tuple[int, ...]] = {}
        self.whole: dict[str, bool] = {}
        #: For whole pieces, from their characters on, the score of the next merge and the last and first part.
        self.steps: dict[str, list[tuple[float, str, str]]] = {}

    def merged(self, text: str, steps: list[tuple[float, str, str]] | None = None) -> list[str]:
        """Merge the pair of the best score, the leftmost of equals, until none is a piece. ``steps``
        gets the best score, the last and the first part before each merge."""
        parts, score = list(text), self.score.get
        scores = [score(a + b, NONE) for a, b in pairwise(parts)]
        while scores and (best := max(scores)) > NONE:
            if steps is not None:
                steps.append((best, parts[-1], parts[0]))
            i = scores.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = score(parts[i - 1] + parts[i], NONE)
            if i < len(scores):
                scores[i] = score(parts[i] + parts[i + 1], NONE)
        return parts

    def forget(self) -> None:
        """Forget endings, whole pieces and their merges, pairs and other characters."""
        for memory in (self.options, self.whole, self.steps, self.apart):
            memory.clear()
        for char in self.others:
            del self.code[char]
        self.others.clear()
        self.held = 0

    def _hold(self, size: int) -> None:
        """Room for one more entry. Called before it is made, so what was just met stays."""
        if self.held + size > MEMORY // 2:
            self.forget()
        self.held += size

    def _steps(self, piece: str) -> list[tuple[float, str, str]]:
        """What a whole piece goes through as it is merged alone; no score is left at its end."""
        steps = self.steps.get(piece)
        if steps is None:
            self._hold(OTHER * len(piece))
            steps = []
            self.merged(piece, steps)
            steps.append((NONE, piece, piece))
            self.steps[piece] = steps
        return steps

    def stay_apart(self, before: str, piece: str) -> bool:
        """Whether two whole pieces, merged from the characters of both, come out as these two. Each is
        merged as it would be alone until the pair across the border is the best, the leftmost of equals."""
        score, lefts, rights = self.score.get, iter(self._steps(before)), iter(self._steps(piece))
        (left, last, _), (right, _, first) = next(lefts), next(rights)
        while True:
            across = score(last + first, NONE)
            if left >= across and left >= right:
                if left == NONE:
                    return True
                left, last, _ = next(lefts)
            elif across >= right:
                return False
            else:
                right, _, first = next(rights)

    def _fits(self, before: str, piece: str) -> bool:
        """Whether two pieces stay apart; remembered in ``apart``, where it is looked up first."""
        known = self.stay_apart(before, piece)
        self._hold(OTHER + (FIRST if before not in self.apart else 0))
        self.apart.setdefault(before, {})[piece] = known
        return known

    def _whole(self, piece: str) -> bool:
        """Whether a piece is what its own characters merge to."""
        known = self.whole.get(piece)
        if known is None:
            self._hold(OTHER)
            known = self.whole[piece] = piece in self.code and self.merged(piece) == [piece]
        return known

    def _options(self, ending: str) -> tuple[int, ...]:
        """Lengths of the pieces of two or three characters that end these three, or fewer at a word's start."""
        found = tuple(n for n in range(len(ending), 1, -1) if ending[-n:] in self.lengths and self._whole(ending[-n:]))
        self._hold(OTHER)
        self.options[ending] = found
        return found

    def _code(self, char: str) -> bytes:
        """Ids of a character that is no piece: its bytes, or the unknown id."""
        ids = [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")] if self.byte_ids else [self.unknown]
        self._hold(OTHER)
        self.others.append(char)
        code = self.code[char] = array("i", ids).tobytes()
        return code

    def encodings(self, words: list[str]) -> Iterator[bytes]:
        """Ids of each word as bytes. ``words`` are sorted, which is the depth-first order of
        their trie: a word goes on from the table of the prefix it shares with the one before.
        Long words have a table of their own without ids, so memory grows with their length.
        """
        step = self._merge_step if self.kind == BPE else self._score_step
        last, code, total, before = [""], [b""], [0.0], ""
        for word in words:
            if len(word) > LONG:
                yield self._traced(word, step)
                continue
            shared = min(len(before), len(word))
            while not word.startswith(before[:shared]):
                shared -= 1
            del last[shared + 1 :], code[shared + 1 :], total[shared + 1 :]
            step(word, last, code, total)
            yield code[-1]
            before = word

    def _traced(self, word: str, step: Callable[[str, list[str], list[bytes], list[float]], None]) -> bytes:
        """Ids of one word from the last pieces of its prefixes, from its end to its start."""
        last, parts, d = [""], [], len(word)
        step(word, last, [], [0.0])
        while d:
            parts.append(self.code.get(last[d]) or self._code(last[d]))
            d -= len(last[d])
        return b"".join(reversed(parts))

    def _merge_step(self, word: str, last: list[str], code: list[bytes], total: list[float]) -> None:
        """Go on with the table to the word's end: the last piece of each prefix, and its ids
        unless ``code`` is empty."""
        options, lengths, whole, apart, codes = self.options, self.lengths, self.whole, self.apart, self.code
        for d in range(len(last), len(word) + 1):
            ending = word[d - 3 : d] if d > 3 else word[:d]
            sizes = options.get(ending)
            if sizes is None:
                sizes = self._options(ending)
            if d > 3 and (longer := lengths.get(word[d - 4 : d])):
                sizes = longer + sizes
            for n in sizes:
                j = d - n
                if j < 0:
                    continue
                piece = word[j:d]
                if n > 3 and (piece not in codes or not (whole.get(piece) or self._whole(piece))):
                    continue
                if not j:
                    break
                try:
                    if apart[last[j]][piece]:
                        break
                except KeyError:
                    if self._fits(last[j], piece):
                        break
            else:
                j = d - 1
                piece = word[j]
                if piece not in codes:
                    self._code(piece)
            last.append(piece)
            if code:
                code.append(code[j] + codes[piece])

    def _score_step(self, word: str, last: list[str], code: list[bytes], total: list[float]) -> None:
        """The same for a unigram model, with the best total score of each prefix."""
        for d in range(len(last), len(word) + 1):
            sizes = {1}.union(*(self.lengths.get(word[max(0, d - n) : d], ()) for n in (4, 3, 2)))
            best, n = max(
                (total[d - n] + self.score.get(word[d - n : d], self.worst), n)
                for n in sizes
                if n == 1 or (n <= d and word[d - n : d] in self.score)
            )
            piece = word[d - n : d]
            last.append(piece)
            ids = self.code.get(piece) or self._code(piece)
            if code:
                code.append(code[d - n] + ids)
            total.append(best)

    def ids_of(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts as bytes; new words are encoded together and remembered."""
        words = [self.marked(text) for text in texts]
        if self.held_words > MEMORY // 4:
            self.known, self.before, self.held_words = {}, self.known, 0
        met = set().union(*words).difference(self.known)
        again = met.intersection(self.before)
        new = sorted(met.difference(again))
        for some, codes in ((again, [self.before[w] for w in again]), (new, list(self.encodings(new)))):
            self.known.update(zip(some, codes, strict=True))
            self.held_words += ENTRY * len(codes) + 4 * sum(map(len, some)) + sum(map(len, codes))
        return [b"".join(map(self.known.__getitem__, w)) for w in words]

    def marked(self, text: str | None) -> list[str]:
        return self.words.findall(MARK + text.replace(" ", MARK)) if text else []


def load_pieces(path: str = MODEL_PATH) -> dict:
    """The vocabulary of a model file as plain values; its size is the vocabulary's."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    spec, kinds = model.normalizer_spec, {1: UNIGRAM, 2: BPE}
    if spec.precompiled_charsmap or not spec.add_dummy_prefix or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
        raise ValueError("only models that leave texts as they are, with a mark before, are supported")
    rows = list(enumerate(model.pieces))
    inner = [p.piece for _, p in rows if p.type == 1 and MARK in p.piece.lstrip(MARK)]
    if inner:
        raise ValueError(f"pieces go beyond words: {inner[:3]}")
    return {
        "pieces": {p.piece: (i, p.score) for i, p in rows if p.type == 1},
        "byte_ids": [i for i, p in rows if p.type == 6],
        "unknown": next((i for i, p in rows if p.type == 2), 0),
        "kind": kinds[model.trainer_spec.model_type],
    }


def _together(batch: pa.Array) -> Iterator[list[str | None]]:
    """The texts of a batch, a few at a time."""
    texts, size = [], 0
    for text in batch:
        texts.append(text.as_py())
        size += len(texts[-1] or "")
        if len(texts) >= TEXTS or size >= TEXT_CHARS:
            yield texts
            texts, size = [], 0
    if texts:
        yield texts


def _lists(parts: list[bytes]) -> pa.Array:
    offsets = np.cumsum([0, *[len(p) // 4 for p in parts]], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), np.int32)))


class Letters:
    """The bytes of every id, one after the other, and where each begins and how long it is."""

    def __init__(self, model: dict):
        name = {i: p.replace(MARK, " ").encode("utf-8", "surrogatepass") for p, (i, _) in model["pieces"].items()}
        name.update({i: bytes([b]) for b, i in enumerate(model["byte_ids"])})
        name[model["unknown"]] = " ⁇ ".encode()
        rows = [name.get(i, b"") for i in range(max(name) + 2)]
        self.letters = np.frombuffer(b"".join(rows), np.uint8)
        self.length = np.array([len(r) for r in rows])
        self.begin = np.r_[0, np.cumsum(self.length)[:-1]]

    def text(self, ids: np.ndarray) -> str:
        ids = np.where((ids < 0) | (ids >= len(self.length)), len(self.length) - 1, ids)
        n = self.length[ids]
        at = np.repeat(self.begin[ids] - np.r_[0, np.cumsum(n)[:-1]][: len(n)], n) + np.arange(n.sum())
        whole = self.letters[at].tobytes()
        return (whole[1:] if whole[:1] == b" " else whole).decode("utf-8", "replace")


def encoded(text: Column, model: dict) -> Column:
    """array<int>: the ids of each whole text; null and empty texts have none."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = Pieces(**model)
        for batch in batches:
            lists = [_lists(pieces.ids_of(texts)) for texts in _together(batch)]
            yield pa.concat_arrays(lists) if lists else pa.array([], pa.list_(pa.int32()))

    return encode(text.cast("string"))


def decoded(ids: Column, model: dict) -> Column:
    """string: the text of each list of ids, null for a null list. Ids of no piece give nothing."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        letters = Letters(model)
        for batch in batches:
            rows = (row.values.fill_null(-1).to_numpy(zero_copy_only=False) if row.is_valid else None for row in batch)
            yield pa.array([None if ids is None else letters.text(np.asarray(ids)) for ids in rows], pa.string())

    return decode(ids.cast("array<int>"))


def round_trip(text: Column, model: dict) -> Column:
    """struct<ids, decoded>: what ``encoded`` and then ``decoded`` give, by one worker."""

    @F.arrow_udf("ids array<int>, decoded string")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces, letters = Pieces(**model), Letters(model)
        for batch in batches:
            lists, texts = [], []
            for some in _together(batch):
                parts = pieces.ids_of(some)
                lists.append(_lists(parts))
                texts.append(pa.array([letters.text(np.frombuffer(p, np.int32)) for p in parts], pa.string()))
            ids = pa.concat_arrays(lists) if lists else pa.array([], pa.list_(pa.int32()))
            back = pa.concat_arrays(texts) if texts else pa.array([], pa.string())
            yield pa.StructArray.from_arrays([ids, back], ["ids", "decoded"])

    return both(text.cast("string"))


def encode_documents(docs: DataFrame, path: str = MODEL_PATH, text: str = "text", out: str = "ids") -> DataFrame:
    """Documents with ``out``, the piece ids of the whole text.

    Other columns stay; a column named ``out`` is replaced. Null and empty texts have an empty
    list, repeated rows the same list, an empty table gives no rows. Characters outside the
    vocabulary become bytes, or the unknown id where the model has no bytes. A task remembers about
    ``MEMORY`` bytes besides the words of the ``TEXTS`` texts at hand, whatever the input.
    """
    return docs.drop(*([out] if out != text else [])).withColumn(out, encoded(F.col(text), load_pieces(path)))


def decode_documents(rows: DataFrame, path: str = MODEL_PATH, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Rows with ``out``, the text of their ids; the inverse of ``encode_documents``, but that
    a mark in a text comes back as a space."""
    return rows.drop(*([out] if out != ids else [])).withColumn(out, decoded(F.col(ids), load_pieces(path)))
