"""Classifier, licences, pieces, near copies, vectors and language model against plain Python."""

import math
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loghaven.llm import gam, hnsw, jaccard, licenses, lm, pieces
from loghaven.llm.common import one_label
from loghaven.llm.components import connected
from loghaven.llm.shingles import Hasher, shingles

from .conftest import CLASHES, SMALL, odd_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


class Classes:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


# Components


def test_connected(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    pairs += [(5000, 5000 + i) for i in range(1, 200)] + [(7, 7), (None, 3), (1, 2), (2, 1)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = Classes()
    for a, b in pairs:
        if a is not None and a != b:
            want.join(a, b)
    assert got == {x: want.find(x) for x in want.up if want.find(x) != x}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


# Classifier


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = one_label(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "quality")
    stats = gam.with_stats(docs)
    rows = gam.classified(stats, gam.learn(stats, labels)).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.label for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_interaction_is_learned():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit(x, y)
    assert (0, 1) in {(i, j) for i, j, _ in model["pairs"]}
    fresh = rng.random((1000, 3))
    assert ((gam.predict(model, fresh) > 0.5) == ((fresh[:, 0] > 0.5) ^ (fresh[:, 1] > 0.5))).mean() > 0.9


def test_score_is_a_sum_of_looked_up_numbers():
    rng = np.random.default_rng(2)
    x = rng.random((500, 2))
    model = gam.fit(x, (x[:, 0] > 0.3).astype(float))
    for row in x[:20]:
        total = model["intercept"] + sum(t[sum(e < v for e in edges)] for v, edges, t in zip(row, model["edges"], model["tables"], strict=True))
        total += sum(t[sum(e < row[i] for e in model["pair_edges"][i]), sum(e < row[j] for e in model["pair_edges"][j])] for i, j, t in model["pairs"])
        assert gam.predict(model, row[None])[0] == pytest.approx(1 / (1 + math.exp(-total)))


def test_classifier_of_odd_rows(odd_docs, no_docs, no_labels):
    stats = gam.with_stats(odd_docs)
    got = gam.classified(stats, gam.learn(stats, no_labels))
    assert set(CLASHES) <= set(got.columns)
    assert [r.score for r in got.collect()] == [0.5] * len(odd_rows())
    empty = gam.with_stats(no_docs)
    assert gam.classified(empty, gam.learn(empty, no_labels)).count() == 0


# Licences


def test_phrases_at_every_place(small_docs, spark):
    texts = [r.text for r in small_docs.collect()] + [
        "Under the MIT license", "under the mit license under the mit LICENSE", "apache license, version 2.0; cc-by-nc", "the mit license",
        "under under the mit license\nxcc by nc", "cc by nc by nc cc by", None, "", "under the mitü license", "UNDER\x00THE MIT-LICENSE",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licenses.scan_licenses(docs).collect():
        words = LICENSE_WORD.findall(low(r.text))
        hits = [(label, i) for label, p in licenses.PHRASES for q in [p.split()] for i in range(len(words)) if words[i : i + len(q)] == q]
        firsts = [i for _, i in hits]
        assert r.n_words == len(words) and r.n_base == len(hits)
        assert (r.first_word, r.last_word) == (min(firsts, default=None), max(firsts, default=None))
        assert r.base_labels == ",".join(sorted({label for label, _ in hits}))
        assert 0 <= r.score <= 1 and (not hits or r.score == 1)


def test_matching_statistics():
    """The automaton's longest matches against all substrings of the templates."""
    automaton = licenses.Automaton((("p", "b c"),), (("t", "a b c a b d"), ("u", "c c a b d d"), ("t", "a b c a b d")))
    runs = {tuple(t[i:j]) for _, t in automaton.templates for i in range(len(t)) for j in range(i, len(t) + 1)}
    rng = np.random.default_rng(0)
    for _ in range(200):
        words = [bytes([w]) for w in rng.choice(list(b"abcd"), 12)]
        s = n = 0
        for i, w in enumerate(words):
            w = automaton.word[w]
            while s and w not in automaton.arcs[s]:
                s = automaton.link[s]
                n = automaton.length[s]
            if w in automaton.arcs[s]:
                s, n = automaton.arcs[s][w], n + 1
            assert n == max(k for k in range(i + 2) if tuple(words[i + 1 - k : i + 1]) in runs)


def test_templates_with_gaps_and_changes():
    automaton = licenses.Automaton()
    text = (
        b"Permission is hereby granted, free of charge and without fee, to any person obtaining a copy of this software "
        b"... redistribution and use in binary forms"
    )
    found = automaton.scan(licenses.words_of(text.decode()), 4, 6, 0.8)
    assert [(label, base) for label, base, *_ in found] == [("mit", False)] and found[0][2] == 0 and found[0][3] == 19


def test_licenses_of_odd_rows(odd_docs, no_docs):
    got = licenses.scan_licenses(odd_docs)
    assert set(CLASHES) - {"labels", "n_words", "spans", "score"} <= set(got.columns)
    assert got.where("n_base = 0 and labels = '' and score = 0").count() == len(odd_rows())
    assert licenses.scan_licenses(no_docs).count() == 0


# Pieces

needs_model = pytest.mark.skipif(not os.path.exists(pieces.MODEL_PATH), reason="no vocabulary")


@needs_model
def test_same_ids_as_the_library(small_docs, odd_docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    docs = small_docs.select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    for r in pieces.decode_documents(pieces.encode_documents(docs)).collect():
        assert r.ids == library.encode(r.text or "")
        assert r.decoded == (r.text or "").replace(pieces.MARK, " ")


@needs_model
def test_odd_texts_as_the_library():
    import random

    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    rng = random.Random(7)
    vocabulary = pieces.Pieces(**pieces.load_pieces())
    texts = ["   ", "a\nb  c", "▁a ▁▁ b", "the" * 40, "\x00\n\t", "aaaaaaaaaaaaaaa", "= = == === ===="]
    texts += ["".join(rng.choice("aeinst .▁\nth=é日") for _ in range(rng.randint(1, 40))) for _ in range(2000)]
    words = sorted({w for t in texts for w in vocabulary.marked(t)})
    code = dict(zip(words, vocabulary.encodings(words), strict=True))
    for t in texts:
        assert np.frombuffer(b"".join(code[w] for w in vocabulary.marked(t)), np.int32).tolist() == library.encode(t)


@needs_model
def test_unbroken_text():
    import random
    import tracemalloc

    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    vocabulary, rng = pieces.Pieces(**pieces.load_pieces()), random.Random(3)
    for letters, n in (("日本語の文章漢字かな", 20_000), ("日本語の文章漢字かな", 200_000), ("aeinstABC+/019", 200_000)):
        text = "".join(rng.choices(letters, k=n))
        tracemalloc.start()
        code = list(vocabulary.encodings(vocabulary.marked(text)))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 1000 * n  # carried ids would take bytes by the square of the length
        assert np.frombuffer(b"".join(code), np.int32).tolist() == library.encode(text)


def test_pairs_stay_apart_as_merged_alone():
    import random

    rng = random.Random(5)
    for _ in range(100):
        names = {*"abc", *("".join(rng.choices("abc", k=rng.randint(2, 5))) for _ in range(12))}
        model = pieces.Pieces({p: (i, -float(rng.randint(1, 5))) for i, p in enumerate(sorted(names))}, [], 99, pieces.BPE)
        whole = ["?", *(p for p in sorted(names) if model.merged(p) == [p])]
        assert all(model.stay_apart(a, b) == (model.merged(a + b) == [a, b]) for a in whole for b in whole)


@needs_model
def test_pairs_are_not_merged_one_by_one(monkeypatch):
    import random

    rng, calls, merged = random.Random(5), [], pieces.Pieces.merged
    monkeypatch.setattr(pieces.Pieces, "merged", lambda self, *a: calls.append(a) or merged(self, *a))
    vocabulary = pieces.Pieces(**pieces.load_pieces())
    list(vocabulary.encodings(sorted({"▁" + "".join(rng.choices("aeinrst", k=8)) for _ in range(5000)})))
    assert len(calls) < sum(map(len, vocabulary.apart.values())) / 2  # by piece, not by pair


@pytest.mark.parametrize("kind", [pieces.BPE, pieces.UNIGRAM])
def test_long_words_have_the_same_ids(monkeypatch, kind):
    names = ["▁", "a", "b", "▁a", "ab", "ba", "aba", "▁ab", "bb"]
    model = {p: (i, -float(1 + i)) for i, p in enumerate(names)}
    words = sorted({"▁" + "".join(w) for n in range(1, 8) for w in __import__("itertools").product("ab?", repeat=n)})
    want = list(pieces.Pieces(model, [], 99, kind).encodings(words))
    monkeypatch.setattr(pieces, "LONG", 4)
    assert list(pieces.Pieces(model, [], 99, kind).encodings(words)) == want


def test_unigram_model_against_all_segmentations():
    scores = {"▁": -3.0, "▁a": -2.0, "a": -4.0, "b": -4.5, "ab": -3.5, "▁ab": -6.1, "ba": -5.0, "aba": -6.5, "bb": -7.0}
    model = pieces.Pieces({p: (i, s) for i, (p, s) in enumerate(scores.items())}, [], 99, pieces.UNIGRAM)

    def cuts(word):
        return [[]] if not word else [[word[:n], *rest] for n in range(1, len(word) + 1) if word[:n] in scores for rest in cuts(word[n:])]

    words = sorted({"▁" + "".join(w) for n in range(1, 7) for w in __import__("itertools").product("ab", repeat=n)})
    names = list(scores)
    for word, code in zip(words, model.encodings(words), strict=True):
        got = [names[i] for i in np.frombuffer(code, np.int32)]
        assert "".join(got) == word
        assert sum(scores[p] for p in got) == pytest.approx(max(sum(scores[p] for p in c) for c in cuts(word)))
    assert [np.frombuffer(c, np.int32).tolist() for c in model.encodings(["?a"])] == [[99, names.index("a")]]


@needs_model
def test_forgetful_encoding(small_docs, monkeypatch):
    want = {r.doc_id: r.ids for r in pieces.encode_documents(small_docs).collect()}
    monkeypatch.setattr(pieces, "MEMORY", 50)
    monkeypatch.setattr(pieces, "TEXTS", 3)
    assert {r.doc_id: r.ids for r in pieces.encode_documents(small_docs).collect()} == want


@needs_model
def test_pieces_of_odd_rows(odd_docs, no_docs):
    got = pieces.encode_documents(odd_docs)
    assert set(got.columns) == set(odd_docs.columns)
    assert {r.doc_id: r.ids for r in got.where("doc_id in (4, 5)").collect()} == {4: [], 5: []}
    assert pieces.encode_documents(no_docs).count() == 0


# Near copies


def set_of(text, n):
    words = WORD.findall(low(text))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


def brute_classes(rows, n, share, whole):
    sets = [set_of(t, n) for _, t in rows]
    classes = Classes()
    for a in range(len(rows)):
        classes.find(a)
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and whole * common >= share * (len(sets[a]) + len(sets[b]) - common):
                classes.join(a, b)
    members = defaultdict(list)
    for a, (i, _) in enumerate(rows):
        members[classes.find(a)].append(i)
    least = {c: min((i for i in ids if i is not None), default=None) for c, ids in members.items()}
    return sorted(((i, len(s), least[classes.find(a)]) for a, ((i, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


@pytest.mark.parametrize(("n", "similarity"), [(3, (90, 100)), (5, (80, 100))])
def test_classes(spark, small_docs, odd_docs, n, similarity):
    rows = [(r.doc_id, r.text) for r in small_docs.collect()] + [(None if i is None else 1000 + i, t) for i, t, _ in odd_rows()]
    got = jaccard.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"), n, similarity)
    assert sorted(map(tuple, got.collect()), key=str) == brute_classes(rows, n, *similarity)


def varied(seed, count, words, most):
    """Copies of one text, each with up to ``most`` words changed."""
    rng = np.random.default_rng(seed)
    base = prose(seed, words).split()
    out = []
    for i in range(count):
        text = list(base)
        for at in rng.choice(words, rng.integers(0, most + 1), replace=False):
            text[at] = f"x{rng.integers(0, 40)}"
        out.append(" ".join(text[: words - rng.integers(0, 3)]))
    return out


@pytest.mark.parametrize("chunk", [1 << 17, 2000])
@pytest.mark.parametrize(("n", "similarity"), [(3, (90, 100)), (5, (80, 100))])
def test_classes_of_many_near_copies(spark, monkeypatch, chunk, n, similarity):
    monkeypatch.setattr(jaccard, "CHUNK_TOKENS", chunk)
    monkeypatch.setattr(jaccard, "HITS", 5000)
    texts = varied(1, 60, 80, 6) + varied(2, 40, 30, 2) + varied(3, 30, 12, 1) + [prose(5, k) for k in range(1, 30)]
    passage = prose(9, 60)
    texts += [passage + " " + prose(100 + i, 20) for i in range(25)] + ["a b c d e f"] * 5
    rows = list(enumerate(texts))
    got = jaccard.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), n, similarity)
    assert sorted(map(tuple, got.collect()), key=str) == brute_classes(rows, n, *similarity)


@pytest.mark.parametrize(("share", "whole"), [(90, 100), (80, 100), (50, 100)])
def test_similar_sets_have_a_mark_in_common(share, whole):
    rng, classes, seen = np.random.default_rng(4), jaccard.Classes(share, whole), 0
    for _ in range(1500):
        n = int(np.exp(rng.uniform(0, 6))) + 1
        tokens = rng.integers(0, 2**48, 2 * n, dtype=np.uint64)
        cut, more = rng.integers(0, max(1, n // 4) + 1, 2)
        a, b = np.unique(tokens[:n]), np.unique(np.r_[tokens[cut:n], tokens[n : n + more]])
        common = len(np.intersect1d(a, b))
        if len(b) and whole * common >= share * (len(a) + len(b) - common) and not np.array_equal(a, b):
            seen += 1
            (of_a, need_a), (of_b, need_b) = (jaccard.part_marks(x, classes) for x in (a, b))
            assert len(np.intersect1d(of_a, of_b)) >= max(need_a, need_b) >= 1
    assert seen > 100


def test_shingles_are_those_of_the_words():
    hasher = Hasher()
    for text in ["a b c a b c", "A b\tC\x0b a b c", "x", "", None, "é É e", "a  b " * 30_000]:
        words = WORD.findall(low(text))
        assert len(hasher.words(text)) == len(words) and len(shingles(hasher.words(text), 3)) == len(set_of(text, 3))
    assert hasher.words("Ab")[0] == hasher.words("x aB")[1] != hasher.words("ab c")[1]


def test_without_near_copies(odd_docs, no_docs):
    got = jaccard.without_near_copies(odd_docs)
    assert got.columns == odd_docs.columns
    want = Counter(i for i, _, _ in odd_rows())
    for gone in (2, 3, 10):
        del want[gone]
    assert Counter(r.doc_id for r in got.collect()) == want
    assert jaccard.without_near_copies(no_docs).count() == 0


def test_without_near_copies_by_row(spark):
    """Rows without an id, or with an id of two texts, go by their own text."""
    a, b, c, d = (prose(200 + i, 40) for i in range(4))
    rows = [(3, a, "x"), (7, a, "y"), (7, b, "z"), (None, a, "n"), (None, c, "m"), (None, d, "p"), (None, d, "p"), (None, "", "e"), (None, None, "f")]
    rows += [(None, c + " more", "near"), (3, a, "x")]
    got = jaccard.without_near_copies(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3), one_row=True)
    found = Counter(tuple(r) for r in got.collect())
    near = Counter(t for i, t, _ in found.elements() if t in (c, c + " more"))
    assert sum(near.values()) == 1
    rest = Counter({r: n for r, n in found.items() if r[1] not in near})
    assert rest == Counter([(3, a, "x"), (7, b, "z"), (None, d, "p"), (None, "", "e"), (None, None, "f")])


# Vectors


def brute_links(rows, cosine=0.98):
    classes, links = Classes(), Counter()
    unit = []
    for _, e, label in rows:
        x = None if e is None or label is None or any(v is None for v in e) else np.array(e, np.float64)
        ok = x is not None and len(x) and np.isfinite(x).all() and x.any()
        unit.append(x / np.linalg.norm(x) if ok else None)
    for a in range(len(rows)):
        classes.find(a)
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine:
                links[a] += 1
                links[b] += 1
                classes.join(a, b)
    least = defaultdict(list)
    for a, r in enumerate(rows):
        least[classes.find(a)].append(r[0])
    return [(r[0], links[a], min(least[classes.find(a)])) for a, r in enumerate(rows)]


@pytest.mark.parametrize("shard_nodes", [8192, 60])
def test_vectors(spark, shard_nodes):
    rng = np.random.default_rng(8)
    rows = []
    for c in range(40):
        center = rng.normal(size=24)
        rows += [(center + rng.normal(size=24) * 0.12 * rng.random(), c % 3) for _ in range(rng.integers(1, 14))]
    rows = [(i, [float(v) for v in x.astype(np.float32)], label) for i, (x, label) in enumerate(rows)]
    same = rows[5][1]
    rows += [(2000 + i, same, rows[5][2]) for i in range(30)] + [(3000, same, None), (3001, None, 1), (3002, [], 1), (3003, [0.0] * 24, 1)]
    rows += [(3004, [float("nan")] * 24, 1), (3005, [None] * 24, 1), (3006, [float("inf")] + same[1:], 1), (3007, [2 * v for v in same], rows[5][2])]
    rows += [(3008, same[:12], rows[5][2])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("node", F.lit("x"))
    got = {r.vec_id: r for r in hnsw.vector_classes(docs.repartition(3), shard_nodes=shard_nodes).collect()}
    assert len(got) == len(rows)
    for i, links, least in brute_links(rows):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (links, least, i == least)


def test_recall_on_given_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [tuple(r) for r in vectors.select("vec_id", "embedding", "label").collect()]
    got = {r.vec_id: r.n_links for r in hnsw.vector_classes(vectors, cosine=0.6).collect()}
    label = np.array([r[2] for r in rows])
    x = np.array([r[1] for r in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.6) & (label[:, None] == label[None, :])
    true = near.sum(axis=1) - 1
    found = np.array([got[r[0]] for r in rows])
    assert (found <= true).all() and found.sum() >= 0.9 * true.sum()


def test_no_vectors(spark):
    assert hnsw.vector_classes(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


# Language model


def scores_by_hand(rows, modulus, share):
    tokens = [WORD.findall(low(t)) + [None] for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % modulus == 0 for i, _ in rows]
    count = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    n, v = sum(count.values()), len(count)
    states = {w for w, c in count.items() if c >= share * max(n, 1)}
    pairs = Counter((a, b) for t, h in zip(tokens, held, strict=True) if not h for a, b in zip(t, t[1:], strict=False) if a in states and b in states)
    pairs = {p: c for p, c in pairs.items() if c >= lm.MIN_PAIR}
    mass = Counter()
    for (a, _), c in pairs.items():
        mass[a] += c - lm.DISCOUNT
    out = []
    for (i, _), t, h in zip(rows, tokens, held, strict=True):
        base = model = 0.0
        for a, b in zip([0, *t], t, strict=False):
            p = (count[b] + 0.1) / (n + 0.1 * (v + 1))
            base += math.log10(p)
            if a in states and a != 0:
                p = p * (1 - mass[a] / count[a]) + ((pairs[a, b] - lm.DISCOUNT) / count[a] if (a, b) in pairs else 0)
            model += math.log10(p)
        out.append((i, h, len(t), sum(count[w] > 0 for w in t), n, base, model))
    return out


@pytest.mark.parametrize(("share", "docs_of_a_block"), [(2e-5, 2000), (2e-3, 7)])
def test_lm_scores(spark, small_docs, monkeypatch, share, docs_of_a_block):
    monkeypatch.setattr(lm, "BLOCK_DOCS", docs_of_a_block)
    rows = [(r.doc_id, r.text) for r in small_docs.collect()] + [(None if i is None else 1000 + i, t) for i, t, _ in odd_rows()]
    got = lm.lm_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), state_share=share).collect()
    want = scores_by_hand(rows, 10, share)
    for r, w in zip(sorted(map(tuple, got), key=str), sorted(want, key=str), strict=True):
        assert r[:5] == w[:5] and r[5:] == pytest.approx(w[5:], rel=1e-9)


def test_lm_pairs_of_rare_words(spark):
    """Pairs count however small a share of the training words their words hold."""
    rows = [(i, "the " * 25_000) for i in range(12)] + [(100 + i, f"the rare pair the {'odd' * (i % 2)} end") for i in range(4)]
    got = lm.lm_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = scores_by_hand(rows, 10, 0)
    for r, w in zip(sorted(map(tuple, got), key=str), sorted(want, key=str), strict=True):
        assert r[:5] == w[:5] and r[5:] == pytest.approx(w[5:], rel=1e-9)


def test_model_beats_its_base_on_held_out_texts(spark):
    rows = lm.lm_scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out")
    r = rows.agg(F.sum("score").alias("model"), F.sum("base_score").alias("base")).first()
    assert r.model > r.base


def test_state_probabilities_sum_to_one():
    words = np.arange(1, 6, dtype=np.uint64)
    counts = np.array([10, 20, 5, 3, 0])
    states, of = words[:2], counts[:2].astype(float)
    pairs, pair_counts = np.array([0, 1, 2]), np.array([4, 3, 1])  # 1-1, 1-2, 2-1; the last is too rare
    failure = np.array([1 - (4 + 3 - 2 * lm.DISCOUNT) / 10, 1.0])
    model = {"n": 38, "v": 4, "states": states, "state_counts": of, "failure": failure}
    automaton = lm.Automaton(words, counts, pairs, pair_counts, model)
    for before in range(5):
        p = [10 ** automaton.read(np.array([before, b]), np.array([2]))[2][1] for b in range(5)]
        assert sum(p) == pytest.approx(1.0)  # the word without a count stands for all unknown ones


def test_lm_of_nothing(no_docs, spark):
    assert lm.lm_scores(no_docs).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = lm.lm_scores(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0)


def test_distinct_pairs_of_a_block_are_sorted_out_in_the_time_of_a_sort():
    import time

    rng, times = np.random.default_rng(3), {}
    words = np.sort(rng.integers(0, 1 << 63, 200_000).astype(np.uint64))
    tokens, sizes = rng.integers(0, len(words), 1_000_000), np.array([400_000, 600_000])
    pair = np.delete(tokens[:-1] * len(words) + tokens[1:], 399_999)
    for _ in range(3):
        for name, run in (("sort", lambda: np.unique(pair, return_inverse=True)), ("pairs", lambda: lm._pairs_of(tokens, sizes, words.tobytes(), None))):
            began = time.process_time()
            got = run()
            times.setdefault(name, []).append(time.process_time() - began)
    assert (got[2] == np.unique(pair, return_inverse=True)[0]).all()
    assert min(times["pairs"]) < 5 * min(times["sort"])
