"""Exact top-k search, phrases and conversation repair against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loghaven.llm import phrases, repair, vafile

# Exact top-k search


def top_by_hand(rows, k=5, modulus=50):
    import math

    vectors = []
    for vec_id, x in rows:
        if x is not None and all(v is not None and math.isfinite(v) for v in x):
            vectors.append((vec_id, [math.floor(256 * float(v)) for v in x]))
    out = []
    for i, (q, a) in enumerate(vectors):
        if q is not None and q % modulus == 0:
            found = [(-sum(x * y for x, y in zip(a, b)), v is None, v or 0, v) for j, (v, b) in enumerate(vectors) if j != i]
            out += [(q, r + 1, v, -s) for r, (s, _, _, v) in enumerate(sorted(found, key=lambda t: t[:3])[:k])]
    return Counter(out)


def found(spark, rows, **more):
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, place string, rank string")
    return Counter(tuple(r) for r in vafile.top_k(table, **more).collect())


def test_top_k(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(np.float32(v)) for v in rng.normal(0, 0.2, 12)]) for i in range(400)]
    hot = rows[3][1]
    rows += [(1000 + i, hot) for i in range(150)]  # a third of all rows is one vector, and asks
    rows += [(5000, None), (5050, []), (5100, [1.0, None]), (5150, [float("nan")] * 12), (5200, [float("inf")] * 12), (None, hot), (None, rows[8][1])]
    rows += [(50, rows[50][1]), (50, rows[50][1]), (-50, rows[7][1]), (5250, [0.5, -0.25]), (5300, [0.0] * 12), (5350, [3.0] * 30)]
    assert found(spark, rows) == top_by_hand(rows)
    assert found(spark, rows, cells=4, k=3) == top_by_hand(rows, k=3)


def test_top_k_of_few_and_of_extreme_rows(spark):
    assert found(spark, []) == Counter()
    assert found(spark, [(0, [1.0])]) == Counter()
    assert found(spark, [(0, [1.0]), (1, [2.0])]) == Counter([(0, 1, 1, 256 * 512)])
    huge = [(0, [3e36, 1.0]), (1, [3e36, 0.0]), (2, [-3e36, 0.0])]
    assert [r[2] for r in sorted(found(spark, huge))] == [1, 2]


def test_bounds_hold_every_score():
    rng = np.random.default_rng(4)
    vectors, queries = rng.integers(-300, 300, (500, 16)), rng.integers(-300, 300, (20, 16))
    for cells in (2, 16, 256):
        upper, width = vafile.bounds(queries, *vafile.approximate(vectors, cells))
        score = queries @ vectors.T
        assert (score <= upper).all() and (score >= upper - width[:, None]).all()
    wide = np.array([[-(2**62), 2**62], [2**62, -(2**62)]])
    upper, width = vafile.bounds(wide, *vafile.approximate(wide))
    score = wide.astype(object) @ wide.T.astype(object)
    assert (score <= upper).all() and (score >= upper - width[:, None]).all()


def test_few_exact_vectors_are_read(spark):
    rows = spark.range(4000).select(F.col("id").alias("vec_id"), F.transform(F.sequence(F.lit(1), F.lit(16)), lambda i: F.randn(7) * 0 + F.sin(F.col("id") * i)).alias("embedding"))
    entries = vafile.entries_of(vafile.integer_rows(rows), 5, 50).cache()
    hits = vafile.scanned(vafile.approximation_file(entries), vafile.query_blocks(entries), 6)
    assert hits.count() == 80
    assert hits.agg(F.sum(F.size("places"))).first()[0] < 0.05 * 80 * 4000
    entries.unpersist()


# Phrases


def phrases_by_hand(docs, least=30, top=2000):
    counts, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    often = {(g, p): a for (g, p), a in counts.items() if len(p) > 1 and a >= least}
    inside = defaultdict(int)
    for (g, p), a in often.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                inside[g, p[i : i + size]] = max(inside[g, p[i : i + size]], a)
    rows = defaultdict(list)
    for (g, p), a in often.items():
        cuts = [(2000000 * a // (counts[g, p[:k]] + counts[g, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        if 100 * inside[g, p] < 80 * a:
            rows[g].append((-score, -a, " ".join(p).encode(), counts[g, p[:k]], counts[g, p[k:]]))
    out = set()
    for g, found in rows.items():
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top]):
            out.add((g, rank + 1, p.decode(), -a, left, right, n[g], -score))
    return out


def mined(spark, docs, **more):
    table = spark.createDataFrame([(*d, "x", "y", 1) for d in docs], "lang string, text string, phrase string, rank string, n int")
    return {tuple(r) for r in phrases.collocations(table, **more).collect()}


@pytest.fixture(scope="module")
def chatter():
    rng = random.Random(11)
    words = ["the", "of", "Ünï", "日本", "a" * 40, "x\x00y", "😀", *[f"w{i}" for i in range(40)]]
    docs = [(rng.choice(["en", "de", None, "und"]), " ".join(rng.choice(words) + rng.choice(["", "", "", ".", ",\n", "\t", "  "]) for _ in range(rng.randint(1, 300)))) for _ in range(120)]
    docs += [("en", "New York City Hall is here; New York City.")] * 60 + [("en", "one long piece without any stop " * 3000)]
    docs += [("en", None), ("en", ""), (None, " \t. ,"), ("fr", "ONE"), ("en", "The THE the"), ("en", "no words in common\x0bwith\x0cothers")]
    return docs


def test_phrases(spark, chatter):
    got = mined(spark, chatter)
    assert got == phrases_by_hand(chatter)
    assert any(r[2] == "new york city hall" for r in got) and not any(r[2] == "york city" for r in got)


def test_phrases_in_small_slices_blocks_and_parts(spark, chatter, monkeypatch):
    for name, value in (("SLICE", 500), ("MERGED", 5000), ("BLOCK_CHARS", 4000), ("PART_HASHES", 300)):
        monkeypatch.setattr(phrases, name, value)
    assert mined(spark, chatter, least=5, top=50) == phrases_by_hand(chatter, 5, 50)


def test_no_phrases(spark):
    assert mined(spark, []) == set()
    assert mined(spark, [("en", None), (None, "a few words")]) == set()


def test_chunks_cut_copies_alike():
    rng = random.Random(3)
    passage = " ".join(f"w{rng.randint(0, 500)}" for _ in range(400))
    texts = [f"{' '.join(f'v{rng.randint(0, 99)}' for _ in range(k))} {passage}" for k in (0, 7, 33)]
    cut = [set(phrases.chunks_of(t.encode())[0].to_pylist()) for t in texts]
    assert len(cut[0] & cut[1] & cut[2]) >= len(cut[0]) - 3 and len(cut[0]) > 10


# Conversation repair

STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def _insertions(ways):
    for _ in range(2):
        for q, (cost, audit, out) in list(ways.items()):
            for role in ("user", "assistant"):
                to = STEP.get((q, role[0]))
                new = (cost + 3, audit + "I", (*out, (role, "")))
                if to is not None and (to not in ways or new[:2] < ways[to][:2]):
                    ways[to] = new
    return ways


def repaired_by_hand(rows):
    conversations, ids = defaultdict(list), set()
    for conv, turn, role, text in rows:
        ids.add(conv)
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        conversations[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv in ids:
        found = sorted(conversations[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, faults, ways = set(), Counter(), {0: (0, "", ())}
        for _, role, text in found:
            last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated"
            faults[fault] += 1
            seen.add((role, text))
            after = {}
            for q, (cost, audit, so_far) in _insertions(dict(ways)).items():
                more = 3 * (fault == "truncated")
                edits = [(q, 4, "D", ())]
                if fault in ("", "truncated"):
                    edits += [(STEP.get((q, role[:1])), more, "K", ((role, text),))]
                    edits += [(STEP.get((q, r[0])), 3 + more, "R", ((r, text),)) for r in ("user", "assistant")]
                for to, price, edit, message in edits:
                    new = (cost + price, audit + edit, so_far + message)
                    if to is not None and (to not in after or new[:2] < after[to][:2]):
                        after[to] = new
            ways = after
        ways = _insertions(dict(ways))
        cost, audit, so_far = min((ways[q] for q in (0, 3) if q in ways), key=lambda w: w[:2])
        turns = [t for t, _, _ in found if t is not None]
        initials = [r[:1] for _, r, _ in found]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        text = "\n".join(f"{r}:{t}" for r, t in so_far)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()), so_far
    return out


def chats(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, number int")


@pytest.fixture(scope="module")
def broken_chats():
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "tool", "user", "assistant", None, "", "User"]
    rows = []
    for conv in [None, *range(50)]:
        for i in range(3000 if conv == 7 else rng.choice([1, 2, 3, 5, 9, 40])):  # one holds most rows
            text = rng.choice([None, "", "Hi.", "Ho!", "cut", "a. ", " \x0b ", f"n{i}.", f"n{i}?", f"m{i}", f"k{i} 日本."])
            rows.append((conv, rng.choice([None, i, i, i, i // 2]), rng.choice(roles), text))
    rows += [(90, 1, "user", "word " * 60_000 + "end."), (91, None, "user", None), *[(92, 4, "user", "Same.")] * 2500]
    return rows + rows[:40]


def test_repair(spark, broken_chats):
    table = chats(spark, broken_chats)
    got = {r[0]: tuple(r)[1:] for r in repair.repair_summaries(repair.damaged(table), table).collect()}
    assert got == {conv: row for conv, (row, _) in repaired_by_hand(broken_chats).items()}
    assert all(re.fullmatch("[KRDI]*", row[6]) for row in got.values())


def test_repaired_messages(spark, broken_chats):
    rows = [r for r in broken_chats if r[0] not in (7, 92)]
    got = defaultdict(dict)
    for r in repair.repaired_messages(repair.damaged(chats(spark, rows))).collect():
        got[r.conv_id][r.position] = (r.role, r.text)
    want = {conv: so_far for conv, (_, so_far) in repaired_by_hand(rows).items() if so_far}
    assert {conv: tuple(x for _, x in sorted(m.items())) for conv, m in got.items()} == want
    order = {conv: "".join(role[:1] for role, _ in m) for conv, m in want.items()}
    assert all(re.fullmatch("(s?(ua)+)?", x) for x in order.values())


def test_repair_without_rows(spark):
    none = chats(spark, [])
    assert repair.repair_summaries(repair.damaged(none), none).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    table = chats(spark, [(gone, 0, "user", "Hi.")])
    row = repair.repair_summaries(repair.damaged(table), table).first()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_rules_shorten_segments_and_change_no_result(spark):
    rng = random.Random(8)
    shapes = sorted({"".join(rng.choice("ABCBC") for _ in range(rng.randint(1, 60))) for _ in range(300)})
    table = spark.createDataFrame([(s,) for s in shapes], "symbols string")
    rules = repair.grammar(table)
    assert 0 < len(rules) <= repair.ROUNDS * repair.ROUND_RULES
    assert sum(len(repair.compressed(s, rules)) for s in shapes) < 0.4 * sum(map(len, shapes))
    by_rules = {r.symbols: tuple(r) for r in repair.evaluated(table, rules).collect()}
    assert by_rules == {r.symbols: tuple(r) for r in repair.evaluated(table, []).collect()}


def test_ropes():
    rng = random.Random(1)
    texts = ["".join(rng.choice("DK") for _ in range(rng.randint(0, 90))) for _ in range(60)]
    ropes = []
    for text in texts:
        rope = repair.Rope()
        while text:
            n = rng.randint(1, 20)
            rope, text = rope + repair.Rope(text[:n]), text[n:]
        ropes.append(rope)
    assert [str(r) for r in ropes] == texts
    assert all((a < b) == (x < y) for a, x in zip(ropes, texts) for b, y in zip(ropes, texts))
