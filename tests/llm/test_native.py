"""Mixing, rules, sharding and quotes against plain Python."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from loghaven.llm import mixing, quality_rules, quotes, sharding
from loghaven.llm.common import one_label
from loghaven.llm.text_stats import with_text_stats

from .conftest import CLASHES, SMALL, odd_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """The sharing as a loop: give by weight, stop what is above, share again."""
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full = set()
    while True:
        left = share * sum(sizes.values()) - sum(cap * sizes[s] for s in full)
        per = left / max(1e-300, sum(weight[s] for s in names if s not in full))
        over = [s for s in names if s not in full and per * weight[s] > cap * sizes[s]]
        if not over:
            return {s: cap * sizes[s] if s in full else per * weight[s] for s in names}
        full |= set(over)


@pytest.mark.parametrize("bits", [10, 2])
def test_mix(spark, small_docs, bits):
    got = mixing.mix_sources(small_docs, bits=bits)
    no_python(got)
    rows = got.collect()
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in rows:
        assert r.size == len(WORD.findall(r.text)) and 0 <= r.copies <= 2
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
        largest[r.source] = max(largest[r.source], r.size)
    want = targets(sizes)
    assert {(r.source, r.source_size) for r in rows} == set(sizes.items())
    for r in rows:
        assert r.target == pytest.approx(want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]
    assert sum(taken.values()) <= sum(want.values()) + 1e-6
    assert sorted(got.select("doc_id", "copies").collect()) == sorted((r.doc_id, r.copies) for r in rows)


def test_mix_with_one_hot_source_and_low_share(spark):
    rows = [(i, prose(i, 5 + i % 7), "hot" if i % 3 else f"s{i % 9}") for i in range(300)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), share=0.5).collect()
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
    want = targets(sizes, share=0.5)
    assert all(abs(taken[s] - want[s]) <= 11 for s in sizes)


def test_mix_of_odd_rows(odd_docs, no_docs):
    got = mixing.mix_sources(odd_docs)
    assert set(got.columns) == {*odd_docs.columns, "source_size"}
    rows = got.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((i, t) for i, t, _ in odd_rows())
    assert all(r.copies == 0 and r.size == 0 for r in rows if r.doc_id in (4, 5, 6))
    repeated = [r.copies for r in rows if r.doc_id == 7]
    assert repeated[0] == repeated[1]
    assert mixing.mix_sources(no_docs).count() == 0


def stats_of(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


TEXTS = [
    None, "", " ", "a", "a b c d e f g h", "a b c d e f g h i", " ".join("abcdefgh") + " " + " ".join("abcdefgh"), "x " * 9, "x " * 500,
    "a\nb\na\n\n\n \nb a", "#|<> ** é ü &&", " ".join(map(str, range(100))) + " 3 4 5 6 7 8 9 10 11 12 z " + " ".join(map(str, range(50))),
]


def test_text_stats(spark, small_docs):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + r.doc_id, r.text) for r in small_docs.collect()]
    got = with_text_stats(spark.createDataFrame(rows, "doc_id long, text string"))
    no_python(got)
    for r in got.collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == stats_of(r.text), r.text


def labelled(spark, n=600):
    rows = [(i, i % 3 == 0, (5.0 if i % 3 == 0 else 1.0) + (i * 37 % 100) / 100, (i * 61 % 97) / 97.0) for i in range(n)]
    return spark.createDataFrame([(i, int(b), x, y) for i, b, x, y in rows], "key long, bad int, x double, y double")


def test_rules_find_the_separating_threshold(spark):
    rules = quality_rules.learn_rules(labelled(spark), stats=("x", "y"))
    assert [str(c) for c in rules[0]] and {c.stat for c in rules[0]} == {"x"}
    kept = labelled(spark).withColumn("kept", quality_rules.kept_by(rules)).groupBy("bad", "kept").count().collect()
    assert {(r.bad, r.kept) for r in kept} == {(0, True), (1, False)}


def test_rules_without_use(spark):
    rows = labelled(spark)
    assert quality_rules.learn_rules(rows.where("bad = 0"), stats=("x", "y")) == []
    assert quality_rules.learn_rules(rows.where("bad = 1"), stats=("x", "y")) == []
    assert quality_rules.learn_rules(rows.limit(0), stats=("x", "y")) == []
    noise = rows.withColumn("bad", F.pmod(F.xxhash64("key"), F.lit(2)).cast("int"))
    assert len(quality_rules.learn_rules(noise, stats=("x", "y"))) <= 1


def test_quality_rules(spark, small_docs):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    got, _ = quality_rules.quality_rules(small_docs, one_label(labels, "quality"))
    no_python(got)
    assert got.columns[: len(small_docs.columns)] == small_docs.columns
    for r in got.collect():
        n, _, _, _, repeated = stats_of(r.text)
        assert r.base_failed == (n < 20 or 100 * repeated > 30 * n) and not (r.base_failed and r.kept)


def test_quality_rules_of_odd_rows(odd_docs, no_docs, no_labels):
    got, rules = quality_rules.quality_rules(odd_docs, no_labels)
    assert rules == [] and got.count() == len(odd_rows()) and set(CLASHES) <= set(got.columns)
    assert {r.doc_id for r in got.where("kept").collect()} == {1, 2, 3, 7, 8, None}
    assert quality_rules.quality_rules(no_docs, no_labels)[0].count() == 0


def test_one_label(spark):
    rows = [(1, 1), (1, 0), (2, 1), (2, 1), (3, None), (None, 1)]
    got = one_label(spark.createDataFrame(rows, "doc_id long, quality int"), "quality").collect()
    assert {tuple(r) for r in got} == {(1, 0), (2, 1)}


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_shards(small_docs, shards):
    got = sharding.shard_rows(small_docs, shards=shards)
    no_python(got)
    text = {r.doc_id: r.text for r in small_docs.collect()}
    slots = defaultdict(list)
    for r in got.collect():
        data = text[r.doc_id].encode()
        assert (r["size"], r.text_crc32) == (len(data) + 16, zlib.crc32(data))
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_few_documents_move_to_a_new_shard(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    before, after = ({r.doc_id: r.shard for r in sharding.shard_rows(docs, shards=n).collect()} for n in (40, 41))
    moved = sum(before[i] != after[i] for i in before)
    assert moved < 0.35 * len(before)


def test_place_cells_is_whole():
    counts = {c: (c * 7919) % 13 + 50 * (c == 5) for c in range(64)}
    placed = sharding.place_cells(counts, 6, 8, 64)
    used = Counter()
    for cell, n in counts.items():
        parts = sorted((a, b) for c, a, b, _, _ in placed if c == cell)
        assert [x for a, b in parts for x in range(a, b)] == list(range(n))
    for _, a, b, shard, slot in placed:
        assert slot == used[shard]
        used[shard] += b - a
    assert max(used.values()) - min(used.values()) <= 1


def test_shards_of_odd_rows(odd_docs, no_docs):
    got = sharding.shard_rows(odd_docs, shards=3).collect()
    assert len(got) == len(odd_rows()) and len({(r.shard, r.slot) for r in got}) == len(got)
    assert {(r["size"], r.text_crc32) for r in got if r.doc_id in (4, 5)} == {(16, 0)}
    assert sharding.shard_rows(no_docs).count() == 0


CHAT = [
    (1, 0, "user", "How do I start?\nPlease help."),
    (1, 1, "assistant", "Open the lid.\nPress the button."),
    (1, 2, "user", "> How do I   START?\nNever mind."),
    (1, 3, "assistant", ">> How do I start?\n> Never mind.\nFine then."),
    (1, 4, "user", "> Press the button.\n>> How do I start?\nWhich one?"),
    (1, 5, "user", "> nobody said this\nHello"),
    (2, 0, "user", "Press the button."),
    (2, 7, None, None),
    (None, 0, "user", "> Press the button."),
    (3, None, "user", "> a"),
    (3, 1, "user", "a"),
    (3, 1, "user", "a"),
    (3, 2, "system", ">a\n\n> a"),
]


@pytest.mark.parametrize("turns_of_a_slice", [4096, 2])
def test_quotes(spark, monkeypatch, turns_of_a_slice):
    monkeypatch.setattr(quotes, "SLICE", turns_of_a_slice)
    docs = spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string").withColumn("body", F.lit("x"))
    got = quotes.format_chats(docs)
    no_python(got)
    rows = got.collect()
    assert len(rows) == len(CHAT)
    at = {(r.conv_id, r.turn): r for r in rows}
    assert [at[1, t].reply_to for t in range(6)] == [None, 0, 0, 2, 1, 4]
    assert (at[1, 3].n_quoted, at[1, 3].n_linked) == (2, 2) and (at[1, 5].n_quoted, at[1, 5].n_linked) == (1, 0)
    assert at[1, 4].formatted == "<|user|>\nWhich one?\n<|end|>"
    assert at[2, 7].reply_to == 0 and at[2, 7].formatted == "<|user|>\n\n<|end|>"
    assert at[None, 0].reply_to is None and at[None, 0].n_linked == 0
    assert at[3, 2].reply_to == 1 and at[3, 2].n_quoted == 1 and at[3, None].position == 0
    for conv in (1, 2, 3, None):
        mine = sorted((r for r in rows if r.conv_id == conv), key=lambda r: r.position)
        assert [r.position for r in mine] == list(range(len(mine)))
        assert [r.turn for r in mine if r.turn is not None] == sorted(r.turn for r in mine if r.turn is not None)
    assert quotes.format_chats(docs.limit(0)).count() == 0


def test_votes_of_all_earlier_messages(spark, monkeypatch):
    chats = [
        (1, 1, "alpha one\n\nbeta two"),
        (1, 2, "alpha one\n\ngamma three"),
        (1, 3, "> alpha one\n\n> beta two\nyes"),
        (1, 4, "thanks"),
        (1, 5, "> gamma three\n> thanks"),
        (1, 6, "a passage that runs\nover two lines\n\nthanks"),
        (1, 7, "other words"),
        (1, 8, "> a passage\n> that runs over\n> TWO lines\nno"),
    ]
    got = quotes.format_chats(spark.createDataFrame([(c, t, "user", x) for c, t, x in chats], "conv_id long, turn long, role string, text string"))
    at = {r.turn: r for r in got.collect()}
    assert at[3].reply_to == 1  # both lines, where the last holder of alpha has one
    assert at[5].reply_to == 4  # one line each: the later one
    assert at[8].reply_to == 6 and (at[8].n_quoted, at[8].n_linked) == (3, 3)


@pytest.mark.parametrize("turns_of_a_slice", [4096, 3])
def test_votes_against_plain_python(spark, monkeypatch, turns_of_a_slice):
    import random

    monkeypatch.setattr(quotes, "SLICE", turns_of_a_slice)
    rng = random.Random(5)
    chats = []
    for conv in range(3):
        for turn in range(30):
            own = rng.sample("abcdef", rng.randint(1, 4))
            said = rng.sample("abcdef", rng.randint(0, 3))
            chats.append((conv, turn, own, said))
    # Blank lines between, so that each line is a passage of its own.
    rows = [(c, t, "user", "\n\n".join([*(f"> {x}" for x in said), *own])) for c, t, own, said in chats]
    got = quotes.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    reply = {(r.conv_id, r.turn): r.reply_to for r in got.collect()}
    for conv, turn, _, said in chats:
        earlier = [(len(set(said) & set(own)), t) for c, t, own, _ in chats if c == conv and t < turn]
        votes, best = max(earlier, default=(0, None))
        assert reply[conv, turn] == (best if votes else turn - 1 if turn else None)


def walk(replies):
    """Turns depth first, the earliest answer first."""
    answers = defaultdict(list)
    for turn, to in replies.items():
        answers[to].append(turn)
    out, left = [], sorted(answers[None], reverse=True)
    while left:
        out.append(left.pop())
        left += sorted(answers[out[-1]], reverse=True)
    return out


@pytest.mark.parametrize("turns_of_a_slice", [4096, 3])
def test_conversations_in_reply_order(spark, monkeypatch, turns_of_a_slice):
    import random

    monkeypatch.setattr(quotes, "SLICE", turns_of_a_slice)
    monkeypatch.setattr(quotes, "PIECE_CHARS", 150)
    rng = random.Random(11)
    links = {1: {0: None, 1: 0, 2: 1, 3: 0, 4: 1, 5: 3}, None: {0: None, 1: 0, 2: 0}, 2: {t: t - 1 if t else None for t in range(9)}}
    links |= {c: {t: rng.randrange(t) if t else None for t in range(25)} for c in (3, 4)}
    rows = [(c, t, "user", ("" if to is None else f"> said {to}\n") + f"said {t}") for c, of in links.items() for t, to in of.items()]
    rows += [(1, 3, "user", "> said 0\nonce more"), (4, None, "user", "first")]
    rng.shuffle(rows)
    got = quotes.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    no_python(got)
    found, texts = got.collect(), quotes.chat_texts(got).collect()
    for conv, of in links.items():
        mine = sorted((r for r in found if r.conv_id == conv), key=lambda r: r.reply_position)
        assert {r.turn: r.reply_to for r in mine if r.turn is not None} == of
        assert [r.reply_position for r in mine] == list(range(len(mine)))
        want = ([None] if conv == 4 else []) + [t for t in walk(of) for _ in range(1 + ((conv, t) == (1, 3)))]
        assert [r.turn for r in mine] == want
        parts = sorted((r.piece, r.text) for r in texts if r.conv_id == conv)
        assert "\n".join(t for _, t in parts) == "\n".join(r.formatted for r in mine)
        assert max(len(t) for _, t in parts) < 150 + 60
