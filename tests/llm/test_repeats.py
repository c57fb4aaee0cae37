"""Repeated rows, hot ids, clashing columns and full memories of the earlier operators."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loghaven.llm import gam, mixing, pieces, sharding
from loghaven.llm.common import one_label
from loghaven.llm.queries import QUERIES

from .conftest import SMALL, prose
from .test_native import targets


def repeated_sources(spark, times):
    """Sources a, b, c of 20,000 words; half of c is one document on many rows."""
    rows = [(i, prose(i, 20), "a" if i % 2 else "b") for i in range(2000)]
    rows += [(5000 + i, prose(9000 + i, 20), "c") for i in range(500)] + [(7777 + times, prose(times, 10), "c")] * 1000
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("times", [1, 2, 3])
@pytest.mark.parametrize("share", [1.5, 0.3])
def test_a_repeated_document_is_taken_as_often_as_its_source_needs(spark, times, share, monkeypatch):
    monkeypatch.setattr(mixing, "REPEATS", 300)
    docs = repeated_sources(spark, times)
    for bare in (True, False):
        taken, sizes = Counter(), Counter()
        for r in mixing.mix_sources(docs, share=share, bare=bare).collect():
            taken[r.source] += r.size * r.copies
            sizes[r.source] += r.size
        want = targets(sizes, share=share)
        assert all(abs(taken[s] - want[s]) <= 20 for s in "abc"), (taken, want)


def test_repeats_of_many_parts_get_different_places(spark):
    docs = repeated_sources(spark, 1).repartition(7)
    rows = docs.select("doc_id", "source", mixing.queue_place(F.col("doc_id"), F.col("text")).alias("__place"))
    groups = rows.groupBy("doc_id", "source", F.col("__place").alias("place")).agg(F.count("*").alias("n"))
    places = sorted(r[0] for r in mixing.numbered(rows, groups).select("__place").collect())
    assert len(places) == len({*places}) == 3500
    assert places == sorted(r.place for r in mixing.queue_of(groups).collect())


def test_a_hot_id_does_not_pass_the_bound_of_the_sample(spark, monkeypatch):
    texts = [prose(i, 20 + i % 50) for i in range(300)]
    rows = [(1, texts[i % 300]) for i in range(20_000)] + [(10 + i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)] + [(10 + i, i % 2) for i in range(300)], "doc_id long, label int")
    seen = []
    fit = gam.fit
    monkeypatch.setattr(gam, "fit", lambda x, y, *more: seen.append(len(x)) or fit(x, y, *more))
    gam.learn(gam.with_stats(docs), labels, max_rows=100)
    assert 50 <= seen[0] <= 150


def test_the_memory_of_the_encoder_is_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "MEMORY", 1 << 20)
    encoder, rng = pieces.Pieces(**pieces.load_pieces()), random.Random(3)
    plain = pieces.Pieces(**pieces.load_pieces())
    base, held = len(encoder.code), []
    for _ in range(60):
        texts = ["".join(chr(rng.randint(0x3400, 0x9FFF)) for _ in range(400)) + f" w{rng.random()}" for _ in range(5)]
        got = encoder.ids_of(texts)
        entries = len(encoder.options) + len(encoder.whole) + sum(map(len, encoder.apart.values())) + len(encoder.known) + len(encoder.before)
        held.append(entries + len(encoder.code) - base)
        assert encoder.held + encoder.held_words <= 2 * pieces.MEMORY
    plain.held = plain.held_words = -(1 << 60)  # never forgets
    assert got == plain.ids_of(texts)
    assert max(held[30:]) <= 1.1 * max(held[:30]) and max(held) * pieces.OTHER <= 3 * pieces.MEMORY


def test_round_trip_is_encoding_and_decoding(spark, odd_docs):
    model = pieces.load_pieces()
    both = odd_docs.select("text", pieces.round_trip(F.col("text"), model).alias("both")).select("text", "both.ids", "both.decoded")
    apart = pieces.decode_documents(pieces.encode_documents(odd_docs.select("text")))
    key = lambda r: (r.text is None, r.text or "")
    assert sorted(map(tuple, both.collect()), key=lambda r: (r[0] is None, r[0] or "")) == [(r.text, r.ids, r.decoded) for r in sorted(apart.collect(), key=key)]


CLASHING = {"score": "own score", "kept": "own kept", "n_words": -1, "size": -2, "target": "t", "predicted": 7, "component_id": "c", "copies": 99, "ids": "i", "__own0": 3}


def test_pipeline_stages_keep_the_callers_columns(spark, small_docs):
    docs = small_docs.withColumns({c: F.lit(v) for c, v in CLASHING.items()})
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == [*small_docs.columns, *CLASHING], name
        rows = docs.select(*CLASHING).distinct().collect()
        assert [r.asDict() for r in rows] == [CLASHING], name


def test_pipeline_of_no_rows_and_null_ids(spark, small_docs):
    none = small_docs.limit(0)
    nulls = small_docs.where("doc_id < 40").withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")))
    for docs, least in ((none, 0), (nulls, 1)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
        assert docs.count() >= least
    assert none.count() == 0


def test_registered_queries_return_every_row(spark, small_docs):
    n = small_docs.count()
    for name in ("op4_license_scan", "op6_jaccard_join", "op9_lm_scores"):
        assert QUERIES[name](spark, SMALL).count() == n
    assert QUERIES["op8_vector_classes"](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/embeddings.parquet").count()
    labels = one_label(spark.read.parquet(f"{SMALL}/labels.parquet"), "quality")
    assert np.isin([r.label for r in labels.collect()], [0, 1]).all()


def test_one_id_on_a_third_of_the_rows_is_sharded(spark):
    rows = [(i, f"text {i}") for i in range(2000)] + [(7, "same")] * 500 + [(7, f"other {i}") for i in range(500)] + [(None, "x")] * 100
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard_rows(docs.repartition(6), shards=9).collect()
    assert len(got) == len(rows)
    slots = Counter((r.shard, r.slot) for r in got)
    by_shard = Counter(r.shard for r in got)
    assert max(slots.values()) == 1 and max(by_shard.values()) - min(by_shard.values()) <= 1
    assert all(sorted(s for shard, s in slots if shard == k) == list(range(n)) for k, n in by_shard.items())
    again = sharding.shard_rows(docs.repartition(11), shards=9).collect()
    assert Counter((r.doc_id, r.text_crc32, r.shard) for r in got) == Counter((r.doc_id, r.text_crc32, r.shard) for r in again)
