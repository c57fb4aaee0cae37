"""The registered queries of the package and the pipeline's stages on the smallest data."""

import zlib
from collections import Counter

import corpus_pipeline
from loghaven.llm.common import one_label
from loghaven.llm.queries import ORACLES, QUERIES

from .conftest import SMALL
from .test_models import brute_classes
from .test_native import WORD, stats_of, targets


def test_one_query_per_operator():
    assert {int(q[2:].split("_")[0]) for q in QUERIES if q != "pipeline"} == set(range(1, 14))
    assert {*ORACLES} <= {*QUERIES} and "pipeline" in QUERIES


def test_queries_return_every_row(spark, small_docs):
    n = small_docs.count()
    for name in ("op1_source_mix", "op2_quality_rules", "op3_quality_model", "op5_pieces", "op10_shards"):
        assert QUERIES[name](spark, SMALL).count() == n
    assert QUERIES["op7_quoted_chats"](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/conversations.parquet").count()


def test_stages(spark, small_docs):
    docs, kept = small_docs, []
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == small_docs.columns, name
        docs = docs.cache()
        kept.append([(r.doc_id, r.text, r.source) for r in docs.collect()])
    rules, model, single, mixed = kept
    labels = {r.doc_id: r.label for r in one_label(spark.read.parquet(f"{SMALL}/labels.parquet"), "quality").collect()}
    for i, text, _ in rules:
        n, _, _, _, repeated = stats_of(text)
        assert n >= 20 and 100 * repeated <= 30 * n
    assert set(model) <= set(rules)
    good = [r for r in rules if labels.get(r[0]) == 1]
    assert len(set(good) & set(model)) >= 0.95 * len(good)
    classes = brute_classes([(i, t) for i, t, _ in model], 5, 80, 100)
    assert sorted(i for i, _, _ in single) == sorted(i for i, _, least in classes if i == least)
    sizes, taken, most = Counter(), Counter(), Counter()
    for _, text, source in single:
        sizes[source] += len(WORD.findall(text))
        most[source] = max(most[source], len(WORD.findall(text)))
    for _, text, source in mixed:
        taken[source] += len(WORD.findall(text))
    assert set(mixed) <= set(single) and max(Counter(mixed).values()) <= 2
    assert all(abs(taken[s] - t) <= most[s] for s, t in targets(sizes).items())
    encoded = corpus_pipeline.STAGES[4][1](spark, docs, SMALL).collect()
    assert Counter(r.doc_id for r in encoded) == Counter(i for i, _, _ in mixed)
    assert all(r.n_tokens == len(r.ids) > 0 for r in encoded)


def test_run_is_repeatable(spark):
    rows = [Counter((r.doc_id, zlib.crc32(str(r.ids).encode())) for r in corpus_pipeline.run(spark, SMALL).collect()) for _ in range(2)]
    assert rows[0] == rows[1] and rows[0]
