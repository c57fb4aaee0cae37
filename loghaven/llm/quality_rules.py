"""Quality rules: an ordered decision list learned by sequential covering.

A rule is a conjunction of thresholds that rejects a document. It is grown on two thirds of the
labelled rows, one condition at a time by information gain, and pruned on the rest from its last
condition on. Rows that it covers are left out and the next rule is grown. The list is emitted
as one conditional expression. Each step is one aggregate over the labelled rows; the driver
sees counts per statistic and bin only.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import pairwise
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loghaven.lake import stored
from loghaven.llm.text_stats import SHARES, base_failed, with_text_stats

BINS = 24
MAX_RULES = 10
MAX_CONDITIONS = 3
MIN_PRECISION = 0.9
MIN_COVER = 8
PREFIX = "__stat_"


@dataclass(frozen=True)
class Condition:
    stat: str
    above: bool
    threshold: float

    def column(self, prefix: str = "") -> Column:
        value = F.col(prefix + self.stat)
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.stat} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def conjunction(rule: Rule, prefix: str = "") -> Column:
    covered = F.lit(True)
    for condition in rule:
        covered = covered & condition.column(prefix)
    return covered


def kept_by(rules: list[Rule], prefix: str = "") -> Column:
    """The decision list: the first rule that holds rejects, else the document is kept."""
    if not rules:
        return F.lit(True)
    decision = F.when(conjunction(rules[0], prefix), False)
    for rule in rules[1:]:
        decision = decision.when(conjunction(rule, prefix), False)
    return decision.otherwise(True)


def thresholds_of(rows: DataFrame, stats: tuple[str, ...], bins: int = BINS) -> dict[str, list[float]]:
    """Candidate thresholds: halfway between neighbours among the quantiles of each statistic over
    the good rows and over the bad, so that a rule does not end at the last value seen."""
    steps = [i / bins for i in range(bins + 1)]
    exprs = [
        F.percentile_approx(F.when(F.col("bad") == side, F.col(s)), steps, 10_000).alias(f"{s}|{side}")
        for s in stats
        for side in (0, 1)
    ]
    row = rows.agg(*exprs).first()
    seen = {s: sorted({float(v) for side in (0, 1) for v in row[f"{s}|{side}"] or []}) for s in stats}
    return {s: [(a + b) / 2 for a, b in pairwise(values)] for s, values in seen.items()}


def _bin(value: Column, thresholds: list[float]) -> Column:
    """How many thresholds the value exceeds."""
    return F.size(F.filter(F.array(*[F.lit(t) for t in thresholds]), lambda t: t < value))


def _gain(p: float, n: float, before: float) -> float:
    return p * (log2(p / (p + n)) - before) if p else 0.0


def _best_condition(binned: DataFrame, thresholds: dict[str, list[float]], min_cover: int) -> Condition | None:
    """The condition of highest gain on the rows at hand; None if none gains."""
    stats = list(thresholds)
    at = F.explode(F.array(*[F.struct(F.lit(i).alias("stat"), F.col(f"bin_{s}").alias("bin")) for i, s in enumerate(stats)]))
    counts: dict[int, dict[int, list[int]]] = {}
    for r in binned.select("bad", at.alias("at")).groupBy("at.stat", "at.bin", "bad").count().collect():
        counts.setdefault(r["stat"], {}).setdefault(r["bin"], [0, 0])[r["bad"]] += r["count"]
    if not counts:
        return None
    n_all, p_all = (sum(c[k] for c in counts[0].values()) for k in (0, 1))
    if not p_all or not n_all:
        return None
    before, best, chosen = log2(p_all / (p_all + n_all)), 1e-9, None
    for i, s in enumerate(stats):
        n = p = 0
        for b in range(len(thresholds[s])):  # rows of bin <= b have a value <= thresholds[b]
            n, p = n + counts[i].get(b, [0, 0])[0], p + counts[i].get(b, [0, 0])[1]
            for above, good, bad in ((False, n, p), (True, n_all - n, p_all - p)):
                if bad >= min_cover and (gain := _gain(bad, good, before)) > best:
                    best, chosen = gain, Condition(s, above, thresholds[s][b])
    return chosen


def learn_rules(
    labelled: DataFrame,
    stats: tuple[str, ...] = SHARES,
    bins: int = BINS,
    max_rules: int = MAX_RULES,
    max_conditions: int = MAX_CONDITIONS,
    min_precision: float = MIN_PRECISION,
    min_cover: int = MIN_COVER,
) -> list[Rule]:
    """Rules from rows with ``bad`` (0 or 1), ``key`` (splits grow and prune rows) and the
    statistics. No rows, or rows of one label only, give no rules."""
    thresholds = thresholds_of(labelled, stats, bins)
    thresholds = {s: t for s, t in thresholds.items() if t}  # a statistic of one value has none
    if not thresholds:
        return []
    bin_of = {f"bin_{s}": _bin(F.col(s), ts) for s, ts in thresholds.items()}
    prune = (F.pmod(F.xxhash64(F.lit(3), "key"), F.lit(3)) == 0).alias("prune")
    rows = stored(labelled.select("bad", prune, *thresholds, *[c.alias(n) for n, c in bin_of.items()]), "rule-rows")
    rules: list[Rule] = []
    while len(rules) < max_rules:
        left = rows.where(kept_by(rules))
        rule: Rule = ()
        while len(rule) < max_conditions:
            condition = _best_condition(left.where(~F.col("prune") & conjunction(rule)), thresholds, min_cover)
            if condition is None:
                break
            rule = (*rule, condition)
        if not rule:
            break
        cuts = range(1, len(rule) + 1)
        tested = left.where("prune").agg(
            *[F.sum(F.when(conjunction(rule[:k]), F.col("bad"))).alias(f"p{k}") for k in cuts],
            *[F.count(F.when(conjunction(rule[:k]), 1)).alias(f"n{k}") for k in cuts],
        ).first()
        worth = {k: (2 * (tested[f"p{k}"] or 0) - tested[f"n{k}"]) / max(1, tested[f"n{k}"]) for k in cuts}
        k = max(cuts, key=lambda k: (worth[k], -k))
        if tested[f"n{k}"] == 0 or (tested[f"p{k}"] or 0) < min_precision * tested[f"n{k}"]:
            break
        rules.append(rule[:k])
    return rules


NEW = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def rules_from(stats: DataFrame, labels: DataFrame, **options) -> list[Rule]:
    """Rules from rows with doc_id and statistics under ``PREFIX``, and labels (doc_id, label)."""
    narrow = stats.select(F.col("doc_id").alias("key"), *[F.col(PREFIX + s).alias(s) for s in SHARES])
    return learn_rules(narrow.join(labels.select(F.col("doc_id").alias("key"), (1 - F.col("label")).alias("bad")), "key"), **options)


def judged(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows with statistics under ``PREFIX`` -> their other columns, the base counts,
    base_failed and kept."""
    others = [c for c in stats.columns if not c.startswith(PREFIX) and c not in (*NEW, "base_failed", "kept")]
    failed = base_failed(PREFIX)
    return stats.select(
        *others,
        *[F.col(PREFIX + n).alias(n) for n in NEW],
        failed.alias("base_failed"),
        (~failed & kept_by(rules, PREFIX)).alias("kept"),
    )


def quality_rules(docs: DataFrame, labels: DataFrame, **options) -> tuple[DataFrame, list[Rule]]:
    """Documents with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept; and the rules learned.

    ``docs`` needs doc_id and text, all other columns stay; columns of the new names are
    replaced. ``labels`` has doc_id and label (1: good), see ``one_label``; without labels only
    the base rule rejects. Null texts count as empty, which the base rule rejects; rows with a
    null id are judged, never learned from. Repeated rows are judged alike; an empty table
    gives none. The statistics are written for the learning, without the texts, and made again
    for the decision.
    """
    narrow = stored(with_text_stats(docs.select("doc_id", "text"), prefix=PREFIX).drop("text"), "rule-stats")
    rules = rules_from(narrow, labels, **options)
    return judged(with_text_stats(docs, prefix=PREFIX), rules), rules
