"""Threshold detection rules, evaluated together in one pass over the logs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loghaven.functions import geo, net

SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW", "INFO")


@dataclass(frozen=True)
class Rule:
    """Rows matching ``condition`` are grouped by ``field``; a group above ``threshold`` alerts.

    ``measure`` is ``"rows"``, ``"distinct"`` or ``"total"``; the last two read
    ``operand``. ``threshold`` None alerts on every group.
    """

    rule_id: str
    name: str
    severity: str
    description: str
    field: str
    condition: Callable[[], Column]
    measure: str = "rows"
    operand: str | None = None
    threshold: int | None = None

    def __post_init__(self):
        if self.severity not in SEVERITIES:
            raise ValueError(f"{self.rule_id}: unknown severity {self.severity}")
        if self.measure not in ("rows", "distinct", "total"):
            raise ValueError(f"{self.rule_id}: unknown measure {self.measure}")
        if (self.measure == "rows") != (self.operand is None):
            raise ValueError(f"{self.rule_id}: operand goes with distinct and total only")


@dataclass(frozen=True)
class SqlRule:
    """A rule as SQL over ``batch_logs`` that returns matched_field, matched_value, hit_count."""

    rule_id: str
    name: str
    severity: str
    description: str
    query: str


def _topic(name: str) -> Column:
    return F.col("source_topic") == name


def _named(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")


def _like_any(column: str, patterns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(column).like(p) for p in patterns])


# Rule ids, texts, field values and thresholds.
DEFAULT_RULES: tuple[Rule, ...] = (
    Rule(
        "SIEM-001", "Brute Force Detection (HTTP)", "HIGH",
        "Single IP generating 50+ HTTP 401/403 errors in a micro-batch",
        field="client_ip",
        condition=lambda: _topic("web-logs")
        & F.col("status_code").isin("401", "403")
        & _named("client_ip"),
        threshold=50,
    ),
    Rule(
        "SIEM-002", "Path Traversal Attempt", "CRITICAL",
        "URL containing ../ patterns indicating directory traversal attack",
        field="request_path",
        condition=lambda: _topic("web-logs") & _like_any("request_path", ["%../%"]),
    ),
    Rule(
        "SIEM-003", "Unusual High Volume from Single IP", "MEDIUM",
        "Single IP generating 1000+ requests in a micro-batch (potential DDoS)",
        field="client_ip",
        condition=lambda: _topic("web-logs") & _named("client_ip"),
        threshold=1000,
    ),
    Rule(
        "SIEM-004", "SSH Brute Force (Syslog)", "HIGH",
        "Repeated 'Failed password' patterns in syslog indicating SSH brute force",
        field="syslog_host",
        condition=lambda: _topic("syslogs")
        & _like_any("raw_log", ["%Failed password%"])
        & F.col("syslog_host").isNotNull(),
        threshold=10,
    ),
    Rule(
        "SIEM-005", "SQL Injection Attempt", "CRITICAL",
        "URL containing common SQL injection patterns",
        field="request_path",
        condition=lambda: _topic("web-logs")
        & _like_any(
            "request_path", ["%UNION%SELECT%", "%OR%1=1%", "%'%OR%'%", "%DROP%TABLE%"]
        ),
    ),
    Rule(
        "SIEM-006", "Application Critical Error Spike", "HIGH",
        "Multiple critical/error events from an application service",
        field="app_service",
        condition=lambda: _topic("app-logs")
        & F.col("app_event").isin("error", "critical")
        & F.col("app_service").isNotNull(),
        threshold=5,
    ),
    Rule(
        "SIEM-007", "HTTP 5xx Server Error Spike", "MEDIUM",
        "High volume of server errors indicating potential service degradation",
        field="status_code",
        condition=lambda: _topic("web-logs") & _like_any("status_code", ["5%"]),
        threshold=20,
    ),
    Rule(
        "SIEM-008", "Network Port Scanning", "HIGH",
        "Single internal/external IP scanning multiple distinct ports",
        field="client_ip",
        condition=lambda: _topic("real_network_logs") & F.col("dest_port").isNotNull(),
        measure="distinct", operand="dest_port", threshold=50,
    ),
    Rule(
        "SIEM-009", "Potential Data Exfiltration", "CRITICAL",
        "Large data transfer detected from internal network to external IP",
        field="client_ip",
        condition=lambda: _topic("real_network_logs") & (F.col("country") != "Internal"),
        measure="total", operand="orig_bytes", threshold=100_000_000,
    ),
)


def select_rules(*rule_ids: str, thresholds: dict[str, int] | None = None) -> tuple[Rule, ...]:
    """Default rules by id (all when none is named), with other thresholds if given."""
    thresholds = thresholds or {}
    chosen = [r for r in DEFAULT_RULES if not rule_ids or r.rule_id in rule_ids]
    return tuple(
        replace(r, threshold=thresholds[r.rule_id]) if r.rule_id in thresholds else r
        for r in chosen
    )


def sql_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _per_rule(rules: Sequence[Rule], value: Callable[[Rule], str]) -> Column:
    """A value that depends on ``rule_no`` alone. Stated as SQL: one call, not one per rule."""
    cases = " ".join(f"WHEN {n} THEN {value(rule)}" for n, rule in enumerate(rules))
    return F.expr(f"CASE rule_no {cases} END")


def _candidate(n: int, rule: Rule) -> Column:
    item = f"CAST(`{rule.operand}` AS STRING)" if rule.measure == "distinct" else "CAST(NULL AS STRING)"
    amount = f"try_cast(`{rule.operand}` AS BIGINT)" if rule.measure == "total" else "CAST(NULL AS BIGINT)"
    return F.expr(
        f"named_struct('rule_no', {n}, 'matched_value', CAST(`{rule.field}` AS STRING), "
        f"'item', {item}, 'amount', {amount})"
    )


def rule_candidates(
    logs: DataFrame, rules: Sequence[Rule], carry: Sequence[Column] = (), prefilter: bool = True
) -> DataFrame:
    """One row per (log row, rule it matches): rule_no, matched_value, item, amount.

    ``prefilter`` first drops rows that match no rule, at the scan if possible. A stream
    with a watermark must not: the filter would move below the watermark, which would
    then advance with matching rows only.
    """
    conditions = [rule.condition() for rule in rules]
    matches = F.array(*[F.when(c, _candidate(n, r)) for n, (c, r) in enumerate(zip(conditions, rules))])
    carried = [F.col(name) for name in logs.select(*carry).columns] if carry else []
    rows = logs.filter(reduce(or_, conditions)) if prefilter else logs
    return (
        rows.select(*carry, F.explode(matches).alias("c"))
        .filter("c IS NOT NULL")
        .select(*carried, "c.*")
    )


def count_hits(
    candidates: DataFrame, rules: Sequence[Rule], keys: Sequence[str] = ()
) -> DataFrame:
    """Aggregate candidates to rule_no, matched_value, hit_count and apply the thresholds.

    Two levels: first per distinct item, which combines map-side and spreads a hot
    value over its items, then per value. Neither level sees raw rows in one task.
    """
    per_item = candidates.groupBy(*keys, "rule_no", "matched_value", "item").agg(
        F.count("*").alias("n"), F.sum("amount").alias("amount")
    )
    per_value = per_item.groupBy(*keys, "rule_no", "matched_value").agg(
        F.sum("n").alias("n"), F.count("item").alias("items"), F.sum("amount").alias("amount")
    )
    return apply_thresholds(per_value, rules)


def apply_thresholds(per_value: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rule_no, n, items, amount -> hit_count above each rule's threshold."""
    measured = {"rows": "n", "distinct": "items", "total": "amount"}
    hit_count = _per_rule(rules, lambda r: f"CAST({measured[r.measure]} AS BIGINT)")
    above = _per_rule(rules, lambda r: "true" if r.threshold is None else f"hit_count > {int(r.threshold)}")
    return per_value.withColumn("hit_count", hit_count).drop("n", "items", "amount").filter(above)


def describe_hits(hits: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Replace rule_no by the rule's texts."""
    texts = {
        "rule_id": lambda r: r.rule_id,
        "rule_name": lambda r: r.name,
        "severity": lambda r: r.severity,
        "description": lambda r: r.description,
        "matched_field": lambda r: r.field,
    }
    columns = {
        name: _per_rule(rules, lambda r, text=text: sql_literal(text(r))) for name, text in texts.items()
    }
    return hits.withColumns(columns).drop("rule_no")


def _sql_hits(logs: DataFrame, rule: SqlRule) -> DataFrame:
    logs.createOrReplaceTempView("batch_logs")
    return logs.sparkSession.sql(rule.query).select(
        F.lit(rule.rule_id).alias("rule_id"),
        F.lit(rule.name).alias("rule_name"),
        F.lit(rule.severity).alias("severity"),
        F.lit(rule.description).alias("description"),
        F.col("matched_field").cast("string"),
        F.col("matched_value").cast("string"),
        F.col("hit_count").cast("bigint"),
    )


HIT_COLUMNS = [
    "rule_id", "rule_name", "severity", "description", "matched_field", "matched_value", "hit_count",
]


def rule_hits(logs: DataFrame, rules: Sequence[Rule | SqlRule] = DEFAULT_RULES) -> DataFrame:
    """All rules over one batch: one scan for the ``Rule`` entries, one per ``SqlRule``."""
    plain = [r for r in rules if isinstance(r, Rule)]
    parts = []
    if plain:
        counted = count_hits(rule_candidates(logs, plain), plain)
        parts.append(describe_hits(counted, plain).select(*HIT_COLUMNS))
    parts += [_sql_hits(logs, r) for r in rules if isinstance(r, SqlRule)]
    return reduce(DataFrame.unionByName, parts)


def locate_hits(hits: DataFrame, logs: DataFrame) -> DataFrame:
    """Add country and city where the matched value is a client address of the batch.

    Both are functions of the address, so no address table is joined: a hit on
    client_ip is located by its own value, and another value (a host, a path, a
    status code) only if some row of the batch has that text as its client_ip. The
    semi-join keeps just the addresses that occur among the values, so what is
    shuffled and joined is no larger than the hits.
    """
    # A NULL value is looked up as '': otherwise the join adds a filter to this copy of
    # the hits, and the two copies no longer share their shuffles.
    values = hits.select(F.coalesce("matched_value", F.lit("")).alias("matched_value")).distinct()
    seen = (
        logs.select(F.col("client_ip").alias("matched_value"))
        .join(values, "matched_value", "left_semi")
        .distinct()
        .withColumn("seen", F.lit(True))
    )
    value = F.col("matched_value")
    is_address = value.isNotNull() & (
        (F.col("matched_field") == "client_ip") | F.coalesce(F.col("seen"), F.lit(False))
    )
    return (
        hits.join(seen, "matched_value", "left")
        .withColumn("country", F.when(is_address, geo.country_of(value)))
        .withColumn("city", F.when(is_address, geo.city_of(F.col("country"))))
        .drop("seen")
    )


def stamp_alerts(located: DataFrame, detected_at: Column | None = None) -> DataFrame:
    """Add detected_at and detect_date and order the columns as in the alerts table."""
    detected_at = F.current_timestamp() if detected_at is None else detected_at
    return (
        located.withColumn("detected_at", detected_at)
        .withColumn("detect_date", F.to_date("detected_at"))
        .select(*HIT_COLUMNS, "country", "city", "detected_at", "detect_date")
    )


def evaluate_rules(
    logs: DataFrame,
    rules: Sequence[Rule | SqlRule] = DEFAULT_RULES,
    detected_at: Column | None = None,
) -> DataFrame:
    """Parsed logs of one batch -> rows of the alerts table."""
    return stamp_alerts(locate_hits(rule_hits(logs, rules), logs), detected_at)


def windowed_hits(
    logs: DataFrame,
    rules: Sequence[Rule] = DEFAULT_RULES,
    width: str = "5 minutes",
    time: str = "ingest_ts",
) -> DataFrame:
    """The rules per event-time window, so that a threshold does not depend on batch size."""
    carry = [F.window(F.col(time).cast("timestamp"), width).alias("w")]
    counted = count_hits(rule_candidates(logs, rules, carry), rules, keys=["w"])
    return describe_hits(counted, rules).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *HIT_COLUMNS
    )


def error_rate_alarm(
    logs: DataFrame, as_of: Column, within: str = "5 minutes", threshold: int = 50
) -> DataFrame:
    """Server errors in the period before ``as_of`` and whether they exceed the threshold.

    The status test orders text, so ``''`` and NULL do not count and ``'53'`` does.
    ingest_date is filtered too: it prunes partitions, which the time alone does not.
    """
    since = as_of - F.expr(f"INTERVAL {within}")
    recent = (F.col("ingest_ts") > since) & (F.col("ingest_date") >= F.to_date(since))
    return (
        logs.filter((F.col("status_code") >= "500") & recent)
        .agg(F.count("*").alias("err_count"))
        .withColumn("triggered", F.col("err_count") > threshold)
    )


def internal_exfiltration(flows: DataFrame, threshold: int = 100_000_000) -> DataFrame:
    """Private sources whose bytes sent to public destinations exceed the threshold, by real
    address ranges; text that is no address is neither."""
    outbound = net.is_private_address(F.col("src_ip")) & ~net.is_private_address(F.col("dest_ip"))
    return (
        flows.filter(outbound)
        .groupBy(F.col("src_ip").alias("matched_value"))
        .agg(F.sum("orig_bytes").alias("hit_count"))
        .filter(F.col("hit_count") > threshold)
        .select(F.lit("src_ip").alias("matched_field"), "matched_value", "hit_count")
    )
