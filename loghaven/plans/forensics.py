"""Forensic queries over scored flows.

Each takes the table it reads. ``as_of`` stands for the clock, so a result can be
reproduced. A relative time filter also filters ingest_date, which prunes partitions.
Top-k orders end in a key, so a limit cuts ties the same way every time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loghaven.functions.numeric import rounded

# Connection states of a failed attempt.
REFUSED_STATES = ("REJ", "S0", "RSTOS0")


def since(rows: DataFrame, as_of: Column, period: str, time: str = "ingest_ts", date: str = "ingest_date") -> DataFrame:
    start = as_of - F.expr(f"INTERVAL {period}")
    return rows.filter((F.col(time) >= start) & (F.col(date) >= F.to_date(start)))


def since_date(rows: DataFrame, today: Column, days: int, date: str = "ingest_date") -> DataFrame:
    return rows.filter(F.col(date) >= F.date_sub(today, days))


def with_share(counts: DataFrame, n: str, out: str = "pct") -> DataFrame:
    """Percent of the total, as one scalar subquery over the already small counts."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.withColumn(out, rounded(F.col(n) * F.lit(100.0) / total, 2))


def _score_avg() -> Column:
    return rounded(F.avg("anomaly_score"), 3).alias("avg_score")


def _score_max() -> Column:
    return rounded(F.max("anomaly_score"), 3).alias("max_score")


def recent_anomalies(anomalies: DataFrame, as_of: Column, period: str = "1 HOUR", limit: int = 100) -> DataFrame:
    order = [F.desc("anomaly_score"), "ingest_ts", "src_ip", "dest_ip", "dest_port", "orig_bytes", "resp_bytes", "uid"]
    return (
        since(anomalies, as_of, period)
        .orderBy(*order)
        .limit(limit)
        .select(
            "ingest_ts", "src_ip", "dest_ip", "dest_port", "proto",
            rounded(F.col("duration"), 2).alias("duration_sec"),
            "orig_bytes", "resp_bytes",
            rounded(F.col("anomaly_score"), 3).alias("score"),
            "cluster_id", "conn_state",
        )
    )


def top_sources(anomalies: DataFrame, limit: int = 20) -> DataFrame:
    return (
        anomalies.groupBy("src_ip")
        .agg(
            F.count("*").alias("anomaly_count"), _score_avg(), _score_max(),
            F.count_distinct("dest_port").alias("unique_dest_ports"),
        )
        .orderBy(F.desc("anomaly_count"), "src_ip")
        .limit(limit)
    )


def density_per_minute(anomalies: DataFrame, as_of: Column, period: str = "6 HOURS") -> DataFrame:
    return (
        since(anomalies, as_of, period)
        .groupBy(F.date_format("ingest_ts", "yyyy-MM-dd HH:mm").alias("minute_bucket"))
        .agg(F.count("*").alias("anomaly_count"), _score_avg(), _score_max())
        .orderBy("minute_bucket")
    )


def port_scanners(anomalies: DataFrame, min_ports: int = 20) -> DataFrame:
    return (
        anomalies.filter(F.col("conn_state").isin(*REFUSED_STATES))
        .groupBy("src_ip")
        .agg(
            F.count_distinct("dest_port").alias("unique_ports_hit"),
            F.count("*").alias("total_flows"),
            rounded(F.avg("duration"), 4).alias("avg_duration"),
            rounded(F.avg("orig_bytes"), 0).alias("avg_orig_bytes"),
        )
        .filter(F.col("unique_ports_hit") > min_ports)
        .orderBy(F.desc("unique_ports_hit"), "src_ip")
    )


def large_transfers(anomalies: DataFrame, min_bytes: int = 1_000_000, limit: int = 50) -> DataFrame:
    order = [F.desc("orig_bytes"), "src_ip", "dest_ip", "dest_port", "proto", "duration", "resp_bytes", "anomaly_score", "uid"]
    return (
        anomalies.filter(F.col("orig_bytes") > min_bytes)
        .orderBy(*order)
        .limit(limit)
        .select(
            "src_ip", "dest_ip", "dest_port", "proto",
            rounded(F.col("duration"), 0).alias("duration_sec"),
            "orig_bytes", "resp_bytes",
            rounded(F.col("anomaly_score"), 3).alias("score"),
        )
    )


def by_protocol(anomalies: DataFrame) -> DataFrame:
    return (
        anomalies.groupBy("proto")
        .agg(F.count("*").alias("anomaly_count"), _score_avg())
        .orderBy(F.desc("anomaly_count"), "proto")
    )


def cluster_statistics(anomalies: DataFrame) -> DataFrame:
    return (
        anomalies.groupBy("cluster_id")
        .agg(
            F.count("*").alias("anomaly_count"), _score_avg(),
            rounded(F.min("anomaly_score"), 3).alias("min_score"), _score_max(),
        )
        .orderBy(F.desc("avg_score"), "cluster_id")
    )


def anomaly_share(flows: DataFrame, as_of: Column, period: str = "1 HOUR") -> DataFrame:
    counts = since(flows, as_of, period).groupBy("is_anomaly").agg(F.count("*").alias("flow_count"))
    return with_share(counts, "flow_count")


def by_port(anomalies: DataFrame, limit: int = 30) -> DataFrame:
    return (
        anomalies.groupBy("dest_port", "proto")
        .agg(F.count("*").alias("anomaly_count"), _score_avg())
        .orderBy(F.desc("anomaly_count"), "dest_port", "proto")
        .limit(limit)
    )


def daily_summary(anomalies: DataFrame, approximate: bool = False) -> DataFrame:
    """``approximate`` counts distinct addresses by sketch, for tables of any size."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return (
        anomalies.groupBy("ingest_date")
        .agg(
            F.count("*").alias("total_anomalies"),
            distinct("src_ip").alias("unique_src_ips"),
            distinct("dest_ip").alias("unique_dest_ips"),
            _score_avg(), _score_max(),
        )
        .orderBy(F.desc("ingest_date"))
    )


def pruned_lookup(flows: DataFrame, date: str, dest_port: int) -> DataFrame:
    """Flows of one date to one port; the date selects the partition that is read."""
    return flows.filter(
        (F.col("ingest_date") == F.to_date(F.lit(date))) & (F.col("dest_port") == dest_port)
    ).select("ingest_ts", "src_ip", "dest_ip", "dest_port", "orig_bytes", "conn_state")


def count_between(flows: DataFrame, dest_port: int, first: str, last: str) -> DataFrame:
    """Number of flows to a port between two times, both included."""
    lo, hi = F.to_timestamp(F.lit(first)), F.to_timestamp(F.lit(last))
    return flows.filter(
        F.col("ingest_date").between(F.to_date(lo), F.to_date(hi))
        & F.col("ingest_ts").between(lo, hi)
        & (F.col("dest_port") == dest_port)
    ).agg(F.count("*").alias("flow_count"))


def at_time(logs: DataFrame, at: Column) -> DataFrame:
    """An append-only table as it stood at a time."""
    return logs.filter((F.col("ingest_ts") <= at) & (F.col("ingest_date") <= F.to_date(at)))
