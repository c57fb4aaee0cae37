"""Flow features and their z-score scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loghaven.functions import net

# Feature names and the addresses counted as servers.
FEATURES = ("duration_log", "orig_bytes_log", "resp_bytes_log", "is_dst_external", "is_src_server")
RAW_FEATURES = ("dest_port", "duration", "orig_bytes", "resp_bytes")
SERVERS = ("192.168.1.250", "192.168.1.100")


def fill_missing(flows: DataFrame) -> DataFrame:
    return flows.fillna({"duration": 0.0, "orig_bytes": 0, "resp_bytes": 0})


def flow_features(flows: DataFrame, servers: Sequence[str] = SERVERS) -> DataFrame:
    """Fill missing sizes and add the five model features."""
    return fill_missing(flows).withColumns(
        {
            "duration_log": F.log1p("duration"),
            "orig_bytes_log": F.log1p("orig_bytes"),
            "resp_bytes_log": F.log1p("resp_bytes"),
            "is_dst_external": F.when(net.is_private(F.col("dest_ip")), 0).otherwise(1),
            "is_src_server": F.when(F.col("src_ip").isin(*servers), 1).otherwise(0),
        }
    )


def flag_servers(flows: DataFrame, servers: DataFrame) -> DataFrame:
    """is_src_server from a table with one column ``src_ip`` instead of a list.

    The flag needs the table's distinct addresses only; Spark broadcasts them when
    their measured size allows and shuffles otherwise.
    """
    listed = servers.select("src_ip").distinct().withColumn("listed", F.lit(1))
    return (
        flows.join(listed, "src_ip", "left")
        .withColumn("is_src_server", F.coalesce(F.col("listed"), F.lit(0)))
        .drop("listed")
    )


def complete_rows(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Drop rows with a NULL or NaN feature."""
    for name in features:
        value = F.col(name).cast("double")
        df = df.filter(value.isNotNull() & ~F.isnan(value))
    return df


def feature_stats(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """One row with the mean and the sample standard deviation of every feature."""
    return df.agg(
        *[F.avg(F.col(f).cast("double")).alias(f"{f}_mean") for f in features],
        *[F.stddev_samp(F.col(f).cast("double")).alias(f"{f}_std") for f in features],
    )


def z_score(value: Column, mean: Column, std: Column) -> Column:
    """(value - mean) / std; 0 where the feature is constant."""
    return F.when(std > 0, (value.cast("double") - mean) / std).otherwise(F.lit(0.0))


def scale_features(
    df: DataFrame, features: Sequence[str] = FEATURES, stats: DataFrame | None = None
) -> DataFrame:
    """Add ``z_<feature>`` columns. The statistics reach the rows as one scalar subquery."""
    stats = feature_stats(df, features) if stats is None else stats
    row = stats.select(F.struct(*stats.columns).alias("s")).scalar()
    bound = df.withColumn("_stats", row)
    return bound.withColumns(
        {
            f"z_{f}": z_score(
                F.col(f),
                F.col("_stats").getField(f"{f}_mean"),
                F.col("_stats").getField(f"{f}_std"),
            )
            for f in features
        }
    ).drop("_stats")
