"""Order-free comparison of two result frames by column name."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pandas as pd


def _plain(value):
    if value is None or (not isinstance(value, (list, tuple, dict)) and pd.isna(value)):
        return None
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime().replace(tzinfo=None).isoformat()
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day).isoformat()
    if hasattr(value, "item") and not isinstance(value, (list, tuple)):
        try:
            value = value.item()
        except ValueError:
            value = list(value)
    if isinstance(value, float):
        return int(value) if value.is_integer() else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def rows(frame: pd.DataFrame) -> Counter:
    names = sorted(frame.columns)
    return Counter(tuple(_plain(v) for v in r) for r in frame[names].itertuples(index=False, name=None))


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None when equal, else a short description of the difference."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} against {sorted(want.columns)}"
    a, b = rows(got), rows(want)
    if a == b:
        return None
    extra, missing = list((a - b).items())[:2], list((b - a).items())[:2]
    return f"{sum(a.values())} rows against {sum(b.values())}; extra {extra}; missing {missing}"
