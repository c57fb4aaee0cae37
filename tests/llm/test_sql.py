"""The SQL of the queries on the given tables, and that of the repair on broken conversations."""

import duckdb
import pyarrow as pa
import pytest

from loghaven.llm.queries import QUERIES
from loghaven.llm.sql import ORACLES

from .conftest import SMALL
from .test_search_phrases_repair import broken_chats, repaired_by_hand  # noqa: F401


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = db.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SMALL).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall()) and got


def test_repair_sql_of_broken_conversations(broken_chats):  # noqa: F811
    rows = [r for r in broken_chats if r[0] != 7]
    columns = dict(zip(("conv_id", "turn", "role", "text"), map(list, zip(*rows))))
    db = duckdb.connect()
    db.register("conversations", pa.table({**columns, "conv_id": pa.array(columns["conv_id"], pa.int64()), "turn": pa.array(columns["turn"], pa.int64())}))
    got = {r[0]: r[1:] for r in db.execute(ORACLES["op13_repaired_chats"]).fetchall()}
    assert got == {conv: row for conv, (row, _) in repaired_by_hand(rows).items()}
