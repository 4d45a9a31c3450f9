"""Queries against their SQL on rows that the given tables lack."""

import duckdb
import pytest

from lodeplane.plans import registry
from tests.oracle import from_spark, rows

ODD = {
    "json_text_flags": ("conversations", "SELECT * FROM (VALUES (1, 0, 'user', 'Èle modèle'), (2, 0, 'user', 'x' || chr(10) || 'The y'), (3, 104, 'user', 'x'), (4, 0, 'System', NULL), (5, 0, 'user', chr(1) || 'le_')) t(conv_id, turn, role, text)"),
    "content_hashes": ("customer", "SELECT * FROM (VALUES (1, 'a', 1.23456789::DOUBLE), (2, ' b ', -0.0::DOUBLE), (3, NULL, 0.1::DOUBLE + 0.2::DOUBLE), (4, 'd', NULL), (8, 'cafe' || chr(769), 1.5::DOUBLE), (9, 'caf' || chr(233), 1.5::DOUBLE), (5, 'x' || chr(31), 150.5::DOUBLE)) t(c_custkey, c_name, c_acctbal)"),
}


@pytest.mark.parametrize("name", sorted(ODD))
def test_odd_rows(spark, tmp_path, name):
    table, made = ODD[name]
    con = duckdb.connect()
    con.execute(f"COPY ({made}) TO '{tmp_path}/{table}.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet'")
    want = con.execute(registry.ORACLES[name])
    assert from_spark(registry.QUERIES[name](spark, str(tmp_path))) == rows([d[0] for d in want.description], want.fetchall())
