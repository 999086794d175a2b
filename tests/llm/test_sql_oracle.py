"""The queries that have DuckDB SQL return its rows, on a whole table and on awkward rows."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "scripts"))
from compare_oracle import digest  # noqa: E402
from helpers import SF, edge_docs  # noqa: E402

from contrail.llm.queries import ORACLE, QUERIES  # noqa: E402


def same(spark, key, folder, table):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet{'' if folder == SF else '/*.parquet'}')")
    want = con.execute(ORACLE[key])
    columns, rows = [d[0] for d in want.description], want.fetchall()
    got = QUERIES[key](spark, folder)
    assert sorted(got.columns) == sorted(columns)
    assert digest(got.columns, [tuple(r) for r in got.collect()]) == digest(columns, rows)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_whole_table(spark, key):
    same(spark, key, SF, "embeddings" if key == "op3_embedding_near_dups" else "documents")


@pytest.mark.parametrize("key", sorted(set(ORACLE) - {"op3_embedding_near_dups"}))
def test_awkward_rows(spark, key, tmp_path):
    # The SQL reads ids as unique.
    edge_docs(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).write.parquet(f"{tmp_path}/documents.parquet")
    same(spark, key, str(tmp_path), "documents")
