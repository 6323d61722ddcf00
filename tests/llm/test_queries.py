"""The registered queries against their SQL, and what they promise where SQL has no say."""

import duckdb
import pytest

import __spark_entry__ as entry_module

SF_DIR = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = entry_module.LLM_QUERIES, entry_module.LLM_ORACLES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(spark, duck, key):
    df = QUERIES[key](spark, SF_DIR)
    columns = sorted(df.columns)
    cursor = duck.execute(ORACLES[key])
    names = [d[0] for d in cursor.description]
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()), key=repr)
    assert sorted(names) == columns
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == want


def test_quality_on_rows_that_were_held_out(spark, duck):
    rows = {r.doc_id: r for r in QUERIES["op7_quality_classifier"](spark, "/root/testdata/sf0.01").collect()}
    labels = duck.execute("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall()
    held = [(rows[i].predicted, q) for i, q in labels if rows[i].held_out]
    assert len(rows) == 1000 and len(held) > 50
    assert sum(p == q for p, q in held) / len(held) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())


def test_shards_are_whole_and_even(spark):
    rows = QUERIES["op1_hypergeometric_sharding"](spark, SF_DIR).collect()
    slots = sorted((r.shard, r.slot) for r in rows)
    assert slots == [(s, k) for s in range(8) for k in range(len(rows) // 8)]
    assert len({r.doc_id for r in rows}) == len(rows)
