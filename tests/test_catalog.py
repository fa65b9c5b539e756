"""Every registered query against its SQL."""

import os

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from talkmill.plans import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def rounded(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, oracle, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(rounded(r[c]) for c in columns) for r in df.collect()), key=str)
    cursor = oracle.execute(catalog.ORACLES[name])
    names = [x[0] for x in cursor.description]
    assert sorted(names) == columns
    assert got == sorted((tuple(rounded(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=str)


def against_sql(spark, tmp_path, name, rows):
    """What the query has beyond its SQL and what it lacks, over documents of these ids, texts and sources."""
    table = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string()), "source": pa.array([r[2] for r in rows], pa.string())})
    pq.write_table(table, tmp_path / "documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    con.register("got", catalog.QUERIES[name](spark, str(tmp_path)).toArrow())
    con.execute(f"CREATE TABLE want AS {catalog.ORACLES[name]}")
    return [con.execute(f"SELECT * FROM (FROM {a} EXCEPT ALL FROM {b})").fetchall() for a, b in (("got", "want"), ("want", "got"))]


def test_report_of_null_and_empty_texts(spark, tmp_path):
    assert against_sql(spark, tmp_path, "token_report", [(1, None, "a"), (2, "", "a"), (None, "x", "a"), (3, "日本", None), (4, "é", "a")]) == [[], []]


def test_lines_of_odd_rows(spark, tmp_path):
    """Ties at the second decimal and ratios just below one, nulls, empty texts, wide and long labels."""
    rows = [(1, None, "a"), (2, "", "b"), (3, "abc", None), (4, "é" + "a" * 7, "1.125"), (5, "é" * 17 + "a" * 183, "1.085"), (6, "é" * 5 + "a" * 3, "🤦" * 3), (7, "日" * 1_000_000, "long " * 9), (8, None, None)]
    rows += [(100 + 100 * n + k, "é" * k + "a" * (n - k), "src") for n in (8, 40, 80, 200) for k in range(0, min(n, 90))]
    assert against_sql(spark, tmp_path, "report_lines", rows) == [[], []]
