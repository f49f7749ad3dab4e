"""Every registered query against its SQL equivalent in DuckDB."""

import math

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tallyglass.plans.oracles import ORACLES
from tallyglass.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def views(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def duck(sf_dir):
    return views(sf_dir)


@pytest.fixture(scope="module")
def hot_dir(sf_dir, duck, tmp_path_factory):
    """The same tables, with a third of the events on one user and day, a third of the documents of
    one length and a third of the lines on one day."""
    path = tmp_path_factory.mktemp("hot")
    changed = {
        "events": """SELECT * REPLACE (
            CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id,
            CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-25 12:00:00' ELSE ts END AS ts) FROM events""",
        "documents": "SELECT * REPLACE (CASE WHEN doc_id % 3 = 0 THEN 1500 ELSE n_chars END AS n_chars) FROM documents",
        "lineitem": """SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN TIMESTAMP '1999-01-01' ELSE l_shipdate END
            AS l_shipdate) FROM lineitem""",
    }
    for name in TABLES:
        rows = changed.get(name, f"SELECT * FROM {name}")
        duck.execute(f"COPY ({rows}) TO '{path}/{name}.parquet' (FORMAT parquet)")
    return str(path)


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_all_of_them():
    assert set(QUERIES) <= set(queries())
    assert set(ORACLES) <= set(oracle_sql())


def check(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, sf_dir, name):
    check(spark, duck, sf_dir, name)


@pytest.mark.parametrize(
    "name",
    [
        "features",
        "join_pred_actual",
        "prediction_quality",
        "roc_auc",
        "best_f1_threshold",
        "drift_report",
        "predictions_last_n_days",
        "stream_scoring",
    ],
)
def test_matches_sql_with_hot_keys(spark, hot_dir, name):
    check(spark, views(hot_dir), hot_dir, name)
