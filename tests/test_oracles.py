"""Every registered query against its SQL, on the given tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered
from vecloom.plans.oracles import ORACLES
from vecloom.plans.queries import QUERIES


def normal(rows):
    def cell(v):
        if isinstance(v, float):
            return 0.0 if v == 0 else (str(v) if math.isnan(v) else v)
        return v

    return sorted((tuple(cell(v) for v in row) for row in rows), key=repr)


def views(folder):
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def assert_equal(spark, folder, connection, name):
    result = QUERIES[name](spark, folder)
    columns = sorted(result.columns)
    got = normal(tuple(r) for r in result.select(*columns).collect())
    relation = connection.sql(ORACLES[name])
    assert sorted(relation.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = normal(relation.query("t", f"select {quoted} from t").fetchall())
    assert len(got) == len(want)
    assert got == want


@pytest.fixture(scope="module")
def duck(sf_dir):
    return views(sf_dir)


@pytest.fixture(scope="module")
def hot_dir(sf_dir, tmp_path_factory):
    """The tables with a third more rows that are copies, hot classes, NULLs and odd paths."""
    folder = tmp_path_factory.mktemp("hot")
    more = {
        "embeddings": """select (10000 + i)::bigint, embedding, 7::int
            from (select embedding from t where vec_id = 3), range(250) r(i)""",
        "pages": """select (10000 + i)::bigint,
            case i % 4 when 0 then 'nopath' when 1 then null when 2 then '' else 'a://b/hot/1' end,
            '' from range(200) r(i)""",
        "labels": "select (10000 + i)::bigint, 2::int, 3::int from range(200) r(i)",
        "documents": """select (10000 + i)::bigint, 'x', 'en',
            case i % 2 when 0 then 'hôt source' end, 1::bigint from range(800) r(i)""",
    }
    connection = duckdb.connect()
    for name, rows in more.items():
        connection.execute(f"create or replace view t as select * from '{sf_dir}/{name}.parquet'")
        connection.execute(
            f"copy (select * from t union all {rows}) to '{folder}/{name}.parquet' (format parquet)"
        )
    return str(folder)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) <= set(registered.queries())
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    assert_equal(spark, sf_dir, duck, name)


@pytest.mark.parametrize(
    "name",
    [
        "classification_report", "confusion", "correlation", "featurize_maxpool", "hash_split",
        "index_rows", "label_from_path", "pca_project", "per_label_metrics", "string_index",
        "weighted_metrics",
    ],
)
def test_query_equals_sql_on_hot_tables(spark, hot_dir, name):
    assert_equal(spark, hot_dir, views(hot_dir), name)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
