"""Every query against its SQL, by different routes, on the smallest tables."""

import os
import re

import duckdb
import pytest

from lodestone import index_queries, more_queries, scale_queries  # noqa: F401  they register their queries
from lodestone import queries as Q

DATA = "/root/testdata"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/sf0.001/{t}.parquet'")
    return con


def plain(v):
    return round(v, 6) if isinstance(v, float) else v.isoformat() if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_against_sql(spark, duck, name):
    df = Q.QUERIES[name](spark, f"{DATA}/sf0.001")
    cur = duck.execute(Q.ORACLE_SQL[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted(repr([plain(r[columns.index(c)]) for c in sorted(columns)]) for r in cur.fetchall())
    assert sorted(repr([plain(r[c]) for c in sorted(columns)]) for r in df.collect()) == expected


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.ORACLE_SQL)))
def test_without_sql(spark, name):
    assert Q.QUERIES[name](spark, f"{DATA}/sf0.001").count() > 0


def test_entry(spark):
    import __spark_entry__ as E

    assert set(Q.QUERIES) <= set(E.queries()) and set(Q.ORACLE_SQL) <= set(E.oracle_sql())
    assert E.entry(spark).columns == ["segment", "n"]


def test_no_import_of_the_corpus_package():
    root = os.path.dirname(Q.__file__)
    for folder, _, names in os.walk(root):
        if os.path.basename(folder) != "llm":
            for n in names:
                if n.endswith(".py"):
                    assert not re.search(r"^\s*(from|import)\s.*\bllm\b", open(os.path.join(folder, n)).read(), re.M), n


@pytest.mark.parametrize("name", ["json_round_trip", "yaml_round_trip", "turtle_round_trip"])
def test_documents_are_made_by_tasks(spark, name, monkeypatch):
    """No text passes through the driver."""

    def refused(*_):
        raise AssertionError("rows were brought to the driver")

    for way in ("collect", "toLocalIterator", "toPandas"):
        monkeypatch.setattr(type(spark.range(1)), way, refused)
    out = Q.QUERIES[name](spark, f"{DATA}/sf0.001")
    monkeypatch.undo()
    assert out.count() > 0


def test_type_slugs_in_small_tasks(spark, monkeypatch):
    from lodestone import more_queries

    rows = lambda df: sorted(map(tuple, df.collect()))
    whole = rows(Q.QUERIES["type_slugs"](spark, f"{DATA}/sf0.001"))
    monkeypatch.setattr(more_queries, "TASK_ROWS", 500)
    some = Q.QUERIES["type_slugs"](spark, f"{DATA}/sf0.001")
    assert rows(some) == whole and some.rdd.getNumPartitions() >= 12
