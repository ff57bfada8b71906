"""Every registered plan against its DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL

TABLES = "events documents embeddings pages benchmark labels".split()


def _rows(pdf):
    cols = sorted(pdf.columns)

    def norm(v):
        if v is None:
            return None
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        if hasattr(v, "item"):
            return norm(v.item())
        if hasattr(v, "isoformat"):
            return str(v)[:26]
        return v

    rows = [tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return c


def test_every_plan_has_sql():
    from trawl.plans.catalog import REGISTRY
    assert set(REGISTRY) <= set(E.oracle_sql())


SPARK_TO_DUCK = {"LongType()": "BIGINT", "IntegerType()": "INTEGER", "DoubleType()": "DOUBLE",
                 "StringType()": "VARCHAR", "TimestampNTZType()": "TIMESTAMP", "BooleanType()": "BOOLEAN"}


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[key])
    spark_types = {f.name: SPARK_TO_DUCK.get(repr(f.dataType), repr(f.dataType)) for f in sdf.schema.fields}
    duck_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    assert spark_types == duck_types
    assert _rows(sdf.toPandas()) == _rows(rel.df())


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["qid", "rank", "doc_id", "score"]
    assert df.count() > 0
