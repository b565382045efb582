"""Every registered query against its SQL, value by value."""

import datetime
import decimal
import math
import os

import pytest

import __spark_entry__ as driver_entry
from layerforge.workload import oracle as entry_sql
from layerforge.workload import queries as entry_points

duckdb = pytest.importorskip("duckdb")

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
FAMILIES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


@pytest.fixture(scope="session")
def db(sf_dir):
    connection = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return connection


def canonical(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(canonical(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_sql():
    assert set(entry_points.queries()) == set(entry_sql.oracle_sql())


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_matches_sql(name, spark, sf_dir, db):
    df = entry_points.queries()[name](spark, sf_dir)
    relation = db.sql(entry_sql.oracle_sql()[name])
    expected_types = {c: FAMILIES[str(t)] for c, t in zip(relation.columns, relation.types)}
    assert dict(df.dtypes) == expected_types
    mine = bag(df.collect(), df.columns)
    theirs = bag(relation.fetchall(), relation.columns)
    assert len(mine) == len(theirs)
    assert len(mine) > 0
    differing = [(a, b) for a, b in zip(mine, theirs) if a != b]
    assert not differing, differing[:3]


@pytest.mark.parametrize(
    "name",
    [
        "category_taxonomy_join",
        "dim_user",
        "dim_user_null_safe",
        "product_catalog",
        "raw_chunk_assignment",
        "upsert_scd1",
        "user_directory",
    ],
)
def test_matches_sql_when_no_side_is_small_and_keys_are_split(name, spark, sf_dir, db):
    large = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
    }
    before = {k: spark.conf.get(k, None) for k in large}
    try:
        for k, v in large.items():
            spark.conf.set(k, v)
        test_matches_sql(name, spark, sf_dir, db)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_entry(spark):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("benchmark tables are not here")
    assert driver_entry.entry(spark).count() > 0
