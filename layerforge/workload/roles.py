"""Benchmark tables in the roles of the pipeline's inputs.

The tables are clean, so each role derives its defects from the row's own key,
the same way every time: missing ids, blank titles, negative prices, unmapped
categories, malformed text, several versions of a row. Ids stay bigint, as in
the tables, because table keys outgrow an int at large scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-02-01 00:00:00"

TAXONOMY = {
    "economy": "value_range",
    "small": "compact",
    "medium": "mid_size",
    "large": "full_size",
    "standard": "standard",
}


def as_of() -> Column:
    return F.expr(f"TIMESTAMP_NTZ'{AS_OF}'")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_VERSION_TIME = "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(version)"


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze products: one to three versions of every part.

    The third version of some parts has no timestamp and must lose to the others.
    """
    versions = table(spark, sf_dir, "part").selectExpr(
        "*", "p_partkey AS k", "explode(sequence(1, int(1 + p_partkey % 3))) AS version"
    )
    return versions.selectExpr(
        "CASE WHEN k % 101 <> 0 THEN k END AS id",
        "CASE WHEN k % 97 = 0 THEN '' ELSE concat('  ', p_name, ' ') END AS title",
        "CASE WHEN k % 50 = 0 THEN -p_retailprice ELSE p_retailprice + version * 1.003D END AS price",
        "CASE WHEN k % 37 <> 0 THEN concat(' made by ', p_brand) END AS description",
        "CASE WHEN k % 41 <> 0 THEN concat(' ', p_type, ' ') END AS category",
        "CASE WHEN k % 43 <> 0 THEN concat(CASE WHEN k % 11 = 0 THEN 'ftp' ELSE 'https' END,"
        " '://img.example.com/', string(k)) END AS image",
        "named_struct('rate', p_size / 8.0D, 'count', p_size - 3) AS rating",
        f"CASE WHEN NOT (version = 3 AND k % 4 = 0) THEN {_VERSION_TIME} END AS ingestion_ts",
        "version",
    )


def _degrees(divisor: int) -> str:
    value = f"string(CAST(c_acctbal / {divisor} AS decimal(12,4)))"
    return f"CASE WHEN k % 23 = 0 THEN 'n/a' ELSE concat(' ', {value}, ' ') END"


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze users: one or two versions of every customer."""
    versions = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .selectExpr(
            "*",
            "c_custkey AS k",
            "string(c_custkey % 997) AS short",
            "explode(sequence(1, int(1 + c_custkey % 2))) AS version",
        )
    )
    return versions.selectExpr(
        "CASE WHEN k % 103 <> 0 THEN k END AS id",
        "CASE WHEN k % 29 <> 0 THEN concat(' ', CASE WHEN k % 13 = 0 THEN c_name"
        " ELSE replace(c_name, '#', '.') END, '@Mail.Example.COM ') END AS email",
        "CASE WHEN k % 31 = 0 THEN '' WHEN k % 37 <> 0 THEN concat(' ', c_name, ' ') END AS username",
        "concat('pw', string(k)) AS password",
        "concat(' +1.570-', lpad(short, 3, '0'), 'x7033 (ab)', string(version)) AS phone",
        "version AS __v",
        "named_struct("
        "'firstname', CASE WHEN k % 17 <> 0 THEN concat(' ', lower(c_mktsegment), ' ') END,"
        "'lastname', concat('mc ', c_name)) AS name",
        "named_struct("
        "'city', CASE WHEN k % 47 <> 0 THEN concat('  port ', n_name, ' ') END,"
        "'street', concat(' ', c_mktsegment, '   high ', char(9), ' st '),"
        "'number', CASE WHEN k % 53 <> 0 THEN int(k % 500) END,"
        "'zipcode', CASE WHEN k % 19 = 0 THEN NULL WHEN k % 7 = 0 THEN lpad(short, 4, '0')"
        " WHEN k % 5 = 0 THEN concat(lpad(short, 5, '0'), '-1234 ') ELSE lpad(short, 5, '0') END,"
        f"'geolocation', named_struct('lat', {_degrees(50)}, 'long', {_degrees(25)})) AS address",
        "'customer' AS file_origin",
        f"{_VERSION_TIME} AS ingestion_ts",
        "version",
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily ratings of products: every line item, several per product and day."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_partkey AS id",
        "CASE WHEN l_linenumber % 2 = 0 THEN l_shipdate END AS processed_at",
        "l_shipdate AS ingestion_ts",
        "l_orderkey AS order_no",
        "l_extendedprice AS price",
        "CASE WHEN l_linenumber <> 7 THEN l_discount * 50 END AS rating_rate",
        "CASE WHEN l_tax > 0 THEN int(l_quantity) END AS rating_count",
    )


def rating_order() -> Column:
    """Line items have no time of day, and their order and line numbers repeat.

    The closing row of a day has the largest order number, price and rate, in one
    number of 38 digits: any bigint, then prices below 10^11 in cents, of either
    sign, then tenths of a rate. A larger value raises an overflow. Rows that tie
    have equal closing values.
    """
    return F.expr(
        "CAST(order_no AS DECIMAL(20,0)) * CAST(10000000000000000 AS DECIMAL(17,0))"
        " + CAST(CAST(round(price * 100) AS DECIMAL(13,0)) * 100"
        " + coalesce(int(round(rating_rate * 10)) + 1, 0) AS DECIMAL(17,0))"
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of two files per event type; every 29th line is cut short."""
    return table(spark, sf_dir, "events").selectExpr(
        "CASE WHEN event_id % 29 = 0 THEN substring(props, 1, length(props) - 1)"
        " ELSE props END AS value",
        "concat_ws('-', event_type, string(event_id % 2)) AS file_origin",
    )


def product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NDJSON text of the parts (`k, value`), good and bad by the part's key."""
    good = (
        "to_json(named_struct('id', p_partkey + 3000000000, 'title', p_name, 'price', p_size,"
        " 'category', p_type, 'rating', named_struct('rate', p_size / 8.0D, 'count', p_size)))"
    )
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS k",
        f"CASE WHEN p_partkey % 13 = 0 THEN substring({good}, 1, 20)"
        f" WHEN p_partkey % 11 = 0 THEN replace({good}, '\"id\":', '\"id\":\"x\",\"other\":')"
        " WHEN p_partkey % 7 = 0 THEN concat('{\"id\":', p_partkey, ',\"rating\":\"none\"}')"
        f" ELSE {good} END AS value",
    )


def user_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NDJSON text of the customers (`k, value`); some names are a text instead of a struct."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS k",
        "CASE WHEN c_custkey % 9 = 0 THEN concat('{\"id\":', c_custkey, ',\"name\":\"John\",\"email\":\"j@e.com\"}')"
        " WHEN c_custkey % 10 = 0 THEN '{broken'"
        " ELSE to_json(named_struct('id', c_custkey, 'email', lower(c_name), '__v', c_nationkey,"
        " 'name', named_struct('firstname', c_mktsegment), 'address', named_struct('number', c_nationkey,"
        " 'geolocation', named_struct('lat', string(c_nationkey))))) END AS value",
    )


PAGE = 100


def customer_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses (`page, kind, body`): an array per page of 100 customer numbers, an object per customer."""
    item = "named_struct('id', c_custkey, 'name', c_name)"
    customers = table(spark, sf_dir, "customer").selectExpr(f"c_custkey div {PAGE} AS page", f"{item} AS item")
    arrays = customers.groupBy("page").agg(F.to_json(F.collect_list("item")).alias("body"))
    objects = customers.select("page", F.to_json("item").alias("body"))
    return arrays.withColumn("kind", F.lit("array")).unionByName(objects.withColumn("kind", F.lit("object")))
