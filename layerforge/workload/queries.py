"""Every registered query: name -> (spark, sf_dir) -> DataFrame.

Audit timestamps are pinned and issue lists are joined to text, so that a result
can be compared with SQL value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerforge.functions import numeric, predicates, text
from layerforge.functions.keys import surrogate_key
from layerforge.operators import chunks, contracts, merge, quality, registry, running
from layerforge.operators.dedup import latest_per_key, newest_first
from layerforge.plans import bronze, gold, silver
from layerforge.sources import landing, scans, schemas
from layerforge.workload import lake, roles

Query = Callable[[SparkSession, str], DataFrame]
CHUNK_ROWS = 50


# A version number tells rows of one id apart when their timestamps do not.
TIES = ("version",)


def _checked_products(raw: DataFrame) -> DataFrame:
    return silver.products_checked(raw, roles.as_of(), roles.TAXONOMY, id_type="bigint")


def _latest_products(raw: DataFrame) -> DataFrame:
    return silver.products(raw, roles.as_of(), roles.TAXONOMY, "bigint", TIES)


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest_products(roles.products(spark, sf_dir))


def _latest_users(raw: DataFrame) -> DataFrame:
    return silver.users(raw, roles.as_of(), TIES)


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest_users(roles.users(spark, sf_dir))


def _issues_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn(quality.ISSUES, F.array_join(quality.ISSUES, ","))


def silver_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _issues_as_text(_products(spark, sf_dir))


def silver_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _issues_as_text(_users(spark, sf_dir))


def quarantine_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = roles.products(spark, sf_dir)
    return _issues_as_text(silver.quarantine(_latest_products(raw), _checked_products(raw)))


def quarantine_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = roles.users(spark, sf_dir)
    return _issues_as_text(
        silver.quarantine(_latest_users(raw), silver.users_checked(raw, roles.as_of()))
    )


def dq_issue_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = _checked_products(roles.products(spark, sf_dir))
    users = silver.users_checked(roles.users(spark, sf_dir), roles.as_of())
    return quality.issue_summary(products, "products").unionByName(
        quality.issue_summary(users, "users")
    )


def _raw_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = silver.flat_products(roles.products(spark, sf_dir), roles.as_of(), "bigint")
    return flat.select("id", "ingestion_ts", "category_raw")


def category_taxonomy_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_category(_raw_categories(spark, sf_dir), "category_raw", roles.TAXONOMY)


def category_taxonomy_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with an external mapping table, here of the parts' own types; some have two rows."""
    types = roles.table(spark, sf_dir, "part").select(F.lower("p_type").alias("t")).distinct()
    mapping = types.where(F.col("t") != "promo").select(
        F.col("t").alias("category_raw"), F.concat(F.lit("cat_"), "t").alias("category")
    )
    twice = mapping.where("length(category_raw) > 5").withColumn("category", F.concat("category", F.lit("_x")))
    return quality.with_category_table(
        _raw_categories(spark, sf_dir), "category_raw", mapping.unionByName(twice)
    )


def safe_double_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = roles.users(spark, sf_dir)
    lat, long = F.col("address.geolocation.lat"), F.col("address.geolocation.long")
    return u.select(
        "id",
        "version",
        numeric.plain_double(lat).alias("lat"),
        numeric.plain_double(long).alias("long"),
        predicates.off_the_globe(numeric.plain_double(lat), numeric.plain_double(long)).alias(
            "off_the_globe"
        ),
        # Exponents, plus signs and bare fractions are not plain decimals.
        numeric.plain_double(F.concat(F.trim(lat), F.lit("e2"))).alias("exponent"),
        numeric.plain_double(F.concat(F.lit("+"), F.trim(lat))).alias("plus_sign"),
    )


def text_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = roles.users(spark, sf_dir)
    first = text.title_case(F.col("name.firstname"))
    last = text.title_case(F.col("name.lastname"))
    street = text.squeezed_title_case(F.col("address.street"))
    return u.select(
        "id",
        "version",
        text.lower_trimmed(F.col("email")).alias("email"),
        first.alias("firstname"),
        text.joined(" ", first, last).alias("full_name"),
        text.title_case(F.col("address.city")).alias("city"),
        street.alias("street"),
        text.joined(", ", street, F.col("address.number")).alias("address_line"),
        text.upper_trimmed(F.col("address.zipcode")).alias("zipcode"),
    )


def phone_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.users(spark, sf_dir).select(
        "id", "version", text.phone_digits(F.col("phone")).alias("phone")
    )


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = roles.table(spark, sf_dir, "events")
    return latest_per_key(events, "user_id", newest_first("ts"), ties=("event_id",))


def dim_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_category(_products(spark, sf_dir), roles.as_of())


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_product(_products(spark, sf_dir), as_of=roles.as_of(), unique=True)


def dim_product_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a category dimension from elsewhere, here made of the raw categories."""
    products = _products(spark, sf_dir)
    given = gold.dim_category(_checked_products(roles.products(spark, sf_dir)), roles.as_of())
    return gold.dim_product(products, given, roles.as_of(), unique=True)


def dim_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_city(_users(spark, sf_dir), roles.as_of())


def dim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_user(_users(spark, sf_dir), as_of=roles.as_of(), unique=True)


def _all_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A city dimension from elsewhere: of every version of every user."""
    return gold.dim_city(silver.users_checked(roles.users(spark, sf_dir), roles.as_of()), roles.as_of())


def dim_user_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    users, cities = _users(spark, sf_dir), _all_cities(spark, sf_dir)
    return gold.dim_user(users, cities, roles.as_of(), unique=True)


def user_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.user_directory(_users(spark, sf_dir), as_of=roles.as_of())


def user_directory_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.user_directory(dim_user_by_join(spark, sf_dir), _all_cities(spark, sf_dir))


def surrogate_key_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of int, bigint and two-column ids; equal numbers of other types differ."""
    part = roles.table(spark, sf_dir, "part")
    return part.select(
        "p_partkey",
        surrogate_key(F.col("p_size")).alias("int_key"),
        surrogate_key(-F.col("p_size")).alias("negative_key"),
        surrogate_key(F.col("p_partkey")).alias("bigint_key"),
        surrogate_key(F.col("p_brand"), F.col("p_type")).alias("text_pair_key"),
    )


def global_rating_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gold.daily_ratings(roles.ratings(spark, sf_dir))
    return running.global_mean(rows, "rating_rate").select(
        F.round("m_global", 6).alias("m_global"), F.lit(numeric.PRIOR_VOTES).alias("c_prior")
    )


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_product_metrics_daily(
        roles.ratings(spark, sf_dir), roles.rating_order(), keep_id=True
    )


def fact_product_metrics_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir).withColumn(
        "rating_bayes_score", F.round("rating_bayes_score", 6)
    )


def latest_dt_per_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gold.daily_ratings(roles.ratings(spark, sf_dir))
    return gold.latest_dt_per_product(
        rows.select(surrogate_key(F.col("id")).alias("product_key"), "dt")
    )


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = gold.product_catalog(_products(spark, sf_dir), None, _fact(spark, sf_dir))
    return catalog.withColumn("rating_bayes_score", F.round("rating_bayes_score", 6))


def product_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalog(spark, sf_dir)


def product_catalog_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain of joins over a product and a category dimension."""
    given = gold.dim_category(_checked_products(roles.products(spark, sf_dir)), roles.as_of())
    catalog = gold.product_catalog(dim_product_by_join(spark, sf_dir), given, _fact(spark, sf_dir))
    return catalog.withColumn("rating_bayes_score", F.round("rating_bayes_score", 6))


def value_change_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change of an event's value since the user's event before; the first counts in full."""
    order = F.struct("ts", "event_id")
    events = roles.table(spark, sf_dir, "events").withColumn("at", order)
    before = running.previous_value("value", "user_id", "at")
    return events.select("event_id", "user_id", F.round(running.increment(F.col("value"), before), 6).alias("change"))


def product_catalog_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.newest_in_catalog(_catalog(spark, sf_dir), 20)


def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts on the inputs before cleaning, where they do fail."""
    products = roles.products(spark, sf_dir).withColumn("rating_rate", F.col("rating.rate"))
    return contracts.all_contracts(
        contracts.row_contracts(
            products,
            {
                "products.id not null": contracts.not_null("id"),
                "products.category not null": contracts.not_null("category"),
                "products.rating_rate range": contracts.rate_in_range(),
            },
        ),
        contracts.row_contracts(
            roles.users(spark, sf_dir), {"users.id not null": contracts.not_null("id")}
        ),
        contracts.unique_contract(
            gold.daily_ratings(roles.ratings(spark, sf_dir)), "ratings.grain", ["dt", "id"]
        ),
        contracts.key_collisions(
            roles.table(spark, sf_dir, "part").select(
                surrogate_key(F.col("p_size")).alias("size_key"), "p_partkey"
            ),
            "parts.size_key collisions",
            "size_key",
            ["p_partkey"],
        ),
    )


def bronze_one_per_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per id of a raw batch; every row without an id stays."""
    batch = roles.products(spark, sf_dir).withColumn("file_origin", F.col("version"))
    return bronze.one_per_id(batch).select("id", "version", "title", "price")


def accepted_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other side of the quarantine."""
    return quality.accepted(_users(spark, sf_dir)).select("id", "email", "username", "zipcode")


def dim_user_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with half an address find their city too."""
    dim = gold.dim_user(_users(spark, sf_dir), as_of=roles.as_of(), unique=True, null_safe=True)
    return dim.select("user_id", "city_key")


def latest_fact_per_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = running.latest_day(
        _fact(spark, sf_dir), "product_id", "dt", "rating_count_cum", "rating_bayes_score"
    )
    return last.withColumn("rating_bayes_score", F.round("rating_bayes_score", 6))


def upsert_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second versions, or else first ones, as the target, all others as updates: newer, older and without a time."""
    keyed = roles.products(spark, sf_dir).where(F.col("id").isNotNull())
    flat = keyed.select(
        "id", F.trim("title").alias("title"), numeric.cents(F.col("price")).alias("price"),
        "ingestion_ts", "version",
    )
    held = F.when(F.col("id") % 3 == 0, 1).otherwise(2)
    return merge.upsert(
        flat.where(F.col("version") == held),
        flat.where(F.col("version") != held),
        "id",
        newest_first("ingestion_ts"),
        TIES,
    )


def schema_evolution_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first batch without image and description, a later one without title."""
    rows = roles.products(spark, sf_dir)
    older = rows.where("version = 1").select("id", "version", "title", "price")
    newer = rows.where("version > 1").select("id", "version", "price", "image", "description")
    return merge.evolved_union(older, newer)


def raw_chunk_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = roles.table(spark, sf_dir, "orders").select(
        F.trunc(F.to_date("o_orderdate"), "month").alias("batch"), "o_orderkey"
    )
    return chunks.chunk_numbers(orders, ["batch"], "o_orderkey", CHUNK_ROWS)


def raw_chunk_assignment_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks by a sparse 64-bit key."""
    orders = roles.table(spark, sf_dir, "orders").select(
        F.trunc(F.to_date("o_orderdate"), "year").alias("batch"),
        (F.col("o_orderkey") * 1_000_000_007).alias("order_no"),
    )
    return chunks.chunk_numbers(orders, ["batch"], "order_no", CHUNK_ROWS)


def key_registry_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered keys of the customers' places, NULLs included, in one first run."""
    cities = silver.users_checked(roles.users(spark, sf_dir), roles.as_of()).select("city", "zipcode")
    return registry.new_keys(cities, ["city", "zipcode"])


def key_registry_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names in three runs: names with an earlier key keep it, others are numbered on."""
    parts = roles.table(spark, sf_dir, "part").select(F.col("p_name").alias("name"), "p_partkey")
    known = None
    for run in range(3):
        seen = parts.where(F.col("p_partkey") % 3 <= run)
        fresh = registry.new_keys(seen, ["name"], known).withColumn("run", F.lit(run))
        known = fresh if known is None else known.unionByName(fresh)
    every = known.agg(F.count(F.lit(1)).alias("n_keys"), F.countDistinct("key").alias("n_distinct"), F.max("key").alias("last_key"))
    by_run = known.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first"), F.max("key").alias("last"))
    whole = every.select(F.lit(-1).alias("run"), F.col("n_keys").alias("n"), (F.col("n_keys") - F.col("n_distinct") + 1).alias("first"), F.col("last_key").alias("last"))
    return by_run.unionByName(whole)


def bronze_products_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NDJSON lines with integer prices, text ids, a text where a struct belongs, and broken lines, typed."""
    lines = roles.product_lines(spark, sf_dir)
    return scans.parsed_lines(lines, schemas.entity_schema("products", "bigint")).select(
        "k", "id", "title", "price", "category", "rating.rate", "rating.count"
    )


def bronze_users_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = roles.user_lines(spark, sf_dir)
    return scans.parsed_lines(lines, schemas.entity_schema("users", "bigint")).select(
        "k", "id", "email", "__v", "name.firstname", "address.number", "address.geolocation.lat"
    )


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of every line that does not fit, why, and what could be read of it."""
    lines = roles.product_lines(spark, sf_dir)
    rows = scans.parsed_lines(lines, schemas.entity_schema("products", "bigint"), broken=True)
    reason = scans.broken_reason().alias("reason")
    return rows.where(F.col(scans.BROKEN).isNotNull()).select("k", "id", "title", reason, scans.BROKEN)


def payload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API responses: pages of customers as arrays, and single objects."""
    rows = scans.payload_rows(
        roles.customer_payloads(spark, sf_dir), T.StructType.fromDDL("id bigint, name string"), "body"
    )
    return rows.select("page", "kind", "id", "name")


def source_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by the table whose file they were read from, by the name in the scan's own metadata, and files without such a name."""
    parts = [
        roles.table(spark, sf_dir, t).select(F.col("_metadata.file_path").alias("file_origin"), F.lit(t).alias("read"))
        for t in ("part", "customer", "supplier")
    ]
    return rows_by_source(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def rows_by_source(rows: DataFrame) -> DataFrame:
    """`source, n_rows, n_unnamed` of rows with `file_origin` and the table that was `read`, which stands for a name that is not there."""
    by_file = rows.groupBy("read", "file_origin").agg(F.count(F.lit(1)).alias("n"))
    # A table is one file, or a folder of that name.
    name = F.coalesce(F.regexp_extract("file_origin", r"([^/]+)\.parquet(?:/[^/]*)?$", 1), F.lit(""))
    named = by_file.select("read", "n", name.alias("name"))
    return named.groupBy(F.when(F.col("name") == "", F.col("read")).otherwise(F.col("name")).alias("source")).agg(
        F.sum("n").alias("n_rows"), F.count_if(F.col("name") == "").alias("n_unnamed")
    )


def ndjson_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the products, read back field by field."""
    fields = ["id", "title", "price", "description", "category", "image", "rating"]
    lines = roles.products(spark, sf_dir).select(
        "version", text.ndjson_line(*fields).alias("line")
    )
    back = F.from_json(
        "line",
        "id bigint, title string, price double, description string, category string, "
        "image string, rating struct<rate: double, count: int>",
    )
    return lines.select(
        "version",
        back.alias("r"),
        F.json_object_keys("line").alias("keys"),
    ).select(
        "version",
        "r.id",
        "r.title",
        "r.price",
        "r.description",
        "r.category",
        "r.image",
        F.col("r.rating.rate").alias("rating_rate"),
        F.col("r.rating.count").alias("rating_count"),
        F.array_join("keys", ",").alias("keys"),
    )


def json_line_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.line_report(roles.event_lines(spark, sf_dir))


def flat_relational_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.relational_products(roles.products(spark, sf_dir), roles.as_of())


def queries() -> dict[str, Query]:
    listed = [
        silver_products,
        silver_users,
        quarantine_products,
        quarantine_users,
        dq_issue_summary,
        category_taxonomy_map,
        category_taxonomy_join,
        safe_double_cast,
        text_normalise,
        phone_clean,
        dedup_latest,
        dim_category,
        dim_product,
        dim_product_by_join,
        dim_city,
        dim_user,
        dim_user_by_join,
        user_directory,
        user_directory_by_join,
        surrogate_key_int,
        global_rating_mean,
        fact_product_metrics_daily,
        latest_dt_per_product,
        product_catalog,
        product_catalog_by_join,
        value_change_per_user,
        product_catalog_top20,
        latest_fact_per_product,
        bronze_one_per_id,
        accepted_users,
        dim_user_null_safe,
        contract_violations,
        upsert_scd1,
        schema_evolution_union,
        raw_chunk_assignment,
        raw_chunk_assignment_sparse,
        key_registry_first,
        key_registry_next,
        bronze_products_typed,
        bronze_users_typed,
        broken_lines,
        payload_rows,
        source_lineage,
        ndjson_lines,
        json_line_validation,
        flat_relational_products,
        lake.landed_products,
        lake.lake_catalog,
        lake.lake_measures,
    ]
    return {q.__name__: q for q in listed}
