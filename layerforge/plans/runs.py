"""Runs that write the layers. Every run can be repeated and leaves the same tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerforge.functions import numeric
from layerforge.operators import contracts as rules
from layerforge.operators import quality, registry, trends
from layerforge.operators.dedup import newest_first
from layerforge.operators.merge import by_range, evolved_union, upsert
from layerforge.plans import bronze as bronze_plan
from layerforge.plans import gold, silver
from layerforge.sources import landing, scans, sinks


# Formats whose tables are plain files in folders: slices are switched folder by folder.
FORMATS = ("parquet", "orc")

# `Lake.keys`: numbers from a registry instead of hashes.
REGISTRY = "registry"


@dataclass(frozen=True)
class Lake:
    """Where the layers live and how they are written."""

    base: str
    source: str = "shop"
    fmt: str = "parquet"
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    keys: str = "murmur3"
    max_lines: int = landing.MAX_LINES_PER_FILE
    id_type: str = "int"
    taxonomy: Mapping[str, str] = field(default_factory=lambda: dict(silver.CATEGORIES))

    def __post_init__(self) -> None:
        if self.fmt not in FORMATS:
            raise ValueError(f"unknown format {self.fmt!r}, expected one of {FORMATS}")

    @property
    def hashed(self) -> str:
        """The algorithm of keys that are computed from the row; with `keys="registry"` they are replaced."""
        return "murmur3" if self.keys == REGISTRY else self.keys

    def path(self, layer: str, table: str) -> str:
        return f"{self.base.rstrip('/')}/{layer}/{self.source}/{table}"

    def raw(self, entity: str, day: date, batch_id: str) -> str:
        return landing.raw_folder(
            f"{self.base.rstrip('/')}/raw", self.source, entity, day.isoformat(), batch_id
        )


def land(
    items: DataFrame, lake: Lake, entity: str, day: date, batch_id: str
) -> str | None:
    """RAW: land and validate a batch. Returns its folder, None when there is nothing to land."""
    folder = lake.raw(entity, day, batch_id)
    return folder if landing.write_raw(items, folder, lake.max_lines) else None


def _check_days(spark: SparkSession) -> None:
    """Days are UTC days, whatever session the run is given."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"days are UTC days, but the session's time zone is {zone}")


def _stamp(as_of: datetime) -> Column:
    """`as_of` as a UTC timestamp; without a zone it is UTC, not the zone of the driver."""
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=UTC)
    return F.timestamp_micros(F.lit(int(as_of.timestamp() * 1_000_000)))


def to_bronze(
    spark: SparkSession, lake: Lake, entity: str, raw: str, batch_id: str, as_of: datetime
) -> DataFrame:
    """BRONZE: one slice per batch. Also a view `bronze_<entity>` for ad-hoc SQL.

    `<entity>_landed` records the day of every batch, the first one where a batch comes again.
    """
    _check_days(spark)
    sinks.create_namespace(spark, lake.bronze)
    rows = bronze_plan.bronze(spark, entity, raw, _stamp(as_of), lake.id_type)
    # Small categories share a file and lie together inside it; none becomes a folder name.
    rows = rows.sortWithinPartitions("category") if entity == "products" else rows
    log, day = f"{lake.bronze}.{entity}_landed", as_of.date().isoformat()
    first = None
    if spark.catalog.tableExists(log):
        first = spark.table(log).where(F.col("batch_id") == batch_id).agg(F.min("landed_on").alias("day")).first()["day"]
    landed = spark.createDataFrame([(min(first or day, day),)], "landed_on string")
    sinks.publish_slice(landed, log, lake.path("bronze", f"{entity}_landed"), "batch_id", batch_id, lake.fmt)
    table = sinks.publish_slice(
        rows, f"{lake.bronze}.{entity}", lake.path("bronze", entity), "batch_id", batch_id, lake.fmt
    )
    sinks.view(table, f"bronze_{entity}")
    return table


def _last_before(spark: SparkSession, table: str, column: str, day: str, until: bool = False) -> str | None:
    """The last slice before `day`, or up to and with it. One name comes to the driver."""
    values = sinks.slices(spark, table, column)
    wanted = F.col("value") <= day if until else F.col("value") < day
    return values.where(wanted).agg(F.max("value").alias("last")).first()["last"]


def _readable(spark: SparkSession, lake: Lake, entity: str, day: str, batch_id: str | None) -> DataFrame:
    """`batch`: the batches that a run of `day` may read.

    Those landed up to that day. A day that later snapshots follow reads what it recorded when it last ran, so
    running it again does not bring in anything that came afterwards. The named batch is always read.
    """
    held = sinks.slices(spark, f"{lake.bronze}.{entity}", "batch_id").select(F.col("value").alias("batch"))
    days = sinks.slices(spark, f"{lake.silver}.{entity}", "snapshot")
    log = f"{lake.silver}.{entity}_batches"
    own = sinks.slices(spark, log, "snapshot").where(F.col("value") == day)
    if not days.where(F.col("value") > day).isEmpty() and not own.isEmpty():
        seen = spark.table(log).where(F.col("snapshot") == day).select("batch")
    else:
        landed = spark.table(f"{lake.bronze}.{entity}_landed").select(F.col("batch_id").alias("batch"), "landed_on")
        # A batch that was written without a record counts as there from the start.
        seen = held.join(landed, "batch", "left").where((F.col("landed_on") <= day) | F.col("landed_on").isNull()).select("batch")
    if batch_id is not None:
        seen = seen.union(spark.createDataFrame([(batch_id,)], "batch string"))
    return held.join(seen, "batch", "left_semi")


def _names(batches: DataFrame) -> list[str]:
    return sorted(r["batch"] for r in batches.collect())


def to_silver(
    spark: SparkSession, lake: Lake, entity: str, as_of: datetime, batch_id: str | None = None
) -> DataFrame:
    """SILVER: one snapshot per day, the latest row of every id, and its quarantine.

    Without `batch_id` all batches landed by that day are read. With it, the run reads that batch and
    every other batch landed by then that the snapshot of the last day before does not hold
    yet, and merges them into that snapshot (SCD1, newest first). So several
    batches of one day, late batches and repeated ones give the same rows as
    reading all of them, while the cost follows the new batches and one
    snapshot. Each snapshot records its batches in `<entity>_batches`; an old day that is run again reads those
    and the named one, whatever has landed since.

    The quarantine keeps the text and the file of lines that did not parse. What a run wrote is counted while it is
    written, into `dq_runs`.
    """
    _check_days(spark)
    sinks.create_namespace(spark, lake.silver)
    day, stamp = as_of.date().isoformat(), _stamp(as_of)
    name, held = f"{lake.silver}.{entity}", f"{lake.silver}.{entity}_quarantine"
    log = f"{lake.silver}.{entity}_batches"
    bronze = spark.table(f"{lake.bronze}.{entity}")
    readable = _readable(spark, lake, entity, day, batch_id)
    before = None if batch_id is None else _last_before(spark, name, "snapshot", day)
    included = None
    if before is None:
        # Names of batches: none, unless some landed after the day.
        later = sinks.slices(spark, f"{lake.bronze}.{entity}", "batch_id").select(F.col("value").alias("batch"))
        hidden = _names(later.join(readable, "batch", "left_anti"))
        source = bronze.where(~F.col("batch_id").isin(hidden)) if hidden else bronze
    else:
        included = spark.table(log).where(F.col("snapshot") == before).select("batch")
        # The names of the batches to read, usually one or a few.
        new = _names(readable.join(included, "batch", "left_anti"))
        source = bronze.where(F.col("batch_id").isin(batch_id, *new))

    # Bronze holds one row per id and batch, so the batch tells versions apart.
    ties = ("batch_id",)
    typed = silver.with_typed_id(source, lake.id_type)
    keyless = quality.without_key(typed, "id")
    if entity == "products":
        carry = ("batch_id", "file_origin", scans.BROKEN)
        latest = silver.products(source, stamp, lake.taxonomy, lake.id_type, ties, carry)
        keyless = silver.products_checked(keyless, stamp, lake.taxonomy, lake.id_type, carry)
    else:
        carry = ("batch_id", scans.BROKEN)
        latest = silver.users(source, stamp, ties, lake.id_type, carry)
        keyless = silver.users_checked(keyless, stamp, lake.id_type, carry)

    if before is None:
        latest = by_range(latest, "id")

    def carried(table: str) -> DataFrame:
        rows = spark.table(table).where(F.col("snapshot") == before).drop("snapshot")
        return rows.withColumn("processed_at", stamp)

    if before is not None:
        ids = typed.select("id")
        # Untouched rows keep the order of their files, so a snapshot stays clustered from day to day.
        latest = upsert(carried(name), latest, "id", newest_first("ingestion_ts"), ties, keys=ids, clustered=True)
        read = source.select("batch_id").distinct()
        others = quality.without_key(carried(held), "id").join(read, "batch_id", "left_anti")
        keyless = evolved_union(others, keyless)

    def write(df: DataFrame, table: str) -> DataFrame:
        path = lake.path("silver", table)
        return sinks.publish_slice(df, f"{lake.silver}.{table}", path, "snapshot", day, lake.fmt)

    watched = trends.watch(latest, silver.tags(entity))
    table = write(watched.rows, entity)
    snapshot = table.where(F.col("snapshot") == day).drop("snapshot")
    write(silver.quarantine(snapshot, keyless), f"{entity}_quarantine")
    batches = readable if included is None else included.union(readable).distinct()
    # The version names this writing of the snapshot: what is built on it can tell that it changed.
    write(batches.withColumn("version", F.lit(uuid.uuid4().hex)), f"{entity}_batches")
    sinks.publish_slice(
        watched.measured(spark, entity, day), f"{lake.silver}.dq_runs", lake.path("silver", "dq_runs"), "run", f"{entity}.{day}", lake.fmt
    )
    sinks.view(table, f"silver_{entity}")
    return table


def dq_spikes(spark: SparkSession, lake: Lake, entity: str, as_of: datetime, **rule) -> DataFrame:
    """Measures of the day's snapshot that are far from those of the days before (see `operators.trends.spikes`)."""
    runs = spark.table(f"{lake.silver}.dq_runs").where(F.col("entity") == entity)
    return trends.spikes(runs, as_of.date().isoformat(), **rule)


def _score_view(spark: SparkSession, lake: Lake) -> DataFrame:
    """The fact as a view: stored days, scored with the mean rate of all of them when it is read."""
    days, rates = f"{lake.gold}.product_days", f"{lake.gold}.rating_days"
    mean = f"(SELECT coalesce(sum(rate_sum) / sum(rate_count), 0D) FROM {rates})"
    spark.sql(
        f"CREATE OR REPLACE VIEW {lake.gold}.fact_product_metrics_daily AS "
        "SELECT to_date(dt) AS dt, product_key, product_id, price, rating_rate, rating_count_incremental, "
        f"rating_count_cum, ({numeric.PRIOR_VOTES} * {mean} + rating_rate * rating_count_cum) "
        f"/ ({numeric.PRIOR_VOTES} + rating_count_cum) AS rating_bayes_score FROM {days} "
        "WHERE coalesce(present, true)"
    )
    return spark.table(f"{lake.gold}.fact_product_metrics_daily")


def _fact_states(spark: SparkSession, lake: Lake) -> dict[str, tuple]:
    """What every stored day of the fact was made of: the snapshot's version, the totals before, its own totals.

    One short row per day comes to the driver, never more.
    """
    rates = f"{lake.gold}.rating_days"
    if not spark.catalog.tableExists(rates) or "totals" not in spark.table(rates).columns:
        return {}
    rows = spark.table(rates).select("dt", "version", "built_on", "totals").collect()
    return {r["dt"]: (r["version"], r["built_on"], r["totals"]) for r in rows}


def register_keys(spark: SparkSession, lake: Lake, name: str, ids: DataFrame, day: str) -> DataFrame:
    """Number the ids (all columns of `ids`) that the registry `<name>_keys` lacks. Returns the whole registry.

    A run adds a slice of its own; keys that were given are never changed, and a repeated run gives no new ones.
    """
    table, natural = f"{lake.gold}.{name}_keys", ids.columns
    known = spark.table(table) if spark.catalog.tableExists(table) else None
    fresh = registry.new_keys(ids, natural, known)
    if known is not None:
        fresh = known.where(F.col("run") == day).select(*natural, "key").unionByName(fresh)

    def contracts(rows: DataFrame) -> DataFrame:
        return rules.all_contracts(
            rules.unique_contract(rows, f"{name}_keys.key", ["key"]), rules.unique_contract(rows, f"{name}_keys.id", natural)
        )

    return sinks.publish_slice(fresh, table, lake.path("gold", f"{name}_keys"), "run", day, lake.fmt, contracts)


def _write_fact_day(spark: SparkSession, lake: Lake, day: str, before: str | None, built_on: int | None, version: str | None) -> int | None:
    """Write the fact rows of one day from its snapshot and the totals of the day before. Returns its own totals."""
    days, rates = f"{lake.gold}.product_days", f"{lake.gold}.rating_days"
    totals = (
        spark.createDataFrame([], f"product_id {lake.id_type}, rating_count_cum bigint")
        if before is None
        else spark.table(days).where(F.col("dt") == before).select("product_id", "rating_count_cum")
    )
    snapshot = spark.table(f"{lake.silver}.products").where(F.col("snapshot") == day)
    rows = gold.fact_of_day(snapshot, F.lit(day), totals, 0.0, keys=lake.hashed).drop("rating_bayes_score")
    if lake.keys == REGISTRY:
        numbers = register_keys(spark, lake, "product", snapshot.select(F.col("id").alias("product_id")), day)
        rows = registry.rekeyed(rows, "product_key", ["product_id"], numbers, ["product_id"])

    def contracts(own: DataFrame) -> DataFrame:
        return rules.all_contracts(
            rules.row_contracts(own, {"fact.rating_rate": rules.rate_in_range()}),
            rules.unique_contract(own, "fact.grain", ["product_id"]),
        )

    table = sinks.publish_slice(rows, days, lake.path("gold", "product_days"), "dt", day, lake.fmt, contracts)
    # One number that differs when any total does.
    mark = F.when(F.col("rating_count_cum") != 0, F.xxhash64("product_id", "rating_count_cum"))
    summed = table.where(F.col("dt") == day).agg(
        F.coalesce(F.sum("rating_rate"), F.lit(0.0)).alias("rate_sum"),
        F.count("rating_rate").alias("rate_count"),
        F.coalesce(F.bit_xor(mark), F.lit(0).cast("bigint")).alias("totals"),
    )
    state = summed.withColumns({"built_on": F.lit(built_on).cast("bigint"), "version": F.lit(version).cast("string")})
    stored = sinks.publish_slice(state, rates, lake.path("gold", "rating_days"), "dt", day, lake.fmt)
    return stored.where(F.col("dt") == day).first()["totals"]


def _fact_days(spark: SparkSession, lake: Lake, day: str) -> None:
    """Bring the fact up to `day`, and every later day that it holds into line with what came before.

    A day is written when it is missing (up to `day`), when its snapshot was written anew, or when the totals of the
    day before are not those it was built on. So a correction of an old day moves forward through the
    running counts of all later days, a run that was broken off is completed by the next one, and without
    corrections only the new day is written, at the cost of one snapshot and one row per product.
    """
    snapshots = spark.table(f"{lake.silver}.products_batches")
    has_version = "version" in snapshots.columns
    version = F.max("version") if has_version else F.lit(None).cast("string")
    # Names of days: one row per day comes to the driver.
    written = {r["snapshot"]: r["version"] for r in snapshots.groupBy("snapshot").agg(version.alias("version")).collect()}
    there = sorted(r["value"] for r in sinks.slices(spark, f"{lake.silver}.products", "snapshot").collect())
    states = _fact_states(spark, lake)
    before, totals = None, None
    for one in there:
        state = states.get(one)
        if state is None and one > day:
            continue
        if state is None or state[:2] != (written.get(one), totals):
            totals = _write_fact_day(spark, lake, one, before, totals, written.get(one))
        else:
            totals = state[2]
        before = one


def to_gold(spark: SparkSession, lake: Lake, as_of: datetime) -> dict[str, DataFrame]:
    """GOLD: dimensions and marts from the last snapshots up to the day, and the day's rows of the fact.

    An entity without any snapshot up to the day is an error. Nothing after the
    day takes part, so an old day can be run again; the fact's later days get the corrected
    running counts, while dimensions and marts show the day that ran last.
    """
    _check_days(spark)
    sinks.create_namespace(spark, lake.gold)
    day, stamp = as_of.date().isoformat(), _stamp(as_of)

    def current(entity: str) -> tuple[DataFrame, str]:
        last = _last_before(spark, f"{lake.silver}.{entity}", "snapshot", day, until=True)
        if last is None:
            raise ValueError(f"there is no snapshot of {entity} up to {day}")
        return spark.table(f"{lake.silver}.{entity}").where(F.col("snapshot") == last), last

    def publish(name: str, df: DataFrame, check=None) -> DataFrame:
        return sinks.publish(df, f"{lake.gold}.{name}", lake.path("gold", name), lake.fmt, (), check)

    def keyed(table: str, key: str, natural: tuple[str, ...], not_null: str, source: DataFrame | None = None):
        def check(df: DataFrame) -> DataFrame:
            frames = [
                rules.row_contracts(df, {f"{table}.{not_null}": rules.not_null(not_null)}),
                rules.unique_contract(df, f"{table}.unique", natural),
            ]
            if key in ("category_key", "city_key"):  # where the hash may be the only join key it has to be unique
                frames.append(rules.key_collisions(df, f"{table}.{key}", key, natural))
            if source is not None:
                frames.append(rules.not_emptied(df, source, f"{table} is empty"))
            return rules.all_contracts(*frames)

        return check

    (products, product_day), (users, _) = current("products"), current("users")
    numbered = lake.keys == REGISTRY

    def with_key(dim: DataFrame, column: str, name: str, natural: list[str]) -> DataFrame:
        if not numbered:
            return dim
        return registry.rekeyed(dim, column, natural, register_keys(spark, lake, name, dim.select(*natural), day), natural)

    out: dict[str, DataFrame] = {}
    out["dim_category"] = publish(
        "dim_category",
        with_key(gold.dim_category(products, stamp, lake.hashed), "category_key", "category", ["category"]),
        keyed("dim_category", "category_key", ("category",), "category_key"),
    )
    # A registered key is not a function of the row, so it comes from the dimension by a join.
    categories = out["dim_category"] if numbered else None
    out["dim_product"] = publish(
        "dim_product",
        with_key(gold.dim_product(products, categories, stamp, lake.hashed, unique=True), "product_key", "product", ["product_id"]),
        keyed("dim_product", "product_key", ("product_id",), "product_id", products),
    )
    _fact_days(spark, lake, product_day)
    out["fact_product_metrics_daily"] = fact = _score_view(spark, lake)
    until = fact.where(F.col("dt") <= F.lit(day).cast("date"))
    out["product_catalog"] = publish("product_catalog", gold.product_catalog(products, None, until))
    out["dim_city"] = publish(
        "dim_city",
        with_key(gold.dim_city(users, stamp, lake.hashed), "city_key", "city", ["city", "zipcode"]),
        keyed("dim_city", "city_key", ("city", "zipcode"), "city_key"),
    )
    cities = out["dim_city"] if numbered else None
    out["dim_user"] = publish(
        "dim_user",
        with_key(gold.dim_user(users, cities, stamp, lake.hashed, unique=True), "user_key", "user", ["user_id"]),
        keyed("dim_user", "user_key", ("user_id",), "user_id", users),
    )
    out["user_directory"] = publish("user_directory", gold.user_directory(users, None, stamp))
    return out
