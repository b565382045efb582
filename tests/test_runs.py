"""Runs over several days and batches: nothing is lost, overwritten or half published."""

import datetime

import pytest
from pyspark.sql import functions as F
from test_plans import product, user

from layerforge.operators import chunks, merge, quality, registry
from layerforge.operators.contracts import ContractViolation
from layerforge.operators.dedup import newest_first
from layerforge.plans import gold, runs
from layerforge.sources import scans, sinks
from layerforge.workload import roles


def at(day, hour=6):
    return datetime.datetime(2024, 1, day, hour)


def lake_at(tmp_path, tag, **more):
    return runs.Lake(str(tmp_path / tag), bronze=f"{tag}_b", silver=f"{tag}_s", gold=f"{tag}_g", **more)


def land(spark, lake, entity, batch, records, as_of):
    items = scans.records_frame(spark, entity, records, lake.id_type)
    raw = runs.land(items, lake, entity, as_of.date(), batch)
    runs.to_bronze(spark, lake, entity, raw, batch, as_of)


def table(spark, name, *but):
    df = spark.table(name)
    keep = sorted(c for c in df.columns if c not in ("file_origin", *but))
    return sorted(map(repr, df.select(*keep).collect()))


def test_several_late_and_repeated_batches_equal_a_rebuild(spark, tmp_path):
    # (day of the snapshot, batch, time of the batch, records)
    steps = [
        (1, "a", at(1), [product(1), product(2, price=-1), product(None)]),
        (2, "b", at(2), [product(1, title="newer"), product(3), product(None, price=-2)]),
        (2, "c", at(2, 9), [product(2, title="fixed")]),
        (3, "late", at(1, 12), [product(1, title="late"), product(4), product(3, title="late")]),
        (4, "a", at(1), None),  # an old batch once more
        (4, "d", at(4), [product(5, category="toys")]),
    ]
    found = {}
    for tag in ("step", "full"):
        lake = lake_at(tmp_path, tag)
        for day, batch, time, records in steps:
            if records is not None:
                land(spark, lake, "products", batch, records, time)
            runs.to_silver(spark, lake, "products", at(day), batch if tag == "step" else None)
        found[tag] = [table(spark, f"{lake.silver}.{t}") for t in ("products", "products_quarantine")]
    last = spark.table("step_s.products").where("snapshot = '2024-01-04'")
    assert {(r["id"], r["title"]) for r in last.collect()} == {
        (1, "newer"), (2, "fixed"), (3, "item 3"), (4, "item 4"), (5, "item 5"),
    }
    assert found["step"] == found["full"]


def test_an_older_update_does_not_replace(spark):
    def rows(*data):
        return spark.createDataFrame(data, "id int, price double, ts timestamp, version int")

    target = rows((1, 10.0, at(3), 1), (2, 20.0, at(3), 1), (3, 30.0, None, 1))
    updates = rows((1, 1.0, at(1), 2), (2, 2.0, at(4), 2), (3, 3.0, at(1), 2), (4, 4.0, None, 2), (None, 5.0, at(9), 2))
    out = merge.upsert(target, updates, "id", newest_first("ts"), ("version",))
    assert {(r["id"], r["price"]) for r in out.collect()} == {(1, 10.0), (2, 2.0), (3, 3.0), (4, 4.0)}


def run_gold(spark, lake, day, products, users=None):
    land(spark, lake, "products", f"p{day}", products, at(day))
    runs.to_silver(spark, lake, "products", at(day), f"p{day}")
    if users is not None:
        land(spark, lake, "users", f"u{day}", users, at(day))
        runs.to_silver(spark, lake, "users", at(day), f"u{day}")
    return runs.to_gold(spark, lake, at(day))


def test_gold_uses_the_last_snapshot_and_refuses_to_publish_nothing(spark, tmp_path):
    lake = lake_at(tmp_path, "last")
    land(spark, lake, "products", "p0", [product(1)], at(1))
    runs.to_silver(spark, lake, "products", at(1), "p0")
    with pytest.raises(ValueError, match="users"):
        sinks.create_namespace(spark, lake.silver)
        runs.to_gold(spark, lake, at(1))
    run_gold(spark, lake, 2, [product(2)], [user(1), user(2)])
    run_gold(spark, lake, 4, [product(3)])
    assert spark.table("last_g.dim_user").count() == spark.table("last_g.user_directory").count() == 2
    assert spark.table("last_g.dim_product").count() == 3
    old = runs.to_gold(spark, lake, at(2))
    assert str(old["product_catalog"].agg(F.max("last_dt")).first()[0]) == "2024-01-02"
    assert old["dim_product"].count() == 2
    assert spark.table("bronze_products").count() == 3


def test_day_by_day_fact_equals_the_full_fact(spark, tmp_path):
    lake = lake_at(tmp_path, "fact")
    days = [
        [product(1, rating={"rate": 4.0, "count": 3}), product(2, rating=None)],
        [product(1, rating={"rate": 2.0, "count": 5}), product(3)],
        [product(2, rating={"rate": None, "count": 7})],
        [product(4, rating={"rate": 5.0, "count": 1})],
    ]
    for n, records in enumerate(days, start=1):
        out = run_gold(spark, lake, n, records, [user(1)] if n == 1 else None)
    out = runs.to_gold(spark, lake, at(3))  # an old day again
    full = gold.fact_product_metrics_daily(
        spark.table("fact_s.products"), keep_id=True, day=F.to_date("snapshot"), closed=True
    )
    assert out["fact_product_metrics_daily"].columns == [
        "dt", "product_key", "product_id", "price", "rating_rate", "rating_count_incremental",
        "rating_count_cum", "rating_bayes_score",
    ]

    def rounded(df):
        rows = df.withColumn("rating_bayes_score", F.round("rating_bayes_score", 9))
        return sorted(map(repr, rows.select(sorted(rows.columns)).collect()))

    assert rounded(out["fact_product_metrics_daily"]) == rounded(full)
    assert full.count() == 2 + 3 + 3 + 4


def test_a_failed_write_leaves_what_was_published(spark, tmp_path):
    sinks.create_namespace(spark, "half")
    path = str(tmp_path / "t")
    good = spark.createDataFrame([(1,)], "id int")
    sinks.publish_slice(good, "half.t", path, "day", "d1")
    broken = good.withColumn("id", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        sinks.publish_slice(broken, "half.t", path, "day", "d1")
    assert [tuple(r) for r in spark.table("half.t").collect()] == [(1, "d1")]
    sinks.publish_slice(spark.createDataFrame([(2, "x")], "id int, v string"), "half.t", path, "day", "d1")
    sinks.publish_slice(good, "half.t", path, "day", "d2")
    assert sorted(map(tuple, spark.table("half.t").select("id", "v", "day").collect()), key=repr) == [
        (1, None, "d2"),
        (2, "x", "d1"),
    ]
    root = str(tmp_path / "p")
    sinks.publish(good, "half.p", root)
    with pytest.raises(ContractViolation):
        from layerforge.operators.contracts import not_emptied

        sinks.publish(good.limit(0), "half.p", root, contracts=lambda df: not_emptied(df, good, "empty"))
    assert spark.table("half.p").count() == 1
    sinks.publish(spark.createDataFrame([(5, "y")], "id int, w string"), "half.p", root)
    assert [tuple(r) for r in spark.table("half.p").collect()] == [(5, "y")]


def test_wide_ids_reach_gold(spark, tmp_path):
    lake = lake_at(tmp_path, "wide", id_type="bigint")
    wide = 3_000_000_000
    out = run_gold(spark, lake, 1, [product(wide)], [user(wide)])
    assert out["dim_product"].first()["product_id"] == out["dim_user"].first()["user_id"] == wide
    assert out["product_catalog"].first()["id"] == wide
    assert spark.table("wide_s.products_quarantine").where("id IS NULL").count() == 0


def test_text_ids_are_cast_before_rows_are_told_apart(spark):
    from layerforge.plans import silver

    rows = scans.records_frame(spark, "products", [product("7"), product("07"), product("x")], "string")
    bronze = rows.withColumn("ingestion_ts", F.lit(at(1))).withColumn("batch_id", F.lit("b"))
    latest = silver.products(bronze, at(1), id_type="int", ties=("title",))
    assert [r["id"] for r in latest.collect()] == [7]
    keyless = quality.without_key(silver.with_typed_id(bronze, "int"), "id")
    held = silver.quarantine(latest, silver.products_checked(keyless, at(1)))
    assert [(r["id"], r["title"]) for r in held.collect() if r["id"] is None] == [(None, "item x")]


def test_closing_order_holds_large_numbers_and_negative_prices(spark):
    data = [
        (600_000_000_000, 1.0, None), (599_999_999_999, 2_000_000.0, 5.0), (600_000_000_000, -3.5, 5.0),
        (600_000_000_000, 1.0, 0.5), (9_223_372_036_854_775_807, -9_999_999.99, None), (5, 99_999_999_999.99, 5.0),
    ]
    df = spark.createDataFrame(data, "order_no long, price double, rating_rate double")
    got = [tuple(r)[:3] for r in df.withColumn("at", roles.rating_order()).orderBy("at").collect()]
    assert got == sorted(data, key=lambda r: (r[0], r[1], -1 if r[2] is None else r[2]))


def test_chunks_of_sparse_keys_have_few_offsets_and_claims_are_counted(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("b"), (F.col("id") * 987_654_321).alias("k"))
    out = chunks.chunk_numbers(df, ["b"], "k", 1000)
    assert sorted(r["count"] for r in out.groupBy("seq").count().collect()) == [1000] * 20
    assert out.where("seq <> k div 987654321 div 1000 + 1").isEmpty()
    assert chunks.order_contract(df, ["b"], "k").first()["violations"] == 0
    assert chunks.order_contract(df.union(df.limit(3)), ["b"], "k").first()["violations"] == 3


def test_a_mapping_with_repeated_rows_does_not_multiply(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, raw string")
    mapping = spark.createDataFrame([("a", "y"), ("a", "x"), (None, "z")], "category_raw string, category string")
    got = {(r["id"], r["category"]) for r in quality.with_category_table(rows, "raw", mapping).collect()}
    assert got == {(1, "x"), (2, "unknown"), (3, "unknown")}


def test_runs_check_their_settings(spark, tmp_path):
    with pytest.raises(ValueError, match="format"):
        runs.Lake(str(tmp_path), fmt="delta")
    lake = lake_at(tmp_path, "zone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="UTC"):
            runs.to_gold(spark, lake, at(1))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def stored_and_full(spark, tag):
    """Both forms of the fact, from the stored days and over all snapshots at once."""
    full = gold.fact_product_metrics_daily(
        spark.table(f"{tag}_s.products"), keep_id=True, day=F.to_date("snapshot"), closed=True
    )

    def rounded(df):
        rows = df.withColumn("rating_bayes_score", F.round("rating_bayes_score", 9))
        return sorted(map(repr, rows.select(sorted(c for c in rows.columns if c != "product_key")).collect()))

    return rounded(spark.table(f"{tag}_g.fact_product_metrics_daily")), rounded(full)


def rated(n, count, rate=4.0, **more):
    return product(n, rating={"rate": rate, "count": count}, **more)


def silver_count(spark, tag, day, n):
    rows = spark.table(f"{tag}_s.products").where(f"snapshot = '2024-01-{day:02}' AND id = {n}").collect()
    return [(r["rating_count"], r["batch_id"]) for r in rows]


def test_an_old_day_again_sees_what_it_saw(spark, tmp_path):
    lake = lake_at(tmp_path, "again")
    for day, count in ((1, 3), (2, 3), (3, 50)):
        run_gold(spark, lake, day, [rated(1, count)], [user(1)] if day == 1 else None)
    runs.to_silver(spark, lake, "products", at(2), "p2")
    assert silver_count(spark, "again", 2, 1) == [(3, "p2")]
    runs.to_gold(spark, lake, at(2))
    stored, full = stored_and_full(spark, "again")
    assert stored == full
    cum = spark.table("again_g.fact_product_metrics_daily").orderBy("dt").collect()
    assert [r["rating_count_cum"] for r in cum] == [3, 6, 56]
    # The whole of it once more, without naming a batch.
    runs.to_silver(spark, lake, "products", at(2))
    assert silver_count(spark, "again", 2, 1) == [(3, "p2")]


def test_a_batch_that_landed_later_is_not_in_an_earlier_day(spark, tmp_path):
    lake = lake_at(tmp_path, "later")
    for day in (1, 2, 3):
        land(spark, lake, "products", f"p{day}", [rated(1, day), rated(10 + day, 1)], at(day))
    # All three days are made after everything has landed.
    for day in (1, 2, 3):
        runs.to_silver(spark, lake, "products", at(day), f"p{day}")
        assert silver_count(spark, "later", day, 1) == [(day, f"p{day}")]
    runs.to_silver(spark, lake, "products", at(2))
    assert spark.table("later_s.products").where("snapshot = '2024-01-02'").count() == 3
    # A batch that lands again keeps its first day.
    land(spark, lake, "products", "p1", [rated(1, 1), rated(11, 1)], at(3, 9))
    assert [r["landed_on"] for r in spark.table("later_b.products_landed").where("batch_id = 'p1'").collect()] == ["2024-01-01"]


def test_late_batches_move_forward_through_the_running_counts(spark, tmp_path):
    tag = "late"
    lake = lake_at(tmp_path, tag)
    for day in (1, 2, 3):
        run_gold(spark, lake, day, [rated(1, day), rated(day + 1, 5)], [user(1)] if day == 1 else None)
    for day in (2, 1):
        # A correction, and a product that only this batch has.
        land(spark, lake, "products", f"late{day}", [rated(1, 100 * day), rated(20 + day, 7)], at(day, 9))
        runs.to_silver(spark, lake, "products", at(day), f"late{day}")
        runs.to_gold(spark, lake, at(day))
        stored, full = stored_and_full(spark, tag)
        assert stored == full
    # A silver day that changed without a gold run of its own is caught up by the next one.
    land(spark, lake, "products", "last1", [rated(1, 9), rated(30, 2)], at(1, 10))
    runs.to_silver(spark, lake, "products", at(1), "last1")
    run_gold(spark, lake, 4, [rated(1, 1)])
    stored, full = stored_and_full(spark, tag)
    assert stored == full


def test_a_run_that_broke_off_is_completed(spark, tmp_path, monkeypatch):
    lake = lake_at(tmp_path, "off")
    for day in (1, 2, 3):
        run_gold(spark, lake, day, [rated(1, day)], [user(1)] if day == 1 else None)
    land(spark, lake, "products", "late", [rated(1, 40)], at(1, 9))
    runs.to_silver(spark, lake, "products", at(1), "late")
    whole = runs._write_fact_day

    def broken(spark, lake, day, *rest):
        if day.endswith("-02"):
            raise RuntimeError("lost")
        return whole(spark, lake, day, *rest)

    monkeypatch.setattr(runs, "_write_fact_day", broken)
    with pytest.raises(RuntimeError, match="lost"):
        runs.to_gold(spark, lake, at(1))
    monkeypatch.setattr(runs, "_write_fact_day", whole)
    runs.to_gold(spark, lake, at(1))
    stored, full = stored_and_full(spark, "off")
    assert stored == full


def test_a_day_that_breaks_a_contract_is_never_public(spark, tmp_path):
    lake = lake_at(tmp_path, "bad")
    for day in (1, 2):
        run_gold(spark, lake, day, [rated(1, day)], [user(1)] if day == 1 else None)
    before = table(spark, "bad_g.product_days")
    # Silver never holds such a rate; somebody wrote it.
    wrong = spark.table("bad_s.products").where("snapshot = '2024-01-02'").withColumn("rating_rate", F.lit(9.0))
    sinks.publish_slice(wrong, "bad_s.products", lake.path("silver", "products"), "snapshot", "2024-01-02")
    log = spark.table("bad_s.products_batches").where("snapshot = '2024-01-02'").withColumn("version", F.lit("wrong"))
    sinks.publish_slice(log, "bad_s.products_batches", lake.path("silver", "products_batches"), "snapshot", "2024-01-02")
    with pytest.raises(ContractViolation, match="rating_rate"):
        runs.to_gold(spark, lake, at(2))
    assert table(spark, "bad_g.product_days") == before


def test_broken_lines_reach_the_quarantine_with_their_text(spark, tmp_path):
    lake = lake_at(tmp_path, "text")
    folder = tmp_path / "raw"
    folder.mkdir()
    lines = ['{"id": 1, "title": "good", "price": 2, "category": "electronics"}', '{"id": 2, "title": "cut', '{"id": 3, "title": "t", "price": "dear", "category": "electronics"}', "[]"]
    (folder / "a.json").write_text("\n".join(lines) + "\n")
    for batch, day in (("b1", 1), ("b2", 2)):
        runs.to_bronze(spark, lake, "products", str(folder), batch, at(day))
        runs.to_silver(spark, lake, "products", at(day), batch)
    held = spark.table("text_s.products_quarantine").where("snapshot = '2024-01-02'").collect()
    found = {(r["id"], r["batch_id"], r["broken_line"], "line_not_json" in r["dq_issues"], "field_mistyped" in r["dq_issues"]) for r in held}
    assert {f for f in found if f[2] == lines[1]} == {(None, b, lines[1], True, False) for b in ("b1", "b2")}
    assert {f for f in found if f[2] == lines[2]} == {(3, "b2", lines[2], False, True)}
    assert all(r["file_origin"].endswith("a.json") for r in held)
    assert not any(r["id"] == 1 for r in held)


def test_measures_of_a_run_and_spikes(spark, tmp_path):
    lake = lake_at(tmp_path, "dq")
    for day in range(1, 5):
        land(spark, lake, "products", f"p{day}", [rated(n, day) for n in range(40)], at(day))
        runs.to_silver(spark, lake, "products", at(day), f"p{day}")
    assert runs.dq_spikes(spark, lake, "products", at(4)).isEmpty()
    land(spark, lake, "products", "p5", [rated(n, 1, price=-1 if n % 2 else 3) for n in range(200)], at(5))
    runs.to_silver(spark, lake, "products", at(5), "p5")
    kept = spark.table("dq_s.dq_runs").where("run = 'products.2024-01-05'")
    measured = {r["metric"]: (r["n"], r["share"]) for r in kept.collect()}
    snapshot = spark.table("dq_s.products").where("snapshot = '2024-01-05'")
    assert measured["rows"] == (200, 1.0) and measured["null:price"] == (snapshot.where("price IS NULL").count(), 0.5)
    assert measured["issue:price_invalid"][0] == 100 and measured["issue:line_not_json"] == (0, 0.0)
    spikes = {r["metric"] for r in runs.dq_spikes(spark, lake, "products", at(5)).collect()}
    assert spikes == {"rows", "invalid", "issue:price_invalid", "null:price"}


def test_registered_keys_are_given_once(spark, monkeypatch):
    monkeypatch.setattr(registry, "PER_BUCKET", 10_000)
    known = None
    for run in range(3):
        ids = spark.range(0, 200_000, 3 - run).select(F.concat(F.lit("id"), "id").alias("natural"))
        fresh = registry.new_keys(ids, ["natural"], known)
        before = [] if known is None else sorted(map(tuple, known.collect()))
        known = spark.createDataFrame((fresh if known is None else known.unionByName(fresh)).collect(), "natural string, key bigint")
        assert set(before) <= set(map(tuple, known.collect()))
    row = known.agg(F.count("key"), F.countDistinct("key"), F.countDistinct("natural"), F.min("key"), F.max("key")).first()
    assert tuple(row) == (200_000, 200_000, 200_000, 1, 200_000)
    assert registry.new_keys(known.select("natural"), ["natural"], known).isEmpty()
    pairs = spark.createDataFrame([("a", None), ("a", None), (None, "b"), (None, None)], "x string, y string")
    assert sorted(map(tuple, registry.new_keys(pairs, ["x", "y"]).collect()), key=repr) == [("a", None, 2), (None, "b", 1)]


def test_dimensions_with_registered_keys(spark, tmp_path):
    lake = lake_at(tmp_path, "reg", keys="registry")
    out = run_gold(spark, lake, 1, [product(1), product(2, category="jewelery")], [user(1), user(2)])
    first = {r["product_id"]: r["product_key"] for r in out["dim_product"].collect()}
    out = run_gold(spark, lake, 2, [product(3), product(1)], [user(3)])
    again = runs.to_gold(spark, lake, at(2))
    keys = {r["product_id"]: r["product_key"] for r in again["dim_product"].collect()}
    assert sorted(keys.values()) == [1, 2, 3] and {k: keys[k] for k in first} == first
    categories = {r["category_key"]: r["category"] for r in again["dim_category"].collect()}
    assert sorted(categories) == [1, 2]
    assert {categories[r["category_key"]] for r in again["dim_product"].collect()} == set(categories.values())
    cities = {r["city_key"] for r in again["dim_city"].collect()}
    assert {r["city_key"] for r in again["dim_user"].collect()} <= cities
    fact = again["fact_product_metrics_daily"].collect()
    assert {(r["product_id"], r["product_key"]) for r in fact} == set(keys.items())
    stored, full = stored_and_full(spark, "reg")
    assert stored == full


def test_only_old_folders_that_nothing_points_to_are_removed(spark, tmp_path):
    sinks.create_namespace(spark, "keepers")
    root = str(tmp_path / "lake")
    df = spark.createDataFrame([(1,), (2,)], "id int")
    for _ in range(3):
        sinks.publish_slice(df, "keepers.sliced", f"{root}/sliced", "day", "d1")
        sinks.publish(df, "keepers.whole", f"{root}/whole")
    sinks.publish_slice(df.limit(0), "keepers.sliced", f"{root}/sliced", "day", "empty")
    tables = ["keepers.sliced", "keepers.whole", "keepers.none"]
    none = datetime.timedelta(0)
    assert sinks.unreferenced(spark, tables, root).isEmpty()  # nothing is older than a week
    found = sinks.unreferenced(spark, tables, root, none)
    assert found.count() == 4
    used = {r["location"] for t in tables for r in sinks.published_locations(spark, t).collect()}
    assert len(used) == 3 and not used & {r["location"] for r in found.collect()}
    assert len(sinks.remove_unreferenced(spark, tables, root, none)) == 4
    assert sinks.unreferenced(spark, tables, root, none).isEmpty()
    assert spark.table("keepers.whole").count() == 2 and spark.table("keepers.sliced").count() == 2


def test_rows_without_a_key_are_spread(spark):
    from layerforge.operators.joins import left_join

    left = spark.range(4000).select("id", F.when(F.col("id") % 10 == 0, F.col("id") % 7).alias("k"))
    right = spark.createDataFrame([(k, f"v{k}") for k in range(6)] + [(None, "nobody")], "r long, v string")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = left_join(left, right, [(F.col("k"), F.col("r"))], ("id",))
        got = {(r["id"], r["k"], r["v"]) for r in out.collect()}
        want = {(r["id"], r["k"], r["v"]) for r in left.join(right, F.col("k") == F.col("r"), "left").collect()}
        assert got == want and len(got) == 4000
        held = out.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
        assert len(held) == 16 and max(r["count"] for r in held) < 2 * 3600 / 16
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_a_small_batch_reads_few_row_groups_of_a_clustered_target(spark, tmp_path):
    rows = spark.range(20_000).select(F.col("id"), F.lit(1).alias("v"), F.lit(1).alias("ts"))
    path = str(tmp_path / "clustered")
    merge.by_range(rows.orderBy(F.rand(1)), "id").write.option("parquet.block.size", 8192).option("parquet.page.size", 1024).parquet(path)
    target = spark.read.parquet(path)
    updates = spark.createDataFrame([(700, 2, 2), (705, 2, 0), (None, 2, 2)], "id long, v int, ts int")
    read = {}
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for clustered in (False, True):
            out = merge.upsert(target, updates, "id", newest_first("ts"), (), clustered=clustered)
            changed = {r["id"] for r in out.where("v = 2").collect()}
            assert changed == {700}
            out = merge.upsert(target, updates, "id", newest_first("ts"), (), clustered=clustered)
            assert len(out.collect()) == 20_000
            leaves = out._jdf.queryExecution().executedPlan().collectLeaves()
            scans = [leaves.apply(k) for k in range(leaves.size())]
            read[clustered] = sum(s.metrics().apply("numOutputRows").value() for s in scans if s.nodeName().startswith("Scan parquet"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    # Twice the target, and once with a part of one range.
    assert read[False] == 40_000 and 20_000 < read[True] < 30_000
