"""Scans, landing, sinks, registration and whole runs on real files."""

import datetime
import glob
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F
from test_plans import product, user

from layerforge.operators.contracts import ContractViolation, not_null, row_contracts
from layerforge.plans import runs
from layerforge.sources import landing, scans, schemas, sinks


def write(path, text, zipped=True):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    opener = gzip.open if zipped else open
    with opener(path, "wt", encoding="utf-8") as f:
        f.write(text)


# ----------------------------------------------------------------------- scans


def test_raw_scan_is_permissive_and_knows_its_files(spark, tmp_path):
    lines = [
        json.dumps(product(1, price=10)),
        "{broken",
        '{"id":"x","title":"a"}',
        '{"id":2.5,"title":"b"}',
        '{"id":3,"rating":"text"}',
    ]
    write(str(tmp_path / "2024-01-01/b1/part-1.jsonl.gz"), "\n".join(lines) + "\n\n")
    write(str(tmp_path / "2024-01-02/b2/part-2.json"), json.dumps(product(4)) + "\n", zipped=False)
    write(str(tmp_path / "2024-01-02/b2/ignored.txt"), "x", zipped=False)
    df = scans.read_raw(spark, str(tmp_path), schemas.PRODUCTS)
    got = {(r["id"], r["title"], r["price"]) for r in df.collect()}
    assert got == {
        (1, " item 1 ", 10.0), (None, None, None), (None, "a", None), (None, "b", None),
        (3, None, None), (4, " item 4 ", 10.126),
    }
    files = {os.path.basename(r["file_origin"]) for r in df.select("file_origin").collect()}
    assert files == {"part-1.jsonl.gz", "part-2.json"}


def test_payload_array_and_object(spark, tmp_path):
    write(str(tmp_path / "a.json"), json.dumps([product(1), product(2)], indent=1), zipped=False)
    write(str(tmp_path / "o.json"), json.dumps(product(3), indent=1), zipped=False)
    got = scans.read_payload(spark, str(tmp_path), schemas.PRODUCTS)
    assert sorted(r["id"] for r in got.collect()) == [1, 2, 3]


def test_text_lines(spark, tmp_path):
    write(str(tmp_path / "a.jsonl.gz"), "1\n2\n")
    assert sorted(r["value"] for r in scans.read_lines(spark, str(tmp_path)).collect()) == ["1", "2"]


def test_records_follow_the_schema(spark):
    df = scans.records_frame(spark, "products", [product(1, price=10), {"id": 2}])
    assert df.schema == schemas.PRODUCTS
    assert [(r["id"], r["price"]) for r in df.orderBy("id").collect()] == [(1, 10.0), (2, None)]
    odd = scans.records_frame(spark, "users", [{"id": 1, "name": "John", "email": "j@e.com"}]).first()
    assert odd["name"] is None and odd["email"] == "j@e.com" and odd["id"] == 1


def test_save_to_parquet(spark, tmp_path):
    path = str(tmp_path / "products.parquet")
    sinks.save_to_parquet("products", [product(1, price=10)], path, spark)
    assert os.path.exists(path)
    assert spark.read.parquet(path).first()["price"] == 10.0
    users = str(tmp_path / "users.parquet")
    sinks.save_to_parquet("users", [{"id": 1, "name": "John"}], users, spark)
    assert os.path.exists(users)


# --------------------------------------------------------------------- landing


def test_landing_chunks_keeps_nulls_and_repeats(spark, tmp_path):
    items = scans.records_frame(
        spark, "products", [product(i, description=None, title="ação") for i in range(25)]
    ).coalesce(1)
    folder = landing.raw_folder(str(tmp_path), "shop", "products", "2024-01-01", "b1")
    assert folder.endswith("shop/products/2024-01-01/b1")
    for _ in range(2):
        assert landing.write_raw(items, folder, max_lines=10)
        files = glob.glob(f"{folder}/*.json.gz")
        counts = []
        for f in files:
            with gzip.open(f, "rt", encoding="utf-8") as lines:
                parsed = [json.loads(x) for x in lines]
            counts.append(len(parsed))
            assert all("description" in p and p["description"] is None for p in parsed)
            assert all(p["title"] == "ação" for p in parsed)
        assert sorted(counts) == [5, 10, 10]


def test_landing_nothing_writes_nothing(spark, tmp_path):
    folder = str(tmp_path / "none")
    assert not landing.write_raw(scans.records_frame(spark, "users", []), folder)
    assert not os.path.exists(folder)


def test_validation_names_empty_and_broken_files(spark, tmp_path):
    good = str(tmp_path / "good.jsonl.gz")
    write(good, '{"a":1}\n3\n')
    landing.validate_landing(spark, str(tmp_path))
    write(str(tmp_path / "late.jsonl.gz"), '{"a":1}\n' * 5 + "{broken\n")
    open(tmp_path / "empty.json", "w").close()
    bad = {
        os.path.basename(r["file_origin"]): r["reason"]
        for r in landing.bad_files(spark, str(tmp_path)).collect()
    }
    assert bad == {"late.jsonl.gz": "invalid JSON", "empty.json": "empty"}
    with pytest.raises(landing.LandingError, match="late.jsonl.gz"):
        landing.validate_landing(spark, str(tmp_path))
    os.makedirs(tmp_path / "hollow")
    with pytest.raises(landing.LandingError, match="no landed file"):
        landing.validate_landing(spark, str(tmp_path / "hollow"))


def test_file_sizes_do_not_read_contents(spark, tmp_path):
    write(str(tmp_path / "a.json"), "12345", zipped=False)
    df = landing.file_sizes(spark, str(tmp_path))
    assert [r["n_bytes"] for r in df.collect()] == [5]
    assert "content" not in df._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


# ----------------------------------------------------------------------- sinks


def test_append_with_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append(spark.createDataFrame([(1, "a")], "id int, x string"), path)
    sinks.append(spark.createDataFrame([(2, "b", 5)], "id int, x string, y int"), path)
    merged = scans.read_table(spark, path, merge_schema=True)
    assert sorted(map(tuple, merged.collect()), key=repr) == [(1, "a", None), (2, "b", 5)]
    stated = scans.read_table(spark, path, schema=merged.schema)
    assert stated.count() == 2


def test_registered_table_evolves_and_refreshes(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.create_namespace(spark, "evo")
    first = spark.createDataFrame([(1, "a")], "id int, x string")
    sinks.append(first, path)
    sinks.register(spark, "evo.t", path, first.schema)
    wider = spark.createDataFrame([(2, "b", 5)], "id int, x string, y int")
    sinks.append(wider, path)
    sinks.register(spark, "evo.t", path, wider.schema)
    assert sorted(map(tuple, scans.read_catalog(spark, "spark_catalog.evo.t").collect())) == [
        (1, "a", None),
        (2, "b", 5),
    ]
    assert sinks.add_columns(spark, "evo.t", wider.schema) == []


def test_slices_replace_only_themselves(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.create_namespace(spark, "parts")
    full = "id int, v string, batch_id string, category string"
    one = spark.createDataFrame([(1, "a", "1", "x y"), (2, "b", "1", None)], full)
    two = spark.createDataFrame([(1, "c", "2", "z'w")], full)
    for df, b in ((one, "1"), (two, "2"), (one, "1"), (one.where("id = 1"), "1")):
        sinks.replace_slice(df, path, "batch_id", b, partition_by=["category"])
        sinks.register(spark, "parts.t", path, df.schema, partition_by=["batch_id", "category"])
    got = spark.table("parts.t")
    assert dict(got.dtypes)["batch_id"] == "string"
    assert sorted(map(tuple, got.select("id", "v", "batch_id", "category").collect())) == [
        (1, "a", "1", "x y"),
        (1, "c", "2", "z'w"),
    ]
    scan = got.where("batch_id = '2'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in scan


def test_publish_may_read_what_it_replaces(spark, tmp_path):
    sinks.create_namespace(spark, "pub")
    root = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, dt string")
    sinks.publish(df, "pub.t", root, partition_by=["dt"])
    again = spark.table("pub.t").withColumn("id", F.col("id") + 10)
    sinks.publish(again, "pub.t", root, partition_by=["dt"])
    assert sorted(r["id"] for r in spark.table("pub.t").collect()) == [11, 12]


def test_broken_contract_leaves_the_published_table(spark, tmp_path):
    sinks.create_namespace(spark, "pub")
    root = str(tmp_path / "t")

    def check(df):
        return row_contracts(df, {"id": not_null("id")})

    sinks.publish(spark.createDataFrame([(1,)], "id int"), "pub.c", root, contracts=check)
    with pytest.raises(ContractViolation):
        sinks.publish(spark.createDataFrame([(None,)], "id int"), "pub.c", root, contracts=check)
    assert [r["id"] for r in spark.table("pub.c").collect()] == [1]


def test_namespace_view_and_overwrite(spark, tmp_path):
    sinks.create_namespace(spark, "ns", use=True)
    assert spark.catalog.currentDatabase() == "ns"
    sinks.create_namespace(spark, "default", use=True)
    path = str(tmp_path / "t")
    for n in (3, 2):
        sinks.overwrite(spark.range(n), path)
    assert scans.read_table(spark, path).count() == 2
    sinks.view(spark.range(4), "four")
    assert spark.sql("SELECT * FROM four").count() == scans.read_catalog(spark, "four").count() == 4


def test_partitioned_write_opens_one_file_per_small_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 2000, 1, 16).withColumn("dt", F.col("id") % 5)
    sinks.overwrite(df, path, partition_by=["dt"])
    assert len(glob.glob(f"{path}/dt=*/*.parquet")) == 5


# ------------------------------------------------------------------ whole runs


def snapshot(spark, lake):
    names = [
        f"{lake.bronze}.products", f"{lake.bronze}.users", f"{lake.silver}.products",
        f"{lake.silver}.users", f"{lake.silver}.products_quarantine",
        f"{lake.silver}.users_quarantine",
        *[f"{lake.gold}.{t}" for t in (
            "dim_category", "dim_product", "fact_product_metrics_daily", "product_catalog",
            "dim_city", "dim_user", "user_directory")],
    ]
    out = {}
    for n in names:
        df = spark.table(n)
        keep = sorted(c for c in df.columns if c != "file_origin")
        out[n] = sorted(map(repr, df.select(*keep).collect()))
    return out


def refine(spark, lake, day, entity, records, incremental=False):
    as_of = datetime.datetime.combine(day, datetime.time(6))
    batch = f"b{day:%d}"
    raw = runs.land(scans.records_frame(spark, entity, records), lake, entity, day, batch)
    runs.to_bronze(spark, lake, entity, raw, batch, as_of)
    runs.to_silver(spark, lake, entity, as_of, batch if incremental else None)
    return as_of


def run_day(spark, lake, day, products, users, incremental=False):
    refine(spark, lake, day, "products", products, incremental)
    return runs.to_gold(spark, lake, refine(spark, lake, day, "users", users, incremental))


def test_raw_to_gold_twice_and_the_next_day(spark, tmp_path):
    lake = runs.Lake(str(tmp_path), bronze="lb", silver="ls", gold="lg", max_lines=2)
    first, second = datetime.date(2024, 1, 1), datetime.date(2024, 1, 2)
    products = [product(1), product(2, price=-1), product(3, category="toys"), product(None)]
    users = [user(1), user(2, email="bad"), user(None)]
    out = run_day(spark, lake, first, products, users)
    before = snapshot(spark, lake)
    run_day(spark, lake, first, products, users)
    assert snapshot(spark, lake) == before

    catalog = {r["id"]: r for r in out["product_catalog"].collect()}
    assert set(catalog) == {1, 2, 3}
    assert catalog[3]["category"] == "unknown"
    assert {r["id"] for r in spark.table("ls.products_quarantine").collect()} == {2, 3, None}
    assert {r["id"] for r in spark.table("ls.users_quarantine").collect()} == {2, None}
    assert spark.table("silver_users").columns == spark.table("ls.users").columns

    newer = [product(1, title="renamed", rating={"rate": 2.0, "count": 9}), product(4)]
    run_day(spark, lake, second, newer, [user(1, username="other")], incremental=True)
    dims = {r["product_id"]: r["title"] for r in spark.table("lg.dim_product").collect()}
    assert dims == {1: "renamed", 2: "item 2", 3: "item 3", 4: "item 4"}
    fact = {
        (r["product_id"], str(r["dt"])): (r["rating_count_incremental"], r["rating_count_cum"])
        for r in spark.table("lg.fact_product_metrics_daily").collect()
    }
    assert fact[(1, "2024-01-01")] == (3, 3)
    assert fact[(1, "2024-01-02")] == (9, 12)
    assert fact[(2, "2024-01-02")] == (3, 6)
    assert len(fact) == 7
    directory = spark.table("lg.user_directory").collect()
    assert {(r["id"], r["username"]) for r in directory} == {(1, "other"), (2, "ann")}
    assert runs.land(scans.records_frame(spark, "users", []), lake, "users", second, "x") is None


def test_incremental_silver_equals_the_full_one(spark, tmp_path):
    days = [
        [product(1), product(2, price=-1), product(None)],
        [product(1, title="new"), product(3), product(None, price=-2)],
        [product(2), product(4, category="toys")],
        # A day that runs again must not build on itself.
        [product(2), product(4, category="toys")],
    ]
    seen = []
    for incremental in (False, True):
        tag = "inc" if incremental else "all"
        lake = runs.Lake(str(tmp_path / tag), bronze=f"{tag}_b", silver=f"{tag}_s")
        for n, products in enumerate(days, start=1):
            refine(spark, lake, datetime.date(2024, 1, min(n, 3)), "products", products, incremental)
        # The two lakes have different folders, and the rows name their files.
        seen.append(
            [
                sorted(map(repr, spark.table(f"{lake.silver}.{t}").drop("file_origin").collect()))
                for t in ("products", "products_quarantine")
            ]
        )
    assert seen[0] == seen[1]
    assert len(seen[0][0]) == 2 + 3 + 4


def test_slice_values_must_be_plain(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.replace_slice(spark.range(1), str(tmp_path), "b", "../x")
