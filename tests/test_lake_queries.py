"""Queries that write, and queries of files, on small tables of their own."""

from layerforge.workload import lake, queries


def tables(spark, folder, customers, parts):
    """`customers` are (key, nation) pairs, `parts` keys; all else is the same for every row."""
    spark.createDataFrame(
        [(k, f"Customer#{k}", n, 9.5, "BUILDING") for k, n in customers],
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    ).write.parquet(f"{folder}/customer.parquet")
    nations = [(k, f"Nation_{k}") for k in range(25)]
    spark.createDataFrame(nations, "n_nationkey int, n_name string").write.parquet(f"{folder}/nation.parquet")
    spark.createDataFrame(
        [(k, f"part {k}", "Brand#1", "ECONOMY", 7, 12.5) for k in parts],
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    ).write.parquet(f"{folder}/part.parquet")
    return str(folder)


def customer(short):
    """A key whose ZIP code has nine digits and begins with this number."""
    return next(k for k in range(short, 10**6, 997) if k % 5 == 0 and all(k % d for d in (7, 19, 47, 103)))


def test_places_that_share_a_narrow_key_stop_neither_the_lake_nor_multiply_users(spark, tmp_path):
    folder = tables(spark, tmp_path / "sf", [(customer(208), 9), (customer(258), 18)], [1, 2, 4])
    cities = queries.dim_city(spark, folder).collect()
    assert len(cities) == 2 and len({r["city_key"] for r in cities}) == 1
    users = {(r["id"], r["city"], r["zipcode"]) for r in queries.user_directory(spark, folder).collect()}
    assert users == {(customer(208), "Port Nation_9", "00208-1234"), (customer(258), "Port Nation_18", "00258-1234")}
    catalog = {r["id"]: (r["first_count"], r["last_count"]) for r in lake.lake_catalog(spark, folder).collect()}
    assert catalog == {1: (4, 8), 2: (4, 8), 4: (4, 8)}


def test_rows_are_counted_by_file_and_files_without_a_name_too(spark, tmp_path):
    folder = tables(spark, tmp_path / "sf", [(1, 2), (3, 4)], [1, 2, 4])
    spark.range(5).write.parquet(f"{folder}/supplier.parquet")
    found = queries.source_lineage(spark, folder)
    assert sorted(map(tuple, found.select("source", "n_rows", "n_unnamed").collect())) == [("customer", 2, 0), ("part", 3, 0), ("supplier", 5, 0)]
    rows = [("file:/x/part.parquet", "part"), ("file:/x/part.parquet/p-0", "part"), ("", "part"), (None, "customer"), ("s3://b/customer.parquet", "customer")]
    found = queries.rows_by_source(spark.createDataFrame([*rows, rows[0]], "file_origin string, read string")).collect()
    assert {(r["source"], r["n_rows"], r["n_unnamed"]) for r in found} == {("part", 4, 1), ("customer", 2, 1)}


def test_all_tasks_land_products(spark, tmp_path, monkeypatch):
    folder = tables(spark, tmp_path / "sf", [], range(1, 61))
    once = spark.read.parquet(f"{folder}/part.parquet").coalesce(1)
    once.write.parquet(f"{tmp_path}/one/part.parquet")
    monkeypatch.setattr(lake, "_folder", lambda _: f"{tmp_path}/landed")
    rows = lake.landed_products(spark, f"{tmp_path}/one").collect()
    assert len(rows) == 120 and all(r["whole"] and r["named"] for r in rows)
    tasks = {f.name.split("-")[1] for f in (tmp_path / "landed").glob("part-*.json.gz")}
    assert len(tasks) == spark.sparkContext.defaultParallelism
