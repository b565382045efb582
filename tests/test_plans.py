"""Layer plans on literal rows."""

import datetime
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from layerforge.plans import bronze, gold, silver
from layerforge.sources import schemas
from layerforge.sources.scans import records_frame

AT = datetime.datetime(2024, 3, 1, 8, 0)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def product(i, **fields):
    base = {
        "id": i, "title": f" item {i} ", "price": 10.126, "description": " d ",
        "category": " Electronics ", "image": "https://x/1.png", "rating": {"rate": 4.0, "count": 3},
    }
    return {**base, **fields}


def user(i, **fields):
    base = {
        "id": i, "email": " Ann@Example.com ", "username": " ANN ", "password": "secret",
        "phone": " 1-570.236 ", "__v": 0,
        "name": {"firstname": " ann ", "lastname": "o'hara smith"},
        "address": {"city": " port  ", "street": " new   road", "number": 7, "zipcode": "12926-3874",
                    "geolocation": {"lat": " -37.31 ", "long": "81.1"}},
    }
    return {**base, **fields}


def frame(spark, entity, *records, ts=AT):
    return bronze.stamped(records_frame(spark, entity, records), ts).withColumn(
        "file_origin", F.lit("f")
    )


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).orderBy("id").collect()]


def test_products_are_normalised_and_nullified(spark):
    b = frame(
        spark,
        "products",
        product(1),
        product(2, price=-1, rating={"rate": 5.1, "count": -1}, image="ftp://x"),
        product(3, price=0, rating={"rate": 0, "count": 0}, image=None, category="toys"),
        product(4, title="  ", category=None),
    )
    s = silver.products(b, AT)
    assert s.columns == [
        "id", "title", "price", "description", "image", "rating_rate", "rating_count",
        "ingestion_ts", "processed_at", "category_unmapped", "category", "dq_issues",
        "dq_invalid_flag",
    ]
    got = rows(
        s, "id", "title", "price", "rating_rate", "rating_count", "image", "category",
        "category_unmapped", "dq_issues", "dq_invalid_flag",
    )
    web = "https://x/1.png"
    assert got == [
        (1, "item 1", 10.13, 4.0, 3, web, "electronics", False, [], False),
        (2, "item 2", None, None, None, None, "electronics", False, ["price_invalid"], True),
        (3, "item 3", 0.0, 0.0, 0, None, "unknown", True, ["category_unmapped"], True),
        (4, "", 10.13, 4.0, 3, web, "unknown", True, ["title_empty", "category_unmapped"], True),
    ]


def test_the_four_known_categories(spark):
    raw = ["Men's Clothing", " women's clothing", "JEWELERY ", "electronics"]
    b = frame(spark, "products", *[product(i, category=c) for i, c in enumerate(raw)])
    assert [c for _, c in rows(silver.products(b, AT), "id", "category")] == [
        "mens_clothing", "womens_clothing", "jewelry", "electronics",
    ]


def test_users_are_flattened_and_flagged(spark):
    geo = {"city": None, "street": None, "number": None, "zipcode": None,
           "geolocation": {"lat": "90.1", "long": "n/a"}}
    b = frame(
        spark,
        "users",
        user(1),
        user(2, email=None, username="", address=geo),
        user(3, email="a@b", address={**geo, "zipcode": "1234", "geolocation": None}),
    )
    s = silver.users(b, AT)
    assert "password" not in s.columns
    got = rows(
        s, "id", "email", "username", "phone", "full_name", "city", "address_line", "zipcode",
        "lat", "long", "_v", "dq_issues",
    )
    name = "Ann O'hara Smith"
    assert got == [
        (1, "ann@example.com", "ann", "1-570236", name, "Port", "New Road, 7", "12926-3874",
         -37.31, 81.1, 0, []),
        (2, None, "", "1-570236", name, None, "", None, 90.1, None, 0,
         ["email_invalid", "username_empty", "geolocation_invalid"]),
        (3, "a@b", "ann", "1-570236", name, None, "", "1234", None, None, 0,
         ["email_invalid", "zipcode_invalid"]),
    ]
    flags = rows(s, "id", "dq_email_invalid", "dq_zip_invalid", "dq_geo_invalid")
    assert flags == [(1, False, False, False), (2, None, None, True), (3, True, True, False)]


def test_latest_version_wins_and_rows_without_id_go_to_quarantine(spark):
    later = AT + datetime.timedelta(days=1)
    b = frame(spark, "products", product(1, title="old"), product(None)).unionByName(
        frame(spark, "products", product(1, title="new"), product(None, price=-5), ts=later)
    )
    b = b.unionByName(frame(spark, "products", product(1, title="no time"), ts=None).withColumn(
        "ingestion_ts", F.lit(None).cast("timestamp")))
    latest = silver.products(b, AT)
    assert rows(latest, "id", "title") == [(1, "new")]
    held = silver.quarantine(latest, silver.products_checked(b, AT))
    assert sorted(tuple(r["dq_issues"]) for r in held.collect()) == [
        ("id_null",),
        ("id_null", "price_invalid"),
    ]


def test_cleaning_before_or_after_taking_the_latest_is_the_same(spark):
    b = frame(
        spark, "products", *[product(i % 5, title=f"t{i}", price=i - 10) for i in range(40)]
    )
    first = silver.products(b, AT)
    from layerforge.operators.dedup import latest_per_key, newest_first

    checked = silver.products_checked(b.withColumn("ingestion_ts", F.col("ingestion_ts")), AT)
    after = latest_per_key(checked, "id", newest_first("ingestion_ts", "processed_at"))
    assert rows(first, "id", "title") == rows(after, "id", "title")


def test_external_mapping_table(spark):
    b = frame(spark, "products", product(1, category="Toys "), product(2))
    mapping = spark.createDataFrame([("toys", "toys_and_games")], "category_raw string, category string")
    got = silver.products(b, AT, mapping)
    assert rows(got, "id", "category", "category_unmapped") == [
        (1, "toys_and_games", False),
        (2, "unknown", True),
    ]


def test_bronze_keeps_one_row_per_id_and_all_rows_without(spark):
    df = frame(spark, "products", product(1), product(1, title="z"), product(None), product(None))
    got = bronze.one_per_id(df)
    assert rows(got, "id", "title")[-1] == (1, "z")
    assert got.count() == 3


def test_relational_projection_fills_its_timestamp(spark):
    df = bronze.relational_products(records_frame(spark, "products", [product(1)]), AT)
    assert df.columns == [
        "id", "title", "price", "description", "category", "image", "rating_rate",
        "rating_count", "date_ingest",
    ]
    assert df.first()["date_ingest"] == AT
    stamped = frame(spark, "products", product(1), ts=AT)
    other = bronze.relational_products(stamped, datetime.datetime(2030, 1, 1))
    assert other.first()["date_ingest"] == AT


# ------------------------------------------------------------------------ gold


def silver_rows(spark, data):
    return spark.createDataFrame(
        data,
        "id int, title string, description string, image string, category string, price double, "
        "rating_rate double, rating_count int, ingestion_ts timestamp, processed_at timestamp",
    )


def day(n, hour=0):
    return datetime.datetime(2024, 1, n, hour)


def history(seed=5, days=6, products=8):
    """Product 0 is hot: 40 rows on every day. Times of one product never repeat."""
    import random

    rng = random.Random(seed)
    out = []
    for i in range(products):
        for d in range(1, days + 1):
            for n in range(40 if i == 0 else rng.choice([0, 1, 1, 2])):
                at = day(d) + datetime.timedelta(minutes=n)
                out.append(
                    (
                        i, f"t{i}", None, None, rng.choice(["A", "b", None]), float(rng.randrange(9)),
                        rng.choice([None, 1.0, 2.5, 5.0]), rng.choice([None, 0, 3, 8]),
                        at, at if rng.random() < 0.8 else None,
                    )
                )
    return out


def test_fact_matches_brute_force(spark):
    data = history()
    fact = gold.fact_product_metrics_daily(silver_rows(spark, data), keep_id=True)
    rates = [r[6] for r in data if r[6] is not None]
    mean = sum(rates) / len(rates)
    groups = defaultdict(list)
    for r in data:
        groups[(r[0], (r[9] or r[8]).date())].append(r)

    expected, cum = {}, defaultdict(int)
    for (i, d), rs in sorted(groups.items()):
        last = max(rs, key=lambda r: r[9] or r[8])
        add = sum(r[7] or 0 for r in rs)
        cum[i] += add
        score = None if last[6] is None else (20 * mean + last[6] * cum[i]) / (20 + cum[i])
        expected[(i, d)] = (last[5], last[6], add, cum[i], score)
    got = {
        (r["product_id"], r["dt"]): (
            r["price"], r["rating_rate"], r["rating_count_incremental"], r["rating_count_cum"],
            r["rating_bayes_score"],
        )
        for r in fact.collect()
    }
    assert got.keys() == expected.keys()
    for k, v in expected.items():
        assert got[k][:4] == v[:4]
        assert got[k][4] == (None if v[4] is None else pytest.approx(v[4]))
    assert fact.drop("product_id").columns == [
        "dt", "product_key", "price", "rating_rate", "rating_count_incremental",
        "rating_count_cum", "rating_bayes_score",
    ]


def test_fact_without_rows_and_without_rates(spark):
    assert gold.fact_product_metrics_daily(silver_rows(spark, [])).count() == 0
    one = silver_rows(spark, [(1, "t", None, None, "a", 1.0, None, None, day(1), None)])
    row = gold.fact_product_metrics_daily(one).first()
    assert row["rating_count_cum"] == 0 and row["rating_bayes_score"] is None


def test_fact_shuffles_twice_and_never_crosses(spark):
    text = plan(gold.fact_product_metrics_daily(silver_rows(spark, history())))
    main = text.split("Subquery")[0] + text.split("Subquery")[-1]
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert main.count("Exchange hashpartitioning") == 2


def test_product_star_and_catalog(spark):
    data = history()
    products = silver_rows(spark, data)
    categories = gold.dim_category(products, AT)
    assert {r["category"] for r in categories.collect()} <= {"a", "b"}
    dim = gold.dim_product(products, categories, AT)
    assert dim.columns == [
        "product_key", "product_id", "title", "description", "image", "category_key",
        "current_price", "current_rating_rate", "current_rating_count", "is_active",
        "created_at", "updated_at",
    ]
    assert dim.count() == dim.select("product_id").distinct().count() == len({r[0] for r in data})
    fact = gold.fact_product_metrics_daily(products, keep_id=True)
    by_id = gold.product_catalog(dim, categories, fact)
    by_key = gold.product_catalog(dim, categories, fact.drop("product_id"))
    assert by_id.columns == [
        "id", "title", "category", "current_price", "current_rating_rate",
        "current_rating_count", "rating_bayes_score", "image", "last_dt",
    ]
    assert rows(by_id, "id", "last_dt") == rows(by_key, "id", "last_dt")
    last = {}
    for r in data:
        d = (r[9] or r[8]).date()
        last[r[0]] = max(last.get(r[0], d), d)
    with_category = {
        r["product_id"] for r in dim.where(F.col("category_key").isNotNull()).collect()
    }
    assert {tuple(r) for r in rows(by_id, "id", "last_dt")} == {
        (i, d) for i, d in last.items() if i in with_category
    }
    top = gold.newest_in_catalog(by_id, 2)
    assert "TakeOrderedAndProject" in plan(top)
    days = gold.latest_dt_per_product(fact)
    assert days.count() == len(last)


def test_colliding_keys_do_not_mix_products(spark):
    """Two ids with the same 31-bit key stay two products in the fact and the catalog."""
    ids = spark.range(400_000).select(F.col("id").cast("int").alias("id"))
    from layerforge.functions.keys import surrogate_key

    pair = (
        ids.groupBy(surrogate_key(F.col("id")).alias("k"))
        .agg(F.collect_list("id").alias("ids"))
        .where(F.size("ids") > 1)
        .first()["ids"][:2]
    )
    data = [
        (i, f"t{i}", None, None, "a", 1.0, 4.0, n, day(1), day(1)) for i, n in zip(pair, (5, 70))
    ]
    products = silver_rows(spark, data)
    fact = gold.fact_product_metrics_daily(products, keep_id=True)
    assert sorted(r["rating_count_cum"] for r in fact.collect()) == [5, 70]
    categories = gold.dim_category(products, AT)
    catalog = gold.product_catalog(
        gold.dim_product(products, categories, AT), categories, fact
    )
    assert sorted(r["id"] for r in catalog.collect()) == sorted(pair)


def city_users(spark):
    return spark.createDataFrame(
        [
            (1, "A B", "A", "B", "a@b.co", "ab", "1", "Port", "123", 1.0, 2.0),
            (2, "C", "C", None, None, None, None, " port ", "123", None, None),
            (3, "D", "D", None, None, None, None, "Port", None, None, None),
            (4, "E", "E", None, None, None, None, None, None, None, None),
        ],
        "id int, full_name string, firstname string, lastname string, email string, "
        "username string, phone string, city string, zipcode string, lat double, long double",
    )


def test_city_dimension_and_user_directory(spark):
    users = city_users(spark).withColumns(
        {"ingestion_ts": F.lit(AT), "processed_at": F.lit(AT)}
    )
    cities = gold.dim_city(users, AT)
    assert sorted((r["city"], r["zipcode"] or "") for r in cities.collect()) == [
        ("Port", ""),
        ("Port", "123"),
    ]
    dim = gold.dim_user(users, cities, AT)
    found = {r["user_id"]: r["city_key"] is not None for r in dim.collect()}
    assert found == {1: True, 2: True, 3: False, 4: False}
    safe = gold.dim_user(users, cities, AT, null_safe=True)
    assert {r["user_id"]: r["city_key"] is not None for r in safe.collect()} == {
        1: True, 2: True, 3: True, 4: False,
    }
    directory = gold.user_directory(dim, cities)
    assert directory.columns == [
        "id", "full_name", "first_name", "last_name", "email", "username", "phone", "city",
        "zipcode", "latitude", "longitude", "is_active", "updated_at",
    ]
    assert rows(directory, "id", "city", "zipcode") == [
        (1, "Port", "123"), (2, "Port", "123"), (3, None, None), (4, None, None),
    ]


def test_schemas_are_nullable_and_unknown_entities_are_refused():
    for s in (schemas.PRODUCTS, schemas.USERS):
        assert all(f.nullable for f in s.fields)
    with pytest.raises(ValueError):
        schemas.entity_schema("carts")
