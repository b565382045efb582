"""Duplicates, rules, windows, chunks, merges and contracts against brute force."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from layerforge.operators import chunks, contracts, merge, quality, running
from layerforge.operators.dedup import distinct_values, latest_per_key, newest_first


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot_rows(n=3000, seed=7):
    """A third of the rows share one key, the timestamps tie and are often missing."""
    rng = random.Random(seed)
    return [
        (
            0 if i % 3 == 0 else rng.randrange(1, 200),
            rng.choice([None, *range(20)]),
            f"v{i}",
        )
        for i in range(n)
    ]


def test_latest_matches_brute_force_with_a_hot_key(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "id int, ts int, payload string").repartition(7)
    best = {}
    for r in rows:
        rank = (r[1] is not None, r[1] or 0, r[2])
        if r[0] not in best or rank > best[r[0]][0]:
            best[r[0]] = (rank, r)
    got = {tuple(r) for r in latest_per_key(df, "id", newest_first("ts")).collect()}
    assert got == {b[1] for b in best.values()}


def test_latest_limits_groups_before_the_shuffle(spark):
    df = spark.createDataFrame(hot_rows(60), "id int, ts int, payload string")
    text = plan(latest_per_key(df, "id", newest_first("ts"), ties=("payload",)))
    below = text.split("Exchange hashpartitioning(id")[1]
    assert "WindowGroupLimit" in below
    assert text.count("Exchange hashpartitioning") == 1


def test_named_ties_let_other_columns_be_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(hot_rows(60), "id int, ts int, payload string").withColumn(
        "wide", F.lit("x")
    ).write.parquet(path)
    df = latest_per_key(spark.read.parquet(path), "id", newest_first("ts"), ties=("payload",))
    assert "wide" not in plan(df.select("id")).split("ReadSchema")[1]


def test_null_keys_are_dropped_or_kept_whole(spark):
    df = spark.createDataFrame(
        [(None, 1), (None, 1), (None, 2), (1, 1), (1, 2)], "id int, ts int"
    )
    order = newest_first("ts")
    assert [tuple(r) for r in latest_per_key(df, "id", order).collect()] == [(1, 2)]
    kept = latest_per_key(df, "id", order, null_keys="keep")
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(
        [(None, 1), (None, 1), (None, 2), (1, 2)], key=repr
    )
    assert kept.columns == ["id", "ts"]
    with pytest.raises(ValueError):
        latest_per_key(df, "id", order, null_keys="maybe")


def test_latest_with_composite_key_and_unorderable_column(spark):
    df = spark.createDataFrame(
        [(1, "a", 1, {"x": 1}), (1, "a", 2, {"x": 2}), (1, "b", 1, {"x": 3})],
        "k int, j string, ts int, m map<string,int>",
    )
    got = latest_per_key(df, ["k", "j"], newest_first("ts"))
    assert sorted((r.k, r.j, r.ts) for r in got.collect()) == [(1, "a", 2), (1, "b", 1)]


def test_distinct_values(spark):
    df = spark.createDataFrame([("A",), ("a",), ("b",)], "c string")
    got = distinct_values(df, c=F.lower("c"))
    assert sorted(r["c"] for r in got.collect()) == ["a", "b"]


def test_issue_list_orders_tags_and_ignores_undecided(spark):
    df = spark.createDataFrame([(None, -1), (1, None), (2, 5)], "id int, n int")
    rules = [("id_null", F.col("id").isNull()), ("negative", F.col("n") < 0)]
    got = quality.with_issues(df, rules).collect()
    assert [(r["dq_issues"], r["dq_invalid_flag"]) for r in got] == [
        (["id_null", "negative"], True),
        ([], False),
        ([], False),
    ]


def test_quarantine_split_is_a_partition_of_the_rows(spark):
    df = spark.createDataFrame(
        [(1, True), (2, False), (3, None)], "id int, dq_invalid_flag boolean"
    )
    assert [r["id"] for r in quality.accepted(df).collect()] == [2]
    assert sorted(r["id"] for r in quality.quarantined(df).collect()) == [1, 3]


def test_taxonomy_map_and_table_agree(spark):
    taxonomy = {"jewelery": "jewelry", "electronics": "electronics"}
    df = spark.createDataFrame(
        [(1, "jewelery"), (2, "toys"), (3, None), (4, "electronics")], "id int, raw string"
    )
    mapping = spark.createDataFrame(list(taxonomy.items()), "category_raw string, category string")
    expected = [
        (1, False, "jewelry"), (2, True, "unknown"), (3, True, "unknown"), (4, False, "electronics"),
    ]
    for got in (
        quality.with_category(df, "raw", taxonomy),
        quality.with_category_table(df, "raw", mapping),
    ):
        assert got.columns == ["id", "category_unmapped", "category"]
        assert sorted(map(tuple, got.collect())) == expected
    empty = quality.with_category(df, "raw", {})
    assert {r["category"] for r in empty.collect()} == {"unknown"}


def test_running_windows_share_one_shuffle(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 0), (1, 3, 7), (2, 1, 4)], "k int, d int, n int")
    out = df.withColumn("cum", running.running_sum(F.col("n"), "k", "d")).withColumn(
        "prev", running.previous_value("cum", "k", "d")
    )
    out = out.withColumn("inc", running.increment(F.col("cum"), F.col("prev")))
    assert plan(out).count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, out.collect())) == [
        (1, 1, 5, 5, None, 5), (1, 2, 0, 5, 5, 0), (1, 3, 7, 12, 5, 7), (2, 1, 4, 4, None, 4),
    ]


def test_global_mean_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(None,)], "r double")
    assert running.global_mean(df, "r").first()["m_global"] == 0.0
    assert running.global_mean(df.where("false"), "r").first()["m_global"] == 0.0


def test_daily_grain_sums_and_closes(spark):
    rows = [
        (1, "d1", 1, 10.0, 1.0, 3), (1, "d1", 2, 20.0, None, None), (1, "d2", 1, 5.0, 2.0, 4),
    ]
    df = spark.createDataFrame(rows, "id int, dt string, o int, price double, rate double, n int")
    got = running.daily_grain(
        df, "id", "dt", total="n", closing=("price", "rate"), at=F.col("o")
    )
    assert "SortAggregate" not in plan(got)
    assert sorted(map(tuple, got.collect())) == [(1, "d1", 20.0, None, 3), (1, "d2", 5.0, 2.0, 4)]


def test_latest_day_is_a_hash_aggregation(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01", 1.0), (1, "2024-01-03", None), (2, "2024-01-02", 5.0)],
        "k int, d string, s double",
    ).withColumn("d", F.to_date("d"))
    got = running.latest_day(df, "k", "d", "s")
    assert "SortAggregate" not in plan(got)
    assert sorted((r["k"], r["s"], str(r["d"])) for r in got.collect()) == [
        (1, None, "2024-01-03"),
        (2, 5.0, "2024-01-02"),
    ]


def test_chunks_match_a_plain_numbering_with_a_hot_batch(spark):
    rng = random.Random(3)
    keys = rng.sample(range(100_000), 4000)
    rows = [(None if i % 50 == 0 else ("hot" if i % 3 == 0 else f"b{i % 9}"), k) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "batch string, k int").repartition(5)
    got = chunks.chunk_numbers(df, ["batch"], "k", 30, F.floor(F.col("k") / 1000))
    expected = defaultdict(list)
    for b, k in rows:
        expected[b].append(k)
    wanted = {
        (b, k, i // 30 + 1) for b, ks in expected.items() for i, k in enumerate(sorted(ks))
    }
    assert {tuple(r) for r in got.collect()} == wanted
    per_chunk = got.groupBy("batch", "seq").count().agg(F.max("count")).first()[0]
    assert per_chunk <= 30


def test_chunks_by_text_order_and_several_batch_columns(spark):
    rows = [("a", i % 2, f"{i:04d}") for i in range(200)]
    df = spark.createDataFrame(rows, "x string, y int, k string")
    got = chunks.chunk_numbers(df, ["x", "y"], "k", 7, F.substring("k", 1, 3))
    wanted = {("a", y, f"{k:04d}", n // 7 + 1) for y in (0, 1) for n, k in enumerate(range(y, 200, 2))}
    assert {tuple(r) for r in got.collect()} == wanted
    with pytest.raises(ValueError):
        chunks.chunk_numbers(df, ["x"], "k", 0)


def test_upsert_replaces_keeps_and_adds(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id int, v string, ts int")
    updates = spark.createDataFrame(
        [(2, "c", 2), (2, "d", 3), (3, "e", 2), (None, "x", 9)], "id int, v string, ts int"
    )
    got = merge.upsert(target, updates, "id", newest_first("ts"))
    wanted = [(1, "a", 1), (2, "d", 3), (3, "e", 2)]
    assert sorted(map(tuple, got.collect())) == wanted
    again = merge.upsert(got, updates, "id", newest_first("ts"))
    assert sorted(map(tuple, again.collect())) == wanted


def test_evolved_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, old string")
    b = spark.createDataFrame([(2, 5)], "id int, fresh int")
    got = merge.evolved_union(a, b)
    assert got.columns == ["id", "old", "fresh"]
    assert sorted(map(tuple, got.collect())) == [(1, "x", None), (2, None, 5)]


def test_contracts_count_and_enforce(spark):
    df = spark.createDataFrame(
        [(1, 5.0), (None, 5.1), (2, None), (2, -0.1)], "id int, rating_rate double"
    )
    frame = contracts.all_contracts(
        contracts.row_contracts(
            df, {"id": contracts.not_null("id"), "rate": contracts.rate_in_range()}
        ),
        contracts.unique_contract(df, "grain", ["id"]),
    )
    assert {r["contract"]: r["violations"] for r in frame.collect()} == {
        "id": 1,
        "rate": 2,
        "grain": 1,
    }
    with pytest.raises(contracts.ContractViolation, match="rate: 2"):
        contracts.enforce(frame)
    contracts.enforce(frame.where("violations = 0"))
    empty = contracts.row_contracts(df.where("false"), {"id": contracts.not_null("id")})
    assert empty.first()["violations"] == 0


def test_key_collisions_count_keys_with_several_ids(spark):
    df = spark.createDataFrame([(7, 1), (7, 1), (7, 2), (8, 3)], "k bigint, id int")
    assert contracts.key_collisions(df, "c", "k", ["id"]).first()["violations"] == 1
    pairs = spark.createDataFrame(
        [(1, "a", None), (1, "a", "z"), (2, "b", None), (2, "b", None), (3, "a", "x"), (3, "b", "x")],
        "k bigint, c string, z string",
    )
    assert contracts.key_collisions(pairs, "c", "k", ["c", "z"]).first()["violations"] == 2
