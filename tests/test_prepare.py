from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from ratewell.functions import batch_mean_rmse, clip, masked_rmse, metrics_frame, mse, presence, relu, rmse
from ratewell.operators import prepare as prep
from ratewell.operators.numbering import batch_no, dense_index, global_row_number, n_distinct
from ratewell.plans.prepare import normalise, prepare
from ratewell.sources import (
    load_interactions,
    load_split,
    read_ratings_csv,
    read_ratings_dat,
    save_interactions,
    save_split,
    write_metrics,
    write_ratings_csv,
)


def pairs(spark, rows):
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double")


def test_global_row_number_over_skewed_keys(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).alias("a"), F.col("id").alias("b"))
    got = global_row_number(df.repartition(6), ["a", "b"]).orderBy("a", "b").select("rn").collect()
    assert [r[0] for r in got] == list(range(1, 5001))


def test_global_row_number_descending(spark):
    got = global_row_number(spark.range(10), [F.desc("id")]).collect()
    assert {r["id"]: r["rn"] for r in got} == {i: 10 - i for i in range(10)}


def test_dense_index_is_ascending(spark):
    got = dense_index(spark.createDataFrame([(50,), (7,), (50,), (900,)], "k long"), "k", "x")
    assert {(r["k"], r["x"]) for r in got.collect()} == {(7, 0), (50, 1), (900, 2)}
    assert got.count() == 4


def test_batches(spark):
    sizes = batch_no(spark.range(25), 10, ["id"]).groupBy("batch").count().orderBy("batch").collect()
    assert [tuple(r) for r in sizes] == [(0, 10), (1, 10), (2, 5)]


def test_n_distinct(spark):
    assert n_distinct(spark.createDataFrame([(1,), (1,), (2,)], "k long"), "k").first()[0] == 2


def test_top_n_breaks_ties_by_lowest_id(spark):
    counts = spark.createDataFrame([(9, 3), (4, 5), (2, 3), (7, 3)], "user_id long, n_ratings long")
    assert sorted(r[0] for r in prep.top_n(counts, "user_id", 2).select("user_id").collect()) == [2, 4]


def test_a_top_user_can_vanish_with_the_items(spark):
    rows = [(1, i, 3.0) for i in range(50, 55)] + [(u, 1, 3.0) for u in (2, 3, 4)]
    kept = prep.filter_active(pairs(spark, rows), 2, 1)
    # User 1 is the busiest, but none of its items is in the top one.
    assert {(r["user_id"], r["item_id"]) for r in kept.collect()} == {(2, 1)}


def test_latest_rating_wins(spark):
    df = spark.createDataFrame(
        [(1, 1, 2.0, 10), (1, 1, 4.0, 30), (1, 1, 3.0, 20), (1, 2, 1.0, 5)],
        "user_id long, item_id long, rating double, t long",
    )
    got = prep.latest_rating(df, ["t"]).collect()
    assert {(r[0], r[1]): r[2] for r in got} == {(1, 1): 4.0, (1, 2): 1.0}


@pytest.mark.parametrize("share", [0.2, 0.5, 0.01])
def test_exact_split_size(spark, share):
    df = pairs(spark, [(u, i, 3.0) for u in range(31) for i in range(13)])
    got = prep.split_exact(df, share, seed=3)
    assert got.where("split = 'test'").count() == math.ceil(share * 31 * 13)
    assert got.count() == 31 * 13


def test_random_split_covers_everything(spark):
    df = pairs(spark, [(u, 1, 3.0) for u in range(200)])
    train, test = prep.split_random(df)
    assert train.count() + test.count() == 200


def test_center_and_back(spark):
    df = pairs(spark, [(1, 1, 2.0), (1, 2, 5.0)])
    mean = prep.global_mean(df)
    centred = prep.center(df, mean)
    assert sorted(r[0] for r in centred.select("rating").collect()) == [-1.5, 1.5]
    back = prep.uncenter(centred, mean, "rating")
    assert sorted(r[0] for r in back.select("rating").collect()) == [2.0, 5.0]


def test_adjacency_pieces_are_bounded(spark):
    df = pairs(spark, [(u, 1, 3.0) for u in range(100)])
    got = prep.item_users(df, "user_id", "item_id", span=16).collect()
    assert max(len(r["partners"]) for r in got) == 16
    assert sorted(p for r in got for p in r["partners"]) == list(range(100))


def test_extent(spark):
    a = spark.createDataFrame([(3, 1)], "user_idx int, item_idx int")
    b = spark.createDataFrame([(0, 8)], "user_idx int, item_idx int")
    assert tuple(prep.extent(a, b).first()) == (4, 9)


def test_scalar_expressions(spark):
    df = spark.createDataFrame([(-3.0,), (0.0,), (3.0,), (9.0,), (None,)], "x double")
    got = df.select(clip("x"), relu("x"), presence("x")).collect()
    assert [r[0] for r in got] == [0.5, 0.5, 3.0, 5.0, None]
    assert [r[1] for r in got][:4] == [0.0, 0.0, 3.0, 9.0]
    assert [r[2] for r in got] == [1, 0, 1, 1, 0]


def test_metrics(spark):
    df = spark.createDataFrame(
        [(0, 1.0, 2.0), (0, 0.0, 5.0), (1, 3.0, 1.0), (2, None, 1.0)], "batch int, rating double, prediction double"
    )
    assert mse(df.where("rating is not null")).first()[0] == (1 + 25 + 4) / 3
    assert abs(rmse(df).first()[0] - math.sqrt(10 + 1e-8)) < 1e-12
    assert abs(masked_rmse(df, zero_is_missing=True).first()[0] - math.sqrt(2.5 + 1e-8)) < 1e-12
    assert masked_rmse(df.where("batch = 2")).first()[0] is None
    expected = (math.sqrt(13 + 1e-8) + math.sqrt(4 + 1e-8)) / 2
    assert abs(batch_mean_rmse(df).first()[0] - expected) < 1e-12


def test_dat_file_in_latin1(spark, tmp_path):
    path = tmp_path / "r.dat"
    path.write_bytes("1::10::3.5::100\n1::10::4.0::200\n2::11::0.5::50\n".encode("latin-1"))
    raw = read_ratings_dat(spark, str(path))
    assert raw.columns == ["userId", "movieId", "rating", "timestamp"] and raw.count() == 3
    got = {tuple(r) for r in normalise(raw).collect()}
    assert got == {(0, 10, 4.0), (1, 11, 0.5)}


def test_csv_schema_and_inference(spark, tmp_path):
    df = pairs(spark, [(1, 2, 3.5)])
    write_ratings_csv(df, str(tmp_path / "c"))
    assert read_ratings_csv(spark, str(tmp_path / "c")).first()["rating"] == 3.5
    assert read_ratings_csv(spark, str(tmp_path / "c"), df.schema).schema == df.schema


def raw_rows(spark):
    rows = [(u + 1, 100 + i, float(1 + (u * i) % 9) / 2 + 0.5, u + i) for u in range(12) for i in range(8)]
    return spark.createDataFrame(rows, "userId int, movieId int, rating double, timestamp long")


def test_prepare_saves_and_reloads(spark, tmp_path):
    path = str(tmp_path / "split")
    train, test = prepare(spark, raw_rows(spark), path, max_users=10, max_items=5)
    assert train.count() == 40 and test.count() == 10
    assert set(train.columns) == {"user_id", "item_id", "user_idx", "item_idx", "rating"}
    assert {r[0] for r in train.union(test).select("user_idx").distinct().collect()} == set(range(10))
    again, _ = prepare(spark, "/nowhere", path)
    assert again.count() == 40
    fresh, _ = prepare(spark, raw_rows(spark), path, max_users=3, max_items=5, load=False, save=False)
    assert fresh.count() == 12


def test_prepare_needs_both_parts(spark, tmp_path):
    path = str(tmp_path / "half")
    raw_rows(spark).write.parquet(f"{path}/split=train")
    train, test = prepare(spark, raw_rows(spark), path, max_users=10, max_items=5, exact=False)
    assert train.count() + test.count() == 50


def test_split_roundtrip_reads_one_part(spark, tmp_path):
    df = pairs(spark, [(1, 1, 1.0), (2, 2, 2.0)])
    save_split(df.where("user_id = 1"), df.where("user_id = 2"), str(tmp_path / "s"))
    train, test = load_split(spark, str(tmp_path / "s"))
    assert train.first()["user_id"] == 1 and test.first()["user_id"] == 2


def test_interactions_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(u, i, 1.0) for u in range(20) for i in range(5)], "user_idx int, item_idx int, rating double")
    save_interactions(df, str(tmp_path / "x"))
    by_user, by_item = load_interactions(spark, str(tmp_path / "x"))
    assert by_user.exceptAll(by_item).count() == 0 and by_user.count() == 100


def test_metric_history_is_stored(spark, tmp_path):
    df = metrics_frame(spark, [("m", 1, "train", "mse", 0.5)])
    write_metrics(df, str(tmp_path / "m"))
    write_metrics(df, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).count() == 2


def test_bucketed_tables_join_without_an_exchange(spark, sf_dir):
    from ratewell.plans.queries import _stored, bucketed_lookup

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = bucketed_lookup(spark, _stored(spark, sf_dir))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SelectedBucketsCount" in plan and "Join" in plan
        assert found.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_activity_filter_reads_its_input_once(spark, sf_dir):
    from ratewell.operators.prepare import filter_active
    from ratewell.sources import ratings_view

    kept = filter_active(ratings_view(spark, sf_dir), 50, 5)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in plan and plan.count("LogicalRDD") == 3
    assert kept.select("user_id").distinct().count() <= 50 and kept.select("item_id").distinct().count() == 5
