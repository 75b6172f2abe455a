"""What the registered queries compute once."""

from __future__ import annotations

import datetime as dt

import pytest

from ratewell.plans import queries


def test_masked_errors_read_the_ratings_once(spark, sf_dir, monkeypatch):
    view, calls = queries.ratings_view, []
    monkeypatch.setattr(queries, "ratings_view", lambda *a: calls.append(a) or view(*a))
    queries.q_masked_rmse_zero(spark, sf_dir)
    assert len(calls) == 1


def test_errors_written_twice_are_computed_once(spark, sf_dir, monkeypatch):
    write, scans = queries.io.write_metrics, []

    def watched(metrics, path):
        scans.append(len(metrics.inputFiles()))
        write(metrics, path)

    monkeypatch.setattr(queries.io, "write_metrics", watched)
    assert queries.q_metrics_roundtrip(spark, sf_dir).count() == 4
    assert scans == [0, 0]  # stored rows, no file of the tables is read again


@pytest.mark.parametrize("name", ["mf_forward", "deep_forward", "residual_forward", "mf_rmse"])
def test_pairs_and_ids_share_one_join(spark, tmp_path, name):
    """Ids come from the rows that get scored: the pairs and both id lists read the tables once (the mean of mf_rmse once more at most)."""
    lines = [(o, s, 1, 20.0, 10.0) for o in (1, 2, 3) for s in (1, 2, None)] + [(1, 1, 2, 30.0, 10.0)]
    orders = [(1, 7, dt.date(2020, 1, 1)), (2, None, dt.date(2020, 1, 2)), (3, 7, dt.date(2020, 1, 3))]
    shape = "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double"
    spark.createDataFrame(lines, shape).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate date").write.parquet(f"{tmp_path}/orders.parquet")
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        scored = queries.QUERIES[name](spark, str(tmp_path))
        plan = scored._jdf.queryExecution().executedPlan().toString()
        rows = scored.collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert plan.count("FileScan") <= (4 if name == "mf_rmse" else 2)
    if name != "mf_rmse":
        assert {(r.user_id, r.item_id) for r in rows} == {(u, i) for u in (7, None) for i in (1, 2, None)}
        assert len(rows) == 6 and all(r.prediction is not None for r in rows)
