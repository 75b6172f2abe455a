from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewell.operators import scoring


@pytest.mark.parametrize("users_per_block,items_per_chunk,at_once", [(2048, 2048, 256), (3, 4, 2), (1, 100, 1)])
def test_autorec_blocks_equal_numpy(spark, monkeypatch, users_per_block, items_per_chunk, at_once):
    monkeypatch.setattr(scoring, "BLOCK_USERS", users_per_block)
    monkeypatch.setattr(scoring, "CHUNK_ITEMS", items_per_chunk)
    monkeypatch.setattr(scoring, "USERS_AT_ONCE", at_once)
    rng = np.random.default_rng(9)
    h, n_items = 40, 11  # two pieces of hidden units
    w_in, w_out, b_out, b_in = rng.normal(size=(n_items, h)), rng.normal(size=(n_items, h)), rng.normal(size=n_items), rng.normal(size=h)
    cells = [(u, i, float(rng.normal())) for u in range(9) for i in range(n_items) if rng.random() < 0.5]
    parts = [(i, p, w_in[i, 32 * p : 32 * p + 32].tolist(), w_out[i, 32 * p : 32 * p + 32].tolist(), float(b_out[i])) for i in range(n_items) for p in (0, 1)]
    items = spark.createDataFrame(parts, "item_idx int, part int, w_in array<double>, w_out array<double>, b_out double").repartition(3)
    # User 50 has no rating, item 99 no weights; a pair may be asked twice, and a map may ride along.
    asked = [(u, i) for u in (*range(9), 50) for i in (0, 3, 7, 99)] + [(1, 3), (1, 3)]
    pairs = spark.createDataFrame([(u, i, {"k": n}) for n, (u, i) in enumerate(asked)], "user_idx long, item_idx int, note map<string,int>")
    ratings = spark.createDataFrame(cells, "user_idx long, item_idx int, rating double").repartition(4)
    got = scoring.score_autorec(pairs, ratings, items, b_in.tolist()).collect()
    assert len(got) == len(asked)
    for row in got:
        x = np.zeros(n_items)
        for u, i, y in cells:
            if u == row["user_idx"]:
                x[i] = y
        code = np.tanh(x @ w_in + b_in)
        expected = code @ w_out[row["item_idx"]] + b_out[row["item_idx"]] if row["item_idx"] < n_items else 0.0
        assert abs(row["prediction"] - expected) < 1e-9 and row["note"]["k"] is not None


def test_autorec_asked_for_nothing(spark):
    items = spark.createDataFrame([(1, 0, [0.5], [2.0], 0.25)], "item_idx int, part int, w_in array<double>, w_out array<double>, b_out double")
    ratings = spark.createDataFrame([(1, 1, 1.0)], "user_idx long, item_idx int, rating double")
    assert scoring.score_autorec(ratings.where(F.lit(False)), ratings, items, [0.1]).count() == 0
    null = spark.createDataFrame([(None, 1), (1, None)], "user_idx long, item_idx int")
    assert [r["prediction"] for r in scoring.score_autorec(null, ratings, items, [0.1]).collect()] == [0.0, 0.0]


def test_weights_and_codes_do_not_move_as_users_times_items():
    """At 900,000 users, 60,000 items and 36 million cells a tenth of what blocks of 2048 whole rows moved."""
    cells, users, items, h = 36_000_000, 900_000, 60_000, 700
    parts, width = scoring.slices_of(cells, users, items, h)
    blocks, chunks = -(-users // (scoring.BLOCK_USERS * parts)), -(-items // (scoring.CHUNK_ITEMS * parts))
    before = 16 * h * (items * -(-users // 2048) + users * -(-items // 2048))
    assert parts * width >= h
    assert 10 * (16 * h * (items * blocks + users * chunks) + cells * parts * scoring.CELL_BYTES) < before
    assert scoring.slices_of(1000, 100, 50, h) == (1, 704)  # little data is not cut


@pytest.mark.parametrize("unit_bytes,values,own", [(0, 1 << 22, 12), (1 << 28, 22, 1), (1 << 28, 200, 2), (1 << 28, 11 * 64, 12)])
def test_autorec_weights_pass_in_slices(spark, monkeypatch, unit_bytes, values, own):
    """Slices of one or more hidden units, and chunks of items, give the same; the weights are not shuffled to the users."""
    monkeypatch.setattr(scoring, "UNIT_BYTES", unit_bytes)
    monkeypatch.setattr(scoring, "SLICE_VALUES", values)
    monkeypatch.setattr(scoring, "OWN_BLOCKS", own)
    monkeypatch.setattr(scoring, "BLOCK_USERS", 2)
    rng = np.random.default_rng(10)
    h, n_items = 40, 11
    w_in, w_out, b_out, b_in = rng.normal(size=(n_items, h)), rng.normal(size=(n_items, h)), rng.normal(size=n_items), rng.normal(size=h)
    cells = [(u, i, float(rng.normal())) for u in range(30) for i in range(n_items) if rng.random() < 0.5]
    parts = [(i, p, w_in[i, 32 * p : 32 * p + 32].tolist(), w_out[i, 32 * p : 32 * p + 32].tolist(), float(b_out[i])) for i in range(n_items) for p in (0, 1)]
    items = spark.createDataFrame(parts, "item_idx int, part int, w_in array<double>, w_out array<double>, b_out double").repartition(3)
    pairs = spark.createDataFrame([(u, i) for u in range(31) for i in (0, 3, 99)] + [(1, 3)], "user_idx long, item_idx int")
    ratings = spark.createDataFrame(cells + [(40, 1, 1.0), (2, None, 1.0)], "user_idx long, item_idx int, rating double")
    scored = scoring.score_autorec(pairs, ratings, items, b_in.tolist())
    if unit_bytes:
        assert "CartesianProduct" in scored._jdf.queryExecution().executedPlan().toString()
        slices, width = scoring.weight_slices(items, "item_idx", h, n_items)
        assert slices.count() == -(-h // width) and (width == 1 or width * n_items * 2 <= values)
    got = scored.collect()
    assert len(got) == 31 * 3 + 1
    for row in got:
        x = np.zeros(n_items)
        for u, i, y in cells:
            if u == row["user_idx"]:
                x[i] = y
        expected = np.tanh(x @ w_in + b_in) @ w_out[row["item_idx"]] + b_out[row["item_idx"]] if row["item_idx"] < n_items else 0.0
        assert abs(row["prediction"] - expected) < 1e-9
