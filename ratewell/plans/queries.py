"""Registered queries: one per operator, each over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewell.functions import batch_mean_rmse, masked_rmse, rmse
from ratewell.operators import full_batch, scoring, strata, synchronous
from ratewell.operators import prepare as prep
from ratewell.operators.als import attach_predictions, fit_als, predict_als
from ratewell.operators.gradients import PairNet, RowCoder
from ratewell.operators.neighbors import KnnModel, entity_stats
from ratewell.operators.numbering import batch_no, dense_index, n_distinct
from ratewell.operators.training import AutoRec, DeepMF, Descent, MatrixFactorization, ResidualMF, row_values
from ratewell.plans.evaluate import evaluate
from ratewell.plans.prepare import normalise, prepare
from ratewell.session import cut_lineage, shared_dir
from ratewell.sources import ratings as io
from ratewell.sources.fixtures import ratings_planted, ratings_view

TOP_USERS, TOP_ITEMS = 1000, 80
K, H, CODER_H = 10, 10, 700

USER, ITEM = "user_id", "item_id"


def _r6(column: str) -> Column:
    return (F.round(column, 6) + F.lit(0.0)).alias(column)


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.split_bernoulli(ratings_view(spark, sf_dir))


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled ratings, materialised once because a model reads them several times."""
    return cut_lineage(_labelled(spark, sf_dir))


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# -- preparation --------------------------------------------------------------------------


def q_activity_users(spark, sf_dir):
    return prep.activity(ratings_view(spark, sf_dir), USER)


def q_activity_items(spark, sf_dir):
    return prep.activity(ratings_view(spark, sf_dir), ITEM)


def q_distinct_ids(spark, sf_dir):
    ratings = ratings_view(spark, sf_dir)
    users = n_distinct(ratings, USER).select(F.lit("user").alias("side"), "n_distinct")
    return users.unionByName(n_distinct(ratings, ITEM).select(F.lit("item").alias("side"), "n_distinct"))


def q_top_filter(spark, sf_dir):
    return prep.filter_active(ratings_view(spark, sf_dir), TOP_USERS, TOP_ITEMS).select(USER, ITEM, "rating")


def q_dense_ids(spark, sf_dir):
    kept = cut_lineage(q_top_filter(spark, sf_dir))
    indexed = dense_index(dense_index(kept, USER, "user_idx"), ITEM, "item_idx")
    return indexed.select(USER, ITEM, "user_idx", "item_idx", "rating")


def q_split_hash(spark, sf_dir):
    return _labelled(spark, sf_dir).select(USER, ITEM, "split")


def q_split_exact(spark, sf_dir):
    ratings = cut_lineage(ratings_view(spark, sf_dir))
    return prep.split_exact(ratings).select(USER, ITEM, "split")


def q_centered(spark, sf_dir):
    labelled = _labelled(spark, sf_dir)
    centred = prep.center(labelled, prep.global_mean(prep.part_of(labelled, "train")))
    return centred.select(USER, ITEM, "split", _r6("rating"))


def q_user_items(spark, sf_dir):
    train = prep.part_of(_labelled(spark, sf_dir), "train")
    return prep.user_items(train, USER, ITEM).select(USER, "chunk", F.concat_ws(",", "partners").alias("partners"))


def q_item_users(spark, sf_dir):
    train = prep.part_of(_labelled(spark, sf_dir), "train")
    return prep.item_users(train, USER, ITEM).select(ITEM, "chunk", F.concat_ws(",", "partners").alias("partners"))


def q_user_vectors(spark, sf_dir):
    train = prep.part_of(_labelled(spark, sf_dir), "train")
    text = F.transform("cells", lambda c: F.format_string("%d=%.1f", c["item"], c["rating"]))
    return prep.user_vectors(train, USER, ITEM).select(USER, "chunk", F.concat_ws(",", text).alias("cells"))


def q_extent(spark, sf_dir):
    labelled = _labelled(spark, sf_dir)
    return prep.extent(prep.part_of(labelled, "train"), prep.part_of(labelled, "test"), user=USER, item=ITEM)


# -- neighbourhoods -----------------------------------------------------------------------


def _stats(entity):
    def run(spark, sf_dir):
        train = prep.part_of(_labelled(spark, sf_dir), "train")
        return entity_stats(train, entity).select(entity, "n", _r6("avg"), _r6("sigma"))

    return run


def _sides(entity):
    return (USER, ITEM) if entity == USER else (ITEM, USER)


def _neighbors(entity):
    def run(spark, sf_dir):
        train = prep.part_of(_stored(spark, sf_dir), "train")
        near = KnnModel.fit(train, *_sides(entity)).neighbors
        return near.select("entity", "neighbor", _r6("weight"), "rank")

    return run


def _knn_predict(entity, fallback):
    def run(spark, sf_dir):
        labelled = _stored(spark, sf_dir)
        model = KnnModel.fit(prep.part_of(labelled, "train"), *_sides(entity))
        pairs = prep.part_of(labelled, "test").select(USER, ITEM)
        return model.predict(pairs, fallback).select(USER, ITEM, _r6("prediction"))

    return run


def _knn_mse(entity):
    def run(spark, sf_dir):
        labelled = _stored(spark, sf_dir)
        train, test = prep.part_of(labelled, "train"), prep.part_of(labelled, "test")
        model = KnnModel.fit(train, *_sides(entity))
        return evaluate(model.predict, train, test).select("split", "n", _r6("mse"))

    return run


# -- alternating least squares ------------------------------------------------------------


def _planted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    labelled = cut_lineage(prep.split_bernoulli(ratings_planted(ratings_view(spark, sf_dir))))
    return prep.part_of(labelled, "train"), prep.part_of(labelled, "test")


def q_als_predict(spark, sf_dir):
    train, test = _planted(spark, sf_dir)
    return predict_als(fit_als(train, user=USER, item=ITEM), test)


def q_als_mse(spark, sf_dir):
    train, test = _planted(spark, sf_dir)
    model = fit_als(train, user=USER, item=ITEM)
    return evaluate(lambda df: attach_predictions(df, predict_als(model, df), USER, ITEM), train, test, "als")


def q_als_optimality(spark, sf_dir):
    """Gradient of the regularised squared error at each user's factors, against its right side."""
    train, _ = _planted(spark, sf_dir)
    reg = 0.01
    model = fit_als(train, reg=reg, user=USER, item=ITEM)
    users = model.userFactors.select(F.col("id").alias(USER), F.col("features").alias("x"))
    items = model.itemFactors.select(F.col("id").alias(ITEM), F.col("features").alias("y"))
    x, y = ([F.col(c)[f].cast("double") for f in range(K)] for c in "xy")
    gap = sum((a * b for a, b in zip(x, y)), F.lit(0.0)) - F.col("rating")
    sums = (
        train.join(users, USER)
        .join(items, ITEM)
        .groupBy(USER)
        .agg(
            F.array(*[F.sum(gap * y[f] + reg * x[f]) for f in range(K)]).alias("slope"),
            F.array(*[F.sum(F.col("rating") * y[f]) for f in range(K)]).alias("right"),
        )
    )
    norm = {c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, v: s + v * v)) for c in ("slope", "right")}
    return sums.select(USER, (F.round(norm["slope"] / norm["right"], 3) + F.lit(0.0)).alias("residual"))


def q_als_products(spark, sf_dir):
    """Predictions of held-out pairs less the product of the two factor rows the model returned."""
    train, test = _planted(spark, sf_dir)
    model = fit_als(train, user=USER, item=ITEM)
    scored = cut_lineage(predict_als(model, test))
    users = model.userFactors.select(F.col("id").alias(USER), F.col("features").alias("x"))
    items = model.itemFactors.select(F.col("id").alias(ITEM), F.col("features").alias("y"))
    product = sum((F.col("x")[f].cast("double") * F.col("y")[f] for f in range(K)), F.lit(0.0))
    gap = F.round(F.col("prediction") - product, 4) + F.lit(0.0)
    met = scored.join(users, USER).join(items, ITEM)
    return met.select(F.col(USER).cast("long").alias(USER), F.col(ITEM).cast("long").alias(ITEM), gap.alias("gap"))


def q_attached(spark, sf_dir):
    """Ratings with a formula prediction; every seventh pair has none and is left out."""
    labelled = _labelled(spark, sf_dir)
    known = labelled.where((F.col(USER) + F.col(ITEM)) % 7 != 0)
    predictions = known.select(USER, ITEM, ((F.col(USER) * 31 + F.col(ITEM) * 17) % 101 / 20).alias("prediction"))
    return attach_predictions(labelled, predictions, USER, ITEM).select(USER, ITEM, "rating", _r6("prediction"))


# -- forward passes with formula parameters -----------------------------------------------


def _ids(ratings: DataFrame, key: str, also: str | None) -> DataFrame:
    """Distinct ids, taken from the very rows that get scored.

    A plain ``distinct`` is planned past the ratings' own grouping, and the join's test for null ids below it:
    joins and shuffles of its own. Counts of rows (and of a hash of ``also``, if the scored rows carry that column) and
    an id that is aggregated keep the plan of the ratings as it is, so that Spark reuses its shuffle.
    """
    rows = F.count(F.lit(1)) if also is None else F.count(F.lit(1)) + F.max(F.xxhash64(also)) * 0
    ids = ratings.groupBy(F.col(key).alias("_key")).agg(F.max(key).alias(key), rows.alias("_rows"))
    return ids.where(F.col("_rows") > 0).select(key)


def _formula_tables(ratings: DataFrame, also: str | None = None) -> tuple[DataFrame, DataFrame]:
    users = scoring.formula_factors(_ids(ratings, USER, also), USER, 0, K)
    items = scoring.formula_factors(_ids(ratings, ITEM, also), ITEM, 1, K)
    return users, items


def _forward(kind):
    def run(spark, sf_dir):
        ratings = _labelled(spark, sf_dir)
        users, items = _formula_tables(ratings)
        pairs = ratings.select(USER, ITEM)
        net = scoring.Dense.from_formula(K, H)
        if kind == "mf":
            scored = scoring.score_mf(pairs, users, items, K, USER, ITEM)
        elif kind == "deep":
            scored = scoring.score_mlp(pairs, users, items, net, USER, ITEM)
        else:
            scored = scoring.score_residual(pairs, users, items, net, K, USER, ITEM)
        return scored.select(USER, ITEM, _r6("prediction"))

    return run


def q_mf_forward_cold(spark, sf_dir):
    """Factors of train ids only, asked for all pairs and for users that no table holds."""
    labelled = _stored(spark, sf_dir)
    users, items = _formula_tables(prep.part_of(labelled, "train"))
    pairs = labelled.select(USER, ITEM)
    unseen = pairs.where(F.col(USER) % 50 == 0).select((F.col(USER) + 1_000_000).alias(USER), ITEM)
    return scoring.score_mf(pairs.unionByName(unseen), users, items, K, USER, ITEM).select(USER, ITEM, _r6("prediction"))


def _autorec_scored(spark, sf_dir) -> DataFrame:
    labelled = _stored(spark, sf_dir)
    train = prep.part_of(labelled, "train")
    centred = prep.center(labelled, prep.global_mean(train))
    coder = scoring.formula_coder(labelled.select(ITEM).distinct(), ITEM, CODER_H)
    return scoring.score_autorec(
        centred, prep.part_of(centred, "train"), coder, scoring.formula_hidden_bias(CODER_H), USER, ITEM
    )


def q_autorec_forward(spark, sf_dir):
    return _autorec_scored(spark, sf_dir).select(USER, ITEM, _r6("prediction"))


def q_autorec_masked_rmse(spark, sf_dir):
    return masked_rmse(_autorec_scored(spark, sf_dir), by=["split"]).select("split", _r6("rmse"))


def _mf_scored(spark, sf_dir, raw: str | None = None) -> DataFrame:
    """Centred ratings with their scores; ``raw`` names a column for the rating as given."""
    ratings = _labelled(spark, sf_dir)
    users, items = _formula_tables(ratings, "rating")
    kept = ratings.withColumn(raw, F.col("rating")) if raw else ratings
    centred = prep.center(kept, prep.global_mean(prep.part_of(ratings, "train")))
    return scoring.score_mf(centred, users, items, K, USER, ITEM)


def q_mf_rmse(spark, sf_dir):
    return rmse(_mf_scored(spark, sf_dir), by=["split"]).select("split", _r6("rmse"))


def q_mf_batch_rmse(spark, sf_dir):
    numbered = batch_no(_mf_scored(spark, sf_dir), 1000, [USER, ITEM])
    return batch_mean_rmse(numbered).select(_r6("batch_rmse"))


def q_masked_rmse_zero(spark, sf_dir):
    """The literal mask on ratings shifted by 2.5, so that those of 2.5 count as missing."""
    scored = _mf_scored(spark, sf_dir, raw="given").where(F.col(USER).isNotNull() & F.col(ITEM).isNotNull())
    shifted = scored.withColumn("rating", F.col("given") - 2.5)
    return masked_rmse(shifted, by=["split"], zero_is_missing=True).select("split", _r6("rmse"))


def q_metrics_roundtrip(spark, sf_dir):
    """Errors written twice in append mode and read back."""
    path = _fresh(spark, "metrics")
    errors = cut_lineage(rmse(_mf_scored(spark, sf_dir), by=["split"]))  # one row per split, written twice
    for epoch in (0, 1):
        row = errors.select(F.lit("mf").alias("model"), F.lit(epoch).alias("epoch"), "split", F.lit("rmse").alias("metric"), _r6("rmse"))
        io.write_metrics(row.withColumnRenamed("rmse", "value"), path)
    return spark.read.parquet(path)


# -- training -----------------------------------------------------------------------------


def q_mf_sgd_step(spark, sf_dir):
    labelled = _stored(spark, sf_dir)
    train = prep.part_of(labelled, "train")
    centred = prep.center(train, prep.global_mean(train))
    users, items = _formula_tables(labelled)
    state = full_batch.start(users, items, K, USER, ITEM)
    stepped = full_batch.step(centred, state, K, user=USER, item=ITEM)
    return stepped.select("kind", "idx", F.posexplode("values").alias("pos", "value")).select(
        "kind", "idx", "pos", _r6("value")
    )


def q_mf_train_step(spark, sf_dir):
    """The training loop itself: formula start, one stratum, one epoch, one batch of all ratings."""
    labelled = _stored(spark, sf_dir)
    mean = prep.global_mean(prep.part_of(labelled, "train"))
    cells = prep.center(labelled, mean).select(
        F.col(USER).alias("user"), F.col(ITEM).alias("item"), F.col("rating").alias("y"), (F.col("split") == "test").alias("held_out")
    )
    start = None
    for kind, id_col, table in zip(("user", "item"), (USER, ITEM), _formula_tables(labelled)):
        one = table.select(F.lit(kind).alias("kind"), F.col(id_col).cast("long").alias("idx"), F.concat("factors", F.array("bias")).alias("values"))
        start = one if start is None else start.unionByName(one)
    how = Descent(epochs=1, batch=cells.where(~F.col("held_out")).count(), lr=1.0, decay=1e-5, strata=1)
    model = PairNet(K, 0, True)
    state, _ = strata.descend(cells, model, how, "one step", start)
    tables = [row_values(state, kind, model.row_width).select(F.lit(kind).alias("kind"), "idx", "values") for kind in ("user", "item")]
    return _positions(tables[0].unionByName(tables[1]))


def _positions(state: DataFrame) -> DataFrame:
    return state.select("kind", "idx", F.posexplode("values").alias("pos", "value")).select("kind", "idx", "pos", _r6("value"))


def _network_step(model: PairNet):
    def run(spark, sf_dir):
        labelled = _stored(spark, sf_dir)
        train = prep.part_of(labelled, "train")
        centred = prep.center(train, prep.global_mean(train))
        net = scoring.Dense.from_formula(K, H)
        # Formula values make hidden inputs of exactly 0, where the sign would hang on rounding.
        net = scoring.Dense(net.w1, [b + 3e-5 for b in net.b1], net.w2, net.b2)
        rows = synchronous.network_row(spark, net)
        for kind, id_col, table in zip(("user", "item"), (USER, ITEM), _formula_tables(labelled)):
            values = F.concat("factors", F.array("bias")) if model.bilinear else F.col("factors")
            rows = rows.unionByName(table.select(F.lit(kind).alias("kind"), F.col(id_col).cast("long").alias("idx"), values.alias("values")))
        state = synchronous.at_rest(rows)
        return _positions(synchronous.pair_step(centred, cut_lineage(state), model, user=USER, item=ITEM)[0])

    return run


def q_autorec_sgd_step(spark, sf_dir):
    labelled = _stored(spark, sf_dir)
    train = prep.part_of(labelled, "train")
    centred = prep.center(train, prep.global_mean(train))
    cells = centred.select(F.col(USER).alias("user"), F.col(ITEM).alias("item"), F.col("rating").alias("y"))
    coder = scoring.formula_coder(labelled.select(ITEM).distinct(), ITEM, CODER_H)
    parts = coder.groupBy(ITEM).agg(
        F.array_sort(F.collect_list(F.struct("part", "w_in", "w_out"))).alias("parts"), F.first("b_out").alias("b_out")
    )
    flat = [F.flatten(F.col("parts")[c]) for c in ("w_in", "w_out")]
    rows = parts.select(F.lit("item").alias("kind"), F.col(ITEM).cast("long").alias("idx"), F.concat(*flat, F.array("b_out")).alias("values"))
    bias = [("net", 0, scoring.formula_hidden_bias(CODER_H))]
    rows = rows.unionByName(spark.createDataFrame(bias, "kind string, idx long, values array<double>"))
    state = cut_lineage(synchronous.at_rest(rows))
    return _positions(synchronous.coder_step(cells, state, RowCoder(CODER_H, 0))[0])


def q_user_batches(spark, sf_dir):
    """Batches of 128 users in the orders of two epochs."""
    train = prep.part_of(_labelled(spark, sf_dir), "train")
    return synchronous.user_batches(train, 128, 2, user=USER).select("epoch", "batch", F.col("user").alias(USER))


def _trained(trainer):
    def run(spark, sf_dir):
        train, test = (
            part.select(F.col(USER).alias("user_idx"), F.col(ITEM).alias("item_idx"), "rating")
            for part in _planted(spark, sf_dir)
        )
        return trainer.fit(train, test).metrics

    return run


# -- sources and sinks --------------------------------------------------------------------


def _as_raw(ratings: DataFrame) -> DataFrame:
    return ratings.select(
        (F.col(USER) + 1).cast("int").alias("userId"),
        F.col(ITEM).cast("int").alias("movieId"),
        "rating",
        F.lit(0).cast("long").alias("timestamp"),
    )


def q_roundtrip_dat(spark, sf_dir):
    path = _fresh(spark, "dat")
    io.write_ratings_dat(_as_raw(ratings_view(spark, sf_dir)), path)
    back = normalise(io.read_ratings_dat(spark, path))
    return back.select(F.col(USER).cast("long"), F.col(ITEM).cast("long"), "rating")


def q_roundtrip_csv(spark, sf_dir):
    path = _fresh(spark, "csv")
    io.write_ratings_csv(
        ratings_view(spark, sf_dir).select(
            F.col(USER).alias("user_idx"), F.col(ITEM).alias("movie_idx"), "rating"
        ),
        path,
    )
    return prep.as_triples(io.read_ratings_csv(spark, path), item="movie_idx")


def q_roundtrip_split(spark, sf_dir):
    path = _fresh(spark, "split")
    labelled = _labelled(spark, sf_dir)
    io.save_split(prep.part_of(labelled, "train"), prep.part_of(labelled, "test"), path)
    train, test = io.load_split(spark, path)
    return (
        train.withColumn("split", F.lit("train"))
        .unionByName(test.withColumn("split", F.lit("test")))
        .select(USER, ITEM, "rating", "split")
    )


def q_roundtrip_index(spark, sf_dir):
    path = _fresh(spark, "index")
    io.save_interactions(ratings_view(spark, sf_dir), path, USER, ITEM)
    by_user, by_item = io.load_interactions(spark, path)
    return by_user.join(by_item.withColumnRenamed("rating", "rating_by_item"), [USER, ITEM])


def q_prepared_split(spark, sf_dir):
    """The whole preparation, twice: loaded from the store, and made again where half of the store is gone."""
    raw = cut_lineage(_as_raw(ratings_view(spark, sf_dir)))
    whole, half = _fresh(spark, "prepared"), _fresh(spark, "half")
    train, _ = prepare(spark, raw, whole)
    train.write.parquet(f"{half}/split=train")
    runs = [("loaded", prepare(spark, raw.limit(0), whole)), ("again", prepare(spark, raw, half))]
    parts = [
        part.select(F.lit(run).alias("run"), F.col(USER).cast("long"), F.col(ITEM).cast("long"), "user_idx", "item_idx", "rating", F.lit(split).alias("split"))
        for run, pair in runs
        for split, part in zip(("train", "test"), pair)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def bucketed_lookup(spark: SparkSession, labelled: DataFrame) -> DataFrame:
    """How many ratings each test pair's user has in the train index; both are stored in buckets by user."""
    tables = {}
    for split in ("train", "test"):
        name, path = f"{split}_{uuid.uuid4().hex}", _fresh(spark, split)
        io.save_bucketed(prep.part_of(labelled, split), path, name, USER, ITEM)
        spark.sql(f"DROP TABLE {name}")  # its files stay, as for another session
        tables[split] = io.load_bucketed(spark, path, name, USER, ITEM)
    train = tables["train"].select(USER, F.col("rating").alias("_r"))
    return tables["test"].join(train, USER).groupBy(USER, ITEM).agg(F.count("_r").alias("n_train"), F.sum("_r").alias("sum_train"))


def q_roundtrip_buckets(spark, sf_dir):
    return bucketed_lookup(spark, _stored(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ratings_view": ratings_view,
    "activity_users": q_activity_users,
    "activity_items": q_activity_items,
    "distinct_ids": q_distinct_ids,
    "top_filter": q_top_filter,
    "dense_ids": q_dense_ids,
    "split_hash": q_split_hash,
    "split_exact": q_split_exact,
    "centered": q_centered,
    "user_items": q_user_items,
    "item_users": q_item_users,
    "user_vectors": q_user_vectors,
    "extent": q_extent,
    "user_stats": _stats(USER),
    "item_stats": _stats(ITEM),
    "user_neighbors": _neighbors(USER),
    "item_neighbors": _neighbors(ITEM),
    "user_knn_predict": _knn_predict(USER, "mean"),
    "user_knn_predict_zero": _knn_predict(USER, "zero"),
    "item_knn_predict": _knn_predict(ITEM, "mean"),
    "item_knn_predict_zero": _knn_predict(ITEM, "zero"),
    "user_knn_mse": _knn_mse(USER),
    "item_knn_mse": _knn_mse(ITEM),
    "als_predict": q_als_predict,
    "als_products": q_als_products,
    "als_optimality": q_als_optimality,
    "attached": q_attached,
    "als_mse": q_als_mse,
    "mf_forward": _forward("mf"),
    "deep_forward": _forward("deep"),
    "residual_forward": _forward("residual"),
    "mf_forward_cold": q_mf_forward_cold,
    "autorec_forward": q_autorec_forward,
    "autorec_masked_rmse": q_autorec_masked_rmse,
    "mf_rmse": q_mf_rmse,
    "mf_batch_rmse": q_mf_batch_rmse,
    "masked_rmse_zero": q_masked_rmse_zero,
    "metrics_roundtrip": q_metrics_roundtrip,
    "mf_sgd_step": q_mf_sgd_step,
    "mf_train_step": q_mf_train_step,
    "deep_sgd_step": _network_step(PairNet(K, H, False)),
    "residual_sgd_step": _network_step(PairNet(K, H, True)),
    "autorec_sgd_step": q_autorec_sgd_step,
    "user_batches": q_user_batches,
    "mf_train": _trained(MatrixFactorization()),
    "deep_train": _trained(DeepMF()),
    "residual_train": _trained(ResidualMF()),
    "autorec_train": _trained(AutoRec()),
    "roundtrip_dat": q_roundtrip_dat,
    "roundtrip_csv": q_roundtrip_csv,
    "roundtrip_split": q_roundtrip_split,
    "roundtrip_index": q_roundtrip_index,
    "roundtrip_buckets": q_roundtrip_buckets,
    "prepared_split": q_prepared_split,
}
