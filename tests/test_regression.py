from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.operators import regression


@pytest.fixture(scope="module")
def features(spark):
    n = F.col("id")
    return spark.range(2000).select(
        (n % 4).cast("int").alias("passenger_count"), (n % 13).cast("double").alias("trip_distance"),
        (n % 3).cast("string").alias("PULocationID"), (n % 5).cast("string").alias("DOLocationID"),
        (n % 2).cast("string").alias("payment_type"), (5 + n % 17).cast("double").alias("fare_amount"),
        (n % 7).cast("double").alias("tolls_amount"),
        (1 + 0.2 * (5 + n % 17) + F.when(n % 2 == 1, 3).otherwise(0)).cast("double").alias("tip_amount"),
    )


def test_feature_table_drops_free_trips(spark):
    df = spark.createDataFrame([(1, 2.0, 7, 8, 1, 0.0, 0.0, 1.0), (1, 2.0, 7, 8, 1, 5.0, 0.0, 1.0)],
        "passenger_count int, trip_distance double, PULocationID int, DOLocationID int, payment_type int, "
        "fare_amount double, tolls_amount double, tip_amount double")
    table = regression.feature_table(df)
    assert table.count() == 1 and dict(table.dtypes)["PULocationID"] == "string"


def test_exact_line_is_recovered(spark, features):
    training, evaluation = regression.split(features)
    assert training.count() + evaluation.count() == 2000 and evaluation.count() > 200
    model = regression.train(training)
    error = regression.evaluate(regression.predict(model, evaluation)).first()
    assert error.mean_absolute_error < 1e-3 and error.r2_score > 0.999 and error.explained_variance > 0.999
    weights = {(r.processed_input, r.category): r.weight for r in regression.coefficients(spark, model).collect()}
    assert weights["fare_amount", None] == pytest.approx(0.2, abs=1e-3)
    assert weights["payment_type", "1"] - weights["payment_type", "0"] == pytest.approx(3, abs=1e-2)


def test_missing_numbers_and_labels_keep_their_rows(spark, features):
    holes = features.withColumn("passenger_count", F.when(F.col("fare_amount") > 9, F.col("passenger_count"))).withColumn(
        "tolls_amount", F.lit(None).cast("double")).withColumn("PULocationID", F.when(F.col("trip_distance") > 3, F.col("PULocationID")))
    unlabelled = holes.withColumn("tip_amount", F.when(F.col("trip_distance") > 1, F.col("tip_amount")))
    model = regression.train(unlabelled)
    scored = regression.predict(model, unlabelled)
    assert scored.count() == 2000 and scored.filter(F.col("predicted_tip_amount").isNull()).count() == 0
    assert regression.explain(model, unlabelled).count() == 2000
    assert regression.evaluate(scored).first().median_absolute_error is not None


def test_weights_are_determined(spark, features):
    weights = {(r.processed_input, r.category): r.weight for r in regression.coefficients(spark, regression.train(features)).collect()}
    assert len(weights) == 1 + 4 + 3 + 5 + 2
    for name, base in (("PULocationID", 3), ("DOLocationID", 5), ("payment_type", 2)):
        of = [weight for (column, _), weight in weights.items() if column == name]
        assert len(of) == base and 0.0 in of


def test_explanations_add_up(features):
    model = regression.train(features)
    explained = regression.explain(model, features, top=7)
    mean = explained.agg(F.avg("predicted_tip_amount")).first()[0]
    row = explained.first()
    assert len(row.top_feature_attributions) == 7
    assert sum(p.attribution for p in row.top_feature_attributions) == pytest.approx(row.predicted_tip_amount - mean, abs=1e-6)
    assert {p.feature for p in regression.explain(model, features, 2).first().top_feature_attributions} == {"fare_amount", "payment_type"}


def test_categories_of_later_rows_may_be_new(features):
    model = regression.train(features)
    unseen = features.limit(5).withColumn("PULocationID", F.lit("never seen"))
    assert regression.predict(model, unseen).count() == 5
    assert regression.explain(model, unseen).count() == 5


def test_tuning_reports_every_trial_best_first(features):
    lines = regression.tune(features, points=[(20.0, 10.0), (0.0, 0.0), (0.0, 0.1)]).collect()
    assert [r.trial_id for r in lines] == [2, 3, 1]
    assert regression.trial_points(5) == regression.trial_points(5) and len(regression.trial_points(5)) == 5


def test_feature_info(features):
    info = {r.input: r for r in regression.feature_info(features).collect()}
    assert info["DOLocationID"].category_count == 5 and info["DOLocationID"].min is None
    assert (info["fare_amount"].min, info["fare_amount"].max, info["fare_amount"].null_count) == (5.0, 21.0, 0)


def test_batch_scoring_equals_the_expression(spark, features):
    scored = regression.score_in_batches(features, ["passenger_count", "trip_distance"])
    assert scored.columns == ["passenger_count", "trip_distance", "predicted_duration"]
    assert scored.filter(F.col("predicted_duration") != F.col("trip_distance") * 5).count() == 0


def _design(rows, model):
    """The design matrix row by row, as numpy."""
    lines = []
    for row in rows:
        line = [1.0] + [model.means[name] if row[name] is None else float(row[name]) for name in regression.NUMBERS]
        for name in regression.CATEGORIES:
            line += [float(row[name] == label) for label in model.labels[name][1:]]
        lines.append(line)
    return np.array(lines), np.array([row[regression.LABEL] for row in rows])


@pytest.fixture(scope="module")
def noisy(features):
    """Holes in numbers and categories, labels that are no line, and rows without a label."""
    n = F.xxhash64(*features.columns)
    return features.withColumns({
        "tip_amount": F.when(n % 11 != 0, F.col("tip_amount") + F.pmod(n, F.lit(7)) / 3),
        "trip_distance": F.when(n % 5 != 0, F.col("trip_distance")),
        "DOLocationID": F.when(n % 6 != 0, F.col("DOLocationID")),
        "passenger_count": F.lit(2),
    })


def test_weights_equal_least_squares_on_rows(noisy):
    model = regression.train(noisy)
    rows = noisy.filter("tip_amount is not null").collect()
    design, label = _design(rows, model)
    assert np.allclose(model.products.gram, design.T @ design) and np.allclose(model.products.moments, design.T @ label)
    # Passengers are a constant beside the intercept: no weight of their own.
    assert model.weights[1] == 0.0
    best = np.linalg.lstsq(design, label, rcond=None)[0]
    assert np.allclose(design @ model.weights, design @ best)
    assert model.products.mean_squared_error(model.weights) == pytest.approx(np.mean((label - design @ best) ** 2))


@pytest.mark.parametrize("l1, l2", [(0.05, 0.0), (0.0, 0.3), (0.1, 0.2), (50.0, 1.0)])
def test_penalised_weights_are_optimal(noisy, l1, l2):
    model = regression.train(noisy, l1, l2)
    design, label = _design(noisy.filter("tip_amount is not null").collect(), model)
    spread = design.std(axis=0)
    slope = design.T @ (label - design @ model.weights) / len(label)
    assert slope[0] == pytest.approx(0, abs=1e-9)
    for k in np.flatnonzero(spread):
        weight, pull = model.weights[k] * spread[k], slope[k] / spread[k]
        if weight:
            assert pull == pytest.approx(l1 * np.sign(weight) + l2 * weight, abs=1e-8)
        else:
            assert abs(pull) <= l1 + 1e-9
    assert l1 < 50 or not model.weights[1:].any()


def test_tuning_judges_on_evaluation_rows(noisy):
    points = [(0.0, 0.0), (0.2, 0.1), (5.0, 10.0)]
    lines = {row.trial_id: row.mean_squared_error for row in regression.tune(noisy, points=points).collect()}
    training, evaluation = regression.split(noisy)
    for k, (l1, l2) in enumerate(points, 1):
        scored = regression.predict(regression.train(training, l1, l2), evaluation)
        assert lines[k] == pytest.approx(regression.evaluate(scored).first().mean_squared_error)


def test_sums_are_one_pass_over_the_rows(spark, noisy, tmp_path):
    noisy.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    sums = regression.statistics(rows, regression.split_mark(rows))
    assert sums.agg(F.sum("n")).first()[0] == noisy.filter("tip_amount is not null").count()
    assert sums.count() <= 2 * (3 + 1) * (5 + 1) * (2 + 1) * 2


def test_no_rows_and_too_many_weights(spark, noisy, monkeypatch):
    empty = regression.train(noisy.limit(0))
    assert not empty.weights.any() and regression.predict(empty, noisy).count() == noisy.count()
    assert not regression.train(noisy.limit(0), 1.0, 1.0).weights.any()
    monkeypatch.setattr(regression, "MOST_WEIGHTS", 5)
    with pytest.raises(ValueError, match="weights"):
        regression.train(noisy)
