"""Linear regression of the tip: features, training, scoring, explanation, tuning.

The rows are read once, for sums per combination of categories and of missing numbers. Everything a
least-squares fit needs follows from that stored table: the products of all columns, for any
filling of missing numbers, for training and evaluation rows apart. Plain fits are solved by elimination, penalised
ones by coordinate descent on the products, and squared errors come from the products too, so
trials of a tuning job cost no further pass. What reaches the driver is bounded by the square of the number of
weights, ``MOST_WEIGHTS`` at most.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterline.operators.percentiles import exact_percentiles
from meterline.workspace import materialize

LABEL = "tip_amount"
PREDICTION = "predicted_tip_amount"
CATEGORIES = ["PULocationID", "DOLocationID", "payment_type"]
NUMBERS = ["passenger_count", "trip_distance", "fare_amount", "tolls_amount"]
# The search space of the tuning job.
L1_RANGE = (0.0, 20.0)
L2_CANDIDATES = (0.0, 0.1, 1.0, 10.0)
# The products of the weights are solved on the driver.
MOST_WEIGHTS = 4096
# A column of which less than this part is left by the columns before it depends on them.
DEPENDENT = 1e-9
MOST_ROUNDS = 1000


def feature_table(trips: DataFrame) -> DataFrame:
    """Features and label of trips with a fare; ids become text, that is, categories."""
    return trips.filter(F.col("fare_amount") != 0).select(
        F.col("passenger_count").cast("int").alias("passenger_count"),
        F.col("trip_distance").cast("double").alias("trip_distance"),
        *[F.col(name).cast("string").alias(name) for name in CATEGORIES],
        *[F.col(name).cast("double").alias(name) for name in ("fare_amount", "tolls_amount", LABEL)],
    )


def feature_info(features: DataFrame) -> DataFrame:
    """Range, mean, spread, category and NULL counts per column, in one pass."""
    lines = []
    for name in features.columns:
        number = name not in CATEGORIES
        value = F.col(name).cast("double") if number else F.lit(None).cast("double")
        lines.append(
            F.struct(
                F.lit(name).alias("input"),
                F.min(value).alias("min"),
                F.max(value).alias("max"),
                F.avg(value).alias("mean"),
                F.stddev(value).alias("stddev"),
                (F.lit(None).cast("bigint") if number else F.count_distinct(name)).alias("category_count"),
                F.count_if(F.col(name).isNull()).alias("null_count"),
            )
        )
    return features.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def split_mark(features: DataFrame, evaluation_tenths: int = 2) -> Column:
    """Whether a row is for evaluation: a hash of its text, the same on every run and in any engine."""
    text = F.concat_ws("|", *[F.col(name).cast("string") for name in features.columns])
    return F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("int") % 10 < evaluation_tenths


def split(features: DataFrame, evaluation_tenths: int = 2) -> tuple[DataFrame, DataFrame]:
    """Training and evaluation rows."""
    mark = split_mark(features, evaluation_tenths)
    return features.filter(~mark), features.filter(mark)


_PAIRS = [(a, b) for k, a in enumerate(NUMBERS) for b in NUMBERS[k:]]


def _missing(name: str) -> str:
    return f"_no_{name}"


def statistics(features: DataFrame, judged: Column | None = None) -> DataFrame:
    """Sums of the rows with a known label per combination of categories and missing numbers; stored.

    One pass with map-side sums. ``judged`` marks evaluation rows. Missing numbers add nothing here.
    """
    label = F.col(LABEL)
    rows = features.withColumn("_judged", F.lit(False) if judged is None else judged).filter(label.isNotNull())
    value = {name: F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for name in NUMBERS}
    missing = [F.col(name).isNull().alias(_missing(name)) for name in NUMBERS]
    return materialize(rows.groupBy("_judged", *CATEGORIES, *missing).agg(
        F.count("*").cast("double").alias("n"), F.sum(label).alias("y"), F.sum(label * label).alias("yy"),
        *[F.sum(value[name]).alias(f"x_{name}") for name in NUMBERS],
        *[F.sum(value[name] * label).alias(f"y_{name}") for name in NUMBERS],
        *[F.sum(value[a] * value[b]).alias(f"xx_{a}_{b}") for a, b in _PAIRS],
    ), "tip-sums")


def _means(sums: DataFrame) -> dict[str, float]:
    """Mean of the known values of each number, 0 where there is none."""
    there = {name: F.when(~F.col(_missing(name)), F.col("n")) for name in NUMBERS}
    row = sums.agg(*[F.coalesce(F.sum(f"x_{name}") / F.sum(there[name]), F.lit(0.0)).alias(name) for name in NUMBERS]).first()
    return row.asDict()


def _filled(sums: DataFrame, means: dict[str, float]) -> DataFrame:
    """The sums with missing numbers filled by ``means``; a group knows which of its numbers are missing."""
    fill = {name: F.when(F.col(_missing(name)), F.lit(means[name])).otherwise(F.lit(0.0)) for name in NUMBERS}
    x, n = {name: F.col(f"x_{name}") for name in NUMBERS}, F.col("n")
    return sums.select(
        *CATEGORIES, "n", "y", "yy",
        *[(x[name] + n * fill[name]).alias(f"x_{name}") for name in NUMBERS],
        *[(F.col(f"y_{name}") + F.col("y") * fill[name]).alias(f"y_{name}") for name in NUMBERS],
        *[(F.col(f"xx_{a}_{b}") + x[a] * fill[b] + x[b] * fill[a] + n * fill[a] * fill[b]).alias(f"xx_{a}_{b}") for a, b in _PAIRS],
    )


@dataclass
class Products:
    """Products of all columns of the design, the intercept first: X'X, X'y, y'y."""

    gram: np.ndarray
    moments: np.ndarray
    square: float

    @property
    def n(self) -> float:
        return float(self.gram[0, 0])

    def mean_squared_error(self, weights: np.ndarray) -> float:
        return float(self.square - 2 * weights @ self.moments + weights @ self.gram @ weights) / self.n if self.n else float("nan")


def _rollup(filled: DataFrame) -> list:
    """The sums per category, per pair of categories of two columns, and in all."""
    sets = [[], *([name] for name in CATEGORIES), *map(list, combinations(CATEGORIES, 2))]
    columns = [F.col(name) for name in CATEGORIES]
    values = [name for name in filled.columns if name not in CATEGORIES]
    of = filled.groupingSets([[F.col(name) for name in chosen] for chosen in sets], *columns)
    return of.agg(F.grouping_id(*columns).alias("_left_out"), *[F.sum(name).alias(name) for name in values]).collect()


def _labels(rolled: list) -> dict[str, list[str]]:
    """The categories of each column, the most frequent first; that one is the base and has no weight."""
    labels: dict[str, list[str]] = {}
    for place, name in enumerate(CATEGORIES):
        alone = 7 ^ (4 >> place)
        counts = {row[name]: row["n"] for row in rolled if row["_left_out"] == alone and row[name] is not None}
        labels[name] = sorted(counts, key=lambda label: (-counts[label], label))
    weights = 1 + len(NUMBERS) + sum(max(len(own) - 1, 0) for own in labels.values())
    if weights > MOST_WEIGHTS:
        raise ValueError(f"{weights} weights: the products of more than {MOST_WEIGHTS} are not for one machine")
    return labels


def _products(rolled: list, labels: dict[str, list[str]]) -> Products:
    """The design's products from rolled-up sums; a missing or unlisted category counts as the base."""
    places: dict[tuple[str, str], int] = {}
    for name in CATEGORIES:
        for label in labels[name][1:]:
            places[name, label] = 1 + len(NUMBERS) + len(places)
    size = 1 + len(NUMBERS) + len(places)
    gram, moments, square = np.zeros((size, size)), np.zeros(size), 0.0
    number = {name: k + 1 for k, name in enumerate(NUMBERS)}
    for row in rolled:
        grouped = [name for place, name in enumerate(CATEGORIES) if not row["_left_out"] & (4 >> place)]
        at = [places.get((name, row[name])) for name in grouped]
        if None in at or row["n"] is None:
            continue
        if len(at) == 2:
            gram[at[0], at[1]] = gram[at[1], at[0]] = row["n"]
            continue
        own = at[0] if at else 0
        gram[own, own] = row["n"]
        gram[own, 0] = gram[0, own] = row["n"]
        moments[own] = row["y"]
        for name, k in number.items():
            gram[own, k] = gram[k, own] = row[f"x_{name}"]
        if not at:
            square = row["yy"]
            for name, k in number.items():
                moments[k] = row[f"y_{name}"]
            for a, b in _PAIRS:
                gram[number[a], number[b]] = gram[number[b], number[a]] = row[f"xx_{a}_{b}"]
    return Products(gram, moments, square)


def solve(products: Products) -> np.ndarray:
    """Least-squares weights by elimination; a column that follows from those before it weighs 0."""
    size = len(products.moments)
    table = np.column_stack([products.gram, products.moments])
    least = DEPENDENT * np.diag(products.gram)
    used = np.zeros(size, bool)
    for k in range(size):
        if table[k, k] > least[k]:
            used[k] = True
            table[k] /= table[k, k]
            others = np.arange(size) != k
            table[others] -= np.outer(table[others, k], table[k])
    return np.where(used, table[:, -1], 0.0)


def solve_penalised(products: Products, l1: float, l2: float) -> np.ndarray:
    """Weights that minimise half the mean squared error plus ``l1`` times their sizes and half ``l2`` times their squares.

    Weights are penalised in units of their column's spread, the intercept not at all. Coordinate
    descent goes over the columns until none moves, each step from the products alone.
    """
    n = products.n
    if not n:
        return np.zeros(len(products.moments))
    means = products.gram[0] / n
    spread = np.sqrt(np.maximum(np.diag(products.gram) / n - means * means, 0.0))
    spread[np.diag(products.gram) / n * DEPENDENT >= spread * spread] = 0.0
    spread[0] = 0.0
    scale = np.where(spread > 0, spread, 1.0)
    gram = (products.gram / n - np.outer(means, means)) / np.outer(scale, scale)
    mean = products.moments[0] / n
    moments = (products.moments / n - means * mean) / scale
    weights = np.zeros(len(scale))
    columns = np.flatnonzero(spread > 0)
    for _ in range(MOST_ROUNDS):
        moved = 0.0
        for k in columns:
            rest = moments[k] - gram[k] @ weights + gram[k, k] * weights[k]
            new = np.sign(rest) * max(abs(rest) - l1, 0.0) / (gram[k, k] + l2)
            moved, weights[k] = max(moved, abs(new - weights[k])), new
        if moved <= 1e-12 * (1 + np.abs(weights).max()):
            break
    found = weights / scale
    found[0] = mean - found[1:] @ means[1:]
    return found


@dataclass
class TipModel:
    """Weights of the tip model and the numbers that fill what is missing."""

    means: dict[str, float]
    labels: dict[str, list[str]]
    weights: np.ndarray
    products: Products

    def rows(self) -> list[tuple[str, str | None, float]]:
        """(column, category or None, weight); base categories weigh 0."""
        found = [("__INTERCEPT__", None, float(self.weights[0]))]
        found += [(name, None, float(weight)) for name, weight in zip(NUMBERS, self.weights[1:])]
        place = 1 + len(NUMBERS)
        for name in CATEGORIES:
            own = [0.0, *self.weights[place:place + max(len(self.labels[name]) - 1, 0)].tolist()]
            found += [(name, label, weight) for label, weight in zip(self.labels[name], own)]
            place += max(len(self.labels[name]) - 1, 0)
        return found


def train(features: DataFrame, l1: float = 0.0, l2: float = 0.0) -> TipModel:
    """Fit the tip on rows whose tip is known.

    No row is dropped: a missing number takes the training mean, or 0 where training has none. A
    missing or new category counts as the base category, the most frequent one (of equals the
    first by text), which has no weight of its own: weights beside an intercept are determined then.
    """
    sums = statistics(features)
    means = _means(sums)
    rolled = _rollup(_filled(sums, means))
    labels = _labels(rolled)
    products = _products(rolled, labels)
    return TipModel(means, labels, solve_penalised(products, l1, l2) if l1 or l2 else solve(products), products)


def coefficients(spark: SparkSession, model: TipModel) -> DataFrame:
    """One row per weight: column, category (NULL for numbers) and weight; base categories weigh 0."""
    return spark.createDataFrame(model.rows(), "processed_input string, category string, weight double")


def _shares(model: TipModel, features: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """``features`` with the weight of every category, and what each column adds to the prediction.

    Category weights are joined from a stored table, so their number is no part of the plan.
    """
    table = materialize(coefficients(features.sparkSession, model), "weights")
    for name in CATEGORIES:
        weights = table.filter((F.col("processed_input") == name) & F.col("category").isNotNull()).select(
            F.col("category").alias(f"_{name}"), F.col("weight").alias(f"_{name}_weight"))
        features = features.join(weights, F.col(name) == F.col(f"_{name}"), "left").drop(f"_{name}")
    numeric = dict(zip(NUMBERS, model.weights[1:].tolist()))
    shares = {name: F.coalesce(F.col(name).cast("double"), F.lit(model.means[name])) * F.lit(numeric[name]) for name in NUMBERS}
    return features, shares | {name: F.coalesce(F.col(f"_{name}_weight"), F.lit(0.0)) for name in CATEGORIES}


def _sum(model: TipModel, shares: dict[str, Column]) -> Column:
    total = F.lit(float(model.weights[0]))
    for share in shares.values():
        total = total + share
    return total.alias(PREDICTION)


def predict(model: TipModel, features: DataFrame) -> DataFrame:
    """Every feature row with the predicted tip."""
    joined, shares = _shares(model, features)
    return joined.select(*features.columns, _sum(model, shares))


def evaluate(predictions: DataFrame) -> DataFrame:
    """Error measures of the predictions; the median is exact."""
    label, guess = F.col(LABEL), F.col(PREDICTION)
    error = label - guess
    log_error = F.log1p(F.greatest(label, F.lit(0.0))) - F.log1p(F.greatest(guess, F.lit(0.0)))
    known = materialize(
        predictions.filter(label.isNotNull()).select(label, F.abs(error).alias("size"), error.alias("error"), log_error.alias("log_error")),
        "errors",
    )
    measures = known.agg(
        F.avg("size").alias("mean_absolute_error"),
        F.avg(F.col("error") * F.col("error")).alias("mean_squared_error"),
        F.avg(F.col("log_error") * F.col("log_error")).alias("mean_squared_log_error"),
        (1 - F.avg(F.col("error") * F.col("error")) / F.var_pop(label)).alias("r2_score"),
        (1 - F.var_pop("error") / F.var_pop(label)).alias("explained_variance"),
    )
    median = exact_percentiles(known, [], "size", {"median_absolute_error": 0.5}).scalar()
    return measures.select(
        "mean_absolute_error", "mean_squared_error", "mean_squared_log_error", median.alias("median_absolute_error"),
        "r2_score", "explained_variance",
    )


def explain(model: TipModel, features: DataFrame, top: int = 3) -> DataFrame:
    """Predictions with the ``top`` columns that move each one most from the average.

    A column's share is its weight times the distance of its value from the mean over ``features``.
    """
    joined, shares = _shares(model, features)
    shared = materialize(
        joined.select(*features.columns, _sum(model, shares), *[share.alias(f"_share_{name}") for name, share in shares.items()]), "shares")
    means = shared.agg(*[F.coalesce(F.avg(f"_share_{name}"), F.lit(0.0)).alias(name) for name in shares]).first()
    parts = [
        F.struct(
            F.abs(F.col(f"_share_{name}") - F.lit(means[name])).alias("size"),
            F.lit(name).alias("feature"),
            (F.col(f"_share_{name}") - F.lit(means[name])).alias("attribution"),
        )
        for name in shares
    ]
    ranked = F.slice(F.sort_array(F.array(*parts), asc=False), 1, top)
    return shared.select(
        *features.columns, PREDICTION,
        F.transform(ranked, lambda part: F.struct(part["feature"].alias("feature"), part["attribution"].alias("attribution")))
        .alias("top_feature_attributions"),
    )


def trial_points(trials: int, seed: int = 17) -> list[tuple[float, float]]:
    """Penalty pairs (l1, l2) drawn from the search space."""
    draw = random.Random(seed)
    return [(draw.uniform(*L1_RANGE), draw.choice(L2_CANDIDATES)) for _ in range(trials)]


def tune(features: DataFrame, trials: int = 5, points: Sequence[tuple[float, float]] | None = None) -> DataFrame:
    """Try penalty pairs and report the evaluation error of each, best first.

    Training and evaluation rows are summed apart in one pass; all trials are fitted and judged by
    the two sets of products. Categories that only evaluation rows have count as the base.
    """
    chosen = list(points or trial_points(trials))
    sums = statistics(features, split_mark(features))
    fitted, judged = sums.filter(~F.col("_judged")), sums.filter("_judged")
    means = _means(fitted)
    rolled = _rollup(_filled(fitted, means))
    labels = _labels(rolled)
    training, evaluation = _products(rolled, labels), _products(_rollup(_filled(judged, means)), labels)

    def error(l1: float, l2: float) -> float:
        return evaluation.mean_squared_error(solve_penalised(training, l1, l2) if l1 or l2 else solve(training))

    rows = [(i + 1, l1, l2, error(l1, l2)) for i, (l1, l2) in enumerate(chosen)]
    return features.sparkSession.createDataFrame(
        rows, "trial_id int, l1_reg double, l2_reg double, mean_squared_error double"
    ).orderBy("mean_squared_error", "trial_id")


def score_in_batches(trips: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Apply a Python model partition-wise: predicted duration is five times the distance.

    The model sees Arrow batches as pandas frames; its output schema is declared.
    """
    wanted = trips.select(*columns)

    def predicted(batches):
        for batch in batches:
            yield batch.assign(predicted_duration=batch["trip_distance"] * 5)

    schema = wanted.withColumn("predicted_duration", F.lit(0.0)).schema
    return wanted.mapInPandas(predicted, schema)
