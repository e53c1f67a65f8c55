"""The tip model: features, training, scoring, explanation and tuning."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.operators import regression
from meterline.registry import checks
from meterline.registry.book import query
from meterline.sources import roles
from meterline.workspace import materialize


def _features(spark, sf_dir):
    raw = roles.yellow_trips(spark, sf_dir).withColumnsRenamed(
        {"pulocationid": "PULocationID", "dolocationid": "DOLocationID"}
    )
    return regression.feature_table(raw)


def _stored_features(spark, sf_dir):
    """Training reads the features many times, so they are stored once."""
    return materialize(_features(spark, sf_dir), "features")


_FEATURES = f"""{checks.TRIPS}, features AS (SELECT passenger_count, trip_distance,
    CAST(pulocationid AS VARCHAR) AS "PULocationID", CAST(dolocationid AS VARCHAR) AS "DOLocationID", payment_type,
    CAST(fare_amount AS DOUBLE) AS fare_amount, CAST(tolls_amount AS DOUBLE) AS tolls_amount,
    CAST(tip_amount AS DOUBLE) AS tip_amount FROM trips WHERE service = 'Yellow' AND fare_amount <> 0)"""


@query("ml_feature_table", f"WITH {_FEATURES} SELECT * FROM features")
def ml_feature_table(spark, sf_dir):
    return _features(spark, sf_dir)


def _info(name: str) -> str:
    if name in regression.CATEGORIES:
        return f"""SELECT '{name}' AS input, NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS mean,
            NULL::DOUBLE AS stddev, count(DISTINCT "{name}") AS category_count,
            count_if("{name}" IS NULL) AS null_count FROM features"""
    return f"""SELECT '{name}' AS input, CAST(min({name}) AS DOUBLE) AS min, CAST(max({name}) AS DOUBLE) AS max,
        round(avg({name}), 4) AS mean, round(stddev({name}), 4) AS stddev, NULL::BIGINT AS category_count,
        count_if({name} IS NULL) AS null_count FROM features"""


_COLUMNS = [*regression.NUMBERS, regression.LABEL, *regression.CATEGORIES]


@query("feature_info", f"WITH {_FEATURES} " + " UNION ALL ".join(_info(name) for name in _COLUMNS))
def feature_info(spark, sf_dir):
    info = regression.feature_info(_features(spark, sf_dir))
    return info.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


# The fit in SQL: the design as entries of rows, its products as a matrix, Gauss-Jordan by recursion.
def _design(rows: str) -> str:
    """Labels, numbered columns and the entries of every row of ``known``; means and labels come from ``rows``."""
    numbers, categories = list(enumerate(regression.NUMBERS, 2)), list(enumerate(regression.CATEGORIES, 1))
    counted = " UNION ALL ".join(
        f"""SELECT {c} AS c, '{name}' AS input, "{name}" AS label, count(*) AS times FROM {rows} WHERE "{name}" IS NOT NULL GROUP BY 3"""
        for c, name in categories)
    means = ", ".join(f"coalesce(avg({name}), 0)::DOUBLE AS m{k}" for k, name in numbers)
    entries = " UNION ALL ".join(
        ["SELECT r, 1 AS k, 1::DOUBLE AS v FROM known"]
        + [f"SELECT r, {k}, coalesce({name}::DOUBLE, m{k}) FROM known, means" for k, name in numbers]
        + [f"""SELECT r, k, 1::DOUBLE FROM known JOIN placed ON c = {c} AND label = "{name}" """ for c, name in categories])
    return f"""labels AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY times DESC, label) AS place FROM ({counted})
), placed AS (SELECT c, input, label, 5 + row_number() OVER (ORDER BY c, place) AS k FROM labels WHERE place > 1
), size AS (SELECT 5 + count(*) AS p FROM placed), means AS (SELECT {means} FROM {rows}), entries AS ({entries})"""


def _matrix(rows: str) -> str:
    return f"""products AS (
  SELECT a.k AS i, b.k AS j, sum(a.v * b.v) AS v FROM entries a JOIN entries b USING (r) SEMI JOIN {rows} USING (r) GROUP BY 1, 2
  UNION ALL SELECT k, p + 1, sum(v * tip_amount) FROM entries JOIN {rows} USING (r), size GROUP BY ALL
), matrix AS (
  SELECT list(line ORDER BY i) AS m FROM (SELECT i, list(coalesce(v, 0) ORDER BY j) AS line
    FROM (SELECT i, unnest(range(1, p + 2)) AS j FROM (SELECT unnest(range(1, p + 1)) AS i, p FROM size)) LEFT JOIN products USING (i, j) GROUP BY i)
)"""


_FIT = f"""WITH RECURSIVE {_FEATURES}, known AS (SELECT *, row_number() OVER () AS r FROM features WHERE tip_amount IS NOT NULL
), {_design("known")}, {_matrix("known")}, elimination(k, m, least, used) AS (
  SELECT 1::BIGINT, m, list_transform(m, lambda line, i: {regression.DEPENDENT} * line[i]), []::BOOLEAN[] FROM matrix
  UNION ALL
  SELECT k + 1, CASE WHEN m[k][k] > least[k] THEN list_transform(m, lambda line, i: CASE WHEN i = k THEN list_transform(line, lambda x: x / m[k][k])
    ELSE list_transform(line, lambda x, j: x - line[k] * (m[k][j] / m[k][k])) END) ELSE m END, least, list_append(used, m[k][k] > least[k])
  FROM elimination, size WHERE k <= p
), weights AS (
  SELECT k, CASE WHEN used[k] THEN m[k][p + 1] ELSE 0 END AS w FROM (SELECT m, used, p, unnest(range(1, p + 1)) AS k FROM elimination, size WHERE k = p + 1)
), predicted AS (SELECT r, sum(v * w) AS predicted_tip_amount FROM entries JOIN weights USING (k) GROUP BY r
), scored AS (SELECT * FROM known JOIN predicted USING (r))"""

_NAMED = " UNION ALL ".join(
    f"SELECT '{name}' AS processed_input, NULL::VARCHAR AS category, {k} AS k" for k, name in enumerate(["__INTERCEPT__", *regression.NUMBERS], 1))


def _trained(spark, sf_dir):
    features = _stored_features(spark, sf_dir)
    return regression.train(features), features


@query(
    "ml_train_coeffs",
    f"""{_FIT} SELECT processed_input, category, round(coalesce(w, 0), 4) + 0 AS weight FROM (
          {_NAMED} UNION ALL SELECT labels.input, labels.label, k FROM labels LEFT JOIN placed USING (c, label)) LEFT JOIN weights USING (k)""",
)
def ml_train_coeffs(spark, sf_dir):
    """The weights, solved from the normal equations."""
    weights = regression.coefficients(spark, regression.train(_features(spark, sf_dir)))
    return weights.withColumn("weight", F.round("weight", 4) + F.lit(0.0))


_ERRORS = """avg(abs(tip_amount - predicted_tip_amount)) AS mean_absolute_error, avg(pow(tip_amount - predicted_tip_amount, 2)) AS mean_squared_error,
    avg(pow(ln(1 + greatest(tip_amount, 0)) - ln(1 + greatest(predicted_tip_amount, 0)), 2)) AS mean_squared_log_error,
    quantile_cont(abs(tip_amount - predicted_tip_amount), 0.5) AS median_absolute_error,
    1 - avg(pow(tip_amount - predicted_tip_amount, 2)) / var_pop(tip_amount) AS r2_score,
    1 - var_pop(tip_amount - predicted_tip_amount) / var_pop(tip_amount) AS explained_variance"""
_MEASURES = [
    "mean_absolute_error", "mean_squared_error", "mean_squared_log_error", "median_absolute_error", "r2_score", "explained_variance"]


@query("ml_evaluate", f"{_FIT}, measures AS (SELECT {_ERRORS} FROM scored) SELECT {', '.join(f'round({m}, 4) AS {m}' for m in _MEASURES)} FROM measures")
def ml_evaluate(spark, sf_dir):
    """Error measures of the model on the rows it was fitted on."""
    model, features = _trained(spark, sf_dir)
    measures = regression.evaluate(regression.predict(model, features))
    return measures.select([F.round(name, 4).alias(name) for name in _MEASURES])


@query("ml_predict", f"{_FIT} SELECT * EXCLUDE (r, predicted_tip_amount), round(predicted_tip_amount, 2) AS predicted_tip_amount FROM scored")
def ml_predict(spark, sf_dir):
    """Every row with its prediction."""
    model, features = _trained(spark, sf_dir)
    return regression.predict(model, features).withColumn(regression.PREDICTION, F.round(regression.PREDICTION, 2))


_SHARES = " UNION ALL ".join(
    [f"SELECT r, '{name}' AS feature, sum(CASE WHEN k = {k} THEN v * w ELSE 0 END) AS share FROM entries JOIN weights USING (k) GROUP BY r"
     for k, name in enumerate(regression.NUMBERS, 2)]
    + [f"""SELECT r, '{name}', coalesce(w, 0) FROM known LEFT JOIN (FROM placed JOIN weights USING (k)) ON c = {c} AND label = "{name}" """
       for c, name in enumerate(regression.CATEGORIES, 1)])


@query(
    "ml_explain",
    f"""{_FIT}, shares AS ({_SHARES}), moved AS (SELECT r, feature, share - avg(share) OVER (PARTITION BY feature) AS attribution FROM shares
        ), ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY abs(attribution) DESC, feature DESC) AS place FROM moved)
        SELECT scored.* EXCLUDE (r, predicted_tip_amount), round(predicted_tip_amount, 2) AS predicted_tip_amount,
          place::INTEGER AS place, feature, round(attribution, 2) + 0 AS attribution FROM scored JOIN ranked USING (r) WHERE place <= 3""",
)
def ml_explain(spark, sf_dir):
    """Every row's prediction with its three largest attributions, one row each."""
    explained = regression.explain(*_trained(spark, sf_dir))
    parts = explained.select(
        *[name for name in explained.columns if name not in (regression.PREDICTION, "top_feature_attributions")],
        F.round(regression.PREDICTION, 2).alias(regression.PREDICTION), F.posexplode("top_feature_attributions").alias("place", "part"))
    return parts.withColumns({
        "place": F.col("place") + 1, "feature": F.col("part.feature"), "attribution": F.round("part.attribution", 2) + F.lit(0.0)}).drop("part")


_POINTS = ", ".join(f"({k}, {l1!r}::DOUBLE, {l2!r}::DOUBLE)" for k, (l1, l2) in enumerate(regression.trial_points(5), 1))
# Rounds of coordinate descent in the check SQL; the library stops when nothing moves.
_ROUNDS = 40
_MARK = f"""('0x' || substr(md5(concat_ws('|', {', '.join(f'"{n}"' for n in (
    "passenger_count", "trip_distance", *regression.CATEGORIES, "fare_amount", "tolls_amount", "tip_amount"))})), 1, 4))::INTEGER % 10 < 2"""


@query(
    "ml_tune",
    f"""WITH RECURSIVE {_FEATURES}, known AS (SELECT *, row_number() OVER () AS r, {_MARK} AS judged FROM features WHERE tip_amount IS NOT NULL
        ), fitted AS (SELECT * FROM known WHERE NOT judged), {_design("fitted")}, {_matrix("fitted")}, spread AS (
          SELECT m, p, m[1][1] AS n, list_transform(m, lambda line, i: m[1][i] / m[1][1]) AS mean, list_transform(m, lambda line, i:
            CASE WHEN i = 1 OR line[i] * {regression.DEPENDENT} >= line[i] - m[1][i] * m[1][i] / m[1][1] THEN 0::DOUBLE
            ELSE sqrt(line[i] / m[1][1] - pow(m[1][i] / m[1][1], 2)) END) AS s FROM matrix, size
        ), standard AS (
          SELECT p, n, mean, s, m[1][p + 1] / n AS mean_y,
            list_transform(m, lambda line, i: list_transform(line[1:p], lambda x, j: CASE WHEN s[i] * s[j] > 0 THEN (x / n - mean[i] * mean[j]) / (s[i] * s[j]) ELSE 0 END)) AS g,
            list_transform(m, lambda line, i: CASE WHEN s[i] > 0 THEN (line[p + 1] / n - mean[i] * m[1][p + 1] / n) / s[i] ELSE 0 END) AS c FROM spread
        ), points(trial_id, l1_reg, l2_reg) AS (VALUES {_POINTS}), descent(trial_id, l1, l2, step, w) AS (
          SELECT trial_id, l1_reg, l2_reg, 0::BIGINT, list_transform(s, lambda x: 0::DOUBLE) FROM points, standard
          UNION ALL
          SELECT trial_id, l1, l2, step + 1, list_transform(w, lambda x, i: CASE WHEN i = k AND s[k] > 0 THEN sign(rest) * greatest(abs(rest) - l1, 0) / (g[k][k] + l2) ELSE x END)
          FROM (SELECT *, c[k] - list_dot_product(g[k], w) + g[k][k] * w[k] AS rest
                FROM (SELECT descent.*, standard.*, step % p + 1 AS k FROM descent, standard WHERE step < {_ROUNDS} * p))
        ), found AS (
          SELECT trial_id, l1, l2, unnest(range(1, p + 1)) AS k, unnest(list_transform(w, lambda x, i: CASE WHEN s[i] > 0 THEN x / s[i] ELSE 0 END)) AS w,
            mean_y - list_dot_product(mean, list_transform(w, lambda x, i: CASE WHEN s[i] > 0 THEN x / s[i] ELSE 0 END)) AS intercept
          FROM descent, standard WHERE step = {_ROUNDS} * p
        ), guessed AS (
          SELECT trial_id, l1, l2, r, sum(v * CASE WHEN k = 1 THEN intercept ELSE w END) AS guess FROM found JOIN entries USING (k) GROUP BY ALL
        )
        SELECT trial_id::INTEGER AS trial_id, l1 AS l1_reg, l2 AS l2_reg, round(avg(pow(tip_amount - guess, 2)), 2) AS mean_squared_error
        FROM guessed JOIN known USING (r) WHERE judged GROUP BY ALL""",
)
def ml_tune(spark, sf_dir):
    """Five penalty pairs with their errors on the evaluation rows."""
    return regression.tune(_features(spark, sf_dir)).withColumn("mean_squared_error", F.round("mean_squared_error", 2))


@query(
    "predict_rows",
    f"""WITH {checks.TRIPS} SELECT vendorid, pickup_datetime AS lpep_pickup_datetime, pulocationid, dolocationid,
        trip_distance, trip_distance * 5 AS predicted_duration FROM trips WHERE service = 'Green'""",
)
def predict_rows(spark, sf_dir):
    columns = ["vendorid", "lpep_pickup_datetime", "pulocationid", "dolocationid", "trip_distance"]
    # Vendors may be NULL, which pandas integers cannot hold: they travel as doubles.
    green = roles.green_trips(spark, sf_dir).withColumn("vendorid", F.col("vendorid").cast("double"))
    scored = regression.score_in_batches(green, columns)
    return scored.withColumn("vendorid", F.col("vendorid").cast("int"))
