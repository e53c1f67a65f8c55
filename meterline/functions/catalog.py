"""The rules of this library as functions of the session, for SQL text."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.functions import arrow_udf

from meterline.functions.decode import OTHER_PAYMENT, PAYMENT_TYPES


def define_functions(spark: SparkSession) -> None:
    """Define ``payment_label``, ``base_code`` and their Arrow twin ``base_code_arrow`` in the session.

    The first two are SQL: their bodies become part of the query's plan. The twin is a Python function
    over Arrow batches, for callers that have rules SQL cannot state.
    """
    labels = " ".join(f"WHEN {code} THEN '{text}'" for code, text in PAYMENT_TYPES.items())
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION payment_label(code STRING) RETURNS STRING
        RETURN CASE CAST(round(try_cast(code AS DOUBLE)) AS INT) {labels} ELSE '{OTHER_PAYMENT}' END""")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION base_code(base STRING) RETURNS STRING
        RETURN CASE WHEN try_cast(substr(base, 2) AS BIGINT) % 7 = 0 THEN 's' WHEN try_cast(substr(base, 2) AS BIGINT) % 3 = 0 THEN 'a' ELSE 'e' END
          || '/' || CASE WHEN length(hex(try_cast(substr(base, 2) AS BIGINT))) < 3 THEN lpad(lower(hex(try_cast(substr(base, 2) AS BIGINT))), 3, '0')
                         ELSE lower(hex(try_cast(substr(base, 2) AS BIGINT))) END""")
    spark.udf.register("base_code_arrow", arrow_udf(base_codes, "string"))


def base_codes(bases: pa.Array) -> pa.Array:
    """``base_code`` over an Arrow array."""

    def code(base: str | None) -> str | None:
        digits = "" if base is None else base[1:].strip()
        if not digits.isascii() or not digits.isdigit():
            return None
        number = int(digits)
        return ("s" if number % 7 == 0 else "a" if number % 3 == 0 else "e") + f"/{number:03x}"

    return pa.array([code(base) for base in bases.to_pylist()], pa.string())


def labels_by_sql(spark: SparkSession, view: str, column: str) -> DataFrame:
    """Payment codes of a view with their labels and counts, as SQL text over the session's functions."""
    return spark.sql(f"SELECT {column}, payment_label({column}) AS description, count(*) AS n FROM {view} GROUP BY ALL")

