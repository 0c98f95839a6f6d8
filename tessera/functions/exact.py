"""What engines round or rewrite differently: half-even rounding of the binary value, and setting a dotted path."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def half_even(value: Column, places: int) -> Column:
    """The double rounded to `places` by its exact binary value, ties to even. Spark's own functions round the shortest decimal that names it."""

    @F.pandas_udf("double")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: v if pd.isna(v) else round(v, places))

    return run(value.cast("double"))


def set_field(record: Column, path: str, value: Column) -> Column:
    """A struct with the field at a dotted path set; the structs on the way must be there."""
    return record.withField(path, value)


def set_json(document: Column, path: str, value: Column) -> Column:
    """JSON text with the value (JSON text) at a dotted path set, objects on the way made; null where the text is no JSON object."""
    *parents, leaf = path.split(".")

    @F.pandas_udf("string")
    def run(documents: pd.Series, values: pd.Series) -> pd.Series:
        def one(text, new):
            try:
                top = node = json.loads(text)
                for key in parents:
                    node = node.setdefault(key, {})
                node[leaf] = json.loads(new)
                return json.dumps(top, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
            except (TypeError, ValueError, AttributeError):
                return None

        return pd.Series([one(t, v) for t, v in zip(documents, values, strict=True)])

    return run(document, value)


#: SQL functions by name: parameters, result and body.
SQL_FUNCTIONS = {
    "seeded_position": ("seed STRING, k STRING", "DOUBLE", "CAST(CAST(conv(substring(sha2(concat_ws(':', seed, k), 256), 1, 12), 16, 10) AS BIGINT) AS DOUBLE) / power(2D, 48)"),
    "closed_draw": ("seed STRING, k STRING", "DOUBLE", "CAST(CAST(conv(substring(sha2(concat_ws(':', seed, k), 256), 1, 8), 16, 10) AS BIGINT) AS DOUBLE) / 4294967295D"),
    "first_sentence": ("t STRING", "STRING", "element_at(split(t, '(?<=[.!?])\\\\s', 2), 1)"),
    "duration_minutes": ("t STRING", "INT", "CASE WHEN t RLIKE '^[0-9]+h$' THEN CAST(left(t, length(t) - 1) AS INT) * 60 WHEN t RLIKE '^[0-9]+m$' THEN CAST(left(t, length(t) - 1) AS INT) END"),
    "file_stem": ("p STRING", "STRING", "substring_index(substring_index(p, '/', -1), '.', 1)"),
}


def register(spark: SparkSession) -> list[str]:
    """Make the library's scalar functions available to SQL for this session. They are expressions, which Catalyst inlines; `half_even` alone runs
    in Python."""
    for name, (given, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({given}) RETURNS {result} RETURN {body}")

    @F.pandas_udf("double")
    def rounded(values: pd.Series, places: pd.Series) -> pd.Series:
        return pd.Series([v if pd.isna(v) else round(v, int(n)) for v, n in zip(values, places, strict=True)])

    spark.udf.register("half_even", rounded)
    return [*SQL_FUNCTIONS, "half_even"]
