"""Schemas of the four inputs: raw (every column a string, as fed) and typed."""

from __future__ import annotations

from pyspark.sql import types as T


def _raw(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# Raw feeds: every column arrives as text, in this order.  Doses: women is the
# sixth column (position 5); the one before it is not used.
SUMMARY_RAW = _raw("date", "region", "total")
CENTERS_RAW = _raw("region")
DOSES_RAW = _raw("date", "supplier", "region", "age", "men", "women")
POPULATION_RAW = _raw("region", "population")

# Landed (typed) tables.
SUMMARY = T.StructType(
    [
        T.StructField("date", T.DateType(), True),
        T.StructField("region", T.StringType(), True),
        T.StructField("total", T.LongType(), True),
    ]
)
CENTERS = T.StructType([T.StructField("region", T.StringType(), True)])
DOSES = T.StructType(
    [
        T.StructField("date", T.DateType(), True),
        T.StructField("supplier", T.StringType(), True),
        T.StructField("region", T.StringType(), True),
        T.StructField("age", T.StringType(), True),
        T.StructField("women", T.LongType(), True),
    ]
)
POPULATION = T.StructType(
    [
        T.StructField("region", T.StringType(), True),
        T.StructField("population", T.LongType(), True),
    ]
)

# Result tables.
MONTHLY_MEAN = T.StructType(
    [
        T.StructField("date", T.DateType(), True),
        T.StructField("region", T.StringType(), True),
        T.StructField("mean_vacc_center", T.DoubleType(), True),
    ]
)
