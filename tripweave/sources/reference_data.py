"""Small parameter tables: holiday calendar, city gazetteer and postal prefixes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values: (month, holiday window), earlier entries win ------------------------------
HOLIDAYS = [
    ("2026-03-01", "lebaran"),
    ("2026-04-01", "lebaran"),
    ("2025-12-01", "natal"),
    ("2026-12-01", "natal"),
    ("2026-02-01", "imlek"),
    ("2026-06-01", "school"),
    ("2026-07-01", "school"),
    ("2026-12-01", "school"),
]
# -------------------------------------------------------------------------------------------

# Approximate positions, rounded to a tenth of a degree.
CITIES = [
    ("Kuta", -8.7, 115.2, "Bali"),
    ("Ubud", -8.5, 115.3, "Bali"),
    ("Lombok", -8.6, 116.3, "Nusa Tenggara Barat"),
    ("Labuan Bajo", -8.5, 119.9, "Nusa Tenggara Timur"),
    ("Jakarta", -6.2, 106.8, "DKI Jakarta"),
    ("Surabaya", -7.3, 112.8, "Jawa Timur"),
    ("Yogyakarta", -7.8, 110.4, "DI Yogyakarta"),
]

GAZETTEER_SCHEMA = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lng", T.DoubleType()),
        T.StructField("province", T.StringType()),
    ]
)


def _literal(value) -> str:
    return f"'{value}'" if isinstance(value, str) else f"{value}D"


def _constant_table(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"select * from values {body} as t({columns})")


def holiday_calendar(spark: SparkSession) -> DataFrame:
    rows = [(month, window, priority) for priority, (month, window) in enumerate(HOLIDAYS)]
    return _constant_table(spark, rows, "year_month, holiday_window, priority").withColumn(
        "year_month", F.col("year_month").cast("date")
    )


def gazetteer(spark: SparkSession, csv_path: str | None = None) -> DataFrame:
    """City positions from a CSV with header, or the built-in short list."""
    if csv_path:
        return spark.read.schema(GAZETTEER_SCHEMA).option("header", True).csv(csv_path)
    return _constant_table(spark, CITIES, "city, lat, lng, province")
