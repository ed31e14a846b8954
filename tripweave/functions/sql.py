"""The cleansing rules as temporary SQL functions, for people who write SQL instead of Python.

A function's body is the SQL text of the column expression that the models use, so there is one definition of each
rule; calls are inlined and stay inside the engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tripweave.functions import cleanse as C
from tripweave.functions.identity import resolved_id

#: Name, type of the argument and rule of each function.
RULES: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "normalize_email": ("string", C.email),
    "normalize_phone": ("string", C.phone),
    "normalize_amount_idr": ("bigint", C.whole_hundreds),
    "strip_honorifics": ("string", C.person_name),
    "title_case": ("string", C.title_case),
    "normalize_payment": ("string", C.payment_method),
    "normalize_status": ("string", C.booking_status),
    "resolved_customer_id": ("string", resolved_id),
}


def _body(spark: SparkSession, argument: str, rule: Callable[[Column], Column]) -> tuple[str, str]:
    """Result type and SQL text of a rule over a column ``x``."""
    one = spark.range(0).select(F.lit(None).cast(argument).alias("x")).select(rule(F.col("x")).alias("y"))
    expression = one._jdf.queryExecution().analyzed().expressions().head().child()
    return expression.dataType().sql().lower(), expression.sql()


def functions(spark: SparkSession | None = None) -> dict[str, tuple[str, str, str]]:
    """Name to (argument type, result type, body); the argument is called ``x``."""
    spark = spark or SparkSession.active()
    return {name: (argument, *_body(spark, argument, rule)) for name, (argument, rule) in RULES.items()}


def register(spark: SparkSession) -> list[str]:
    for name, (argument, result, body) in functions(spark).items():
        spark.sql(f"create or replace temporary function {name}(x {argument}) returns {result} return {body}")
    return list(RULES)
