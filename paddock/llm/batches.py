"""Bounds on what one Python worker holds."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Rows handed to Python at once. Texts may be very long, so few rows are better than many.
ROWS = 256


def small_batches(spark: SparkSession, rows: int = ROWS) -> None:
    """Hand at most ``rows`` rows at once to Python; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))
