"""High-water-mark state: a small table (table_name, last_loaded_at, updated_at)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from erpspark.operators.upsert import latest_per_key

SCHEMA = "table_name string, last_loaded_at string, updated_at timestamp"


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def as_text_state(state: DataFrame) -> DataFrame:
    """Older state kept marks as timestamps; text holds dates and ids alike."""
    return state.withColumn("last_loaded_at", F.col("last_loaded_at").cast("string"))


def get_mark(state: DataFrame, table: str, default: str) -> str:
    row = state.filter(F.col("table_name") == table).select("last_loaded_at").first()
    return row[0] if row and row[0] is not None else default


def set_mark(state: DataFrame, table: str, mark: str, now: datetime) -> DataFrame:
    """State with the mark of one table replaced or added."""
    new = state.sparkSession.createDataFrame([(table, mark, now)], SCHEMA)
    return state.filter(F.col("table_name") != table).unionByName(new)


def reset_marks(state: DataFrame, table: str | None = None, to: str | None = None) -> DataFrame:
    """Move one table's mark (or all) back to a point, or forget it so that the default applies."""
    chosen = F.lit(True) if table is None else F.col("table_name") == table
    if to is None:
        return state.filter(~chosen)
    return state.withColumn("last_loaded_at", F.when(chosen, F.lit(to)).otherwise(F.col("last_loaded_at")))


def merge_marks(state: DataFrame, marks: DataFrame) -> DataFrame:
    """Upsert many marks at once; a later ``updated_at`` wins."""
    return latest_per_key(state.unionByName(marks), "table_name", ["updated_at", "last_loaded_at"])
