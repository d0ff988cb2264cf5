"""Batch cleaning and additive schema evolution."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: column names that get the suffix, and the zero-date prefix
RESERVED = [
    "concurrently", "order", "default", "user", "table", "where", "group", "select", "from", "index", "check",
    "unique", "primary", "end", "begin",
]
ZERO_DATE = "^0000-00-00"


def fix_zero_dates(df: DataFrame) -> DataFrame:
    """Text that starts with 0000-00-00 becomes NULL."""
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[
            F.when(~F.coalesce(F.col(f"`{c}`").rlike(ZERO_DATE), F.lit(False)), F.col(f"`{c}`")).alias(c)
            if c in texts
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def rename_reserved(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}_col" for c in df.columns if c.lower() in RESERVED})


def integral_columns(df: DataFrame) -> list[str]:
    """Float columns whose every value is whole and fits a bigint (and that have a value): one aggregate."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floats:
        return []
    row = df.agg(
        *[F.max(((F.col(f"`{c}`") % 1 != 0) | (F.abs(F.col(f"`{c}`")) >= 2.0**63)).cast("int")).alias(c) for c in floats],
    ).first()
    return [c for c in floats if row[c] == 0]


def whole_floats_to_int(df: DataFrame) -> DataFrame:
    whole = integral_columns(df)
    return df.withColumns({c: F.col(c).cast("bigint") for c in whole})


def add_audit(df: DataFrame, now: datetime) -> DataFrame:
    return df if "etl_loaded_at" in df.columns else df.withColumn("etl_loaded_at", F.lit(now))


def clean_batch(df: DataFrame, now: datetime) -> DataFrame:
    return whole_floats_to_int(rename_reserved(fix_zero_dates(add_audit(df, now))))


def _widened(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """Common type when the stored column can hold the new values, else None."""
    if old == new or isinstance(old, T.StringType):
        return old
    order = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]
    rank = {t: i for i, t in enumerate(order)}
    if type(old) in rank and type(new) in rank:
        return old if rank[type(old)] >= rank[type(new)] else new
    return None


def align_to(batch: DataFrame, stored: T.StructType) -> tuple[DataFrame, dict[str, str]]:
    """Batch in the stored layout plus its own new columns.

    New columns are added; columns whose type the stored one cannot take are
    dropped from the batch (the stored column comes out NULL). The second result
    says what happened to each such column.
    """
    known = {f.name: f.dataType for f in stored}
    notes: dict[str, str] = {}
    cols = []
    for f in batch.schema:
        if f.name not in known:
            notes[f.name] = "added"
            cols.append(F.col(f"`{f.name}`"))
            continue
        target = _widened(known[f.name], f.dataType)
        if target is None:
            notes[f.name] = "skipped"
            continue
        if target != known[f.name]:
            notes[f.name] = "widened"
        cols.append(F.col(f"`{f.name}`").cast(target).alias(f.name))
    return batch.select(*cols), notes


def evolve(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored rows and batch rows under the union of their columns."""
    aligned, _ = align_to(batch, stored.schema)
    target = {f.name: f.dataType for f in aligned.schema}
    widened = stored.withColumns({c: F.col(c).cast(target[c]) for c in stored.columns if c in target})
    return widened.unionByName(aligned, allowMissingColumns=True)
