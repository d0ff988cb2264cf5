"""Left lookups that stay balanced when many rows carry a NULL or a hot key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sized(side: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A stored side of a join that is sent out only if its rows, decoded, fit the session threshold.

    Spark takes the size of some columns as their share of the table's. Where the other columns are mostly NULL that is far
    too little, and millions of keys would be collected on the driver. Here the rows are counted (Parquet has their number
    in its footers); a side above the threshold gets a hint for a merge join. ``columns`` are those that the join reads.
    """
    limit = side.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    # 8 bytes a row beside the columns, texts as Spark's default
    width = 8 + side.select(*(columns or side.columns))._jdf.schema().defaultSize()
    return side.hint("merge") if side.count() * width > limit else side


def sent_out(dim: DataFrame) -> bool:
    """Whether Spark's own size check would broadcast the dimension."""
    limit = dim.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= limit


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Left join ``dim`` (unique on its key) onto ``df``.

    No broadcast hint: Spark broadcasts the dimension when its measured size is
    under the session threshold and otherwise shuffles. In a shuffle, rows with a hot
    key or without a key lie in partitions that adaptive execution splits for this
    join, as only the left side repeats them; the dimension's part is then read by each split.
    """
    right = dim.withColumnRenamed(dim_key or key, "__dim_key")
    return df.join(right, df[key] == right["__dim_key"], "left").drop("__dim_key")


def resolve_key(
    df: DataFrame,
    dim: DataFrame,
    source_id: str,
    natural: str,
    surrogate: str,
    target: str,
    only_when: Column | None = None,
) -> DataFrame:
    """Add ``target`` = surrogate key of the dimension row whose natural key matches.

    ``only_when`` limits the lookup to rows of one item type, for id columns that
    are shared by two dimensions. Unresolved ids give NULL.
    """
    probe = F.col(source_id) if only_when is None else F.when(only_when, F.col(source_id))
    keys = dim.select(F.col(natural).alias("__nat"), F.col(surrogate).alias(target))
    return lookup(df.withColumn("__probe", probe), keys, "__probe", "__nat").drop("__probe")


def resolve_either(df: DataFrame, source_id: str, sides: list[tuple[DataFrame, str, str, str, Column]]) -> DataFrame:
    """``resolve_key`` for an id column that several dimensions share, so that the rows travel to their keys only once.

    ``sides`` are (dimension, natural, surrogate, target, only_when); no row may meet the conditions of two sides.
    """
    which = F.lit(None).cast("int")
    for i, (*_, only_when) in reversed(list(enumerate(sides))):
        which = F.when(only_when, F.lit(i)).otherwise(which)
    keys = [
        dim.select(F.lit(i).alias("__side"), F.col(natural).alias("__nat"), F.col(surrogate).alias("__key"))
        for i, (dim, natural, surrogate, _, _) in enumerate(sides)
    ]
    probes = df.withColumn("__which", which).withColumn("__probe", F.when(F.col("__which").isNotNull(), F.col(source_id)))
    on = (F.col("__which") == F.col("__side")) & (F.col("__probe") == F.col("__nat"))
    joined = probes.join(reduce(DataFrame.unionByName, keys), on, "left")
    targets = {
        target: F.when(F.col("__which") == i, F.col("__key").cast(dim.schema[surrogate].dataType))
        for i, (dim, _, surrogate, target, _) in enumerate(sides)
    }
    return joined.withColumns(targets).drop("__which", "__probe", "__side", "__nat", "__key")


def decorate(df: DataFrame, dim: DataFrame, key: str, columns: dict[str, str] | list[str]) -> DataFrame:
    """Attach dimension attributes (``{source: target}`` or names) by surrogate key."""
    names = columns if isinstance(columns, dict) else {c: c for c in columns}
    return lookup(df, dim.select(key, *[F.col(s).alias(t) for s, t in names.items()]), key)


def with_dates(df: DataFrame, dates: DataFrame, key: str, columns: dict[str, str] | list[str]) -> DataFrame:
    """Attach calendar attributes. The calendar has one row per day of a fixed
    range (about 4 000 rows), so broadcasting it is bounded by construction."""
    names = columns if isinstance(columns, dict) else {c: c for c in columns}
    cal = dates.select(F.col("date_key").alias("__dk"), *[F.col(s).alias(t) for s, t in names.items()])
    return df.join(F.broadcast(cal), F.col(key) == F.col("__dk"), "left").drop("__dk")
