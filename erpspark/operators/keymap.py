"""Dimensions stored in buckets of their natural key, beside a map from natural to surrogate keys.

Both tables have the same number of buckets, so a load deals its batch out by the natural key once and joins bucket
to bucket: the stored side is never shuffled. A load evaluates each join once:

1. batch against key map (two narrow columns), written bucketed as ``<table>__batch``; rows without a surrogate are new, and
   stand first in their bucket, so their place there is their position;
2. every bucket gets a range of surrogates above the highest known one, as wide as its new rows; the new pairs are appended to the
   map;
3. dimension against written batch, written as ``<table>__next`` and swapped in.

A load that broke off can be run again: new keys that the map got keep their surrogates, and the dimension is whole at any time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from erpspark.sources import sinks

_ROW = (1 << 33) - 1


@dataclass(frozen=True)
class BucketedDimension:
    """A dimension table with surrogate keys from 1. ``buckets`` must stay the same for the life of the table."""

    spark: SparkSession
    table: str
    natural: str
    surrogate: str
    buckets: int

    @property
    def map_table(self) -> str:
        return f"{self.table}__keys"

    def rows(self) -> DataFrame:
        sinks.exists(self.spark, self.table)  # finishes a swap that broke off
        return self.spark.table(self.table)

    def keys(self) -> DataFrame:
        return self.spark.table(self.map_table)

    def _save(self, df: DataFrame, table: str, mode: str = "errorifexists") -> None:
        df.write.format("parquet").bucketBy(self.buckets, self.natural).sortBy(self.natural).mode(mode).saveAsTable(table)

    def matched(self, batch: DataFrame) -> DataFrame:
        """The batch with the surrogates that the map knows, new keys first in every bucket; only the batch is shuffled."""
        dealt = batch.where(F.col(self.natural).isNotNull())
        if self.spark.catalog.tableExists(self.map_table):
            keys = self.keys()
            dealt = dealt.withColumn(self.natural, F.col(self.natural).cast(keys.schema[self.natural].dataType))
            found = dealt.repartition(self.buckets, self.natural).join(keys, self.natural, "left")
        else:
            found = dealt.repartition(self.buckets, self.natural).withColumn(self.surrogate, F.lit(None).cast("bigint"))
        ordered = found.sortWithinPartitions(F.col(self.surrogate).isNotNull(), self.natural)
        return ordered.withColumn("__place", F.monotonically_increasing_id())

    def numbered(self, matched: DataFrame, top: int) -> DataFrame:
        """Surrogates for the rows without one: ranges per bucket, one after the other."""
        part = F.shiftright("__place", 33)
        counts = matched.where(F.col(self.surrogate).isNull()).groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__new"))
        # one row per bucket
        before = F.coalesce(F.sum("__new").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        ranges = counts.select("__part", before.alias("__before"))
        dealt = matched.withColumn("__part", part).join(F.broadcast(ranges), "__part", "left")
        fresh = F.lit(top) + F.col("__before") + F.col("__place").bitwiseAND(F.lit(_ROW)) + 1
        is_new = F.col(self.surrogate).isNull()
        out = dealt.withColumns({"__is_new": is_new, self.surrogate: F.coalesce(self.surrogate, fresh)})
        return out.drop("__part", "__before", "__place")

    def merged(self, batch: DataFrame) -> DataFrame:
        """The stored rows with the columns of the batch where it has the key, and its new rows. Both sides are bucketed alike."""
        new = [c for c in batch.columns if c not in (self.natural, self.surrogate)]
        named = batch.withColumnsRenamed({c: f"__s_{c}" for c in [*new, self.surrogate]}).withColumn("__hit", F.lit(True))
        stored = self.rows()
        both = stored.join(named, self.natural, "full")
        out = []
        for c in stored.columns:
            if c == self.surrogate:
                out.append(F.coalesce(F.col(c), F.col(f"__s_{c}")).alias(c))
            elif c in new:
                out.append(F.when(F.col("__hit"), F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c))
            else:
                out.append(F.col(c))
        return both.select(*out)

    def load(self, batch: DataFrame) -> None:
        """Overwrite the batch's columns of known keys, add new ones. ``batch`` has one row per natural key; rows without a key are left out."""
        spark, staged = self.spark, f"{self.table}__batch"
        known = spark.catalog.tableExists(self.map_table)
        top = (self.keys().agg(F.max(self.surrogate)).first()[0] or 0) if known else 0
        for name in (f"{staged}_in", staged):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.matched(batch).write.format("parquet").saveAsTable(f"{staged}_in")
        self._save(self.numbered(spark.table(f"{staged}_in"), top).repartition(self.buckets, self.natural), staged)
        rows = spark.table(staged)
        self._save(rows.where("__is_new").select(self.natural, self.surrogate), self.map_table, "append")
        rows = rows.drop("__is_new")
        columns = [self.surrogate, *[c for c in rows.columns if c != self.surrogate]]
        if not sinks.exists(spark, self.table):
            self._save(rows.select(*columns), self.table)
        else:
            following = f"{self.table}__next"
            spark.sql(f"DROP TABLE IF EXISTS {following}")
            self._save(self.merged(rows), following)
            spark.sql(f"DROP TABLE IF EXISTS {self.table}")
            spark.sql(f"ALTER TABLE {following} RENAME TO {self.table}")
        for name in (f"{staged}_in", staged):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
