"""Incremental load as a file stream.

The checkpoint takes the place of the mark table. Every micro-batch runs the same
cleaning and keyed write as the batch load, so replays change nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from erpspark.operators.lookup import sized
from erpspark.operators.upsert import latest_per_key, new_rows
from erpspark.sources import cleaning, sinks

Writer = Callable[[DataFrame, int], None]


def insert_writer(table: str, natural: str, order: list[str], now: datetime) -> Writer:
    """Append rows whose key the table does not hold yet. New columns are added to the table; a stored
    column that cannot hold the new values is widened, which rewrites the table."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rows = latest_per_key(cleaning.clean_batch(batch, now), natural, order)
        if sinks.exists(spark, table):
            stored = spark.table(table)
            aligned, notes = cleaning.align_to(new_rows(sized(stored, [natural]), rows, natural), stored.schema)
            if "widened" in notes.values():
                sinks.replace_table(cleaning.evolve(stored, aligned), table)
                return
            added = [f for f in aligned.schema if f.name not in stored.columns]
            if added:
                spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in added)})")
            layout = spark.table(table)
            rows = layout.limit(0).unionByName(aligned, allowMissingColumns=True).select(*layout.columns)
        sinks.append_rows(rows, table)

    return write


def upsert_writer(table: str, natural: str, order: list[str], now: datetime) -> Writer:
    """Keep the newest row per key (by ``order``), whatever order batches arrive in."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rows = cleaning.clean_batch(batch, now)
        if sinks.exists(spark, table):
            rows = cleaning.evolve(spark.table(table), rows)
        sinks.replace_table(latest_per_key(rows, natural, order), table)

    return write


def stream_incremental(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    checkpoint: str,
    write: Writer,
    fmt: str = "parquet",
    max_files: int = 1000,
    target: str | None = None,
) -> int:
    """Process every file that is not yet in the checkpoint, then stop. Returns the batch count.

    Micro-batches run in a session of their own; naming the ``target`` table makes
    this session drop its file listing of it.
    """
    batches = []

    def counted(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        batches.append(batch_id)

    stream = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files).load(source_dir)
    query = (
        stream.writeStream.foreachBatch(counted)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if target and sinks.exists(spark, target):
        spark.catalog.refreshTable(target)
    return len(batches)


def stream_to_folder(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    checkpoint: str,
    target: str,
    natural: str,
    order: list[str],
    fmt: str = "parquet",
    pattern: str = "*",
    max_files: int = 1000,
    buckets: int = 64,
) -> DataFrame:
    """Keep the newest row per key in a folder that is partitioned by a hash of the key.

    A micro-batch merges and rewrites only the buckets that it touches, by way of a staged copy, so a
    replayed batch changes nothing. ``buckets`` must stay the same for a folder; take more for
    larger tables. Returns the table, also when no file is new.
    """
    rows = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    spark.createDataFrame([], rows).write.mode("ignore").partitionBy("bucket").parquet(target)

    def write(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        new = batch.withColumn("bucket", F.pmod(F.xxhash64(natural), F.lit(buckets)).cast("int"))
        touched = [r.bucket for r in new.select("bucket").distinct().collect()]
        old = session.read.schema(rows).parquet(target).where(F.col("bucket").isin(touched))
        staged = f"{target}__next"
        latest_per_key(old.unionByName(new), natural, order).write.mode("overwrite").parquet(staged)
        merged = session.read.schema(rows).parquet(staged)
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(target)

    stream = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", max_files).load(source_dir)
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(rows).parquet(target).drop("bucket")
