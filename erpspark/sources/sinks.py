"""Writing tables through the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

#: column that holds the path of a row's file
FILE = "__file"
#: up to this many keys are pushed into the scan as values instead of being joined
POINT_KEYS = 200


def with_year(df: DataFrame, date_key: str) -> DataFrame:
    """Partition column of the fact tables; rows without a date go to year 0."""
    return df.withColumn("year", F.coalesce(F.floor(F.col(date_key) / 10000).cast("int"), F.lit(0)))


def read_between(spark: SparkSession, table: str, date_key: str, first: int, last: int) -> DataFrame:
    """Rows of a date-key range. The key alone prunes nothing, so the year range goes with it."""
    return between(spark.table(table), date_key, first, last)


def between(rows: DataFrame, date_key: str, first: int, last: int) -> DataFrame:
    """The same for rows that are partitioned by ``year``."""
    return rows.filter(F.col(date_key).between(first, last) & F.col("year").between(first // 10000, last // 10000))


def exists(spark: SparkSession, table: str) -> bool:
    """Whether the table is there; a swap that broke off between its two steps is finished first."""
    finish_file_swap(spark, table)
    if spark.catalog.tableExists(table):
        return True
    staged = f"{table}__next"
    if not spark.catalog.tableExists(staged):
        return False
    # a staged table is in the catalog only once it is written whole, and the old one is dropped only after that
    spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    return True


def replace_table(df: DataFrame, table: str) -> None:
    """Write the whole (unpartitioned) table next to the old one, then swap the names,
    so that the frame may read the table it replaces. At any moment one whole copy is in the catalog."""
    spark = df.sparkSession
    staged = f"{table}__next"
    exists(spark, table)  # a staged copy that is the only one becomes the table
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    df.write.format("parquet").saveAsTable(staged)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")


def append_rows(df: DataFrame, table: str, partition_by: str | None = None, key: str | None = None) -> None:
    """Append, creating the table on the first load. Files get a Bloom filter on ``key``."""
    writer = _filtered(df.write.format("parquet").mode("append"), key)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(table)


def replace_partitions(
    df: DataFrame, table: str, partition: str = "year", emptied: set[int] | None = None
) -> None:
    """Overwrite only the partitions present in the frame (which may read the table).

    Partitions listed in ``emptied`` that the frame has no rows for are dropped.
    """
    spark = df.sparkSession
    staged = f"{table}__part"
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    df.write.format("parquet").partitionBy(partition).saveAsTable(staged)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        spark.table(staged).select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    if emptied:
        written = {r[0] for r in spark.table(staged).select(partition).distinct().collect()}
        for value in sorted(emptied - written):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition} = {value})")
    spark.sql(f"DROP TABLE IF EXISTS {staged}")


# --- rewriting single files ---------------------------------------------------


def _filtered(writer: DataFrameWriter, key: str | None) -> DataFrameWriter:
    return writer.option(f"parquet.bloom.filter.enabled#{key}", "true") if key else writer


def with_file(stored: DataFrame) -> DataFrame:
    """The rows of a table with the path of the file that holds them."""
    return stored.withColumn(FILE, F.col("_metadata.file_path"))


def in_files(stored: DataFrame, files: list[str]) -> DataFrame:
    """The rows of some files; the others are dropped from the listing and not opened."""
    return stored.filter(F.col("_metadata.file_path").isin(files))


def files_holding(stored: DataFrame, keys: DataFrame, natural: str) -> list[str]:
    """Files that hold a row with one of the keys. NULL is no key.

    Few keys reach the scan as values, so that row groups are passed over by their Bloom filters;
    more are joined, and only the key column is read.
    """
    known = keys.select(natural).filter(F.col(natural).isNotNull())
    few = [r[0] for r in known.distinct().limit(POINT_KEYS + 1).collect()]
    if not few:
        return []
    rows = with_file(stored.select(natural, "_metadata"))
    if len(few) <= POINT_KEYS:
        hit = rows.filter(F.col(natural).isin(few))
    else:
        hit = rows.join(known, natural, "left_semi")
    return [r[0] for r in hit.select(FILE).distinct().collect()]


def replace_files(df: DataFrame, table: str, files: list[str], key: str | None = None, partition: str = "year") -> None:
    """Put the frame (which may read the table) in the place of some of the table's files; all others stay as they are.

    The new files are written aside and the old ones listed in a table; from then on the swap is decided, and
    one that breaks off is finished by the next call. Rows may be seen twice while it runs.
    """
    spark = df.sparkSession
    finish_file_swap(spark, table)
    staged = f"{table}__part"
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    _filtered(df.select(*spark.table(table).columns).write.format("parquet"), key).partitionBy(partition).saveAsTable(staged)
    spark.createDataFrame([(f,) for f in files], "file string").coalesce(1).write.format("parquet").saveAsTable(f"{table}__swap")
    finish_file_swap(spark, table)


def finish_file_swap(spark: SparkSession, table: str) -> None:
    """Carry out a decided swap: every step may be done again."""
    staged, swap = f"{table}__part", f"{table}__swap"
    if not spark.catalog.tableExists(swap):
        return
    if spark.catalog.tableExists(staged):  # otherwise only the drops below are left
        for row in spark.sql(f"SHOW PARTITIONS {staged}").collect():
            name, value = row[0].split("=", 1)
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({name} = {value})")
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        root = next(r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r["col_name"] == "Location")

        def path(encoded: str):
            return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(encoded))

        spark.catalog.refreshTable(staged)
        for file in spark.table(staged).inputFiles():
            source = path(file)
            folder = jvm.org.apache.hadoop.fs.Path(root, source.getParent().getName())
            system = folder.getFileSystem(conf)
            system.mkdirs(folder)
            target = jvm.org.apache.hadoop.fs.Path(folder, source.getName())
            if not system.rename(source, target):
                raise OSError(f"{source} could not be moved to {target}")
        for row in spark.table(swap).collect():
            old = path(row["file"])
            old.getFileSystem(conf).delete(old, False)
    spark.catalog.refreshTable(table)
    spark.sql(f"DROP TABLE IF EXISTS {swap}")
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
