"""Extract and load: every registered table, each on its own."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from erpspark.sources import cleaning, sinks, state, tables
from erpspark.sources.tables import WATERMARKS, Source

STATE = "etl_watermark"


def load_table(source: Source, table: str, raw_schema: str, now: datetime) -> tuple[int, str]:
    """Load one table with a single read of the source.

    The batch is written as it came; everything after that, the new mark included, is taken from the
    written rows, so rows that reach a live source meanwhile are left to the next load. The mark moves only
    after the raw table is in place.
    """
    spark, column = source.spark, WATERMARKS.get(table)
    state_table, target = f"{raw_schema}.{STATE}", f"{raw_schema}.{table}"
    marks = spark.table(state_table) if sinks.exists(spark, state_table) else state.empty_state(spark)
    old = state.get_mark(marks, table, tables.default_mark(column))
    batch = source.read(table)
    if column:
        batch = tables.incremental_load(batch, column, old)
    came = f"{target}__batch"
    sinks.replace_table(cleaning.rename_reserved(batch), came)
    try:
        batch = spark.table(came)
        rows = batch.count()
        if not rows:
            return 0, "no new data"
        cleaned = cleaning.clean_batch(batch, now)
        if sinks.exists(spark, target):
            # the raw table keeps its columns; new ones are added, the rows are this batch only
            stored = spark.table(target)
            aligned, _ = cleaning.align_to(cleaned, stored.schema)
            cleaned = stored.limit(0).select(
                *[c for c in stored.columns if c not in aligned.columns]
            ).unionByName(aligned, allowMissingColumns=True)
        sinks.replace_table(cleaned, target)
        mark = tables.next_mark(batch, column, old, now.strftime("%Y-%m-%d %H:%M:%S"))
        sinks.replace_table(state.set_mark(marks, table, mark, now), state_table)
        return rows, mark
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {came}")


def run_extract(
    source: Source, raw_schema: str, now: datetime, only: list[str] | None = None
) -> DataFrame:
    """Load all (or the named) tables one after another; a failing table does not stop the rest."""
    spark = source.spark
    results = []
    for table in WATERMARKS:
        if only and table not in only:
            continue
        try:
            rows, note = load_table(source, table, raw_schema, now)
            results.append((table, "skipped" if rows == 0 else "ok", rows, note))
        except Exception as err:  # noqa: BLE001 - isolation per table is the feature
            results.append((table, "failed", 0, str(err).split("\n")[0]))
    return spark.createDataFrame(results, "table_name string, status string, rows bigint, note string")
