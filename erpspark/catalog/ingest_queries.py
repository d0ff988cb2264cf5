"""Extract-and-load queries."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from erpspark.catalog.quality_queries import marks
from erpspark.catalog.registry import Erp, query
from erpspark.catalog.sqltext import r
from erpspark.functions.expr import rounded
from erpspark.operators.upsert import latest_per_key
from erpspark.session import work_dir
from erpspark.sources import cleaning, pipeline, sinks, state, tables
from erpspark.streaming.incremental import stream_to_folder

EVENT = "event_id:l user_id:l event_type:s value:d props:s"
NOW = datetime(2024, 2, 1)

query("ingest_full", EVENT, "SELECT * FROM events")(lambda e: tables.full_load(e.table("events")))
query("ingest_incremental", EVENT, "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'")(
    lambda e: tables.incremental_load(e.table("events"), "ts", "2024-01-16 00:00:00")
)
query(
    "ingest_incremental_nulls",
    EVENT,
    "SELECT * FROM events WHERE coalesce(CASE WHEN event_type <> 'error' THEN ts END, TIMESTAMP '2000-01-01') >= TIMESTAMP '1999-12-31'",
)(
    # rows without a value stand at 2000-01-01, so an older mark keeps them
    lambda e: tables.incremental_load(
        e.table("events").withColumn("ts", F.when(F.col("event_type") != "error", F.col("ts"))), "ts", "1999-12-31"
    )
)
query("ingest_incremental_id", EVENT, "SELECT * FROM events WHERE event_id >= 900")(
    # as text '900' would sort after '1000'
    lambda e: tables.incremental_load(e.table("events"), "event_id", "900")
)


@query(
    "ingest_watermark_state",
    "table_name:s last_loaded_at:s",
    """SELECT * FROM k_marks WHERE table_name <> 'lineitem' UNION ALL SELECT 'lineitem', '1999-01-01'
       UNION ALL SELECT 'documents', '0'""",
)
def _state(e: Erp):
    # stored marks, one table known only from before, then one table set back
    stored = marks(e).withColumn("updated_at", F.lit(NOW))
    older = marks(e).withColumn("last_loaded_at", F.lit("0")).withColumn("updated_at", F.lit(datetime(2024, 1, 1)))
    older = older.unionByName(
        older.filter("table_name = 'events'").withColumn("table_name", F.lit("documents"))
    )
    return state.reset_marks(state.merge_marks(state.as_text_state(older), stored), "lineitem", "1999-01-01")


@query(
    "ingest_clean",
    "event_id:l happened:s user_col:l whole:l share:d etl_loaded_at:t",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN event_type || ' 0000-00-00' END AS happened, user_id AS user_col,
         floor(value) AS whole, value AS share, DATE '2024-02-01' AS etl_loaded_at FROM events""",
)
def _clean(e: Erp):
    zero = F.when(F.col("event_type") == "error", F.lit("0000-00-00 00:00:00"))
    raw = e.table("events").select(
        "event_id",
        F.coalesce(zero, F.concat("event_type", F.lit(" 0000-00-00"))).alias("happened"),
        F.col("user_id").alias("user"),
        F.floor("value").cast("double").alias("whole"),
        F.col("value").alias("share"),
    )
    return cleaning.clean_batch(raw, NOW)


@query(
    "ingest_schema_evolution",
    "event_id:l user_id:l value:d event_type:s props:s",
    """SELECT event_id, user_id, value, event_type, NULL AS props FROM events WHERE ts < TIMESTAMP '2024-01-16'
       UNION ALL SELECT event_id, user_id, value, NULL, props FROM events WHERE ts >= TIMESTAMP '2024-01-16'""",
)
def _evolution(e: Erp):
    # the second half brings a new column, a wider id, and a type the stored column cannot take
    events = e.table("events")
    stored = events.filter("ts < timestamp_ntz '2024-01-16'").select(
        F.col("event_id").cast("int").alias("event_id"), "user_id", F.col("value").cast("double").alias("value"), "event_type"
    )
    batch = events.filter("ts >= timestamp_ntz '2024-01-16'").select("event_id", "user_id", "value", "props")
    return cleaning.evolve(stored, batch)


@query(
    "ingest_partitioned",
    "year:l lots:l quantity:d",
    "SELECT import_date_key // 10000 AS year, count(*) AS lots, sum(quantity) AS quantity FROM r_lots WHERE import_date_key BETWEEN 19970101 AND 19991231 GROUP BY 1",
)
def _partitioned(e: Erp):
    """Lots written by year and read back for a date range; the scan touches three years."""
    path = f"{work_dir(e.spark)}/lots-{uuid.uuid4().hex}"
    sinks.with_year(e.lots.select("stock_id", "import_date_key", "quantity"), "import_date_key").write.partitionBy("year").parquet(path)
    first, last = 19970101, 19991231
    rows = sinks.between(e.spark.read.parquet(path), "import_date_key", first, last)
    return rows.groupBy("year").agg(F.count(F.lit(1)).alias("lots"), F.sum("quantity").alias("quantity"))


CUSTOMER_DDL = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query(
    "ingest_csv",
    "kind:s reason:s n_rows:l files:b chars:l balance:d",
    f"""WITH wrong AS (SELECT 'x' || c_custkey || ',' || c_name || ',' || c_nationkey || ',,' || c_mktsegment AS record FROM customer WHERE c_acctbal < 0),
          short AS (SELECT c_custkey || ',' || c_name AS record FROM customer WHERE c_mktsegment = 'BUILDING')
        SELECT 'good' AS kind, NULL AS reason, count(*) AS n_rows, NULL AS files, NULL AS chars, {r('sum(c_acctbal)', 2)} AS balance FROM customer
        UNION ALL SELECT 'bad', 'value of c_custkey', count(*), true, sum(length(record)), NULL FROM wrong HAVING count(*) > 0
        UNION ALL SELECT 'bad', 'number of fields', count(*), true, sum(length(record)), NULL FROM short HAVING count(*) > 0
        UNION ALL SELECT 'counted good', NULL, count(*), NULL, NULL, NULL FROM customer
        UNION ALL SELECT 'counted bad', NULL, (SELECT count(*) FROM wrong) + (SELECT count(*) FROM short), NULL, NULL, NULL""",
)
def _csv(e: Erp):
    """Customers as CSV lines, with a line of a wrong key for those in debt and a cut-off line for those of one segment."""
    root = f"{work_dir(e.spark)}/csv-{uuid.uuid4().hex}"
    c = e.table("customer")
    names = [x.split()[0] for x in CUSTOMER_DDL.split(", ")]
    line = lambda *fields: F.concat_ws(",", *[F.coalesce(x.cast("string"), F.lit("")) for x in fields]).alias("value")
    key, name, nation, segment = (F.col(x) for x in ("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))
    wrong = c.filter("c_acctbal < 0").select(line(F.concat(F.lit("x"), key), name, nation, F.lit(""), segment))
    short = c.filter(segment == "BUILDING").select(line(key, name))
    c.select(line(*map(F.col, names))).unionByName(wrong).unionByName(short).write.text(f"{root}/files")
    load = tables.load_csv(e.spark, f"{root}/files", CUSTOMER_DDL, f"{root}/table", header=False)
    shape = ["kind", "reason", "n_rows", "files", "chars", "balance"]
    none = lambda kind: F.lit(None).cast(kind)
    rows = F.count(F.lit(1))
    good = load.good.agg(rows.alias("n_rows"), rounded(F.sum("c_acctbal"), 2).alias("balance")).withColumns(
        {"kind": F.lit("good"), "reason": none("string"), "files": none("boolean"), "chars": none("bigint")}
    )
    bad = load.bad.groupBy("reason").agg(
        rows.alias("n_rows"), F.bool_and(F.col("file").isNotNull()).alias("files"), F.sum(F.length("record")).alias("chars")
    ).withColumns({"kind": F.lit("bad"), "balance": none("double")})
    counted = [("counted good", None, load.n_good, None, None, None), ("counted bad", None, load.n_bad, None, None, None)]
    told = e.spark.createDataFrame(counted, "kind string, reason string, n_rows bigint, files boolean, chars bigint, balance double")
    return good.select(*shape).unionByName(bad.select(*shape)).unionByName(told)


LATEST = "user_id:l event_id:l event_type:s value:d"
LATEST_SQL = "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id"


@query("ingest_stream_latest", LATEST, LATEST_SQL)
def _stream(e: Erp):
    """Events streamed in four micro-batches, newest row per user kept; the stream is then started once more."""
    root = f"{work_dir(e.spark)}/stream-{uuid.uuid4().hex}"
    events = e.table("events")
    events.repartition(4, "event_id").write.parquet(f"{root}/files")
    for _ in range(2):
        out = stream_to_folder(
            e.spark, f"{root}/files", events.schema, f"{root}/checkpoint", f"{root}/table", "user_id", ["ts", "event_id"], pattern="*.parquet", max_files=1, buckets=4
        )
    return out


query("ingest_batch_latest", LATEST, LATEST_SQL)(
    lambda e: latest_per_key(e.table("events"), "user_id", ["ts", "event_id"])
)


@query(
    "ingest_pipeline_replay",
    "load:l table_name:s status:s row_count:l mark:s kept:l",
    """WITH o AS (SELECT o_orderkey AS id, o_orderdate + INTERVAL 30 YEAR AS date FROM orders),
         first AS (SELECT max(date) AS m, count(*) AS n FROM o WHERE date < TIMESTAMP '2028-01-01'),
         loads AS (
           SELECT 1 AS load, 'tbl_orders' AS table_name, n AS row_count, strftime(m, '%Y-%m-%d %H:%M:%S') AS mark FROM first
           UNION ALL SELECT 1, 'tbl_delivery_items', count(*), cast(max(l_orderkey) AS varchar) FROM lineitem WHERE l_orderkey < 500
           UNION ALL SELECT l, 'tblclients', count(*), '2024-02-01 00:00:00' FROM customer, (VALUES (1), (2)) v(l) GROUP BY l
           UNION ALL SELECT 2, 'tbl_orders', count(*), strftime(max(date), '%Y-%m-%d %H:%M:%S') FROM o, first WHERE date >= m
           UNION ALL SELECT 2, 'tbl_delivery_items', count(*), cast(max(l_orderkey) AS varchar) FROM lineitem WHERE l_orderkey >= (SELECT max(l_orderkey) FROM lineitem WHERE l_orderkey < 500))
       SELECT load, table_name, 'ok' AS status, row_count, mark, row_count AS kept FROM loads
       UNION ALL SELECT 2, 'tblsuppliers', 'ok', count(*), '2024-02-01 00:00:00', count(*) FROM supplier
       UNION ALL SELECT 1, 'tblsuppliers', 'skipped', 0, 'no new data', 0
       UNION ALL SELECT l, 'tbl_deliveries', 'failed', 0, NULL, 0 FROM (VALUES (1), (2)) v(l)""",
)
def _replay(e: Erp):
    """Two runs of the extract pipeline over folders of source tables; the second starts at the marks of the first.
    Suppliers are empty in the first run, and deliveries cannot be read in either: the other tables load all the same."""
    spark, root = e.spark, f"{work_dir(e.spark)}/extract-{uuid.uuid4().hex}"
    database = f"extract_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/{database}'")
    orders = e.table("orders").select(F.col("o_orderkey").alias("id"), F.expr("o_orderdate + INTERVAL 30 YEARS").alias("date"))
    lines = e.table("lineitem").select(F.col("l_orderkey").alias("id"), "l_quantity")
    names = ["tbl_orders", "tbl_delivery_items", "tblclients", "tblsuppliers"]
    out = None
    for load, (seen, known) in enumerate([(F.col("date") < F.lit("2028-01-01").cast("timestamp_ntz"), F.col("id") < 500), (F.lit(True), F.lit(True))], 1):
        source = f"{root}/source-{load}"
        suppliers = e.table("supplier") if load == 2 else e.table("supplier").limit(0)
        for name, rows in zip(names, (orders.filter(seen), lines.filter(known), e.table("customer"), suppliers), strict=True):
            rows.write.parquet(f"{source}/{name}")
        status = pipeline.run_extract(tables.Source(spark, source), database, NOW, only=[*names, "tbl_deliveries"])
        # the raw tables are replaced by the next load: their rows are counted now
        kept = [(name, spark.table(f"{database}.{name}").count() if sinks.exists(spark, f"{database}.{name}") else 0) for name in [*names, "tbl_deliveries"]]
        raw = spark.createDataFrame(kept, "table_name string, kept bigint")
        part = status.join(raw, "table_name").select(
            F.lit(load).cast("bigint").alias("load"), "table_name", "status", F.col("rows").alias("row_count"), F.when(F.col("status") != "failed", F.col("note")).alias("mark"), "kept"
        )
        out = part if out is None else out.unionByName(part)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return out
