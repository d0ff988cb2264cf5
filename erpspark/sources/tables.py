"""Raw-table registry and readers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from erpspark.settings import DEFAULT_ID_MARK, DEFAULT_MARK, NULL_MARK_STANDIN

# fixed values: watermark column per source table, None = full load every time
WATERMARKS: dict[str, str | None] = {
    "tbl_orders": "date",
    "tbl_order_items": None,
    "tbl_deliveries": "date",
    "tbl_delivery_items": "id",
    "tblclients": None,
    "tbl_products": None,
    "tblwarehouse": None,
    "tbllocaltion_warehouses": "date_create",
    "tblwarehouse_product": "date_warehouse",
    "tblwarehouse_export": "date_warehouse",
    "tbltransfer_warehouse_detail": "id",
    "tblsuppliers": None,
    "tblpurchase_order": None,
    "tblpurchase_order_items": None,
    "tbl_purchase_products": "date",
    "tbl_purchase_product_items": "id",
    "tbl_productions_orders": None,
    "tbl_productions_orders_items": None,
    "tbl_productions_orders_items_stages": "date_active",
    "tbl_productions_plan": None,
    "tbl_productions_plan_items": None,
    "tbl_productions_plan_bom": None,
    "tbl_manufactures": "date",
    "tblstaff": None,
    "tbldepartments": None,
    "tblcustomers_groups": None,
    "tblcustomer_groups": None,
    "tblcurrencies": None,
    "tbl_materials": None,
}


@dataclass(frozen=True)
class Source:
    """Where raw tables come from: a folder of files or a JDBC database."""

    spark: SparkSession
    location: str
    fmt: str = "parquet"
    options: dict | None = None
    # per table: numeric key, its lowest and highest value, and the number of tasks that read it
    parts: dict[str, tuple[str, int, int, int]] | None = None

    def jdbc_options(self, table: str) -> dict[str, str]:
        """Reader options of a database table, with key ranges where the registry names them."""
        out = {"url": self.location, "dbtable": table, "fetchsize": "50000"} | (self.options or {})
        if self.parts and table in self.parts:
            key, lower, upper, parts = self.parts[table]
            out |= {"partitionColumn": key, "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(parts)}
        return out

    def read(self, table: str) -> DataFrame:
        """Whole table; Spark prunes columns and pushes filters into the scan."""
        if self.fmt == "jdbc":
            return self.spark.read.format("jdbc").options(**self.jdbc_options(table)).load()
        return self.spark.read.format(self.fmt).options(**(self.options or {})).load(f"{self.location.rstrip('/')}/{table}")


def read_jdbc(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, parts: int, **options: str
) -> DataFrame:
    """Database table read by ``parts`` tasks over ranges of a numeric key, 50 000 rows per fetch."""
    return spark.read.jdbc(
        url, table, column=key, lowerBound=lower, upperBound=upper, numPartitions=parts,
        properties={"fetchsize": "50000", **options},
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header row; empty fields are NULL."""
    return (
        spark.read.option("header", True).option("emptyValue", None).option("nullValue", "")
        .option("encoding", "UTF-8").schema(schema).csv(path)
    )


@dataclass(frozen=True)
class CsvLoad:
    """Rows of a CSV load that fit the schema, lines that do not (`record`, `file`, `reason`), and how many of each."""

    good: DataFrame
    bad: DataFrame
    n_good: int
    n_bad: int


def _csv_reason(record: Column, schema: T.StructType) -> Column:
    """Why a line does not fit: its number of fields, or the first value that its column's type cannot take."""
    fields = ", ".join(f"`{f.name}` string" for f in schema)
    texts = F.from_csv(record, f"{fields}, `__bad` string", {"columnNameOfCorruptRecord": "__bad", "nullValue": ""})
    unfit = [F.when(texts[f.name].isNotNull() & texts[f.name].try_cast(f.dataType).isNull(), F.lit(f"value of {f.name}")) for f in schema]
    return F.when(texts["__bad"].isNotNull(), "number of fields").otherwise(F.coalesce(*unfit, F.lit("value")))


def load_csv(spark: SparkSession, path: str, schema: T.StructType | str, target: str, header: bool = True) -> CsvLoad:
    """Read CSV files once, lines that do not fit the schema kept aside with their file and the reason.

    Good rows and bad lines are written to two partitions of the folder ``target`` and counted while they are
    written. Empty fields are NULL; blank lines are no rows. A file without rows gives nothing on either side.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    record, file = "__record", "__file"
    read = (
        spark.read.option("header", header).option("emptyValue", None).option("nullValue", "").option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", record)
        .schema(T.StructType([*schema.fields, T.StructField(record, T.StringType())])).csv(path)
    )
    is_bad = F.col(record).isNotNull()
    counts = Observation()
    (
        read.select(*(F.col(f"`{f.name}`") for f in schema), record, F.when(is_bad, F.col("_metadata.file_name")).alias(file), is_bad.alias("__is_bad"))
        .observe(counts, F.count_if(~F.col("__is_bad")).alias("good"), F.count_if("__is_bad").alias("bad"))
        .write.partitionBy("__is_bad").parquet(target)
    )
    stored = spark.read.schema(
        T.StructType([*schema.fields, *(T.StructField(c, T.StringType()) for c in (record, file)), T.StructField("__is_bad", T.BooleanType())])
    ).parquet(target)
    bad = stored.filter("__is_bad").select(F.col(record).alias("record"), F.col(file).alias("file"), _csv_reason(F.col(record), schema).alias("reason"))
    good = stored.filter("not __is_bad").select(*(F.col(f"`{f.name}`") for f in schema))
    return CsvLoad(good, bad, counts.get["good"], counts.get["bad"])


def default_mark(column: str | None) -> str:
    return DEFAULT_ID_MARK if column == "id" else DEFAULT_MARK


def full_load(df: DataFrame) -> DataFrame:
    return df


def incremental_load(df: DataFrame, column: str, mark: str) -> DataFrame:
    """Rows at or after the mark. The mark is compared in the type of the column, so
    ids compare as numbers; rows without a value count as 2000-01-01."""
    kind = df.schema[column].dataType
    bound = F.lit(mark).cast(kind)
    if isinstance(kind, T.NumericType):
        return df.filter(F.col(column) >= bound)
    if mark > NULL_MARK_STANDIN:
        # rows without a value stand at 2000-01-01, below this mark: plain predicate, pushed down
        return df.filter(F.col(column) >= bound)
    return df.filter(F.coalesce(F.col(column), F.lit(NULL_MARK_STANDIN).cast(kind)) >= bound)


def next_mark(df: DataFrame, column: str | None, old: str, now: str) -> str:
    """Mark to store after a load: the largest value, the old mark when there is none,
    the current time for full loads."""
    if column is None or column not in df.columns:
        return now
    top = df.agg(F.max(column).cast("string")).first()[0]
    return old if top is None else top
