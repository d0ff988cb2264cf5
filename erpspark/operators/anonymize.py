"""Replace names by numbered labels and scale money, once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from erpspark.operators.upsert import dense_positions

# fixed values: label per entity and the money factor
LABELS = {"customer": "Khach Hang", "staff": "Nhan Vien", "supplier": "Nha Cung Cap"}
MONEY_FACTOR = "0.1"


def anonymize(df: DataFrame, key: str, entity: str, names: list[str], money: list[str] | None = None) -> DataFrame:
    """Names become ``<label> 001`` by key order (a whole-number key), money columns are multiplied by 0.1.

    Rows flagged ``is_anonymized`` keep their label and amounts, so a second run changes
    nothing; rows that came since (flag false or NULL) get the numbers after the highest in use.
    """
    done, top = None, 0
    if "is_anonymized" in df.columns:
        flagged = F.coalesce(F.col("is_anonymized"), F.lit(False))
        done, columns = df.where(flagged), df.columns
        df = df.where(~flagged).drop("is_anonymized")
        used = F.regexp_extract(F.col(names[0]), rf"^{LABELS[entity]} (\d+)$", 1)
        top = done.agg(F.max(F.when(used != "", used.cast("bigint")))).first()[0] or 0
    numbered = dense_positions(df, key, "__pos", top)
    digits = F.col("__pos").cast("string")
    label = F.concat(F.lit(LABELS[entity] + " "), F.when(F.col("__pos") < 1000, F.lpad(digits, 3, "0")).otherwise(digits))
    for c in names:
        numbered = numbered.withColumn(c, label)
    for c in money or []:
        numbered = numbered.withColumn(c, (F.col(c) * F.lit(MONEY_FACTOR).cast("decimal(2,1)")).cast("decimal(22,4)"))
    out = numbered.drop("__pos").withColumn("is_anonymized", F.lit(True))
    return out if done is None else done.unionByName(out).select(*columns)
