"""Date dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from erpspark.functions.expr import date_key
from erpspark.settings import DATE_DIM_END, DATE_DIM_START


def date_dim(spark: SparkSession, start: date = DATE_DIM_START, end: date = DATE_DIM_END) -> DataFrame:
    """One row per day with the calendar attributes the marts group by."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias("full_date")
    )
    d = F.col("full_date")
    dow = F.dayofweek(d) - 1  # 0 = Sunday
    return days.select(
        date_key(d).alias("date_key"),
        d,
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_num"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        dow.isin(0, 6).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )
