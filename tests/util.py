from decimal import Decimal

from pyspark.sql import types as T


def frame(spark, ddl, rows):
    """Literal DataFrame; plain numbers are accepted for decimal columns."""
    schema = T.StructType.fromDDL(ddl)

    def conv(row):
        return tuple(
            Decimal(str(v)) if v is not None and isinstance(f.dataType, T.DecimalType)
            else float(v) if v is not None and isinstance(f.dataType, T.DoubleType)
            else v
            for f, v in zip(schema, row, strict=True)
        )

    return spark.createDataFrame([conv(r) for r in rows], schema)


def rows(df, *cols):
    key = lambda r: tuple((v is not None, v) for v in r)
    return sorted((tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in df.select(*cols).collect()), key=key)
