"""Small document frames with the awkward cases every operator must take."""

DOCS_DDL = "doc_id long, text string, lang string, source string, n_chars long, __text string, row_id string, score double"


def docs(spark, texts, **extra):
    """Documents 0.. with the texts, and extra columns whose names clash with inner ones."""
    rows = [(i, t, extra.get("lang", "en"), extra.get("source", "src0"), None if t is None else len(t), "clash", "clash", -1.0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS_DDL)


def plain(spark, rows, ddl="doc_id long, text string"):
    return spark.createDataFrame(rows, ddl)
