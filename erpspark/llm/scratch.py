"""Written intermediate tables in the folder that the cluster shares.

``spark.checkpoint.dir`` names the folder. Only on a local master where it is unset (tests, local
runs) a folder of this process is made, and removed when the process ends.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

_LOCAL: list[str] = []
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the package to the session's Python workers once, so that they import it wherever they run."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="erpspark-zip-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        with zipfile.ZipFile(f"{folder}/{package.name}.zip", "w") as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, file.relative_to(package.parent))
        context.addPyFile(f"{folder}/{package.name}.zip")
        _SHIPPED.add(context.applicationId)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="erpspark-llm-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return _LOCAL[0]


def aside(docs: DataFrame, text: str, outputs: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """The text column as `__text`, every other column under a numbered name, and those names by the names to give back.

    Whatever the input's columns are called, they cannot clash with inner names; a column named as one of the outputs gives way.
    """
    taken = {o.lower() for o in outputs}
    inner = {c: f"c{i}" for i, c in enumerate(docs.columns) if c != text and c.lower() not in taken}
    return docs.select(*(F.col(f"`{c}`").alias(n) for c, n in inner.items()), F.col(text).cast("string").alias("__text")), inner


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: its lineage ends there, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
