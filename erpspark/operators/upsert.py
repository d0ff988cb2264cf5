"""Keyed writes expressed as joins: upsert, insert-if-absent, replace, key healing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from erpspark.operators.lookup import lookup
from erpspark.operators.ranks import bucket_bounds, bucket_of


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the greatest by ``order``. Partial aggregation runs before
    the shuffle, so a hot key sends one row per task, not all of its rows."""
    rest = [c for c in df.columns if c != key]
    best = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(key).agg(best.alias("__row")).select(key, "__row.*")


def dense_positions(df: DataFrame, order: str, name: str = "position", after: int = 0) -> DataFrame:
    """Number rows after+1, after+2, ... by a unique numeric column (buckets compare it as a double).

    Rows are cut into ordered buckets, each bucket is numbered on its own and
    shifted by the number of rows before it.
    """
    cut = df.withColumn("__b", bucket_of(order, bucket_bounds(df, order)))
    # one row per bucket, a few hundred at most
    before = (
        cut.groupBy("__b")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn(
            "__shift",
            F.coalesce(
                F.sum("__n").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        )
        .drop("__n")
    )
    inside = F.row_number().over(Window.partitionBy("__b").orderBy(order))
    return (
        cut.withColumn(name, inside)
        .join(F.broadcast(before), "__b")
        .withColumn(name, F.col(name) + F.col("__shift") + F.lit(after).cast("bigint"))
        .drop("__b", "__shift")
    )


def upsert_scd1(target: DataFrame, source: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """Overwrite matching rows with the source, keep the others, add new rows.

    ``source`` has the natural key and the columns it updates; target columns it
    does not carry keep their value. New rows get surrogate keys above the
    current maximum, in natural-key order.
    """
    updated = [c for c in source.columns if c != natural]
    src = source.withColumnsRenamed({c: f"__s_{c}" for c in updated}).withColumn("__in_src", F.lit(True))
    merged = target.join(src, natural, "full")
    out = [F.col(natural), F.col(surrogate)]
    for c in target.columns:
        if c in (natural, surrogate):
            continue
        if c in updated:
            out.append(F.when(F.col("__in_src"), F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    merged = merged.select(*out).withColumn(surrogate, F.col(surrogate).cast("bigint")).select(*target.columns)
    top = target.agg(F.max(surrogate)).first()[0] or 0
    known, fresh = merged.where(F.col(surrogate).isNotNull()), merged.where(F.col(surrogate).isNull())
    # the rows of the join without a surrogate are the new ones
    numbered = dense_positions(fresh.drop(surrogate), natural, surrogate, top)
    return known.unionByName(numbered)


def update_where_changed(
    target: DataFrame, changes: DataFrame, key: str, watch: str, columns: list[str]
) -> DataFrame:
    """Set ``columns`` from the change row of the same key, only where the watched
    column differs (NULL counts as a value)."""
    new = changes.select(key, *[F.col(c).alias(f"__c_{c}") for c in columns]).withColumn("__hit", F.lit(True))
    joined = lookup(target, new, key)
    changed = F.coalesce(F.col("__hit"), F.lit(False)) & ~F.col(watch).eqNullSafe(F.col(f"__c_{watch}"))
    return joined.select(
        *[
            F.when(changed, F.col(f"__c_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in target.columns
        ]
    )


def new_rows(fact: DataFrame, rows: DataFrame, natural: str) -> DataFrame:
    """Rows whose natural key the fact does not hold yet (append these)."""
    return rows.join(fact.select(natural), natural, "left_anti")


def insert_if_absent(fact: DataFrame, rows: DataFrame, natural: str) -> DataFrame:
    """Fact plus the new rows; rows already present are never changed."""
    return fact.unionByName(new_rows(fact, rows, natural), allowMissingColumns=True)


def replace_by_key(fact: DataFrame, rows: DataFrame, natural: str) -> DataFrame:
    """Drop the fact rows the batch names, then add the whole batch."""
    kept = fact.join(rows.select(natural).distinct(), natural, "left_anti")
    return kept.unionByName(rows, allowMissingColumns=True)


def heal_keys(
    fact: DataFrame,
    resolved: DataFrame,
    natural: str,
    keys: list[str],
    needs: Column | None = None,
    clear: dict[str, Column] | None = None,
) -> DataFrame:
    """Fill keys that were unknown when the row was inserted.

    ``resolved`` has the natural key and freshly looked-up keys. A row is touched
    when any listed key is NULL (or ``needs`` holds, which may use ``r_<key>``);
    every listed key of a touched row becomes coalesce(fresh, old), or NULL where
    ``clear[key]`` holds. The flag column ``key_fixed`` marks touched rows.
    """
    clear = clear or {}
    extra = [c for c in resolved.columns if c != natural and c not in keys]
    fresh = resolved.select(
        natural, *[F.col(k).alias(f"r_{k}") for k in keys], *[F.col(c).alias(f"r_{c}") for c in extra]
    ).withColumn("__in_batch", F.lit(True))
    joined = lookup(fact, fresh, natural)
    if needs is None:
        needs = F.lit(False)
        for k in keys:
            needs = needs | F.col(k).isNull()
    touched = F.coalesce(F.col("__in_batch") & needs, F.lit(False))
    out = []
    for c in fact.columns:
        if c in keys:
            value = F.coalesce(F.col(f"r_{c}"), F.col(c))
            if c in clear:
                value = F.when(~clear[c], value)
            out.append(F.when(touched, value).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out, touched.alias("key_fixed"))


def rekey_materials(
    fact: DataFrame,
    source: DataFrame,
    materials: DataFrame,
    natural: str,
    source_id: str,
    reset_first: bool = False,
) -> DataFrame:
    """Repair rows of raw materials that carry a product key.

    ``source`` lists the raw-material rows with their material id. Where the id
    resolves, the product key is cleared and the material key set; with
    ``reset_first`` both keys of every listed row are cleared beforehand.
    """
    found = lookup(
        source.select(natural, F.col(source_id).alias("__mid")),
        materials.select(F.col("material_id"), F.col("material_key").alias("__mk")),
        "__mid",
        "material_id",
    ).select(natural, "__mk", F.lit(True).alias("__listed"))
    joined = lookup(fact, found, natural)
    hit = F.coalesce(F.col("__listed"), F.lit(False))
    if not reset_first:
        hit = hit & F.col("__mk").isNotNull()
    keep = [c for c in fact.columns if c not in ("product_key", "material_key")]
    return joined.select(
        *keep,
        F.when(~hit, F.col("product_key")).alias("product_key"),
        F.when(hit, F.col("__mk")).otherwise(F.col("material_key")).alias("material_key"),
    ).select(*fact.columns)
