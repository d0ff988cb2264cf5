"""Exact global and grouped order statistics without a single-task sort.

Rows are collapsed to (group, value, count), written once, and wanted ranks are selected digit by digit: every value
has an order-preserving 64-bit code; one aggregate counts, for all groups and ranks at once, the rows per leading 16 bits; the
counts say in which of these buckets each rank lies, and the next aggregate looks at the next 16 bits inside the
hit buckets only. Once the hit buckets hold few distinct values they are sorted, each on its own. Every pass
reads the collapsed table once.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from erpspark.session import written

#: Bits of a digit, and digits of a code.
DIGIT, DIGITS = 16, 4
#: Distinct values of a bucket that are sorted without looking at further digits.
SORTED = 1 << 16


def code(value: Column) -> Column:
    """Long that orders like the value as a double: sign, exponent and mantissa.

    Never falls where the value rises; values that agree as doubles share a code, and those under 2^-1022 share that of zero.
    """
    v = value.cast("double")
    size = F.abs(v)
    about = F.floor(F.log2(size)).cast("double")  # may be one off beside a power of two
    low = F.pow(F.lit(2.0), F.least(F.greatest(about, F.lit(-1022.0)), F.lit(1023.0)))
    exponent = about + F.when(size < low, -1).when(size / 2 >= low, 1).otherwise(0)
    part = size / F.pow(F.lit(2.0), exponent) - 1
    bits = ((exponent + 1023).cast("bigint") * F.lit(1 << 52)) + (part * F.lit(float(1 << 52))).cast("bigint")
    whole = F.when(F.isnan(v) | (size == math.inf), F.lit(0x7FF << 52)).when(size < 2.0**-1021, F.lit(0).cast("bigint")).otherwise(bits)
    return F.when(v < 0, -whole).otherwise(whole) + F.isnan(v).cast("bigint")


def _prefix(digits: int) -> Column:
    """The leading digits of the code."""
    return F.shiftright("__code", 64 - DIGIT * digits)


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Equality on columns that `right` has under a leading `h_`; NULL groups are groups."""
    on = F.lit(True)
    for c in columns:
        on = on & left[c].eqNullSafe(right[f"h_{c}"])
    return on


def _renamed(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"h_{c}" for c in columns})


def collapsed(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Written (group, value, __n, __code), one row per distinct value of a group."""
    counts = rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("__n"))
    return written(counts.withColumn("__code", code(F.col(value))), "counts")


def _histogram(rows: DataFrame, by: list[str], digits: int) -> DataFrame:
    """Per bucket of that many digits: rows before it inside its group or parent bucket, its rows and distinct values."""
    parent = [*by, "__p"] if digits > 1 else by
    cells = rows.groupBy(*parent, _prefix(digits).alias("__d")).agg(F.sum("__n").alias("__bn"), F.count(F.lit(1)).alias("__k"))
    # at most 2^16 rows of a group reach these windows
    order = Window.partitionBy(*parent)
    before = F.sum("__bn").over(order.orderBy("__d").rowsBetween(Window.unboundedPreceding, -1))
    return cells.withColumns({"__first": F.coalesce(before, F.lit(0)), "__total": F.sum("__bn").over(order)})


def _inside(counts: DataFrame, targets: DataFrame, by: list[str], digits: int) -> DataFrame:
    """The collapsed rows in the buckets that ranks were found in, with the bucket as __p."""
    hit = _renamed(targets.select(*by, "__p").distinct(), [*by, "__p"])
    rows = counts.withColumn("__p", _prefix(digits))
    return rows.join(hit, _same(rows, hit, [*by, "__p"]), "left_semi")


def select_ranks(
    counts: DataFrame, by: list[str], value: str, ranks: Callable[[Column], dict[str, Column]] | DataFrame, few: bool = False
) -> DataFrame:
    """group, name, rank, value, start, n and total for every wanted 0-based rank of a collapsed table.

    ``ranks`` maps the number of rows of a group to named ranks, or is a table (group, name, rank). ``start`` is the rank of the
    first row that has the value. With ``few`` the caller states that groups and ranks are a handful: their buckets are kept
    on the driver instead of being written.
    """

    def kept(targets: DataFrame) -> tuple[DataFrame, int]:
        if few:
            rows = targets.collect()
            return counts.sparkSession.createDataFrame(rows, targets.schema), max((r["__k"] for r in rows), default=0)
        targets = written(targets, "targets")
        return targets, targets.agg(F.max("__k")).first()[0] or 0

    first = _histogram(counts, by, 1)
    if callable(ranks):
        wanted = F.array(*[F.struct(F.lit(k).alias("name"), r.cast("bigint").alias("rank")) for k, r in ranks(F.col("__total")).items()])
        asked = first.withColumn("__r", F.explode(wanted)).select(*first.columns, "__r.name", "__r.rank")
    else:
        asks = _renamed(ranks, by)
        asked = first.join(asks, _same(first, asks, by)).select(*first.columns, "name", "rank")
    hit = (F.col("rank") >= F.col("__first")) & (F.col("rank") < F.col("__first") + F.col("__bn"))
    targets, most = kept(asked.where(hit).select(*by, "name", "rank", "__total", F.col("__first").alias("__base"), F.col("__d").alias("__p"), "__k"))
    digits = 1
    while digits < DIGITS and most > SORTED:
        digits += 1
        cells = _renamed(_histogram(_inside(counts, targets, by, digits - 1), by, digits).drop("__total"), [*by, "__p", "__k"])
        both = targets.join(cells, _same(targets, cells, [*by, "__p"]))
        left = F.col("rank") - F.col("__base")
        deeper = both.where((left >= F.col("__first")) & (left < F.col("__first") + F.col("__bn")))
        base = (F.col("__base") + F.col("__first")).alias("__base")
        targets, most = kept(deeper.select(*by, "name", "rank", "__total", base, F.col("__d").alias("__p"), F.col("h___k").alias("__k")))
    rows = _inside(counts, targets, by, digits)
    bucket = Window.partitionBy(*by, "__p").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    placed = _renamed(rows.withColumn("__at", F.coalesce(F.sum("__n").over(bucket), F.lit(0))), [*by, "__p"])
    start = F.col("__base") + F.col("__at")
    covers = (F.col("rank") >= start) & (F.col("rank") < start + F.col("__n"))
    found = targets.join(placed, _same(targets, placed, [*by, "__p"])).where(covers)
    return found.select(*by, "name", "rank", value, start.alias("start"), F.col("__n").alias("n"), F.col("__total").alias("total"))


def exact_percentiles(df: DataFrame, value: str, probs: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """Interpolated percentiles of a double column, one output column per entry of ``probs``.

    One row per group (or a single row); groups without a non-NULL value are absent.
    """
    by = by or []
    rows = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("__v"))

    def wanted(total: Column) -> dict[str, Column]:
        at = {name: F.lit(float(p)) * (total - 1) for name, p in probs.items()}
        return {f"lo_{name}": F.floor(pos) for name, pos in at.items()} | {f"hi_{name}": F.ceil(pos) for name, pos in at.items()}

    hits = select_ranks(collapsed(rows, by, "__v"), by, "__v", wanted, few=not by)
    values = {n: F.max(F.when(F.col("name") == n, F.col("__v"))).alias(f"__{n}") for p in probs for n in (f"lo_{p}", f"hi_{p}")}
    found = hits.groupBy(*by).agg(F.max("total").alias("__total"), *values.values())
    out = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("__total") - 1)
        lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        out.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    # without groups an empty input still gives one aggregate row: it has no total
    return found.where(F.col("__total").isNotNull()).select(*by, *out)


def percentile_values(df: DataFrame, value: str, probs: dict[str, float]) -> dict[str, float | None]:
    """Global exact percentiles as plain numbers (one per entry of ``probs``)."""
    row = exact_percentiles(df, value, probs).first()
    return {name: (row[name] if row is not None else None) for name in probs}


def _tile_starts(total: Column, tiles: int) -> dict[str, Column]:
    """0-based ranks at which tiles 2..n start (NULL where there are too few rows); the first total % n tiles are one larger."""
    starts = {t: F.lit(t) * F.floor(total / tiles) + F.least(F.lit(t), total % tiles) for t in range(1, tiles)}
    return {str(t): F.when(s < total, s) for t, s in starts.items()}


def ntile_columns(df: DataFrame, tiles: int, metrics: dict[str, tuple[Column, bool]], key: str) -> DataFrame:
    """Add one ntile column per entry ``name -> (metric, descending)``.

    NULLs sort as the largest value (last ascending, first descending) and ties
    are broken by ``key``, a whole-number column. The input is written once; the tiles - 1 boundary rows of all
    metrics are selected together and every row is compared against them, so no task ever sorts all rows.
    """
    low, high = F.lit("-1e32").cast("decimal(38,4)"), F.lit("1e32").cast("decimal(38,4)")
    values = {}
    for name, (metric, desc) in metrics.items():
        m = metric.cast("decimal(38,4)")
        values[f"__{name}"] = F.coalesce(-m, low) if desc else F.coalesce(m, high)
    frame = written(df.withColumns(values | {"__key": F.coalesce(F.col(key).cast("bigint"), F.lit(2**63 - 1))}), "ntile-rows")
    each = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"__{n}").alias("v")) for n in metrics])
    melted = frame.select("__key", F.explode(each).alias("m")).select("__key", "m.*")
    # tiles - 1 boundaries per metric
    cuts = select_ranks(collapsed(melted, ["metric"], "v"), ["metric"], "v", lambda total: _tile_starts(total, tiles), few=True).collect()
    # the first row of a value needs no tie-break; any other is found among the keys tied on the value
    keys = {(c["metric"], c["rank"]): None for c in cuts}
    tied = [(c["metric"], c["v"], str(c["rank"]), c["rank"] - c["start"]) for c in cuts if c["rank"] > c["start"]]
    if tied:
        asks = df.sparkSession.createDataFrame(tied, "metric string, v decimal(38,4), name string, rank bigint")
        rows = melted.join(F.broadcast(asks.select("metric", "v").distinct()), ["metric", "v"])
        for c in select_ranks(collapsed(rows, ["metric", "v"], "__key"), ["metric", "v"], "__key", asks, few=True).collect():
            keys[c["metric"], int(c["name"])] = c["__key"]
    for name in metrics:
        tile = F.lit(1)
        for cut in (c for c in cuts if c["metric"] == name):
            value, least = F.lit(cut["v"]).cast("decimal(38,4)"), keys[name, cut["rank"]]
            at = F.col(f"__{name}")
            past = at >= value if least is None else (at > value) | ((at == value) & (F.col("__key") >= F.lit(least)))
            tile = tile + past.cast("int")
        frame = frame.withColumn(name, tile)
    return frame.drop("__key", *values)


def bucket_bounds(df: DataFrame, value: str, buckets: int | None = None) -> list[float]:
    """Approximate quantiles used as cut points (one driver value per bucket); as many buckets as the session shuffles into."""
    buckets = buckets or max(4, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    probs = [i / buckets for i in range(1, buckets)]
    found = df.select(F.col(value).cast("double").alias("v")).approxQuantile("v", probs, 1 / (4 * buckets))
    return sorted({float(b) for b in found if math.isfinite(b)})


def bucket_of(value: str, bounds: list[float]) -> Column:
    """Index of the bucket a value falls in: first among every step-th bound, then inside that step."""
    v, array = F.col(value).cast("double"), F.array(*[F.lit(b) for b in bounds]).cast("array<double>")
    step = max(1, math.isqrt(len(bounds)))
    start = F.size(F.filter(array, lambda b, i: (i % step == step - 1) & (b < v))) * step
    return (start + F.size(F.filter(F.slice(array, start + 1, step), lambda b: b < v))).cast("int")


def cumulative_desc(df: DataFrame, value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over all rows with a value at least as large.

    Ties share one total. Values are collapsed and written first, so the ordered work is on
    distinct values, cut into buckets that carry the totals of those above them.
    """
    cut = written(df.groupBy(value).agg(F.sum(value).alias("__t")).filter(F.col(value).isNotNull()).withColumn("__neg", -F.col(value).cast("double")), "totals")
    cut = cut.withColumn("__b", bucket_of("__neg", bucket_bounds(cut, "__neg")))
    above = (
        cut.groupBy("__b")
        .agg(F.sum("__t").alias("__bt"))
        # one row per bucket
        .withColumn(
            "__above",
            F.coalesce(F.sum("__bt").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        .drop("__bt")
    )
    inside = Window.partitionBy("__b").orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, 0)
    running = (
        cut.withColumn("__in", F.sum("__t").over(inside))
        .join(F.broadcast(above), "__b")
        .select(value, (F.col("__in") + F.col("__above")).alias(name))
    )
    return df.join(running, value, "left")
