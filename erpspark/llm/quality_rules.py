"""Quality rules with thresholds that follow each language and source, in DataFrame functions only.

Base measures are counted per document on the whole text. A KLL quantile sketch per (lang, source) and
measure is built with map-side merging. Its 0.2, 0.5 and 0.8 quantiles are drawn towards those of the language,
and these towards those of everything, as if `SHRINK` documents more had them; so small groups lean on
others and no bound jumps as a group grows. A measure is out of bounds where it lies further beyond an outer quantile
than `REACH` times the distance of that from the median; `LEAST_MARGIN` is the margin where nearly all
documents of a group have one value and there is no distance to go by. Bounds are set on both sides.

Defined results: null or empty text has no words and fails the base rules; null lang or source is a group
of its own; repeated rows are judged each; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from erpspark.llm.scratch import stored

SPACE = r"[ \t\n\x0B\f\r]"
_BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]"

#: Measures that are judged, with the least margin of each.
LEAST_MARGIN = {"symbol_share": 0.02, "dup_line_share": 0.20, "repeat_share": 0.05, "upper_share": 0.01, "mark_share": 0.05, "mean_word": 0.25, "log_words": 0.5}
REACH = 6.0
#: Documents that the next wider group counts for in the quantiles of a group.
SHRINK = 50


def let(value: Column, use) -> Column:
    """`use(value)` with `value` computed once per row."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    """Words of a text: runs of anything but 0x20 and 0x09-0x0D."""
    trimmed = F.btrim(text, F.lit(_BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


def count_matches(text: Column, pattern: str) -> Column:
    """Number of characters that match a one-character pattern."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def repeat_words(word_list: Column, n: int = 5) -> Column:
    """Words inside runs of `n` words that occur twice or more in the list, first occurrences included.

    Runs are compared by 64-bit hash. Most texts repeat no run, which a distinct count shows; only the others are sorted.
    """

    def runs(w: Column) -> Column:
        size = F.size(w)
        return F.when(size < n, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.greatest(size - n, F.lit(0))), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(n))))
        )

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
            found = F.filter(s, lambda x, i: (F.when(i > 0, same(x, i - 1)).otherwise(F.lit(False))) | same(x, i + 1))
            return F.sort_array(F.transform(found, lambda x: x["i"]))

        total = F.aggregate(
            let(placed, starts),
            F.struct(F.lit(0).alias("total"), F.lit(-n).alias("last")),
            lambda acc, x: F.struct((acc["total"] + F.least(F.lit(n), x - acc["last"])).alias("total"), x.alias("last")),
            lambda acc: acc["total"],
        )
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(total)

    return let(let(word_list, runs), covered).cast("long")


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, base counts and the judged measures, one row per input row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(_BLANKS)) != "")
    line_counts = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    word_counts = let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeat_words(w).alias("repeat")))
    out = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        (F.length(text) - count_matches(text, SPACE)).cast("long").alias("word_chars"),
        count_matches(text, SYMBOLS).alias("n_symbols"),
        count_matches(text, r"\p{Lu}").alias("n_upper"),
        count_matches(text, r"[!?#*$%&|<>{}\[\]\\^~_=+]").alias("n_marks"),
        line_counts.alias("lines"),
        word_counts.alias("words"),
    )
    n_words, chars = F.col("words.n"), F.greatest(F.col("word_chars"), F.lit(1))
    return out.select(
        "doc_id", "lang", "source", n_words.alias("n_words"), "word_chars", "n_symbols",
        F.col("lines.dup").cast("long").alias("n_dup_lines"), F.col("words.repeat").alias("n_repeat_words"),
        (F.col("n_symbols") / chars).alias("symbol_share"),
        (F.col("lines.dup") / F.greatest(F.col("lines.n"), F.lit(1))).alias("dup_line_share"),
        (F.col("words.repeat") / F.greatest(n_words, F.lit(1))).alias("repeat_share"),
        (F.col("n_upper") / chars).alias("upper_share"),
        (F.col("n_marks") / F.greatest(n_words, F.lit(1))).alias("mark_share"),
        (F.col("word_chars") / F.greatest(n_words, F.lit(1))).alias("mean_word"),
        F.log(F.greatest(n_words, F.lit(1)).cast("double")).alias("log_words"),
    )


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


def thresholds(measured: DataFrame, shrink: int = SHRINK, reach: float = REACH) -> DataFrame:
    """Lower and upper bound of every measure per (lang, source), from mergeable sketches of the documents that pass the base rules."""
    fit = measured.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    groups = fit.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), *(F.kll_sketch_agg_double(m).alias(m) for m in LEAST_MARGIN))

    def merged(*keys: str) -> DataFrame:
        return groups.groupBy(*keys).agg(F.sum("n").alias("n"), *(F.kll_merge_agg_double(m).alias(m) for m in LEAST_MARGIN))

    def quantiles(df: DataFrame, name: str, *keys: str) -> DataFrame:
        # the merged sketch of no document at all has no quantiles
        q = {m: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double(m, F.array(F.lit(0.2), F.lit(0.5), F.lit(0.8)))) for m in LEAST_MARGIN}
        return df.select(*keys, F.struct(F.col("n"), *(q[m].alias(m) for m in LEAST_MARGIN)).alias(name))

    def drawn(n: Column, own: Column, wider: Column) -> Column:
        mean = F.zip_with(own, wider, lambda x, y: (n * x + F.lit(shrink) * y) / (n + F.lit(shrink)))
        return F.when(n > 0, mean).otherwise(wider)

    own = quantiles(groups, "own", "lang", "source")
    by_lang = quantiles(merged("lang"), "by_lang", "lang").withColumnRenamed("lang", "lang_key")
    whole = quantiles(merged(), "whole")
    # every group that occurs gets a row, also where none of its documents passed the base rules
    keys = measured.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows"))
    joined = (
        keys.join(own.withColumnsRenamed({"lang": "l", "source": "s"}), F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")), "left")
        .join(by_lang, F.col("lang").eqNullSafe(F.col("lang_key")), "left")
        .join(F.broadcast(whole), F.lit(True), "left")  # one row
    )
    of_lang = {m: drawn(F.col("by_lang.n"), F.col(f"by_lang.{m}"), F.col(f"whole.{m}")) for m in LEAST_MARGIN}
    used = joined.select("lang", "source", *(drawn(F.col("own.n"), F.col(f"own.{m}"), of_lang[m]).alias(m) for m in LEAST_MARGIN))
    margin = lambda x, y, m: F.greatest(reach * (y - x), F.lit(LEAST_MARGIN[m]))
    bounds = [
        bound
        for m, q in ((m, F.col(m)) for m in LEAST_MARGIN)
        for bound in ((q[0] - margin(q[0], q[1], m)).alias(f"min_{m}"), (q[2] + margin(q[1], q[2], m)).alias(f"max_{m}"))
    ]
    return used.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), *bounds)


def judge(docs: DataFrame) -> DataFrame:
    """Base counts, measures, `base_failed` and `kept` per document."""
    measured = stored(measures(docs), "measures")
    limits = stored(thresholds(measured), "thresholds")
    same = F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source"))
    inside = F.lit(True)
    for m in LEAST_MARGIN:
        inside = inside & F.coalesce(F.col(m).between(F.col(f"min_{m}"), F.col(f"max_{m}")), F.lit(True))
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return measured.join(limits, same, "left").select(*measured.columns, failed.alias("base_failed"), (~failed & inside).alias("kept"))
