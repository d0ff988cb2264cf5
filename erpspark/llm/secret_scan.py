"""Secret scan with linking of multipart credentials, in DataFrame functions only.

Three base kinds are always reported: assignments to secret names, access identifiers and long hex
strings. Three weak kinds are reported only where complementary parts stand within `REACH` code points of
each other in one scope (a block of text between empty lines):

- a bare 40-character key, next to an access identifier (base or weak),
- a weak identifier (an assignment to a user or client name), next to a bare key or a base assignment,
- an endpoint (URL or host name with port), next to both an identifier and a secret.

The parts meet in an interval join: weak parts, widened by `REACH` on both sides, and their complements are dealt to all
cells of `REACH` code points that they touch in their scope. Parts that are near share a cell whatever their lengths, and
a part only meets those in the cells around it, however many a document has.

Places are counted in code points, end exclusive. Matches are leftmost and do not overlap within a kind.
Defined results: null text is empty; no finding gives zero counts and an empty list; repeated rows give
repeated results; other columns are passed by whatever their names, but for those named as an output of `scan`, which give way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from erpspark.llm.quality_rules import let
from erpspark.llm.scratch import stored

REACH = 400

# Patterns of the base kinds: fixed values.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"

# Patterns of the weak kinds.
IDENTIFIER = r"""(?i)(?:access_?key(?:_?id)?|client_?id|user(?:_?name)?|login|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})"""
BARE_KEY = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
ENDPOINT = r"""https?://[A-Za-z0-9][^\s"'<>]*|(?<![A-Za-z0-9.-])[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+:[0-9]{2,5}"""

#: Order in which kinds that start at one place are listed.
KINDS = ["assign", "access", "hex", "identifier", "key", "endpoint"]

_CHUNK = 500
_NO_SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"


def running_ends(lengths: Column) -> Column:
    """Running sums of an array of longs. Chunks are summed by themselves, so that long arrays are not copied for every entry."""

    def chunk(acc: Column, first: Column) -> Column:
        inner = F.aggregate(
            F.slice(lengths, first, _CHUNK),
            F.struct(acc["total"].alias("total"), F.array().cast("array<bigint>").alias("out")),
            lambda a, x: F.struct((a["total"] + x).alias("total"), F.concat(a["out"], F.array(a["total"] + x)).alias("out")),
        )
        return let(inner, lambda r: F.struct(r["total"].alias("total"), F.concat(acc["out"], F.array(r["out"])).alias("out")))

    firsts = F.sequence(F.lit(1), F.greatest(F.size(lengths), F.lit(1)), F.lit(_CHUNK))
    start = F.struct(F.lit(0).cast("bigint").alias("total"), F.array().cast("array<array<bigint>>").alias("out"))
    return F.flatten(F.aggregate(firsts, start, chunk, lambda acc: acc["out"]))


def spans(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """(start, kind, end) of every match; `keep` takes the text of group 2 (or the match) and says which matches stay.

    The text between matches and the matches themselves alternate, so their running lengths are the places.
    """
    code = KINDS.index(kind)
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("bigint"))
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda x: F.length(x).cast("bigint"))
    judged = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(2 if kind == "assign" else 0)), lambda x: keep(x) if keep else F.lit(True))
    steps = F.flatten(F.transform(F.arrays_zip(between.alias("b"), found.alias("f")), lambda z: F.array(z["b"], F.coalesce(z["f"], F.lit(0).cast("bigint")))))

    def placed(ends: Column) -> Column:
        return let(judged, lambda ok: F.filter(
            F.transform(ok, lambda good, i: F.when(good, F.struct(F.get(ends, 2 * i).alias("start"), F.lit(code).alias("kind"), F.get(ends, 2 * i + 1).alias("end")))),
            lambda s: s.isNotNull(),
        ))

    return F.coalesce(let(let(steps, running_ends), placed), F.array()).cast(_NO_SPANS)


def base_spans(text: Column) -> Column:
    """All spans of the base kinds; texts without a trace of a kind skip its exact pass."""
    none = F.array().cast(_NO_SPANS)
    kinds = [
        F.when(F.regexp_like(text, F.lit(r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]")), spans(text, ASSIGN, "assign", lambda x: F.length(x) >= 12)).otherwise(none),
        F.when(F.contains(text, F.lit("AKIA")), spans(text, ACCESS, "access", lambda x: F.length(x) >= 18)).otherwise(none),
        F.when(F.regexp_like(text, F.lit("[0-9a-f]{16}")), spans(text, HEX, "hex", lambda x: F.length(x) >= 16)).otherwise(none),
    ]
    return F.concat(*kinds)


def weak_spans(text: Column) -> Column:
    """Candidates of the weak kinds."""
    return F.concat(spans(text, IDENTIFIER, "identifier"), spans(text, BARE_KEY, "key"), spans(text, ENDPOINT, "endpoint"))


def scope_starts(text: Column) -> Column:
    """Places where a new scope begins (after each run of empty lines), ascending."""
    gap = r"\n[ \t\r]*\n\s*"
    between = F.transform(F.split(text, gap, -1), lambda x: F.length(x).cast("bigint"))
    found = F.transform(F.regexp_extract_all(text, F.lit(gap), F.lit(0)), lambda x: F.length(x).cast("bigint"))
    blocks = F.transform(F.arrays_zip(between.alias("b"), found.alias("f")), lambda z: z["b"] + F.coalesce(z["f"], F.lit(0).cast("bigint")))
    return let(blocks, running_ends)


def linked(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """Weak parts that stand by their complements; `parts` has row_id, scope, kind, start, end."""
    code = {k: i for i, k in enumerate(KINDS)}
    ident = F.col("kind").isin(code["access"], code["identifier"])
    secret = F.col("kind").isin(code["assign"], code["key"])
    weak = F.col("kind").isin(code["identifier"], code["key"], code["endpoint"])
    first, last = F.floor((F.col("start") - reach) / reach), F.floor((F.col("end") + reach) / reach)
    r_first, r_last = F.floor(F.col("start") / reach), F.floor(F.col("end") / reach)
    left = parts.where(weak).select("row_id", "scope", "kind", "start", "end", first.alias("first"), F.explode(F.sequence(first, last)).alias("cell"))
    right = parts.where(ident | secret).select(
        F.col("row_id"), F.col("scope"), r_first.alias("r_first"), F.explode(F.sequence(r_first, r_last)).alias("cell"),
        F.col("start").alias("r_start"), F.col("end").alias("r_end"), ident.alias("is_ident"), secret.alias("is_secret"),
    )
    near = (F.col("r_start") - F.col("end") <= reach) & (F.col("start") - F.col("r_end") <= reach)
    other = (F.col("r_start") != F.col("start")) | (F.col("r_end") != F.col("end"))
    once = F.col("cell") == F.greatest("first", "r_first")  # of the cells that a pair shares, the first
    met = left.join(right, ["row_id", "scope", "cell"]).where(once & near & other)
    flags = met.groupBy("row_id", "kind", "start", "end").agg(F.bool_or("is_ident").alias("by_ident"), F.bool_or("is_secret").alias("by_secret"))
    whole = (
        F.when(F.col("kind") == code["identifier"], F.col("by_secret"))
        .when(F.col("kind") == code["key"], F.col("by_ident"))
        .otherwise(F.col("by_ident") & F.col("by_secret"))
    )
    return flags.where(whole).select("row_id", "start", "kind", "end")


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """The input's columns but `text` (which `__text` carries), and `__base` and `__spans`: sorted (start, kind, end) of base and of all findings."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rest = [c for c in docs.columns if c.lower() not in ("text", "__text", "__base", "__spans")]
    found = docs.select(F.struct(*(F.col(f"`{c}`") for c in rest)).alias("__doc"), text.alias("__text")).withColumn("__base", F.sort_array(base_spans(F.col("__text"))))
    # an identifier is needed for any weak part but an identifier, and a secret for that
    traces = F.regexp_like("__text", F.lit(IDENTIFIER)) | F.exists("__base", lambda x: x["kind"] == KINDS.index("access"))
    # texts without any get a key that matches nothing and spreads them
    marked = found.withColumn("__traced", traces).withColumn("__row", F.when(F.col("__traced"), F.xxhash64("__text")).otherwise(-1 - F.monotonically_increasing_id()))
    some = (
        marked.where("__traced")
        .select(F.col("__row").alias("row_id"), F.col("__text").alias("t"), F.concat("__base", weak_spans(F.col("__text"))).alias("all"))
        .where(F.size("all") > 1)
        .select("row_id", "all", scope_starts(F.col("t")).alias("scopes"))
    )
    scope = F.size(F.filter("scopes", lambda s: s <= F.col("p.start")))
    parts = stored(
        some.select("row_id", "scopes", F.explode("all").alias("p")).select("row_id", scope.alias("scope"), "p.kind", "p.start", "p.end").distinct(), "credential-parts"
    )
    extra = stored(linked(parts, reach).groupBy(F.col("row_id").alias("__id")).agg(F.collect_set(F.struct("start", "kind", "end")).alias("__extra")), "linked-parts")
    return (
        marked.join(extra, F.col("__traced") & (marked["__row"] == extra["__id"]), "left")
        .select("__doc.*", "__text", "__base", F.sort_array(F.concat("__base", F.coalesce("__extra", F.array().cast(_NO_SPANS)))).alias("__spans"))
    )


def listed(found: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redact(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """The documents with `[kind]` in place of every finding; findings that overlap become one place."""
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole"), "text")
    names = F.array(*(F.lit(f"[{k}]") for k in KINDS))

    def step(acc: Column, s: Column) -> Column:
        before = F.substring(F.col("__text"), (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        grown = F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(before, F.get(names, s["kind"])))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), grown.alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))
    tail = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(F.col("__text"), (acc["at"] + 1).cast("int"), F.length(F.col("__text"))))
    text = F.when(F.col("whole.text").isNull(), F.lit(None).cast("string")).when(F.size("__spans") == 0, F.col("__text")).otherwise(F.aggregate("__spans", start, step, tail))
    return scan(whole, reach).select(*(text.alias(c) if c == "text" else F.col(f"whole.`{c}`").alias(c) for c in docs.columns))
