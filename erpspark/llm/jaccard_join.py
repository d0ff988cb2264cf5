"""Exact Jaccard join of word n-grams by a partition of the n-gram universe.

If two sets are similar enough, their symmetric difference has at most H elements. Hashing every n-gram to
one of m segments cuts both sets alike, and each differing element spoils one segment only. So among any
segments that together can stand H + 1 spoilt ones, one is nearly whole in both: a segment that must agree exactly
stands one, a segment that may differ by one element stands two. Sets are grouped in size bands, which share m.

- A set is indexed with all segments of its band. Segments that may differ by one are indexed with their
  one-deletion neighbourhood too (the segment without each of its elements).
- A set looks for smaller ones of its own band and of the bands below that similar sets can lie in. Spark counts
  the sets per segment; a segment that no other set has costs nothing, and a set with enough of those has no
  similar smaller set at all. Otherwise it uses as many more as it needs, those that the fewest sets have.
- Per band the number of exact and of one-deletion segments is the cheapest by a cost of written rows and of
  chance matches: one-deletion segments for small sets, exact ones for large.

Rows that meet in a segment are candidates. Equal sets are one candidate. Candidates are verified by all n-grams of the whole
texts, as lists written once per set. To find the groups without listing all pairs inside them, each bucket first compares its members
with one of them; after the components of these links are known, only members of different components that still
share a bucket go on. Every link either is verified or lies inside a component already.

Sets that go on after `SEGMENT_ROUNDS` rounds are crowded together without linking (copies with too many changes share segments of what
was not changed). They meet anew, by their rare n-grams: ordered by the number of these sets that have them, two similar sets
share one of the first few n-grams of each, so early that enough are left to share after it. What a copy changed stands first in its
order and is shared with nobody. All pairs of different components that meet so are compared at last.

Defined results: no word, null or empty text: an empty set, linked with nothing; fewer words than n: the
whole sequence is the only n-gram; equal doc_ids are kept as separate rows; rows with a null doc_id are returned with a
null component; other columns are ignored. Elements and sets are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from erpspark.llm.components import components
from erpspark.llm.scratch import stored
from erpspark.llm.words import block_words, in_blocks, mix, sequence_hashes

WORDS = 5
PERCENT = 80
#: Upper size of a band over its lower size.
BAND_RATIO = 1.5
#: Written rows that one chance match is worth.
CHANCE_COST = 40
#: Compare-with-one rounds by segments, and in all, by rare n-grams, before all remaining pairs of different components are compared.
SEGMENT_ROUNDS, ROUNDS = 2, 4
#: A further round is made only where that leaves more pairs than so many per remaining row.
PAIRS_PER_ROW = 4

_FLAGS = np.uint64(3)


def difference(percent: int, sizes: int) -> int:
    """Largest symmetric difference of two sets of `sizes` elements together whose Jaccard similarity reaches percent."""
    return (100 - percent) * sizes // (100 + percent)


@lru_cache(maxsize=None)
def band_of(size: int) -> int:
    low, band = 1, 0
    while (after := max(low + 1, int(low * BAND_RATIO))) <= size:
        low, band = after, band + 1
    return band


@lru_cache(maxsize=None)
def band_range(band: int) -> tuple[int, int]:
    low = 1
    for _ in range(band):
        low = max(low + 1, int(low * BAND_RATIO))
    return low, max(low + 1, int(low * BAND_RATIO)) - 1


@lru_cache(maxsize=None)
def allocation(band: int, percent: int) -> tuple[int, int]:
    """Numbers of exact and of one-deletion segments of a band (the one-deletion ones come last)."""
    low, high = band_range(band)
    need = difference(percent, high + 100 * high // percent) + 1
    if need == 1:
        return 1, 0
    best = None
    for loose in range(min((need + 1) // 2, 64) + 1):  # more never pay
        exact = max(0, need - 2 * loose)
        if exact:  # some to choose from, so that small segments can be left out
            exact += max(1, need // 20)
        held = low / (exact + loose)
        cost = exact + loose * (1 + held) + CHANCE_COST * (exact * math.exp(-held) + loose * (1 + held) * math.exp(-held))
        if best is None or cost < best[0]:
            best = cost, exact, loose
    return best[1], best[2]


def _segments(tokens: np.ndarray, band: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int]:
    """Segment of each element, and sum and number of elements per segment."""
    exact, loose = allocation(band, percent)
    m = exact + loose
    at = (mix(tokens ^ np.uint64((band + 1) * 0x5851F42D4C957F2D & 0xFFFFFFFFFFFFFFFF)) % np.uint64(m)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    count = np.bincount(at, minlength=m)
    sums = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(mix(tokens)[order], out=sums[1:])
    ends = np.cumsum(count)
    return at, sums[ends] - sums[ends - count], count, exact, m


def _signature(band: int, segment: np.ndarray, total: np.ndarray, count: np.ndarray) -> np.ndarray:
    return mix(total + mix((segment + (band << 32)).astype(np.uint64)) + mix(count.astype(np.uint64) + np.uint64(0x1000)))


def signatures(tokens: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Per band: signatures of a set, their segments (`place` codes: band, what the set needs there, segment) and whether they are its index (1) or not (0)."""
    size = len(tokens)
    own = band_of(size)
    for band in range(own, -1, -1):
        high = band_range(band)[1]
        if 100 * min(high, size) < percent * size:
            break
        at, total, count, exact, m = _segments(tokens, band, percent)
        need = difference(percent, size + min(high, size)) + 1
        segment = np.arange(m)
        sig, place = _signature(band, segment, total, count), segment
        loose = at >= exact
        if loose.any():
            near = at[loose]
            sig = np.concatenate((sig, _signature(band, near, total[near] - mix(tokens[loose]), count[near] - 1)))
            place = np.concatenate((place, near))
        yield sig, place + ((band << 52) | (need << 26)), int(band == own)


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Distinct n-gram hashes of a text's word hashes, ascending; a shorter text is one n-gram."""
    if not len(words):
        return np.empty(0, np.uint64)
    length = min(n, len(words))
    return np.unique(mix(sequence_hashes(words, length) + np.uint64(length)))


def set_id(tokens: np.ndarray) -> np.uint64:
    """Hash of a set; the two lowest bits are free for flags."""
    with np.errstate(over="ignore"):
        return mix(np.array([mix(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))]))[0] & ~_FLAGS


def _blocks(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    for first, texts in in_blocks(column):
        words, begins = block_words(texts, lower=True)
        for i in range(len(texts)):
            yield first + i, ngrams(words[begins[i] : begins[i + 1]], n)


_SIGNED = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("n", pa.int64()), ("set", pa.int64())])
_ROW = pa.schema([("sig", pa.int64()), ("place", pa.int64()), ("item", pa.int64())])


def _sign(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sets = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.uint64)
            for i, tokens in _blocks(batch.column(2), n):
                sizes[i], sets[i] = len(tokens), set_id(tokens)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(sizes), pa.array(sets.view(np.int64))], schema=_SIGNED)

    return run


def _emit(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies within the partition write their rows once
        for batch in batches:
            rows, held = ([], [], []), 0

            def flush(rows=rows):
                out = pa.record_batch([pa.array(np.concatenate(x)) for x in rows], schema=_ROW)
                for x in rows:
                    x.clear()
                return out

            for _, tokens in _blocks(batch.column(0), n):
                if not len(tokens) or (own := set_id(tokens)) in seen:
                    continue
                seen.add(own)
                for sig, place, indexed in signatures(tokens, percent):
                    for x, values in zip(rows, (sig.view(np.int64), place, np.full(len(sig), own | np.uint64(indexed)).view(np.int64)), strict=True):
                        x.append(values)
                    held += len(sig)
                if held > 200_000:
                    yield flush()
                    held = 0
            if held:
                yield flush()

    return run


def _gram_lists(n: int):
    """The n-grams of each set, ascending, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, tokens in _blocks(batch.column(1), n):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([tokens.tobytes()], pa.binary())], names=["set", "grams"])

    return run


def _each_gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for own, grams in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            values = np.frombuffer(grams.as_buffer(), np.int64)
            size = len(values)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(size, own, np.int64)), pa.array(values), pa.array(np.full(size, size, np.int32))], names=["set", "gram", "n"])


def _rare(lists: DataFrame, percent: int) -> DataFrame:
    """Rows (sig, set, indexed, probe, n, at): for every set those n-grams by which it meets all similar sets.

    `at` is the place of the n-gram in the set's order, rare ones first. The larger of two similar sets meets the smaller one, which needs
    fewer places.
    """
    grams = stored(lists.mapInArrow(_each_gram, "set long, gram long, n int"), "grams")
    shared = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    order = Window.partitionBy("set").orderBy(F.coalesce("f", F.lit(1)), "gram")  # the n-grams of one set
    placed = grams.join(shared, "gram", "left").withColumn("at", F.row_number().over(order))
    larger = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1
    smaller = F.col("n") - F.ceil(F.lit(2 * percent) * F.col("n") / (100 + percent)) + 1
    rows = placed.where(F.col("f").isNotNull() & (F.col("at") <= larger))
    return rows.select(F.col("gram").alias("sig"), "set", (F.col("at") <= smaller).alias("indexed"), F.lit(True).alias("probe"), "n", "at")


def _enough_left(percent: int) -> Column:
    """Whether two sets that first meet at these places can still share as many n-grams as similar sets do."""
    most = 1 + F.least(F.col("n") - F.col("at"), F.col("n_b") - F.col("at_b"))
    return (F.col("n_b") <= F.col("n")) & ((100 + percent) * most >= percent * (F.col("n") + F.col("n_b")))


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (a, b) in enumerate(zip(batch.column("grams_a"), batch.column("grams_b"), strict=True)):
                left, right = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                shared = len(np.intersect1d(left, right, assume_unique=True))
                if 100 * shared >= percent * (len(left) + len(right) - shared):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([c.take(pa.array(keep, pa.int64())) for c in (batch.column("a"), batch.column("b"))], names=["a", "b"])

    return run


def _links(pairs: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of sets that are similar enough, by all their n-grams."""
    right = pairs.join(lists.select(F.col("set").alias("b"), F.col("grams").alias("grams_b")), "b")
    both = right.join(lists.select(F.col("set").alias("a"), F.col("grams").alias("grams_a")), "a")
    return both.select("a", "b", "grams_a", "grams_b").mapInArrow(_verify(percent), "a long, b long")


def _pairs(left: str, right: str) -> list:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


def _starred(rows: DataFrame, seed: int) -> DataFrame:
    """Pairs of every bucket's member of least rank with its others that lie in other components."""
    rank = F.struct(F.xxhash64("set", F.lit(seed)).alias("r"), F.col("set"), F.col("label"))
    centres = rows.groupBy("sig").agg(F.min(rank).alias("c"))
    return rows.join(centres, "sig").where(F.col("label") != F.col("c.label")).select(*_pairs("set", "c.set")).distinct()


def _meeting(rows: DataFrame) -> DataFrame:
    """Rows whose signature an index row of another set has, or that are such index rows: with `others`, the index rows of other sets."""
    bucket = Window.partitionBy("sig")
    indexed = F.col("item").bitwiseAND(F.lit(1))
    once = rows.withColumn("copy", F.lag("item").over(bucket.orderBy("item"))).where(F.col("copy").isNull() | (F.col("copy") != F.col("item")))
    counted = once.withColumns({"held": F.count(F.lit(1)).over(bucket), "index": F.sum(indexed).over(bucket)}).where("held > 1 and index > 0")
    return counted.select("sig", "place", F.col("item").bitwiseAND(F.lit(~3)).alias("set"), (indexed == 1).alias("indexed"), (F.col("index") - indexed).alias("others"))


def _probing(met: DataFrame, percent: int) -> DataFrame:
    """The meeting rows with `probe`: whether the set uses them to look for others. Buckets that no set uses are left out."""
    bands = [allocation(b, percent) for b in range(64)]
    exact, whole = (F.array(*[F.lit(x) for x in v]) for v in ([e for e, _ in bands], [e + 2 * k for e, k in bands]))
    band, need, segment = (F.col("place").bitwiseAND(F.lit(mask)) for mask in (0x7FF << 52, 0x3FFFFFF << 26, 0x3FFFFFF))
    band, need = F.shiftright(band, 52).cast("int"), F.shiftright(need, 26)
    stands = F.when(segment >= F.get(exact, band), F.lit(2)).otherwise(F.lit(1))
    costs = met.where("others > 0").groupBy("set", "place").agg(F.sum("others").alias("cost"))
    costs = costs.select("set", "place", "cost", band.alias("band"), need.alias("need"), stands.alias("stands"))
    one = Window.partitionBy("set", "band")  # the segments of one set
    before = F.coalesce(F.sum("stands").over(one.orderBy("cost", "place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # what its segments without any other set cannot stand
    left = F.col("need") - (F.get(whole, F.col("band")) - F.sum("stands").over(one))
    used = costs.withColumns({"before": before, "left": left}).where("before < left").select("set", "place", F.lit(True).alias("used"))
    flagged = met.join(used, ["set", "place"], "left").select("sig", "set", "indexed", (F.coalesce("used", F.lit(False)) & (F.col("others") > 0)).alias("probe"))
    live = flagged.groupBy("sig").agg(F.bool_or("probe").alias("live")).where("live").select("sig")
    return flagged.join(live, "sig")


def similar_sets(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Signed documents (doc_id, mark, n, set) and edges (a, b) that span the components of the sets."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("mark"), F.col("text").cast("string").alias("text"))
    signed = stored(texts.mapInArrow(_sign(n), "doc_id long, mark long, n long, set long"), "signed")
    rows = texts.where("doc_id is not null").select("text").mapInArrow(_emit(n, percent), "sig long, place long, item long")
    met = stored(_probing(stored(_meeting(rows), "meeting"), percent), "met")
    # rows without a doc_id can be joined by nothing, so they speak for no set
    wanted = signed.where("doc_id is not null").join(met.select("set").distinct(), "set", "left_semi").groupBy("set").agg(F.min(F.struct("doc_id", "mark")).alias("d"))
    wanted = wanted.select("set", F.col("d.doc_id").alias("doc_id"), F.col("d.mark").alias("mark"))
    chosen = texts.join(wanted, ["doc_id", "mark"]).select("set", "text").dropDuplicates(["set"])
    held = stored(chosen.mapInArrow(_gram_lists(n), "set long, grams binary"), "candidate-grams")

    met = met.withColumns({"n": F.lit(None).cast("int"), "at": F.lit(None).cast("int")})
    left = met.withColumn("label", F.col("set"))
    links, tried = None, None  # links: those found so far, as edges to the smallest set of each component
    for turn in range(ROUNDS + 1):
        sums = left.groupBy("sig").agg(F.count(F.lit(1)).alias("k"), F.count_if("probe").alias("p")).agg(F.sum("k"), F.sum(F.col("k") * F.col("p"))).first()
        last = turn == ROUNDS or not sums[0] or (turn > 0 and sums[1] <= PAIRS_PER_ROW * sums[0])
        if last:
            other = left.where("indexed").select("sig", *[F.col(c).alias(f"{c}_b") for c in ("set", "label", "n", "at")])
            both = left.where("probe").join(other, "sig").where("label != label_b")
            pairs = both.where(F.coalesce(_enough_left(percent), F.lit(True))).select(*_pairs("set", "set_b")).distinct()
        else:
            pairs = _starred(left, turn)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = stored(_links(pairs, held, percent), "links")
        if last:
            return signed, found if links is None else links.unionByName(found)
        labels = stored(components(found if links is None else links.unionByName(found)), "labels")
        links = labels.where("node != label").select(F.col("label").alias("a"), F.col("node").alias("b"))
        left = _still_mixed(met, labels)
        if turn + 1 == SEGMENT_ROUNDS:
            met = stored(_rare(held.join(left.select("set").distinct(), "set", "left_semi"), percent), "rare")
            left = _still_mixed(met, labels)


def _still_mixed(met: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of buckets whose sets lie in different components, with those (label)."""
    named = met.join(labels.withColumnRenamed("node", "set"), "set", "left").withColumn("label", F.coalesce("label", "set"))
    mixed = named.groupBy("sig").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l < h").select("sig")
    return stored(named.join(mixed, "sig"), "left-over")


def groups(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, mark (hash of the text), n_shingles and component_id per row of the documents."""
    signed, links = similar_sets(docs, n, percent)
    labels = stored(components(links), "labels").withColumnRenamed("node", "set")
    # an empty set belongs to no group, a null doc_id neither
    named = stored(signed.where("doc_id is not null and n > 0").join(labels, "set", "left").withColumn("label", F.coalesce("label", "set")).select("doc_id", "mark", "n", "label"), "named")
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    grouped = named.join(least, "label").select("doc_id", "mark", F.col("n").alias("n_shingles"), "component_id")
    alone = signed.where("doc_id is null or n = 0").select("doc_id", "mark", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return grouped.unionByName(alone)


def keep_first(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents without those that have a smaller doc_id in their group; rows with a null doc_id stay."""
    gone = groups(docs, n, percent).where("component_id < doc_id").select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")).distinct()
    return docs.join(gone, (docs["doc_id"].cast("long") == gone["__id"]) & (F.xxhash64(docs["text"].cast("string")) == gone["__mark"]), "left_anti")
