"""SimHash near-duplicates: groups of fingerprints that differ in few bits, found with vantage-point trees.

A fingerprint has a bit set where more than half of a text's word shingles have it in their hash. Bits that differ are a
metric, so a point v and a radius r cut all fingerprints into those within r of v and those beyond, and two
fingerprints at most `REACH` apart on different sides both lie within `REACH` of the border. So only the inner points
within `REACH` of the border visit the outer side as guests, and a guest visits only sides that its own distance
does not rule out (triangle bounds).

- The upper levels of the tree are chosen on a bounded sample of fingerprints; they only deal the work. Every distinct
  fingerprint is at home in one leaf, its shard, and a guest in the shards beyond borders that it is near to.
- Each shard goes on cutting in the same way until comparing directly costs less. Where many points lie within `REACH` of the
  vantage point they are linked to it and not compared among themselves.
- A shard returns a spanning forest of its links, not the links, so a group of near copies costs rows in proportion to
  its size. Components of all forests are the groups.

Copies are one fingerprint throughout. No candidate is capped: links are exact.

Defined results: null or empty texts, or texts without words, have fingerprint zero, which links like any other; texts of
fewer words than a shingle are one shingle. Rows with a null doc_id take part but give no id; a group without any id
has a null component. Equal doc_ids are rows each. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from erpspark.llm.components import components
from erpspark.llm.scratch import stored

WORDS = 3
SEED = 42
REACH = 3
#: Distinct fingerprints per shard, about; the sample that the upper levels are chosen on, and the least part of it that is cut further; tried vantage points per cut.
SHARD, SAMPLE, JUDGED, TRIES = 1 << 15, 1 << 14, 32, 8
#: Fewer points than this are compared directly; entries of one comparison; links kept before they are reduced to a forest.
LEAF, MATRIX, LINKS = 192, 1 << 21, 1 << 20
#: Bytes of a text that are split into words at once.
PART = 1 << 20

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _parts(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, in lists of bounded size that start with the last `WORDS` - 1 words of the one before."""
    if len(text) <= PART:
        yield text.translate(_LOWER).split()
        return
    carry, at = [], 0
    while at < len(text):
        end = min(len(text), at + PART)
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        words = carry + text[at:end].translate(_LOWER).split()
        at = end
        if len(words) >= WORDS or at >= len(text):
            yield words
            words = words[1 - WORDS :]
        carry = words


def _hashes(words: list[bytes]) -> np.ndarray:
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends[WORDS - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, ends, strict=False)), np.uint64, len(ends))


def fingerprint(text: bytes | None) -> int:
    """64-bit SimHash of a UTF-8 text."""
    ones, n, few = np.zeros(64, np.int64), 0, []
    for words in _parts(text or b""):
        if len(words) < WORDS:
            few = words
            continue
        for h in np.array_split(_hashes(words), 1 + len(words) // (1 << 16)):
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            n += len(h)
    if not n:
        return xxhash.xxh64_intdigest(b" ".join(few), SEED) if few else 0
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _print_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.fromiter((fingerprint(t.as_buffer().to_pybytes() if t.is_valid else None) for t in batch.column(1)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=["doc_id", "print"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and print (the fingerprint as a signed long) of every row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(_print_texts, "doc_id long, print long")


def distance(points: np.ndarray, v: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ v)


def cut(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """Vantage point and radius of the cut with the fewest points near the border, of those that leave a fifth on each side; None if there is none."""
    best, points = None, points[:: max(1, len(points) // 4096)]  # enough to judge by
    for v in points[:: max(1, len(points) // TRIES)][:TRIES]:
        held = np.bincount(distance(points, v), minlength=66)
        inner = np.cumsum(held)
        for radius in range(REACH, 64):
            least = min(inner[radius], len(points) - inner[radius])
            if 5 * least >= len(points):
                near = (inner[radius] - inner[radius - REACH]) / least
                if best is None or near < best[0]:
                    best = near, v, radius
    return None if best is None else (best[1], best[2])


def upper_levels(sample: np.ndarray, shards: int) -> list[tuple]:
    """Nodes (vantage point, radius, inner node, outer node), or (None, shard) for leaves; node 0 is the root."""
    nodes: list[tuple] = []

    def grow(points: np.ndarray, wanted: int) -> int:
        at = len(nodes)
        nodes.append(())
        found = cut(points) if wanted > 1 and len(points) > JUDGED else None
        if found is None:
            nodes[at] = (None, at)
            return at
        inside = distance(points, found[0]) <= found[1]
        share = max(1, min(wanted - 1, round(wanted * inside.mean())))
        nodes[at] = (*found, grow(points[inside], share), grow(points[~inside], wanted - share))
        return at

    grow(sample, shards)
    return nodes


def _visits(nodes: list[tuple]):
    """Rows (shard, print, home): one home row per fingerprint, and its visits as a guest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, np.ndarray, bool]] = []

            def go(at: int, homes: np.ndarray, guests: np.ndarray) -> None:
                if nodes[at][0] is None:
                    out.extend((at, x, home) for x, home in ((homes, True), (guests, False)) if len(x))
                    return
                v, radius, inner, outer = nodes[at]
                h, g = distance(homes, v), distance(guests, v)
                go(inner, homes[h <= radius], guests[g <= radius + REACH])
                go(outer, homes[h > radius], np.concatenate((guests[g > radius - REACH], homes[(h <= radius) & (h > radius - REACH)])))

            points = np.asarray(batch.column(0)).view(np.uint64)
            go(0, points, points[:0])
            for shard, values, home in out:
                n = len(values)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, shard, np.int32)), pa.array(values.view(np.int64)), pa.array(np.full(n, home))], names=["shard", "print", "home"])

    return run


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node of the component of each of n nodes under the links (a, b)."""
    label = np.arange(n)
    while True:
        la, lb = label[a], label[b]
        if (la == lb).all():
            return label
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]


class _Shard:
    """Links among the homes of a shard, and of its guests with them."""

    def __init__(self, values: np.ndarray):
        self.values, self.a, self.b, self.held = values, [], [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a.append(a)
        self.b.append(b)
        self.held += len(a)
        if self.held > LINKS:
            self.reduce()

    def reduce(self) -> tuple[np.ndarray, np.ndarray]:
        empty = [np.empty(0, np.int64)]
        label = forest(np.concatenate(empty + self.a), np.concatenate(empty + self.b), len(self.values))
        moved = np.flatnonzero(label != np.arange(len(label)))
        self.a, self.b, self.held = [moved], [label[moved]], 0
        return moved, label[moved]

    def compare(self, homes: np.ndarray, guests: np.ndarray, inside: bool) -> None:
        step = max(1, MATRIX // max(1, len(homes) + len(guests)))
        for i in range(0, len(homes), step):
            rows = homes[i : i + step]
            for others in ((homes[i:], guests) if inside else (guests,)):
                for j in range(0, len(others), MATRIX):
                    x, y = np.nonzero(np.bitwise_count(self.values[rows][:, None] ^ self.values[others[j : j + MATRIX]][None, :]) <= REACH)
                    if len(x):
                        self.add(rows[x], others[j : j + MATRIX][y])

    def work(self, homes: np.ndarray, guests: np.ndarray, inside: bool = True) -> None:
        """All links of homes with guests and, where `inside`, with each other, up to links that follow from others."""
        if not len(homes) or not (inside or len(guests)):
            return
        points = self.values[homes]
        if len(homes) <= LEAF:
            return self.compare(homes, guests, inside)
        if inside:
            tried = [(int((distance(points, v) <= REACH).sum()), i) for i, v in enumerate(points[:: max(1, len(points) // TRIES)][:TRIES])]
            most, at = max(tried)
            if 4 * most >= len(homes):  # a dense group: its members are linked through the vantage point
                v = points[at * max(1, len(points) // TRIES)]
                close = distance(points, v) <= REACH
                dense, rest = homes[close], homes[~close]
                self.add(dense, np.full(len(dense), homes[at * max(1, len(points) // TRIES)]))
                self.work(dense, guests[distance(self.values[guests], v) <= 2 * REACH], False)
                return self.work(rest, np.concatenate((guests, dense)), True)
        found = cut(points)
        if found is None:
            return self.compare(homes, guests, inside)
        v, radius = found
        h, g = distance(points, v), distance(self.values[guests], v)
        inner, outer = homes[h <= radius], homes[h > radius]
        to_inner, to_outer = guests[g <= radius + REACH], guests[g > radius - REACH]
        if inside:
            to_outer = np.concatenate((to_outer, inner[h[h <= radius] > radius - REACH]))
        cost = lambda n, m: n * (n / 2 * inside + m)
        if cost(len(inner), len(to_inner)) + cost(len(outer), len(to_outer)) > 0.9 * cost(len(homes), len(guests)):
            return self.compare(homes, guests, inside)
        self.work(inner, to_inner, inside)
        self.work(outer, to_outer, inside)


def shard_forest(values: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (as two arrays of fingerprints) that connect what the links of the homes connect."""
    # a guest may be sent once only, so values are distinct
    shard = _Shard(values)
    shard.work(np.flatnonzero(home), np.flatnonzero(~home))
    a, b = shard.reduce()
    return values[a], values[b]


def _shard_links(rows: pd.DataFrame) -> pd.DataFrame:
    a, b = shard_forest(rows["print"].to_numpy().view(np.uint64), rows["home"].to_numpy(dtype=bool))
    return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})


def links(prints: DataFrame, shard: int = SHARD) -> DataFrame:
    """Links (a, b) that connect what links of the distinct fingerprints (print) within `REACH` bits connect."""
    n = prints.count()
    shards = min(-(-n // shard), SAMPLE // JUDGED)
    # a bounded sample; it decides where the work goes, not what is found
    sample = [r[0] for r in prints.orderBy(F.xxhash64("print"), "print").limit(SAMPLE).collect()] if shards > 1 else []
    nodes = upper_levels(np.array(sample, np.int64).view(np.uint64), shards)
    visits = prints.select("print").mapInArrow(_visits(nodes), "shard int, print long, home boolean")
    return visits.repartition(max(1, shards), "shard").groupBy("shard").applyInPandas(_shard_links, "a long, b long")


def groups(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """doc_id, print and component_id (the smallest doc_id of the row's group) of every row."""
    printed = stored(fingerprints(docs), "fingerprints")
    prints = stored(printed.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct-prints")
    labels = stored(components(stored(links(prints, shard), "print-links")), "print-labels")
    # only fingerprints with links have a label
    named = labels.join(prints, labels["node"] == prints["print"]).select("print", "label", "least")
    ids = named.join(named.groupBy("label").agg(F.min("least").alias("component_id")), "label").select("print", "component_id")
    alone = prints.join(labels, prints["print"] == labels["node"], "left_anti").select("print", F.col("least").alias("component_id"))
    return printed.join(stored(ids.unionByName(alone), "print-groups"), "print").select("doc_id", "print", "component_id")
