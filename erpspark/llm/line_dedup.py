"""Line dedup against an index of recurring line hashes.

Every long line of a document gives two 64-bit hashes. Spark counts the documents per hash pair; the
pairs found in enough documents are dealt to shards, and each shard gets a minimal perfect hash whose
slots carry three flat arrays: the second hash as fingerprint, the number of documents and the largest
doc_id. Line hashes of the documents are routed to the shards and probe the arrays, so no line is ever
joined with a line, and texts are only brought together with the hashes that they lose.

Skew: documents per hash are counted with map-side partial sums; the probes are counted per shard, and those of a
shard are dealt to as many tasks as their number needs, each with a copy of the shard's arrays, so a line that stands
in a third of all documents is spread.

Defined results: null or empty text is one empty line; duplicate doc_ids count as one document; rows with
a null doc_id are returned unchanged and do not count; a line that recurs inside its largest document
stays there each time; bytes that are no UTF-8 become replacement characters where texts are given back; other columns of
the input are kept whatever their names, but for those named as an output, which give way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from erpspark.llm.scratch import aside, stored
from erpspark.llm.words import SPACES, mix, text_bytes

MIN_CHARS = 40
MIN_DOCS = 5
#: Keys per shard and probes per task: both bound the memory of a task, not what is looked up.
SHARD_KEYS = 100_000
TASK_PROBES = 400_000

_PROBE = pa.schema([("doc_id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])


def line_key(line: bytes) -> bytes:
    """The line without ASCII white space at its ends, A-Z in lower case."""
    return line.strip(SPACES).lower()


def _hashes(key: bytes) -> tuple[int, int]:
    digest = xxhash.xxh3_128_intdigest(key)
    return digest >> 64, digest & 0xFFFFFFFFFFFFFFFF


def _long_key(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars)


def _line_hashes(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, h1, h2 = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                if doc_id is not None and len(text) >= min_chars:
                    found = {_hashes(k) for k in map(line_key, text.split(b"\n")) if _long_key(k, min_chars)}
                    ids += [doc_id] * len(found)
                    for a, b in found:
                        h1.append(a)
                        h2.append(b)
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), *(pa.array(np.array(h, np.uint64).view(np.int64)) for h in (h1, h2))], schema=_PROBE
            )

    return run


# --- the minimal perfect hash of a shard -------------------------------------------------------


def _level(keys: np.ndarray, seed: int, size: int) -> np.ndarray:
    return (mix(keys ^ mix(np.array([seed + 1], np.uint64))) % np.uint64(size)).astype(np.int64)


def build_mph(keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Levels of bits and the slot of every key: a key takes the bit of the first level where no other key falls on it.

    Slots number the set bits through all levels, so they are 0..len(keys)-1. Keys must be distinct.
    """
    levels: list[np.ndarray] = []
    slots = np.empty(len(keys), np.int64)
    left, first = np.arange(len(keys)), 0
    while len(left):
        size = max(64, 2 * len(left))
        at = _level(keys[left], len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        ranks = np.cumsum(alone) - 1
        done = alone[at]
        slots[left[done]] = first + ranks[at[done]]
        levels.append(alone)
        first += int(alone.sum())
        left = left[~done]
    return levels, slots


def probe_mph(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Slot of each key (-1: surely not among the keys; other strangers get some slot, which the fingerprint tells apart)."""
    slots = np.full(len(keys), -1, np.int64)
    left, first = np.arange(len(keys)), 0
    for seed, bits in enumerate(levels):
        at = _level(keys[left], seed, len(bits))
        hit = bits[at]
        slots[left[hit]] = first + (np.cumsum(bits) - 1)[at[hit]]
        first += int(bits.sum())
        left = left[~hit]
    return slots


_SHARD = "shard long, seed long, level_bits array<long>, bits binary, fingerprints binary, counts binary, keepers binary"


def _shard_keys(h1: np.ndarray, h2: np.ndarray, seed: int) -> np.ndarray:
    """One key of both hashes; the pairs that share a key differ from seed to seed."""
    return mix(h1.view(np.uint64) ^ mix(np.array([seed], np.uint64))) ^ h2.view(np.uint64)


def _build_shard(table: pa.Table) -> pa.Table:
    col = {n: table.column(n).to_numpy() for n in ("h1", "h2", "n_docs", "keeper")}
    # two pairs of hashes may give one key: then all are keyed anew by the next seed
    seed = 0
    while len(np.unique(keys := _shard_keys(col["h1"], col["h2"], seed))) < len(keys):
        seed += 1
    levels, slots = build_mph(keys)
    arrays = []
    for name, kind in (("h2", np.int64), ("n_docs", np.int64), ("keeper", np.int64)):
        out = np.empty(len(keys), kind)
        out[slots] = col[name]
        arrays.append(out.tobytes())
    return pa.table(
        {
            "shard": [table.column("shard")[0].as_py()],
            "seed": [seed],
            "level_bits": pa.array([[len(x) for x in levels]], pa.list_(pa.int64())),
            "bits": [np.packbits(np.concatenate(levels)).tobytes()],
            "fingerprints": [arrays[0]],
            "counts": [arrays[1]],
            "keepers": [arrays[2]],
        }
    )


def _probe_shard(min_docs: int):
    def run(probes: pa.Table, shards: pa.Table) -> pa.Table:
        empty = pa.table({n: pa.array([], pa.int64()) for n in _PROBE.names}, schema=_PROBE)
        if not probes.num_rows or not shards.num_rows:
            return empty
        row = shards.slice(0, 1).to_pylist()[0]
        ends = np.cumsum(row["level_bits"])
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[: ends[-1]].astype(bool)
        levels = np.split(bits, ends[:-1])
        marks, counts, keepers = (np.frombuffer(row[n], np.int64) for n in ("fingerprints", "counts", "keepers"))
        doc, h1, h2 = (probes.column(n).to_numpy() for n in _PROBE.names)
        slots = probe_mph(levels, _shard_keys(h1, h2, row["seed"]))
        hit = slots >= 0
        at = slots[hit]
        drop = np.flatnonzero(hit)[(marks[at] == h2[hit]) & (counts[at] >= min_docs) & (keepers[at] != doc[hit])]
        return probes.select(_PROBE.names).take(pa.array(drop))

    return run


def _drop_lines(min_chars: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, dropped, kept = [], [], []
            for text, lost in zip(text_bytes(batch.column("__text")), batch.column("__lost"), strict=True):
                parts = text.split(b"\n")
                left = parts
                if lost.is_valid:
                    gone = {(x["h1"] & 0xFFFFFFFFFFFFFFFF, x["h2"] & 0xFFFFFFFFFFFFFFFF) for x in lost.as_py()}
                    left = [p for p in parts if not (_long_key(k := line_key(p), min_chars) and _hashes(k) in gone)]
                out = b"\n".join(left)
                lines.append(len(parts))
                dropped.append(len(parts) - len(left))
                kept.append(hashlib.sha256(out).hexdigest() if digest else out.decode("utf-8", "replace"))
            keep = [n for n in batch.schema.names if n not in ("__text", "__lost")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in keep), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())],
                names=[*keep, "__n_lines", "__n_dropped", "__kept"],
            )

    return run


def lost_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id and the hash pairs of the lines it loses, one row per document that loses any."""
    probes = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_line_hashes(min_chars), "doc_id long, h1 long, h2 long"), "line-hashes")
    keys = (
        probes.groupBy("h1", "h2").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("keeper")).where(F.col("n_docs") >= min_docs)
    )
    keys = stored(keys, "line-keys")
    shards = max(1, -(-keys.count() // SHARD_KEYS))
    shard = F.pmod(F.xxhash64("h1"), F.lit(shards)).alias("shard")
    # one row per shard: the number of tasks that its probes need
    copies = stored(probes.groupBy(shard).agg(F.ceil(F.count(F.lit(1)) / TASK_PROBES).cast("int").alias("copies")), "shard-copies")
    index = keys.select("*", shard).groupBy("shard").applyInArrow(_build_shard, _SHARD).join(copies, "shard")
    index = index.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    dealt = probes.select("*", shard).join(copies, "shard").withColumn("copy", F.pmod(F.xxhash64("doc_id"), F.col("copies")).cast("int")).drop("copies")
    lost = dealt.groupBy("shard", "copy").cogroup(index.groupBy("shard", "copy")).applyInArrow(_probe_shard(min_docs), "doc_id long, h1 long, h2 long")
    return lost.groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("lost"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, digest: bool = False) -> DataFrame:
    """The input's columns and `__n_lines`, `__n_dropped`, `__kept`.

    `__kept` is the text that stays, or its SHA-256 when `digest` is true; `text` itself is only passed on
    when it is not digested (the caller overwrites or drops it).
    """
    lost = lost_lines(docs, min_chars, min_docs).select(F.col("doc_id").alias("__id"), F.col("lost").alias("__lost"))
    outputs = ["__n_lines", "__n_dropped", "__kept"]
    named, inner = aside(docs, "text", outputs)
    joined = named.join(lost, named[inner["doc_id"]].cast("long") == lost["__id"], "left").drop("__id")
    schema = ", ".join([*(f"{n} {named.schema[n].dataType.simpleString()}" for n in inner.values()), "__n_lines long, __n_dropped long, __kept string"])
    return joined.mapInArrow(_drop_lines(min_chars, digest), schema).toDF(*inner, *outputs)
