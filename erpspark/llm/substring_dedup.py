"""Removal of word passages that also start in an earlier document.

A window is a run of 50 consecutive words. Windows are Rabin-Karp hashed; which of them recur is found
by counting in Spark, without moving a row per window:

1. Every window has an anchor: the smallest hash among its runs of 16 words (the leftmost of equals).
   Equal windows have equal anchors. Consecutive windows with one anchor form a stretch; one row per
   stretch goes to the count: anchor hash, hash of the whole stretch, place. Anchors of one document only
   drop out.
2. Equal stretches: all but those of the smallest document are covered by removable windows whole.
3. What is left are the first stretches of each kind whose anchor has several kinds (the ends of
   passages). Only for these the single windows are hashed and counted.
4. Repeated windows merge into maximal intervals per document, which the last pass removes.

Counts combine before the shuffle, and hits come back by joins that adaptive execution can split, so a
passage that a third of all documents share stays spread. Two windows count as equal when both their
64-bit anchor hash and their 64-bit window hash are.

Defined results: null text has no words; rows with a null doc_id lose nothing and take nothing from others;
rows with one doc_id are one document (each text judged with its own places); fewer than 50 words: unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from erpspark.llm.scratch import aside, stored
from erpspark.llm.words import block_words, in_blocks, mix, sequence_hashes, text_bytes, word_hashes

WINDOW = 50
ANCHOR = 16

_LOW = np.uint64(0xFFFFFFFF)


def anchors(sub: np.ndarray, span: int) -> np.ndarray:
    """For every run of `span` values: place of the smallest (by its upper half, then leftmost)."""
    low = (sub & ~_LOW) | np.arange(len(sub), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if span > width:
        low = np.minimum(low[: -(span - width)], low[span - width :])
    return (low & _LOW).astype(np.int64)


def _stretches(words: np.ndarray, begins: np.ndarray, window: int, anchor: int):
    """Stretches of equal anchor over texts that lie one after another: text, first window in the text, windows, anchor and stretch hash."""
    n = len(words) - window + 1
    if n <= 0:
        return None
    sub = sequence_hashes(words, anchor)
    at = anchors(sub, window - anchor + 1)
    text = np.searchsorted(begins, np.arange(n), "right") - 1
    valid = np.arange(n) + window <= begins[text + 1]
    starts = np.flatnonzero(valid)
    if not len(starts):
        return None
    first = np.concatenate(([True], (at[starts[1:]] != at[starts[:-1]]) | (text[starts[1:]] != text[starts[:-1]])))
    heads = np.flatnonzero(first)
    count = np.diff(np.concatenate((heads, [len(starts)])))
    begin = starts[heads]
    # the whole stretch as one hash: both outer windows, its length and where its anchor lies
    whole = sequence_hashes(words, window)
    kind = mix(mix(whole[begin]) + whole[begin + count - 1] + mix((count * 4096 + at[begin] - begin).astype(np.uint64)))
    return text[begin], begin - begins[text[begin]], count, sub[at[begin]], kind, whole, begin


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


_STRETCH = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("start", pa.int64()), ("n", pa.int32()), ("anchor", pa.int64()), ("kind", pa.int64())])


def _find_stretches(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column(0), batch.column(1)
            ids_np, marks_np = ids.fill_null(0).to_numpy(zero_copy_only=False), marks.to_numpy(zero_copy_only=False)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            for first, texts in in_blocks(batch.column(2)):
                words, begins = block_words(texts)
                found = _stretches(words, begins, window, anchor)
                if found is None:
                    continue
                text, start, count, anchor_hash, kind, _, _ = found
                row = first + text
                keep = known[row]
                yield pa.record_batch(
                    [pa.array(ids_np[row][keep]), pa.array(marks_np[row][keep]), pa.array(start[keep]), pa.array(count[keep].astype(np.int32)), _signed(anchor_hash[keep]), _signed(kind[keep])],
                    schema=_STRETCH,
                )

    return run


_WINDOW = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("start", pa.int64()), ("anchor", pa.int64()), ("hash", pa.int64())])


def _edge_windows(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(text_bytes(batch.column("text"))):
                spans = batch.column("edges")[i].as_py()
                words, _, _ = word_hashes(text)
                hashes = sequence_hashes(words, window)
                start = np.concatenate([np.arange(s["start"], s["start"] + s["n"]) for s in spans])
                anchor_hash = np.repeat(np.array([s["anchor"] for s in spans], np.int64), [s["n"] for s in spans])
                n = len(start)
                yield pa.record_batch(
                    [pa.array(np.full(n, batch.column("doc_id")[i].as_py())), pa.array(np.full(n, batch.column("mark")[i].as_py())), pa.array(start), pa.array(anchor_hash), _signed(hashes[start])],
                    schema=_WINDOW,
                )

    return run


def _remove(digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            for text, cut in zip(text_bytes(batch.column("__text")), batch.column("__cut"), strict=True):
                words = text.split()
                total.append(len(words))
                if cut.is_valid:
                    steps = np.zeros(len(words) + 1, np.int64)
                    for s in cut.as_py():
                        steps[s["start"]] += 1
                        steps[s["end"]] -= 1
                    stay = np.cumsum(steps)[:-1] == 0
                    words = [words[i] for i in np.flatnonzero(stay)]
                removed.append(total[-1] - len(words))
                out = b" ".join(words)
                kept.append(hashlib.sha256(out).hexdigest() if digest else out.decode("utf-8", "replace"))
            keep = [n for n in batch.schema.names if n not in ("__text", "__cut")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in keep), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=[*keep, "__n_words", "__n_removed", "__kept"],
            )

    return run


def repeated_intervals(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, mark (hash of the text) and `cut`: intervals [start, end) of words that repeated windows cover, per document that has any."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("mark"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, mark long, start long, n int, anchor long, kind long"
    every = stored(texts.mapInArrow(_find_stretches(window, anchor), schema), "stretches")
    shared = every.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.min("kind").alias("kind_low"), F.max("kind").alias("kind_high")).where("low < high")
    hits = stored(every.join(shared.select("anchor", (F.col("kind_low") < F.col("kind_high")).alias("mixed")), "anchor"), "shared-stretches")
    first = hits.groupBy("anchor", "kind").agg(F.min("doc_id").alias("first_id"))
    judged = stored(hits.join(first, ["anchor", "kind"]).where(F.col("mixed") | (F.col("doc_id") > F.col("first_id"))), "judged-stretches")
    whole = judged.where("doc_id > first_id").select("doc_id", "mark", "start", (F.col("start") + F.col("n") + (window - 1)).alias("end"))
    edges = judged.where("doc_id = first_id").groupBy("doc_id", "mark").agg(F.collect_set(F.struct("start", "n", "anchor")).alias("edges"))
    distinct_texts = texts.join(edges, ["doc_id", "mark"])
    single = stored(distinct_texts.mapInArrow(_edge_windows(window, anchor), "doc_id long, mark long, start long, anchor long, hash long"), "edge-windows")
    earliest = single.groupBy("anchor", "hash").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).where("first_id < last_id").drop("last_id")
    part = single.join(earliest, ["anchor", "hash"]).where("doc_id > first_id").select("doc_id", "mark", "start", (F.col("start") + window).alias("end"))
    return whole.unionByName(part).groupBy("doc_id", "mark").agg(F.collect_set(F.struct("start", "end")).alias("cut"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, digest: bool = False) -> DataFrame:
    """The input's columns but `text`, and `__n_words`, `__n_removed`, `__kept` (kept words joined by one space, or the SHA-256 of that)."""
    cut = repeated_intervals(docs, window, anchor).select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"), F.col("cut").alias("__cut"))
    outputs = ["__n_words", "__n_removed", "__kept"]
    named, inner = aside(docs, "text", outputs)
    same = (named[inner["doc_id"]].cast("long") == cut["__id"]) & (F.xxhash64(named["__text"]) == cut["__mark"])
    joined = named.join(cut, same, "left").drop("__id", "__mark")
    schema = ", ".join([*(f"{n} {named.schema[n].dataType.simpleString()}" for n in inner.values()), "__n_words long, __n_removed long, __kept string"])
    return joined.mapInArrow(_remove(digest), schema).toDF(*inner, *outputs)
