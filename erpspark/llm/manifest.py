"""Merkle manifest of a table: a content-addressed graph of digests, and proofs found by descending it.

Rows are leaves. Per source, leaves ascend by doc_id; every `FANOUT` consecutive nodes of a level become the hash of
their joined digests until one node, the subroot, is left. Subroots, ordered by source, become the root likewise.

- Store: a node is a record digest -> children. `LEVELS` levels of records are written together as one pack under the
  digest of their top node, so a pack has a size bound, however many leaves a source has; packs of packs follow until each
  source has one node. Ranks come from a sort by ranges and the row counts of the ranges.
- Descent: requests for leaves start at the root. The base-`FANOUT` digits of a leaf's rank say which child is taken
  at every level; the children not taken are one path segment each. All requests below one node share the way to it: each
  pack is looked up once, by its digest. Reversed, the segments are the proof from leaf to root.

Texts are hashed where they are read; only digests move.

Defined results: leaves hash doc_id, source, lang, n_chars and text, null as `-`, other columns are ignored. A null doc_id
comes first and is never tampered with; rows of equal doc_id are ordered by digest, equal rows are leaves each (with
different proofs). A null source is a source of its own, the first. A lone leaf is its source's subroot, a lone subroot the
root; a proof without siblings is the hash of nothing. No rows: no results.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from erpspark.llm.scratch import stored

FANOUT = 3
#: Levels of records in a pack: at most 3^7 nodes at its lower end.
LEVELS = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_RECORDS = "array<struct<digest:string,children:array<string>>>"
_PATH = "array<struct<before:string,after:string>>"


def digest(joined: str) -> str:
    return sha256(joined.encode()).hexdigest()


def leaf(columns: dict[str, Column]) -> Column:
    """Digest of a row: every field as its UTF-8 byte count, a colon and its value, or `-`."""

    def field(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[field(c) for c in columns.values()]).cast("binary"), 256)


def tampered_text(doc_id: Column, text: Column) -> Column:
    """The text without line ends where 2 divides the checksum of the doc_id; null elsewhere, and where the text is null."""
    return F.when(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.replace(text.cast("string"), F.lit("\n"), F.lit("")))


def leaves(docs: DataFrame) -> DataFrame:
    """tree (one per source), doc_id, digest and the digest after tampering (null where the row is left alone)."""
    fields = {c: F.col(c) for c in FIELDS}
    changed = tampered_text(F.col("doc_id"), F.col("text"))
    source = F.col("source").cast("string")
    return docs.select(
        F.coalesce(F.concat(F.lit("1"), source), F.lit("0")).alias("tree"),  # "0" for null sorts first
        F.col("doc_id"),
        leaf(fields).alias("digest"),
        F.when(changed.isNotNull(), leaf(fields | {"text": changed})).alias("tampered"),
    )


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with their rank in their tree (from 0) and the number of rows of the tree.

    One sort by ranges over all trees; a tree's ranks are those inside a range, moved on by what its earlier ranges hold.
    """
    spread = rows.repartitionByRange(*[F.col(c).asc_nulls_first() for c in ("tree", *order)])
    place = spread.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in ("tree", *order)]).withColumn("place", F.monotonically_increasing_id())
    placed = stored(place.withColumn("part", F.shiftright("place", 33)), "placed")
    held = placed.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    parts = Window.partitionBy("tree").orderBy("part")  # one row per range
    before = F.coalesce(F.sum("rows").over(parts.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    moved = held.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("rows").over(Window.partitionBy("tree")).alias("n"))
    return placed.join(moved, ["tree", "part"]).withColumn("rank", F.col("place") + F.col("shift")).drop("place", "part", "shift")


def _folds(n: int, levels: int) -> int:
    """Levels that a pack of a tree with n nodes at its lower end spans."""
    depth = 0
    while n > 1 and depth < levels:
        n, depth = -(-n // FANOUT), depth + 1
    return depth


def fold(nodes: list[str], depth: int) -> tuple[str, list[tuple[str, list[str]]]]:
    """Top digest and records of `depth` levels over consecutive nodes."""
    records = []
    for _ in range(depth):
        runs = [nodes[i : i + FANOUT] for i in range(0, len(nodes), FANOUT)]
        nodes = [digest("".join(run)) for run in runs]
        records += zip(nodes, runs, strict=True)
    return nodes[0], records


def descend(records: dict[str, list[str]], top: str, offset: int, depth: int) -> tuple[str, list[tuple[str, str]]]:
    """The node at an offset below `top`, and per level, from the top, the digests before and after the child taken."""
    path = []
    for level in range(depth - 1, -1, -1):
        children, digit = records[top], offset // FANOUT**level % FANOUT
        path.append(("".join(children[:digit]), "".join(children[digit + 1 :])))
        top = children[digit]
    return top, path


def climb(claimed: str, path: list[tuple[str, str]]) -> str:
    """The root that a claimed leaf leads to; `path` runs from leaf to root."""
    for before, after in path:
        claimed = digest(before + claimed + after)
    return claimed


def _levels_above(n: Column, tiers: int, levels: int) -> Column:
    """Nodes of a tree after so many tiers of packs."""
    for _ in range(tiers):
        n = F.ceil(n / F.lit(float(FANOUT**levels)))
    return n.cast("long")


_PACK = pa.schema(
    [("tree", pa.string()), ("rank", pa.int64()), ("n", pa.int64()), ("leaves", pa.int64()), ("digest", pa.string())]
    + [("records", pa.list_(pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))])))]
)


def _packs(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                top, records = fold(row["nodes"], _folds(row["n"], levels))
                pack = {"tree": row["tree"], "rank": row["block"], "n": row["n"], "leaves": row["leaves"], "digest": top}
                yield pa.RecordBatch.from_pylist([pack | {"records": [{"digest": d, "children": c} for d, c in records]}], schema=_PACK)

    return run


def in_order(values: str, by: str) -> Column:
    """List of a column, ordered by another; null values stay in place. Only for groups of bounded size."""
    return F.transform(F.sort_array(F.collect_list(F.struct(by, F.coalesce(values, F.lit("")).alias("v")))), lambda x: x["v"])


def store(nodes: DataFrame, levels: int = LEVELS) -> tuple[DataFrame, list[DataFrame]]:
    """Tops of all trees (tree, n, digest) and their packs (digest, records) by tier, from ranked nodes (tree, rank, n, digest)."""
    tops, packs = None, []
    size = FANOUT**levels
    tier = nodes.select("tree", "rank", "n", "digest", F.col("n").alias("leaves"))
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        done = tier.where("n = 1").select("tree", F.col("leaves").alias("n"), "digest")
        tops = done if tops is None else tops.unionByName(done)
        if most <= 1:
            return stored(tops, "tops"), packs
        sizes = tier.where("n > 1").groupBy("tree", F.floor(F.col("rank") / size).alias("block"))
        blocks = sizes.agg(F.max("n").alias("n"), F.max("leaves").alias("leaves"), in_order("digest", "rank").alias("nodes"))
        made = stored(blocks.mapInArrow(_packs(levels), f"tree string, rank long, n long, leaves long, digest string, records {_RECORDS}"), "packs")
        packs.append(made.select("digest", "records"))
        tier = made.select("tree", "rank", F.ceil(F.col("n") / F.lit(float(size))).cast("long").alias("n"), "digest", "leaves")
        most = -(-most // size)


_DOWN = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("top", pa.string()), ("digest", pa.string()), ("path", pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())])))])


def _ways(levels: int):
    """One row per wanted node of a pack: its digest, and the path to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                records, depth, out = _as_map(row["records"]), _folds(row["n"], levels), []
                for offset in row["wanted"]:
                    node, path = descend(records, row["digest"], offset, depth)
                    own = [{"before": b, "after": a} for b, a in path]
                    out.append({"tree": row["tree"], "block": row["block"] * FANOUT**levels + offset, "top": row["top"], "digest": node, "path": row["path"] + own})
                yield pa.RecordBatch.from_pylist(out, schema=_DOWN)

    return run


def _as_map(records: list[dict]) -> dict[str, list[str]]:
    return {r["digest"]: r["children"] for r in records or []}


def ways(tops: DataFrame, packs: list[DataFrame], wanted: DataFrame, tiers: int, levels: int = LEVELS) -> DataFrame:
    """The way to the lower end of `tiers` from the top: for every wanted block (tree, rank of a node there, n leaves of
    the tree) its digest and path. `tops` has tree, top, digest and the path that leads to the tree."""
    size = FANOUT**levels
    at = wanted.select("tree", F.col("rank").alias("block"), _levels_above(F.col("n"), tiers, levels).alias("n")).distinct()
    single = at.where("n = 1").select("tree", "block").join(tops, "tree").select("tree", "block", "top", "digest", "path")
    if tiers >= len(packs):
        return single
    upper = at.where("n > 1").select("tree", F.floor(F.col("block") / size).alias("rank"), (F.col("block") % size).alias("offset"), "n")
    groups = upper.groupBy("tree", "rank").agg(F.max("n").alias("n"), F.sort_array(F.collect_list("offset")).alias("wanted"))  # at most `size` of them
    parents = ways(tops, packs, _with_leaves(wanted, size), tiers + 1, levels).withColumnRenamed("block", "rank")
    found = groups.join(parents, ["tree", "rank"]).withColumnRenamed("rank", "block")
    below = found.join(_addressed(packs[tiers]), "digest").select("tree", "block", "n", "wanted", "top", "digest", "path", "records")
    return single.unionByName(below.mapInArrow(_ways(levels), f"tree string, block long, top string, digest string, path {_PATH}"))


def _with_leaves(wanted: DataFrame, size: int) -> DataFrame:
    return wanted.select("tree", F.floor(F.col("rank") / size).alias("rank"), "n").distinct()


def _addressed(packs: DataFrame) -> DataFrame:
    """One pack per digest: equal contents are one."""
    return packs.dropDuplicates(["digest"])


_PROOF = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("proof_sha256", pa.string()), ("folded_root", pa.string())])


def _prove(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                records, depth, out = _as_map(row["records"]), _folds(row["n"], levels), []
                upper = [(p["before"], p["after"]) for p in reversed(row["path"])]
                for doc_id, offset, tampered in zip(row["ids"], row["offsets"], row["tampered"], strict=True):
                    node, path = descend(records, row["digest"], offset, depth)
                    path = path[::-1] + upper
                    proof = digest("".join(before + after for before, after in path))
                    out.append({"doc_id": doc_id, "leaf": node, "subroot": row["top"], "proof_sha256": proof, "folded_root": climb(tampered or node, path)})
                yield pa.RecordBatch.from_pylist(out, schema=_PROOF)

    return run


class Manifest:
    """Digests of a table: ranked leaves, and the stores of the trees of the sources and of the tree over them."""

    def __init__(self, docs: DataFrame, levels: int = LEVELS):
        self.levels = levels
        self.leaves = stored(ranked(leaves(docs), ["doc_id", "digest"]).withColumn("doc_id", F.col("doc_id").cast("long")), "leaves")
        self.subroots, self.packs = store(self.leaves, levels)
        over = self.subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest")
        self.sources = stored(ranked(over, ["source"]), "sources")
        self.tops, self.upper = store(self.sources, levels)
        top = self.tops.first()
        self.root = None if top is None else top["digest"]

    def starts(self, wanted: DataFrame) -> DataFrame:
        """Where descents in the wanted trees begin: the subroot, reached from the root, and the path to it."""
        here = self.sources.join(wanted.select(F.col("tree").alias("source")).distinct(), "source", "left_semi")
        none = F.array().cast(_PATH)
        top = self.tops.select("tree", F.lit("").alias("top"), "digest", none.alias("path"))
        found = ways(top, self.upper, here.select("tree", "rank", "n"), 0, self.levels)
        return here.select("tree", F.col("rank").alias("block"), "source").join(found, ["tree", "block"]).select(F.col("source").alias("tree"), F.col("digest").alias("top"), "digest", "path")

    def prove(self, requests: DataFrame | None = None) -> DataFrame:
        """For the requested leaves (rows of `leaves`; all by default): leaf, subroot, root, the hash of the proof's siblings, and
        the root that the row leads to after tampering."""
        rows, size = self.leaves if requests is None else requests, FANOUT**self.levels
        asked = rows.withColumns({"block": F.floor(F.col("rank") / size), "offset": F.col("rank") % size})
        blocks = asked.groupBy("tree", "block").agg(
            F.max("n").alias("n"),
            F.sort_array(F.collect_list(F.struct("offset", "doc_id", "tampered"))).alias("rows"),  # at most `size` of them
        )
        starts = stored(self.starts(rows), "starts")
        if self.packs:
            to_pack = stored(ways(starts, self.packs, _with_leaves(rows, size), 1, self.levels), "ways")
            packs = _addressed(self.packs[0])
        else:
            to_pack = starts.select("tree", F.lit(0).cast("long").alias("block"), "top", "digest", "path")
            packs = rows.sparkSession.createDataFrame([], f"digest string, records {_RECORDS}")
        # a lone leaf has no pack
        found = blocks.join(to_pack, ["tree", "block"]).join(packs, "digest", "left")
        shaped = found.select("n", "top", "digest", "path", "records", *[F.col(f"rows.{c}").alias(name) for c, name in (("doc_id", "ids"), ("offset", "offsets"), ("tampered", "tampered"))])
        proofs = shaped.mapInArrow(_prove(self.levels), "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string")
        root = F.lit(self.root).cast("string")
        return proofs.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))
