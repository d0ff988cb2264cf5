import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import docs, plain
from pyspark.sql import functions as F

from erpspark.llm import catalog, line_dedup, substring_dedup

DATA = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^ \t-\r]+")


@pytest.mark.parametrize("name", sorted(catalog.CHECKS))
def test_against_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    df = catalog.QUERIES[name](spark, DATA)
    cur = con.execute(catalog.CHECKS[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert Counter(tuple(r) for r in df.select(*names).collect()) == Counter(cur.fetchall())


def brute_lines(rows, min_chars, min_docs):
    key = lambda x: x.strip(SPACES).translate({c: c + 32 for c in range(65, 91)})
    holders = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if i is not None:
                holders[key(x)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        gone = lambda k, i=i: i is not None and len(k) >= min_chars and len(holders[k]) >= min_docs and max(holders[k]) != i
        kept = [x for x in lines if not gone(key(x))]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


def test_line_edges(spark):
    long, other = "This line is Long enough to count É " * 2, "ünïcode " * 8
    rows = [(i, f"start {i}\n {long}\t\n{other}\nend") for i in range(6)] + [
        (6, long.upper().replace("É", "é")), (7, f"{long}\n{long}\nx"), (7, f"{long}\n{long}\nx"), (8, None), (9, ""), (10, "\n\n"), (None, long), (None, None),
        (11, "ä" * 39), (12, "ä" * 39), (13, "ä" * 40), (14, "ä" * 40), (15, "ä" * 40), (16, "ä" * 40), (17, "ä" * 40), (18, "ä" * 39), (19, "ä" * 39), (20, "ä" * 39), (21, f"{long}\n" * 20_000 + other),
    ]
    out = line_dedup.dedup_lines(plain(spark, rows), digest=True).select("doc_id", "__n_lines", "__n_dropped", "__kept").collect()
    assert Counter(tuple(r) for r in out) == brute_lines(rows, 40, 5)
    assert line_dedup.dedup_lines(plain(spark, [])).count() == 0
    clash = line_dedup.dedup_lines(docs(spark, ["a", None]).withColumn("__lost", F.lit(1)).withColumn("c0", F.lit("x")))
    assert {"row_id", "score", "lang", "__text", "__lost", "c0"} <= set(clash.columns)
    assert {(r["__text"], r["__lost"], r.c0, r["__kept"]) for r in clash.collect()} == {("clash", 1, "x", "a"), ("clash", 1, "x", "")}


def test_no_utf8(spark):
    """Bytes that are no UTF-8 become replacement characters in texts given back."""
    bad = plain(spark, [(i, "plain") for i in range(6)]).withColumn("text", F.expr("cast(unhex('61FF62') as string)"))
    assert {r["__kept"] for r in line_dedup.dedup_lines(bad, min_chars=2).collect()} == {"a\ufffdb", ""}
    assert {r["__kept"] for r in substring_dedup.remove_repeats(bad).collect()} == {"a\ufffdb"}


def test_equal_keys_take_another_seed():
    h1 = np.array([1, 2, 3], np.int64)
    clash = line_dedup.mix(h1.view(np.uint64) ^ line_dedup.mix(np.array([0], np.uint64)))
    h2 = (clash ^ clash[0]).view(np.int64)  # the first seed gives all three one key
    table = pa.table({"shard": [0] * 3, "h1": h1, "h2": h2, "n_docs": [5, 6, 7], "keeper": [1, 2, 3]})
    shard = line_dedup._build_shard(table)
    assert shard.column("seed")[0].as_py() > 0
    probes = pa.table({"doc_id": pa.array([9] * 3), "h1": h1, "h2": h2})
    assert line_dedup._probe_shard(6)(probes, shard).num_rows == 2


def test_line_shards_agree(spark, monkeypatch):
    """Many shards, and several tasks per shard, give what one gives."""
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 7)
    monkeypatch.setattr(line_dedup, "TASK_PROBES", 20)
    rows = [(i, "\n".join(f"line number {(i * k) % 23} " + "pad " * 10 for k in range(1, 6))) for i in range(60)]
    out = line_dedup.dedup_lines(plain(spark, rows), digest=True).select("doc_id", "__n_lines", "__n_dropped", "__kept").collect()
    assert Counter(tuple(r) for r in out) == brute_lines(rows, 40, 5)


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 20_000, dtype=np.uint64))
    levels, slots = line_dedup.build_mph(keys)
    assert sorted(slots) == list(range(len(keys)))
    assert (line_dedup.probe_mph(levels, keys) == slots).all()
    strange = line_dedup.probe_mph(levels, keys + np.uint64(1))
    assert strange.max() < len(keys)
    empty, none = line_dedup.build_mph(keys[:0])
    assert not empty and not len(none) and (line_dedup.probe_mph(empty, keys[:3]) == -1).all()


def brute_windows(rows, size):
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - size + 1):
            if i is not None:
                first[tuple(w[k : k + size])] = min(i, first.get(tuple(w[k : k + size]), i))
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = {k + j for k in range(len(w) - size + 1) if i is not None and first[tuple(w[k : k + size])] < i for j in range(size)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize(("window", "anchor"), [(50, 16), (6, 3), (3, 1)])
def test_windows_against_brute_force(spark, window, anchor):
    rng = np.random.default_rng(window)
    vocabulary = [f"wö{i}" if i % 5 == 0 else f"W{i}" for i in range(12 if window < 50 else 300)]
    passages = [list(rng.choice(vocabulary, n)) for n in (window, window + 1, window + 5, 3 * window, window - 1)]
    rows = [(1, None), (2, ""), (3, " \x0b "), (None, " ".join(passages[3])), (4, "same " * (4 * window)), (5, "same " * (2 * window))]
    for i in range(6, 40):
        words = list(rng.choice(vocabulary, rng.integers(0, 2 * window)))
        for p in rng.integers(0, len(passages), rng.integers(0, 3)):
            at = rng.integers(0, len(words) + 1)
            words[at:at] = passages[p]
        rows.append((i, "\n ".join(words)))
    rows += [rows[-1], (rows[-1][0], " ".join(passages[0])), (99, rows[10][1]), (100, rows[10][1])]
    out = substring_dedup.remove_repeats(plain(spark, rows), window, anchor, digest=True).select("doc_id", "__n_words", "__n_removed", "__kept").collect()
    assert Counter(tuple(r) for r in out) == brute_windows(rows, window)


def test_window_edges(spark):
    assert substring_dedup.remove_repeats(plain(spark, [])).count() == 0
    clash = substring_dedup.remove_repeats(docs(spark, ["a b", None]).withColumn("cut", F.lit(1)))
    assert {"row_id", "score", "cut", "__text"} <= set(clash.columns) and {(r["__text"], r["__kept"]) for r in clash.collect()} == {("clash", "a b"), ("clash", "")}
