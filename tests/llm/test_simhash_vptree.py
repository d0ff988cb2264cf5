"""SimHash groups against plain fingerprints and all pairs."""

import re

import numpy as np
import pytest
import xxhash
from llm_fixtures import docs, plain

from erpspark.llm import simhash_vptree as vp
from erpspark.llm.scratch import ship

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows):
    """(doc_id, print, component) of (doc_id, text) rows."""
    prints = [(i, plain_print(t)) for i, t in rows]
    values = sorted({p for _, p in prints})
    root = {p: p for p in values}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for k, p in enumerate(values):
        for q in values[k + 1 :]:
            if (p ^ q).bit_count() <= 3:
                root[top(q)] = top(p)
    least = {}
    for i, p in prints:
        if i is not None:
            least[top(p)] = min(i, least.get(top(p), i))
    return sorted(((i, p, least.get(top(p))) for i, p in prints), key=str)


def got(spark, frame, **more):
    ship(spark)
    return sorted(((r[0], r[1] % (1 << 64), r[2]) for r in vp.groups(frame, **more).collect()), key=str)


WORDS = [f"w{i}" for i in range(400)]


def variants(seed, n, words, changes):
    rng = np.random.default_rng(seed)
    base = [WORDS[i] for i in rng.integers(0, 400, words)]
    for _ in range(n):
        text = list(base)
        for at in rng.integers(0, words, rng.integers(0, changes + 1)):
            text[at] = WORDS[rng.integers(0, 400)]
        yield " ".join(text)


def test_groups_and_edges(spark):
    texts = [t for s in range(12) for t in variants(s, 9, 120, 6)]
    texts += [None, "", " \n\t", "One", "one two", "ONE Two", "A\x0bb\x0cc d", "Ä ä Ünicode ß", "x " * 5000, texts[3], texts[3]]
    rows = list(enumerate(texts))
    assert got(spark, docs(spark, texts)) == plain_groups(rows)
    # null ids and repeated ids
    rows = [(None if i % 5 == 0 else i // 2, t) for i, t in rows]
    assert got(spark, plain(spark, rows), shard=20) == plain_groups(rows)
    assert got(spark, plain(spark, [(None, "a b c d")])) == plain_groups([(None, "a b c d")])
    assert got(spark, plain(spark, [])) == []


def test_long_text_in_parts(monkeypatch):
    text = "\n".join(variants(1, 40, 60, 60)) + "  "
    whole = vp.fingerprint(text.encode())
    assert whole == plain_print(text)
    for part in (1, 7, 100):
        monkeypatch.setattr(vp, "PART", part)
        assert vp.fingerprint(text.encode()) == whole
        assert vp.fingerprint(b"One two") == plain_print("one two") and vp.fingerprint(b"  ") == 0


def test_invalid_utf8(spark):
    ship(spark)
    frame = spark.sql("SELECT 1L doc_id, CAST(X'61ff20620a63' AS STRING) text")
    assert got(spark, frame)[0][1] == xxhash.xxh64_intdigest(b"a\xff b c", 42)


def spread(seed, n, centres, flips):
    """Distinct fingerprints: centres with up to `flips` bits changed."""
    rng = np.random.default_rng(seed)
    heads = rng.integers(0, 1 << 63, centres, dtype=np.uint64) * np.uint64(2)
    out = heads[rng.integers(0, centres, n)]
    for _ in range(flips):
        out = np.where(rng.random(n) < 0.7, out ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)), out)
    return np.unique(out)


def all_components(values):
    close = np.bitwise_count(values[:, None] ^ values[None, :]) <= 3
    a, b = np.nonzero(close)
    return vp.forest(a, b, len(values))


@pytest.mark.parametrize("seed, n, centres, flips", [(1, 3000, 3000, 0), (2, 3000, 300, 3), (3, 3000, 1, 2), (4, 3000, 1, 6), (5, 3000, 20, 5)])
def test_shards_equal_all_pairs(spark, seed, n, centres, flips):
    """Random, loosely and densely grouped fingerprints, in one shard and dealt to many."""
    values = spread(seed, n, centres, flips)
    want = all_components(values)
    a, b = vp.shard_forest(values, np.ones(len(values), bool))
    at = {v: i for i, v in enumerate(values.tolist())}
    assert (vp.forest(np.array([at[x] for x in a.tolist()], int), np.array([at[x] for x in b.tolist()], int), len(values)) == want).all()
    assert len(a) < len(values)  # a forest, however many pairs there are
    if seed in (2, 4):
        ship(spark)
        links = vp.links(plain(spark, [(int(v),) for v in values.view(np.int64)], "print long"), shard=200).collect()
        a, b = (np.array([at[x % (1 << 64)] for x in c], int) for c in zip(*[(r["a"], r["b"]) for r in links], strict=True))
        assert (vp.forest(a, b, len(values)) == want).all()
