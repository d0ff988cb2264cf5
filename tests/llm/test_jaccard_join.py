import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from llm_fixtures import docs, plain

from erpspark.llm import jaccard_join as jj
from erpspark.llm.components import components


def meets(x, y, percent):
    """Whether a probe row of one set meets an index row of the other."""
    rows = []
    for tokens in (x, y):
        parts = list(jj.signatures(np.unique(np.array(tokens, np.uint64)), percent))
        rows.append(({s for sig, _, _ in parts for s in sig.tolist()}, {s for sig, _, indexed in parts if indexed for s in sig.tolist()}))
    (xp, xi), (yp, yi) = rows
    return bool(xp & yi or yp & xi)


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_every_similar_pair_meets(percent):
    rng = random.Random(percent)
    checked = 0
    for _ in range(3000):
        size = rng.choice([1, 2, 3, 5, 8, 13, 20, 40, 90, 200, 700])
        x = {rng.getrandbits(60) for _ in range(size)}
        worst = jj.difference(percent, 2 * size)
        out = rng.randint(0, min(size - 1, worst))
        y = set(rng.sample(sorted(x), size - out)) | {rng.getrandbits(60) for _ in range(rng.randint(0, worst))}
        if 100 * len(x & y) >= percent * len(x | y):
            checked += 1
            assert meets(list(x), list(y), percent), (len(x), len(y), len(x & y))
    assert checked > 500


def test_unrelated_texts_rarely_meet(spark):
    """Sets that only share a passage find enough segments of their own, so that few of them are looked up."""
    rng = random.Random(0)
    passage = " ".join(f"p{i}" for i in range(50))
    texts = [" ".join(f"w{rng.getrandbits(40)}" for _ in range(rng.randint(60, 300))) + " " + passage for _ in range(150)]
    rows = plain(spark, [(t,) for t in texts], "text string").mapInArrow(jj._emit(4, 85), "sig long, place long, item long")
    used = jj._probing(jj._meeting(rows), 85)
    pairs = used.where("probe").alias("a").join(used.where("indexed").alias("b"), "sig").where("a.set != b.set").select("a.set", "b.set").distinct()
    assert pairs.count() < 30


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 80)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)] + [(7, 7)]
    parent = {}

    def find(v):
        while parent.setdefault(v, v) != v:
            v = parent[v]
        return v

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    want = {v: find(v) for e in edges for v in e if e[0] != e[1]}
    got = {r.node: r.label for r in components(plain(spark, edges, "a long, b long")).collect()}
    assert got == want
    assert components(plain(spark, [], "a long, b long")).count() == 0


def brute(texts, n, percent):
    def grams(t):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = [x for x in lower.translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ") if x]
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()

    sets = [grams(t) for t in texts]
    label = list(range(len(texts)))
    changed = True
    pairs = [(i, j) for i, j in combinations(range(len(texts)), 2) if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in pairs:
            low = min(label[i], label[j])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    return [len(s) for s in sets], label


def test_groups_against_all_pairs(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(400)]
    texts = [None, "", "  \n ", "one", "One", "one two three", "ONE two\nthree", "É a b c d e", "é a b c d e"]
    for size in (6, 9, 15, 30, 60, 150):
        for _ in range(6):
            base = rng.choices(vocabulary, k=size)
            texts.append(" ".join(base))
            for _ in range(rng.randint(0, 4)):  # chains of small edits, so that links are not all direct
                for _ in range(rng.randint(1, max(1, size // 40))):
                    base[rng.randrange(size)] = rng.choice(vocabulary)
                texts.append(" ".join(base))
    star = " ".join(rng.choices(vocabulary, k=120)).split()
    for _ in range(40):  # a large group of near copies of one text
        copy = list(star)
        for _ in range(2):
            copy[rng.randrange(120)] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    texts += [texts[-1]] * 5 + ["long " * 3 + " ".join(f"x{i}" for i in range(30_000))] * 2
    sizes, want = brute(texts, 4, 85)
    got = {r.doc_id: r for r in jj.groups(docs(spark, texts), n=4, percent=85).collect()}
    assert [got[i].n_shingles for i in range(len(texts))] == sizes
    assert [got[i].component_id for i in range(len(texts))] == want


def test_edges(spark):
    assert jj.groups(plain(spark, [])).count() == 0
    rows = [(None, "same words in both of these"), (4, "same words in both of these"), (4, "same words in both of these"), (2, "same words in both of these"), (9, None)]
    got = Counter((r.doc_id, r.component_id) for r in jj.groups(plain(spark, rows)).collect())
    assert got == Counter([(None, None), (4, 2), (4, 2), (2, 2), (9, 9)])
    kept = jj.keep_first(plain(spark, rows)).collect()
    assert Counter(r.doc_id for r in kept) == Counter([None, 2, 9])


def test_null_id_copy_of_a_text_with_near_copies(spark):
    base = [f"w{i}" for i in range(60)]
    near = [" ".join([*base[:-1], f"end{k}"]) for k in range(3)]
    rows = [(None, near[0]), (5, near[0]), (3, near[1]), (7, near[2]), (None, near[2])]
    got = Counter((r.doc_id, r.component_id) for r in jj.groups(plain(spark, rows)).collect())
    assert got == Counter([(None, None), (None, None), (5, 3), (3, 3), (7, 3)])
    assert Counter(r.doc_id for r in jj.keep_first(plain(spark, rows)).collect()) == Counter([None, None, 3])


def _crowd(copies, words=100, changes=4):
    """Copies of one text with so many words changed that none links with another, and a few near copies of some."""
    rng = np.random.default_rng(copies)
    base = [f"w{i}" for i in range(words)]
    texts = []
    for k in range(copies):
        text = list(base)
        for at in rng.choice(words, changes, replace=False):
            text[at] = f"c{k}x{at}"
        texts.append(" ".join(text))
        if k % 10 == 0:
            texts.append(" ".join([*text, "more"]))
    return texts


def test_crowded_copies_without_links(spark, monkeypatch):
    """Groups stay right and pairs in proportion to the rows where a bucket is full of sets that do not link."""
    compared = {}
    for copies in (80, 320):
        texts, seen = _crowd(copies), []
        keep = jj.stored
        monkeypatch.setattr(jj, "stored", lambda df, name: (out := keep(df, name), seen.append(out.count()) if name == "pairs" else None)[0])
        got = {r.doc_id: r.component_id for r in jj.groups(docs(spark, texts), 4, 85).collect()}
        monkeypatch.setattr(jj, "stored", keep)
        grams = [{tuple(w[i : i + 4]) for i in range(len(w) - 3)} for w in (t.split() for t in texts)]
        want = list(range(len(texts)))
        for b in range(len(texts)):
            for a in range(b):
                common = len(grams[a] & grams[b])
                if 100 * common >= 85 * (len(grams[a]) + len(grams[b]) - common):
                    low, high = sorted((want[a], want[b]))
                    want = [low if x == high else x for x in want]
        assert got == dict(enumerate(want))
        compared[copies] = sum(seen) / len(texts)
    assert compared[320] < 2 * compared[80] + 10 and compared[320] < 30
