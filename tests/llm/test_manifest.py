"""Merkle manifest against a plain twin."""

import zlib
from hashlib import sha256

import pytest

from erpspark.llm.manifest import Manifest, climb, descend, fold
from erpspark.llm.scratch import ship

DDL = "doc_id long, text string, lang string, source string, n_chars long, digest string, tree string, rank string"


def h(text):
    return sha256(text.encode()).hexdigest()


def _leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _tree(nodes):
    """Top of the tree and, per leaf, (before, after) from leaf to top."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(place):
            run, at = nodes[p // 3 * 3 : p // 3 * 3 + 3], p % 3
            paths[k].append(("".join(run[:at]), "".join(run[at + 1 :])))
            place[k] = p // 3
        nodes = [h("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def twin(rows):
    sources = {}
    for doc_id, text, lang, source, n_chars, *_ in rows:
        cut = None
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            cut = _leaf((doc_id, source, lang, n_chars, text.replace("\n", "")))
        sources.setdefault(source, []).append((doc_id is not None, doc_id or 0, _leaf((doc_id, source, lang, n_chars, text)), cut))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = [_tree([x[2] for x in sorted(sources[s], key=lambda x: x[:3])]) for s in names]
    root, tops = _tree([t[0] for t in trees])
    out = []
    for s, (subroot, paths), top in zip(names, trees, tops):
        for (known, doc_id, leaf, cut), path in zip(sorted(sources[s], key=lambda x: x[:3]), paths):
            claimed = cut or leaf
            for before, after in path + top:
                claimed = h(before + claimed + after)
            proof = h("".join(b + a for b, a in path + top))
            out.append((doc_id if known else None, leaf, subroot, root, proof, claimed, claimed == root))
    return out


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


def _row(doc_id, text, source="s", lang="en"):
    return doc_id, text, lang, source, None if text is None else len(text), "clash", "clash", "clash"


CASES = {
    "one row": [_row(5, "a\nb")],
    "one source": [_row(i, f"line {i}\nnext") for i in range(29)],
    "lone leaves": [_row(i, f"a\n{i}", f"s{i:02d}") for i in range(11)],
    "hot source, names beside ASCII": [_row(i, f"t{i}\n", "hot" if i % 3 else ("é", "Z", "a", "", None)[i % 5]) for i in range(70)],
    "nulls, ties, repeats": [_row(None, "x\n"), _row(None, None, None, None), _row(None, "x\n"), _row(3, "y\n"), _row(3, "y\n"), _row(3, "z\n"), _row(4, ""), _row(8, "\n"), _row(9, "w" * 300_000 + "\n")],
}


@pytest.mark.parametrize("name, levels", zip(CASES, (7, 2, 7, 1, 7)))
def test_twin(spark, name, levels):
    ship(spark)
    got = Manifest(spark.createDataFrame(CASES[name], DDL), levels).prove().collect()
    assert _sorted(map(tuple, got)) == _sorted(twin(CASES[name]))


def test_requests_and_empty_table(spark):
    ship(spark)
    rows = CASES["one source"]
    made = Manifest(spark.createDataFrame(rows, DDL), 2)
    some = made.prove(made.leaves.where("doc_id in (0, 17, 28)")).collect()
    assert _sorted(map(tuple, some)) == _sorted(r for r in twin(rows) if r[0] in (0, 17, 28))
    none = Manifest(spark.createDataFrame([], DDL))
    assert none.root is None and none.prove().collect() == []


def test_descent_inverts_folding():
    nodes = [h(str(i)) for i in range(10)]
    top, records = fold(nodes, 3)
    for i, node in enumerate(nodes):
        found, path = descend(dict(records), top, i, 3)
        assert found == node and climb(node, path[::-1]) == top
        assert climb(h("other"), path[::-1]) != top
