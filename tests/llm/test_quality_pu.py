import zlib

import numpy as np
from llm_fixtures import docs, plain

from erpspark.llm import catalog, quality_pu

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = catalog.QUERIES["op1_pu_quality"](spark, DATA).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    assert len({r.doc_id for r in got}) == len(got) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    unseen = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert len(unseen) > 50 and sum(p == q for p, q in unseen) / len(unseen) > 0.95


def test_moments_and_risk(spark):
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["the", "of", "alpha", "beta.", "gamma,", "delta"], 30)) for _ in range(60)] + ["$$$ !!! ###" * 5] * 20
    frame = docs(spark, texts)
    labels = plain(spark, [(i, 1) for i in range(40)], "doc_id long, quality int")
    rows = quality_pu.measured_rows(frame, labels).collect()
    x = np.array([quality_pu.measures(t) for t in texts])
    m_u, m_p, n_u, n_p = quality_pu.moments(quality_pu.measured_rows(frame, labels))
    flags = {r.doc_id: r.positive for r in rows}
    p = np.array([flags[i] for i in range(80)])
    assert n_u == 80 and n_p == p.sum() and not any(flags[i] for i in range(40, 80))
    np.testing.assert_allclose(m_u, x.T @ x / 80, atol=1e-4)
    np.testing.assert_allclose(m_p, x[p].T @ x[p] / p.sum(), atol=1e-4)
    w = quality_pu.fit(m_u, m_p, 0.75)
    assert (x[:60] @ w).min() > (x[60:] @ w).max()

    def risk(w):
        loss = lambda g, y: (1 - y * g) ** 2 / 4
        return 0.75 * loss(x[p] @ w, 1).mean() + max(0, loss(x @ w, -1).mean() - 0.75 * loss(x[p] @ w, -1).mean())

    assert risk(w) < risk(np.zeros(len(w)))


def test_prior_from_tails():
    rng = np.random.default_rng(2)
    edges = np.linspace(-3, 3, quality_pu.BINS + 1)
    good, bad = rng.normal(1, 0.3, 70_000), rng.normal(-1, 0.3, 30_000)
    bins = np.array([np.histogram(np.concatenate((good, bad)), edges)[0], np.histogram(rng.normal(1, 0.3, 5_000), edges)[0]])
    assert abs(quality_pu.class_prior(bins) - 0.7) < 0.03


def test_edges(spark):
    odd = [None, "", " \n\t ", "x", "word " * 50_000, "ok text here.", "ok text here."]
    labels = plain(spark, [(0, 1), (5, 1), (5, 0), (6, 1), (None, 1), (99, 1)], "doc_id long, quality int")
    got = quality_pu.score(docs(spark, odd), labels).collect()
    assert len(got) == len(odd) and all(0 <= r.score <= 1 for r in got)
    none = quality_pu.score(docs(spark, odd), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_pu.score(docs(spark, []), labels).count() == 0
    kept = quality_pu.keep_good(docs(spark, odd), labels)
    assert kept.columns == docs(spark, odd).columns
