"""Quality classifier learned from positive and unlabelled documents.

The trusted positives are documents labelled 1; every document of the corpus, its label ignored, is
unlabelled text. The score function is linear in style measures of the whole text. With the loss
(1 - z)^2 / 4 the non-negative unbiased risk

    prior * P[loss(g)] + max(0, U[loss(-g)] - prior * P[loss(-g)])

depends on the data only through first and second moments of the measures under P and U. Spark sums these
over all documents (partial sums per task, one number per pair of measures), so nothing is sampled and the
driver holds a table of fixed size, on which the risk is minimised.

The class prior is estimated from scores alone: the share of positives cannot exceed the ratio
U(g >= t) / P(g >= t) for any t; the smallest such ratio over a histogram (with an allowance for its counting
error) is the prior. First and second fit alternate with two such estimates. The last histogram also sets
the cut, where the positive-unlabelled estimate of the share of wrong decisions is least; it gets a score of 0.7.

Defined results: null and empty texts get the score of zero measures; several labels for one document count as
1 only if all are; rows with a null doc_id are scored but never labelled; without any positive everything
scores 0.5; other columns are never inputs of a score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from erpspark.llm.scratch import stored
from erpspark.llm.words import text_bytes

CUT = 0.7
RIDGE = 1e-3
BINS = 2000
#: Tails with a smaller share of the positives are not used for the prior.
LEAST_TAIL = 0.2
#: Cuts whose share of wrong decisions is this close to the least count as equal.
NEAR_LEAST = 0.001

_PUNCT = frozenset(".,;:!?")
_PLAIN = frozenset(".,;:!?'\"-()")


def _ratios(text: str) -> list[float]:
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * 20
    chars = sum(map(len, words))
    counts = Counter(words)
    distinct = Counter(w.strip(".,;:!?").lower() for w in counts)
    tails = sum(c for w, c in counts.items() if w[-1] in _PUNCT)
    stops = sum(c for w, c in counts.items() if w[-1] == ".")
    double = sum(c for w, c in counts.items() if len(w) > 1 and not w[-1].isalnum() and not w[-2].isalnum())
    odd = sum(c for w, c in counts.items() if not w.isalnum() and any(not ch.isalnum() and ch not in _PLAIN for ch in w))
    caps = sum(c for w, c in counts.items() if len(w) > 1 and w.isupper())
    title = sum(c for w, c in counts.items() if w[0].isupper() and not (len(w) > 1 and w.isupper()))
    short = sum(c for w, c in counts.items() if len(w) <= 3)
    single = sum(c for w, c in counts.items() if len(w) == 1 and not w.isalnum())
    digits = sum(c * sum(ch.isdigit() for ch in w) for w, c in counts.items() if not w.isalpha())
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    runs = len(set(zip(*(words[i:] for i in range(5)), strict=False)))
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = [x for x in text.split("\n") if x.strip()]
    top = max(counts.values())
    return [
        chars / n / 10, tails / n, stops / n, double / n, odd / n, caps / n, title / n, short / n, single / n, digits / chars,
        again / max(1, n - 1), 1 - runs / (n - 4) if n > 4 else 0.0, 1 - pairs / (n - 1) if n > 1 else 0.0, 1 - len(set(lines)) / len(lines),
        top / n if n >= 10 else 0.1, math.log(max(1, len(distinct))) / math.log(n) if n > 1 else 1.0, 1 - len(distinct) / n, min(1.0, n / 1000),
        min(1.0, max(map(len, counts)) / 50), 1.0,
    ]


def measures(text: str) -> list[float]:
    """Style measures: shares of the text and the same bent at small values, so that a linear score can step."""
    shares = _ratios(text)
    words = 1.0 if shares[-1] else 0.0
    bent = [min(1.0, 20 * x) for x in shares[3:6] + shares[8:14]] + [min(1.0, 4 * x) for x in shares[1:6] + shares[7:9] + shares[10:14]]
    size = [1.0 if words and shares[17] <= k else 0.0 for k in (0.005, 0.02)]
    far = [max(0.0, shares[0] - 0.55), max(0.0, 0.45 - shares[0]), max(0.0, 0.9 - shares[15]), max(0.0, shares[14] - 0.1), max(0.0, 0.2 - shares[7])]
    return [1.0, *shares[:-1], words, *bent, *size, *far]


WIDTH = len(measures("one two"))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [np.array(measures(t.decode("utf-8", "replace")), np.float32) for t in text_bytes(batch.column(1))]
        flat = pa.array(np.concatenate(rows) if rows else np.empty(0, np.float32))
        x = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * WIDTH), flat)
        yield pa.RecordBatch.from_arrays([batch.column(0), x], names=["doc_id", "x"])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, WIDTH)


_UPPER = np.triu_indices(WIDTH)


def _sum_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = {True: np.zeros(len(_UPPER[0])), False: np.zeros(len(_UPPER[0]))}
    seen = False
    for batch in batches:
        x, positive = _matrix(batch, "x"), batch.column("positive").to_numpy(zero_copy_only=False).astype(bool)
        seen |= len(x) > 0
        for part in range(0, len(x), 4096):
            rows, flags = x[part : part + 4096], positive[part : part + 4096]
            sums[False] += (rows.T @ rows)[_UPPER]
            sums[True] += (rows[flags].T @ rows[flags])[_UPPER]
    if seen:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(_UPPER[0]), dtype=np.int32)), pa.array(sums[False]), pa.array(sums[True])], names=["cell", "u", "p"])


def moments(measured: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Second moments under U and P and both counts. The first measure is 1, so its row holds the means."""
    rows = measured.select("x", "positive").mapInArrow(_sum_moments, "cell int, u double, p double").groupBy("cell").agg(F.sum("u").alias("u"), F.sum("p").alias("p")).collect()
    out = []
    for name in ("u", "p"):
        m = np.zeros((WIDTH, WIDTH))
        for r in rows:
            m[_UPPER[0][r.cell], _UPPER[1][r.cell]] = r[name]
        n = m[0, 0]
        m = m + np.triu(m, 1).T
        out.append((m / max(n, 1), int(n)))
    return out[0][0], out[1][0], out[0][1], out[1][1]


def fit(m_u: np.ndarray, m_p: np.ndarray, prior: float, ridge: float = RIDGE) -> np.ndarray:
    """Weights of least non-negative risk; g = w.x estimates 2 P(good | x) - 1.

    The unbiased risk with a ridge has its minimum in closed form. Where the estimated risk of the negatives is
    below zero there, the fit has read noise into the unlabelled rows: the ridge doubles until it is not
    (it ends, as the constant score has a risk above zero).
    """
    mean_u, mean_p = m_u[0], m_p[0]

    def negative(w: np.ndarray) -> float:
        return (1 + 2 * w @ mean_u + w @ m_u @ w - prior * (1 + 2 * w @ mean_p + w @ m_p @ w)) / 4

    while True:
        penalty = np.full(WIDTH, 2 * ridge)
        penalty[0] = 0
        w = np.linalg.lstsq(m_u + np.diag(penalty), 2 * prior * mean_p - mean_u, rcond=None)[0]
        if negative(w) >= 0 or ridge > 1e6:
            return w
        ridge *= 2


def _score_bins(w: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BINS), np.int64)
        for batch in batches:
            at = np.clip(((_matrix(batch, "x") @ w + 3) / 6 * BINS).astype(np.int64), 0, BINS - 1)
            positive = batch.column("positive").to_numpy(zero_copy_only=False).astype(bool)
            counts[0] += np.bincount(at, minlength=BINS)
            counts[1] += np.bincount(at[positive], minlength=BINS)
        used = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[0][used]), pa.array(counts[1][used])], names=["bin", "u", "p"])

    return run


def histogram(measured: DataFrame, w: np.ndarray) -> np.ndarray:
    """Documents (row 0) and trusted positives (row 1) per bin of g over [-3, 3)."""
    out = np.zeros((2, BINS))
    for r in measured.select("x", "positive").mapInArrow(_score_bins(w), "bin int, u long, p long").groupBy("bin").agg(F.sum("u").alias("u"), F.sum("p").alias("p")).collect():
        out[:, r.bin] = r.u, r.p
    return out


def class_prior(bins: np.ndarray) -> float:
    """Smallest ratio of tails, each bounded against its counting error."""
    tails = bins[:, ::-1].cumsum(axis=1)
    n = tails[:, -1]
    ok = tails[1] >= LEAST_TAIL * n[1]
    share = tails[:, ok] / n[:, None]
    slack = 2 * np.sqrt(share * (1 - share) / n[:, None])
    return float(np.clip(((share[0] + slack[0]) / np.maximum(share[1] - slack[1], 1e-9)).min(), 0.02, 0.98))


def train(measured: DataFrame) -> dict:
    """Weights, prior, cut and slope from all measured rows (`x`, `positive`)."""
    m_u, m_p, n_u, n_p = moments(measured)
    if not n_p:
        return {"w": np.zeros(WIDTH), "prior": 0.5, "at": 0.0, "slope": 0.0}
    prior, ridge = 0.5, RIDGE + 1 / n_p  # few positives: less may be read into them
    for _ in range(2):
        w = fit(m_u, m_p, prior, ridge)
        bins = histogram(measured, w)
        prior = class_prior(bins)
    w = fit(m_u, m_p, prior, ridge)
    bins = histogram(measured, w)
    edges = np.linspace(-3, 3, BINS + 1)[:-1]
    above = bins[:, ::-1].cumsum(axis=1)[:, ::-1] / np.array([[n_u], [n_p]])
    wrong = prior * (1 - above[1]) + np.maximum(0, above[0] - prior * above[1])
    at = float(np.median(edges[wrong <= wrong.min() + NEAR_LEAST]))
    typical = float(edges[np.searchsorted(bins[1].cumsum(), n_p / 2)])
    at = min(at, typical - 0.05)
    return {"w": w, "prior": prior, "at": at, "slope": 3.0 / (typical - at)}


def _score(model: dict):
    shift = math.log(CUT / (1 - CUT)) if model["slope"] else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g = _matrix(batch, "x") @ model["w"]
            z = np.clip(model["slope"] * (g - model["at"]) + shift, -40, 40)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(1 / (1 + np.exp(-z)))], names=["doc_id", "row", "score"])

    return run


def measured_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, row (hash of the text), x and positive, written to the shared folder."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    x = texts.select(F.struct("doc_id", F.xxhash64("text").alias("row")).alias("doc_id"), "text").mapInArrow(_measure, "doc_id struct<doc_id:bigint,row:bigint>, x array<float>")
    trusted = labels.groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(F.min("quality").alias("quality")).where((F.col("quality") == 1) & ~held_out(F.col("l_id")))
    flat = x.select("doc_id.doc_id", "doc_id.row", "x")
    joined = flat.join(trusted, F.col("doc_id") == F.col("l_id"), "left")
    return stored(joined.select("doc_id", "row", "x", F.col("l_id").isNotNull().alias("positive")), "measures")


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, row (hash of the text), score and predicted of every document."""
    measured = measured_rows(docs, labels)
    out = measured.select("doc_id", "row", "x").mapInArrow(_score(train(measured)), "doc_id long, row long, score double")
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with their columns."""
    good = score(docs, labels).where("predicted = 1").select(F.col("doc_id").alias("__id"), F.col("row").alias("__row")).distinct()
    return docs.join(good, docs["doc_id"].cast("long").eqNullSafe(good["__id"]) & (F.xxhash64(docs["text"].cast("string")) == good["__row"]), "left_semi")
