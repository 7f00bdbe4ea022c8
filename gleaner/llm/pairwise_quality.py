"""Quality scores from Bradley-Terry preferences.

Every pair of a good and a bad labelled document is a preference; the chance that the good one wins is
the logistic function of the difference of two linear scores, so the weights are fitted by logistic
loss on feature differences.  The bad labels' share of the sample names a quantile of the fitted scores, which
becomes the decision threshold; the reported score maps the threshold to ``CUT``.

Features are counted on the whole text: shares of each kind of character, of repeated words and lines, word
lengths, text length.  Only text enters; ids, sources and languages do not.  The model is fitted on a
bounded sample: at most ``SAMPLE_ROWS`` labelled training rows, those of smallest id hash, and
``PAIRS`` preferences drawn from them with a fixed seed.

Defined cases: null text has the features of the empty text; with no labels every score is 0.5, with one
kind of label only it is that label; labels that are null or neither 0 nor 1 are skipped; a document
labelled twice counts twice; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.tables import bound_batches

SAMPLE_ROWS = 20_000
PAIRS = 60_000
CUT = 0.7  # score of the threshold
RIDGE = 1e-3
SEED = 5

_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
N_FEATURES = len(_PUNCTUATION) + 16


def features(text: str | None) -> np.ndarray:
    data = (text or "").encode()
    out = np.zeros(N_FEATURES)
    if not data:
        return out
    n = len(data)
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    w = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    shares = [
        seen[65:91].sum() / n, seen[97:123].sum() / n, seen[48:58].sum() / n, seen[128:].sum() / n, seen[32] / n, seen[10] / n,
        (seen[:9].sum() + seen[11:32].sum() + seen[127]) / n, sum(seen[c] for c in _PUNCTUATION) / n,
        1 - len(set(words)) / w, sum(a == b for a, b in zip(words, words[1:], strict=False)) / w, 1 - len(set(lines)) / max(1, len(lines)),
        min(1.0, lengths.mean() / 50), min(1.0, lengths.std() / 50), min(1.0, lengths.max() / 1000), min(1.0, np.log1p(n) / 20),
        min(1.0, len(lines) / w),
    ]
    # roots spread the small shares
    out[:len(shares)] = np.sqrt(np.maximum(shares, 0))
    out[len(shares):] = np.sqrt(seen[list(_PUNCTUATION)] / n)
    return out


class Ranker:
    """score(x) = logistic of a linear function of the text's features."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(features(text) @ self.weights + self.bias, -500, 500))))


def fit(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, cut: float = CUT, seed: int = SEED) -> Ranker:
    """Bradley-Terry weights by Newton's method on seeded preference pairs, and the quantile threshold."""
    if not len(good) or good.all() or not good.any():
        share = 0.5 if not len(good) else float(good[0])
        return Ranker(np.zeros(N_FEATURES), float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    rng = np.random.default_rng(seed)
    scale = x.std(axis=0)
    scale[scale < 1e-9] = np.inf
    z = x / scale
    winners, losers = np.flatnonzero(good), np.flatnonzero(~good)
    d = z[rng.choice(winners, pairs)] - z[rng.choice(losers, pairs)]
    v = np.zeros(N_FEATURES)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(d @ v, -30, 30)))
        slope = d.T @ (1 - p) / pairs - RIDGE * v
        curve = (d * (p * (1 - p))[:, None]).T @ d / pairs + RIDGE * np.eye(N_FEATURES)
        step = np.linalg.solve(curve, slope)
        v += step
        if np.abs(step).max() < 1e-6:
            break
    weights = v / scale
    s = np.sort(x @ weights)
    at = int((~good).sum())  # as many below the threshold as there are bad labels
    threshold = (s[at - 1] + s[min(at, len(s) - 1)]) / 2
    return Ranker(weights, float(np.log(cut / (1 - cut)) - threshold))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [features(t.as_py()) for t in b.column(1)]
        yield pa.record_batch({"quality": b.column(0), "x": pa.array(rows, pa.list_(pa.float64()))})


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          sample_rows: int = SAMPLE_ROWS) -> Ranker:
    """``docs`` and ``labels`` hold training rows only; the sample's ids are broadcast (``sample_rows`` at most)."""
    bound_batches(docs.sparkSession)
    chosen = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("quality"))
              .where("doc_id is not null and quality in (0, 1)").orderBy(F.xxhash64("doc_id"), "quality").limit(sample_rows))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("quality", "text").mapInArrow(_feature_rows, "quality int, x array<double>").toArrow()
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(-1, N_FEATURES) if rows.num_rows else np.zeros((0, N_FEATURES))
    good = rows.column("quality").to_numpy() == 1
    # one order whatever the tasks did
    order = np.lexsort((*x.T, good)) if len(good) else []
    return fit(x[order], good[order])


def _scores(batches: Iterator[pa.RecordBatch], model: Ranker) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([model.score(t.as_py()) for t in b.column(1)], pa.float64())], names=["row", "score"])


def score(docs: DataFrame, model: Ranker, keep: list[str], text_col: str = "text", cut: float = CUT) -> DataFrame:
    """The columns ``keep`` of every row with score and predicted (1 from ``cut`` on); one narrow pass."""
    bound_batches(docs.sparkSession)
    row = F.struct(*[F.col(c) for c in keep]).alias("row")
    kinds = docs.select(row).schema["row"].dataType.simpleString()
    out = docs.select(row, F.col(text_col).cast("string").alias("text")).mapInArrow(lambda it: _scores(it, model), f"row {kinds}, score double")
    return out.select("row.*", "score", (F.col("score") >= cut).cast("int").alias("predicted"))
