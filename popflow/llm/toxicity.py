"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic examples and unlabelled text fit a numpy linear model on word
and word-prefix presence; the prior-corrected risk makes up for the toxic rows
hidden among the unlabelled ones.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popflow.llm import nnpu
from popflow.llm.common import fold, staged, text_or_empty
from popflow.llm.pu_sample import training_sample

WORD = re.compile(r"[^\W\d_]+")
#: Bounded model size: features kept, and the least sample rows of a feature.
MAX_FEATURES = 2_048
MIN_ROWS = 4
#: Least standard score of a feature's share among positives against unlabelled.
MIN_Z = 3.5
PREFIXES = (4, 5, 6)
#: Distinct tokens a counting task holds before it hands partial counts on.
FLUSH_TOKENS = 400_000


def features(text: str) -> set[str]:
    """Words of the whole text, and their prefixes marked by a trailing star."""
    words = set(WORD.findall(text.lower()))
    out = set(words)
    for n in PREFIXES:
        out.update(w[:n] + "*" for w in words if len(w) >= n)
    return out


COUNTED = pa.schema([("token", pa.string()), ("p", pa.int64()), ("u", pa.int64())])
SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
VECTORS = pa.schema([("positive", pa.bool_()), ("half", pa.bool_()), ("ix", pa.list_(pa.int32()))])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    p, u = Counter(), Counter()

    def flush():
        keys = list(p.keys() | u.keys())
        out = pa.RecordBatch.from_pydict({"token": keys, "p": [p[k] for k in keys], "u": [u[k] for k in keys]},
                                         schema=COUNTED)
        p.clear(), u.clear()
        return out

    for batch in batches:
        for text, positive in zip(batch["text"].to_pylist(), batch["positive"].to_pylist()):
            (p if positive else u).update(features(text))
        if len(p) + len(u) > FLUSH_TOKENS:
            yield flush()
    yield flush()


def _vectors(vocabulary: dict[str, int]):
    def run(batches):
        for batch in batches:
            found = [sorted(vocabulary[t] for t in features(x) & vocabulary.keys()) for x in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_pydict({"positive": batch["positive"], "half": batch["half"], "ix": found},
                                             schema=VECTORS)
    return run


#: Weight of the squared weights in both fits.
L2 = 3e-3


def fit_toxicity(docs: DataFrame, labels: DataFrame, mod: int = 5,
                 held: int = 0) -> tuple[dict[str, float], float]:
    """Token weights and bias; no usable positives give no weights and a bias that rejects nothing."""
    sample = staged(training_sample(docs, labels, "toxic", mod, held), "toxic-sample")
    sizes = {r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()}
    n_p, n_u = sizes.get(True, 0), sizes.get(False, 0)
    if not n_p or not n_u:
        return {}, -30.0
    counts = sample.mapInArrow(_count, "token string, p long, u long").groupBy("token").agg(
        F.sum("p").alias("p"), F.sum("u").alias("u"))
    share = (F.col("p") + F.col("u")) / F.lit(float(n_p + n_u))
    z = (F.col("p") / n_p - F.col("u") / n_u) / F.sqrt(share * (1 - share + 1e-9) * (1 / n_p + 1 / n_u))
    chosen = [r["token"] for r in counts.where(F.col("p") + F.col("u") >= MIN_ROWS)
              .withColumn("z", F.abs(z)).where(F.col("z") >= MIN_Z)
              .orderBy(F.desc("z"), "token").limit(MAX_FEATURES).collect()]
    if not chosen:
        return {}, -30.0
    vocabulary = {t: i for i, t in enumerate(chosen)}
    got = sample.mapInArrow(_vectors(vocabulary), "positive boolean, half boolean, ix array<int>").collect()
    # Bounded by the sample and the model size; ordered here, so that sums do not depend on the tasks.
    got.sort(key=lambda r: (r["ix"], r["half"]))
    xp, xu = (nnpu.Rows([r["ix"] for r in got if r["positive"] == kind], len(chosen)) for kind in (True, False))
    half_p, half_u = (np.array([r["half"] for r in got if r["positive"] == kind]) for kind in (True, False))
    prior = nnpu.class_prior(xp, xu, half_p, half_u, l2=L2)
    if not 0 < prior < 1:
        return {}, (-30.0 if prior < 0.5 else 30.0)
    model = nnpu.calibrated(nnpu.fit(xp, xu, prior, l2=L2), xp, xu, prior, 0.5)
    return dict(zip(chosen, model.weights.tolist())), model.bias


def logits(texts: list[str | None], weights: dict[str, float]) -> np.ndarray:
    return np.array([sum(weights[t] for t in sorted(features(x or "") & weights.keys())) for x in texts], dtype=float)


def _scorer(weights: dict[str, float], bias: float):
    def run(batches):
        model = nnpu.LinearModel(np.empty(0), bias)
        for batch in batches:
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch["doc_id"], "score": model.proba(logits(batch["text"].to_pylist(), weights))},
                schema=SCORED)
    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, mod: int = 5, held: int = 0,
                   threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts are scored as texts without words. Repeated rows score
    alike; other columns of either table are ignored. Only labels of 1 are read;
    the class prior is estimated from them and the unlabelled texts. Empty tables
    give no rows. Without positives, or where no word tells them from unlabelled
    text, every score is 0.
    """
    weights, bias = fit_toxicity(docs, labels, mod, held)
    return (docs.select("doc_id", text_or_empty().alias("text"))
            .mapInArrow(_scorer(weights, bias), "doc_id long, score double")
            .select("doc_id", (fold(F.col("doc_id"), mod) == held).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents scored below the threshold, with all their columns."""
    weights, bias = fit_toxicity(docs, labels)

    def keep(batches):
        model = nnpu.LinearModel(np.empty(0), bias)
        for batch in batches:
            z = logits(batch["text"].to_pylist(), weights)
            yield batch.filter(pa.array(model.proba(z) < threshold))

    return docs.mapInArrow(keep, docs.schema)
