"""Quality by positive-unlabelled learning on surface statistics.

Trusted positives and unlabelled web text minimise the non-negative unbiased
risk under an estimated class prior. Each statistic of a text is one-hot
encoded by sample quantiles, so the linear model is additive and free in shape.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popflow.llm import nnpu
from popflow.llm.common import fold, text_or_empty
from popflow.llm.pu_sample import training_sample

SPACE = re.compile(r"[ \t-\r]+")
#: Sample quantiles that bound the bins of a statistic; the tails, where junk sits, get finer ones.
QUANTILES = (0.005, 0.01, 0.02, *np.arange(0.05, 0.96, 0.05), 0.98, 0.99, 0.995)
STATISTICS = (
    "log_words", "word_chars", "upper", "digits", "marks", "symbols", "spaces", "distinct",
    "repeats", "top_word", "pairs_distinct", "lines_distinct", "line_words", "short_words",
    "long_words", "sentence_ends", "marked_words", "upper_words", "bare_words", "non_ascii",
)


def statistics(text: str) -> list[float]:
    """Shares and logs in the order of STATISTICS, over the whole text."""
    words = [w for w in SPACE.split(text) if w]
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    size = len(chars)
    upper = ((chars >= 65) & (chars <= 90)).sum()
    lower = ((chars >= 97) & (chars <= 122)).sum()
    digits = ((chars >= 48) & (chars <= 57)).sum()
    wide = (chars > 127).sum()
    white = ((chars == 32) | ((chars >= 9) & (chars <= 13))).sum()
    plain = np.isin(chars, (33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63)).sum()
    symbols = size - upper - lower - digits - wide - white - plain
    letters = max(1, upper + lower + wide)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x]
    lengths = np.fromiter(map(len, words), float, n)
    ends = sum(w[-1] in ".!?" for w in words)
    marked = sum(not w[-1].isalnum() and w[-1] not in ".,;:!?\"')" for w in words)
    return [
        np.log1p(n), np.log1p(lengths.mean()), upper / letters, digits / size, plain / size,
        symbols / size, white / size, len(counts) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n, max(counts.values()) / n,
        len(set(zip(words, words[1:]))) / max(1, n - 1), len(set(lines)) / max(1, len(lines)),
        np.log1p(n / max(1, len(lines))), (lengths <= 3).mean(), (lengths >= 12).mean(),
        ends / n, marked / n, sum(w.isupper() for w in words) / n,
        sum(not any(map(str.isalnum, w)) for w in words) / n, wide / letters,
    ]


SAMPLED = pa.schema([("positive", pa.bool_()), ("half", pa.bool_()), ("x", pa.list_(pa.float64()))])
SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def _sampled(batches):
    for batch in batches:
        x = [list(map(float, statistics(t))) for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_pydict({"positive": batch["positive"], "half": batch["half"], "x": x}, schema=SAMPLED)


def encode(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """For each row and statistic the index of its bin between quantile cuts."""
    bins = len(QUANTILES) + 1
    return np.stack([j * bins + np.searchsorted(cuts[j], x[:, j], "left") for j in range(x.shape[1])], axis=1)


#: Weight of the squared weights in both fits.
L2 = 2e-4


def fit_quality(docs: DataFrame, labels: DataFrame, mod: int = 4, held: int = 2):
    """(cuts, model); no usable positives give no cuts and a model that scores 0."""
    sample = training_sample(docs, labels, "quality", mod, held)
    got = sample.mapInArrow(_sampled, "positive boolean, half boolean, x array<double>").collect()
    # Bounded by the sample; ordered here, so that sums do not depend on the tasks.
    got.sort(key=lambda r: (r["x"], r["half"]))
    xp, xu = (np.array([r["x"] for r in got if r["positive"] == kind], float).reshape(-1, len(STATISTICS))
              for kind in (True, False))
    half_p, half_u = (np.array([r["half"] for r in got if r["positive"] == kind]) for kind in (True, False))
    if not len(xp) or not len(xu):
        return None, nnpu.LinearModel(np.empty(0), -30.0)
    cuts = np.quantile(xu, QUANTILES, axis=0).T
    dim = len(STATISTICS) * (len(QUANTILES) + 1)
    xp, xu = (nnpu.Rows(encode(x, cuts).tolist(), dim) for x in (xp, xu))
    prior = nnpu.class_prior(xp, xu, half_p, half_u, l2=L2)
    if not 0 < prior < 1:
        return None, nnpu.LinearModel(np.empty(0), -30.0 if prior < 0.5 else 30.0)
    return cuts, nnpu.calibrated(nnpu.fit(xp, xu, prior, l2=L2), xp, xu, prior, 0.7)


def score_quality(docs: DataFrame, labels: DataFrame, mod: int = 4, held: int = 2,
                  threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts are scored as texts without words; repeated rows score
    alike; other columns are ignored. Only labels of 1 are read; the class prior
    is estimated from them and the unlabelled texts. Empty tables give no rows,
    without positive labels every score is 0, and 1 where nothing tells the
    unlabelled texts from the positives.
    """
    cuts, model = fit_quality(docs, labels, mod, held)

    def run(batches):
        for batch in batches:
            x = np.array([statistics(t) for t in batch["text"].to_pylist()], float).reshape(-1, len(STATISTICS))
            z = model.weights[encode(x, cuts)].sum(axis=1) if cuts is not None else np.zeros(len(x))
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "score": model.proba(z)}, schema=SCORED)

    return (docs.select("doc_id", text_or_empty().alias("text"))
            .mapInArrow(run, "doc_id long, score double")
            .select("doc_id", (fold(F.col("doc_id"), mod) == held).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
