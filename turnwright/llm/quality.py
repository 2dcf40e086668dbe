"""Quality classifier: regularised quadratic discriminant over document statistics (operator 4).

Each text gives a vector of transformed statistics. Each class has a mean and a covariance, shrunk towards the pooled
covariance and its diagonal; the score is the logistic of the difference of the two Gaussian log densities (Mahalanobis
distance by cached Cholesky factors) plus the log prior odds, at a temperature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnwright.llm import shingles as S
from turnwright.llm.common import in_arrow, map_arrow
from turnwright.storage import cut

CHARS = {
    "upper": [*range(65, 91)],
    "lower": [*range(97, 123)],
    "digit": [*range(48, 58)],
    "stop": [ord(c) for c in ".,;:?'\"()-"],
    "mark": [b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:?'\"()-"],
    "high": [*range(128, 256)],
    "line": [10],
}
NAMES = ("log_words", "word_length", "upper", "digit", "stop", "mark", "high", "line", "distinct", "repeat", "short", "bare", "heavy", "capital", "twice")
D = len(NAMES)
#: Labelled rows that the classifier is fitted on, about: those of smallest hash of their id.
FIT_ROWS = 50_000


def _sums(flags: np.ndarray, begin: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[begin[1:]] - total[begin[:-1]]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The statistics (texts x D) of one chunk of whole texts; all finite, for empty texts too."""
    hashes, starts, begins = S.words(data, offsets)
    n = np.diff(begins)
    some = np.maximum(n, 1)
    solid = ~S.SPACE[data]
    size = np.maximum(_sums(solid, offsets), 1)
    count = {}
    for name, members in CHARS.items():
        flag = np.zeros(256, bool)
        flag[members] = True
        count[name] = _sums(flag[data], offsets)
    length = np.add.reduceat(solid.astype(np.int64), starts) if len(starts) else starts
    flag = np.zeros(256, bool)
    flag[CHARS["upper"] + CHARS["lower"] + CHARS["high"]] = True
    letters = np.add.reduceat(flag[data].astype(np.int64), starts) if len(starts) else starts
    flag[:] = False
    flag[CHARS["upper"]] = True
    owner = np.repeat(np.arange(len(n)), n)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    _, first = S.ranked(hashes, begins)
    kinds = _sums(first, begins)
    firsts = np.flatnonzero(first)
    runs = np.diff(np.concatenate((firsts, [len(first)])))
    top = np.zeros(len(n), np.int64)
    if len(runs):
        top[n > 0] = np.maximum.reduceat(runs, (np.cumsum(kinds) - kinds)[n > 0])
    grams, at = S.shingles(hashes, begins, 3)
    once = _sums(S.ranked(grams, at)[1], at)
    n_grams = np.maximum(np.diff(at), 1)
    rate = lambda x, of=size: np.log((x + 0.5) / (of + 1.0))
    table = np.stack(
        [
            np.log1p(n),
            np.log(size / some),
            rate(count["upper"]),
            rate(count["digit"]),
            rate(count["stop"]),
            rate(count["mark"]),
            rate(count["high"]),
            rate(count["line"], some),
            np.log(np.maximum(kinds, 1)) - np.log(some) * 0.85,
            rate(_sums(same, begins), some),
            rate(_sums(length <= 3, begins), some),
            rate(_sums(letters == 0, begins), some),
            rate(top, some),
            rate(_sums(flag[data[starts]], begins) if len(starts) else np.zeros(len(n)), some),
            rate(n_grams - np.maximum(once, 1), n_grams),
        ],
        axis=1,
    )
    return table


@dataclass(frozen=True)
class Discriminant:
    """Two Gaussian classes; ``score`` is the probability of class 1."""

    centre: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, np.ndarray]
    factors: tuple[np.ndarray, np.ndarray]
    log_dets: tuple[float, float]
    log_odds: float
    temperature: float

    @classmethod
    def fit(cls, counts: np.ndarray, sums: np.ndarray, products: np.ndarray, shrink: float = 0.1, ridge: float = 0.05, temperature: float = 4.0) -> Discriminant:
        """From each class's count, sum of x and sum of x x'. With an empty class every score is the prior; where a class
        has no more rows than there are statistics, its covariance says little and both classes have the pooled one."""
        total = max(counts.sum(), 1)
        centre = sums.sum(0) / total
        scale = np.sqrt(np.maximum(np.diag(products.sum(0)) / total - centre**2, 1e-6))
        n = np.maximum(counts, 1)[:, None]
        means = (sums / n - centre) / scale * (counts > 0)[:, None]
        each = products / n[:, :, None] - (sums / n)[:, :, None] * (sums / n)[:, None, :]
        each = each / np.outer(scale, scale)
        pooled = (each * counts[:, None, None]).sum(0) / total
        factors, dets = [], []
        for c in (0, 1):
            cov = (1 - shrink) * each[c] + shrink * pooled if counts.min() > D else pooled.copy()
            cov = (1 - ridge) * cov + ridge * np.diag(np.diag(cov)) + 0.02 * np.eye(D)
            low = np.linalg.cholesky(cov)
            factors.append(np.linalg.inv(low))
            dets.append(2 * float(np.log(np.diag(low)).sum()))
        odds = float(np.log((counts[1] + 1) / (counts[0] + 1)))
        return cls(centre, scale, (means[0], means[1]), (factors[0], factors[1]), (dets[0], dets[1]), odds, temperature)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        density = [-0.5 * (((z - m) @ f.T) ** 2).sum(1) - 0.5 * d for m, f, d in zip(self.means, self.factors, self.log_dets, strict=True)]
        odds = (density[1] - density[0]) / self.temperature + self.log_odds
        return np.round(1 / (1 + np.exp(-np.clip(odds, -30, 30))), 9)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of 1, x and x x' of each class, from rows (y, text)."""
    total = np.zeros((2, D + 1, D + 1))
    for batch in batches:
        y = batch.column(0).to_numpy()
        for first, data, offsets in S.text_chunks(batch.column(1)):
            x = statistics(data, offsets)
            x = np.concatenate((np.ones((len(x), 1)), x), axis=1)
            own = y[first : first + len(x)]
            for c in (0, 1):
                total[c] += x[own == c].T @ x[own == c]
    flat = total.reshape(-1)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat)], ["i", "v"])


def held_out(id_col: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Discriminant:
    """The classifier, from docs (id, text) and labels (id, y) outside the held-out fold.

    Labels are chosen before any text is looked at: about ``rows`` of them, those of smallest hash of their id, so they
    may go to all executors and the texts stay where they lie. A label that is repeated counts once; an id with both
    labels counts for both; a document that is there several times counts as often. Class moments are summed in every
    partition, and the driver gets 2 (D + 1)^2 sums.
    """
    known = cut(labels.where("y in (0, 1)").where(~held_out("id")).distinct())
    n = known.count()
    if n > rows:
        known = known.where(F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(1 << 30)) < int((1 << 30) * rows / n))
    chosen = docs.join(F.broadcast(known), "id").select("y", "text")
    sums = in_arrow(chosen, _moments, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(2 * (D + 1) ** 2)
    for row in sums:
        total[row.i] = row.v
    total = total.reshape(2, D + 1, D + 1)
    return Discriminant.fit(total[:, 0, 0], total[:, 0, 1:], total[:, 1:, 1:])


def _base(df: DataFrame, id_col: str, other: str, name: str, kind: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(other).cast(kind).alias(name))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs.

    Learns from about ``fit_rows`` labelled rows whose crc32(doc_id) mod 4 isn't 2; label, language, source and id are
    no inputs of a score. Labels that are null or neither 0 nor 1, or have a null id, are left out. Null, empty and
    blank texts have statistics like any other, and a long one is taken whole. With no usable labels every score is 0.5.
    Each row has its own row out, repeated and null ids too, and an empty table none. Other columns are ignored.
    """
    base = _base(docs, id_col, text_col, "text", "string")
    model = fit(base, _base(labels, id_col, label_col, "y", "int"), fit_rows)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first, data, offsets in S.text_chunks(batch.column(1)):
            scores = model.score(statistics(data, offsets))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(scores)), pa.array(scores)], ["id", "score"])

    out = map_arrow(base, "id long, score double", work)
    return out.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of docs whose score reaches the threshold, with all their columns, judged where they lie."""
    model = fit(_base(docs, id_col, text_col, "text", "string"), _base(labels, id_col, label_col, "y", "int"), fit_rows)
    column = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in S.text_chunks(batch.column(column)):
                good = model.score(statistics(data, offsets)) >= threshold
                yield batch.slice(first, len(good)).filter(pa.array(good))

    return in_arrow(docs, run, docs.schema)
