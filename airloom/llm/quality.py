"""Quality classifier: regularised quadratic discriminant analysis.

A document becomes a dozen statistics, transformed so that clean prose lies
in one compact cloud. Class means and covariances come from one distributed
sum of moments over the labelled rows; each covariance is shrunk towards the
pooled one and a multiple of the identity. The score is the posterior of
label 1 from the difference of the class log densities, whose Mahalanobis
terms use Cholesky factors computed once on the driver.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import save, small_batches, text_bytes

FEATURES = (
    "log_bytes", "log_words", "word_length", "distinct_words", "top_word", "repeated_pairs",
    "upper", "digits", "marks", "odd_marks", "marked_words", "line_length", "repeated_lines", "short_words",
)
D = len(FEATURES)
# The marks of ordinary sentences; any other ASCII mark is odd.
SENTENCE_MARKS = b".,;:'\"?!()-"
_ASCII = np.arange(256)
_UPPER = (_ASCII >= 65) & (_ASCII <= 90)
_DIGIT = (_ASCII >= 48) & (_ASCII <= 57)
_LETTER = _UPPER | ((_ASCII >= 97) & (_ASCII <= 122)) | (_ASCII >= 128)
_MARK = (_ASCII > 32) & (_ASCII < 127) & ~_LETTER & ~_DIGIT
_ODD = _MARK & ~np.isin(_ASCII, np.frombuffer(SENTENCE_MARKS + b"!", np.uint8)) | (_ASCII == ord("!"))
_BLANK = np.isin(_ASCII, np.frombuffer(b" \t\n\r\x0b\x0c", np.uint8))


# Every text is measured as if it went on with so much ordinary prose, so that the
# shares of a text of a few words stay close to those of prose.
PRIOR_WORDS, PRIOR_BYTES, PRIOR_LINES = 25, 150, 2


def share(part: float, whole: float, prior: float = 0.0, typical: float = 0.0) -> float:
    """arcsin sqrt of a share, after ``prior`` more of the whole with the ``typical`` share."""
    return math.asin(math.sqrt(min(1.0, max(0.0, (part + prior * typical) / max(whole + prior, 1)))))


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of one whole text, in the order of FEATURES."""
    b = np.frombuffer(text, np.uint8)
    n = len(b)
    words = text.split()
    w = len(words)
    hist = np.bincount(b, minlength=256)
    letters, marks, odd = hist[_LETTER].sum(), hist[_MARK].sum(), hist[_ODD].sum()
    counts: dict[bytes, int] = {}
    for x in words:
        counts[x] = counts.get(x, 0) + 1
    again = max(0, w - 1 - len(set(zip(words, words[1:]))))
    lines = [x for x in text.split(b"\n") if x.strip()]
    is_odd, is_blank = _ODD[b], _BLANK[b]
    ends = int((is_odd[:-1] & is_blank[1:]).sum()) if n > 1 else 0
    short = sum(1 for x in counts if len(x) <= 3)
    pw, pb, pl = PRIOR_WORDS, PRIOR_BYTES, PRIOR_LINES
    return [
        math.log1p(n),
        math.log1p(w),
        math.log1p((n - hist[_BLANK].sum() + pb) / (w + pw)),
        share(len(counts), w, pw, 0.8) * math.log1p(w + pw) / 4,
        share(max(counts.values(), default=0), w, pw, 0.05),
        share(again, w - 1, pw, 0.02),
        share(hist[_UPPER].sum(), letters, pb, 0.03),
        share(hist[_DIGIT].sum(), n, pb, 0.001),
        share(marks, n, pb, 0.02),
        share(odd, n, pb),
        share(ends, w, pw),
        math.log1p((n + 200 * pl) / (len(lines) + pl)),
        share(len(lines) - len(set(lines)), len(lines), pl, 0.02),
        share(short, len(counts), pw, 0.2),
    ]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x array<double>) of every row; a null text counts as empty."""

    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([statistics(t) for t in text_bytes(b.column(1))], dtype=np.float64).reshape(-1, D)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, D), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), lists], names=["doc_id", "x"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(work, "doc_id long, x array<double>")


def held_out(doc_id: Column) -> Column:
    """Rows that never train: crc32 of the id as text leaves 0 by 5."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


@dataclass
class Model:
    """Per class (0, 1): mean, inverse Cholesky factor of the covariance, log density constant."""

    center: list
    scale: list
    mean: list
    whiten: list
    constant: list

    def score(self, x: np.ndarray) -> np.ndarray:
        """Posterior of label 1 for each row."""
        z = (x - np.array(self.center)) / np.array(self.scale)
        density = [c - 0.5 * (((z - np.array(m)) @ np.array(w).T) ** 2).sum(axis=1) for m, w, c in zip(self.mean, self.whiten, self.constant)]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))

    def to_json(self) -> str:
        return json.dumps(asdict(self))


def moments(rows: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Per class: count, sum of x, sum of x x'; one small row per class reaches the driver."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + D + D * D))
        for b in batches:
            y = b.column(0).to_numpy(zero_copy_only=False)
            x = b.column(1).flatten().to_numpy().reshape(-1, D)
            for c in (0, 1):
                xc = x[y == c]
                total[c] += np.concatenate(([len(xc)], xc.sum(axis=0), (xc.T @ xc).ravel()))
        c, i = np.divmod(np.arange(total.size), total.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(i), pa.array(total.ravel())], names=["c", "i", "v"])

    out = np.zeros((2, 1 + D + D * D))
    for c, i, v in rows.select("y", "x").mapInArrow(part, "c long, i long, v double").groupBy("c", "i").agg(F.sum("v")).collect():
        out[c, i] = v
    return {c: (int(out[c, 0]), out[c, 1 : 1 + D], out[c, 1 + D :].reshape(D, D)) for c in (0, 1)}


def fit(rows: DataFrame, shrink: float = 0.1, ridge: float = 0.02) -> Model:
    """QDA from rows (y 0 or 1, x). ``shrink``: share of the pooled covariance in each
    class's; ``ridge``: share of the identity after standardising. A class without
    rows gets the pooled cloud, so its score carries the prior alone."""
    m = moments(rows)
    n = sum(k for k, _, _ in m.values())
    if n == 0:
        eye = np.eye(D).tolist()
        return Model([0.0] * D, [1.0] * D, [[0.0] * D] * 2, [eye, eye], [0.0, 0.0])
    center = sum(s for _, s, _ in m.values()) / n
    total = sum(q for _, _, q in m.values()) / n - np.outer(center, center)
    scale = np.sqrt(np.maximum(np.diag(total), 1e-6))
    mean, cov = {}, {}
    for c, (k, s, q) in m.items():
        mu = s / k if k else center
        mean[c] = (mu - center) / scale
        cov[c] = ((q / k - np.outer(mu, mu)) if k else total) / np.outer(scale, scale)
    pooled = sum(cov[c] * m[c][0] for c in (0, 1)) / n
    whiten, constant = [], []
    for c in (0, 1):
        s = (1 - ridge) * ((1 - shrink) * cov[c] + shrink * pooled) + ridge * np.eye(D)
        root = np.linalg.cholesky(s)
        whiten.append(np.linalg.solve(root, np.eye(D)).tolist())
        constant.append(float(math.log((m[c][0] + 1) / (n + 2)) - np.log(np.diag(root)).sum()))
    return Model(center.tolist(), scale.tolist(), [mean[c].tolist() for c in (0, 1)], whiten, constant)


def training_rows(x: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(y, x) of the labelled rows of ``x`` (doc_id, x) that are not held out."""
    y = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
        .filter("y IN (0, 1) AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"), F.max("y").alias("_most"))
        .filter("y = _most")
        .drop("_most")
        .filter(~held_out(F.col("doc_id")))
    )
    return x.join(y, "doc_id")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, all columns as they are.

    Rows are judged where they lie: their statistics are computed again
    rather than joined. Training and odd cases as in ``classify``.
    """
    model = fit(training_rows(document_statistics(docs, id_col, text_col), labels))
    at = docs.columns.index(text_col)

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([statistics(t) for t in text_bytes(b.column(at))], dtype=np.float64).reshape(-1, D)
            yield b.filter(pa.array(model.score(x) >= threshold))

    return docs.mapInArrow(good, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """doc_id, held_out, score (posterior of label 1) and predicted of every row.

    Trains on all labelled rows that are not held out; labels, language,
    source and id are no inputs of the score. A null text counts as empty.
    An id with two different labels, or a null label or id, does not train.
    Rows with a null doc_id are scored and not held out. Repeated rows are
    returned (and train) as often as they come. Without any usable label
    every score is 0.5.
    """
    x = save(document_statistics(docs, id_col, text_col), "quality-statistics")
    model = fit(training_rows(x, labels, id_col, label_col))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.score(b.column(1).flatten().to_numpy().reshape(-1, D))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], names=["doc_id", "score"])

    scored = x.mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
