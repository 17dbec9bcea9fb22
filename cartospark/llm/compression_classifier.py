"""Quality classifier by compression: which labelled texts does a document compress with?

Method: one zstandard dictionary is built from good and one from bad labelled texts.  A text is cut into
pieces of PIECE bytes, so that the dictionaries and not the text itself do the work, and every piece is
compressed with either; the normalised difference ``(bad - good) / max(bad, good)`` of the total sizes
becomes a score through a logistic curve fitted on labelled texts that neither dictionary has seen.

The classifier is fitted on a bounded sample: up to SAMPLE_ROWS labelled documents a class, in hash order
of their ids, and SAMPLE_BYTES of text a class.  Every whole text is scored.  Inputs of the score are the
text's bytes alone.

Defined cases: null and empty texts have difference 0 and the curve's value there; without labels of both
classes the score is the share of label 1 among the labels, or 0.5; label rows with null are ignored; of
conflicting labels of one document the lower holds; rows repeat freely, and of those that share a sampled id the first by
text is learnt from.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 2400
SAMPLE_BYTES = 12_000_000
DICTIONARY_BYTES = 65_536
PIECE = 200
LEVEL = 3


@dataclass(frozen=True)
class Model:
    good: bytes | None
    bad: bytes | None
    slope: float
    intercept: float

    def scorer(self):
        if self.good is None or self.bad is None:
            return lambda text: self.intercept
        good, bad = (_compressor(x) for x in (self.good, self.bad))

        def score(text: str | None) -> float:
            return float(1 / (1 + np.exp(-(self.slope * _difference(good, bad, text) + self.intercept))))

        return score


def _compressor(dictionary: bytes):
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False).compress


def _difference(good, bad, text: str | None) -> float:
    raw = memoryview((text or "").encode())
    a = b = 0
    for at in range(0, len(raw), PIECE):
        piece = raw[at : at + PIECE]
        a += len(good(piece))
        b += len(bad(piece))
    return (b - a) / max(a, b, 1)


def _dictionary(texts: list[str]) -> bytes:
    pieces = [raw[at : at + PIECE] for raw in (t.encode() for t in texts) for at in range(0, len(raw), PIECE)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few texts to train on: their end as it is
        return b"".join(pieces)[-DICTIONARY_BYTES:] or b" " * 8


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton's method, with a weak pull to 0 that keeps separable data finite."""
    scale = float(np.abs(x).mean()) or 1.0
    data, w = np.stack((x / scale, np.ones_like(x)), axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-data @ w))
        hessian = data.T @ (data * (p * (1 - p))[:, None]) + np.diag((1e-2, 1e-6))
        step = np.linalg.solve(hessian, data.T @ (y - p) - np.array((1e-2, 1e-6)) * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-10:
            break
    return float(w[0] / scale), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0) -> Model:
    """Fit on labelled documents whose crc32 of the id as text is not ``held`` modulo ``modulus``."""
    each = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter("doc_id IS NOT NULL AND quality IN (0, 1)")
    each = each.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus != held)
    each = each.groupBy("doc_id").agg(F.min("quality").alias("quality")).withColumn("at", F.xxhash64("doc_id"))
    share = dict(each.groupBy("quality").count().collect())
    picked = [r for q in (0, 1) for r in each.filter(F.col("quality") == q).orderBy("at", "doc_id").limit(SAMPLE_ROWS).collect()]
    texts: dict[int, list[str]] = {0: [], 1: []}
    if picked:
        sample = docs.sparkSession.createDataFrame([(r[0], r[1], r[2]) for r in picked], "doc_id long, quality int, at long")
        joined = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("text IS NOT NULL").join(F.broadcast(sample), "doc_id")
        held_bytes = {0: 0, 1: 0}
        one = joined.groupBy("at", "doc_id", "quality").agg(F.min("text").alias("text"))
        for row in one.orderBy("at", "doc_id").toLocalIterator():  # SAMPLE_ROWS a class at most
            q = row["quality"]
            size = len(row["text"].encode())
            if held_bytes[q] + size <= SAMPLE_BYTES:  # texts that do not fit are passed over, and use nothing up
                held_bytes[q] += size
                texts[q].append(row["text"])
    total = sum(share.values())
    prior = share.get(1, 0) / total if total else 0.5
    if min(len(texts[0]), len(texts[1])) < 2:
        return Model(None, None, 0.0, prior)
    # two of three texts build the dictionaries, the others the curve
    build = {q: [t for k, t in enumerate(texts[q]) if k % 3 < 2] for q in (0, 1)}
    check = {q: [t for k, t in enumerate(texts[q]) if k % 3 == 2] or texts[q] for q in (0, 1)}
    good, bad = _dictionary(build[1]), _dictionary(build[0])
    a, b = _compressor(good), _compressor(bad)
    x = np.array([_difference(a, b, t) for q in (0, 1) for t in check[q]])
    y = np.repeat((0.0, 1.0), (len(check[0]), len(check[1])))
    slope, intercept = _logistic(x, y)
    # the sample has its own share of label 1
    shift = np.log((prior or 1e-6) / (1 - prior or 1e-6)) - np.log(y.mean() / (1 - y.mean()))
    return Model(good, bad, slope, intercept + float(shift))


def scored(docs: DataFrame, model: Model, modulus: int = 5, held: int = 0) -> DataFrame:
    """(doc_id, held_out, score) of every row; a null id has a null held_out."""

    def run(batches):
        score = model.scorer()
        for batch in batches:
            held_out = [None if d is None else zlib.crc32(str(d).encode()) % modulus == held for d in batch.column(0).to_pylist()]
            values = [score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held_out, pa.bool_()), pa.array(values, pa.float64())], names=["doc_id", "held_out", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, held_out boolean, score double")


def accepted(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of docs, all columns, with a score of at least the threshold; no shuffle."""

    def run(batches):
        score = model.scorer()
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array([score(t.as_py()) >= threshold for t in text], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
