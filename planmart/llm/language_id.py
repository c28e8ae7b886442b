"""Language ID: averaged hashed subword embeddings under a linear softmax.

Subwords are character 2-, 3- and 4-grams of lower-cased words (a word's ends
count as a character), hashed into ``buckets``. A text is the mean of its
subword embeddings; a linear softmax over that mean gives the language. Both
layers are trained by stochastic gradient descent in numpy on a bounded
sample of labelled rows (``sample_rows``, spread evenly over the labels);
a fifth of it calibrates a temperature and the rejection threshold: the
score below which fewer than ``reject_share`` of rightly predicted rows fall,
``max_threshold`` at most.

Prediction covers whole texts, needs no shuffle, and looks only at the text.
The trained model is ``buckets x labels`` numbers, both parameters.

Defined cases: a null text or one without letters is ``und`` with score 0 and
rejected; rows without a label or id are never learned from; with no labelled
row at all every text is ``und``; repeated rows and ties get equal results
(the first label in order wins a tie); an empty table gives no rows; further
columns are carried in ``row``; too many labels are an error, none is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches

BUCKETS = 8192
ORDERS = (2, 3, 4)
UNDETERMINED = "und"
_PIECE = 1 << 19  # characters handled at once


@dataclass
class Model:
    labels: list[str]
    table: np.ndarray  # buckets x labels: embeddings times the output layer
    bias: np.ndarray
    temperature: float
    threshold: float


def letter_table() -> np.ndarray:
    """Which of the first 65,536 characters are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(1 << 16)), bool, 1 << 16)


def _pieces(text: str) -> Iterator[str]:
    """``text`` cut at non-letters into pieces of bounded length (n-grams never span a non-letter)."""
    while len(text) > _PIECE:
        cut = next((i for i in range(_PIECE, _PIECE // 2, -1) if not text[i].isalpha()), _PIECE)
        yield text[:cut]
        text = text[cut:]
    yield text


def subwords(text: str, letters: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of every subword of one piece of text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters[np.minimum(codes, 0xFFFF)] if codes.size else np.zeros(0, bool)
    for i in np.flatnonzero(codes > 0xFFFF):
        is_letter[i] = chr(codes[i]).isalpha()
    c = np.zeros(codes.size + 2, np.uint64)
    c[1:-1] = np.where(is_letter, codes, 0)
    c = c[np.concatenate(([True], (c[1:] > 0) | (c[:-1] > 0)))]  # one boundary between words
    inner = c > 0
    out = []
    for n in ORDERS:
        if c.size < n:
            continue
        h = np.full(c.size - n + 1, n, np.uint64)
        ok = np.ones(h.size, bool)
        for k in range(n):
            part = slice(k, c.size - n + 1 + k)
            h = (h * np.uint64(0x100000001B3)) ^ c[part]
            if 0 < k < n - 1:
                ok &= inner[part]
        h = (h[ok] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        out.append((h % np.uint64(buckets)).astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def bucket_counts(text: str | None, letters: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    total = np.zeros(buckets, np.int64)
    for piece in _pieces((text or "").lower()):
        total += np.bincount(subwords(piece, letters, buckets), minlength=buckets)
    return total


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(x: np.ndarray, y: np.ndarray, labels: list[str], dim: int = 16, epochs: int = 30, least_steps: int = 2000,
        rate: float = 2.0, batch: int = 32, reject_share: float = 0.001, max_threshold: float = 0.4, seed: int = 42) -> Model:
    """Train on rows of subword shares ``x`` (each sums to 1) and label numbers ``y``."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, train = order[:len(y) // 5], order[len(y) // 5:]
    emb = rng.uniform(-1 / dim, 1 / dim, (x.shape[1], dim)).astype(np.float32) * 8
    out = np.zeros((dim, len(labels)), np.float32)
    bias = np.zeros(len(labels), np.float32)
    epochs = max(epochs, least_steps // max(1, -(-len(train) // batch)))
    steps, done = epochs * max(1, -(-len(train) // batch)), 0
    for _ in range(epochs):
        rng.shuffle(train)
        for i in range(0, len(train), batch):
            rows = train[i:i + batch]
            xb = x[rows]
            used = np.flatnonzero(xb.any(axis=0))
            xu = xb[:, used]
            hidden = xu @ emb[used]
            grad = softmax(hidden @ out + bias)
            grad[np.arange(len(rows)), y[rows]] -= 1
            step = rate * (1 - done / steps) / len(rows)
            d_hidden = grad @ out.T
            out -= step * hidden.T @ grad
            bias -= step * grad.sum(axis=0)
            emb[used] -= step * 32 * (xu.T @ d_hidden)
            done += 1
    table = emb @ out
    held = held if len(held) else order
    logits = x[held] @ table + bias
    temperature = min((0.25 * 1.25 ** k for k in range(20)), key=lambda t: -np.log(np.maximum(
        softmax(logits / t)[np.arange(len(held)), y[held]], 1e-12)).mean())
    probs = softmax(logits / temperature)
    right = probs.max(axis=1)[probs.argmax(axis=1) == y[held]]
    threshold = min(max_threshold, float(np.quantile(right, reject_share))) if len(right) else 0.0
    return Model(labels, table.astype(np.float32), bias, float(temperature), threshold)


def learnable(id_col: str = "doc_id") -> Column:
    """Rows that may be learned from; the others are held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != 2


def train(docs: DataFrame, sample_rows: int = 2500, max_labels: int = 4096, buckets: int = BUCKETS,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", **options) -> Model | None:
    """Fit on about ``sample_rows`` labelled rows, the same number of every label (two at least).

    More than ``max_labels`` labels are an error: the model holds ``buckets`` numbers for each.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.where(learnable(id_col) & F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label"))
    counts = {r[0]: r[1] for r in rows.groupBy("label").count().limit(max_labels + 1).collect()}
    if not counts:
        return None
    if len(counts) > max_labels:
        raise ValueError(f"more than {max_labels} labels in {label_col}; raise max_labels")
    want = max(2, sample_rows // len(counts))
    shares = spark.createDataFrame([(k, min(1 << 20, -(-want * (1 << 20) // n))) for k, n in counts.items()],
                                   "label string, share long")
    picked = rows.join(F.broadcast(shares), "label").where(  # max_labels rows
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < F.col("share"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            found = [bucket_counts(t, letters, buckets) for t in batch.column("text").to_pylist()]
            at = [np.flatnonzero(c) for c in found]
            share = [(c[i] / max(1, c.sum())).astype(np.float32) for c, i in zip(found, at, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label"), pa.array([i.astype(np.int32).tobytes() for i in at], pa.binary()),
                 pa.array([x.tobytes() for x in share], pa.binary())], names=["key", "label", "at", "share"])

    # packed numbers: about sample_rows rows of 8 bytes a bucket at most, in fact about a tenth of that
    packed = picked.select(F.xxhash64("doc_id", "text").alias("key"), "label", "text").mapInArrow(
        features, "key long, label string, at binary, share binary")
    sample = packed.distinct().drop("key").collect()  # rows that repeat altogether are picked together: they count once
    sample.sort(key=lambda r: (r[0], r[1], r[2]))  # the same model whatever order the tasks end in
    sample = [r for r in sample if r[1]]
    labels = sorted({r[0] for r in sample})
    if not labels:
        return None
    x = np.zeros((len(sample), buckets), np.float32)
    for i, r in enumerate(sample):
        x[i, np.frombuffer(r[1], np.int32)] = np.frombuffer(r[2], np.float32)
    return fit(x, np.array([labels.index(r[0]) for r in sample]), labels, **options)


def predict(texts: list[str | None], model: Model | None, letters: np.ndarray) -> tuple[list[str], list[float], list[bool]]:
    """Language, score and whether it is rejected, for each text."""
    known, scores, rejected = [], [], []
    for text in texts:
        if model is None or not text or not any(map(str.isalpha, text)):
            known.append(UNDETERMINED), scores.append(0.0), rejected.append(True)
            continue
        total, n = np.zeros(len(model.labels)), 0
        for piece in _pieces(text.lower()):
            at = subwords(piece, letters, len(model.table))
            total, n = total + np.bincount(at, minlength=len(model.table)) @ model.table, n + at.size
        probs = softmax((total / max(1, n) + model.bias)[None] / model.temperature)[0]
        best = int(probs.argmax())
        known.append(model.labels[best])
        scores.append(float(min(1.0, probs[best])))
        rejected.append(bool(probs[best] < model.threshold))
    return known, scores, rejected


def identify(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """Every row as struct ``row`` with lang_pred, score and rejected."""
    spark = docs.sparkSession
    bound_batches(spark)
    # buckets x labels numbers; plain values, as a broadcast is unpickled where the package may be missing
    sent = spark.sparkContext.broadcast(model and (model.labels, model.table, model.bias, model.temperature, model.threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, known_model = letter_table(), sent.value and Model(*sent.value)
        for batch in batches:
            row = batch.column("row")
            known, scores, rejected = predict(row.field(text_col).to_pylist(), known_model, letters)
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(known, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["row", "lang_pred", "score", "rejected"])

    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double, "
                                "rejected boolean")
