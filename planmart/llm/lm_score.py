"""LM scoring by masked pseudo-likelihood.

A window network predicts every token from ``SIDE`` tokens on each side: the
position-wise embeddings of the neighbours are summed, squashed, and feed a
two-level softmax (class of the token, token inside its class). It is trained
in numpy by stochastic gradient descent (Adagrad steps) on every token of
every document, in rounds: in each round every task trains a copy on its share
of documents, in steps that grow from ``FIRST_STEP`` to ``STEP`` tokens, and
Spark sums the copies weighted by their tokens into the next round's start. A document's score is the sum of the log-probabilities of all
its tokens.

Tokens are lower-cased words between ASCII white space, held as 64-bit hashes.
The vocabulary is every word of the corpus, counted into a table that grows
with it. The ``WORDS`` commonest have outputs of their own; the others share
``RARE`` outputs by their hash, and such a word's probability is that of its
output times its smoothed share (n + 1/2) / (T + V + 1/2) of the output's T
tokens and V words, which leaves as many unseen words as seen ones 1/2 each.
As neighbours, rare words stand as their output. Logs of the counts of up to
``HEAD`` commoner rare words are sent to the tasks; all others are joined.

The model has a fixed size, so it may be sent to every task; what is gathered
for it (word counts, one copy of the model per task and round) grows with the
corpus and is summed by Spark, never on the driver.

Defined cases: a null or wordless text has 0 tokens, log-likelihood 0 and no
mean; equal texts score alike; places beyond a text's ends are a token of
their own; an empty table gives no rows; further columns are carried in
``row``. Scores are repeatable up to the order in which Spark sums floats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, by_shuffle, materialize
from .hashing import hashed_words, text_chunks

CLASSES, PER_CLASS = 32, 32
VOCABULARY = CLASSES * PER_CLASS
RARE = 64
WORDS = VOCABULARY - RARE
HEAD = 1 << 17  # rare words looked up without a join, at most
SIDE, DIM = 2, 16
OFFSETS = tuple(o for o in range(-SIDE, SIDE + 1) if o)
CHUNK = 1 << 14  # tokens scored at once
STEP = 1 << 12  # tokens in a training step, at most
FIRST_STEP = 1 << 8  # tokens in the first steps of a task
SHAPES = {"emb": (len(OFFSETS), VOCABULARY + 1, DIM), "hid": (DIM,), "cls": (DIM, CLASSES), "cls_b": (CLASSES,),
          "tok": (CLASSES, DIM, PER_CLASS), "tok_b": (CLASSES, PER_CLASS)}

Params = dict[str, np.ndarray]


def batch_tokens(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last + 1, token hashes, text of each token) of consecutive texts."""
    for k, stop, data, offsets in text_chunks(pa.array([t and t.lower() for t in texts.to_pylist()], pa.large_string())):
        hashes, doc = hashed_words(data, offsets)
        yield k, stop, hashes, doc


def ids_of(hashes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Rank of each known token, a hashed id for the others."""
    rare = (WORDS + (hashes >> np.uint64(7)) % np.uint64(RARE)).astype(np.int32)
    if not len(vocabulary):
        return rare
    order = np.argsort(vocabulary)
    at = np.minimum(np.searchsorted(vocabulary[order], hashes), len(order) - 1)
    rank = order[at]
    return np.where(vocabulary[rank] == hashes, rank, rare).astype(np.int32)


def initial(seed: int = 42) -> Params:
    rng = np.random.default_rng(seed)
    return {k: (rng.normal(0, 0.1, s) if k in ("emb", "cls", "tok") else np.zeros(s)).astype(np.float32)
            for k, s in SHAPES.items()}


def contexts(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Neighbours of every token, by offset; VOCABULARY stands beyond a text's end."""
    at = np.arange(len(ids)) + SIDE * (doc + 1)
    line = np.full((at[-1] if len(at) else 0) + SIDE + 1, VOCABULARY, np.int32)
    line[at] = ids
    return np.stack([line[at + o] for o in OFFSETS])


def _exp(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(exp(z), its row sums); rows are shifted where that is needed against overflow."""
    if z.size and np.abs(z).max() > 60:
        z = z - z.max(axis=1, keepdims=True)
    e = np.exp(z)
    return e, e @ np.ones(z.shape[1], z.dtype)


def _log_share(z: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """Log of the softmax share of one entry of each row."""
    e, total = _exp(z)
    return np.log(np.maximum(e[np.arange(len(z)), pick], 1e-30) / total)


def hidden(p: Params, around: np.ndarray) -> np.ndarray:
    total = p["emb"][0][around[0]] + p["hid"]
    for k in range(1, len(OFFSETS)):
        total += p["emb"][k][around[k]]
    return np.tanh(total, out=total)


def _by_class(c: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(class, its rows) for the classes that occur."""
    order = np.argsort(c.astype(np.uint8), kind="stable")
    edges = np.concatenate(([0], np.cumsum(np.bincount(c, minlength=CLASSES))))
    for k in np.flatnonzero(np.diff(edges)):
        yield k, order[edges[k]:edges[k + 1]]


def log_probabilities(p: Params, targets: np.ndarray, around: np.ndarray) -> np.ndarray:
    """log P(token | both sides) of each token."""
    out = np.empty(len(targets), p["hid"].dtype)
    for i in range(0, len(targets), CHUNK):
        t, part = targets[i:i + CHUNK], slice(i, i + CHUNK)
        h = hidden(p, around[:, part])
        c = t // PER_CLASS
        score = _log_share(h @ p["cls"] + p["cls_b"], c)
        for k, rows in _by_class(c):
            score[rows] += _log_share(h[rows] @ p["tok"][k] + p["tok_b"][k], t[rows] % PER_CLASS)
        out[part] = score
    return out


def gradients(p: Params, t: np.ndarray, around: np.ndarray) -> Params:
    """Gradient of the summed negative log-probabilities."""
    n = len(t)
    h = hidden(p, around)
    c, w = t // PER_CLASS, t % PER_CLASS
    grad = {k: np.zeros_like(p[k]) for k in ("tok", "tok_b")}
    e, total = _exp(h @ p["cls"] + p["cls_b"])
    g = e / total[:, None]
    g[np.arange(n), c] -= 1
    grad["cls"], grad["cls_b"] = h.T @ g, g.sum(axis=0)
    back = g @ p["cls"].T
    for k, rows in _by_class(c):
        own = h[rows]
        e, total = _exp(own @ p["tok"][k] + p["tok_b"][k])
        g = e / total[:, None]
        g[np.arange(len(rows)), w[rows]] -= 1
        grad["tok"][k], grad["tok_b"][k] = own.T @ g, g.sum(axis=0)
        back[rows] += g @ p["tok"][k].T
    back *= 1 - h * h
    grad["hid"] = back.sum(axis=0)
    # sums per (offset, neighbour): rows in order of the neighbour, summed run by run
    grad["emb"] = np.zeros_like(p["emb"])
    for k in range(len(OFFSETS)):
        order = np.argsort(around[k].astype(np.int16), kind="stable")
        near = around[k][order]
        runs = np.flatnonzero(np.concatenate(([True], near[1:] != near[:-1])))
        grad["emb"][k][near[runs]] = np.add.reduceat(back[order], runs, axis=0)
    return grad


def train_step(p: Params, squares: Params, t: np.ndarray, around: np.ndarray, rate: float) -> None:
    """One Adagrad step, in place."""
    for k, g in gradients(p, t, around).items():
        g /= len(t)
        squares[k] += g * g
        p[k] -= rate * g / np.sqrt(squares[k])


def steps(n: int, seen: int) -> Iterator[slice]:
    """The training steps over n tokens of a task that has seen others: they grow, so that few tokens make steps too."""
    at = 0
    while at < n:
        size = min(STEP, max(FIRST_STEP, (seen + at) // 16))
        yield slice(at, min(n, at + size))
        at += size


def flat(p: Params) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPES])


def unflat(values: np.ndarray) -> Params:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k], at = values[at:at + n].reshape(s).astype(np.float32), at + n
    return out


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """word (its hash), n: every word of all documents."""
    bound_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, hashes, _ in batch_tokens(batch.column(0)):
                words, n = np.unique(hashes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "n"])

    words = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "word long, n long")
    return materialize(words.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def vocabulary(docs: DataFrame, text_col: str = "text", counts: DataFrame | None = None) -> np.ndarray:
    """Hashes of the commonest words of all documents, commonest first; ties by the hash."""
    counts = word_counts(docs, text_col) if counts is None else counts
    top = counts.orderBy(F.desc("n"), "word").limit(WORDS).collect()
    return np.array([r[0] for r in top], np.int64).view(np.uint64)


def rare_words(counts: DataFrame, words: np.ndarray) -> tuple[DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """(rare words with their counts, log(T + V + 1/2) of each rare output, head of them sorted, its log(n + 1/2))."""
    rare = counts.where(~F.col("word").isin(words.view(np.int64).tolist()))
    place = F.pmod(F.shiftrightunsigned("word", 7), F.lit(RARE))
    sizes = (rare.groupBy(place.alias("place"), F.floor(F.log2("n")).alias("power"))
             .agg(F.sum("n"), F.count(F.lit(1))).collect())  # RARE x 64 rows at most
    total, by_power = np.full(RARE, 0.5), np.zeros(65, np.int64)
    for at, power, n, distinct in sizes:
        total[at] += n + distinct
        by_power[power] += distinct
    least = 1 << int(np.flatnonzero(by_power[::-1].cumsum()[::-1] <= HEAD)[0])
    head = rare.where(F.col("n") >= least).collect() if least <= 1 << 62 else []  # HEAD rows at most
    hashes = np.array([r[0] for r in head], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return rare, np.log(total), hashes[order], np.log(np.array([r[1] for r in head], float)[order] + 0.5)


def train(docs: DataFrame, words: np.ndarray, rounds: int = 3, rate: float = 0.1, text_col: str = "text") -> Params:
    """Every document is trained on once, in the round that its hash names."""
    spark = docs.sparkSession
    bound_batches(spark)
    params = initial()
    for r in range(rounds):
        sent = spark.sparkContext.broadcast((params, words))  # of fixed size

        def learn(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            start, known = sent.value
            own = {k: v.copy() for k, v in start.items()}
            squares, seen = {k: np.full_like(v, 1e-8) for k, v in own.items()}, 0
            for batch in batches:
                for _, _, hashes, doc in batch_tokens(batch.column(0)):
                    t = ids_of(hashes, known)
                    around = contexts(t, doc)
                    order = np.random.default_rng(seen).permutation(len(t))
                    for part in steps(len(t), seen):
                        rows = order[part]
                        train_step(own, squares, t[rows], around[:, rows], rate)
                    seen += len(t)
            if seen:
                values = flat(own).astype(np.float64) * seen
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(values)), pa.int32()), pa.array(values), pa.array(np.full(len(values), seen))],
                    names=["place", "value", "weight"])

        share = docs.where(F.pmod(F.xxhash64(F.col(text_col), F.lit(11)), F.lit(rounds)) == r).select(F.col(text_col).alias("t"))
        sums = (share.mapInArrow(learn, "place int, value double, weight long").groupBy("place")
                .agg((F.sum("value") / F.sum("weight")).alias("value")).orderBy("place").collect())  # the model
        if sums:
            params = unflat(np.array([x[1] for x in sums]))
    return params


def score(docs: DataFrame, words: np.ndarray, params: Params, text_col: str = "text",
          counts: DataFrame | None = None) -> DataFrame:
    """Every row as struct ``row`` with n_tokens, log_likelihood and mean_log_likelihood.

    ``counts`` are the word counts of the corpus trained on, those of ``docs`` by default.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rare, *shares = rare_words(word_counts(docs, text_col) if counts is None else counts, words)
    sent = spark.sparkContext.broadcast((params, words, *shares))  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known, log_total, head, head_log = sent.value
        for batch in batches:
            row = batch.column("row")
            counts, sums, n_far = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            far_words, far_times = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for k, stop, hashes, doc in batch_tokens(row.field(text_col)):
                t = ids_of(hashes, known)
                logs = log_probabilities(own, t, contexts(t, doc)).astype(np.float64)
                at = np.flatnonzero(t >= WORDS)
                logs[at] -= log_total[t[at] - WORDS]
                if len(head):
                    place = np.minimum(np.searchsorted(head, hashes[at]), len(head) - 1)
                    found = head[place] == hashes[at]
                    logs[at[found]] += head_log[place[found]]
                    at = at[~found]
                counts[k:stop] = np.bincount(doc, minlength=stop - k)
                sums[k:stop] = np.bincount(doc, logs, minlength=stop - k)
                at = at[np.lexsort((hashes[at], doc[at]))]  # each far word once per text, with its times
                far, of = hashes[at], doc[at]
                first = np.flatnonzero(np.concatenate(([True], (far[1:] != far[:-1]) | (of[1:] != of[:-1])))[:len(at)])
                far_words.append(far[first])
                far_times.append(np.diff(np.append(first, len(at))))
                n_far[k:stop] = np.bincount(of[first], minlength=stop - k)
            far = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(n_far))), pa.int32()),
                pa.StructArray.from_arrays([pa.array(np.concatenate(far_words).view(np.int64)),
                                            pa.array(np.concatenate(far_times))], names=["word", "times"]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), row, pa.array(counts), pa.array(sums), far],
                                             names=["id", "row", "n_tokens", "near", "far"])

    rows = docs.select(F.monotonically_increasing_id().alias("id"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    scored = materialize(rows.mapInArrow(run, f"id long, row {rows.schema['row'].dataType.simpleString()}, n_tokens long, "
                                              "near double, far array<struct<word:long,times:long>>"), "scores")
    far = scored.select("id", F.inline("far")).join(by_shuffle(rare), "word", "left").groupBy("id").agg(
        F.sum(F.col("times") * F.log(F.coalesce("n", F.lit(0)) + 0.5)).alias("far"))
    total = F.col("near") + F.coalesce("far", F.lit(0.0))
    return scored.drop("far").join(by_shuffle(far), "id", "left").select(
        "row", "n_tokens", total.alias("log_likelihood"),
        F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_likelihood"))


def lm_score(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    counts = word_counts(docs, text_col)
    words = vocabulary(docs, text_col, counts)
    return score(docs, words, train(docs, words, text_col=text_col, **options), text_col, counts)
