"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of word 5-grams. Texts with equal sets are folded into one
class first. Every class gets ``HASHES`` MinHash values of 16 bits; classes
that agree in a band of ``ROWS`` values are candidates. Candidates are
compared a few MinHash values at a time, and a pair is dropped as soon as the
posterior probability that its similarity reaches the threshold, given the
values that agree so far, falls below ``tolerance``. What survives is verified
exactly on the whole sets.

No pair list is made: surviving pairs of a bucket only contribute a spanning
forest (fewer edges than members). The components of all forests hold every
candidate link. Inside a component the members are compared in the same way,
block by block, with a stricter tolerance; only pairs that survive are
verified by exact set intersections, and each block gives link counts per
class and again a spanning forest, now of verified links. N-gram sets are
hashed once, before members go to their blocks. A group of n near copies thus
shuffles and writes in proportion to n times its number of blocks.

Hot cases: copies fold map-side; buckets above ``BUCKET_BLOCK`` and components
above ``VERIFY_BLOCK`` members are split into blocks, and pairs of blocks are
spread over tasks.

A link may be missed only if its classes share no band (below 0.01 % at 0.8)
or are dropped by a comparison (0.0071 % over all comparisons at 0.8, less
above; ``tolerance`` bounds the posterior at each; below one in ten million
for the comparisons inside components); no false link is made.

Defined cases: null and wordless texts have no links and are their own class;
texts of fewer words than an n-gram are one n-gram of all words; a class is
named by its smallest id; rows that repeat id and text fall into one class; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, by_shuffle, materialize, shuffle_partitions
from .components import connected_components

N = 5
THRESHOLD = Fraction(4, 5)
HASHES, ROWS = 96, 4
BANDS = HASHES // ROWS
COMPARE = 16  # MinHash values compared at a time
TOLERANCE = 1e-5  # at each of the looks; over all of them a pair at the threshold is dropped with chance 7.1e-5
VERIFY_TOLERANCE = 1e-9  # at each of the looks inside a component, where most pairs are near
BUCKET_BLOCK, VERIFY_BLOCK = 1024, 256
DENSE = 4  # pairs a set from which a group of pairs is intersected by matrix products

_RNG = np.random.default_rng(20)
_MULTIPLIERS = (_RNG.integers(0, 1 << 63, 64, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_A = (_RNG.integers(0, 1 << 31, HASHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def ngram_set(text: str | None, n: int = N) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a text."""
    import xxhash

    words = (text or "").split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    w = np.fromiter((digest(x.encode("utf-8", "surrogatepass")) for x in words), np.uint64, len(words))
    size = min(n, len(words))
    h = np.full(len(w) - size + 1, size, np.uint64)
    for k in range(size):
        h = (h ^ w[k:len(w) - size + 1 + k]) * _MULTIPLIERS[k % len(_MULTIPLIERS)]
        h ^= h >> np.uint64(29)
    return np.unique(h)


def signature(grams: np.ndarray) -> np.ndarray:
    """``HASHES`` MinHash values of 16 bits."""
    x = (grams >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 1024):
        np.minimum(least, (x[i:i + 1024, None] * _A + _B).min(axis=0), out=least)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def least_matches(threshold: float = float(THRESHOLD), tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(values compared, agreements needed to go on).

    With a uniform prior the similarity given m agreements of n is Beta(m+1,
    n-m+1), so P(similarity >= t) = P(Binomial(n+1, t) <= m).
    """
    out = []
    for n in range(COMPARE, HASHES + 1, COMPARE):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def _survivors(sigs: np.ndarray, i: int, j: np.ndarray, needed: list[tuple[int, int]]) -> np.ndarray:
    """Those of ``j`` whose pair with i no comparison drops."""
    same = np.zeros(len(j), np.int64)
    for n, least in needed:
        if not len(j):
            break
        part = slice(n - COMPARE, n)
        same += (sigs[j, part] == sigs[i, part]).sum(axis=1)
        j, same = j[same >= least], same[same >= least]
    return j


def surviving_forest(sigs: np.ndarray, side: np.ndarray | None, needed: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spanning forest (i, j) of the pairs that no comparison dropped; with ``side``, of pairs across sides only."""
    group = np.arange(len(sigs))
    edges = []
    for i in range(len(sigs) - 1):
        j = np.arange(i + 1, len(sigs))
        j = j[group[j] != group[i]]  # pairs already joined add nothing
        if side is not None:
            j = j[side[j] != side[i]]
        for k in _survivors(sigs, i, j, needed):
            if group[k] != group[i]:
                group[group == group[k]] = group[i]
                edges.append((i, int(k)))
    return edges


def surviving_pairs(sigs: np.ndarray, side: np.ndarray | None, needed: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (i < j) of a block that no comparison dropped; with ``side``, those across sides only."""
    first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in range(len(sigs) - 1):
        j = np.arange(i + 1, len(sigs))
        j = _survivors(sigs, i, j if side is None else j[side[j] != side[i]], needed)
        first.append(np.full(len(j), i))
        second.append(j)
    return np.concatenate(first), np.concatenate(second)


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    n = len(sets)
    out = np.zeros((n, n), np.int64)
    if n <= 4:
        for i in range(n):
            out[i, i] = len(sets[i])
            for j in range(i):
                out[i, j] = out[j, i] = np.intersect1d(sets[i], sets[j], assume_unique=True).size
        return out
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[place] > 1
    owner = owner[shared]
    _, place = np.unique(place[shared], return_inverse=True)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    width = 4096
    for start in range(0, int(place[-1]) + 1 if len(place) else 0, width):
        a, b = np.searchsorted(place, (start, start + width))
        block = np.zeros((n, width), np.float32)
        block[owner[a:b], place[a:b] - start] = 1
        out += np.rint(block @ block.T).astype(np.int64)
    out[np.arange(n), np.arange(n)] = [len(s) for s in sets]
    return out


def spanning_forest(n: int, first: np.ndarray, second: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
    """(edges of a spanning forest of the pairs, group of each of the n places); pairs come in order of ``first``."""
    group = np.arange(n)
    edges = []
    bounds = np.searchsorted(first, np.arange(n + 1))
    for i in range(n):
        ends = second[bounds[i]:bounds[i + 1]]
        while len(ends := ends[group[ends] != group[i]]):
            edges.append((i, int(ends[0])))
            group[group == group[ends[0]]] = group[i]
    return edges, group


def pair_intersections(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs: by products of 0/1 rows where many pairs tie few sets, else one by one."""
    out = np.zeros(len(first), np.int64)
    _, group = spanning_forest(len(sets), first, second)
    owner = group[first]
    order = np.argsort(owner, kind="stable")
    for pairs in np.split(order, np.flatnonzero(np.diff(owner[order])) + 1):
        members = np.unique(np.concatenate((first[pairs], second[pairs])))
        if len(pairs) > DENSE * len(members):
            a, b = np.searchsorted(members, first[pairs]), np.searchsorted(members, second[pairs])
            out[pairs] = intersections([sets[k] for k in members])[a, b]
        else:
            for k in pairs:
                out[k] = np.intersect1d(sets[first[k]], sets[second[k]], assume_unique=True).size
    return out


def verified_links(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray,
                   threshold: Fraction = THRESHOLD) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(number of links of each set, spanning forest of the links) among the pairs, which come in order of ``first``."""
    inter = pair_intersections(sets, first, second)
    sizes = np.array([len(s) for s in sets], np.int64)
    linked = inter * threshold.denominator >= (sizes[first] + sizes[second] - inter) * threshold.numerator
    first, second = first[linked], second[linked]
    counts = np.bincount(first, minlength=len(sets)) + np.bincount(second, minlength=len(sets))
    return counts, spanning_forest(len(sets), first, second)[0]


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys (rows come sorted), also across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            v = np.array(c.to_pylist(), object)
            change[1:] |= v[1:] != v[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:], strict=False):
            key = tuple(c[a].as_py() for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _blocks(df: DataFrame, group: str, node: str, size: str, block: int) -> DataFrame:
    """Each row once per pair of blocks it belongs to: columns ``i <= j`` (the pair) and ``own``."""
    n = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64(node), n).cast("int")
    paired = df.withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0), n - 1))})
    return paired.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other", size)


def text_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, set_key (of the n-gram set; null without words), bands (packed MinHash values)."""
    bound_batches(df.sparkSession)
    rows = df.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, bands = [], []
            for text in batch.column("text").to_pylist():
                grams = ngram_set(text)
                keys.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None)
                bands.append(signature(grams).view(np.int64) if len(grams) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(keys, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "text_hash", "set_key", "bands"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_hash long, "
                                "set_key binary, bands array<long>")


def candidate_forest(classes: DataFrame) -> DataFrame:
    """Edges (u, v) between set keys: spanning forests of the candidates that survive pruning in each bucket."""
    parts = shuffle_partitions(classes)
    banded = classes.select("set_key", F.posexplode("bands").alias("band", "value")).select(
        "set_key", F.xxhash64("band", "value").alias("bucket"))
    sizes = materialize(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "buckets")
    members = materialize(banded.join(sizes, "bucket"), "members")
    placed = _blocks(members.join(classes.select("set_key", "bands"), "set_key"), "bucket", "set_key", "members", BUCKET_BLOCK)
    dealt = placed.repartition(parts, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    needed = least_matches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["bucket", "i", "j"]):
            sigs = group.column("bands").combine_chunks().flatten().to_numpy().view(np.uint16).reshape(-1, HASHES)
            keys = group.column("set_key").to_pylist()
            across = group.column("i")[0] != group.column("j")[0]
            forest = surviving_forest(sigs, group.column("own").to_numpy() if across else None, needed)
            if forest:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[a] for a, _ in forest], pa.binary()), pa.array([keys[b] for _, b in forest], pa.binary())],
                    names=["u", "v"])

    return dealt.select("bucket", "i", "j", "own", "set_key", "bands").mapInArrow(run, "u binary, v binary")


def verify(df: DataFrame, classes: DataFrame, groups: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Exact links inside candidate components: set_key, links (with one block of others), parent (forest edge or null)."""
    parts = shuffle_partitions(df)
    nodes = materialize(
        groups.join(classes.select("set_key", "first", "bands"), F.col("node") == F.col("set_key"))
        .select("component", "members", "set_key", "bands", "first.doc_id", "first.text_hash"), "nodes")
    texts = df.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("hash"), F.col(text_col).alias("text"))
    found = texts.join(by_shuffle(nodes), texts["id"].eqNullSafe(nodes["doc_id"]) & (texts["hash"] == nodes["text_hash"])).select(
        "component", "members", "set_key", "bands", "text")

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = pa.array([ngram_set(t).tobytes() for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], grams], names=["component", "members", "set_key", "bands", "grams"])

    hashed = found.mapInArrow(to_sets, "component binary, members long, set_key binary, bands array<long>, grams binary")
    dealt = (_blocks(hashed, "component", "set_key", "members", VERIFY_BLOCK)
             .repartition(parts, "component", "i", "j").sortWithinPartitions("component", "i", "j", "set_key"))
    needed = least_matches(tolerance=VERIFY_TOLERANCE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["component", "i", "j"]):
            keys = group.column("set_key").to_pylist()
            once = [k for k in range(len(keys)) if not k or keys[k] != keys[k - 1]]  # rows may repeat
            sigs = group.column("bands").combine_chunks().flatten().to_numpy().view(np.uint16).reshape(-1, HASHES)[once]
            own = group.column("own").to_numpy()[once] if group.column("i")[0] != group.column("j")[0] else None
            pairs = surviving_pairs(sigs, own, needed)
            if not len(pairs[0]):
                continue
            grams = group.column("grams")
            links, forest = verified_links([np.frombuffer(grams[k].as_py(), np.uint64) for k in once], *pairs)
            rows = [(keys[once[k]], int(n), None) for k, n in enumerate(links) if n]
            rows += [(keys[once[a]], 0, keys[once[b]]) for a, b in forest]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.binary())], names=["set_key", "links", "parent"])

    return dealt.select("component", "i", "j", "own", "set_key", "bands", "grams").mapInArrow(
        run, "set_key binary, links long, parent binary")


def ngram_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text_hash, class_id (smallest id of its component of links), class_hash
    (hash of that document's text), n_links (other n-gram sets at or above the threshold), n_copies (rows with
    its n-gram set)."""
    docs = materialize(text_classes(df, id_col, text_col), "sets")
    classes = materialize(
        docs.where(F.col("set_key").isNotNull()).groupBy("set_key")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first"),
             F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands")), "classes")
    groups = connected_components(materialize(candidate_forest(classes), "candidates"))
    links = materialize(verify(df, classes, groups, id_col, text_col), "links")
    labels = connected_components(links.where(F.col("parent").isNotNull()), "set_key", "parent")
    counts = links.groupBy("set_key").agg(F.sum("links").alias("n_links")).where("n_links > 0")
    linked = materialize(
        classes.select("set_key", "first", "copies").join(labels, F.col("set_key") == F.col("node"))
        .join(counts, "set_key").select("set_key", "component", "first", "copies", "n_links"), "linked")
    leaders = materialize(linked.groupBy("component").agg(F.min("first").alias("leader")), "leaders")
    alone = classes.where("copies > 1").join(linked, "set_key", "left_anti").select(
        "set_key", F.col("first").alias("leader"), F.lit(0).cast("long").alias("n_links"), "copies")
    named = materialize(linked.join(leaders, "component").select("set_key", "leader", "n_links", "copies")
                        .unionByName(alone), "named")
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    return docs.join(named, "set_key", "left").withColumn("leader", F.coalesce("leader", own)).select(
        "doc_id", "text_hash", F.col("leader.doc_id").alias("class_id"), F.col("leader.text_hash").alias("class_hash"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with one document of each class: that of the smallest id (and, of rows that repeat it, one).

    Only ids and hashes of the rows that go are joined back to the texts.
    """
    joined = materialize(ngram_join(df, id_col, text_col), "joined")
    keys = lambda rows: rows.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    leads = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_hash") == F.col("class_hash"))
    gone = materialize(keys(joined.where(~leads)), "near-copies")
    is_row = lambda rows: df[id_col].eqNullSafe(rows["_id"]) & (F.xxhash64(df[text_col]) == rows["_hash"])
    left = df.join(by_shuffle(gone), is_row(gone), "left_anti")
    twice = materialize(joined.where(leads & (F.col("n_copies") > 1)).groupBy("doc_id", "text_hash")
                        .agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "repeated-rows")
    if twice.isEmpty():  # the rule: ids name one row each
        return left
    twice = keys(twice)
    once = df.join(twice, is_row(twice), "left_semi").dropDuplicates([id_col, text_col])
    return left.join(twice, is_row(twice), "left_anti").unionByName(once)
