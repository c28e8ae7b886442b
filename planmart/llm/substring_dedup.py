"""Substring dedup by prefix-partitioned suffix trees over words.

A window of ``WINDOW`` consecutive words repeats if its words also start in a
document with a smaller id; every word covered by such a window is removed.

1. Exact copies: of equal texts only the one with the smallest id goes on; of
   the others all words are covered (if there are ``WINDOW`` of them).
2. Prefixes: in every window the place with the smallest hashed 5-gram is
   selected, so equal windows select the same place. 5-grams that only one
   document selects cannot lie in a repeat and are dropped.
3. Subtrees: the suffixes around the places that are left are partitioned by
   that 5-word prefix; one row holds the words around a place, from which all
   windows that selected it follow as suffixes that begin up to eight words
   before it. Prefixes have variable length: one with more than ``group_rows``
   places, by exact counts over the corpus, is lengthened to the whole window,
   under which a task holds a single one. A task sorts the suffixes of
   its groups, which is the order of their tree's leaves; the words that
   neighbours share are the depth of the node between them, and a node of depth
   ``WINDOW`` holds all occurrences of one window. Its first document keeps the
   words, all later ones lose them. Joined, the windows of a document are its
   maximal repeats.

Hot cases: whole windows that are heavy in the sample get their smallest
document from a folding aggregate over the corpus instead (a list of at most
``HEAVY_ROWS`` rows, broadcast; others stream through a task). 5-grams that the sample sees twice are known
to repeat, so they need no counting and are salted. The sample only decides
how rows are dealt, never what is found. A task holds one batch of rows and the
distinct windows of the group that it is in, of at most ``group_rows`` places.

Defined cases: null texts have no words; texts of fewer than ``WINDOW`` words
lose nothing; rows without an id neither remove nor lose words; rows that
repeat an id count as one document and never remove each other's words; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bound_batches, by_shuffle, materialize, shuffle_partitions
from .hashing import hashed_words, text_chunks

WINDOW, GRAM = 13, 5
SPAN = WINDOW - GRAM + 1  # 5-grams of a window
AROUND = WINDOW + SPAN - 1  # words around a place that its windows can hold
WORD_BYTES = 6  # of each word's hash that a row carries
SAMPLE = 64  # one document in so many is looked at for heavy prefixes and windows
GROUP_ROWS = 20_000  # places under one prefix: a task holds up to SPAN windows of 86 bytes for each, 16 MB
WINDOW_ROWS = 20_000  # rows of one window that may meet in one task (a sample tells which have more)
HEAVY_ROWS = 100_000  # longest list from the sample; broadcast; what it leaves out takes the plain way

_RNG = np.random.default_rng(13)
_MULTIPLIERS = (_RNG.integers(0, 1 << 63, 16, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


class Words:
    """The words of some texts as 64-bit hashes, with the windows and the places they select."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.hashes, self.doc = hashed_words(data, offsets)
        self.first = np.searchsorted(self.doc, np.arange(len(offsets)))  # word where each text begins
        at = np.arange(max(0, len(self.hashes) - WINDOW + 1))
        self.windows = at[at + WINDOW <= self.first[self.doc[:len(at)] + 1]] if len(at) else at

    def grams(self, n: int) -> np.ndarray:
        """Hash of the n words from each place on (also across texts; callers look at windows only)."""
        size = max(0, len(self.hashes) - n + 1)
        h = np.full(size, n, np.uint64)
        for k in range(n):
            h = (h ^ self.hashes[k:k + size]) * _MULTIPLIERS[k]
            h ^= h >> np.uint64(29)
        return h

    def selected(self) -> tuple[np.ndarray, np.ndarray]:
        """(5-gram hash, place) that each window selects: the smallest hash, the first of equals."""
        h, at = self.grams(GRAM), self.windows
        best, place = h[at], at.copy()
        for k in range(1, SPAN):
            other = h[at + k]
            lower = other < best
            best[lower], place[lower] = other[lower], at[lower] + k
        return best.view(np.int64), place

    def marks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(5-gram hash, text, places) of all selected places, each pair once."""
        mark, place = self.selected()
        fresh = np.ones(len(place), bool)
        fresh[1:] = place[1:] != place[:-1]
        mark, owner = mark[fresh], self.doc[place[fresh]]
        order = np.lexsort((mark, owner))
        mark, owner = mark[order], owner[order]
        fresh = np.ones(len(mark), bool)
        fresh[1:] = (mark[1:] != mark[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(fresh)
        return mark[first], owner[first], np.diff(np.append(first, len(mark)))

    def around(self, places: np.ndarray) -> np.ndarray:
        """Bytes of the words around each place, from SPAN-1 before it on (0 beyond the ends)."""
        at = places[:, None] + np.arange(1 - SPAN, WINDOW)
        inside = (at >= 0) & (at < len(self.hashes))
        words = np.where(inside, self.hashes[np.clip(at, 0, max(0, len(self.hashes) - 1))], np.uint64(0))
        return np.ascontiguousarray(words.astype(">u8").view(np.uint8).reshape(len(places), AROUND, 8)[:, :, :WORD_BYTES])


def chunks(texts: pa.Array) -> Iterator[tuple[int, Words]]:
    """(number of the first text, words) of consecutive texts."""
    for k, _, data, offsets in text_chunks(texts):
        yield k, Words(data, offsets)


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_key"].dataType.simpleString()


def _is_copy():
    return F.coalesce(F.array_contains("copies", F.md5(F.col("doc_text").cast("binary"))), F.lit(False))


def later_copies(docs: DataFrame) -> DataFrame:
    """doc_key, copies: digests of its texts that a smaller id also has."""
    keyed = docs.select("doc_key", F.md5(F.col("doc_text").cast("binary")).alias("digest"))
    first = materialize(keyed.groupBy("digest").agg(F.min("doc_key").alias("first"), F.count(F.lit(1)).alias("n"))
                        .where("n > 1").drop("n"), "first-copies")
    return (keyed.join(by_shuffle(first), "digest").where("doc_key > first").groupBy("doc_key")
            .agg(F.collect_set("digest").alias("copies")))  # one, unless rows share the id


def sampled_lists(docs: DataFrame, window_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """From a sample: 5-grams that two documents or more select; windows of more than ``window_rows`` rows (hashes, sorted)."""
    sample = docs.where(F.pmod(F.xxhash64("doc_key", F.lit(3)), F.lit(SAMPLE)) == 0).select("doc_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words in chunks(batch.column("doc_text")):
                found = [np.unique(h, return_counts=True) for h in (
                    words.marks()[0], words.grams(WINDOW)[words.windows].view(np.int64))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([0, 1], [len(h) for h, _ in found]).astype(np.int32)),
                     pa.array(np.concatenate([h for h, _ in found])), pa.array(np.concatenate([n for _, n in found]))],
                    names=["whole", "hash", "n"])

    least = max(2, window_rows // SAMPLE)
    counted = (sample.mapInArrow(run, "whole int, hash long, n long").groupBy("whole", "hash").agg(F.sum("n").alias("n"))
               .where(F.col("n") >= F.when(F.col("whole") == 0, 2).otherwise(least)))
    rows = [counted.where(F.col("whole") == whole).orderBy(F.desc("n"), "hash").limit(HEAVY_ROWS).collect() for whole in (0, 1)]
    return tuple(np.sort(np.array([x[1] for x in r], np.int64)) for r in rows)


def first_documents(docs: DataFrame, heavy: np.ndarray) -> dict[int, int]:
    """Smallest id of each heavy window, over all documents."""
    if not len(heavy):
        return {}
    sent = docs.sparkSession.sparkContext.broadcast(heavy)  # at most HEAVY_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, words in chunks(batch.column("doc_text")):
                h = words.grams(WINDOW)[words.windows].view(np.int64)
                hit = np.flatnonzero(np.isin(h, sent.value))
                if len(hit):
                    ids = batch.column("doc_key").to_numpy()[k + words.doc[words.windows[hit]]]
                    order = np.lexsort((ids, h[hit]))
                    window, ids = h[hit][order], ids[order]
                    first = np.concatenate(([True], window[1:] != window[:-1]))
                    yield pa.RecordBatch.from_arrays([pa.array(window[first]), pa.array(ids[first])], names=["hash", "doc_key"])

    found = docs.select("doc_key", "doc_text").mapInArrow(run, f"hash long, doc_key {_kind(docs)}")
    return {r[0]: r[1] for r in found.groupBy("hash").agg(F.min("doc_key")).collect()}  # at most HEAVY_ROWS


def repeated_marks(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """doc_key, marks, places: selected 5-grams of each document that other documents select too, and how often it does."""
    sent = docs.sparkSession.sparkContext.broadcast(known)  # at most HEAVY_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, words in chunks(batch.column("doc_text")):
                mark, owner, places = words.marks()
                owner = owner + k
                salt = np.where(np.isin(mark, sent.value), 1 + (owner * 31 + mark % 97) % 199, 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mark), pa.array(salt.astype(np.int16)), pa.array(places.astype(np.int32)),
                     batch.column("doc_key").take(pa.array(owner))], names=["mark", "salt", "places", "doc_key"])

    rows = docs.select("doc_key", "doc_text").mapInArrow(run, f"mark long, salt short, places int, doc_key {_kind(docs)}")
    same = F.count(F.lit(1)).over(Window.partitionBy("mark", "salt"))
    kept = rows.withColumn("n", same).where("n > 1 OR salt > 0")
    own = kept.groupBy("doc_key").agg(F.collect_list(F.struct("mark", "places")).alias("own"))  # of one document
    return own.select("doc_key", F.col("own.mark").alias("marks"), F.col("own.places").alias("places"))


def heavy_prefixes(marks: DataFrame, group_rows: int) -> np.ndarray:
    """5-grams selected at more than ``group_rows`` places, by exact counts (hashes, sorted).

    There is at most one per ``group_rows`` places of the whole corpus.
    """
    each = marks.select(F.explode(F.arrays_zip("marks", "places")).alias("m")).select("m.marks", "m.places")
    heavy = each.groupBy("marks").agg(F.sum("places").alias("n")).where(F.col("n") > group_rows).select("marks")
    return np.sort(np.array([r[0] for r in heavy.collect()], np.int64))


def suffix_rows(marked: DataFrame, heavy_marks: np.ndarray, firsts: dict[int, int]) -> DataFrame:
    """grp, doc_key, tag, place, open, known, words: one row per place (per window where its 5-gram is heavy).

    Bit j of ``open`` stands for the window that begins j words before the
    place; bit j of ``known`` for one that is already known to start in an
    earlier document.
    """
    windows = np.array(sorted(firsts), np.int64)
    sent = marked.sparkSession.sparkContext.broadcast(  # bounded lists, see above
        (heavy_marks, windows, np.array([firsts[h] for h in windows.tolist()])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengthened, settled, least = sent.value
        for batch in batches:
            marks = np.unique(batch.column("marks").flatten().to_numpy())  # repeated is a property of the 5-gram
            ids = batch.column("doc_key").to_numpy()
            for k, words in chunks(batch.column("doc_text")):
                mark, place = words.selected()
                use = np.flatnonzero(np.isin(mark, marks))
                if not len(use):
                    continue
                mark, place, start = mark[use], place[use], words.windows[use]
                owner = k + words.doc[start]
                bit = (1 << (place - start)).astype(np.int64)
                whole = words.grams(WINDOW)[start].view(np.int64)
                at = np.minimum(np.searchsorted(settled, whole), max(0, len(settled) - 1))
                done = settled[at] == whole if len(settled) else np.zeros(len(use), bool)
                late = done & (ids[owner] > least[at]) if len(settled) else done
                lone = np.isin(mark, lengthened) & ~done
                # a row per place; windows of heavy 5-grams stand alone, under their whole length
                new = np.ones(len(use), bool)
                new[1:] = (place[1:] != place[:-1]) | lone[1:] | lone[:-1]
                row = np.cumsum(new) - 1
                first = np.flatnonzero(new)
                open_ = np.bincount(row, np.where(done, 0, bit)).astype(np.int16)
                known = np.bincount(row, np.where(late, bit, 0)).astype(np.int16)
                some = np.flatnonzero((open_ != 0) | (known != 0))
                first, open_, known = first[some], open_[some], known[some]
                group = np.where(lone[first], whole[first], mark[first])
                group = np.where(open_ != 0, group, ids[owner[first]])  # nothing to settle: anywhere
                body = words.around(place[first]).reshape(len(first), AROUND * WORD_BYTES)
                sizes = np.where(open_ != 0, AROUND * WORD_BYTES, 0)
                ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                flat = pa.Array.from_buffers(pa.binary(), len(first), [
                    None, pa.py_buffer(ends.tobytes()), pa.py_buffer(body[open_ != 0].tobytes())])
                own = pa.array(owner[first])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group), batch.column("doc_key").take(own), batch.column("tag").take(own),
                     pa.array((place[first] - words.first[words.doc[place[first]]]).astype(np.int32)),
                     pa.array(open_), pa.array(known), flat],
                    names=["grp", "doc_key", "tag", "place", "open", "known", "words"])

    return marked.select("doc_key", "tag", "doc_text", "marks").mapInArrow(
        run, f"grp long, doc_key {_kind(marked)}, tag int, place int, open short, known short, words binary")


def node_depths(suffixes: np.ndarray) -> np.ndarray:
    """Words that each of the sorted suffixes (rows of bytes) shares with the one before it."""
    same = (suffixes[1:] == suffixes[:-1]).reshape(len(suffixes) - 1, WINDOW, WORD_BYTES).all(axis=2)
    return np.concatenate(([0], np.cumprod(same, axis=1).sum(axis=1)))


def settle_groups(dealt: DataFrame) -> DataFrame:
    """doc_key, tag, place, known: windows that start in an earlier document (rows come by group, then document)."""
    width = WINDOW * WORD_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_docs, held_group = np.zeros((0, width), np.uint8), np.zeros(0, np.int64), None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            group, docs = batch.column("grp").to_numpy(), batch.column("doc_key").to_numpy()
            open_, known = batch.column("open").to_numpy(), batch.column("known").to_numpy().copy()
            body = np.zeros((n, AROUND * WORD_BYTES), np.uint8)
            raw = batch.column("words")
            ends = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset:raw.offset + n + 1]
            if raw.buffers()[2] is not None:
                body[np.diff(ends) > 0] = np.frombuffer(raw.buffers()[2], np.uint8)[ends[0]:ends[-1]].reshape(-1, AROUND * WORD_BYTES)
            rows, back = np.nonzero((open_[:, None] >> np.arange(SPAN)) & 1)
            begin = (SPAN - 1 - back) * WORD_BYTES
            keys = body[rows[:, None], begin[:, None] + np.arange(width)]
            if held_group is None or group[0] != held_group:
                held, held_docs = held[:0], held_docs[:0]
            keys = np.ascontiguousarray(np.concatenate([held, keys]))
            owner = np.concatenate([held_docs, docs[rows]])
            if len(keys):
                # leaves of the subtrees in order; of equal ones the first document leads
                order = np.argsort(keys.view(f"V{width}").ravel(), kind="stable")
                node = np.cumsum(node_depths(keys[order]) < WINDOW) - 1
                lead = owner[order][np.searchsorted(node, np.arange(node[-1] + 1))]
                late = np.empty(len(keys), bool)
                late[order] = owner[order] > lead[node]
                mine = late[len(held):]
                np.bitwise_or.at(known, rows[mine], (1 << back[mine]).astype(np.int16))
                # the distinct windows of the group that may go on in the next batch
                firsts = order[np.searchsorted(node, np.arange(node[-1] + 1))]
                in_group = np.concatenate([np.full(len(held), held_group == group[-1]), group[rows] == group[-1]])
                firsts = firsts[in_group[firsts]]
                held, held_docs = keys[firsts], owner[firsts]
            held_group = group[-1]
            out = pa.array(np.flatnonzero(known))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(out) for c in ("doc_key", "tag", "place")), pa.array(known).take(out)],
                names=["doc_key", "tag", "place", "known"])

    kind = _kind(dealt)
    return dealt.select("grp", "doc_key", "tag", "place", "open", "known", "words").mapInArrow(
        run, f"doc_key {kind}, tag int, place int, known short")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_rows: int = GROUP_ROWS,
                   window_rows: int = WINDOW_ROWS) -> DataFrame:
    """One row per input row: doc_id, n_words, spans (word ranges [start, end) removed, maximal), kept_text."""
    bound_batches(df.sparkSession)
    # The tag tells apart texts that share an id. The columns get names of their own: a renamed column keeps its alias
    # on both sides of the later self-join, so the two exchanges of the texts are equal and Spark reuses the first.
    rows = df.select(F.col(id_col).cast("long").alias("doc_key"), F.col(text_col).alias("doc_text"),
                     F.xxhash64(F.col(text_col)).bitwiseAND(0x7FFFFFFF).cast("int").alias("tag"))
    docs = rows.where("doc_key IS NOT NULL AND doc_text IS NOT NULL")
    copies = materialize(later_copies(docs), "copies")
    known, heavy_windows = sampled_lists(docs, window_rows)
    firsts = first_documents(docs, heavy_windows)
    marks = materialize(repeated_marks(docs, known), "marks")
    heavy_marks = heavy_prefixes(marks, group_rows)
    marks = marks.drop("places")

    # from here on one query: both joins read the same exchange of the texts
    marked = (docs.join(by_shuffle(marks), "doc_key").join(by_shuffle(copies), "doc_key", "left").where(~_is_copy()))
    dealt = (suffix_rows(marked, heavy_marks, firsts).repartition(shuffle_partitions(df), "grp")
             .sortWithinPartitions("grp", "doc_key"))
    found = settle_groups(dealt).groupBy("doc_key").agg(F.collect_list(F.struct("tag", "place", "known")).alias("found"))
    joined = (docs.join(by_shuffle(found), "doc_key", "left").join(by_shuffle(copies), "doc_key", "left")
              .select("doc_key", "tag", "doc_text", "found", _is_copy().alias("copy")))
    apart = rows.where("doc_key IS NULL OR doc_text IS NULL").withColumn("found", F.lit(None).cast(joined.schema["found"].dataType)) \
        .select("doc_key", "tag", "doc_text", "found", F.lit(False).alias("copy"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            counts, spans, kept = [], [], []
            found, tags, copied = batch.column("found"), batch.column("tag").to_pylist(), batch.column("copy").to_pylist()
            for k, text in enumerate(batch.column("doc_text").to_pylist()):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                counts.append(len(words))
                at = np.zeros(0, np.int64)
                if copied[k]:
                    at = np.arange(max(0, len(words) - WINDOW + 1))
                elif found[k].is_valid:
                    own = found[k].values
                    mine = own.field("tag").to_numpy() == tags[k]
                    bits = own.field("known").to_numpy()[mine]
                    row, back = np.nonzero((bits[:, None] >> np.arange(SPAN)) & 1)
                    at = own.field("place").to_numpy()[mine][row] - back
                if not len(at):
                    spans.append([])
                    kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
                    continue
                edge = np.bincount(at, minlength=len(words) + 1) - np.bincount(at + WINDOW, minlength=len(words) + 1)
                gone = np.concatenate(([0], (np.cumsum(edge)[:-1] > 0).astype(np.int8), [0]))
                turn = np.flatnonzero(np.diff(gone)).tolist()
                spans.append([{"start": a, "end": b} for a, b in zip(turn[::2], turn[1::2], strict=True)])
                left = [w for a, b in zip([0, *turn[1::2]], [*turn[::2], len(words)], strict=True) for w in words[a:b]]
                kept.append(b" ".join(left).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_key"), pa.array(counts, pa.int64()), pa.array(spans, span),
                                              pa.array(kept, pa.string())], names=["doc_id", "n_words", "spans", "kept_text"])

    return joined.unionByName(apart).mapInArrow(
        run, "doc_id long, n_words long, spans array<struct<start:int,end:int>>, kept_text string")
