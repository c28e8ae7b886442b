"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark texts and documents are normalised alike: A-Z lower-cased, words are
runs of digits, letters and non-ASCII characters, joined by one space. Every
``window`` consecutive words of an item (all words of a shorter item) is a
pattern. One automaton over the word numbers of all patterns scans each
normalised document once, all texts of a batch side by side; hits are counted
in words and mapped back to character offsets of the original text.

Scale: each task builds the automaton from the item texts. These are sent in
blocks whose size is checked: ``block_bytes`` bounds the item texts of one
automaton, so neither driver nor executor ever holds more than one block. With
one block documents are never shuffled. A larger benchmark is scanned in as
many passes, each of which writes text digests and hits only; these join the
documents once, at the end.

Defined cases: a null document has no words; null or wordless items match
nothing; an item that occurs many times counts once; items with a null id
mark words but are not listed; repeated rows give equal results; an empty
benchmark hits nothing; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, by_shuffle, materialize

WINDOW = 10
BLOCK_BYTES = 8 << 20  # an automaton has at most WINDOW states per word of these
LANE = 256  # words of a lane of the scan

# Word characters are 0-9, a-z, A-Z and everything outside ASCII; in UTF-8 a byte says which it is.
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                  for b in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    """Normalised words as UTF-8 bytes."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


class Automaton:
    """Aho-Corasick over word numbers, its states in flat arrays.

    Patterns are all windows of the items. State 0 is the root; the states of one
    depth are numbered in the order of (state before, word), so ``edges``, the
    sorted list of these pairs, is the whole transition table: the edge at
    place k leads to state k + 1. A state costs 8 bytes for its edge, 4 for its
    failure link, 4 for its next output and 1 for its depth.
    """

    def __init__(self, items: Iterable[tuple[str | None, str | None]], window: int):
        self.numbers: dict[bytes, int] = {}  # 0 stands for words of no item
        self.ids: list[str | None] = []
        self.window = window
        texts, starts, sizes, owners, at = [], [], [], [], 0
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            texts.append(np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words], np.int32))
            size = min(window, len(words))
            n = len(words) - size + 1
            starts.append(np.arange(at, at + n))
            sizes.append(np.full(n, size, np.int8 if window < 128 else np.int32))
            owners.append(np.full(n, len(self.ids), np.int32))
            self.ids.append(item_id)
            at += len(words)
        self.edges, self.fail = np.zeros(0, np.int64), np.zeros(1, np.int32)
        if texts:
            self._grow(np.concatenate(texts), np.concatenate(starts), np.concatenate(sizes), np.concatenate(owners))

    def __len__(self) -> int:
        return len(self.edges)

    def _grow(self, words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, owners: np.ndarray) -> None:
        state = np.zeros(len(starts), np.int64)
        levels, last = [], 1
        for depth in range(self.window):
            on = np.flatnonzero(sizes > depth)
            if not len(on):
                break
            level, place = np.unique((state[on] << 32) | words[starts[on] + depth], return_inverse=True)
            state[on] = last + place
            levels.append(level)
            last += len(level)
        self.edges = np.concatenate(levels)
        self.first = np.zeros(len(self.numbers) + 1, np.int32)  # the root's edges by word
        self.first[levels[0]] = np.arange(1, len(levels[0]) + 1)
        self.depth = np.concatenate([[0], *(np.full(len(x), k + 1) for k, x in enumerate(levels))]).astype(sizes.dtype)
        ends = np.zeros(last, bool)  # states in which a pattern ends
        ends[state] = True
        self.fail, self.output = np.zeros(last, np.int32), np.zeros(last, np.int32)
        low = 1
        for k, level in enumerate(levels):  # links of one depth follow those of the depths before
            mine = np.arange(low, low + len(level))
            if k:
                self.fail[mine] = self.step(self.fail[level >> 32], (level & 0xFFFFFFFF).astype(np.int32))
            link = self.fail[mine]
            self.output[mine] = np.where(ends[mine], mine, self.output[link])
            low += len(level)
        pairs = np.unique((state << 32) | owners)  # the items of each pattern, together
        self.owner_state, self.owner = (pairs >> 32).astype(np.int32), (pairs & 0xFFFFFFFF).astype(np.int32)

    def step(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The states after one more word each."""
        out = np.zeros(len(state), np.int32)
        todo = np.flatnonzero(word)
        state, word = state[todo], word[todo]
        while len(todo):
            root = state == 0
            out[todo[root]] = self.first[word[root]]
            todo, state, word = todo[~root], state[~root], word[~root]
            key = (state.astype(np.int64) << 32) | word
            place = np.searchsorted(self.edges, key)
            found = self.edges[np.minimum(place, len(self.edges) - 1)] == key
            out[todo[found]] = place[found] + 1
            todo, state, word = todo[~found], self.fail[state[~found]], word[~found]
        return out

    def matches(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of its last word, state of its pattern) of every occurrence.

        Texts begin at ``first`` and are cut into lanes that advance together;
        a lane begins ``window - 1`` words early, which is all a state knows.
        """
        lengths = np.diff(np.append(first, len(words)))
        lanes = -(-lengths // LANE)
        text = np.repeat(np.arange(len(first)), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        fresh = first[text] + nth * LANE
        end = np.minimum(fresh + LANE, (first + lengths)[text])
        begin = np.maximum(fresh - self.window + 1, first[text])
        order = np.argsort(begin - end, kind="stable")  # longest first: lanes still running are a prefix
        fresh, end, begin = fresh[order], end[order], begin[order]
        size = end - begin
        state, places, states = np.zeros(len(order), np.int32), [], []
        for t in range(int(size[0]) if len(size) else 0):
            on = int(np.searchsorted(-size, -t, side="left"))
            at = begin[:on] + t
            state = self.step(state[:on], words[at])
            hit = np.flatnonzero((self.output[state] > 0) & (at >= fresh[:on]))
            found, at = self.output[state[hit]], at[hit]
            while len(found):
                places.append(at)
                states.append(found)
                found = self.output[self.fail[found]]  # the next shorter pattern that ends here
                at, found = at[found > 0], found[found > 0]
        return (np.concatenate(places), np.concatenate(states)) if places else (np.zeros(0, np.int64), np.zeros(0, np.int32))

    def scan(self, texts: list[str | None]) -> Iterator[tuple[int, list[int], list[str]]]:
        """(number of words, indices of the words inside any pattern, items hit) of each text."""
        get, parts = self.numbers.get, []
        for text in texts:
            parts.append(np.array([get(w, 0) for w in words_of(text)], np.int32))
        counts = np.array([len(x) for x in parts], np.int64)
        first = np.cumsum(counts) - counts
        words = np.concatenate([*parts, np.zeros(0, np.int32)])
        if not len(self):
            for n in counts.tolist():
                yield n, [], []
            return
        place, state = self.matches(words, first)
        size = self.depth[state].astype(np.int64)
        edge = (np.bincount(place - size + 1, minlength=len(words) + 1) - np.bincount(place + 1, minlength=len(words) + 1))
        hit = np.flatnonzero(np.cumsum(edge)[:-1] > 0)
        # items of the distinct patterns of each text
        pairs = np.unique(((np.searchsorted(first, place, side="right") - 1) << 32) | state)
        text, state = pairs >> 32, (pairs & 0xFFFFFFFF).astype(np.int32)
        low, high = (np.searchsorted(self.owner_state, state, side=side) for side in ("left", "right"))
        bound, items = np.searchsorted(text, np.arange(len(parts) + 1)), np.searchsorted(hit, np.append(first, len(words)))
        for k, n in enumerate(counts.tolist()):
            mine = {i for j in range(bound[k], bound[k + 1]) for i in self.owner[low[j]:high[j]].tolist()}
            yield (n, (hit[items[k]:items[k + 1]] - first[k]).tolist(),
                   sorted({self.ids[i] for i in mine if self.ids[i] is not None}))


def original_spans(text: str, hit_words: list[int]) -> list[tuple[int, int]]:
    """Character offsets [start, end) in the original text of each run of hit words."""
    hit, spans, last = set(hit_words), [], None
    for i, m in enumerate(WORD.finditer(text)):
        if i in hit:
            if last == i - 1 and spans:
                spans[-1] = (spans[-1][0], m.end())
            else:
                spans.append((m.start(), m.end()))
            last = i
    return spans


def _item_blocks(benchmark: DataFrame, block_bytes: int, id_col: str, text_col: str):
    """How many blocks, and the item texts of each, about ``block_bytes``: one small collect at a time."""
    rows = benchmark.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("item_text")).distinct()
    total = rows.agg(F.sum(F.octet_length("item_text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64("item_id", "item_text"), F.lit(n))
    return n, ([(r[0], r[1]) for r in rows.where(block == k).collect()] for k in range(n))  # about block_bytes each


_FOUND = ("n_words long, hit_words array<int>, items array<string>, spans array<struct<start:int,end:int>>")
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _found_batch(row: pa.Array, texts: list[str | None], found: Iterable[tuple[int, list[int], list[str]]]) -> pa.RecordBatch:
    counts, hits, items = (list(x) for x in zip(*found, strict=True)) if texts else ([], [], [])
    spans = [[{"start": a, "end": b} for a, b in original_spans(t, h)] if h else [] for t, h in zip(texts, hits, strict=True)]
    return pa.RecordBatch.from_arrays(
        [row, pa.array(counts, pa.int64()), pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string())),
         pa.array(spans, _SPANS)], names=["row", "n_words", "hit_words", "items", "spans"])


def _scan_once(rows: DataFrame, items: list, window: int, text_col: str) -> DataFrame:
    """A benchmark of one block: one scan gives everything."""
    sent = rows.sparkSession.sparkContext.broadcast(items)  # at most about block_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(sent.value, window)
        for batch in batches:
            texts = batch.column("row").field(text_col).to_pylist()
            yield _found_batch(batch.column("row"), texts, automaton.scan(texts))

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, {_FOUND}")


def _scan_block(keyed: DataFrame, items: list, window: int) -> DataFrame:
    """What one block of several hits: digest of the text and hits of the texts hit, nothing else."""
    sent = keyed.sparkSession.sparkContext.broadcast(items)  # at most about block_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(sent.value, window)
        for batch in batches:
            found = list(automaton.scan(batch.column("text").to_pylist()))
            some = [k for k, (_, hit, _) in enumerate(found) if hit]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest").take(pa.array(some, pa.int64())),
                 pa.array([found[k][1] for k in some], pa.list_(pa.int32())),
                 pa.array([found[k][2] for k in some], pa.list_(pa.string()))], names=["digest", "hit_words", "items"])

    once = keyed.mapInArrow(run, "digest string, hit_words array<int>, items array<string>")
    return once.groupBy("digest").agg(F.first("hit_words").alias("hit_words"), F.first("items").alias("items"))


def _add_hits(rows: DataFrame, text_col: str) -> DataFrame:
    """``row``, ``hit_words`` and ``items`` of all blocks completed by counts and offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("row").field(text_col).to_pylist()
            hits, items = batch.column("hit_words").to_pylist(), batch.column("items").to_pylist()
            yield _found_batch(batch.column("row"), texts, [
                (len(words_of(t)), h or [], i or []) for t, h, i in zip(texts, hits, items, strict=True)])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, {_FOUND}")


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                       text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Every document as struct ``row`` with n_words, hit_words (word indices), items (ids), spans (text offsets)."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    n, blocks = _item_blocks(benchmark, block_bytes, item_col, item_text_col)
    if n == 1:
        return _scan_once(rows, next(blocks), window, text_col)
    digest = F.md5(F.col("row")[text_col].cast("binary")).alias("digest")
    keyed = rows.select(digest, F.col("row")[text_col].alias("text")).where("text IS NOT NULL")
    hits = None
    for items in blocks:
        part = materialize(_scan_block(keyed, items, window), "hits")
        hits = part if hits is None else hits.unionByName(part)
    merged = hits.groupBy("digest").agg(*[  # at most one row per block
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("hit_words", "items")])
    return _add_hits(rows.withColumn("digest", digest).join(by_shuffle(merged), "digest", "left"), text_col)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold any window of an item: no shuffle, no join."""
    return find_contamination(docs, benchmark, **options).where(F.size("hit_words") == 0).select("row.*")
