"""Ranked lexical search over per-term lists cut into geometric blocks.

Documents are tokenised once into a stored table of the items' terms (a block
of items at a time; their vocabulary is a bounded broadcast) with counts; the
corpus figures N, L and df are aggregates of it over all documents. Tasks then
take bounded groups of documents as shards of the index. In a shard every term
has a list of the documents that hold it; a list longer than a block is
clustered by document similarity: each document goes to the nearest of evenly
spaced list members under random projections of the term vectors, and clusters
are cut into blocks. A block's summary holds, for each term, the largest
contribution of any of its documents.

A list's items are served from the heaviest term to the lightest. A block is
skipped only if its exact bound, the item's weights times the summary, is below
the score that the tenth best document is known to reach; documents with a
heavier term of the item were already met in that term's list, so only terms
from the list's own on count. The item ends when the bound of all remaining
lists fails. What survives is scored exactly, in 64-bit integers.

Scores to beat come from rounds over growing parts of the documents (by hash);
each round starts with the tenth score of the one before, the last round takes
all documents. A round's tasks send on at most ten rows an item, and about ten
divided by the part's share of the next in all.

Defined cases: a null or empty text has no terms, neither has a text without
letters and digits; an item without terms, or with none that occurs, has no
rows; documents without a score above 0 have none; equal scores by ascending
id, null ids last; repeated rows are ranked each, repeated items too; no rows
for empty tables; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from .common import bound_batches, materialize

TOP, LENGTH_SHARE = 10, 90
ITEM_BYTES = 4 << 20  # of item text in one block of items
SHARD_DOCS, SHARD_POSTINGS = 1 << 16, 4 << 20  # documents and postings in one shard of the index
BLOCK_DOCS, DIRECTIONS = 32, 16
ROUNDS = (4096, 64, 1)  # a round takes every document whose hash is divisible by this
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")  # in UTF-8 the pattern over code points is this one over bytes


def terms_of(text: str | None) -> list[bytes]:
    return _TERM.findall(text.encode("utf-8").lower()) if text else []


class Items:
    """One block of items: their ids, their terms as numbers of the vocabulary."""

    def __init__(self, rows: list):
        self.ids = [r[0] for r in rows]
        self.vocabulary: dict[bytes, int] = {}
        self.terms = [np.unique([self.vocabulary.setdefault(t, len(self.vocabulary)) for t in terms_of(r[1])]).astype(np.int64)
                      for r in rows]


def _item_blocks(items: DataFrame, block_bytes: int, id_col: str, text_col: str) -> Iterator[Items]:
    rows = items.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("item_id"), F.col(text_col).alias("item_text"))
    total = rows.agg(F.sum(F.octet_length("item_text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64("item_id", "item_text"), F.lit(n))
    for k in range(n):
        yield Items(rows.where(block == k).collect())  # about block_bytes


def term_table(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """doc_id, part, n (all terms of the text), terms (in the vocabulary, ascending), counts; texts without terms go."""
    id_type = docs.schema[id_col].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)  # bounded by the block of items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            rows, lengths, terms, counts = [], [], [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                words = terms_of(text)
                if words:
                    found = sorted((known[t], c) for t, c in Counter(words).items() if t in known)
                    rows.append(k)
                    lengths.append(len(words))
                    terms.append([t for t, _ in found])
                    counts.append([c for _, c in found])
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("part").take(at), pa.array(lengths, pa.int64()),
                 pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                names=["doc_id", "part", "n", "terms", "counts"])

    part = F.pmod(F.xxhash64(id_col, text_col), F.lit(ROUNDS[0])).cast("int").alias("part")
    rows = docs.select(F.col(id_col).alias("doc_id"), part, F.col(text_col).alias("text"))
    return materialize(rows.mapInArrow(run, f"doc_id {id_type}, part int, n long, terms array<int>, counts array<int>"), "terms")


class Shard:
    """The index of some documents: contributions by document and by term, blocks and summaries by list."""

    def __init__(self, ends: np.ndarray, terms: np.ndarray, values: np.ndarray, n_terms: int, queries: list[np.ndarray]):
        self.ends, self.terms, self.values = ends, terms, values  # rows of documents, one after another
        self.docs = len(ends) - 1
        order = np.argsort(terms, kind="stable")
        self.posting = np.repeat(np.arange(self.docs), np.diff(ends))[order]
        self.lists = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.most = np.zeros(n_terms, np.int64)
        filled = np.flatnonzero(np.diff(self.lists))
        if len(filled):
            self.most[filled] = np.maximum.reduceat(values[order], self.lists[filled])
        self.beside: dict[int, list[np.ndarray]] = {}  # of a term: the items' terms it stands beside
        for q in queries:
            for t in q:
                self.beside.setdefault(int(t), []).append(q)
        self.blocks: dict[int, tuple] = {}
        self.place = np.full(n_terms, -1)
        self._sketch = None

    def entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions of all entries of the documents, where each document's entries begin)."""
        size = self.ends[docs + 1] - self.ends[docs]
        begin = np.concatenate([[0], np.cumsum(size)])
        return np.repeat(self.ends[docs] - begin[:-1], size) + np.arange(begin[-1]), begin

    def sketch(self) -> np.ndarray:
        """Documents under random projections: unit vectors whose inner product tells how alike two documents are."""
        if self._sketch is None:
            rays = np.random.default_rng(11).standard_normal((len(self.place), DIRECTIONS)).astype(np.float32)
            out = np.zeros((self.docs, DIRECTIONS), np.float32)
            full = np.flatnonzero(np.diff(self.ends))
            for k in range(0, len(full), 4096):
                docs = full[k:k + 4096]
                at, begin = self.entries(docs)
                out[docs] = np.add.reduceat(rays[self.terms[at]] * self.values[at, None].astype(np.float32), begin[:-1])
            self._sketch = out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
        return self._sketch

    def cut(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents of the list in block order, where blocks begin)."""
        docs = self.posting[self.lists[t]:self.lists[t + 1]]
        if len(docs) <= BLOCK_DOCS:
            return docs, np.array([0, len(docs)])
        points = self.sketch()[docs]
        centres = points[::BLOCK_DOCS]
        near = np.concatenate([(points[k:k + 4096] @ centres.T).argmax(axis=1) for k in range(0, len(docs), 4096)])
        order = np.argsort(near, kind="stable")
        sizes = np.bincount(near, minlength=len(centres))
        begins = np.concatenate([np.arange(b, b + s, BLOCK_DOCS) for b, s in zip(np.cumsum(sizes) - sizes, sizes, strict=True)])
        return docs[order], np.append(begins, len(docs))

    def blocked(self, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(documents, where blocks begin, terms of the summaries, summaries): built when a list is first needed."""
        if t not in self.blocks:
            docs, begin = self.cut(t)
            columns = np.unique(np.concatenate(self.beside[t]))
            self.place[columns] = np.arange(len(columns))
            summary = np.zeros((len(begin) - 1, len(columns)), np.int32)
            for k in range(0, len(begin) - 1, 256):  # some blocks at a time
                b = begin[k:k + 257]
                at, ends = self.entries(docs[b[0]:b[-1]])
                block = np.repeat(np.arange(k, k + len(b) - 1), ends[b[1:] - b[0]] - ends[b[:-1] - b[0]])
                column = self.place[self.terms[at]]
                seen = column >= 0
                cell = block[seen] * len(columns) + column[seen]
                np.maximum.at(summary.reshape(-1), cell, self.values[at][seen].astype(np.int32))
            self.place[columns] = -1
            self.blocks[t] = docs, begin, columns, summary
        return self.blocks[t]

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        at, begin = self.entries(docs)
        total = np.concatenate([[0], np.cumsum(weight[self.terms[at]] * self.values[at])])
        return total[begin[1:]] - total[begin[:-1]]

    def search(self, terms: np.ndarray, weights: np.ndarray, floor: int, top: int) -> tuple[np.ndarray, np.ndarray, int, int]:
        """(documents, scores) that may be among the best ``top``, and how many blocks were scored and skipped."""
        weight = np.zeros(len(self.place), np.int64)
        weight[terms] = weights
        order = terms[np.lexsort((terms, -weights))]
        rest = np.cumsum((weight[order] * self.most[order])[::-1])[::-1]  # bound of the lists from here on
        met = np.zeros(self.docs, bool)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        taken = skipped = 0
        for k, t in enumerate(order):
            if rest[k] < max(floor, 1):
                break
            if self.lists[t] == self.lists[t + 1]:
                continue
            members, begin, columns, summary = self.blocked(int(t))
            later = order[k:]
            bound = summary[:, np.searchsorted(columns, later)].astype(np.int64) @ weight[later]
            by_bound = np.argsort(-bound, kind="stable")
            step = 8
            for j in range(0, len(by_bound), step):
                some = by_bound[j:j + step]
                some = some[bound[some] >= max(floor, 1)]
                if not len(some):
                    break
                taken += len(some)
                found = np.concatenate([members[begin[b]:begin[b + 1]] for b in some])
                found = found[~met[found]]
                met[found] = True
                got = self.scores(found, weight)
                keep = got >= max(floor, 1)
                docs, scores = np.concatenate([docs, found[keep]]), np.concatenate([scores, got[keep]])
                if len(scores) > top:
                    floor = max(floor, int(np.partition(scores, -top)[-top]))
                    keep = scores >= floor
                    docs, scores = docs[keep], scores[keep]
            skipped += int((bound < max(floor, 1)).sum())
        return docs, scores, taken, skipped


def contributions(n: np.ndarray, sizes: np.ndarray, counts: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """(10**9 tf) div (1000 tf + 8 m) with m = 10 + (90 n N) div L; ``sizes`` entries for each document."""
    if int(n.max(initial=0)) * LENGTH_SHARE * n_docs < 1 << 63:
        m = 100 - LENGTH_SHARE + LENGTH_SHARE * n * n_docs // n_terms
    else:
        m = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * int(x) * n_docs // n_terms for x in n], np.int64)
    return 1_000_000_000 * counts // (1000 * counts + 8 * np.repeat(m, sizes))


def _round(table: DataFrame, items: Items, item_type, weights: np.ndarray, floors: np.ndarray, stats: tuple[int, int],
           top: int) -> DataFrame:
    """item (number), item_id, doc_id, score: from each shard the documents that may be among the best."""
    id_type = table.schema["doc_id"].dataType.simpleString()
    item_arrow = to_arrow_type(item_type)
    sent = table.sparkSession.sparkContext.broadcast((items.ids, items.terms, len(items.vocabulary), weights, floors))

    def answers(ids: pa.Array, n, sizes, terms, counts) -> pa.RecordBatch:
        item_ids, queries, n_terms, weight, floor = sent.value
        values = contributions(n, sizes, counts, *stats)
        shard = Shard(np.concatenate([[0], np.cumsum(sizes)]), terms, values, n_terms, queries)
        item, doc, score = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k, q in enumerate(queries):
            docs, scores, _, _ = shard.search(q, weight[q], int(floor[k]), top)
            if len(docs) > top:  # equal scores by id
                best = pc.sort_indices(pa.table({"score": scores, "id": ids.take(pa.array(docs))}),
                                       [("score", "descending"), ("id", "ascending")], null_placement="at_end")
                docs, scores = docs[best[:top].to_numpy()], scores[best[:top].to_numpy()]
            item.append(np.full(len(docs), k))
            doc.append(docs)
            score.append(scores)
        number = pa.array(np.concatenate(item), pa.int32())
        return pa.RecordBatch.from_arrays(
            [number, pa.array(item_ids, item_arrow).take(number), ids.take(pa.array(np.concatenate(doc))),
             pa.array(np.concatenate(score), pa.int64())], names=["item", "item_id", "doc_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, postings = [], 0, 0

        def flush():
            whole = pa.Table.from_batches(held).combine_chunks()
            column = lambda c: whole.column(c).combine_chunks()
            lists = column("terms")
            return answers(column("doc_id"), column("n").to_numpy(), lists.value_lengths().to_numpy().astype(np.int64),
                           lists.flatten().to_numpy().astype(np.int64),
                           column("counts").flatten().to_numpy().astype(np.int64))

        for batch in batches:
            held.append(batch)
            docs += batch.num_rows
            postings += len(batch.column("terms").flatten())
            if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                yield flush()
                held, docs, postings = [], 0, 0
        if docs:
            yield flush()

    return table.where(F.size("terms") > 0).select("doc_id", "n", "terms", "counts").mapInArrow(
        run, f"item int, item_id {item_type.simpleString()}, doc_id {id_type}, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: for each item its ``top`` best documents of all."""
    spark = docs.sparkSession
    bound_batches(spark)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    out = None
    for block in _item_blocks(items, item_bytes, item_col, item_text_col):
        table = term_table(docs, block.vocabulary, id_col, text_col)
        n_docs, n_terms = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(block.vocabulary))
        for r in table.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # at most the vocabulary
            df[r[0]] = r[1]
        weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
        floors = np.zeros(len(block.ids), np.int64)
        for share in ROUNDS:
            part = table.where(F.col("part") % share == 0) if share > 1 else table
            found = _round(part, block, items.schema[item_col].dataType, weights, floors, (n_docs, n_terms), top)
            ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            if share > 1:
                for r in ranked.where(F.col("rank") == top).select("item", "score").collect():  # at most one an item
                    floors[r[0]] = r[1]
        ranked = ranked.select("item_id", "rank", "doc_id", "score")
        out = ranked if out is None else out.unionByName(ranked)
    return out
