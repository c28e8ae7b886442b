"""BPE encoding and decoding with a contiguous rank array.

A word is held as its parts (one per byte at first) and the ranks of adjacent
pairs, both contiguous. The smallest rank is found by scanning, its boundary
is deleted, and the ranks of the two neighbouring pairs are refreshed, until
no pair has a rank. The distinct short words of a batch form one matrix per
word length, and numpy does each of these steps for all of its words at once.
Words longer than ``SHORT`` bytes use a heap of pairs over linked parts, so a
text without any break stays near linear.

Normalisation, splitting and special tokens follow the tokenizer's file, whose
path is a parameter; the driver reads it and sends the vocabulary (its size is
the tokenizer's, not the corpus's) to the tasks. Texts are neither shuffled
nor cut.

Defined cases: a null text is the empty text, which has no ids and decodes to
the empty text; equal texts have equal ids; an empty table gives no rows;
further columns are carried in ``row``.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches

# Character tables differ between libraries by Unicode version. Blocks whose letters and numbers are new in
# Unicode 16, the version that the tokenizers library splits by (first and last code point) ...
SPLIT_KNOWS = ((0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105FF), (0x10D40, 0x10D8F), (0x10EC2, 0x10EC4),
               (0x11380, 0x113FF), (0x116D0, 0x116FF), (0x11BC0, 0x11BFF), (0x13460, 0x143FF), (0x16100, 0x1613F),
               (0x16D40, 0x16D7F), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5FF))
# ... and capitals newer than Python's table that it lower-cases: first, last, distance to the small letter.
CAPITALS = ((0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1),
            (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 0x20),
            (0x16EA0, 0x16EB8, 0x1B))

SHORT = 32  # bytes
CACHE_WORDS = 400_000
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 20, 24, SHORT)  # bytes; words of a group are padded to the next
NO_RANK = np.int32(2**31 - 1)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    codes = dict(zip(shown, shown, strict=True)) | {b: 256 + i for i, b in enumerate(hidden)}
    return [chr(codes[b]) for b in range(256)]


def read_tokenizer(path: str) -> dict:
    """What encoding needs of a tokenizers file of this kind (word-end BPE over byte symbols)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
    steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
    if model["type"] != "BPE" or steps != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None:
        raise ValueError("not a tokenizer of the kind that this encoder reads")
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    tokens = dict(sorted(((i, t) for t, i in vocab.items())))
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens |= {i: t for t, i in special.items()}
    symbols = byte_symbols()
    return {
        "tokens": [tokens.get(i, "") for i in range(max(tokens) + 1)],
        "first": np.array([vocab[s] for s in symbols], np.int32),
        "last": np.array([vocab[s + suffix] for s in symbols], np.int32),
        "left": np.array([vocab[a] for a, _ in pairs], np.int64),
        "right": np.array([vocab[b] for _, b in pairs], np.int64),
        "merged": np.array([vocab[a + b] for a, b in pairs], np.int32),
        "special": special,
        "split": spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"],
        "newer": newer_characters(),
    }


def newer_characters() -> str:
    """Ranges of letters and numbers that the ``regex`` module knows and the tokenizers library does not, for a class."""
    import regex

    known = regex.compile(r"[\p{L}\p{N}]")
    codes = [c for c in range(0xA0, 0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn"
             and known.match(chr(c)) and not any(a <= c <= b for a, b in SPLIT_KNOWS)]
    first = [c for k, c in enumerate(codes) if not k or codes[k - 1] != c - 1]
    last = [c for k, c in enumerate(codes) if k + 1 == len(codes) or codes[k + 1] != c + 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first, last, strict=True))


class Encoder:
    """Encodes words and texts; keeps the ids of a bounded number of words."""

    def __init__(self, spec: dict):
        import regex

        self.spec, self.tokens = spec, spec["tokens"]
        self.width = np.int64(len(self.tokens) + 1)
        keys = spec["left"] * self.width + spec["right"]
        self.by_key = np.argsort(keys, kind="stable")
        self.keys = keys[self.by_key]
        # white space is spelled out: the classes of the two pattern languages differ in control characters
        pattern, newer = spec["split"].replace(r"[^\s", r"[^\p{White_Space}"), spec["newer"]
        self.split = regex.compile(pattern)
        self.small = {c: c + by for a, b, by in CAPITALS for c in range(a, b + 1)}
        self.odd = regex.compile(f"[{newer}{''.join(map(chr, self.small))}]")
        # of the first 65,536 characters those that ``odd`` matches; beyond them any may
        self.maybe_odd = np.zeros(0x10001, bool)
        self.maybe_odd[[c for c in range(0x10000) if not 0xD800 <= c < 0xE000 and self.odd.match(chr(c))] + [0x10000]] = True
        if newer:
            known = {r"\p{L}": rf"[\p{{L}}--[{newer}]]", r"\p{N}": rf"[\p{{N}}--[{newer}]]"}
            for name, rest in known.items():
                pattern = pattern.replace(name, rest)
        self.split_odd = regex.compile(pattern, regex.V1)
        self.special = regex.compile("|".join(map(regex.escape, sorted(spec["special"], key=len, reverse=True)))) \
            if spec["special"] else None
        self.fixed = {t: (i,) for t, i in spec["special"].items()}  # no split word looks like one
        self.cache: dict[str, tuple[int, ...]] = dict(self.fixed)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of parts; NO_RANK where the pair never merges (or a part is absent, -1)."""
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.by_key[at], NO_RANK).astype(np.int32)

    def parts(self, word: bytes) -> np.ndarray:
        codes = np.frombuffer(word, np.uint8)
        ids = self.spec["first"][codes]
        ids[-1] = self.spec["last"][codes[-1]]
        return ids

    def encode_short(self, words: list[bytes], width: int) -> list[tuple[int, ...]]:
        """All words of at most ``width`` bytes at once: one row of parts and one of ranks per word."""
        sizes = np.array([len(w) for w in words])
        codes = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(sizes) - 1
        ids = self.spec["first"][codes]
        ids[ends] = self.spec["last"][codes[ends]]
        parts = np.full((len(words), width + 1), -1, np.int32)  # one place more, always empty
        parts[np.arange(width + 1) < sizes[:, None]] = ids
        done = parts.copy()
        rows = np.arange(len(words))  # of the words that may still merge
        ranks = np.full((len(words), width), NO_RANK, np.int32)
        ranks[:, :-1] = self.ranks(parts[:, :-2], parts[:, 1:-1])
        while rows.size and ranks.shape[1] > 1:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(rows.size), at]
            live = best < NO_RANK
            if not live.all():
                done[rows[~live], :parts.shape[1]] = parts[~live]
                done[rows[~live], parts.shape[1]:] = -1
                rows, parts, ranks, at, best = rows[live], parts[live], ranks[live], at[live], best[live]
            each = np.arange(rows.size)
            # delete the boundary behind `at`: what lies beyond moves one place forward, the merged part stands at `at`
            columns = np.arange(parts.shape[1] - 1)
            np.copyto(parts[:, :-1], parts[:, 1:], where=columns > at[:, None])
            np.copyto(ranks[:, :-1], ranks[:, 1:], where=columns[:-1] >= at[:, None])
            parts[each, at] = self.spec["merged"][best]
            parts, ranks = parts[:, :-1], ranks[:, :-1]  # every row that still merges is one part shorter
            # refresh the ranks on both sides of the merged part
            before = np.maximum(at - 1, 0)
            ranks[each, before] = np.where(at > 0, self.ranks(parts[each, before], parts[each, at]), ranks[each, before])
            after = np.minimum(at, ranks.shape[1] - 1)
            ranks[each, after] = np.where(after == at, self.ranks(parts[each, after], parts[each, after + 1]), ranks[each, after])
        done[rows, :parts.shape[1]] = parts
        done[rows, parts.shape[1]:] = -1
        return [tuple(row[:n]) for row, n in zip(done.tolist(), (done >= 0).sum(axis=1).tolist(), strict=True)]

    def encode_long(self, word: bytes) -> tuple[int, ...]:
        """One word by a heap of (rank, place) over linked parts."""
        ids = self.parts(word).tolist()
        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        lookup = dict(zip(self.keys.tolist(), self.by_key.tolist(), strict=True)) if n > 4096 else None

        def rank(i: int) -> int:
            if i < 0 or after[i] < 0:
                return int(NO_RANK)
            key = ids[i] * int(self.width) + ids[after[i]]
            if lookup is not None:
                return lookup.get(key, int(NO_RANK))
            at = int(np.searchsorted(self.keys, key))
            return int(self.by_key[at]) if at < len(self.keys) and self.keys[at] == key else int(NO_RANK)

        heap = [(r, i) for i in range(n) if (r := rank(i)) < NO_RANK]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] < 0 or rank(i) != r:
                continue
            gone = after[i]
            ids[i], after[i] = int(self.spec["merged"][r]), after[gone]
            ids[gone] = -1
            if after[gone] >= 0:
                before[after[gone]] = i
            for j in (before[i], i):
                if (r := rank(j)) < NO_RANK:
                    heapq.heappush(heap, (r, j))
        return tuple(i for i in ids if i >= 0)

    def encode_words(self, words: set[str]) -> dict[str, tuple[int, ...]]:
        raw = sorted(((w.encode("utf-8", "surrogatepass"), w) for w in words), key=lambda r: len(r[0]))
        sizes = np.array([len(r) for r, _ in raw])
        out, begin = {}, 0
        for width in WIDTHS:
            end = int(np.searchsorted(sizes, width, side="right"))
            if end > begin:
                ids = self.encode_short([r for r, _ in raw[begin:end]], width)
                out.update(zip([w for _, w in raw[begin:end]], ids, strict=True))
            begin = end
        out.update((w, self.encode_long(r)) for r, w in raw[begin:])
        return out

    def words(self, text: str) -> list[str]:
        """Normalised words, and special tokens as they stand, in order."""
        out: list[str] = []
        at = 0
        for m in self.special.finditer(text) if self.special and any(t in text for t in self.fixed) else ():
            out += self._plain(text[at:m.start()])
            out.append(m[0])
            at = m.end()
        return out + self._plain(text[at:] if at else text)

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            return self.split.findall(text.lower())
        # lower-cased character by character: a final sigma is no special case
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        if self.maybe_odd[np.minimum(codes, 0x10000)].any() and self.odd.search(text):
            return self.split_odd.findall(text.translate(self.small))
        return self.split.findall(text)

    def encode(self, texts: list[str]) -> list[list[int]]:
        split = [self.words(t) for t in texts]
        new = set().union(*split).difference(self.cache)
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache = dict(self.fixed)
            new = set().union(*split).difference(self.cache)
        self.cache.update(self.encode_words(new))
        get = self.cache.__getitem__
        return [list(chain.from_iterable(map(get, words))) for words in split]

    def decode(self, ids: list[int]) -> str:
        """Without a decoder in its file, a tokenizer joins tokens with a space."""
        return " ".join(map(self.tokens.__getitem__, ids))


def encode_decode(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """Every row as struct ``row`` with ids and decoded, the text that the ids decode to."""
    spark = docs.sparkSession
    bound_batches(spark)
    sent = spark.sparkContext.broadcast(read_tokenizer(tokenizer_path))  # the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(sent.value)
        for batch in batches:
            row = batch.column("row")
            ids = encoder.encode([t or "" for t in row.field(text_col).to_pylist()])
            flat = pa.array(np.fromiter(chain.from_iterable(ids), np.int32), pa.int32())
            ends = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in ids], dtype=np.int64))).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [row, pa.ListArray.from_arrays(ends, flat), pa.array([encoder.decode(x) for x in ids], pa.string())],
                names=["row", "ids", "decoded"])

    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, ids array<int>, decoded string")
