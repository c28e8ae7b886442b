"""Words of many texts at once as 64-bit hashes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 22  # of text hashed at once
_FNV = np.uint64(0x100000001B3)
_SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])  # the bytes between words, in UTF-8 too


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of its text) for texts that lie one after another in ``data``.

    Words are what stands between ASCII white space; they end with their text.
    """
    space = _SPACE[data]
    border = np.zeros(len(data) + 1, bool)  # a text begins here
    border[offsets] = True
    begin = ~space
    begin[1:] &= space[:-1] | border[1:-1]
    end = ~space
    end[:-1] &= space[1:] | border[1:-1]
    starts = np.flatnonzero(begin)
    sizes = np.flatnonzero(end) + 1 - starts
    order = np.argsort(-sizes, kind="stable")
    at, left = starts[order], sizes[order]
    h = np.full(len(at), 0xCBF29CE484222325, np.uint64)
    longer = len(at) - np.searchsorted(left[::-1], np.arange(1, (left[0] if len(left) else 0) + 1))
    for k, n in enumerate(longer):  # the n words that have a byte k
        h[:n] = (h[:n] ^ data[at[:n] + k]) * _FNV
    out = np.empty_like(h)
    out[order] = mix(h)
    return out, np.searchsorted(offsets, starts, side="right") - 1


def text_chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last + 1, bytes, offsets) of consecutive texts, about ``CHUNK_BYTES`` at a time; null is empty."""
    big = pa.types.is_large_string(texts.type)
    if texts.null_count:
        texts = texts.fill_null("")
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64 if big else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) \
        if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    k = 0
    while k < len(texts):
        stop = int(np.searchsorted(offsets, offsets[k] + CHUNK_BYTES, side="right")) - 1
        stop = min(max(k + 1, stop), len(texts))
        yield k, stop, data[offsets[k]:offsets[stop]], offsets[k:stop + 1] - offsets[k]
        k = stop
