"""Secret scan: fixed patterns and a battery of randomness tests.

Patterns find assignments, access keys and hex strings. Beside them every run
of 20 or more token characters is a candidate; ``=`` belongs to it as padding
at its end only, so the value of ``NAME=value`` is one. A run that fits no
encoding is split at the separators that base64 and base64url do not hold, and
at all of them; its parts of 20 or more characters are candidates. The encoding
(hex, base32, single-case letters or alphanumerics, mixed-case, base64) is
inferred, and three tests look for deviations from randomness over that alphabet:
chi-squared uniformity, runs above and below the middle, and lag-one serial
correlation; Fisher's method combines them (``p_random``). The null to be
rejected is that the candidate is ordinary text: text repeats symbols with an
index of coincidence of ``TEXT_IC``, so its chi-squared statistic has a
non-central distribution whose centre grows with length; ``p_text`` is the
chance of a statistic as small as seen. Short strings cannot reach a small
``p_text``. Benjamini-Hochberg control at rate ``fdr`` inside each length
class, over all candidates of the corpus, sets the thresholds; a candidate
below its threshold that the battery does not reject is reported as ``random``,
unless it lies in a longer one.

Scale: one pass over the texts writes spans and candidates (no texts); the
thresholds come from a histogram of a few hundred counts per length class;
spans are chosen by sweeps over sorted lists, so time grows with a text's
candidates, not with their square.

Defined cases: a null or empty text has no spans; equal texts have equal
spans; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, materialize

# The patterns of the contract, kinds in the order listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}(?:={1,2}(?![A-Za-z0-9+/=_-]))?")
PARTS = (re.compile(r"[A-Za-z0-9+/=]{20,}"), re.compile(r"[A-Za-z0-9_=-]{20,}"), re.compile(r"[A-Za-z0-9=]{20,}"))
TEXT_IC = 0.065  # index of coincidence of ordinary text over 26 letters
LENGTH_CLASSES = (20, 32, 48, 80)  # least length of each class
BINS = 300  # of -log10(p), a tenth each
_TOKEN_BYTES = bytes(b if chr(b).isascii() and (chr(b).isalnum() or chr(b) in "+/=_-") else 32 for b in range(256))

ENCODINGS = (  # the first that holds every character of the token
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("lower", "abcdefghijklmnopqrstuvwxyz"),
    ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("alnum_lower", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("alnum_upper", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("letters", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("alnum", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
_SETS = tuple((name, frozenset(alphabet), {c: i for i, c in enumerate(alphabet)}) for name, alphabet in ENCODINGS)


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by start, then kind as listed."""
    out = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    if max(map(len, text.encode("utf-8", "surrogatepass").translate(_TOKEN_BYTES).split()), default=0) >= LEAST["hex"]:
        out += [("hex", m.start(), m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _tail(z: float) -> float:
    """P(Z >= z) of the normal distribution."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(token: str) -> tuple[str, float, float] | None:
    """(encoding, p_text, p_random); None where no encoding fits or all characters are digits."""
    body = token.rstrip("=")
    used = set(body)
    fit = next(((name, index) for name, chars, index in _SETS if used <= chars), None)
    if fit is None or body.isdigit() or len(body) < 2:
        return None
    name, index = fit
    x = np.fromiter((index[c] for c in body), np.int64, len(body))
    k, n = len(index), len(x)
    counts = np.bincount(x, minlength=k)
    chi2 = k / n * float(counts @ counts) - n
    p_uniform = _tail((chi2 - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n))
    high = x >= k / 2
    n1 = int(high.sum())
    n0, runs = n - n1, 1 + int((high[1:] != high[:-1]).sum())
    if n1 and n0 and (var := 2 * n1 * n0 * (2 * n1 * n0 - n) / (n * n * (n - 1))) > 0:
        p_runs = 2 * _tail(abs(runs - 1 - 2 * n1 * n0 / n) / math.sqrt(var))
    else:
        p_runs = 2.0 ** (1 - n)
    a, b = x[:-1] - x[:-1].mean(), x[1:] - x[1:].mean()
    spread = math.sqrt(float(a @ a) * float(b @ b))
    p_serial = 2 * _tail(abs(float(a @ b) / spread) * math.sqrt(n - 1)) if spread else 0.0
    half = -sum(math.log(min(1.0, max(p, 1e-300))) for p in (p_uniform, p_runs, p_serial))
    p_random = math.exp(-half) * (1 + half + half * half / 2)  # chi-squared of 6 degrees, upper tail
    excess = n * max(0.7, k * TEXT_IC - 1)
    p_text = _tail(-(chi2 - (k - 1 + excess)) / math.sqrt(2 * (k - 1 + 2 * excess)))
    return name, p_text, p_random


def tested(text: str) -> Iterator[tuple[int, int, tuple[str, float, float]]]:
    """(start, end, test results) of the candidates of a text."""
    for m in CANDIDATE.finditer(text):
        if found := battery(m[0]):
            yield m.start(), m.end(), found
        else:
            for a, b in sorted({p.span() for part in PARTS for p in part.finditer(text, *m.span())} - {m.span()}):
                if found := battery(text[a:b]):
                    yield a, b, found


def candidates(text: str) -> list[dict]:
    if max(map(len, text.encode("utf-8", "surrogatepass").translate(_TOKEN_BYTES).split()), default=0) < LENGTH_CLASSES[0]:
        return []
    out = []
    for a, b, found in tested(text):
        out.append({"start": a, "end": b, "encoding": found[0], "length_class": sum(b - a >= n for n in LENGTH_CLASSES),
                    "bin": min(BINS, int(-10 * math.log10(max(found[1], 1e-300)))), "p_random": found[2]})
    return out


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_CANDIDATE = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("encoding", pa.string()),
                        ("length_class", pa.int32()), ("bin", pa.int32()), ("p_random", pa.float64())])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base (pattern spans), candidates (with their test results); no texts."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in pattern_spans(t)] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, pa.list_(_SPAN)),
                 pa.array([candidates(t) for t in texts], pa.list_(_CANDIDATE))], names=["doc_id", "base", "candidates"])

    return rows.mapInArrow(
        run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, base array<struct<kind:string,start:int,end:int>>, "
             "candidates array<struct<start:int,end:int,encoding:string,length_class:int,bin:int,p_random:double>>")


def thresholds(scanned: DataFrame, fdr: float) -> dict[int, int]:
    """Least bin of -log10(p_text) that is a discovery, per length class (Benjamini-Hochberg)."""
    hist = (scanned.select(F.explode("candidates").alias("c")).groupBy("c.length_class", "c.bin")
            .agg(F.count(F.lit(1)).alias("n")).collect())  # length classes x (BINS + 1) rows at most
    out = {}
    for c in {r[0] for r in hist}:
        rows = sorted(((r[1], r[2]) for r in hist if r[0] == c), reverse=True)
        total, seen = sum(n for _, n in rows), 0
        for b, n in rows:  # from the smallest p on; a bin's largest p stands for all of it
            seen += n
            if 10 ** (-b / 10) <= fdr * seen / total:
                out[c] = b
    return out


def chosen_spans(base: list[dict], found: list[dict], limits: dict[int, int], alpha: float) -> list[tuple[str, int, int]]:
    """Pattern spans and the discoveries outside them that lie in no longer one, by start, then kind: one sweep each."""
    begins, reach = [b["start"] for b in base], list(accumulate((b["end"] for b in base), max))
    out = [(b["kind"], b["start"], b["end"]) for b in base]
    last = -1  # the furthest end of the discoveries so far, which begin no later
    for c in sorted(found, key=lambda c: (c["start"], -c["end"])):
        if c["bin"] < limits.get(c["length_class"], BINS + 1) or c["p_random"] < alpha:
            continue
        before = bisect_left(begins, c["end"])  # pattern spans that begin before its end
        if before and reach[before - 1] > c["start"]:
            continue
        if c["end"] > last:
            out.append(("random", c["start"], c["end"]))
            last = c["end"]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_secrets(docs: DataFrame, fdr: float = 0.05, alpha: float = 0.001, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Every document: doc_id, base, spans (pattern spans and random strings outside them), by start, then kind."""
    scanned = materialize(scan(docs, id_col, text_col), "secrets")
    limits = thresholds(scanned, fdr)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base = batch.column("base")
            spans = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in chosen_spans(b, c, limits, alpha)]
                     for b, c in zip(base.to_pylist(), batch.column("candidates").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), base, pa.array(spans, pa.list_(_SPAN))],
                                             names=["doc_id", "base", "spans"])

    span = "array<struct<kind:string,start:int,end:int>>"
    return scanned.mapInArrow(choose, f"doc_id {scanned.schema['doc_id'].dataType.simpleString()}, base {span}, spans {span}")
