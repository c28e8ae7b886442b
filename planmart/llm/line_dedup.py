"""Line dedup by winnowing over line hashes.

Each document becomes its sequence of 64-bit line hashes. In every window of
``window`` consecutive lines the smallest hash is selected, so two equal
windows always select the same line: a run of ``window`` equal lines cannot be
missed. Selected hashes that occur once in the corpus are dropped; at the
others the match is extended to both sides by forming all windows that
selected the line. Of equal windows the one with the smallest (doc_id,
position) stays, and each line covered by a later one is deleted; adjacent
windows join into the whole repeated run. With ``long_words`` every line of so
many words (between ASCII white space) or more is a window of its own too, so
a passage on a single line is found between any neighbours.

Hot lines: first occurrences are found by folding aggregates (one row per
window and task is shuffled), later ones by joins of written tables, whose hot
keys adaptive execution splits. No pairs of documents are formed, and only
hashes are shuffled until texts are joined with their own deleted lines once.

Defined cases: a null text stays null with no lines; an empty text has one
empty line; texts of fewer than ``window`` lines lose long lines only; null ids sort
first; rows that repeat id and text count as one document, all keep the same
lines; an empty table gives no rows; further columns are kept, but for
``n_lines`` and ``n_removed``, which the counts replace. Time grows with a
text's lines, not with their square.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_shuffle, materialize, row_key

WINDOW = 2
LONG_WORDS = 13  # the long lines of the query and the pipeline


def _window_starts(hashes: Column, window: int) -> Column:
    """0-based starts of all windows (none for shorter texts)."""
    return F.when(F.size(hashes) >= window, F.sequence(F.lit(0), F.size(hashes) - window)).otherwise(
        F.array().cast("array<int>"))


def line_hashes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", long_words: int | None = None) -> DataFrame:
    """doc_id, text_hash, hashes (one 64-bit hash per line, in order), long (0-based places of the long lines)."""
    lines = F.split(F.col(text_col), "\n", -1)
    long = F.array().cast("array<int>")
    if long_words:
        is_long = lambda x: (F.length(x) >= 2 * long_words - 1) & (F.regexp_count(x, F.lit(r"\S+")) >= long_words)
        long = F.filter(F.transform(lines, lambda x, i: F.when(is_long(x), i)), lambda i: i.isNotNull())
    return df.where(F.col(text_col).isNotNull()).select(
        *row_key(id_col, text_col), F.transform(lines, lambda x: F.xxhash64(x)).alias("hashes"), long.alias("long"))


def _selected(lines: DataFrame, window: int) -> DataFrame:
    """One row per window with the line it selects: doc_id, text_hash, start, n_lines, mark, key."""
    part = lambda i, n: F.slice("hashes", i + 1, n)
    rows = lambda starts, n: F.transform(starts, lambda i: F.struct(
        i.alias("start"), F.lit(n).alias("n_lines"), F.array_min(part(i, n)).alias("mark"),
        F.md5(F.array_join(F.transform(part(i, n), lambda h: h.cast("string")), " ").cast("binary")).alias("key")))
    found = rows(_window_starts(F.col("hashes"), window), window)
    if window > 1:
        found = F.concat(found, rows(F.col("long"), 1))
    return lines.select("doc_id", "text_hash", F.inline(found))


def repeated_lines(df: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                   long_words: int | None = None) -> DataFrame:
    """doc_id, text_hash, starts (with n_lines): windows of each document that occur earlier in the corpus."""
    lines = materialize(line_hashes(df, id_col, text_col, long_words).distinct(), "line-hashes")
    repeated = materialize(_selected(lines, window).groupBy("mark").agg(F.count(F.lit(1)).alias("n"))
                           .where("n > 1").select("mark"), "marks")
    windows = materialize(_selected(lines, window).join(repeated, "mark", "left_semi").drop("mark"), "windows")
    first = materialize(
        windows.groupBy("key").agg(F.min(F.struct("doc_id", "start", "text_hash")).alias("first"),
                                   F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "first-windows")
    later = windows.join(first, "key").where(
        ~(F.struct("doc_id", "start", "text_hash").eqNullSafe(F.col("first"))))
    return later.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "n_lines")).alias("starts"))  # of one document


def _with(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once a row, also where ``then`` looks into it from a lambda."""
    return F.get(F.transform(F.array(value), then), 0)


def line_dedup(df: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
               long_words: int | None = None) -> DataFrame:
    """``df`` with later repeated runs of lines deleted from ``text_col``, plus n_lines and n_removed."""
    starts = materialize(repeated_lines(df, window, id_col, text_col, long_words), "repeated-lines").select(
        F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), "starts")
    rows = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), df[id_col].alias("id"), df[text_col].alias("text"),
                     F.xxhash64(df[text_col]).alias("hash"))
    joined = rows.join(by_shuffle(starts), F.col("id").eqNullSafe(F.col("of_id")) & (F.col("hash") == F.col("of_hash")), "left")
    covered = F.flatten(F.transform("starts", lambda s: F.sequence(s["start"], s["start"] + s["n_lines"] - 1)))

    def cut(lines: Column) -> Column:
        keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
        kept = F.array_join(F.transform(keep, lambda i: F.get(lines, i)), "\n")
        return F.struct(F.when(F.col("starts").isNull(), F.col("text")).otherwise(kept).alias("text"),
                        F.size(lines).cast("long").alias("n_lines"),
                        F.when(F.col("starts").isNull(), 0).otherwise(F.size(lines) - F.size(keep)).cast("long").alias("n_removed"))

    done = joined.select("row", _with(F.split("text", "\n", -1), cut).alias("cut"))
    counts = ("n_lines", "n_removed")
    none = F.col(f"row.`{text_col}`").isNull()
    kept = [(F.col("cut.text") if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in df.columns if c not in counts]
    return done.select(*kept, *[F.when(none, F.lit(0).cast("long")).otherwise(F.col(f"cut.{c}")).alias(c) for c in counts])
