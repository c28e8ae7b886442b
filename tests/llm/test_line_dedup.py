import time
from collections import Counter

import pytest

import corpus_pipeline as P
from planmart.llm.line_dedup import line_dedup

from .helpers import corpus, docs_df


def brute(rows, window):
    """Ids are unique but for rows that repeat altogether."""
    first, gone = {}, {}
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    for i, t in order:
        lines = [] if t is None else t.split("\n")
        for k in range(len(lines) - window + 1):
            key = tuple(lines[k:k + window])
            if key in first:
                gone.setdefault((i, t), set()).update(range(k, k + window))
            else:
                first[key] = (i, k)
    out = []
    for i, t in rows:
        lines = [] if t is None else t.split("\n")
        lost = gone.get((i, t), set())
        kept = None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in lost)
        out.append((i, kept, len(lines), len(lost)))
    return out


@pytest.mark.parametrize("window", [1, 2, 3])
def test_against_brute_force(spark, window):
    rows = [r for r in corpus() if r[0] is not None or r[1] is None]
    rows += [(9000 + i, "hot line\nsecond\nown " + str(i)) for i in range(200)]
    got = line_dedup(docs_df(spark, rows), window).select("doc_id", "text", "n_lines", "n_removed").collect()
    assert Counter(map(tuple, got)) == Counter(brute(rows, window))


def test_columns_and_empty_table(spark):
    df = docs_df(spark, [(1, "a\nb\nc"), (2, "a\nb\nd"), (None, "a\nb\ne")])
    out = line_dedup(df)
    assert out.columns == [*df.columns, "n_lines", "n_removed"]
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == [(0, "a\nb\ne"), (1, "c"), (2, "d")]  # null ids first
    assert line_dedup(docs_df(spark, [])).count() == 0


def brute_with_long_lines(rows, long_words):
    """Two-line windows and single long lines; no null ids."""
    first, gone = {}, {}
    for i, t in sorted(set(rows), key=lambda r: r[0]):
        lines = [] if t is None else t.split("\n")
        for k in range(len(lines)):
            for n in (1, 2):
                key = tuple(lines[k:k + n])
                if len(key) < n or n == 1 and len(key[0].split()) < long_words:
                    continue
                if first.setdefault(key, (i, k)) != (i, k):
                    gone.setdefault(i, set()).update(range(k, k + n))
    split = lambda t: [] if t is None else t.split("\n")
    return [(i, None if t is None else "\n".join(x for k, x in enumerate(split(t)) if k not in gone.get(i, ())), len(split(t)),
             len(gone.get(i, ()))) for i, t in rows]


def test_long_lines_are_windows(spark):
    line = " ".join(f"license{k}" for k in range(13))
    rows = [(i, f"own {i}\n{line}\nlast {i}") for i in range(500, 520)] + [(530, line), (531, line[:-2]), (532, f"{line}\n{line}")]
    rows += [(i, t) for i, t in corpus() if i is not None]
    got = line_dedup(docs_df(spark, rows), long_words=13).select("doc_id", "text", "n_lines", "n_removed").collect()
    got = Counter(map(tuple, got))
    want = brute_with_long_lines(sorted(set(rows), key=lambda r: r[0]), 13)
    assert set(got) == set(want) and sum(got.values()) == len(rows)
    assert (505, "own 505\nlast 505", 3, 1) in got and (530, "", 1, 1) in got and (531, line[:-2], 1, 0) in got
    kept = P.drop_repeated_lines(spark, docs_df(spark, rows[:23]), "")
    assert {r.doc_id: r.text for r in kept.collect()} == {
        500: rows[0][1], 531: line[:-2], **{i: f"own {i}\nlast {i}" for i in range(501, 520)}}


def test_a_text_of_many_lines_takes_time_in_proportion(spark):
    lines = [f"line {i}" for i in range(100_000)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(["own", lines[70], lines[71], *(f"x{i}" for i in range(100_000))]))]
    began = time.time()
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in line_dedup(docs_df(spark, rows)).collect()}
    assert got[1] == (100_000, 0, rows[0][1])
    assert got[2] == (100_003, 2, "\n".join(["own", *(f"x{i}" for i in range(100_000))]))
    assert time.time() - began < 120  # the square of it took more than ten minutes


def test_columns_with_any_name_are_kept(spark):
    names = ["_id", "_hash", "_starts", "_key", "_text", "id", "hash", "row", "cut", "starts", "of_id", "key", "mark", "hashes"]
    rows = [(i, "a\nb\n" + str(i), *[f"{c}{i}" for c in names], 7) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in names) + ", n_lines int")
    out = line_dedup(df)
    assert out.columns == ["doc_id", "text", *names, "n_lines", "n_removed"]
    for r in out.collect():
        assert [r[c] for c in names] == [f"{c}{r.doc_id}" for c in names]
        assert (r.n_lines, r.n_removed, r.text) == (3, 2 if r.doc_id else 0, str(r.doc_id) if r.doc_id else "a\nb\n0")
