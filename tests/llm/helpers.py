"""Small corpora for the operators: edge cases, and random texts with planted repeats."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "row string, text_hash long, n_words long, shard int, component string, start int, tag int")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def docs_df(spark, rows):
    """Rows of (doc_id, text[, lang]); further columns clash with the operators' own names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", None, None if r[1] is None else len(r[1]), "x", 7, -1, 3, "c", 5, 1)
            for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


def plain(rows):
    return [(r[0], r[1]) for r in rows]


def corpus(seed=1, n=120):
    """Prose-like texts with copies, near copies, shared passages and lines, edge cases and repeated rows."""
    rng = random.Random(seed)
    words = ["".join(rng.choice(["ka", "lo", "mi", "ru", "te", "so", "é", "Na"]) for _ in range(rng.randint(1, 4)))
             for _ in range(400)]
    sentence = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passage, line = sentence(30), sentence(12)
    base = sentence(120)
    out = []
    for i in range(n):
        kind = i % 10
        if kind == 0:
            text = base  # exact copies
        elif kind == 1:
            w = base.split()
            for _ in range(rng.randint(0, 6)):
                w[rng.randrange(len(w))] = rng.choice(words)
            text = " ".join(w)  # near copies
        elif kind == 2:
            text = sentence(20) + " " + passage + "\n" + sentence(15)
        elif kind == 3:
            text = "\n".join([line, sentence(5), line, line, sentence(4), "", sentence(3), line, sentence(5)])
        elif kind == 4:
            text = sentence(rng.randint(1, 15))
        else:
            text = "\n".join(sentence(rng.randint(3, 25)) for _ in range(rng.randint(1, 6)))
        out.append((1000 + (i * 37) % n, text))
    out += [(3, None), (4, ""), (5, " \n\t "), (6, "\n\n\n"), (7, "x"), (8, "🙂 ß İ Σας"), (9, base), (9, base)]
    out += [(10, sentence(4000)), (11, None), (None, base), (None, None)]
    return out
