"""Fixtures and brute-force versions for the training-data operators."""

from __future__ import annotations

import random
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    """Rows of ``documents`` with copies, near copies, shared lines, odd and empty texts, nulls and repeats."""
    rng = random.Random(seed)
    lines = [" ".join(words(rng, 8)) for _ in range(6)]
    rows = []
    for k in range(n):
        body = words(rng, rng.choice([1, 3, 5, 40, 120]))
        text = "\n".join([*rng.sample(lines, rng.randint(0, 5)), " ".join(body).capitalize(), *lines[: rng.randint(0, 4)]])
        rows.append((k, text, rng.choice(["en", "de"]), f"src{k % 3}", len(text)))
    base = " ".join(words(rng, 200))
    for k in range(12):  # a group of near copies, each with a few words changed
        w = base.split()
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = "changed" + str(rng.randint(0, 99))
        rows.append((100 + k, " ".join(w), "en", "src0", None))
    rows += [(200 + k, rows[3][1], "de", "src0", 1) for k in range(5)]  # exact copies
    rows += [(210, rows[3][1].upper(), "de", "src0", 1), (211, "  " + base.replace(" ", " \t "), "en", None, 0)]
    rows += [(300, "", "en", "a", 0), (301, None, "en", "a", None), (302, " \n\t ", None, None, 0), (303, "!!! ... ?", "en", "a", 9)]
    rows += [(None, "a text without an id", "en", "a", 1), (None, None, None, None, None), (None, "a text without an id", "en", "a", 1)]
    rows += [(5, rows[5][1], "en", "src2", 1)] * 2  # repeated rows
    return rows


def with_clashes(df):
    """Extra columns whose names an operator may use itself."""
    from pyspark.sql import functions as F

    for name in ("score", "kept", "rate", "copies", "n", "key", "node", "_row", "_k", "lines", "u", "v", "slot2", "words", "law", "_part", "_bad", "_drop", "_again", "_words", "_vector", "_raw", "b_length", "posteriors", "held_out", "_others"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
