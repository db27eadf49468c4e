"""Benchmark decontamination by winnowed fingerprints.

A window is a run of ``window`` consecutive words of a benchmark item (an item with fewer words is one
window of its own length). Of each text, the minimum k-gram hash of every sliding window is kept: with
``k`` words a gram and ``w = m - k + 1`` grams a window, every run of ``m`` words holds at least one kept
fingerprint, in the document and in the item alike, so no shared run of ``m`` words can be missed.

Documents and benchmark meet on fingerprints; a hit is then extended to both sides, within the words
around it, to all windows that hold it, and these are compared by their words. A fixed-size bit table of
the benchmark's fingerprints (``FILTER_BITS``, whatever the benchmark's size) lets the documents' workers
drop most fingerprints before the join; what passes by chance falls out in the join.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.frames import unused
from lakeworks.llm.textops import NON_ALNUM_BYTES, byte_tables, grams, limit_batches, release, sliding, texts_of, word_blocks
from lakeworks.session import stored

WINDOW = 13
GRAM = 5
#: bits of the fingerprint filter: a broadcast of 4 MB, always
FILTER_BITS = 1 << 25
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


def winnow(doc: np.ndarray, words: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the fingerprints that guarantee every run of ``length`` words of one text.

    Every gram that is the minimum of some window of ``length - k + 1`` grams is kept (all of them at ties).
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(words) < length:
        return none
    g, w = grams(words, k), length - k + 1
    low = sliding(g, w, np.minimum)
    whole = doc[: len(low)] == doc[length - 1 :]
    # a gram is kept when it equals the minimum of a window that holds it and lies in one text
    low = np.where(whole, low, np.uint64(0))
    pad = np.zeros(w - 1, np.uint64)
    best = sliding(np.concatenate([pad, low, pad]), w, np.maximum)
    inside = sliding(np.concatenate([np.zeros(w - 1, bool), whole, np.zeros(w - 1, bool)]), w, np.logical_or)
    kept = np.flatnonzero((g == best) & inside)
    return kept, g[kept]


def _classes(lengths: list[int]) -> list[tuple[int, int]]:
    """``(window length, gram length)`` for each window length that the benchmark has."""
    return [(m, min(GRAM, m)) for m in lengths]


def _fingerprints(classes: list[tuple[int, int]], window: int):
    """Items to rows ``length, hash``: the fingerprints of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = byte_tables(NON_ALNUM_BYTES)
        for batch in batches:
            for first, last, doc, words in word_blocks(texts_of(batch.column(0)), tables):
                counts = np.bincount(doc, minlength=last - first)[doc] if len(doc) else doc
                for length, k in classes:
                    use = counts >= window if length == window else counts == length
                    _, h = winnow(doc[use], words[use], length, k)
                    h = np.unique(h)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(h), length, np.int32)), pa.array(h.view(np.int64))],
                        names=["length", "hash"],
                    )

    return run


def _bit_table(prints: DataFrame) -> np.ndarray:
    """The filter as bytes: at most ``FILTER_BITS / 64`` (place, word) rows reach the driver."""
    place = F.pmod(F.col("hash"), F.lit(FILTER_BITS))
    words = (
        prints.select((place / 64).cast("long").alias("at"), F.expr(f"shiftleft(1L, int(pmod(hash, {FILTER_BITS}L) % 64))").alias("bit"))
        .groupBy("at")
        .agg(F.bit_or("bit").alias("bits"))
    )
    table = np.zeros(FILTER_BITS // 64, np.int64)
    rows = words.toPandas()
    table[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return table


_HITS = "n_words long, hits array<struct<length:int,hash:long,start:long,gram:long,around:array<string>>>"


def _scan(classes: list[tuple[int, int]], shared):
    """Documents to ``n_words`` and the fingerprints that pass the filter, each with the words around it
    (``start``: place of the first of them; ``gram``: place of the fingerprint)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, bits = byte_tables(NON_ALNUM_BYTES), shared.value
        hit_type = pa.list_(
            pa.struct(
                [
                    ("length", pa.int32()),
                    ("hash", pa.int64()),
                    ("start", pa.int64()),
                    ("gram", pa.int64()),
                    ("around", pa.list_(pa.string())),
                ]
            )
        )
        for batch in batches:
            texts = texts_of(batch.column(1))
            for first, last, doc, words in word_blocks(texts, tables):
                n = last - first
                begin = np.searchsorted(doc, np.arange(n + 1))
                hits: list[list[dict]] = [[] for _ in range(n)]
                split: dict[int, list[bytes]] = {}
                for length, k in classes:
                    at, h = winnow(doc, words, length, k)
                    place = (h.view(np.int64) % FILTER_BITS).astype(np.int64)
                    found = (bits[place >> 6] >> (place & 63)) & 1
                    for p, x in zip(at[found == 1], h.view(np.int64)[found == 1]):
                        d = int(doc[p])
                        if d not in split:
                            split[d] = words_of(texts[first + d])
                        own = split[d]
                        p = int(p - begin[d])
                        lo, hi = max(0, p + k - length), min(len(own), p + length)
                        hits[d].append(
                            {"length": length, "hash": int(x), "start": lo, "gram": p, "around": [t.decode() for t in own[lo:hi]]}
                        )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n),
                        batch.column(2).slice(first, n),
                        batch.column(3).slice(first, n),
                        pa.array(np.diff(begin), pa.int64()),
                        pa.array(hits, hit_type),
                    ],
                    names=["doc_id", "text_key", "_row", "n_words", "hits"],
                )
        release()

    return run


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id, length, words``: the windows of each item (its words joined by a space), as often as they occur."""
    lower = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    items = benchmark.select("item_id", F.regexp_extract_all(lower, F.lit(pattern), F.lit(0)).alias("w"))
    items = items.where(F.size("w") > 0).withColumn("length", F.least(F.lit(window), F.size("w")))
    return items.select(
        "item_id", "length", "w", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("length") + 1)).alias("s")
    ).select("item_id", "length", F.array_join(F.slice("w", F.col("s"), F.col("length")), " ").alias("words"))


def _covered(starts: Column) -> Column:
    """Words in the union of ``[start, start + length)`` over an array of ``struct(start, length)``."""
    state = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def step(acc, x):
        end = x["start"] + x["length"]
        return F.struct(
            F.greatest(acc["end"], end).alias("end"),
            (acc["n"] + F.greatest(F.lit(0).cast("long"), end - F.greatest(acc["end"], x["start"]))).alias("n"),
        )

    return F.aggregate(F.array_sort(starts), state, step)["n"]


def text_key(text: Column) -> Column:
    """128 bits that stand for a text (null as empty)."""
    text = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.length(text), text).alias("b"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items (sorted array of text),
    contaminated, text_key``.

    A document word inside any occurrence of an item's window is hit; ``items`` are the ids of the items
    with an occurring window; contaminated means ``n_hit > 0`` and ``20 * n_hit >= n_words``. Null and empty
    texts have no words and are clean; items without words have no window; repeated items add their ids,
    null item ids none (their windows still hit). Ids may be null or repeat: every row is judged by itself.
    Other columns are ignored; empty tables are allowed on both sides.
    """
    spark = docs.sparkSession
    limit_batches(spark)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    windows = stored(item_windows(benchmark, window), "decontam-windows")
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())  # at most ``window`` values
    classes = _classes(lengths)
    prints = stored(
        benchmark.select("text").mapInArrow(_fingerprints(classes, window), "length int, hash long").distinct(),
        "decontam-prints",
    )
    bits = spark.sparkContext.broadcast(_bit_table(prints))
    kind = docs.schema["doc_id"].dataType.simpleString()
    scanned = stored(
        docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key"), F.monotonically_increasing_id().alias("_row"))
        .mapInArrow(_scan(classes, bits), f"doc_id {kind}, text_key struct<a:long,b:long>, _row long, {_HITS}"),
        "decontam-scan",
    )
    hit = scanned.select("_row", F.explode("hits").alias("h")).select("_row", "h.*")
    hit = hit.join(prints, ["length", "hash"], "left_semi")
    # extend: all windows of the hit's length that hold the gram and lie within the words around it
    k = F.least(F.lit(GRAM), F.col("length"))
    first = F.greatest(F.col("start"), F.col("gram") + k - F.col("length"))
    last = F.least(F.col("gram"), F.col("start") + F.size("around") - F.col("length"))
    runs = hit.where(last >= first).select(
        "_row", "length", "start", "around", F.explode(F.sequence(first, last)).alias("s")
    )
    runs = runs.select(
        "_row",
        F.col("s").alias("start"),
        "length",
        F.array_join(F.slice("around", (F.col("s") - F.col("start") + 1).cast("int"), F.col("length")), " ").alias("words"),
    )
    distinct = windows.groupBy("length", "words").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    matched = stored(runs.join(distinct, ["length", "words"]).select("_row", "start", "length", "ids"), "decontam-hits")
    per_row = matched.groupBy(F.col("_row").alias("_r")).agg(
        _covered(F.collect_set(F.struct("start", "length"))).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("items"),
    )
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return scanned.join(per_row, F.col("_row") == F.col("_r"), "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        items.alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        "text_key",
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` (all columns) without its contaminated rows. Contamination is a matter of the text alone, so
    rows are dropped by their text: null and repeated ids need no care."""
    found = contamination(docs.select("doc_id", "text"), benchmark, window)
    name = unused(docs, "_bad")
    bad = stored(found.where("contaminated").select(F.col("text_key").alias(name)).distinct(), "decontam-drop")
    return docs.join(bad, text_key(docs["text"]) == F.col(name), "left_anti")
