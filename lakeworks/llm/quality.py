"""Quality rules by distribution divergence.

The histograms of a document's character classes and of its common words are compared with those of each
language's documents, by Jensen-Shannon distance (base 2: 0 equal, 1 disjoint); the nearest language counts,
so a missing or wrong language of a row does no harm. Distances of short texts are mostly chance, so each
histogram has a minimum length below which it decides nothing. The references are counts over all rows with a
language, in which a very long text weighs no more than a long one: two scans in all, and only counts of words
are shuffled.

Beside the verdict stand plain counts of a text: words, symbols, repeated lines, words in repeated windows.
"""

from __future__ import annotations

import string
import unicodedata
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from functools import cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.llm.textops import limit_batches, release, texts_of
from lakeworks.session import stored

#: characters that count as symbols, and white space between words
SYMBOLS, SPACES = "#*$%&|<>", "\x20\x09\x0a\x0b\x0c\x0d"
#: classes of characters, in the order of the histogram
CLASSES = ("lower", "upper", "letter", "mark", "digit", "space", "symbol", "punctuation", "other")
_SPACE, _SYMBOL = CLASSES.index("space"), CLASSES.index("symbol")
#: punctuation that is no part of a common word
_EDGES = b".,;:!?\"'()[]"
#: common words of a language's histogram
COMMON_WORDS = 200
#: words that a text counts for in a reference at most (a longer one counts with all its words, by as much less), in units
#: of ``1 / UNIT`` word
MOST_WORDS, UNIT = 1_000, 1 << 10
#: words of a language's rows from which it is a reference
MIN_REFERENCE = 1_000
#: words of a repeated window
WINDOW = 8
#: texts measured together at most
ROWS = 1_024
#: distinct words that a task counts before it passes its counts on
HELD_WORDS = 100_000


class Rules(NamedTuple):
    """Limits of the verdict. A text fails at a distance above a limit, given the minimum length."""

    #: character classes: distance, and the words it takes
    class_distance: float = 0.35
    class_words: int = 20
    #: common words: distance, and the words it takes
    word_distance: float = 0.57
    word_words: int = 50
    #: base rules: least words, and the largest percentage of words in repeated windows
    least_words: int = 20
    repeat_percent: int = 30


@cache
def class_table() -> np.ndarray:
    """The class of each code point."""
    by_category = {"Ll": 0, "Lu": 1, "Lt": 1, "Lo": 2, "Lm": 2, "Mn": 3, "Mc": 3, "Me": 3, "Nd": 4, "Nl": 4, "No": 4, "Zs": 5}
    table = np.full(0x110000, 8, np.uint8)
    for c in range(0x110000):
        category = unicodedata.category(chr(c))
        table[c] = 7 if category[0] == "P" else by_category.get(category, 8)
    table[[ord(c) for c in SPACES]] = _SPACE
    table[[ord(c) for c in SYMBOLS]] = _SYMBOL
    return table


def class_histograms(texts: Sequence[bytes]) -> np.ndarray:
    """Characters of each class (texts x classes)."""
    chars = [np.frombuffer(t.decode("utf-8", "replace").encode("utf-32-le"), np.uint32) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(c) for c in chars])
    codes = class_table()[np.concatenate(chars)] if chars else np.zeros(0, np.uint8)
    return np.bincount(owner * len(CLASSES) + codes, minlength=len(texts) * len(CLASSES)).reshape(len(texts), -1)


def common_form(word: bytes) -> bytes:
    """A word as it is counted in histograms: A-Z in lower case, without punctuation at its ends (unless all of it is)."""
    return word.strip(_EDGES).lower() or word


def _pairs(ids: np.ndarray, step: int) -> np.ndarray:
    """Numbers of the runs made of the run at each place and the one ``step`` places on; equal runs, equal numbers."""
    if len(ids) <= step:
        return np.zeros(0, np.int64)
    _, out = np.unique(ids[:-step] * (int(ids.max()) + 1) + ids[step:], return_inverse=True)
    return out.astype(np.int64)


def repeated_words(ids: np.ndarray, owner: np.ndarray, n_texts: int) -> np.ndarray:
    """Per text the words that lie in a window of ``WINDOW`` words which the text has twice or more.

    ``ids`` numbers the words of all texts in order (equal words, equal numbers), ``owner`` says whose each is. Windows
    are numbered by doubling, so equal numbers mean equal words, not equal hashes.
    """
    runs, width = ids, 1
    while width < WINDOW:
        runs, width = _pairs(runs, width), 2 * width
    n = len(runs)
    inside = np.flatnonzero(owner[:n] == owner[WINDOW - 1 :]) if n else np.zeros(0, np.int64)
    if not len(inside):
        return np.zeros(n_texts, np.int64)
    _, kind, count = np.unique(owner[inside] * (int(runs.max()) + 1) + runs[inside], return_inverse=True, return_counts=True)
    edge = np.zeros(len(ids) + 1, np.int64)
    starts = inside[count[kind] > 1]
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return np.bincount(owner[np.cumsum(edge[:-1]) > 0], minlength=n_texts)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line of the text."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts ``p`` from the counts ``q``; 1 for an empty row."""
    size = p.sum(axis=1, keepdims=True)
    p = np.divide(p, size, out=np.zeros(p.shape), where=size > 0)
    q = np.broadcast_to(q / max(q.sum(), 1e-300), p.shape)
    m = (p + q) / 2

    def part(x):
        return np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / np.where(x > 0, m, 1)), 0).sum(axis=1)

    return np.where(size[:, 0] > 0, np.sqrt(np.clip((part(p) + part(q)) / 2, 0, 1)), 1.0)


class Reference(NamedTuple):
    """A language's counts: characters by class; its common words, and their counts with that of all others behind."""

    classes: np.ndarray
    words: tuple[bytes, ...]
    counts: np.ndarray


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, word, n`` counts of a task; characters by class stand under a null word, with ``class``."""
    held: dict[str, Counter] = {}
    classes: dict[str, np.ndarray] = {}

    def flush():
        rows = [(lang, w, None, n) for lang, c in held.items() for w, n in c.items()]
        rows += [(lang, None, k, int(n)) for lang, h in classes.items() for k, n in enumerate(h)]
        held.clear()
        classes.clear()
        for at in range(0, len(rows), 20_000):
            lang, w, k, n = zip(*rows[at : at + 20_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(w, pa.binary()), pa.array(k, pa.int32()), pa.array(n, pa.int64())],
                names=["lang", "word", "class", "n"],
            )

    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), texts_of(batch.column(1))
        histograms = class_histograms(texts)
        for k, (lang, text) in enumerate(zip(langs, texts)):
            words = text.split()
            top, bottom = UNIT * min(len(words), MOST_WORDS), max(1, len(words))
            seen = held.setdefault(lang, Counter())
            for w, c in Counter(words).items():
                seen[w] += c * top // bottom
            classes[lang] = classes.get(lang, 0) + histograms[k] * top // bottom
        if sum(map(len, held.values())) > HELD_WORDS:
            yield from flush()
    yield from flush()
    release()


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, Reference]:
    """The references of all languages, counted over all rows with a language; ``COMMON_WORDS`` + 1 rows and the
    classes of each language reach the driver. Of equally common words the smaller counts."""
    limit_batches(docs.sparkSession)
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL")
    counted = rows.mapInArrow(_counted, "lang string, word binary, class int, n long")
    whole = F.col("word").cast("string")
    stripped = F.translate(F.btrim(whole, F.lit(_EDGES.decode())), string.ascii_uppercase, string.ascii_lowercase)
    word = F.when(stripped == "", whole).otherwise(stripped)
    counts = stored(counted.groupBy("lang", word.alias("word"), "class").agg(F.sum("n").alias("n")), "quality-counts")
    words = counts.where("word IS NOT NULL")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = words.withColumn("place", place).where(F.col("place") <= COMMON_WORDS).collect()
    totals = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    classes: dict[str, np.ndarray] = {}
    for r in counts.where("word IS NULL").collect():
        classes.setdefault(r["lang"], np.zeros(len(CLASSES)))[r["class"]] = r["n"]
    found: dict[str, list] = {}
    for r in sorted(top, key=lambda r: r["place"]):
        found.setdefault(r["lang"], []).append((r["word"].encode(), r["n"]))
    out = {}
    for lang, total in sorted(totals.items()):
        if total >= MIN_REFERENCE * UNIT:
            n = [c for _, c in found[lang]]
            out[lang] = Reference(classes[lang], tuple(w for w, _ in found[lang]), np.array([*n, total - sum(n)], float))
    return out


class Meter:
    """Measures batches of texts against references."""

    def __init__(self, languages: Mapping[str, Reference]):
        self.languages = languages
        words = sorted({w for r in languages.values() for w in r.words})
        self.place = {w: k + 1 for k, w in enumerate(words)}
        #: per language its words' places among the words of all languages
        self.columns = {lang: np.array([self.place[w] for w in r.words], np.int64) for lang, r in languages.items()}

    def measure(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        n = len(texts)
        split = [t.split() for t in texts]
        n_words = np.array([len(w) for w in split], np.int64)
        owner = np.repeat(np.arange(n), n_words)
        known: dict[bytes, int] = {}
        ids = np.fromiter((known.setdefault(w, len(known)) for w in chain.from_iterable(split)), np.int64, len(owner))
        del split
        place = np.fromiter((self.place.get(common_form(w), 0) for w in known), np.int64, len(known))
        width = len(self.place) + 1
        seen = place[ids] if len(known) else ids
        common = np.bincount(owner * width + seen, minlength=n * width).reshape(n, width)
        classes = class_histograms(texts)
        class_distance, word_distance = np.ones(n), np.ones(n)
        for lang, reference in self.languages.items():
            class_distance = np.minimum(class_distance, js_distance(classes, reference.classes))
            mine = common[:, self.columns[lang]]
            mine = np.concatenate([mine, (n_words - mine.sum(axis=1))[:, None]], axis=1)
            word_distance = np.minimum(word_distance, js_distance(mine, reference.counts))
        return {
            "n_words": n_words,
            "word_chars": classes.sum(axis=1) - np.array([sum(map(t.count, map(str.encode, SPACES))) for t in texts], np.int64),
            "n_symbols": classes[:, _SYMBOL],
            "n_dup_lines": np.array([repeated_lines(t) for t in texts], np.int64),
            "n_repeat_words": repeated_words(ids, owner, n),
            "class_distance": class_distance,
            "word_distance": word_distance,
        }


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_DISTANCES = ("class_distance", "word_distance")


def measures(docs: DataFrame, languages: Mapping[str, Reference], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the counts and distances of each row's whole text, in one scan."""
    spark = docs.sparkSession
    limit_batches(spark)
    meter = spark.sparkContext.broadcast(Meter(languages))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            found = meter.value.measure(texts_of(batch.column(1)))
            columns = [pa.array(found[c], pa.int64()) for c in _COUNTS] + [pa.array(found[c], pa.float64()) for c in _DISTANCES]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *_COUNTS, *_DISTANCES])
        release()

    schema = f"doc_id {kind}, " + ", ".join([*(f"{c} long" for c in _COUNTS), *(f"{c} double" for c in _DISTANCES)])
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def quality(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per row of ``docs(doc_id, text, lang)``: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, class_distance, word_distance``.

    ``base_failed``: fewer words than ``least_words``, or over ``repeat_percent`` percent of the words in repeated
    windows. Others are kept unless a histogram is farther from every language's reference than its limit. Null texts
    count as empty: no words, failed. Without any reference (empty tables, no languages) only the base rules decide.
    Ids may be null or repeat, rows too; a null language gives no reference; very long texts are read whole; other
    columns are ignored; an empty table gives no rows.
    """
    languages = references(docs)
    rows = measures(docs, languages)
    failed = (F.col("n_words") < rules.least_words) | (100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words"))
    odd = ((F.col("n_words") >= rules.class_words) & (F.col("class_distance") > rules.class_distance)) | (
        (F.col("n_words") >= rules.word_words) & (F.col("word_distance") > rules.word_distance)
    )
    odd = odd if languages else F.lit(False)
    return rows.select("doc_id", *_COUNTS, failed.alias("base_failed"), (~failed & ~odd).alias("kept"), *_DISTANCES)
