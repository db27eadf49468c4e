"""Line deduplication by winnowing over line hashes (native: DataFrame functions only).

A run is found if it has ``run`` lines, or fewer lines with ``short_words`` words in all. For each such length of
window, of every window of consecutive lines of a text the line with the smallest hash is its fingerprint
(the first one at ties), so two equal windows have the same fingerprint at the same place.
Fingerprints meet by hash; the ones that occur once in the corpus end there. At the others a match is
extended to both sides, to all windows that chose the fingerprint, and windows meet by their lines. A
window whose lines occurred before (smaller document id, then smaller place) is a repeat; overlapping and
adjacent repeats join to runs as long as the text agrees, and the lines of these later runs are deleted.

No pairs are formed: an occurrence is compared with the first one only, counts are combined on the map
side, and the rows of a very common run are split by the skew-join handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.session import stored

#: lines of the shortest run that is found whatever it holds, and words from which a shorter one is
RUN, SHORT_WORDS = 3, 50
#: white space that lines are compared without, and that words end at
SPACES = " \t\x0b\x0c\r\n"


def _held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``value`` as a column that is computed once per row (a generator keeps the optimiser from copying
    the expression into the lambdas that use it)."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _text_key(text: Column) -> Column:
    return F.xxhash64(text, F.length(text))


def _trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(SPACES))


def _word_count(line: Column) -> Column:
    """Words of a line. Most lines hold no other white space than blanks, which the plain split is for."""
    odd = line.contains(SPACES[1])
    for c in SPACES[2:]:
        odd = odd | line.contains(c)
    words = F.when(odd, F.split(line, r"[\x20\x09-\x0D]+")).otherwise(F.split(line, " "))
    return F.size(F.filter(words, lambda w: w != ""))


def _classes(run: int, short_words: int | None) -> list[int]:
    """The lengths of windows: ``run`` lines, and all shorter ones, which need words."""
    return [run] if short_words is None else list(range(1, run + 1))


def line_table(docs: DataFrame, run: int = RUN, short_words: int | None = SHORT_WORDS) -> DataFrame:
    """``doc_id, text_key, hashes, chosen``: hashes of the lines that are not blank, and for each length of window and
    each window the place of its fingerprint (NULL where a short window has too few words)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", _text_key(text).alias("text_key"), text.alias("text"))
    rows = _held(rows, "lines", F.filter(F.transform(F.split("text", "\n", -1), _trimmed), lambda x: x != "")).drop("text")
    words = F.transform("lines", _word_count) if short_words is not None else F.array().cast("array<int>")
    rows = _held(rows, "words", words)
    rows = _held(rows, "hashes", F.transform("lines", lambda x: F.xxhash64(x, F.length(x)))).drop("lines")

    def chosen(size: int) -> Column:
        def fingerprint(i):
            window = F.slice("hashes", i + 1, size)
            at = (i + F.array_position(window, F.array_min(window)) - 1).cast("int")
            if size == run:
                return at
            enough = F.aggregate(F.slice("words", i + 1, size), F.lit(0), lambda n, w: n + w) >= short_words
            return F.when(enough, at)

        none = F.array().cast("array<int>")
        return F.when(F.size("hashes") >= size, F.transform(F.sequence(F.lit(0), F.size("hashes") - size), fingerprint)).otherwise(none)

    return rows.withColumn("chosen", F.array(*[chosen(size) for size in _classes(run, short_words)])).drop("words")


def repeated_windows(lines: DataFrame, run: int = RUN, short_words: int | None = SHORT_WORDS) -> DataFrame:
    """``doc_id, text_key, start, size``: the windows whose lines occurred before."""

    def places_of(k: int, size: int) -> Column:
        found = F.array_distinct(F.array_compact(F.get("chosen", F.lit(k))))
        return F.transform(found, lambda at: F.struct(F.lit(k).alias("class"), F.lit(size).alias("size"), at.alias("at")))

    each = [places_of(k, size) for k, size in enumerate(_classes(run, short_words))]
    places = lines.select("doc_id", "text_key", "hashes", "chosen", F.explode(F.flatten(F.array(*each))).alias("p"))
    places = places.select("doc_id", "text_key", "hashes", F.get("chosen", F.col("p.class")).alias("chosen"), "p.size", "p.at")
    size = F.col("size")
    low = F.greatest(F.lit(0), F.col("at") - size + 1)
    high = F.least(F.col("at"), F.size("hashes") - size)
    prints = places.select(
        "doc_id",
        "text_key",
        "size",
        F.get("hashes", F.col("at")).alias("print"),
        low.alias("low"),
        # what a match can be extended over: the windows that hold this place, and which of them chose it
        F.slice("hashes", low + 1, high - low + size).alias("around"),
        F.transform(F.slice("chosen", low + 1, high - low + 1), lambda c: F.coalesce(c == F.col("at"), F.lit(False))).alias("own"),
    )
    prints = stored(prints, "line-prints")
    common = prints.groupBy(F.col("print").alias("_print"), F.col("size").alias("_size")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    windows = prints.join(common, (F.col("print") == F.col("_print")) & (F.col("size") == F.col("_size")), "left_semi").select(
        "doc_id", "text_key", "size", "low", "around", F.posexplode("own").alias("k", "own")
    )
    windows = windows.where("own").select(
        "doc_id", "text_key", (F.col("low") + F.col("k")).alias("start"), "size", F.slice("around", F.col("k") + 1, F.col("size")).alias("window")
    )
    windows = stored(windows, "line-windows")
    place = F.struct("doc_id", "text_key", "start")
    first = windows.groupBy(F.col("window").alias("_window")).agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n"))
    first = first.where("_n > 1")
    return windows.join(first, F.col("window") == F.col("_window")).where(place > F.col("_first")).select(
        "doc_id", "text_key", "start", "size"
    )


def line_dedup(
    docs: DataFrame, run: int = RUN, id_col: str = "doc_id", text_col: str = "text", short_words: int | None = SHORT_WORDS
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text`` (without the deleted lines), ``n_lines, n_deleted, n_runs``.

    Lines end at a line feed and are compared without surrounding ASCII white space; blank lines are never counted,
    compared or deleted. A line goes when it lies in ``run`` or more consecutive lines that occurred before, in a
    document with a smaller id (a null id is smallest) or earlier in the same one; or in fewer lines with ``short_words``
    words in all (None: never). Null counts as empty; very long texts and lines are read whole. Rows that share id and text are one document and share the decision.
    ``n_runs`` counts the deleted runs. Other columns are ignored; an empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    lines = stored(line_table(docs, run, short_words), "lines")
    gone = repeated_windows(lines, run, short_words).groupBy("doc_id", "text_key").agg(
        F.array_sort(
            F.array_distinct(F.flatten(F.collect_set(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1))))
        ).alias("gone")
    )
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "gone")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("_k", _text_key(F.col("text")))
    rows = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_key")), "left")
    rows = _held(rows.select("doc_id", "text", "gone"), "all", F.split("text", "\n", -1))
    rows = _held(
        rows, "full", F.filter(F.sequence(F.lit(0), F.size("all") - 1), lambda i: _trimmed(F.get("all", i)) != "")
    )
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    rows = _held(rows, "deleted", gone)
    rows = _held(
        rows, "left", F.array_except(F.sequence(F.lit(0), F.size("all") - 1), F.transform("deleted", lambda i: F.get("full", i)))
    )
    return rows.select(
        "doc_id",
        F.when(F.size("deleted") == 0, F.col("text"))
        .otherwise(F.array_join(F.transform("left", lambda i: F.get("all", i)), "\n"))
        .alias("text"),
        F.size("full").alias("n_lines"),
        F.size("deleted").alias("n_deleted"),
        F.size(F.array_except("deleted", F.transform("deleted", lambda i: i + 1))).alias("n_runs"),
    )
