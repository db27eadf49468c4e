"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text: densities of lexicon words, their closeness to second-person pronouns, capitals,
punctuation and obfuscation (characters swapped into words). The lexicon holds whole words and word
stems whose document frequency differs strongly between the labelled classes. Lexicon, trees and
calibration are learned on three disjoint parts of a bounded sample of labelled rows (``FIT_ROWS``);
scoring covers every row and whole texts, in one scan without any shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.frames import aside, back
from lakeworks.llm.textops import limit_batches, release
from lakeworks.session import stored

#: labelled rows that the fit may use at most: those with the smallest hash of their id
FIT_ROWS = 20_000
#: entries of the lexicon at most, by strength
LEXICON_SIZE = 4_000
#: an entry's least smoothed log-odds, and its least log-likelihood ratio (G). Chance yields a few weak entries
#: among tens of thousands of candidates, which the trees weigh, as they learn on other rows; strong entries are beyond it
MIN_ODDS, MIN_G, STRONG_G = 2.0, 14.0, 40.0
STEMS = (4, 5, 6)
#: words between a pronoun and a lexicon word that still count as close
NEAR = 5
PRONOUNS = frozenset("you your yours yourself u ur du dich dir dein deine deiner tu te toi ton ta tes vous votre usted ustedes ti".split())
TREES, DEPTH = 20, 3
FEATURES = 12
_WORD = re.compile(r"[^\W_]+")
_MASKED = re.compile(r"[^\W\d_][^\s.,;:?]*[0-9@$!*|+][^\s.,;:?]*[^\W\d_]")
_UPPER = re.compile(r"[A-Z]")
_PLAIN = str.maketrans("0134578@$!|+", "oieastbasiit")
#: words whose class is kept per worker; the table starts anew when it is full
KEPT_WORDS = 200_000


def _entries(word: str) -> list[str]:
    """The lexicon keys of a word: itself, and its stems marked by a star."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]


class _Lexicon:
    def __init__(self, entries: dict[str, int]):
        self.entries, self.known = entries, {}

    def strength(self, word: str) -> int:
        """0: not in the lexicon, 1: weak, 2: strong."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) > KEPT_WORDS:
                self.known.clear()
            found = self.known[word] = max(self.entries.get(e, 0) for e in _entries(word))
        return found


def text_features(text: str, lexicon: _Lexicon) -> list[float]:
    """The dense features of one text; all 0 for a text without words."""
    low = text.lower()
    words = _WORD.findall(low)
    if not words:
        return [0.0] * FEATURES
    classes = list(map(lexicon.strength, words))
    strong, weak = classes.count(2), classes.count(1)
    close = distinct = 0
    if strong or weak:
        at = [k for k, c in enumerate(classes) if c]
        distinct = len({words[k] for k in at})
        close = sum(not PRONOUNS.isdisjoint(words[max(0, k - NEAR) : k + NEAR + 1]) for k in at)
    masked = _MASKED.findall(low) if re.search(r"[0-9@$!*|+]", low) else []
    hidden = sum(lexicon.strength(m.translate(_PLAIN)) > 0 for m in masked)
    letters = sum(map(len, words))
    upper = len(_UPPER.findall(text))
    n = len(words)
    return [
        strong / n,
        math.log1p(strong),
        weak / n,
        math.log1p(weak),
        math.log1p(distinct),
        close / (strong + weak) if strong or weak else 0.0,
        math.log1p(hidden),
        len(masked) / n,
        upper / max(1, letters),
        (low.count("!") + low.count("?")) / n,
        (len(low) - letters) / max(1, len(low)),
        math.log1p(n),
    ]


def _count_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = {0: Counter(), 1: Counter()}
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found[toxic].update({e for w in set(_WORD.findall((text or "").lower())) for e in _entries(w)})
        entries = list(found[0].keys() | found[1].keys())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(entries, pa.string()),
                pa.array([found[0][e] for e in entries], pa.int64()),
                pa.array([found[1][e] for e in entries], pa.int64()),
            ],
            names=["entry", "n0", "n1"],
        )


def learn_lexicon(sample: DataFrame) -> dict[str, int]:
    """Entry -> strength, from rows ``text, toxic``; at most ``LEXICON_SIZE`` entries reach the driver."""
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return {}
    counts = sample.select("text", "toxic").mapInArrow(_count_entries, "entry string, n0 long, n1 long")
    odds = F.ln((F.col("n1") + 0.5) / (sizes[1] + 1.0)) - F.ln((F.col("n0") + 0.5) / (sizes[0] + 1.0))
    share = sizes[1] / (sizes[0] + sizes[1])
    n = F.col("n0") + F.col("n1")
    surprise = lambda k, p: F.when(k > 0, k * F.ln(k / (n * p))).otherwise(0.0)
    g = 2 * (surprise(F.col("n1"), share) + surprise(F.col("n0"), 1 - share))
    top = (
        counts.groupBy("entry")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .withColumn("odds", odds)
        .withColumn("g", g)
        .where((F.col("odds") >= MIN_ODDS) & (F.col("g") >= MIN_G))
        .orderBy(F.desc("g"), "entry")
        .limit(LEXICON_SIZE)
    )
    return {r["entry"]: 2 if r["g"] >= STRONG_G else 1 for r in top.collect()}


def feature_column(text: Column, entries: dict[str, int]) -> Column:
    @F.pandas_udf("array<double>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon = _Lexicon(entries)
        for texts in batches:
            yield pd.Series([np.array(text_features(t or "", lexicon)) for t in texts])
        release()

    return features(F.coalesce(text, F.lit("")))


class ToxicityModel:
    """A fitted scorer; ``score`` adds ``score`` (0 to 1) to a frame (see ``frames.aside`` for clashing names)."""

    def __init__(self, entries=None, trees=None, isotonic=None, constant: float = 0.0):
        self.entries, self.trees, self.isotonic, self.constant = entries, trees, isotonic, constant

    def score(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        if self.trees is None:
            return docs.withColumn("score", F.lit(self.constant))
        from pyspark.ml.functions import array_to_vector

        rows = docs.withColumn("_vector", array_to_vector(feature_column(F.col(text_col), self.entries)))
        return self._rate(rows).drop("_vector")

    def _raw(self, rows: DataFrame) -> DataFrame:
        from pyspark.ml.functions import vector_to_array

        out = self.trees.transform(rows)
        return out.withColumn("_raw", F.get(vector_to_array("_probability"), F.lit(1))).drop(
            "_probability", "_margin", "_class"
        )

    def _rate(self, rows: DataFrame) -> DataFrame:
        out = self.isotonic.transform(self._raw(rows))
        return out.withColumn("score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), "_rate"))).drop("_raw", "_rate")


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Fit on the documents whose id is in ``labels(doc_id, toxic)``.

    At most ``FIT_ROWS`` labelled rows are used (smallest hash of the id; their ids are broadcast, which
    this number bounds): half for the lexicon, three tenths for the trees, the rest for calibration. Null
    ids, null labels and labels other than 0 and 1 are ignored; an id with both labels counts as toxic. A
    class that is missing from a part (small or empty tables) gives the sample's toxic share for every text.
    """
    # imported here: the workers, which import this module, need no Spark ML
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import IsotonicRegression

    limit_batches(docs.sparkSession)
    ids = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    ids = ids.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
    part = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("part")), F.lit(10))
    sample = stored(
        docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", "toxic", part.alias("part")),
        "toxic-sample",
    )
    entries = learn_lexicon(sample.where("part < 5").dropDuplicates(["text", "toxic"]))
    rest = stored(
        sample.where("part >= 5").select("toxic", "part", feature_column(F.col("text"), entries).alias("f")), "toxic-fit"
    )
    n = {(r["cal"], r["toxic"]): r["n"] for r in rest.groupBy((F.col("part") >= 8).alias("cal"), "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 4:
        total = sum(n.values())
        return ToxicityModel(constant=sum(v for (_, t), v in n.items() if t == 1) / total if total else 0.0)
    rest = rest.select(F.col("toxic").cast("double").alias("toxic"), "part", array_to_vector("f").alias("_vector"))
    booster = GBTClassifier(
        featuresCol="_vector", labelCol="toxic", predictionCol="_class", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7
    )
    booster.setProbabilityCol("_probability").setRawPredictionCol("_margin")
    trees = booster.fit(rest.where("part < 8").coalesce(4))
    model = ToxicityModel(entries, trees)
    model.isotonic = IsotonicRegression(featuresCol="_raw", labelCol="toxic", predictionCol="_rate").fit(
        model._raw(rest.where("part >= 8")).select("_raw", "toxic")
    )
    return model


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learned from: CRC-32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted`` (1 if ``score >= threshold``) added; fitted on the
    labels of rows that are not held out. Null and empty texts are scored like any text without words; ids may
    be null or repeat; columns of these three names are replaced, all others stay; an empty table gives no rows."""
    train = labels.where(~held_out(F.col("doc_id")))
    model = fit(docs, train)
    out = model.score(aside(docs)).withColumn("held_out", held_out(F.col("doc_id")))
    return back(out.withColumn("predicted", (F.col("score") >= threshold).cast("int")), docs, "held_out", "score", "predicted")
