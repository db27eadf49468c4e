"""Language identification by cross-parsing entropy.

For each language the suffix automaton of a bounded amount of labelled text is built. A text is parsed
greedily against it: the longest match from the current place is one phrase, then parsing goes on behind
it. A text of the reference's language needs few, long phrases. A phrase from a long reference says less, as its
place among n characters costs ln(n) to name, and a character that the reference lacks costs as much as naming one
of all characters: so phrases are normalised by the length of the reference, and the language with the cheapest
parse wins, whether it has much labelled text or little. The automata become one table of transitions (failure included: the next phrase starts),
so that a batch of texts is parsed in lockstep, many places at a time, by a few array operations a
character. Long texts are parsed in segments of ``SEGMENT`` characters, all of them.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.llm.textops import limit_batches

#: characters of labelled text per language that an automaton is built from at most
REFERENCE_CHARS = 16_000
#: labelled texts per language that these characters are taken from (different ones, smallest hashes), and characters of
#: the piece, at a hashed place of the whole text, that one gives
REFERENCE_ROWS, ROW_CHARS = 160, 120
#: cost of a character that a reference lacks
UNSEEN = math.log(sys.maxunicode)
#: columns of a language's dense table: its most frequent characters, and 0 for those it has none of; transitions of
#: its further characters are found by binary search
DENSE = 64
SEGMENT = 512
#: characters parsed together
BLOCK = 1 << 20
_BETWEEN = re.compile(r"[\W\d_]+")


def normalised(text: str) -> str:
    """Lower case; every run of characters that no word has is one space."""
    return _BETWEEN.sub(" ", text.lower()).strip()


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts every substring; state 0 is the start."""
    link, length, move, last = [-1], [0], [{}], 0
    for c in symbols:
        new = len(move)
        move.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and c not in move[at]:
            move[at][c] = new
            at = link[at]
        if at >= 0:
            to = move[at][c]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                twin = len(move)
                move.append(dict(move[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at >= 0 and move[at].get(c) == to:
                    move[at][c] = twin
                    at = link[at]
                link[to] = link[new] = twin
        last = new
    return move


class Automaton:
    """A reference's transitions as ``2 * target + phrase-starts``, over codes of its own characters (1 .., the most
    frequent first; 0 is every other character)."""

    def __init__(self, reference: str):
        counts = Counter(reference)
        self.alphabet = sorted(counts, key=lambda c: (-counts[c], c))
        code = {c: k + 1 for k, c in enumerate(self.alphabet)}
        move = suffix_automaton([code[c] for c in reference])
        self.size = len(code) + 1
        self.root = np.ones(self.size, np.int32)  # a character without a match ends a phrase alone
        for c, to in move[0].items():
            self.root[c] = 2 * to + 1
        self.width = min(DENSE, self.size)
        table = np.empty((len(move), self.width), np.int32)
        table[:] = self.root[: self.width]
        rare = []
        for state, edges in enumerate(move[1:], 1):  # a match from the start opens a phrase
            for c, to in edges.items():
                if c < self.width:
                    table[state, c] = 2 * to
                else:
                    rare.append((state * self.size + c, 2 * to))
        self.table = table.reshape(-1)
        rare = np.array(sorted(rare), np.int64).reshape(-1, 2)
        self.keys, self.values = rare[:, 0].copy(), rare[:, 1].astype(np.int32)

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        if self.size == self.width:
            return self.table[state * self.width + code]
        to = self.table[state * self.width + np.where(code < self.width, code, 0)]
        far = np.flatnonzero(code >= self.width)
        if len(far):
            key = state[far].astype(np.int64) * self.size + code[far]
            to[far] = self.root[code[far]]
            if len(self.keys):
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                to[far] = np.where(self.keys[at] == key, self.values[at], to[far])
        return to


class CrossParser:
    """The automata of all languages. ``lookup`` numbers the characters that any reference has, by code point;
    ``codes`` gives each language's code of such a number."""

    def __init__(self, references: dict[str, str]):
        self.languages = sorted(references)
        self.automata = [Automaton(references[language]) for language in self.languages]
        #: what a phrase costs in each language: the place it is copied from
        self.prices = np.log(np.array([len(references[language]) + 1 for language in self.languages], float) + 1)
        known = sorted({c for a in self.automata for c in a.alphabet})
        number = {c: k + 1 for k, c in enumerate(known)}
        self.lookup = np.zeros(sys.maxunicode + 1, np.int32)
        self.lookup[[ord(c) for c in known]] = np.arange(1, len(known) + 1)
        self.codes = np.zeros((len(self.languages), len(known) + 1), np.int32)
        for codes, automaton in zip(self.codes, self.automata):
            codes[[number[c] for c in automaton.alphabet]] = np.arange(1, automaton.size)

    def costs(self, texts: list[str]) -> np.ndarray:
        """Normalised phrases of each text under each language (texts x languages), in nats; 0 for an empty text."""
        phrases, unseen = self.phrases(texts)
        return (phrases - unseen) * self.prices[None, :] + unseen * UNSEEN

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each text under each language (texts x languages), and how many of them are a character that the
        reference lacks; 0 for an empty text."""
        out = np.zeros((2, len(texts), len(self.languages)), np.int64)
        k = 0
        while k < len(texts):
            first, size = k, 0
            while k < len(texts) and (k == first or size + len(texts[k]) <= BLOCK):
                size += len(texts[k])
                k += 1
            self._parse(texts[first:k], out[:, first:k])
        return out[0], out[1]

    def _parse(self, texts: list[str], out: np.ndarray) -> None:
        sizes = np.array([len(t) for t in texts])
        chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols = self.lookup[chars]
        # segments, longest first: at each step the places still open are a prefix
        per = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), per)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
        begin = (np.cumsum(sizes) - sizes)[owner] + nth * SEGMENT
        length = np.minimum(SEGMENT, sizes[owner] - nth * SEGMENT)
        order = np.argsort(-length, kind="stable")
        begin, length, owner = begin[order], length[order], owner[order]
        if not len(order):
            return
        open_at = np.searchsorted(-length, -np.arange(length[0]), side="left")  # places open at each step
        steps = np.arange(int(length[0]))[:, None]
        symbols = symbols[np.minimum(begin[None, :] + steps, len(symbols) - 1)]  # a row per step
        for g, automaton in enumerate(self.automata):
            codes = self.codes[g]
            state = np.zeros(len(order), np.int32)
            count, unseen = np.zeros(len(order), np.int32), np.zeros(len(order), np.int32)
            for step in range(int(length[0])):
                n = open_at[step]
                code = codes[symbols[step, :n]]
                to = automaton.step(state[:n], code)
                count[:n] += to & 1
                unseen[:n] += code == 0
                state[:n] = to >> 1
            for k, found in enumerate((count, unseen)):
                out[k, :, g] = np.bincount(owner, weights=found, minlength=len(texts)).astype(np.int64)


def references(docs: DataFrame, train: Column) -> dict[str, str]:
    """Language -> labelled text, at most ``REFERENCE_CHARS`` characters each (the bound of what is collected)."""
    rows = docs.where(train & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.trim("text") != ""))
    key = F.xxhash64("text", F.length("text"))
    # one row per different text, combined before the shuffle; the rank limit is applied in every task as well, so
    # neither the copies of a text nor a language's rows meet in one task. A text that copies label differently teaches none
    one = rows.groupBy(key.alias("_key")).agg(F.min("doc_id").alias("_id"), F.min("lang").alias("lang"), F.max("lang").alias("_other"))
    one = one.where(F.col("lang") == F.col("_other")).drop("_other")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_key"))
    picked = one.withColumn("_k", rank).where(F.col("_k") <= REFERENCE_ROWS).drop("_k")
    # REFERENCE_ROWS ids a language
    picked = F.broadcast(picked.withColumnRenamed("lang", "_lang"))
    same = (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")) & (key == F.col("_key"))
    begin = F.pmod(F.xxhash64(F.col("_key")), F.greatest(F.lit(1), F.length("text") - ROW_CHARS + 1)) + 1
    piece = F.substring("text", begin.cast("int"), F.lit(ROW_CHARS))
    texts = docs.join(picked, same).groupBy("_lang", "_key").agg(F.min(piece).alias("text"))
    got: dict[str, str] = {}
    for r in sorted(texts.collect(), key=lambda r: (r["_lang"], r["_key"])):
        if len(got.get(r["_lang"], "")) < REFERENCE_CHARS:
            got[r["_lang"]] = (got.get(r["_lang"], "") + " " + normalised(r["text"]))[:REFERENCE_CHARS]
    return got


def held_out(id_col: Column) -> Column:
    """Rows that are never learned from: CRC-32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, parser: CrossParser) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row of ``docs(doc_id, held_out, text)``."""
    shared = docs.sparkSession.sparkContext.broadcast(parser)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = shared.value
        for batch in batches:
            whole = [t or "" for t in batch.column(2).to_pylist()]
            texts = [normalised(t) for t in whole]
            n = parser.costs(texts)
            names = np.array([*parser.languages, "und"], dtype=object)
            empty = np.array([not any(map(str.isalpha, t)) for t in whole], bool)
            if not parser.languages:
                best, score = np.zeros(len(texts), np.int64), np.zeros(len(texts))
            else:
                best = n.argmin(axis=1)  # ties: the first language by name
                ranked = np.sort(n, axis=1)
                second = ranked[:, 1] if n.shape[1] > 1 else ranked[:, 0] * 2
                low = ranked[:, 0]
                score = np.where(second > 0, second / np.maximum(1e-9, second + low), 0.0)
            best = np.where(empty, len(names) - 1, best)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(names[best].tolist(), pa.string()),
                    pa.array(np.where(empty, 0.0, score), pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select("doc_id", "held_out", "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )


def language_ids(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text, lang)``: ``doc_id, held_out, lang_pred, score``.

    Learns from text and non-null ``lang`` of rows that are not held out. ``lang_pred`` is ``und`` with score 0
    for null texts and texts without a letter (and for all texts when there is nothing to learn from). The
    score is the runner-up's share of the normalised phrases of the two best languages (0.5: a tie; ties go to the first
    language by name). Copies of a text are learned once; very long texts are parsed whole. Ids may be null
    (never learned from, not held out) or repeat; other columns are ignored; an empty table gives no rows.
    """
    limit_batches(docs.sparkSession)
    own = docs.select("doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    return identify(own, CrossParser(references(own, ~F.col("held_out"))))
