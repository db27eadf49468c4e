"""License scans: an exact set-similarity join of text blocks with license templates.

Templates are short public notices; a block is a line of a document or a run of lines between blank
ones. A block holds a template when it contains at least ``share`` of the template's distinct words. The
tokens are ordered by their frequency over the whole corpus, rarest first: a block that reaches the
threshold must hold one of the template's first ``|T| - need + 1`` tokens (prefix filter), must have
``need`` distinct words (length filter), and from the first shared token on enough template tokens must
be left (positional filter). What passes is counted out, so every block above the threshold is found.

The templates are a fixed short list in this module, which bounds the index that workers hold. A scan
hashes all words of a batch at once and looks at a document in detail only if one of its words is a prefix
token or starts a base phrase.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.decontam import words_of
from lakeworks.llm.textops import NON_ALNUM_BYTES, byte_tables, limit_batches, texts_of, word_blocks

#: base phrases and their labels
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: public license notices (label, words)
TEMPLATES = (
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
     " General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU"
     " Lesser General Public License as published by the Free Software Foundation"),
    ("apache", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with"
     " the License. You may obtain a copy of the License at"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
     " associated documentation files, to deal in the Software without restriction"),
    ("mit", "Released under the MIT License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
     " that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
)
SHARE = 0.9
_FILTER = 1 << 16


class TemplateIndex:
    """The templates with their tokens in global order and the prefix token -> templates lists."""

    def __init__(self, templates, share: float, frequency: Mapping[bytes, int]):
        rank = lambda t: (frequency.get(t, 0), t)
        self.templates = []
        self.prefix: dict[bytes, list[tuple[int, int]]] = {}
        for label, text in templates:
            tokens = sorted(set(words_of(text.encode())), key=rank)
            need = math.ceil(share * len(tokens) - 1e-9)
            for place, token in enumerate(tokens[: len(tokens) - need + 1]):
                self.prefix.setdefault(token, []).append((len(self.templates), place))
            self.templates.append((label, tokens, need))

    def matches(self, block: set[bytes]) -> dict[int, float]:
        """Template -> containment, for every template whose threshold the block reaches."""
        first: dict[int, int] = {}
        for token in block.intersection(self.prefix):
            for t, place in self.prefix[token]:
                first[t] = min(place, first.get(t, place))
        found = {}
        for t, place in first.items():
            _, tokens, need = self.templates[t]
            if len(block) < need or len(tokens) - place < need:  # length and positional filter
                continue
            both = sum(x in block for x in tokens[place:])  # the tokens before are not in the block
            if both >= need:
                found[t] = both / len(tokens)
        return found


def blocks_of(text: bytes) -> Iterator[bytes]:
    """Each line, and each run of several lines between blank lines."""
    run: list[bytes] = []
    for line in [*text.split(b"\n"), b""]:
        if line.strip():
            run.append(line)
            yield line
            continue
        if len(run) > 1:
            yield b"\n".join(run)
        run = []


def base_places(words: list[bytes], phrases: Mapping[str, str]) -> list[tuple[int, str]]:
    """``(start, label)`` of every place where a phrase's words stand consecutively."""
    out = []
    for phrase, label in phrases.items():
        parts = phrase.encode().split()
        at = -1
        while True:
            try:
                at = words.index(parts[0], at + 1)
            except ValueError:
                break
            if words[at : at + len(parts)] == parts:
                out.append((at, label))
    return out


def _hash_filter(words) -> np.ndarray:
    """A bit per 16-bit hash end: whether one of ``words`` has it."""
    tables, bits = byte_tables(NON_ALNUM_BYTES), np.zeros(_FILTER, bool)
    for _, _, _, h in word_blocks([b" ".join(words)], tables):
        bits[(h & np.uint64(_FILTER - 1)).astype(np.int64)] = True
    return bits


def token_frequencies(docs: DataFrame, templates=TEMPLATES) -> dict[bytes, int]:
    """Documents that hold each template word, over the whole corpus (one row per word reaches the driver)."""
    vocabulary = sorted({w for _, t in templates for w in words_of(t.encode())})
    tables, bits = byte_tables(NON_ALNUM_BYTES), _hash_filter(vocabulary)
    own = {int(h): w for w in vocabulary for _, _, _, hs in word_blocks([w], tables) for h in hs}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}
        for batch in batches:
            for _, _, doc, h in word_blocks(texts_of(batch.column(0)), tables):
                some = np.flatnonzero(bits[(h & np.uint64(_FILTER - 1)).astype(np.int64)])
                pairs = np.unique(np.stack([doc[some].astype(np.uint64), h[some]]), axis=1)[1]
                for x, n in zip(*np.unique(pairs, return_counts=True)):
                    word = own.get(int(x))
                    if word is not None:
                        total[word] = total.get(word, 0) + int(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in total], pa.string()), pa.array(list(total.values()), pa.int64())],
            names=["word", "n"],
        )

    rows = docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"].encode(): r["n"] for r in rows.collect()}


def license_scan(
    docs: DataFrame, templates=TEMPLATES, phrases: Mapping[str, str] = PHRASES, share: float = SHARE,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts the places of the base phrases, ``first_word`` and ``last_word`` are their smallest and
    largest start (null without one). ``labels`` adds the labels of all templates that a block of the text holds
    to at least ``share``. Both label columns are distinct, sorted and comma-joined. ``score``: 1 with a base
    phrase, else the best containment that reached the threshold, else 0. Null and empty texts have no words and
    no labels; ids may be null or repeat; other columns are ignored; an empty table gives no rows.
    """
    limit_batches(docs.sparkSession)
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    index = TemplateIndex(templates, share, token_frequencies(own, templates))
    probe = _hash_filter([*index.prefix, *(p.split()[0].encode() for p in phrases)])
    tables = byte_tables(NON_ALNUM_BYTES)
    kind = own.schema["doc_id"].dataType.simpleString()

    def detail(text: bytes) -> tuple:
        base = base_places(words_of(text), phrases)
        found: dict[int, float] = {}
        for block in blocks_of(text):
            for t, x in index.matches(set(words_of(block))).items():
                found[t] = max(x, found.get(t, 0.0))
        plain = sorted({label for _, label in base})
        every = sorted({*plain, *(index.templates[t][0] for t in found)})
        starts = [at for at, _ in base]
        score = 1.0 if base else max(found.values(), default=0.0)
        return len(base), min(starts, default=None), max(starts, default=None), ",".join(plain), ",".join(every), score

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            for first, last, doc, h in word_blocks(texts, tables):
                n = last - first
                rows = [(0, None, None, "", "", 0.0)] * n
                for d in np.unique(doc[probe[(h & np.uint64(_FILTER - 1)).astype(np.int64)]]):
                    rows[d] = detail(texts[first + int(d)])
                columns = list(zip(*rows)) if n else [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n),
                        pa.array(np.bincount(doc, minlength=n).astype(np.int64)),
                        *(pa.array(c, pa.int64()) for c in columns[:3]),
                        *(pa.array(c, pa.string()) for c in columns[3:5]),
                        pa.array(columns[5], pa.float64()),
                    ],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
                )

    return own.mapInArrow(
        scan,
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string,"
        " labels string, score double",
    )
