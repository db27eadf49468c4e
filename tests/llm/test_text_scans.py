"""Decontamination, token counts, licences, language and toxicity."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeworks.llm import decontam, langid, licenses, textops, tokens, toxicity
from tests.llm.helpers import ALNUM, DOCS, LOWER, corpus, rows_of, with_clashes, words


def alnum(text):
    return ALNUM.findall((text or "").translate(LOWER))


def test_word_hashes_agree_across_blocks_and_long_texts(monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(words(rng, n)).encode() for n in (0, 1, 50, 5000, 30_000)] + [b"x" * 5000 + b" y", b"", b"--"]
    for tables in (textops.byte_tables(textops.SPACE_BYTES), textops.byte_tables(textops.NON_ALNUM_BYTES)):
        whole = {}
        for first, last, doc, h in textops.word_blocks(texts, tables):
            for k in range(first, last):
                whole[k] = h[doc == k - first].tolist()
        monkeypatch.setattr(textops, "PIECE", 1000)
        for first, last, doc, h in textops.word_blocks(texts, tables):
            for k in range(first, last):
                assert whole[k] == h[doc == k - first].tolist()
        monkeypatch.undo()
        assert [len(whole[k]) for k in range(len(texts))] == [len(t.split()) for t in texts[:-1]] + [
            0 if tables[0][ord("-")] == 0 else 1
        ]


# --------------------------------------------------------------------------- decontamination


def contamination_brute_force(rows, items, size=13):
    windows = {}
    for i, t in items:
        w = alnum(t)
        for a in range(len(w) - min(size, len(w)) + 1 if w else 0):
            windows.setdefault(tuple(w[a : a + size]), set()).update([str(i)] if i is not None else [])
    out = []
    for i, t, *_ in rows:
        w = alnum(t)
        hit, found = set(), set()
        for m in {len(x) for x in windows}:
            for a in range(len(w) - m + 1):
                if tuple(w[a : a + m]) in windows:
                    hit |= set(range(a, a + m))
                    found |= windows[tuple(w[a : a + m])]
        out.append((i, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def contaminated_corpus():
    rng = random.Random(8)
    rows = corpus(8, 30)
    items = [(k, " ".join(words(rng, n)).title()) for k, n in enumerate([13, 14, 20, 60, 12, 5, 4, 2, 1])]
    items += [(20, items[3][1]), (21, None), (22, ""), (23, "?!"), (None, items[2][1]), (24, "a a a a a a a a a a a a a a a a")]
    for k, (_, t) in enumerate(items[:9]):
        rows.append((500 + k, f"{' '.join(words(rng, 9))} {t.upper()}, {' '.join(words(rng, 40))} {t}", "en", "s", 1))
    w = items[3][1].split()
    rows.append((520, " ".join([*w[5:17], "gap", *w[20:33], *w[40:60], *w[41:60]]), "en", "s", 1))  # 12 words: no window
    rows.append((521, " ".join(["a"] * 40), "en", "s", 1))
    rows.append((522, " ".join([*words(rng, 90_000), *w[:13]]), "en", "s", 1))
    return rows, items


def test_contamination_brute_force(spark):
    rows, items = contaminated_corpus()
    docs = with_clashes(spark.createDataFrame(rows, DOCS))
    bench = with_clashes(spark.createDataFrame(items, "item_id long, text string"))
    got = decontam.contamination(docs, bench)
    want = contamination_brute_force(rows, items)
    assert rows_of(got, "doc_id", "n_words", "n_hit", "items", "contaminated") == want
    assert all(r["n_items"] == len(r["items"]) for r in got.collect())
    left = decontam.without_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert rows_of(left, "doc_id") == sorted(((r[0],) for r in want if not r[4]), key=repr)


def test_contamination_without_rows(spark):
    docs, bench = spark.createDataFrame(corpus(8, 3), DOCS), spark.createDataFrame([], "item_id long, text string")
    assert {r["n_hit"] for r in decontam.contamination(docs, bench).collect()} == {0}
    assert decontam.contamination(spark.createDataFrame([], DOCS), bench).collect() == []


def test_winnowing_keeps_a_fingerprint_of_every_run():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 50, 4000).astype(np.uint64)
    doc = np.repeat(np.arange(8), 500)
    for length, k in ((13, 5), (5, 5), (4, 4), (1, 1), (7, 5)):
        at, _ = decontam.winnow(doc, h, length, k)
        kept = set(at.tolist())
        for start in range(len(h) - length + 1):
            if doc[start] == doc[start + length - 1]:
                assert any(p in kept for p in range(start, start + length - k + 1))


# --------------------------------------------------------------------------- token counts


def test_token_counts_of_whole_texts(spark, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = corpus(3, 30)
    odd = ["<|endoftext|>", "a<|endoftext|>b <|startoftext|> <| endoftext|>", "don't I'LL x'S 's  '\tt", "é ́e   x y\x1cz\x85q",
           "١٢٣ 12.5% a_b __ \U0001f600\U0001f600 中文字", "​zero﻿", "word " * 30_000, "y" * 20_000, "İI ǅ ß SS"]
    rows += [(600 + k, t, "en", "s", 1) for k, t in enumerate(odd)]
    got = tokens.token_counts(with_clashes(spark.createDataFrame(rows, DOCS)), path, limit=20)
    whole = Tokenizer.from_file(path)
    want = []
    for i, t, *_ in rows:
        n = len(whole.encode(t or "", add_special_tokens=False))
        want.append((i, len((t or "").encode()), n, n > 20))
    assert rows_of(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)
    assert tokens.token_counts(spark.createDataFrame([], DOCS), path).collect() == []
    monkeypatch.setattr(tokens, "KEPT_PIECES", 3)
    monkeypatch.setattr(tokens, "BATCH_BYTES", 50)
    texts = [(t or "").encode() for _, t, *_ in rows]
    assert tokens.count_texts(texts, whole, {}) == [len(whole.encode(t.decode(), add_special_tokens=False)) for t in texts]


# --------------------------------------------------------------------------- licences


def licence_brute_force(rows, share):
    out = []
    for i, t, *_ in rows:
        text = t or ""
        w = alnum(text)
        base = []
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            base += [(a, label) for a in range(len(w)) if w[a : a + len(p)] == p]
        blocks = [set(alnum(x)) for x in text.split("\n")]
        for part in __import__("re").split(r"\n[ \t\r\f\v]*(?=\n)", text):
            blocks.append(set(alnum(part)))
        best, labels = 0.0, {x for _, x in base}
        for label, template in licenses.TEMPLATES:
            tokens_ = set(alnum(template))
            for b in blocks:
                both = len(b & tokens_)
                if both >= math.ceil(share * len(tokens_) - 1e-9):
                    labels.add(label)
                    best = max(best, both / len(tokens_))
        starts = [a for a, _ in base]
        out.append((i, len(w), len(base), min(starts, default=None), max(starts, default=None),
                    ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), 1.0 if base else best))
    return sorted(out, key=repr)


def test_license_scan_brute_force(spark):
    rng = random.Random(4)
    rows = corpus(9, 25)
    for k, (_, t) in enumerate(licenses.TEMPLATES):
        w = t.split()
        rows.append((700 + k, f"intro\n{t.upper()}\nend", "en", "s", 1))
        rows.append((720 + k, " ".join(w[1:]) + "\n\n" + " ".join(words(rng, 30)), "en", "s", 1))
        rows.append((740 + k, "\n".join(" ".join(w[a : a + 5]) for a in range(0, len(w), 5)), "en", "s", 1))
        rows.append((760 + k, " ".join(w[: len(w) // 2]), "en", "s", 1))
    rows.append((790, "cc by cc by-cc\nBY the MIT  license; mit licenses, GNU general public license", "en", "s", 1))
    columns = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    for share in (licenses.SHARE, 0.7):
        got = licenses.license_scan(with_clashes(spark.createDataFrame(rows, DOCS)), share=share)
        assert rows_of(got, *columns) == licence_brute_force(rows, share)
    assert licenses.license_scan(spark.createDataFrame([], DOCS)).collect() == []


# --------------------------------------------------------------------------- language


def cross_parse(text, reference):
    n = at = 0
    while at < len(text):
        size = 1
        while at + size <= len(text) and text[at : at + size] in reference:
            size += 1
        at += max(1, size - 1)
        n += 1
    return n


def test_cross_parsing_counts_phrases(monkeypatch):
    rng = random.Random(6)
    references = {"a": " ".join(words(rng, 300)), "b": "".join(rng.choice("abc ") for _ in range(800)), "c": "x"}
    parser = langid.CrossParser(references)
    texts = ["", "x", "zzz", " ".join(words(rng, 40)), "".join(rng.choice("abc ") for _ in range(300)), references["a"][20:200]]
    want = [[cross_parse(t, references[g]) for g in parser.languages] for t in texts]
    assert parser.phrases(texts)[0].tolist() == want
    monkeypatch.setattr(langid, "SEGMENT", 50)
    pieces = lambda t: [t[k : k + 50] for k in range(0, len(t), 50)]
    assert parser.phrases(texts)[0].tolist() == [[sum(cross_parse(p, references[g]) for p in pieces(t)) for g in parser.languages] for t in texts]


def test_language_ids(spark):
    rng = random.Random(7)
    make = {"aa": lambda: "".join(rng.choice("abcd ") for _ in range(200)), "bb": lambda: "".join(rng.choice("dcfgé ") for _ in range(200))}
    rows = [(k, make[g := rng.choice(["aa", "bb"])](), g, "s", 1) for k in range(200)]
    rows += [(900, None, "aa", "s", 0), (901, "", "bb", "s", 0), (902, "12 - ²½ !", "aa", "s", 0), (None, make["bb"](), "bb", "s", 0), (903, make["aa"]() * 300, None, "s", 0)]
    got = {r["doc_id"]: r for r in langid.language_ids(with_clashes(spark.createDataFrame(rows, DOCS))).collect()}
    for i, t, g, *_ in rows:
        assert got[i]["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1)
        assert got[i]["lang_pred"] == ("und" if i in (900, 901, 902) else g or "aa")
        assert 0 <= got[i]["score"] <= 1
    assert langid.language_ids(spark.createDataFrame([], DOCS)).collect() == []
    bare = langid.language_ids(spark.createDataFrame([(1, "text", None, "s", 1)], DOCS)).collect()
    assert bare[0]["lang_pred"] == "und"


SCRIPTS = {
    "el": "αβγδεζηθικλμνξοπρστυφχψω", "ru": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "uk": "абвгґдеєжзиіїйклмнопрстуфхцчшщьюя",
    "ja": "".join(map(chr, range(0x3041, 0x3097))) + "".join(map(chr, range(0x4E00, 0x4E80))),
    "ko": "".join(map(chr, range(0xAC00, 0xAE00))), "zh": "".join(map(chr, range(0x4E00, 0x5200))),
    "xx": "".join(map(chr, range(0x20000, 0x20100))),
    **{f"a{k}": "abcdefghijklmnopqrstuvwxyz" for k in range(3)},
}


def test_languages_of_many_scripts(spark):
    rng = random.Random(8)
    lexicon = {g: ["".join(rng.choice(c) for _ in range(rng.randint(1, 5))) for _ in range(120)] for g, c in SCRIPTS.items()}
    text = lambda g: " ".join(rng.choice(lexicon[g]) for _ in range(40))
    texts = [text(g) for g in SCRIPTS] + ["mixed " + text("ja") + text("el") + " \U0010ffff"]
    references = {g: text(g) * 2 for g in SCRIPTS}
    parser = langid.CrossParser(references)
    assert parser.phrases(texts)[0].tolist() == [[cross_parse(t, references[g]) for g in parser.languages] for t in texts]
    assert parser.phrases(texts)[1].tolist() == [[sum(c not in references[g] for c in t) for g in parser.languages] for t in texts]
    rows = [(k, text(g), g, "s", 1) for k, g in enumerate(sorted(SCRIPTS) * 40)]
    got = {r["doc_id"]: r for r in langid.language_ids(spark.createDataFrame(rows, DOCS)).collect()}
    held = [(i, g) for i, _, g, *_ in rows if got[i]["held_out"]]
    assert {g for _, g in held} == set(SCRIPTS)
    assert all(got[i]["lang_pred"] == g for i, g in held)


def test_a_language_of_few_rows_is_found(spark):
    """Three short labelled rows beside 16,000 characters of another language, and a header that a third of all rows share."""
    rng = random.Random(11)
    make = lambda c: ["".join(rng.choice(c) for _ in range(rng.randint(2, 7))) for _ in range(150)]
    lexicon = {"en": make("etaoinshrdlu"), "fr": make("etaoinsrléèàu")}
    text = lambda g, n: " ".join(rng.choice(lexicon[g]) for _ in range(n))
    learned = [k for k in range(2000) if zlib.crc32(str(k).encode()) % 3 != 1]
    rows = [(k, text("en", 60), "en", "s", 1) for k in learned[:150]] + [(k, text("fr", 20), "fr", "s", 1) for k in learned[150:153]]
    test = [(5000 + k, text("en" if k % 2 else "fr", 40), None, "s", 1) for k in range(200)]
    header = " ".join(rng.choice(lexicon["en"]) for _ in range(100))[:500]
    for shared in ("", header + "\n"):
        some = [(i, shared + t if i % 3 == 0 else t, *r) for i, t, *r in rows] + [(i, t, *r) for i, t, *r in rows[:1] * 80]
        got = {r["doc_id"]: r["lang_pred"] for r in langid.language_ids(spark.createDataFrame(some + test, DOCS)).collect()}
        for k, g in ((0, "fr"), (1, "en")):
            right = [got[i] == g for i, *_ in test if i % 2 == k]
            assert sum(right) > 0.9 * len(right), (g, bool(shared))


def test_language_never_learns_from_held_out_rows(spark):
    rows = [(k, "abc" if zlib.crc32(str(k).encode()) % 3 == 1 else "xyz", "held" if zlib.crc32(str(k).encode()) % 3 == 1 else "seen", "s", 1) for k in range(60)]
    got = langid.language_ids(spark.createDataFrame(rows, DOCS)).collect()
    assert {r["lang_pred"] for r in got} == {"seen"}


# --------------------------------------------------------------------------- toxicity


def toxic_rows(n=900):
    rng = random.Random(10)
    rows, labels = [], []
    for k in range(n):
        toxic = rng.random() < 0.25
        w = words(rng, rng.randint(5, 60))
        if toxic:
            for _ in range(rng.randint(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(["nastyword", "grub" + rng.choice("abcde") + "x", "nastyw0rd"]))
        rows.append((k, " ".join(w), "en", "s", 1))
        labels.append((k, 1, int(toxic)))
    return rows, labels


def test_toxicity_held_out_accuracy_and_edges(spark):
    rows, labels = toxic_rows()
    rows += [(2000, None, "en", "s", 0), (2001, "", "en", "s", 0), (None, "no id", "en", "s", 0), (3, rows[3][1], "en", "s", 1), (2002, "word " * 100_000, "en", "s", 1)]
    labels += [(None, 1, 1), (2000, 1, None), (5, 1, labels[5][2])]
    held = {k for k, *_ in labels if k is not None and zlib.crc32(str(k).encode()) % 4 == 2}
    truth = {k: t for k, _, t in labels}
    flipped = [(k, q, (1 - t) if k in held and t is not None else t) for k, q, t in labels]  # never learned from
    docs = spark.createDataFrame(rows, DOCS)
    got = toxicity.toxicity_scores(with_clashes(docs), spark.createDataFrame(flipped, "doc_id long, quality int, toxic int"))
    got = got.select("doc_id", "held_out", "score", "predicted").collect()
    assert len(got) == len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] == (r["doc_id"] in held) for r in got if r["doc_id"] is not None and r["doc_id"] < 900)
    judged = [r["predicted"] == truth[r["doc_id"]] for r in got if r["doc_id"] in held and r["doc_id"] < 900]
    assert sum(judged) / len(judged) > 0.97


def test_toxicity_without_labels_or_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(corpus(1, 4), DOCS)
    assert {r["score"] for r in toxicity.toxicity_scores(docs, empty).collect()} == {0.0}
    assert toxicity.toxicity_scores(spark.createDataFrame([], DOCS), empty).collect() == []


@pytest.mark.parametrize("text", ["", "   ", "!!!", "A", "you 1d10t!" * 50])
def test_features_are_finite(text):
    assert all(math.isfinite(x) for x in toxicity.text_features(text, toxicity._Lexicon({"idiot": 2})))


def test_obfuscated_words_are_seen():
    lexicon = toxicity._Lexicon({"idiot": 2, "loser*": 1})
    assert toxicity.text_features("what an 1di0t x1d10t", lexicon)[6] >= 0
    assert toxicity.text_features("an id1ot here", lexicon)[6] > 0
    assert toxicity.text_features("losers", toxicity._Lexicon({"loser*": 1}))[2] > 0


def brute_features(text, entries, masks):
    """The features from scratch, given how many masked words the text was built with: (all, those of the lexicon)."""
    words, word = [], ""
    for c in text.lower() + " ":
        if c.isalnum():
            word += c
        elif word:
            words.append(word)
            word = ""
    if not words:
        return [0.0] * 12
    strength = [max([entries.get(w, 0)] + [entries.get(w[:k] + "*", 0) for k in (4, 5, 6) if k < len(w)]) for w in words]
    hits = [k for k, x in enumerate(strength) if x]
    near = 0
    for k in hits:
        near += any(abs(k - j) <= 5 and words[j] in ("you", "your", "du", "tu") for j in range(len(words)))
    n, letters = len(words), sum(map(len, words))
    return [
        strength.count(2) / n, math.log(1 + strength.count(2)), strength.count(1) / n, math.log(1 + strength.count(1)),
        math.log(1 + len({words[k] for k in hits})), near / len(hits) if hits else 0.0, math.log(1 + masks[1]), masks[0] / n,
        sum("A" <= c <= "Z" for c in text) / max(1, letters), sum(c in "!?" for c in text) / n, 1 - letters / len(text), math.log(1 + n),
    ]


def test_features_brute_force():
    rng = random.Random(15)
    entries = {"idiot": 2, "loser*": 1, "grub": 1, "nasty*": 2}
    pool = ["idiot", "losers", "loser", "grub", "nastyword", "Nasty", "you", "YOUR", "du", "tree", "Éclair", "日本", "a_b", "house", "--", "?!", "x"]
    for _ in range(300):
        parts = [rng.choice(pool) for _ in range(rng.randint(0, 40))]
        masks = [0, 0]
        for _ in range(rng.randint(0, 2)):
            mask, known = rng.choice([("id1ot", 1), ("gr*b", 0), ("h0use", 0), ("1dle", None)])
            parts.insert(rng.randint(0, len(parts)), mask)
            masks = [masks[0] + (known is not None), masks[1] + (known or 0)]
        text = " ".join(parts) + rng.choice(["", "\n", "!"])
        got = toxicity.text_features(text, toxicity._Lexicon(entries))
        assert got == pytest.approx(brute_features(text, entries, masks)), text
