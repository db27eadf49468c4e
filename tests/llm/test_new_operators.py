"""Whitening, conversation repair and quality rules against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeworks.llm import conversations, quality, whitening
from tests.llm.helpers import DOCS, SPACED, corpus, with_clashes, words

# --------------------------------------------------------------------------- whitening

VECTORS = "vec_id long, embedding array<float>"


def integer_scatter(y):
    n, y = len(y), y.astype(object)
    s = y.sum(axis=0)
    return n * (y.T @ y) - np.outer(s, s)


def test_sums_are_exact_at_any_size():
    rng = np.random.default_rng(1)
    for size in (30, 1 << 19, 1 << 33, 1 << 62):
        y = rng.integers(-size, size, (5000, 3))
        cross, total = whitening.scatter_sums(y)
        assert (cross == y.astype(object).T @ y.astype(object)).all() and (total == y.astype(object).sum(axis=0)).all()
    for value in (0, 5, -5, 1 << 31, -(1 << 64) + 3, (1 << 130) - 1):
        assert sum(piece << (32 * place) for place, piece in whitening._limbs(value)) == value
        assert all(abs(piece) < 1 << 32 for _, piece in whitening._limbs(value))


def test_polynomial_and_roots(spark):
    """Against the polynomial by Faddeev and LeVerrier, and roots known beforehand, repeated and zero ones included."""
    rng = np.random.default_rng(2)
    matrix = integer_scatter(rng.integers(-9, 9, (40, 6)))
    matrix[:, 3], matrix[3, :] = matrix[:, 1].copy(), matrix[1, :].copy()  # so that one root is 0
    matrix[3, 3] = matrix[1, 1]
    m, c = np.zeros((6, 6), object), [1]
    for k in range(1, 7):
        m = matrix @ m + c[-1] * np.eye(6, dtype=int).astype(object)
        c.append(-int(np.trace(matrix @ m)) // k)
    poly = whitening.characteristic_polynomial(spark, matrix.tolist())
    assert poly == c[::-1]
    roots = whitening.real_roots(poly)
    assert np.allclose([float(r.value) for r in roots], np.linalg.eigvalsh(matrix.astype(float))[::-1], atol=1e-6)
    known = [0, 0, 1, 7, 7, 7, 10**9, 10**9 + 1, 10**30]
    poly = [1]
    for r in known:
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0])]
    found = whitening.real_roots(poly)
    assert [r.times for r in found] == [1, 1, 1, 3, 1, 2]
    for r, want in zip(found, (10**30, 10**9 + 1, 10**9, 7, 1, 0)):
        assert abs(r.value - want) <= Fraction(want, 1 << 110)
    assert [whitening.roots_above(poly, x) for x in (0, 1, 6, 7, 10**9)] == [7, 6, 6, 3, 2]


def whitened_rows(spark, rows, components=32):
    out = whitening.whiten(with_clashes(spark.createDataFrame(rows, VECTORS)), components).collect()
    return out


def test_whitening_against_a_plain_decomposition(spark):
    rng = np.random.default_rng(3)
    mixing = rng.normal(size=(12, 12))
    vectors = (rng.normal(size=(300, 12)) @ mixing).astype(np.float32)
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(vectors)]
    odd = [(900, None), (901, []), (902, [1.0] * 11 + [None]), (903, [math.nan] * 12), (904, [math.inf] + [0.0] * 11), (905, [1.0] * 5)]
    out = whitened_rows(spark, rows + odd, 5)
    assert len(out) == 300 * 5 and {r["vec_id"] for r in out} == set(range(300))
    x = np.floor(64.0 * vectors.astype(float)).astype(int) + 1_000_000
    centred = x - x.mean(axis=0)
    values, basis = np.linalg.eigh(centred.T @ centred / 300)
    for r in out:
        z = 300 * x[r["vec_id"]] - x.sum(axis=0)
        assert r["n"] == 300 and r["deviation"] == int((z * z).sum())
        k = -r["component"]
        assert abs(r["explained"] / (values[k] / values.sum()) - 1) < 1e-9
        assert abs(abs(r["whitened"]) - abs(centred[r["vec_id"]] @ basis[:, k]) / math.sqrt(values[k])) < 1e-8
        assert r["identity_error"] < 1e-9


def test_whitening_edges(spark):
    assert whitened_rows(spark, []) == [] and whitened_rows(spark, [(1, None), (2, [])]) == []
    one = whitened_rows(spark, [(1, [0.5, 0.25])])
    assert [(r["whitened"], r["explained"], r["deviation"]) for r in one] == [(None, 0.0, 0)] * 2
    # dependent dimensions, equal eigenvalues, null and repeated ids, huge entries
    square = [(None, [1.0, 0.0, 0.0]), (1, [-1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [0.0, -1.0, 0.0])]
    out = whitened_rows(spark, square)
    assert len(out) == 12 and [r["explained"] for r in out if r["component"] < 3] == [0.5] * 8
    assert all((r["whitened"] is None) == (r["component"] == 3) for r in out) and out[0]["identity_error"] < 1e-12
    for_id = {}
    for r in out:
        if r["component"] < 3:
            for_id.setdefault((r["vec_id"], r["component"]), []).append(r["whitened"])
    assert abs(sum(x * x for v in for_id.values() for x in v) - 8) < 1e-9
    huge = whitened_rows(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [1e9, 0.0])])
    assert len(huge) == 6 and all(r["deviation"] is None for r in huge if r["vec_id"] == 1)


# --------------------------------------------------------------------------- conversations

MESSAGES = "conv_id long, turn long, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?\Z")


def brute_repair(rows):
    """Cheapest, then ASCII-least repair of ``(role, text, fault)`` with whole audits at every step."""
    names = {"u": "user", "a": "assistant"}
    layers = [{} for _ in range(len(rows) + 1)]
    layers[0][""] = (0, "", ())
    for i in range(len(rows) + 1):
        layer = layers[i]
        grown = True
        while grown:
            grown = False
            for last, (cost, audit, out) in list(layer.items()):
                for to in {"": "u", "s": "u", "u": "a", "a": "u"}[last]:
                    new = (cost + 3, audit + "I", (*out, (names[to], "")))
                    if to not in layer or new[:2] < layer[to][:2]:
                        layer[to] = new
                        grown = True
        if i == len(rows):
            break
        role, text, fault = rows[i]
        for last, (cost, audit, out) in layer.items():
            moves = [(last, cost + 4, audit + "D", out)]
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                follow = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
                if role[:1] and role[:1] in follow:
                    moves.append((role[:1], cost + more, audit + "K", (*out, (role, text))))
                moves += [(to, cost + 3 + more, audit + "R", (*out, (names[to], text))) for to in follow if to in names]
            for to, c, a, o in moves:
                if to not in layers[i + 1] or (c, a) < layers[i + 1][to][:2]:
                    layers[i + 1][to] = (c, a, o)
    cost, audit, out = min((layers[-1][s] for s in ("", "a") if s in layers[-1]), key=lambda x: x[:2])
    assert PATTERN.match("".join(r[:1] or "?" for r, _ in out))
    return cost, audit, "\n".join(f"{r}:{t}" for r, t in out)


def exhaustive(rows, most):
    """Every audit of at most ``most`` cost, for tiny conversations."""
    names, found = {"u": "user", "a": "assistant"}, []

    def go(i, cost, audit, out):
        if cost > most or len(audit) > len(rows) + 3:
            return
        initials = "".join(r[:1] or "?" for r, _ in out)
        if not re.match(r"(s?(ua)*u?)?\Z", initials):
            return
        if i == len(rows) and PATTERN.match(initials):
            found.append((cost, audit, "\n".join(f"{r}:{t}" for r, t in out)))
        for r in names.values():
            go(i, cost + 3, audit + "I", [*out, (r, "")])
        if i < len(rows):
            role, text, fault = rows[i]
            go(i + 1, cost + 4, audit + "D", out)
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                go(i + 1, cost + more, audit + "K", [*out, (role, text)])
                for r in names.values():
                    go(i + 1, cost + 3 + more, audit + "R", [*out, (r, text)])

    go(0, 0, "", [])
    return min(found)


def run_repair(rows):
    repair, edits, open_most = conversations.Repair(), [], 0
    for role, text, fault in rows:
        edits += repair.add(conversations.Message(0, role, text), fault)
        open_most = max(open_most, repair.open_edits)
    cost, rest = repair.close()
    edits += rest
    return cost, "".join(e for e, _ in edits), "\n".join(f"{m.role}:{m.text}" for _, m in edits if m is not None), open_most


ROWS = st.lists(
    st.tuples(
        st.sampled_from(["user", "assistant", "system", "tool", "", "u"]),
        st.sampled_from(["x.", "y!", "z"]),
        st.sampled_from([None, None, None, "blank", "duplicate", "truncated"]),
    ),
    max_size=24,
)


@settings(max_examples=400, deadline=None)
@given(ROWS)
def test_repairs_are_cheapest_and_least(rows):
    got = run_repair(rows)
    assert got[:3] == brute_repair(rows)


@settings(max_examples=40, deadline=None)
@given(ROWS.map(lambda r: r[:3]))
def test_repairs_of_tiny_conversations(rows):
    got = run_repair(rows)
    assert got[:3] == exhaustive(rows, got[0])


def test_open_edits_stay_few():
    rng = random.Random(4)
    rows = [(("user", "assistant")[k % 2] if rng.random() < 0.8 else "system", f"{k}.", None) for k in range(20_000)]
    cost, audit, text, most = run_repair(rows)
    assert most < 200 and len(audit) >= 20_000 and PATTERN.match("".join(line[:1] for line in text.split("\n")))


def brute_summary(rows):
    """The summary of one conversation from its original ``(turn, role, text)`` rows and its id."""
    conv, rows = rows
    out = []
    for turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in out:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
    turns = {t for t, *_ in out if t is not None}
    cost, audit, text = brute_repair([(r, t, f) for (_, r, t), f in zip(out, faults)])
    return (
        conv,
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(out, out[1:])),
        cost,
        audit,
        hashlib.sha256(text.encode()).hexdigest(),
    )


def conversation_rows():
    rng = random.Random(6)
    rows = []
    for conv in [None, *range(150)]:
        for turn in range(rng.choice([1, 2, 3, 5, 9, 30])):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            role = rng.choice(["system", "tool", None, ""]) if rng.random() < 0.15 else role
            text = rng.choice([None, "", " \n\t", "Yes.", "no end", "né! ", "…", "a\nb?", "x. "]) if rng.random() < 0.4 else f"{' '.join(words(rng, 3))}."
            rows.append((conv, rng.choice([turn, turn, turn, turn * 3, None, 2]), role, text))
    rows += [(7000, 1, "user", "y" * 200_000 + "."), (7000, 2, "assistant", "ok."), (7001, None, None, None)]
    return rows + rows[40:60]


def test_summaries_brute_force(spark):
    rows = conversation_rows()
    frame = with_clashes(spark.createDataFrame(rows, MESSAGES)).repartition(5)
    messages = conversations.damaged(frame)
    got = conversations.summaries(messages, F.col("present"))
    assert got.columns[:9] == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    by = {}
    for conv, *rest in rows:
        by.setdefault(conv, []).append(tuple(rest))
    want = sorted((brute_summary(x) for x in by.items()), key=repr)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    edits = {}
    for r in sorted(conversations.repaired(messages, F.col("present")).collect(), key=lambda r: r["place"]):
        edits.setdefault(r["conv_id"], []).append(r)
    for conv, *_, audit, digest in want:
        mine = edits.get(conv, [])
        assert "".join(r["edit"] for r in mine) == audit and [r["place"] for r in mine] == list(range(len(mine)))
        text = "\n".join(f"{r['role']}:{r['text']}" for r in mine if r["role"] is not None)
        assert hashlib.sha256(text.encode()).hexdigest() == digest


def test_conversations_empty_and_text_ids(spark):
    none = spark.createDataFrame([], MESSAGES)
    assert conversations.summaries(none).collect() == [] and conversations.repaired(none).collect() == []
    named = spark.createDataFrame([("a", 0, "user", "Hi."), ("a", 1, "assistant", "Yes.")], MESSAGES.replace("conv_id long", "conv_id string"))
    (row,) = conversations.summaries(named).collect()
    assert (row["conv_id"], row["cost"], row["audit"]) == ("a", 0, "KK")


# --------------------------------------------------------------------------- quality


def brute_counts(text):
    text = text or ""
    w = SPACED.findall(text)
    lines = [line for line in text.split("\n") if SPACED.search(line)]
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    inside = {i + k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def js(p, q):
    p, q = np.array(p, float) / sum(p), np.array(q, float) / sum(q)
    m = (p + q) / 2
    return math.sqrt(max(0.0, sum(x * math.log2(x / y) for v in (p, q) for x, y in zip(v, m) if x > 0) / 2))


def quality_rows():
    rng = random.Random(9)
    usual = {g: words(rng, 400) for g in ("en", "de")}
    rows = corpus(4, 40)
    for k in range(200):
        g = rng.choice(["en", "de"])
        text = " ".join(rng.choice(usual[g][:40] if rng.random() < 0.6 else usual[g]) for _ in range(rng.randint(100, 300)))
        rows.append((1000 + k, text.capitalize() + ".", g, "s", 1))
    run = " ".join(usual["en"][:9])
    rows += [(2000, " ".join(usual["en"][:60]).upper(), "en", "s", 1), (2001, " | ".join(words(rng, 90)), None, "s", 1)]
    rows += [(2002, f"{run} {run}", "en", "s", 1), (2003, f"{run} x {run} " * 8, "en", "s", 1), (2004, "a " * 30_000, "en", "s", 1)]
    return rows + [(2005, " ".join(rng.choice(usual["de"][:40]) for _ in range(40_000)), "de", "s", 1), (2006, "日本語 текст 😀 é " * 9, "xx", "s", 1)]


def test_quality_brute_force(spark):
    rows = quality_rows()
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    got = quality.quality(with_clashes(docs)).collect()
    texts = Counter((i, *brute_counts(t)) for i, t, *_ in rows)
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == texts
    # references and distances from scratch
    strip = lambda w: w.strip(".,;:!?\"'()[]").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) or w
    table = quality.class_table()
    count, classes = {}, {}
    for _, t, g, *_ in rows:
        if g is not None:
            w = SPACED.findall(t or "")
            top, bottom = 1024 * min(len(w), quality.MOST_WORDS), max(1, len(w))
            for x, n in Counter(w).items():
                count.setdefault(g, Counter())[strip(x)] += n * top // bottom
            for x, n in Counter(int(table[ord(c)]) for c in t or "").items():
                classes.setdefault(g, Counter())[x] += n * top // bottom
    top = {}
    for g, c in count.items():
        if sum(c.values()) >= quality.MIN_REFERENCE * 1024:
            best = sorted(c.items(), key=lambda x: (-x[1], x[0].encode()))[: quality.COMMON_WORDS]
            top[g] = [w for w, _ in best], [n for _, n in best] + [sum(c.values()) - sum(n for _, n in best)]
    assert set(top) == {"en", "de"}
    by_id = {r["doc_id"]: r for r in got}
    for i, t, *_ in rows:
        if i is None or i < 1000:
            continue
        r, w = by_id[i], list(map(strip, SPACED.findall(t)))
        mine = Counter(int(table[ord(c)]) for c in t)
        near = min(js([mine[k] for k in range(9)], [classes[g][k] for k in range(9)]) for g in top)
        assert abs(r["class_distance"] - near) < 1e-6
        n = Counter(w)
        far = min(js([*(n[x] for x in top[g][0]), len(w) - sum(n[x] for x in top[g][0])], top[g][1]) for g in top)
        assert abs(r["word_distance"] - far) < 1e-6
        failed = len(w) < 20 or 100 * r["n_repeat_words"] > 30 * len(w)
        rules = quality.Rules()
        odd = (len(w) >= rules.class_words and near > rules.class_distance) or (len(w) >= rules.word_words and far > rules.word_distance)
        assert (r["base_failed"], r["kept"]) == (failed, not failed and not odd)
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert sum(1000 + k in kept for k in range(200)) >= 195
    assert not kept & {2000, 2001, 2002, 2003, 2004}


def test_quality_edges(spark):
    assert quality.quality(spark.createDataFrame([], DOCS)).collect() == []
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "", "en", "s", 1), (2, " \n ", "en", "s", 1)]
    got = quality.quality(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == 4 and all(r["base_failed"] and not r["kept"] and r["n_words"] == 0 for r in got)
    no_language = [(k, " ".join(words(random.Random(k), 50)), None, "s", 1) for k in range(5)]
    assert all(r["kept"] for r in quality.quality(spark.createDataFrame(no_language, DOCS)).collect())
    p = np.array([[1.0, 1, 0], [0, 0, 5], [0, 0, 0]])
    assert np.allclose(quality.js_distance(p, np.array([2.0, 2, 0])), [0, 1, 1])
