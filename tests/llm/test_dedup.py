"""Exact, near and line deduplication against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from lakeworks.llm import exact_dedup, graph, line_dedup, near_dedup
from tests.llm.helpers import DOCS, LOWER, SPACED, corpus, rows_of, with_clashes, words


def test_chunks_are_the_text(spark):
    rng = random.Random(3)
    texts = [" ".join(words(rng, n)) for n in (0, 1, 300, 9000)] + ["x" * 40_000, "é\n" * 9000, "a b" * 7000]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(
        "text", exact_dedup.chunks(F.col("text")).alias("c")
    )
    for r in rows.collect():
        assert "".join(r["c"]) == r["text"]
        assert all(len(c) <= exact_dedup.MAX_CHUNK for c in r["c"])
        assert all(len(c) >= exact_dedup.MIN_CHUNK for c in r["c"][:-1])


def test_chunks_realign_after_an_insertion(spark):
    text = " ".join(words(random.Random(5), 8000)).replace("b ", "d ")
    rows = spark.createDataFrame([(text,), ("inserted words " + text,)], "text string").select(
        exact_dedup.chunks(F.col("text")).alias("c")
    )
    one, two = (r["c"] for r in rows.collect())
    assert len(set(one) & set(two)) >= len(one) // 2


def test_exact_duplicates_brute_force(spark):
    rows = corpus()
    got = exact_dedup.exact_duplicates(with_clashes(spark.createDataFrame(rows, DOCS)))
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    want = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        kept = False
        for i in ids:
            mine = i == keep and not kept
            kept |= mine
            want.append((i, keep, len(ids), mine, sha))
    assert rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=repr)


def test_exact_duplicates_of_nothing(spark):
    assert exact_dedup.exact_duplicates(spark.createDataFrame([], DOCS)).collect() == []


def test_colliding_identifiers_are_noticed(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    real = exact_dedup._identifier
    monkeypatch.setattr(exact_dedup, "_identifier", lambda c, seed: F.struct(F.lit(1).alias("a")) if seed == 0 else real(c, seed))
    assert exact_dedup.verified_seed(docs) == 1
    assert {r["group_size"] for r in exact_dedup.exact_duplicates(docs).collect()} == {1}


# --------------------------------------------------------------------------- near duplicates


def shingles(text):
    w = SPACED.findall((text or "").translate(LOWER))
    return {tuple(w[a : a + 5]) for a in range(max(1, len(w) - 4))} if w else set()


def near_brute_force(rows, share=85):
    sets = {}
    for i, t, *_ in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingles(t))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(
                p and q and 100 * len(p & q) >= share * len(p | q) for p in sets[a] for q in sets[b]
            ):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_near_duplicates_brute_force(spark):
    rows = corpus(2, 40)
    got = near_dedup.near_duplicates(with_clashes(spark.createDataFrame(rows, DOCS)))
    want = near_brute_force(rows)
    expected = [
        (i, len(shingles(t)), None if i is None else want[i], i is None or want[i] == i) for i, t, *_ in rows
    ]
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == sorted(expected, key=repr)
    assert len(set(want.values())) < len(want)


def test_near_duplicate_chains_and_a_wide_group(spark):
    """A group whose members differ more and more: links exist between neighbours only."""
    rng = random.Random(9)
    base = words(rng, 150)
    rows = []
    for k in range(60):
        if k:
            base = list(base)
            base[rng.randrange(len(base))] = f"step{k}"
        rows.append((1000 - k, " ".join(base)))
    rows += [(k, " ".join([*base[:75], *words(rng, 90)])) for k in range(20)]  # a common passage, no links
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    want = near_brute_force(rows)
    assert rows_of(got, "doc_id", "component_id") == sorted(want.items(), key=repr)


def test_large_buckets_are_dealt_into_groups(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "GROUP", 4)
    rows = corpus(4, 20)
    want = near_brute_force(rows)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, DOCS))
    assert {r["doc_id"]: r["component_id"] for r in got.collect() if r["doc_id"] is not None} == want


def test_sketches_never_hide_a_link():
    """The sketch's estimate lets pairs above the threshold through, whatever the size of the sets."""
    rng = random.Random(11)
    import numpy as np

    for n in (6, 20, 80, 300, 3000):
        for _ in range(60):
            common = [rng.getrandbits(64) for _ in range(n)]
            extra = int(n * 0.15 / 0.85)  # similarity of 0.85 or a little more
            p = np.unique(np.array(common + [rng.getrandbits(64) for _ in range(extra)], np.uint64))
            q = np.unique(np.array(common, np.uint64))
            s = near_dedup._sketches([p, q])
            assert near_dedup._may_reach(s[0], s[1:], len(p), np.array([len(q)]), 85)[0]


def test_one_of_each_group(spark):
    rows = corpus(2, 40)
    docs = with_clashes(spark.createDataFrame(rows, DOCS))
    left = near_dedup.one_of_each_group(docs)
    assert left.columns == docs.columns
    want = near_brute_force(rows)
    kept = Counter(r["doc_id"] for r in left.collect())
    assert kept == Counter({i: 1 for i in want if want[i] == i} | {None: sum(r[0] is None for r in rows)})


def test_near_duplicates_of_nothing_and_long_texts(spark):
    assert near_dedup.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []
    long = " ".join(words(random.Random(1), 120_000))
    rows = [(1, long), (2, long + " end"), (3, "x" * 700_000), (4, long.split()[0] + " " + long)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got, "doc_id", "component_id") == [(1, 1), (2, 1), (3, 3), (4, 1)]
    assert {r["doc_id"]: r["n_shingles"] for r in got.collect()} == {i: len(shingles(t)) for i, t in rows}


def test_components_of_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(205, 203), (203, 205), (7, 7)]
    got = graph.components(spark.createDataFrame(links, "u long, v long"))
    want = {k: 0 for k in range(41)} | {100 + k: 100 for k in range(30)} | {203: 203, 205: 203}
    assert rows_of(got, "node", "component") == sorted(want.items(), key=repr)
    assert graph.components(spark.createDataFrame([], "u long, v long")).collect() == []


# --------------------------------------------------------------------------- lines


BLANKS = " \t\x0b\x0c\r\n"


def lines_brute_force(rows, run, short_words):
    seen, out = set(), {}
    order = sorted({(i is not None, i, t or "") for i, t, *_ in rows}, key=lambda r: (r[0], r[1] or 0))
    for _, i, text in order:
        full = [(k, x.strip(BLANKS)) for k, x in enumerate(text.split("\n")) if x.strip(BLANKS)]
        n_words = [len(SPACED.findall(x)) for _, x in full]
        gone = set()
        for size in range(1, run + 1) if short_words is not None else [run]:
            for a in range(len(full) - size + 1):
                if size < run and sum(n_words[a : a + size]) < short_words:
                    continue
                window = tuple(x for _, x in full[a : a + size])
                if window in seen:
                    gone |= set(range(a, a + size))
                seen.add(window)
        drop = {full[g][0] for g in gone}
        left = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in drop)
        out[i, text] = (left, len(full), len(gone), sum(g - 1 not in gone for g in gone))
    return sorted(((i, *out[i, t or ""]) for i, t, *_ in rows), key=repr)


def test_line_dedup_brute_force(spark):
    for run, short_words in ((1, None), (2, None), (3, None), (3, 8), (2, 5), (3, 50)):
        rows = corpus(6, 40)
        rows.append((400, "one\ntwo\n\nthree\none\n two \nthree\nthree\nthree\nthree\nthree", "en", "s", 1))
        rows.append((401, "\n".join(f"line {k % 50}" for k in range(2000)), "en", "s", 1))
        got = line_dedup.line_dedup(with_clashes(spark.createDataFrame(rows, DOCS)), run, short_words=short_words)
        assert rows_of(got, "doc_id", "text", "n_lines", "n_deleted", "n_runs") == lines_brute_force(rows, run, short_words)


def test_short_runs_and_line_ends(spark):
    """Repeated passages of one and two lines go if they are long; copies with other line ends and blanks meet."""
    rng = random.Random(14)
    long, a, b = " ".join(words(rng, 60)), " ".join(words(rng, 30)), "\t".join(words(rng, 25))
    rows = [
        (1, long, "en", "s", 1),
        (2, f"own words\r\n{long}\r\nmore\r\n", "en", "s", 1),
        (3, f"{a}\n{b}", "en", "s", 1),
        (4, f"x\n\t{a} \r\n\r\n  {b}\x0c\ny", "en", "s", 1),
        (5, a, "en", "s", 1),
        (6, long, "en", "s", 1),
        (7, "\r\n\t\r", "en", "s", 1),
        (8, long.replace(" ", " " * 3, 1), "en", "s", 1),
    ]
    got = line_dedup.line_dedup(spark.createDataFrame(rows, DOCS))
    assert rows_of(got, "doc_id", "text", "n_lines", "n_deleted", "n_runs") == lines_brute_force(rows, 3, 50)
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert texts[1] == long and texts[2] == "own words\r\nmore\r\n" and texts[4] == "x\n\r\ny" and texts[5] == a and texts[6] == ""


def test_line_dedup_of_nothing(spark):
    assert line_dedup.line_dedup(spark.createDataFrame([], DOCS)).collect() == []
