"""Near-duplicate groups: MinHash with tensored banding, candidates verified on full shingle sets.

A text's set holds its distinct 5-word shingles. ``2 * BLOCKS`` small blocks of ``ROWS`` minhashes are
computed in two collections A and B; the key of table (i, j) combines block A_i with block B_j. So
``BLOCKS ** 2`` tables of ``2 * ROWS`` minhashes each need only ``2 * BLOCKS * ROWS`` minhashes, about the
square root of what independent tables would take. A pair of similarity s meets in some table with
probability ``(1 - (1 - s**ROWS)**BLOCKS)**2``: 0.99998 at 0.85.

Scale: texts of one word sequence collapse first, so exact copies never pair up. Blocks that nobody else
has cannot meet, so only shared blocks are combined to keys. In a table's bucket every text is compared
with the bucket's smallest one only; buckets whose texts are then linked together are done. In the others,
texts of different components are compared with each other: the tables of one block A_i together, in
groups of bounded size, each pair at its first shared block. A sketch of 256 bytes per text, an estimate of
the similarity that errs by less than its margin, keeps the dissimilar from verification, so what is
written are pairs near or above the threshold, never all pairs of a bucket. Pairs, links and labels stay in
tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.frames import unused
from lakeworks.llm.graph import components
from lakeworks.llm.textops import SPACE_BYTES, byte_tables, grams, limit_batches, mix, release, texts_of, word_blocks
from lakeworks.session import stored

SHINGLE = 5
BLOCKS = 16
ROWS = 4
HASHES = 2 * BLOCKS * ROWS
#: bins of a text's sketch: the smallest shingle hash of each bin, a byte of it
BINS = 256
#: standard deviations of the sketch's estimate that it may fall short of the threshold
MARGIN = 4.5
#: texts of a bucket that are compared as one group
GROUP = 512
#: pairs of sketches compared together
PAIRS = 4_096
_rng = np.random.default_rng(20240607)
_XOR = _rng.integers(0, 1 << 64, HASHES, np.uint64)
_MUL = _rng.integers(0, 1 << 64, HASHES, np.uint64) | np.uint64(1)


def shingle_runs(texts: list[bytes], size: int = SHINGLE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first, bounds, hashes)`` per block of texts: text ``first + k`` owns ``hashes[bounds[k]:bounds[k+1]]``,
    its shingle hashes with repeats (one for a shorter text, none for one without words)."""
    tables = byte_tables(SPACE_BYTES)
    for first, last, doc, words in word_blocks(texts, tables):
        n = last - first
        word_at = np.searchsorted(doc, np.arange(n + 1))
        full = grams(words, size)
        inside = doc[: len(full)] == doc[size - 1 :] if len(full) else np.zeros(0, bool)
        short = [k for k in np.flatnonzero(np.diff(word_at) < size) if word_at[k + 1] > word_at[k]]
        owner, run = doc[: len(full)][inside], full[inside]
        if short:
            whole = [grams(words[word_at[k] : word_at[k + 1]], int(word_at[k + 1] - word_at[k]))[0] for k in short]
            owner, run = np.concatenate([owner, short]), np.concatenate([run, np.array(whole, np.uint64)])
            order = np.argsort(owner, kind="stable")
            owner, run = owner[order], run[order]
        yield first, np.searchsorted(owner, np.arange(n + 1)), run


def distinct_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    out = []
    for _, bounds, run in shingle_runs(texts):
        out += [np.unique(run[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    return out


def _minhashes(bounds: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the texts that have shingles, and their minhashes (texts x HASHES)."""
    full = np.flatnonzero(np.diff(bounds) > 0)
    low = np.empty((HASHES, len(full)), np.uint64)
    if len(full):
        begins, buffer = bounds[:-1][full], np.empty_like(run)
        for k in range(HASHES):
            np.bitwise_xor(run, _XOR[k], out=buffer)
            np.multiply(buffer, _MUL[k], out=buffer)
            low[k] = np.minimum.reduceat(buffer, begins)
    return full, mix(low.T)


def _blocks(low: np.ndarray) -> np.ndarray:
    """Block hashes (texts x 2 * BLOCKS); a block's place is part of its hash."""
    parts = low.reshape(len(low), 2 * BLOCKS, ROWS)
    key = np.broadcast_to(np.arange(1, 2 * BLOCKS + 1, dtype=np.uint64), parts.shape[:2])
    for k in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key.view(np.int64)


def _sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Texts x BINS bytes, 0 for an empty bin. The sets are sorted, so a bin's first hash is its smallest."""
    out = np.zeros((len(sets), BINS), np.uint8)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    if len(owner):
        h = np.concatenate(sets)
        place = owner * BINS + (h >> np.uint64(56)).astype(np.int64)
        first = np.concatenate([[True], place[1:] != place[:-1]])
        out.reshape(-1)[place[first]] = (h[first] % np.uint64(255)).astype(np.uint8) + 1
    return out


def _may_reach(one: np.ndarray, many: np.ndarray, n_one: int | np.ndarray, n_many: np.ndarray, share: int) -> np.ndarray:
    """Which of ``many`` sketches may belong to a set whose similarity to ``one``, a sketch or as many, is ``share`` percent
    or more.

    Bins sample the union without replacement, so the estimate's variance shrinks as they cover it.
    """
    s = share / 100
    used = (many | one) != 0
    bins = np.maximum(1, used.sum(axis=1))
    same = ((many == one) & used).sum(axis=1)
    union = np.maximum(bins, (n_many + n_one) / (1 + s))
    slack = MARGIN * np.sqrt(s * (1 - s) / bins * np.maximum(0.05, 1 - bins / union)) + 1 / bins
    sizes = np.minimum(n_many, n_one) * 100 >= np.maximum(n_many, n_one) * share
    return sizes & (same / bins >= s - slack)


_SIGNATURE = "n_shingles long, seq binary, a array<long>, b array<long>, sketch binary"


def _lists(rows: np.ndarray, full: np.ndarray, n: int) -> pa.Array:
    """A list per text, null for a text without words."""
    lengths = np.zeros(n + 1, np.int32)
    lengths[1:][full] = rows.shape[1]
    mask = np.ones(n, bool)
    mask[full] = False
    return pa.ListArray.from_arrays(
        pa.array(np.cumsum(lengths), pa.int32()), pa.array(rows.reshape(-1)), mask=pa.array(mask)
    )


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column(1))
        for first, bounds, run in shingle_runs(texts):
            n = len(bounds) - 1
            full, low = _minhashes(bounds, run)
            blocks = _blocks(low)
            sets = [np.unique(run[p:q]) for p, q in zip(bounds[:-1], bounds[1:])]
            sketch = _sketches(sets)
            own = texts[first : first + n]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, n),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([hashlib.sha256(b" ".join(t.lower().split())).digest() for t in own], pa.binary()),
                    _lists(blocks[:, :BLOCKS].copy(), full, n),
                    _lists(blocks[:, BLOCKS:].copy(), full, n),
                    pa.array([x.tobytes() for x in sketch], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "seq", "a", "b", "sketch"],
            )
    release()


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, seq, a, b, sketch`` per row of ``docs(doc_id, text)``; ``seq`` names the word sequence."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_sign, f"doc_id {kind}, {_SIGNATURE}")


# ------------------------------------------------------------------- candidates


def table_rows(nodes: DataFrame) -> DataFrame:
    """``key, i, node``: a row per table in which the node may meet another one."""
    blocks = nodes.select("node", F.posexplode(F.concat("a", "b")).alias("lane", "block"))
    shared = blocks.groupBy(F.col("block").alias("_block")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    lanes = (
        blocks.join(shared, F.col("block") == F.col("_block"), "left_semi")
        .groupBy(F.col("node").alias("_node"))
        .agg(F.collect_set("lane").alias("lanes"))
    )
    lanes = lanes.select(
        "_node",
        F.filter("lanes", lambda x: x < BLOCKS).alias("in_a"),
        F.transform(F.filter("lanes", lambda x: x >= BLOCKS), lambda x: x - BLOCKS).alias("in_b"),
    ).where((F.size("in_a") > 0) & (F.size("in_b") > 0))
    return (
        nodes.join(lanes, F.col("node") == F.col("_node"))
        .select("node", "a", "b", "in_b", F.explode("in_a").alias("i"))
        .select("node", "a", "b", "i", F.explode("in_b").alias("j"))
        .select(F.xxhash64(F.get("a", F.col("i")), F.get("b", F.col("j"))).alias("key"), "i", "node")
    )


def _bucket_stars(rows: DataFrame, nodes: DataFrame, share: int) -> DataFrame:
    """Each node of a bucket with the bucket's smallest node, where the sketches allow a link."""
    hubs = rows.groupBy(F.col("key").alias("_key")).agg(F.min("node").alias("u"), F.count(F.lit(1)).alias("_m")).where("_m > 1")
    pairs = rows.join(hubs, F.col("key") == F.col("_key")).where("u < node").select("u", F.col("node").alias("v")).distinct()
    x = nodes.select(F.col("node").alias("_x"), F.col("n").alias("n_u"), F.col("sketch").alias("s_u"))
    y = nodes.select(F.col("node").alias("_y"), F.col("n").alias("n_v"), F.col("sketch").alias("s_v"))
    pairs = pairs.join(x, F.col("u") == F.col("_x")).join(y, F.col("v") == F.col("_y"))
    kind = nodes.schema["node"].dataType.simpleString()

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, PAIRS) for b in batches for at in range(0, b.num_rows, PAIRS)):
            s_u, s_v = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in (3, 5))
            keep = _may_reach(s_u, s_v, batch.column(2).to_numpy(), batch.column(4).to_numpy(), share)
            yield batch.select([0, 1]).filter(pa.array(keep))
        release()

    return pairs.select("u", "v", "n_u", "s_u", "n_v", "s_v").mapInArrow(likely, f"u {kind}, v {kind}")


def _bucket_rest(rows: DataFrame, nodes: DataFrame, labels: DataFrame, tried: DataFrame, share: int) -> DataFrame:
    """Pairs that share a table, are in different components so far and have sketches that allow a link.

    Two texts share a table when they share a block A_i and a block B_j. So the open tables of a block A_i
    form one bucket; a bucket is dealt into parts of about ``GROUP`` texts and every two parts are a group.
    """
    named = rows.join(labels, F.col("node") == F.col("_node"), "left").select(
        "key", "i", "node", F.coalesce("component", "node").alias("comp")
    )
    open_keys = named.groupBy(F.col("key").alias("_key")).agg(F.min("comp").alias("p"), F.max("comp").alias("q")).where("p != q")
    left = named.join(open_keys, F.col("key") == F.col("_key"), "left_semi").select("node", "i", "comp").distinct()
    full = left.join(nodes.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"))
    full = stored(full.select("node", "i", "comp", "n", "a", "b", "sketch", F.get("a", F.col("i")).alias("bucket")), "near-open")
    sizes = full.groupBy(F.col("bucket").alias("_bucket")).agg(
        F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("parts"), F.min("comp").alias("p"), F.max("comp").alias("q")
    )
    dealt = full.join(sizes.where("p != q"), F.col("bucket") == F.col("_bucket")).withColumn(
        "part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    )
    dealt = dealt.select(
        "bucket", "part", "node", "i", "comp", "n", "a", "b", "sketch", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("_x")
    ).select(
        "bucket", F.least("part", "_x").alias("one"), F.greatest("part", "_x").alias("two"), "part", "node", "i", "comp", "n", "a", "b", "sketch"
    )
    kind = nodes.schema["node"].dataType.simpleString()

    def meet(table: pa.Table) -> pa.Table:
        col = {name: table.column(name) for name in table.column_names}
        node, comp, n, part = (col[c].to_numpy() for c in ("node", "comp", "n", "part"))
        i = int(col["i"][0].as_py())
        a, b = (np.array(col[c].to_pylist(), np.int64).reshape(-1, BLOCKS) for c in ("a", "b"))
        sketch = np.frombuffer(b"".join(col["sketch"].to_pylist()), np.uint8).reshape(-1, BINS)
        one, two = col["one"][0].as_py(), col["two"][0].as_py()
        order = np.arange(len(node))
        us, vs = [], []
        for k in order[part == one]:
            other = (part == two) & (comp != comp[k]) if one != two else (order > k) & (comp != comp[k])
            other &= ~(a[:, :i] == a[k, :i]).any(axis=1)  # a pair is met at its first shared block A_i
            at = np.flatnonzero(other)
            at = at[(b[at] == b[k]).any(axis=1)]  # and shares a table if it shares a block B_j, too
            at = at[_may_reach(sketch[k], sketch[at], n[k], n[at], share)]
            us.append(np.minimum(node[at], node[k]))
            vs.append(np.maximum(node[at], node[k]))
        none = [node[:0]]
        return pa.table({"u": np.concatenate(us or none), "v": np.concatenate(vs or none)})

    pairs = dealt.groupBy("bucket", "one", "two").applyInArrow(meet, f"u {kind}, v {kind}")
    return pairs.where("u != v").join(tried, ["u", "v"], "left_anti")


def _compare(share: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            tu, tv = texts_of(batch.column(2)), texts_of(batch.column(3))
            texts = {(k, len(t)): t for k, t in (*zip(u, tu), *zip(v, tv))}
            sets = dict(zip(texts, distinct_sets(list(texts.values()))))
            keep = []
            for a, b, x, y in zip(u, v, tu, tv):
                p, q = sets[a, len(x)], sets[b, len(y)]
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= share * (len(p) + len(q) - both) > 0)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
        release()

    return compare


def verified_links(docs: DataFrame, pairs: DataFrame, share: int) -> DataFrame:
    """The candidate pairs whose full shingle sets are similar enough. Only the texts of candidates move."""
    pairs = stored(pairs, "near-pairs")
    ends = pairs.select(F.col("u").alias("_node")).unionByName(pairs.select(F.col("v").alias("_node"))).distinct()
    texts = stored(
        docs.join(ends, F.col("doc_id") == F.col("_node"), "left_semi").select(F.col("doc_id").alias("_node"), "text"),
        "near-texts",
    )
    one = pairs.join(texts, F.col("u") == F.col("_node")).select("u", "v", F.col("text").alias("text_u"))
    two = one.join(texts, F.col("v") == F.col("_node")).select("u", "v", "text_u", F.col("text").alias("text_v"))
    kind = pairs.schema["u"].dataType.simpleString()
    return stored(two.mapInArrow(_compare(share), f"u {kind}, v {kind}").distinct(), "near-links")


def near_duplicates(docs: DataFrame, share: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Texts are linked when ``100 * intersection >= share * union`` of their sets of distinct 5-word shingles
    (A-Z lower-cased, words are runs of anything but ASCII white space; a shorter text is one shingle);
    every link rests on the full sets. ``component_id`` is the smallest id reachable over links, ``kept``
    marks the row of that id. A text that is null or has no word has an empty set and is its own group.
    Rows that share an id are one document (linked if any of its texts is). Rows with a null id are
    never linked: ``component_id`` null, ``kept`` true. Other columns are ignored; an empty table gives
    no rows; ``share`` must be 80 or more.
    """
    if not 80 <= share <= 100:
        raise ValueError("share must lie between 80 and 100")
    limit_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    signed = stored(signatures(docs), "near-signatures")
    nodes = stored(
        signed.where(F.col("doc_id").isNotNull() & F.col("a").isNotNull())
        .groupBy("seq")
        .agg(
            F.min("doc_id").alias("node"),
            F.first("n_shingles").alias("n"),
            F.first("a").alias("a"),
            F.first("b").alias("b"),
            F.first("sketch").alias("sketch"),
        ),
        "near-nodes",
    )
    rows = stored(table_rows(nodes), "near-tables")
    tried = stored(_bucket_stars(rows, nodes, share), "near-stars")
    links = verified_links(docs, tried, share)
    labels = components(links).select(F.col("node").alias("_node"), "component")
    more = verified_links(docs, _bucket_rest(rows, nodes, labels, tried, share), share)
    found = components(links.unionByName(more)).select(F.col("node").alias("_node"), "component")
    groups = nodes.join(found, F.col("node") == F.col("_node"), "left").select(
        F.col("seq").alias("_seq"), F.coalesce("component", "node").alias("_component")
    )
    # the rows of a huge group of copies are split by the skew-join handling (no aggregate sits on top)
    return signed.join(
        groups, F.col("doc_id").isNotNull() & F.col("a").isNotNull() & (F.col("seq") == F.col("_seq")), "left"
    ).select(
        "doc_id",
        "n_shingles",
        F.coalesce("_component", "doc_id").alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == F.coalesce("_component", "doc_id"))).alias("kept"),
    )


def one_of_each_group(docs: DataFrame, share: int = 85) -> DataFrame:
    """``docs`` (all columns) with one row of each near-duplicate group, that of the smallest id; rows without an
    id all stay, of rows that share an id one does."""
    found = near_duplicates(docs.select("doc_id", "text"), share)
    found = stored(found.where(F.col("doc_id").isNotNull()).select("doc_id", "kept"), "near-found")
    gone, twice = unused(docs, "_drop"), unused(docs, "_again")
    drop = stored(found.where(~F.col("kept")).select(F.col("doc_id").alias(gone)).distinct(), "near-drop")
    left = docs.join(drop, F.col("doc_id") == F.col(gone), "left_anti")
    again = found.where("kept").groupBy(F.col("doc_id").alias(twice)).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    again = stored(again.select(twice), "near-again")
    if again.isEmpty():
        return left
    match = F.col("doc_id") == F.col(twice)
    once = left.join(again, match, "left_semi").dropDuplicates(["doc_id"])
    return left.join(again, match, "left_anti").unionByName(once)
