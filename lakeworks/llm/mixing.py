"""Mixing sources to target weights by soft domain membership (native: DataFrame functions only).

A naive-Bayes classifier, counted from the labelled table, predicts each document's domain posteriors from
binned surface features and from how many distinct words it has of those that mark each domain, learned from
the same table. Projected gradient then fits a nonnegative rate per document (how often it is to
be used) by least squares: the expected tokens of each domain, ``sum(rate * tokens * posterior)``, should
match the target shares. Documents with the same bins have the same posteriors and, by symmetry, the same
rate, so the state of the descent is one row per combination of bins (bounded by the bins, whatever the
corpus holds), each iteration is one distributed sum, and only the sums per domain reach the driver. The
iterate itself is an expression over the sums so far, so no lineage grows and nothing is checkpointed.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.frames import aside, back
from lakeworks.session import stored

#: upper bounds of the bins of each feature; a value at or above the last one has a bin of its own
BINS = {
    "symbols": (0.02, 0.05, 0.1, 0.2),
    "distinct": (0.1, 0.3, 0.5, 0.7),
    "word_length": (3.0, 4.5, 6.0, 8.0),
    "length": (8.0, 64.0, 512.0, 4096.0),
}
#: bins of the number of distinct words of a domain
WORD_BINS = (0.5, 1.5, 3.5)
#: words that are learned for a domain at most, the strongest by log-likelihood ratio (G); a word's least smoothed
#: log-odds between the domain's labelled rows and the others, and its least G, which chance rarely reaches
WORDS, MIN_ODDS, MIN_G = 4_000, 2.0, 24.0
#: characters that count as symbols
SYMBOLS = "#$%&*+/<=>@[\\]^_`{|}~"
_SYMBOL = "[" + "".join("\\" + c for c in SYMBOLS) + "]"
#: weight of staying at rate 1, against the squared relative errors of the domains
RIDGE = 1e-2
ITERATIONS = 120
#: combinations of bins up to which their rates, a row of about 50 bytes each, are broadcast
MAX_CELLS = 1 << 17
#: labelled rows from which a domain can bound the total of a mix without repetition, and the least share of the input's
#: tokens that such a total falls to for a scarce domain
MIN_LABELS, LEAST_TOTAL = 30, 0.5
#: descent ends when a step changes the loss by no more than this share
TOLERANCE = 1e-5


def _held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``value`` as a column that is computed once per row: a generator keeps the optimiser from copying the
    expression into the lambdas and filters that use it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def features(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) plus ``n_tokens``, one bin column ``b_<feature>`` each and ``_hashes``, 32-bit hashes of
    the distinct words; null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = _held(docs, "_words", F.filter(F.split(F.lower(text), r"[\s.,;:!?]+"), lambda w: w != ""))
    rows = _held(rows, "_distinct", F.array_distinct("_words"))
    n, chars = F.size("_words"), F.length(text)
    values = {
        "symbols": F.try_divide(F.regexp_count(text, F.lit(_SYMBOL)), chars),
        "distinct": F.try_divide(F.size("_distinct"), n),
        "word_length": F.try_divide(chars - n, n),
        "length": n,
    }
    rows = _held(rows, "_values", F.struct(*[F.coalesce(v.cast("double"), F.lit(0.0)).alias(k) for k, v in values.items()]))
    bins = [_bin(F.col("_values")[name], bounds).alias(f"b_{name}") for name, bounds in BINS.items()]
    hashes = F.transform("_distinct", lambda w: F.hash(w)).alias("_hashes")
    return rows.select(*[F.col(c) for c in docs.columns], n.cast("long").alias("n_tokens"), *bins, hashes)


def _bins(domains: list[str]) -> dict:
    return BINS | {f"words{k}": WORD_BINS for k in range(len(domains))}


def _cell(domains: list[str]) -> Column:
    """One number for the combination of bins of a row."""
    code = F.lit(0)
    for name, bounds in _bins(domains).items():
        code = code * (len(bounds) + 1) + F.col(f"b_{name}")
    return code.cast("long")


def _bins_of(cell: Column, domains: list[str]) -> dict[str, Column]:
    """The bins that :func:`_cell` put into one number, by feature."""
    out, behind = {}, 1
    for name, bounds in reversed(_bins(domains).items()):
        out[name] = F.pmod(F.floor(cell / behind), F.lit(len(bounds) + 1)).cast("int")
        behind *= len(bounds) + 1
    return out


def with_word_bins(featured: DataFrame, words: list[list[int]]) -> DataFrame:
    """``featured`` with ``cell``, the combination of its bins and of those of each domain's learned words, in place
    of the bins and ``_hashes``."""
    domains = [str(k) for k in range(len(words))]
    n = [
        F.expr(f"size(filter(_hashes, w -> w IN ({', '.join(map(str, found))})))") if found else F.lit(0)
        for found in words
    ]
    rows = _held(featured, "_found", F.array(*n)).drop("_hashes")
    for k in range(len(words)):
        rows = rows.withColumn(f"b_words{k}", _bin(F.get("_found", F.lit(k)), WORD_BINS))
    return rows.withColumn("cell", _cell(domains)).drop("_found", *[f"b_{name}" for name in _bins(domains)])


def _bin(value: Column, bounds) -> Column:
    out = F.lit(len(bounds))
    for k in reversed(range(len(bounds))):
        out = F.when(value < bounds[k], F.lit(k)).otherwise(out)
    return out


def _known(labels: DataFrame, domains: list[str]) -> DataFrame:
    known = labels.where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains))
    return known.groupBy("doc_id").agg(F.max("domain").alias("domain"))


def learn_words(featured: DataFrame, labels: DataFrame, domains: list[str]) -> list[list[int]]:
    """Per domain the hashes of the words that mark it, from all labelled rows; at most ``WORDS`` a domain reach the
    driver."""
    known = _known(labels, domains)
    sizes = {r["domain"]: r["n"] for r in featured.select("doc_id").join(known, "doc_id").groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return [[] for _ in domains]
    total = float(sum(sizes.values()))
    # the labels grow with the corpus: small ones are joined as large ones are
    rows = featured.select("doc_id", "_hashes").join(known.hint("merge"), "doc_id").select("domain", F.explode("_hashes").alias("word"))
    counts = rows.groupBy("word").agg(
        *[F.count_if(F.col("domain") == d).cast("double").alias(f"n{k}") for k, d in enumerate(domains)],
        F.count(F.lit(1)).cast("double").alias("n"),
    )

    def term(seen, of, share):  # 0 where nothing was seen
        return F.when(seen > 0, seen * F.ln(seen * total / (of * share))).otherwise(0.0)

    marks = []
    for k, d in enumerate(domains):
        own, rest = float(sizes.get(d, 0)), total - sizes.get(d, 0)
        a, b = F.col(f"n{k}"), F.col("n") - F.col(f"n{k}")
        odds = F.ln((a + 0.5) / (own - a + 0.5)) - F.ln((b + 0.5) / (rest - b + 0.5))
        absent = total - F.col("n")
        g = 2.0 * (term(a, own, a + b) + term(b, rest, a + b) + term(own - a, own, absent) + term(rest - b, rest, absent))
        marks.append(F.when((a > 0) & (odds >= MIN_ODDS) & (g >= MIN_G), F.struct(F.lit(k).alias("k"), g.alias("g"))))
    strong = counts.select("word", F.explode(F.array_compact(F.array(*marks))).alias("x")).select("word", "x.k", "x.g")
    strong = stored(strong, "mix-words")
    best = [strong.where(F.col("k") == k).orderBy(F.desc("g"), "word").limit(WORDS) for k in range(len(domains))]
    return [[r["word"] for r in rows.select("word").collect()] for rows in best]


def log_likelihoods(featured: DataFrame, labels: DataFrame, domains: list[str]) -> tuple[dict, dict]:
    """Smoothed naive-Bayes tables, ``(feature, bin, domain) -> ln P`` and ``domain -> ln prior``, and the labelled rows
    of each domain, from ``featured(doc_id, cell)`` and all rows of ``labels(doc_id, domain)``. Domains without labelled
    rows are in no table. Only the counts (features x bins x domains) reach the driver."""
    rows = featured.select("doc_id", "cell").join(_known(labels, domains), "doc_id").groupBy("domain", "cell").agg(F.count(F.lit(1)).alias("n"))
    bins = [F.struct(F.lit(name).alias("f"), b.alias("b")) for name, b in _bins_of(F.col("cell"), domains).items()]
    counts = (
        rows.select("domain", "n", F.explode(F.array(*bins)).alias("x"))
        .groupBy("domain", "x.f", "x.b")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    n = {(r["f"], r["b"], r["domain"]): r["n"] for r in counts}
    sizes = {d: sum(v for (f, _, e), v in n.items() if e == d and f == "length") for d in domains}
    learned = [d for d in domains if sizes[d]]
    tables = {}
    for name, bounds in _bins(domains).items():
        for d in learned:
            for b in range(len(bounds) + 1):
                tables[name, b, d] = math.log((n.get((name, b, d), 0) + 1) / (sizes[d] + len(bounds) + 1))
    total = sum(sizes.values())
    return tables | {d: math.log(sizes[d] / total) for d in learned}, sizes


def posteriors(tables: dict, domains: list[str], bins: Mapping[str, Column]) -> Column:
    """Array of the posteriors of the domains, from the bins of a row; 0 for a domain without labelled rows (if no
    domain has any, 0 for all)."""
    learned = [d for d in domains if d in tables]
    scores = []
    for d in learned:
        score = F.lit(tables[d])
        for name, bounds in _bins(domains).items():
            score = score + F.get(F.array(*[F.lit(tables[name, b, d]) for b in range(len(bounds) + 1)]), bins[name])
        scores.append(score)
    if not scores:
        return F.array(*[F.lit(0.0) for _ in domains])
    raw = F.array(*scores)
    top = F.array_max(raw)
    weights = F.transform(raw, lambda s: F.exp(s - top))
    total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    return F.array(*[F.get(weights, F.lit(learned.index(d))) / total if d in tables else F.lit(0.0) for d in domains])


def rate_column(p: Column, history: list[list[float]], step: float) -> Column:
    """``struct(rate, ahead)`` after one projected step per entry of the history, from rate 1. An entry holds the
    residuals of the domains at ``ahead`` and, last, the momentum of the step."""
    begin = F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("ahead"))
    if not history:
        return begin
    k = len(history[0]) - 1

    def move(acc, entry):
        slope = F.aggregate(F.zip_with(p, F.slice(entry, 1, k), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        new = F.greatest(F.lit(0.0), acc["ahead"] - step * (slope + RIDGE * (acc["ahead"] - 1.0)))
        return F.struct(new.alias("rate"), (new + F.get(entry, F.lit(k)) * (new - acc["rate"])).alias("ahead"))

    entries = F.array(*[F.array(*[F.lit(float(x)) for x in entry]) for entry in history])
    return F.aggregate(entries, begin, move)


def _largest_eigenvalue(g: list[list[float]]) -> float:
    v = [1.0] * len(g)
    size = 1.0
    for _ in range(100):
        w = [sum(a * b for a, b in zip(row, v)) for row in g]
        size = max(map(abs, w)) or 1.0
        v = [x / size for x in w]
    return size


class Mix:
    """A fitted mix: ``rate(p)`` is the rate of a document with posteriors ``p``.

    ``targets`` are the domains' shares wanted, of all tokens of the input; ``totals`` those they have, ``achieved``
    those the rates give (with ``upsample=False``, rates count up to 1); ``shortfall`` what a domain lacks of its target.
    """

    def __init__(self, domains, targets, totals, achieved, history, step):
        self.domains, self.targets, self.totals, self.achieved = domains, targets, totals, achieved
        self.shortfall = [max(0.0, g - a) for g, a in zip(targets, achieved)]
        self._fit = history, step

    def rate(self, p: Column) -> Column:
        return rate_column(p, *self._fit)["rate"]


def fit_rates(
    cells: DataFrame, domains: list[str], weights: Mapping[str, float], upsample: bool = True, labelled: Mapping[str, int] | None = None
) -> Mix:
    """Rates for ``cells(tokens, p)`` whose expected token shares match ``weights``.

    ``labelled`` gives the labelled rows of each domain. One without any leaves the targets, and the rest is
    renormalised. The expected total is that of the input; with ``upsample=False`` it is the largest total for which no
    domain needs more tokens than it has, so that rates stay near or below 1. A domain of fewer than ``MIN_LABELS``
    labelled rows does not bound that total, as its tokens are not known well, and no domain takes it below
    ``LEAST_TOTAL``: what a scarce domain then lacks is its ``shortfall``, not a loss of the others.
    """
    k = len(domains)
    active = [labelled is None or labelled.get(d, 0) > 0 for d in domains]
    share = sum(weights[d] for d, on in zip(domains, active) if on)
    goal = [weights[d] / share if on and share > 0 else 0.0 for d, on in zip(domains, active)]
    sums = [F.sum(F.col("tokens") * F.get("p", F.lit(i))).alias(f"t{i}") for i in range(k)]
    cross = [
        F.sum(F.col("tokens") * F.get("p", F.lit(i)) * F.get("p", F.lit(j))).alias(f"g{i}_{j}") for i in range(k) for j in range(k)
    ]
    first = cells.agg(*sums, *cross).first()
    total = sum(first[f"t{i}"] or 0.0 for i in range(k))
    if not total:
        return Mix(domains, goal, [0.0] * k, [0.0] * k, [], 1.0)
    have = [first[f"t{i}"] / total for i in range(k)]
    if not upsample:
        bounding = [labelled is None or labelled.get(d, 0) >= MIN_LABELS for d in domains]
        fits = min([1.0, *(h / g for h, g, on in zip(have, goal, bounding) if on and g > 0)])
        goal = [g * max(fits, LEAST_TOTAL) for g in goal]
    scale = [1.0 / max(g, 1e-3) for g in goal]  # errors count relative to their targets
    g = [[first[f"g{i}_{j}"] / total * math.sqrt(scale[i] * scale[j]) for j in range(k)] for i in range(k)]
    step = 1.0 / (_largest_eigenvalue(g) * 1.05 + RIDGE)

    def sums_at(history):
        """Per domain the token share at ``ahead`` and at ``rate``, and the loss at ``rate``."""
        state = cells.select("tokens", "p", rate_column(F.col("p"), history, step).alias("s"))
        at = state.agg(
            *[F.sum(F.col("tokens") * F.get("p", F.lit(i)) * F.col("s.ahead")).alias(f"y{i}") for i in range(k)],
            *[F.sum(F.col("tokens") * F.get("p", F.lit(i)) * F.col("s.rate")).alias(f"r{i}") for i in range(k)],
            F.sum(F.col("tokens") * (F.col("s.rate") - 1.0) * (F.col("s.rate") - 1.0)).alias("spread"),
        ).first()
        ahead, rate = ([at[f"{c}{i}"] / total for i in range(k)] for c in "yr")
        loss = sum(w * (x - g) ** 2 for w, x, g in zip(scale, rate, goal)) + RIDGE * at["spread"] / total
        return ahead, rate, loss

    history: list[list[float]] = []
    ahead, rate, loss = sums_at(history)
    run = 0  # steps since the momentum was last reset
    for _ in range(ITERATIONS):
        residuals = [(x - g) * w for x, g, w in zip(ahead, goal, scale)]
        history.append([*residuals, run / (run + 3)])
        ahead, rate, new = sums_at(history)
        run = run + 1 if new <= loss else 0
        settled, loss = abs(new - loss) <= TOLERANCE * max(new, 1e-6), new
        if settled:
            break
    if not upsample:  # a document is used once at most
        used = cells.select("tokens", "p", F.least(F.lit(1.0), rate_column(F.col("p"), history, step)["rate"]).alias("r"))
        at = used.agg(*[F.sum(F.col("tokens") * F.get("p", F.lit(i)) * F.col("r")).alias(f"r{i}") for i in range(k)]).first()
        rate = [at[f"r{i}"] / total for i in range(k)]
    return Mix(domains, goal, have, rate, history, step)


def label_domains(labels: DataFrame, toxic: bool = True) -> DataFrame:
    """``doc_id, domain`` of a labelled table: ``toxic`` (if wanted), else by quality ``good`` or ``poor``; rows
    without the label in question have no domain."""
    domain = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    domain = F.when(F.col("toxic") == 1, "toxic").otherwise(domain) if toxic else domain
    return labels.select("doc_id", domain.alias("domain")).where(F.col("domain").isNotNull())


def fit_mix(featured: DataFrame, labels: DataFrame, weights: Mapping[str, float], upsample: bool = True) -> tuple[DataFrame, Mix]:
    """``cell, posteriors, rate`` of each combination of bins and the fitted :class:`Mix`, from
    ``featured(doc_id, n_tokens, cell)`` (a stored table: it is read twice) and ``labels(doc_id, domain)``."""
    domains = sorted(weights)
    tables, sizes = log_likelihoods(featured, labels, domains)
    p = posteriors(tables, domains, _bins_of(F.col("cell"), domains))
    cells = featured.groupBy("cell").agg(F.sum("n_tokens").alias("tokens"))
    cells = stored(cells.select("cell", "tokens", p.alias("p")), "mix-cells")
    fitted = fit_rates(cells, domains, weights, upsample, sizes)
    return stored(cells.select("cell", F.col("p").alias("posteriors"), fitted.rate(F.col("p")).alias("rate")), "mix-rates"), fitted


def apply_mix(featured: DataFrame, rates: DataFrame, domains: list[str], seed: int = 0) -> DataFrame:
    """``featured(doc_id, _text_key, cell, ..)`` with ``posteriors, rate, copies`` in place of ``cell`` and ``_text_key``.

    The rates, one row per combination of bins, are broadcast where their number has a bound (``MAX_CELLS``).
    """
    cells = math.prod(len(bounds) + 1 for bounds in _bins(domains).values())
    rates = rates.withColumnRenamed("cell", "_cell")
    out = featured.join(F.broadcast(rates) if cells <= MAX_CELLS else rates, F.col("cell") == F.col("_cell"))
    # rows without an id are told apart by their texts and, as no key of theirs is stable, by their places
    place = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("_text_key"), place), F.lit(1 << 30)) / F.lit(float(1 << 30))
    whole = F.floor("rate")
    copies = (whole + F.when(draw < F.col("rate") - whole, 1).otherwise(0)).cast("int")
    return out.withColumn("copies", copies).drop("cell", "_cell", "_text_key")


def _binned(docs: DataFrame, labels: DataFrame, weights: Mapping[str, float]) -> tuple[DataFrame, list[list[int]]]:
    """``doc_id, _text_key, n_tokens, cell``, stored, and the words that were learned for each domain."""
    rows = docs.select("doc_id", "text", _text_key())
    featured = stored(features(rows).drop("text"), "mix-features")
    words = learn_words(featured, labels, sorted(weights))
    return stored(with_word_bins(featured, words), "mix-bins"), words


def _text_key() -> Column:
    return F.xxhash64("text").alias("_text_key")


def mix_rates(
    docs: DataFrame, labels: DataFrame, weights: Mapping[str, float], upsample: bool = True, seed: int = 0
) -> tuple[DataFrame, Mix]:
    """``doc_id, n_tokens, posteriors, rate, copies`` per row of ``docs(doc_id, text)``, and the fitted :class:`Mix`.

    ``labels(doc_id, domain)`` trains the classifier; ``weights`` are the target shares of the domains in tokens.
    ``copies`` rounds the rate by a fixed hash of the id and the text (its expectation is the rate), so rows that repeat
    an id with another text are drawn apart, and a repeated row of the same id and text is one record; rows with a null
    id are each drawn on their own. A domain without labelled rows has posterior 0 and leaves the targets (see
    :func:`fit_rates`); if none has any, every rate is 1. Null and empty texts have no tokens and the posteriors of an
    empty text; very long texts are read whole, their words once; of equally strong words the smaller hash is learned;
    other columns are ignored; with no rows or no tokens every rate is 1. The texts are read once.
    """
    featured, _ = _binned(docs, labels, weights)
    rates, fitted = fit_mix(featured, labels, weights, upsample)
    return apply_mix(featured, rates, fitted.domains, seed), fitted


def mix(
    docs: DataFrame, labels: DataFrame, weights: Mapping[str, float], upsample: bool = True, seed: int = 0
) -> tuple[DataFrame, Mix]:
    """As :func:`mix_rates`, but with all columns of ``docs`` (texts are read twice and never shuffled; columns named
    like the results are replaced)."""
    featured, words = _binned(docs, labels, weights)
    rates, fitted = fit_mix(featured, labels, weights, upsample)
    rows = with_word_bins(features(aside(docs).select("*", _text_key())), words)
    return back(apply_mix(rates=rates, featured=rows, domains=fitted.domains, seed=seed), docs, "n_tokens", "posteriors", "rate", "copies"), fitted
