"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.llm import (
    conversations,
    decontam,
    exact_dedup,
    langid,
    licenses,
    line_dedup,
    mixing,
    near_dedup,
    quality,
    sharding,
    tokens,
    toxicity,
    whitening,
)
from lakeworks.suite import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: the tokenizer of the token-count query, by its name in the public tokenizers' folder
TOKENIZER = "word_bpe_49k.json"
#: shards of the sharding query, all of one weight
SHARD_WEIGHTS = (1.0,) * 8


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


@query(
    "op2_exact_dedup",
    """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), limit=2048)


@query("op9_rendezvous_sharding")
def op9_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), SHARD_WEIGHTS)


@query("op6_near_dedup")
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), share=85)


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query(
    "op3_decontamination",
    f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, m, array_to_string(w[s:s + m - 1], ' ') AS k FROM (
  SELECT item_id, w, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, s, m, array_to_string(w[s:s + m - 1], ' ') AS k FROM (
  SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM d, (SELECT DISTINCT m FROM bw) WHERE len(w) >= m)),
h AS (SELECT doc_id, s, m, item_id FROM dw JOIN bw USING (m, k)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM h) GROUP BY 1),
i AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
  array_to_string(list_sort(list_distinct(list(item_id::VARCHAR))), ',') AS ids FROM h GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), FALSE) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)""",
)
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity_scores(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), threshold=0.3
    )
    return scored.select("doc_id", "held_out", "score", "predicted")


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_ids(table(spark, sf_dir, "documents"))


@query("op7_license_scan")
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


@query(
    "op8_line_dedup",
    r"""WITH raw AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents),
k AS (SELECT doc_id, place, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line FROM raw),
l AS (SELECT doc_id, place, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
  row_number() OVER (PARTITION BY doc_id ORDER BY place) AS n FROM k WHERE line <> ''),
w AS (SELECT doc_id, n, line AS a, lead(line, 1) OVER o AS b, lead(line, 2) OVER o AS c, words AS wa, lead(words, 1) OVER o AS wb
  FROM l WINDOW o AS (PARTITION BY doc_id ORDER BY n)),
r AS (SELECT doc_id, n, 3 AS size, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, n) > 1 AS again FROM w WHERE c IS NOT NULL
  UNION ALL
  SELECT doc_id, n, 2, row_number() OVER (PARTITION BY a, b ORDER BY doc_id, n) > 1 FROM w WHERE b IS NOT NULL AND wa + wb >= 50
  UNION ALL
  SELECT doc_id, n, 1, row_number() OVER (PARTITION BY a ORDER BY doc_id, n) > 1 FROM w WHERE wa >= 50),
gone AS (SELECT DISTINCT doc_id, n + k AS n FROM r, (VALUES (0), (1), (2)) AS s(k) WHERE again AND k < size),
t AS (SELECT raw.doc_id, raw.place, raw.line, l.n, gone.n IS NOT NULL AS deleted,
        gone.n IS NOT NULL AND before.n IS NULL AS begins
  FROM raw LEFT JOIN l USING (doc_id, place) LEFT JOIN gone ON gone.doc_id = raw.doc_id AND gone.n = l.n
  LEFT JOIN gone before ON before.doc_id = raw.doc_id AND before.n = l.n - 1)
SELECT doc_id, count(n)::INT AS n_lines, (count(*) FILTER (WHERE deleted))::INT AS n_deleted,
  (count(*) FILTER (WHERE begins))::INT AS n_runs,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT deleted), '')) AS text_sha256
FROM t GROUP BY doc_id""",
)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.line_dedup(table(spark, sf_dir, "documents"), run=3, short_words=50)
    return cleaned.select(
        "doc_id", "n_lines", "n_deleted", "n_runs", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    )


#: target shares of the domains, in tokens
MIX_WEIGHTS = {"good": 0.85, "poor": 0.1, "toxic": 0.05}


@query("op10_mixing")
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = mixing.label_domains(table(spark, sf_dir, "labels"))
    mixed, _ = mixing.mix_rates(table(spark, sf_dir, "documents"), labels, MIX_WEIGHTS)
    return mixed


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32)


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.summaries(messages, present=F.col("present"))


@query("op13_quality_rules")
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))
