"""Registered queries of the operators of this package, each next to the SQL it is checked against where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from isochron.llm import (
    bitplanes, hard_negatives, language, lexical_search, near_dups, packing, pseudo_likelihood, quality, sharding, sketches, toxicity, urls,
    word_shuffle,
)
from isochron.session import apply_settings, fresh_path, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Rows of texts in an Arrow batch: bounds the memory of Python workers where texts are long.
BATCH_ROWS = "1000"


def prepared(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Put the settings of this package on the session first."""
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_settings(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return build(spark, sf_dir)

    return run


def query(sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = prepared(build)
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return register


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("doc_id", "text")))


@query()
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on a bounded-load ring of 24 shards; counts at most one apart."""
    text = F.coalesce("text", F.lit(""))
    sized = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    placed = sharding.shard_rows(sized, 24, ["doc_id"], ["text_crc32", "size"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query()
def op2_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded, written as byte planes in ascending doc_id order, and read back from the files."""
    target = fresh_path(spark, "token-planes")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bitplanes.write(documents(spark, sf_dir), target, public_tokenizers.path("word_bpe_49k.json"), 2, False, parts)
    return bitplanes.read(spark, target).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query()
def op3_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a window network trained on all documents."""
    return pseudo_likelihood.pseudo_likelihood(documents(spark, sf_dir))


@query()
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    pieces = packing.token_pieces(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), 2, 1024)
    kept = stored(pieces, "token-pieces", compression="zstd")
    digests = kept.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digests, 1024)


@query()
def op5_word_shuffle_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded through its distinct pre-tokens, and decoded again."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = word_shuffle.encode(documents(spark, sf_dir), path, public_tokenizers.PATTERN, buckets)
    return word_shuffle.decode(ids, path).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


SQL_QUALITY_COUNTS = r"""
SELECT doc_id, t, w, len(w) AS n_words, CASE WHEN len(w) >= {judged} THEN len(w) ELSE 0 END AS n_judged, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, length(regexp_replace(t, '[^!]', '', 'g')) AS n_marks,
  length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
  len(list_filter(w, lambda x: list_contains({stops}, lower(regexp_replace(x, '[.,;:!?]+$', ''))))) AS n_stop_words
FROM (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
)"""

SQL_QUALITY = r"""
WITH counted AS ({counts}),
grams AS (
  SELECT doc_id, i, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, n_words - 3)) AS i FROM counted WHERE n_words >= 5)
),
starts AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
cover AS (
  SELECT doc_id, sum(least(5, coalesce(after - i, 5)))::BIGINT AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM starts) GROUP BY doc_id
),
judged AS (
  SELECT c.*, coalesce(n_repeat_words, 0) AS n_repeat_words FROM counted c LEFT JOIN cover USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words){rules} AS kept
FROM judged"""


def quality_rules_sql() -> str:
    """The threshold table as SQL conditions."""
    conditions = []
    for rule in quality.RULES:
        value = rule.value
        if value.startswith("try_divide("):
            above, below = value[len("try_divide("):-1].split(", ")
            value = f"{above}::DOUBLE / nullif({below}, 0)"
        if rule.low is not None:
            conditions.append(f"coalesce({value} >= {rule.low}, TRUE)")
        if rule.high is not None:
            conditions.append(f"coalesce({value} <= {rule.high}, TRUE)")
    return "".join(f" AND {c}" for c in conditions)


def quality_counts_sql() -> str:
    return SQL_QUALITY_COUNTS.replace("{stops}", repr(quality.STOP_WORDS.split())).replace("{judged}", str(quality.JUDGED_FROM))


@query(SQL_QUALITY.replace("{counts}", quality_counts_sql()).replace("{rules}", quality_rules_sql()))
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its counts, the base verdict and the verdict of the threshold table."""
    return quality.judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


SQL_URLS = r"""
WITH parts AS (
  SELECT page_id, coalesce(lower(url), '') AS low,
    translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
ruled AS (
  SELECT *, CASE {rules} END AS rule,
    len(list_filter({strict}, lambda t: regexp_matches(low, '(^|[^a-z])' || t || '($|[^a-z])'))) AS strict_terms,
    len(list_filter({soft}, lambda t: regexp_matches(low, '(^|[^a-z])' || t || '($|[^a-z])'))) AS soft_terms
  FROM parts
)
SELECT page_id, host, path, rule,
  CASE {verdicts} WHEN strict_terms >= 1 OR soft_terms >= {limit} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""


def urls_sql() -> str:
    longest = sorted(urls.SITE_RULES, key=lambda r: -len(r.name))
    rules = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.name}'" for r in longest
    )
    verdicts = " ".join(f"WHEN rule = '{r.name}' THEN '{r.verdict}'" for r in longest)
    return SQL_URLS.replace("{rules}", rules).replace("{verdicts}", verdicts).replace("{limit}", str(urls.SOFT_LIMIT)).replace(
        "{strict}", repr(list(urls.STRICT_TERMS))).replace("{soft}", repr(list(urls.SOFT_TERMS)))


@query(urls_sql())
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by site rules, else by the weighted vocabulary."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return urls.judge(pages).select("page_id", "host", "path", "rule", "verdict")


@query()
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k sketches of every text and its edited text, and how alike they are."""
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = sketches.fingerprints(documents(spark, sf_dir), parts=parts)
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        sketches.as_text(F.col("sketch")).alias("fingerprint"), sketches.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited", "near_next", "n_distinct", "kept_share",
    )


@query()
def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles are alike at 0.8."""
    return near_dups.near_duplicates(documents(spark, sf_dir), width=4).select("doc_id", "n_shingles", "component_id", "kept")


@query()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the clause grammar, learnt on two thirds of the labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    texts = documents(spark, sf_dir)
    scored = toxicity.score(texts, toxicity.train(texts, labels))
    return scored.select(
        "doc_id", F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query()
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language by its shortest code, the trees learnt on three quarters of the rows."""
    rows = documents(spark, sf_dir, "doc_id", "text", "lang")
    found = language.predict(rows, language.train(rows))
    held = F.coalesce(language.held_out(F.col("doc_id")), F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "bits")


SQL_LEXICAL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{term}')) AS term
  FROM documents
),
held AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM held GROUP BY 1),
corpus AS (SELECT count(*) AS documents, sum(n)::BIGINT AS terms FROM sizes),
weights AS (
  SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY 1), corpus
),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{term}')) AS term
  FROM benchmark
),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // terms))))::BIGINT AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), corpus GROUP BY ALL
),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10"""


@query(SQL_LEXICAL.replace("{term}", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item, by two trees."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return lexical_search.search(documents(spark, sf_dir), items)


SQL_HARD_NEGATIVES = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
pairs AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM pairs JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5"""


@query(SQL_HARD_NEGATIVES)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector among all vectors."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    return hard_negatives.mine(rows)
