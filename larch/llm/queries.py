"""Registered queries of this subpackage: each applies one operator to its
whole table and derives the contract's columns from the operator's output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larch.llm import (
    decontaminate, lm, mixing, negatives, pieces, pii, runs, secrets, shards, simhash, toxicity,
    vectors, warc)
from larch.llm.common import scratch_dir, table, text_or_empty, written
from larch.llm.spans import rendered


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(F.col(spans), lambda s: s["kind"] == kind)).cast("long")


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    return lm.score_texts(docs, ~held).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op3_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    model = mixing.learn(docs, table(spark, sf_dir, "labels"), mixing.label_domain())
    told = written(mixing.with_posteriors(docs, model).drop("text"), "posteriors")
    fit = mixing.fit_rates(told, model.domains, mixing.DOMAIN_TARGETS)
    place = {d: i for i, d in enumerate(model.domains)}
    return told.withColumn("rate", fit.rate()).select(
        "doc_id", "source", "n_tokens",
        *[(F.get("posterior", F.lit(place[d])) if d in place else F.lit(0.0)).alias(f"p_{d}")
          for d in mixing.DOMAIN_TARGETS],
        "rate", mixing.copies(F.col("rate")).alias("copies"))


def op4_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shards.shard_documents(docs, 8, columns=["doc_id"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.with_scores(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score").select(
        "*", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vectors.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select("*", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = secrets.train(secrets.labelled_samples(docs))
    found = secrets.find_secrets(docs, model).select("doc_id", "base", "secrets")
    return found.select(
        "doc_id", *[_count("base", k).alias(f"n_{k}") for k in secrets.BASE_KINDS],
        F.sha2(rendered(F.col("base")), 256).alias("base_sha256"),
        rendered(F.col("secrets")).alias("spans"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.page_records(spark, path)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs).select("doc_id", "pii")
    base = F.filter(F.col("pii"), lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select(
        "doc_id", *[_count("pii", k).alias(f"n_{k}") for k in pii.BASE_KINDS],
        F.sha2(rendered(base), 256).alias("base_sha256"),
        rendered(F.col("pii")).alias("spans"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
        .otherwise(F.col("label")).alias("label"))
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


def _with_repeats(docs: DataFrame) -> DataFrame:
    """The contract's texts: in a tenth of the documents, chosen by their ids' checksum,
    the words from a place on repeat with a period; other texts stay."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(text_or_empty(), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n, g = F.size("_words"), F.floor(h / 10)
    numbered = (docs.withColumn("_words", F.when(h % 10 == 0, words))
                .withColumn("_from", F.when(n > 0, g % n).cast("int"))
                .withColumn("_period", (1 + F.floor((n - F.col("_from")) / (3 + g % 8))).cast("int")))
    place = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.get("_words", F.when(i < F.col("_from"), i).otherwise(
            F.col("_from") + (i - F.col("_from")) % F.col("_period"))))
    text = F.when(n > 0, F.array_join(place, " ")).otherwise(F.col("text"))
    return numbered.withColumn("text", text).drop("_words", "_from", "_period")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _with_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = runs.with_runs(docs)
    # Runs come by start and period; a later one must be more of its period to win.
    best = F.reduce(
        "runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
        lambda top, run: F.when(
            top.isNull() | (run["length"] * top["period"] > top["length"] * run["period"]), run
        ).otherwise(top))
    lines = F.transform("runs", lambda run: F.concat(
        run["start"].cast("string"), F.lit(","), run["length"].cast("string"), F.lit(","),
        run["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))


#: The file of the tokenizer's pieces; None for the installed public vocabulary.
PIECE_MODEL: str | None = None


def _piece_model() -> str:
    if PIECE_MODEL:
        return PIECE_MODEL
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    codec = pieces.read_codec(_piece_model())
    told = pieces.with_decoded(pieces.with_ids(docs, codec), codec)
    return told.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


QUERIES = {
    "op1_lm_score": op1_lm_score,
    "op2_decontamination": op2_decontamination,
    "op3_soft_mixing": op3_soft_mixing,
    "op4_label_propagation": op4_label_propagation,
    "op5_toxicity": op5_toxicity,
    "op6_subspace_join": op6_subspace_join,
    "op7_secret_scan": op7_secret_scan,
    "op8_simhash": op8_simhash,
    "op9_warc": op9_warc,
    "op10_pii": op10_pii,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_sentencepiece": op13_sentencepiece,
}

#: The words of a text for benchmark windows, and base32 digits, in DuckDB.
_SQL_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
_SQL_BASE32 = """array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
  (('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)
  FOR i IN range(32)], '')"""

#: DuckDB SQL where it can state the result.
ORACLE: dict[str, str] = {
    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id AS other_id, a.label = v.label AS alike,
         CAST(list_inner_product(a.c, v.c) AS BIGINT) AS score
  FROM v AS a, v WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score
  FROM s WHERE alike AND other_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
                               ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.alike
 AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
""",
    "op2_decontamination": f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_SQL_WORDS} AS w FROM benchmark),
g AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM (
  SELECT item, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
  FROM b WHERE len(w) > 0)),
n AS (SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM (
  SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i
  FROM d, (SELECT DISTINCT k FROM g) WHERE len(w) >= k)),
h AS (SELECT r, i, k, item FROM n JOIN g USING (k, s)),
p AS (SELECT r, count(DISTINCT place) AS n_hit FROM (
  SELECT r, unnest(range(i, i + k)) AS place FROM (SELECT DISTINCT r, i, k FROM h)) GROUP BY r),
m AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN m USING (r)
""",
    "op6_subspace_join": """
WITH RECURSIVE v AS (
  SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a, v AS b
  WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id, vec_id AS m FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.m = l.a)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id) AS n_links, c.component_id,
       e.vec_id = c.component_id AS kept
FROM embeddings AS e JOIN (SELECT vec_id, min(m) AS component_id FROM r GROUP BY vec_id) AS c USING (vec_id)
""",
    "op9_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h,
  max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last_id FROM pages)
SELECT page_id, CAST(octet_length(encode(t)) AS BIGINT) AS payload_bytes, {_SQL_BASE32} AS payload_digest,
       CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last_id THEN last_id END AS refers_to
FROM p
""",
}
