"""The registered queries: thin digests of the operators' outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifetide.llm import (
    bpe,
    compression_classifier,
    decision_list,
    hard_negatives,
    host_reputation,
    packing,
    pitman_yor,
    secret_scan,
    simhash,
    spotsigs,
    substring_dedup,
    token_counts,
    whitening,
)
from lifetide.llm.common import crc_bucket, stored, table


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited_by_next(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        spotsigs.fingerprint("sigs").alias("fingerprint"),
        spotsigs.fingerprint("edited_sigs").alias("edited_fingerprint"),
        spotsigs.likeness("sigs", "edited_sigs").alias("near_edited"),
        spotsigs.likeness("sigs", "next_sigs").alias("near_next"),
    )


#: Fixed value: where a page's path names the document that it shows.
PAGE_DOCUMENT = "^/[a-z]+/([0-9]+)"


def op2_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("good"))
    shown = pages.select(*host_reputation.parts("url"))
    shown = shown.select("host", F.expr(f"try_cast(regexp_extract(path, '{PAGE_DOCUMENT}', 1) AS bigint)").alias("doc_id"))
    outcomes = shown.join(labels, "doc_id").select("host", "good")
    return host_reputation.judge(pages, outcomes).select("page_id", "host", "path", "rule", "verdict")


def op3_aho_corasick_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    listed = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    base = "filter(spans, s -> s.kind IN ('assign', 'access', 'hex'))"
    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) AS long)").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(F.expr(listed.format(base)).cast("binary"), 256).alias("base_sha256"),
        F.expr(listed.format("spans")).alias("spans"),
    )


#: Fixed value: scores from here on predict label 1.
KEEP_SCORE = 0.3


def quality_model(docs: DataFrame, labels: DataFrame) -> compression_classifier.Model:
    """Learned from the labels whose id is not held out (crc32 modulo 5 is 0)."""
    return compression_classifier.train(docs, labels.where(crc_bucket("doc_id", 5) != 0))


def op4_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return compression_classifier.score(docs, model).select(
        "doc_id",
        F.coalesce(crc_bucket("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= KEEP_SCORE, 1).otherwise(0).alias("predicted"),
    )


def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = pitman_yor.train(docs.where(crc_bucket("doc_id", 10) != 0))
    return pitman_yor.score(docs, model).select(
        "doc_id",
        F.coalesce(crc_bucket("doc_id", 10) == 0, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.settings.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op6_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.passages(table(spark, sf_dir, "documents")).drop("text_hash")


def op7_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = byte_bpe_path()
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path)
    return bpe.round_trip(encoded, path).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op8_minimum_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), byte_bpe_path()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op9_simhash_gray_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op10_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = stored(decision_list.measure(table(spark, sf_dir, "documents")), "measured")
    labels = table(spark, sf_dir, "labels").where(crc_bucket("doc_id", 5) != 0)
    rules = decision_list.learn(measured, labels)
    base_failed = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        decision_list.verdict(rules).alias("rejected_by"),
    ).withColumn("kept", F.expr("NOT base_failed AND rejected_by IS NULL"))


def op11_secondary_sort_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", label), anchors="vec_id % 50 = 0")


def op12_jacobi_davidson_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


#: Fixed value: documents of more tokens are over the limit.
TOKEN_LIMIT = 2048


def op13_heap_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count(table(spark, sf_dir, "documents"), word_bpe_path())
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_spotsigs": op1_spotsigs,
    "op2_host_reputation": op2_host_reputation,
    "op3_aho_corasick_secrets": op3_aho_corasick_secrets,
    "op4_compression_classifier": op4_compression_classifier,
    "op5_pitman_yor": op5_pitman_yor,
    "op6_compact_windows": op6_compact_windows,
    "op7_forced_boundary_bpe": op7_forced_boundary_bpe,
    "op8_minimum_bin_slack": op8_minimum_bin_slack,
    "op9_simhash_gray_index": op9_simhash_gray_index,
    "op10_decision_list": op10_decision_list,
    "op11_secondary_sort_negatives": op11_secondary_sort_negatives,
    "op12_jacobi_davidson_whitening": op12_jacobi_davidson_whitening,
    "op13_heap_token_counts": op13_heap_token_counts,
}

ORACLE_SQL: dict[str, str] = {
    "op11_secondary_sort_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda e: floor(256 * e::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
placed AS (
  SELECT p.anchor_id, p.positive_id, n.id AS negative_id, p.positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id) AS place
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM placed WHERE place <= 3
""",
    "op2_host_reputation": """
WITH split AS (
  SELECT page_id, row_number() OVER () AS line,
         CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages),
addressed AS (
  SELECT page_id, line,
         translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM split),
bared AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare FROM addressed),
labelled AS (
  SELECT *, string_split(bare, '.') AS labels, regexp_full_match(bare, '[0-9]+([.][0-9]+){3}') OR starts_with(bare, '[') AS numeric_host,
         array_to_string(list_slice(string_split(bare, '.'), -2, -1), '.') AS two
  FROM bared),
listed AS (SELECT unnest(string_split('""" + " ".join(host_reputation.SUFFIXES) + """', ' ')) AS two_labels),
placed AS (
  SELECT page_id, line, host, path,
         CASE WHEN numeric_host THEN bare
              WHEN two IN (SELECT two_labels FROM listed) THEN array_to_string(list_slice(labels, greatest(-3, -len(labels)), -1), '.')
              ELSE two END AS dom,
         CASE WHEN numeric_host THEN '(address)' WHEN two IN (SELECT two_labels FROM listed) THEN two ELSE labels[-1] END AS suf
  FROM labelled),
outcomes AS (
  SELECT p.host, p.dom, p.suf, l.quality AS good
  FROM placed p JOIN labels l ON l.doc_id = try_cast(regexp_extract(p.path, '^/[a-z]+/([0-9]+)', 1) AS BIGINT)
  WHERE l.quality IN (0, 1)),
overall AS (SELECT coalesce(avg(good), 0.5) AS share FROM outcomes),
counted AS (
  SELECT 1 AS lev, suf AS name, count(*) AS n, sum(good) AS k FROM outcomes GROUP BY suf
  UNION ALL SELECT 2, dom, count(*), sum(good) FROM outcomes GROUP BY dom
  UNION ALL SELECT 3, host, count(*), sum(good) FROM outcomes GROUP BY host),
moments AS (
  SELECT lev, count(*) AS g, sum(n) AS n, sum(n * n) AS sq, sum(n * (k / n - share) ** 2) AS spread, any_value(share) AS share
  FROM counted, overall GROUP BY lev),
dispersion AS (
  SELECT lev, CASE WHEN g < 2 OR share * (1 - share) = 0 OR n <= g THEN NULL
    ELSE (spread - share * (1 - share) * (g - 1)) / (share * (1 - share) * (n - sq / n - (g - 1))) END AS rho
  FROM moments),
strengths AS (SELECT lev, CASE WHEN rho > 0 THEN least(1000.0, greatest(1.0, 1 / rho - 1)) ELSE 1000.0 END AS s FROM dispersion),
one AS (
  SELECT coalesce((SELECT s FROM strengths WHERE lev = 1), 1000.0) AS s1, coalesce((SELECT s FROM strengths WHERE lev = 2), 1000.0) AS s2,
         coalesce((SELECT s FROM strengths WHERE lev = 3), 1000.0) AS s3, (SELECT share FROM overall) AS share),
rated AS (
  SELECT p.page_id, p.line, p.host, p.path,
         coalesce(h.n, 0) AS n3, coalesce(h.k, 0) AS k3, s3,
         (coalesce(d.k, 0) + s2 * (coalesce(x.k, 0) + s1 * share) / (coalesce(x.n, 0) + s1)) / (coalesce(d.n, 0) + s2) AS m2
  FROM placed p CROSS JOIN one
  LEFT JOIN counted h ON h.lev = 3 AND h.name = p.host
  LEFT JOIN counted d ON d.lev = 2 AND d.name = p.dom
  LEFT JOIN counted x ON x.lev = 1 AND x.name = p.suf),
posterior AS (SELECT *, k3 + s3 * m2 AS a, n3 - k3 + s3 * (1 - m2) AS b FROM rated),
rules(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fitting AS (
  SELECT p.*, r.verdict AS said, r.host || r.path AS rule,
         row_number() OVER (PARTITION BY p.line ORDER BY length(r.host || r.path) DESC NULLS LAST) AS place
  FROM posterior p LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule,
       coalesce(said, CASE WHEN a / (a + b) + 1.645 * sqrt(a * b / ((a + b) ** 2 * (a + b + 1))) < 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM fitting WHERE place = 1
""",
}
