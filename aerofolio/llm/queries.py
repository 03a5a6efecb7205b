"""The registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.files import table
from . import decontaminate, filter_audit, html_text, language_models, licences, merkle, mixing, neighbours, quality, simhash, substrings, token_counts, warc


def embedding_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    found = neighbours.near_duplicates(table(spark, d, "embeddings"), threshold=0.95)
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept", "recall")


def html_extraction(spark: SparkSession, d: str) -> DataFrame:
    return html_text.extract(table(spark, d, "pages")).select("page_id", "url", "text", "n_chars")


def simhash_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, d, "documents"), shingle=3, distance=2)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def decontamination(spark: SparkSession, d: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"), size=13, one_in=20)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def lm_scoring(spark: SparkSession, d: str) -> DataFrame:
    """Documents against the model of those labelled good."""
    good = table(spark, d, "labels").where("quality = 1").select("doc_id")
    found = language_models.cross_entropy_difference(table(spark, d, "documents"), good)
    return found.select(F.col("id").alias("doc_id"), "n_words", "score")


def substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, d, "documents").select("doc_id", "text"), size=13).select("doc_id", "n_words", "n_removed", "kept_sha256")


def warc_archives(spark: SparkSession, d: str) -> DataFrame:
    found = warc.archived(table(spark, d, "pages"), min_bytes=0)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem")


def mixing_sources(spark: SparkSession, d: str) -> DataFrame:
    found = mixing.rated(table(spark, d, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def licence_scan(spark: SparkSession, d: str) -> DataFrame:
    found = licences.scan(table(spark, d, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return quality.scored(docs, quality.train(docs, table(spark, d, "labels"))).select("doc_id", "held_out", "score", "predicted")


def filter_interactions(spark: SparkSession, d: str) -> DataFrame:
    return filter_audit.audit(table(spark, d, "documents").select("doc_id", "text", "source"), table(spark, d, "labels"))


def token_counting(spark: SparkSession, d: str) -> DataFrame:
    return token_counts.counted(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    found = merkle.manifest(table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars", "text"))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


MIXING_SQL = r"""
WITH sized AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nr FROM sized GROUP BY source),
lim AS (SELECT source, source_size, CASE nr % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, 2.0::DOUBLE * source_size AS lim FROM per),
run AS (SELECT *, sum(source_size) OVER () AS whole, coalesce(sum(lim) OVER w, 0) AS stopped, coalesce(sum(weight) OVER w, 0) AS past, sum(weight) OVER () AS weights
  FROM lim WINDOW w AS (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lev AS (SELECT *, (whole * 1.5::DOUBLE - stopped) / (weights - past) AS level FROM run),
common AS (SELECT arg_min(level, past) AS level FROM lev WHERE lim > weight * level),
tgt AS (SELECT source, source_size, least(lim, weight * coalesce((SELECT level FROM common), lim / weight)) AS target FROM lev),
rate AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS r,
  CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
  FROM sized JOIN tgt ON sized.source IS NOT DISTINCT FROM tgt.source)
SELECT doc_id, size, source_size, target, size * (CAST(floor(r) AS BIGINT) + CASE WHEN u < r - floor(r) THEN 1 ELSE 0 END) AS taken FROM rate
"""

SUBSTRING_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM win) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM hit, range(13) t(k)),
word AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT doc_id, count(gone.p) AS n_removed, string_agg(x, ' ' ORDER BY p) FILTER (gone.p IS NULL) AS rest FROM word LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)
"""

CONTAMINATION_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
b AS (SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM benchmark),
pat AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS g FROM (SELECT item_id, ws, least(13, len(ws)) AS n, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
win AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM pat))),
hit AS (SELECT doc_id, item_id, n, i FROM win JOIN pat USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT doc_id, n, i FROM hit), range(13) t(k) WHERE k < n GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

AUDIT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
lab AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  CASE WHEN len(ws) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 2 ELSE 0 END
  + CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * len(t) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS mask
  FROM w LEFT JOIN lab USING (doc_id)),
s AS (SELECT part, CAST(k AS INTEGER) AS k, count(*) FILTER ((mask & k) = 0) AS n, count(*) FILTER ((mask & k) = 0 AND good = 1) AS g, count(*) FILTER ((mask & k) = 0 AND toxic = 1) AS x
  FROM m, range(32) r(k) GROUP BY part, k),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(l, b)),
p AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits FROM f a, f b, f c, f d, f e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND (a.b | b.b | c.b | d.b | e.b) = 31),
turn AS (SELECT filter_order, CAST(i AS INTEGER) AS step, CAST(bits[i] AS INTEGER) AS b, CAST(coalesce(list_sum(bits[:i - 1]), 0) AS INTEGER) AS before FROM p, range(1, 6) r(i)),
o AS (SELECT s.part, turn.filter_order, turn.step, turn.b, y.n AS kept, s.n - y.n AS removed, z.n - o.n AS fails, u.n - v.n AS unique_fails, s.g - y.g AS good_lost, s.x - y.x AS toxic_lost
  FROM turn JOIN s ON s.k = turn.before JOIN s y ON y.part = s.part AND y.k = turn.before + turn.b JOIN s z ON z.part = s.part AND z.k = 0 JOIN s o ON o.part = s.part AND o.k = turn.b
  JOIN s u ON u.part = s.part AND u.k = 31 - turn.b JOIN s v ON v.part = s.part AND v.k = 31)
SELECT part, filter_order, step, kept, removed, fails - removed AS redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, b) AS BIGINT) AS shapley FROM o
"""


def merkle_sql(levels: int = 10) -> str:
    """Level by level, as far as ``8 ** levels`` leaves of a key: each node with the brothers to its left and right."""

    def tree(name: str, leaves: str) -> list[str]:
        parts = [f"{name}0 AS ({leaves})"]
        for k in range(levels):
            parts.append(f"""{name}s{k} AS (SELECT key, idx, digest, count(*) OVER (PARTITION BY key) AS n,
              coalesce(string_agg(digest, '') OVER (PARTITION BY key, idx // 8 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
              coalesce(string_agg(digest, '') OVER (PARTITION BY key, idx // 8 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})""")
            parts.append(f"""{name}{k + 1} AS (SELECT key, idx // 8 AS idx, CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY idx)) END AS digest FROM {name}s{k} GROUP BY key, idx // 8)""")
        return parts

    def up(name: str, before: str, place: str, key: str) -> list[str]:
        parts, last = [], before
        for k in range(levels):
            parts.append(f"""{name}p{k} AS (SELECT a.* EXCLUDE (proof, folded), a.proof || CASE WHEN t.n > 1 THEN t.l || t.r ELSE '' END AS proof,
              CASE WHEN t.n > 1 THEN sha256(t.l || a.folded || t.r) ELSE a.folded END AS folded FROM {last} a JOIN {name}s{k} t ON t.key = a.{key} AND t.idx = a.{place} // {8 ** k})""")
            last = f"{name}p{k}"
        return parts

    def field(column: str) -> str:
        return f"coalesce(octet_length(encode(CAST({column} AS VARCHAR))) || ':' || CAST({column} AS VARCHAR), '-')"

    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bit = "list_reduce([xor(c, ascii(b))] || [1::BIGINT, 2, 3, 4, 5, 6, 7, 8], lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1)))"
    crc = f"xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda b: ascii(b)::BIGINT), lambda c, b: {bit.replace('ascii(b)', 'b')}), 4294967295::BIGINT)"
    parts = [
        f"lf AS (SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS key, sha256({head} || {field('text')}) AS leaf, CASE WHEN {crc} % 3 = 0 THEN sha256({head} || {field(low)}) END AS changed FROM documents)",
        "pos AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, coalesce(changed, leaf) AS folded, '' AS proof FROM lf)",
        *tree("a", "SELECT key, place AS idx, leaf AS digest FROM pos"),
        f"sub AS (SELECT '' AS one, key, digest, row_number() OVER (ORDER BY key) - 1 AS rank FROM a{levels})",
        *tree("b", "SELECT one AS key, rank AS idx, digest FROM sub"),
        *up("a", "pos", "place", "key"),
        f"mid AS (SELECT a.*, sub.digest AS subroot, sub.rank, '' AS one FROM ap{levels - 1} a JOIN sub ON sub.key = a.key)",
        *up("b", "mid", "rank", "one"),
    ]
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, b.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = b.digest AS verified FROM bp{levels - 1} a, b{levels} b"""


QUERIES = {
    "op1_embedding_near_dedup": embedding_near_dedup,
    "op2_html_extraction": html_extraction,
    "op3_simhash_near_dedup": simhash_near_dedup,
    "op4_benchmark_decontamination": decontamination,
    "op5_lm_scoring": lm_scoring,
    "op6_substring_dedup": substring_dedup,
    "op7_warc_archives": warc_archives,
    "op8_mixing_sources": mixing_sources,
    "op9_licence_scan": licence_scan,
    "op10_quality_classifier": quality_classifier,
    "op11_filter_interactions": filter_interactions,
    "op12_token_counts": token_counting,
    "op13_merkle_manifest": merkle_manifest,
}
ORACLE = {"op11_filter_interactions": AUDIT_SQL, "op13_merkle_manifest": merkle_sql(), "op4_benchmark_decontamination": CONTAMINATION_SQL, "op6_substring_dedup": SUBSTRING_SQL, "op8_mixing_sources": MIXING_SQL}
