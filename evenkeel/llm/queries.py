"""The operators of this subpackage as named queries, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from evenkeel.llm.language_id import identify
from evenkeel.llm.license_rules import COMMON_LICENSES, LicenseRules
from evenkeel.llm.license_scan import scan_licenses
from evenkeel.llm.line_dedup import drop_repeated_lines
from evenkeel.llm.merkle import build_manifest, fold, hexed as hex_text, leaf_digest, proof_digest
from evenkeel.llm.mixing import mix_sources
from evenkeel.llm.packing import pack
from evenkeel.llm.ppm import score_texts
from evenkeel.llm.quality_qda import score_quality
from evenkeel.llm.quality_rules import judge_documents
from evenkeel.llm.shipping import ship_package
from evenkeel.llm.simhash import hexed, near_duplicates
from evenkeel.llm.token_alignment import align_tokenizers
from evenkeel.llm.url_filter import Entry, judge_urls
from evenkeel.llm.vector_search import nearest
from evenkeel.llm.words import documents

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run

    return add


def remainder(column: str, divisor: int):
    """crc32 of the column as text, modulo ``divisor``; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


OP1_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), listed AS (
  SELECT r, doc_id, source, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), places AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM listed WHERE len(w) >= 3
), repeats AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n FROM places
), covered AS (
  SELECT r, count(DISTINCT i + d) AS n_repeat_words
  FROM repeats CROSS JOIN (VALUES (0), (1), (2)) AS offsets(d) WHERE n > 1 GROUP BY r
), measured AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM listed LEFT JOIN covered USING (r)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
), hosts AS (
  SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CAST(base_failed AS INT)) AS DOUBLE) AS f
  FROM judged WHERE source IS NOT NULL GROUP BY source
), overall AS (
  SELECT sum(f) / sum(n) AS p, sum(n) AS rows_all, sum(n * n) AS squares, sum(f * f / n) AS explained, count(*) AS k FROM hosts
), moments AS (
  SELECT p, CASE WHEN p > 0 AND p < 1 THEN (explained - rows_all * p * p) / (p * (1 - p)) - (k - 1) ELSE 0 END AS excess,
    rows_all - squares / rows_all - (k - 1) AS room FROM overall
), prior AS (
  SELECT p, CASE WHEN p > 0 AND p < 1 AND room > 0 THEN least(greatest(excess / room, 0), 1) ELSE 0 END AS rho FROM moments
), verdicts AS (
  SELECT source, (rho * f + p * (1 - rho)) / (rho * n + (1 - rho)) > 0.7 AS host_failed FROM hosts CROSS JOIN prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR coalesce(host_failed, false)) AS kept
FROM judged LEFT JOIN verdicts USING (source)
"""


@query("op1_quality_rules", OP1_SQL)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_documents(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


# The entries of the query: host, path, verdict.
URL_ENTRIES = (
    Entry("net", "/", "block"),
    Entry("example.net", "/en/", "allow"),
    Entry("example.com", "/de/", "block"),
    Entry("org", "/fr/", "allow"),
)

OP9_SQL = r"""
WITH cut AS (
  SELECT page_id,
    CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path
  FROM cut
), entries(rule_host, rule_path, rule_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, rule_verdict,
    row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rule_host) DESC NULLS LAST, length(rule_path) DESC) AS k
  FROM split LEFT JOIN entries ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM fits WHERE k = 1
"""


@query("op9_url_filter", OP9_SQL)
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(documents(spark, sf_dir, "pages").select("page_id", "url"), URL_ENTRIES).drop("url")


@query("op6_lm_scoring")
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(remainder("doc_id", 7) == 2, F.lit(False))
    docs = documents(spark, sf_dir).select("doc_id", "text", held_out.alias("held_out"))
    return score_texts(docs, ~F.col("held_out"))


@query("op8_simhash_near_dup")
def op8_simhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", hexed(F.col("fp")).alias("fingerprint"), "component_id")


def language_training() -> Column:
    """The rows that language models learn from."""
    return F.coalesce(remainder("doc_id", 4) != 2, F.lit(True))


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    judged = identify(docs, language_training())
    return judged.select("doc_id", (~language_training()).alias("held_out"), "lang_pred", "score", "rejected")


def quality_training() -> Column:
    """The labels that the quality classifier learns from."""
    return F.coalesce(remainder("doc_id", 5) != 0, F.lit(False))


@query("op3_quality_classifier")
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = score_quality(docs, documents(spark, sf_dir, "labels").select("doc_id", "quality"), quality_training())
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op2_mixing")
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mix_sources(documents(spark, sf_dir).select("doc_id", "text", "source")).taken()
    return taken.select("doc_id", "size", "source_size", "target", "taken", "source")


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir).select("doc_id", "text"))


@query("op7_vector_search")
def op7_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = documents(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, F.col("vec_id") % 20 == 0)


def license_sql(rules: LicenseRules = COMMON_LICENSES) -> str:
    """The scan in SQL, for the same rules: runs of lines joined to the known sentences, walks over lines and over sentences."""
    sentences = ", ".join(f"('{text}', {i})" for i, text in rules.sentences)
    entries = ", ".join(
        f"({r}, '{license_name}', {len(ids)}, {j}, {i})" for r, (license_name, ids) in enumerate(rules.rules) for j, i in enumerate(ids)
    )
    longest = max(len(text) for _, text in rules.sentences)
    return rf"""
WITH RECURSIVE sentences(sentence, id) AS (VALUES {sentences}),
rules(rule, license, n, j, id) AS (VALUES {entries}),
texts AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
spoken AS (
  SELECT r, list_filter(list_transform(string_split_regex(lower(text), '[.!?;]+[ 	
]+|[.!?;]+$|[
]+'),
    lambda s: trim(regexp_replace(s, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))), lambda s: s <> '') AS lines
  FROM texts WHERE regexp_matches(lower(text), '{"|".join(rules.telltales)}')
), starts AS (
  SELECT r, lines, unnest(range(1, len(lines) + 1)) AS i FROM spoken
), widths AS (
  SELECT r, i, lines, unnest(range(1, 1 + least(len(lines) - i + 1, {longest // 2 + 1}))) AS w FROM starts
  WHERE string_split(lines[i], ' ')[1] IN (SELECT DISTINCT string_split(sentence, ' ')[1] FROM sentences)
), runs AS (
  SELECT r, i, max(w) AS w, max_by(id, w) AS id
  FROM (SELECT r, i, w, array_to_string(lines[i:i + w - 1], ' ') AS sentence FROM widths) JOIN sentences USING (sentence) GROUP BY r, i
), walk AS (
  SELECT r, 1 AS i, 0 AS nth FROM (SELECT DISTINCT r FROM runs)
  UNION ALL
  SELECT walk.r, walk.i + coalesce(w, 1), nth + 1 FROM walk JOIN spoken USING (r) LEFT JOIN runs ON runs.r = walk.r AND runs.i = walk.i
  WHERE walk.i < len(lines)
), known AS (
  SELECT walk.r, nth, id, row_number() OVER (PARTITION BY walk.r ORDER BY nth) AS k, count(*) OVER (PARTITION BY walk.r) AS n_known,
    nth - lag(nth) OVER (PARTITION BY walk.r ORDER BY nth) AS gap
  FROM walk JOIN runs ON runs.r = walk.r AND runs.i = walk.i
), fits AS (
  SELECT one.r, one.k, rule, license, n, min(other.nth) AS first_at, max(other.nth) AS last_at
  FROM known one JOIN rules ON true JOIN known other ON other.r = one.r AND other.k = one.k + rules.j AND other.id = rules.id
    AND (rules.j = 0 OR other.gap <= {rules.max_gap + 1})
  WHERE EXISTS (SELECT 1 FROM rules head WHERE head.rule = rules.rule AND head.j = 0 AND head.id = one.id)
  GROUP BY one.r, one.k, rule, license, n HAVING count(*) = n
), best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r, k ORDER BY n DESC, rule) AS place FROM fits) WHERE place = 1
), taken AS (
  SELECT r, 1::BIGINT AS k, n_known FROM known WHERE k = 1
  UNION ALL
  SELECT taken.r, taken.k + coalesce(best.n, 1), n_known FROM taken LEFT JOIN best ON best.r = taken.r AND best.k = taken.k WHERE taken.k < n_known
), matched AS (
  SELECT best.r, count(*) AS n, string_agg(license, ',' ORDER BY best.k) AS licenses, min(first_at) AS first_at, max(last_at) AS last_at
  FROM taken JOIN best ON best.r = taken.r AND best.k = taken.k GROUP BY best.r
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_matches, coalesce(licenses, '') AS licenses,
  CAST(first_at AS INTEGER) AS first_sentence, CAST(last_at AS INTEGER) AS last_sentence
FROM texts LEFT JOIN matched USING (r)
"""


@query("op4_license_scan", license_sql())
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join("matches.license", ",").alias("licenses"),
        F.get("matches", F.lit(0))["first"].alias("first_sentence"),
        F.array_max("matches.last").alias("last_sentence"),
    )


# crc32 bit by bit: DuckDB has no function for it.
CRC32_SQL = """
list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST({value} AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda acc, unused: CASE WHEN acc % 2 = 1 THEN xor(acc // 2, 3988292384) ELSE acc // 2 END))
"""

OP11_SQL = r"""
WITH RECURSIVE fields AS (
  SELECT row_number() OVER () AS r, doc_id, source, text, coalesce('+' || source, '') AS g,
    coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
    || coalesce(octet_length(encode(source)) || ':' || source, '-')
    || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
    || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head,
    coalesce(%crc32% %% 2 = 1, false) AS changed
  FROM documents
), leaves AS (
  SELECT r, doc_id, g, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
    CASE WHEN changed THEN sha256(head || coalesce(octet_length(encode(replace(text, chr(10), ''))) || ':' || replace(text, chr(10), ''), '-')) END AS claim
  FROM fields
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves
), nodes AS (
  SELECT 0 AS lvl, g, pos, n, leaf AS digest FROM numbered
  UNION ALL
  SELECT lvl + 1, g, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY lvl, g, pos // 3, n
), subroots AS (
  SELECT g, digest, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS lvl, pos, n, digest FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY lvl, pos // 3, n
), root AS (
  SELECT digest AS root FROM tops WHERE n = 1
), heights AS (
  SELECT g, max(lvl) AS height FROM nodes GROUP BY g
), paths AS (
  SELECT g, 0 AS lvl, pos, pos AS leaf_pos FROM nodes WHERE lvl = 0
  UNION ALL
  SELECT paths.g, paths.lvl + 1, paths.pos // 3, leaf_pos FROM paths JOIN heights USING (g) WHERE paths.lvl < height
), group_paths AS (
  SELECT g, 0 AS lvl, pos FROM subroots
  UNION ALL
  SELECT g, lvl + 1, pos // 3 FROM group_paths WHERE lvl < (SELECT max(lvl) FROM tops)
), steps AS (
  SELECT paths.g, leaf_pos, paths.lvl AS step, coalesce(string_agg(o.digest, '' ORDER BY o.pos) FILTER (o.pos < paths.pos), '') AS before,
    coalesce(string_agg(o.digest, '' ORDER BY o.pos) FILTER (o.pos > paths.pos), '') AS after
  FROM paths JOIN heights ON paths.g = heights.g AND paths.lvl < height
  JOIN nodes o ON o.g = paths.g AND o.lvl = paths.lvl AND o.pos // 3 = paths.pos // 3 GROUP BY paths.g, leaf_pos, paths.lvl
), group_steps AS (
  SELECT p.g, p.lvl AS step, coalesce(string_agg(o.digest, '' ORDER BY o.pos) FILTER (o.pos < p.pos), '') AS before,
    coalesce(string_agg(o.digest, '' ORDER BY o.pos) FILTER (o.pos > p.pos), '') AS after
  FROM group_paths p JOIN tops o ON o.lvl = p.lvl AND o.pos // 3 = p.pos // 3 AND o.n > 1 GROUP BY p.g, p.lvl
), all_steps AS (
  SELECT g, leaf_pos, step, before, after FROM steps
  UNION ALL
  SELECT numbered.g, numbered.pos, height + step, before, after FROM numbered JOIN heights USING (g) JOIN group_steps USING (g)
), proofs AS (
  SELECT g, leaf_pos, sha256(string_agg(before || after, '' ORDER BY step)) AS proof, max(step) AS last FROM all_steps GROUP BY g, leaf_pos
), folded AS (
  SELECT g, pos AS leaf_pos, 0 AS step, coalesce(claim, leaf) AS digest FROM numbered
  UNION ALL
  SELECT f.g, f.leaf_pos, f.step + 1, sha256(before || digest || after) FROM folded f
  JOIN all_steps s ON s.g = f.g AND s.leaf_pos = f.leaf_pos AND s.step = f.step
)
SELECT doc_id, leaf, nodes.digest AS subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded.digest AS folded_root,
  folded.digest = root AS verified
FROM numbered JOIN nodes ON nodes.g = numbered.g AND nodes.n = 1 CROSS JOIN root
LEFT JOIN proofs ON proofs.g = numbered.g AND proofs.leaf_pos = numbered.pos
JOIN folded ON folded.g = numbered.g AND folded.leaf_pos = numbered.pos AND folded.step = coalesce(last + 1, 0)
""".replace("%crc32%", CRC32_SQL.format(value="doc_id")).replace("%%", "%")


@query("op11_merkle_manifest", OP11_SQL)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.coalesce(remainder("doc_id", 2) == 0, F.lit(False))
    claim = F.when(tampered, leaf_digest(*named, F.translate("text", "\n", "")))
    manifest = build_manifest(documents(spark, sf_dir), leaf_digest(*named, F.col("text")), carry={"claim": claim})
    folded = fold(F.coalesce("claim", "leaf"), F.col("steps"))
    return manifest.withColumn("folded", folded).select(
        "doc_id",
        hex_text(F.col("leaf")).alias("leaf"),
        hex_text(F.col("subroot")).alias("subroot"),
        hex_text(F.col("root")).alias("root"),
        hex_text(proof_digest(F.col("steps"))).alias("proof_sha256"),
        hex_text(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


OP12_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), placed AS (
  SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS nth FROM texts
), keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM placed
), found AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) + CAST(bool_or(doc_id IS NULL) AS INT) >= 3
), verdicts AS (
  SELECT r, nth, line, found.key IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS dropped FROM keyed LEFT JOIN found USING (key)
), kept AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped, string_agg(line, chr(10) ORDER BY nth) FILTER (NOT dropped) AS kept
  FROM verdicts GROUP BY r
)
SELECT doc_id, n_lines, n_dropped, sha256(coalesce(kept, '')) AS kept_sha256 FROM texts JOIN kept USING (r)
"""


@query("op12_line_dedup", OP12_SQL)
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


TOKENIZERS = "/opt/tokenizers"


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return align_tokenizers(docs, f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")
