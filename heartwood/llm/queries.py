"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heartwood.llm import (
    alignment,
    ann,
    embedding_dedup,
    language_id,
    line_dedup,
    minhash_dedup,
    packing,
    piece_codec,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filter,
    whitening,
)


def _table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, directory: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(_table(spark, directory, "documents"))
    return kept.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op2_line_dedup(spark: SparkSession, directory: str) -> DataFrame:
    kept = line_dedup.drop_common_lines(_table(spark, directory, "documents"), min_docs=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def dated_captures(pages: DataFrame) -> DataFrame:
    """The pages as captures: the tables have no fetch time, so the id gives a day of 2024."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(365)).cast("int"))
    return pages.select(F.col("page_id").alias("capture_id"), "url", day.alias("fetched_on"))


def dated_lists(pages: DataFrame) -> DataFrame:
    """List entries for hosts, their paths with and without final slash, and single pages, with
    days from the bytes of the MD5 of host or page."""
    hosts = (
        pages.select(url_filter.host_of(F.col("url")).alias("host"))
        .where("host <> ''")
        .distinct()
        .withColumn("m", F.md5("host"))
    )
    single = (
        pages.select(
            F.concat(url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))).alias("page")
        )
        .where("not startswith(page, '/')")
        .distinct()
        .withColumn("m", F.md5("page"))
    )
    byte = [F.conv(F.substring("m", 2 * i + 1, 2), 16, 10).cast("int") for i in range(4)]
    first = F.date_add(F.lit("2024-01-01").cast("date"), byte[1])

    def entry(name, kind, pattern, action, day, when):
        row = F.struct(
            F.lit(name).alias("list"), F.lit(kind).alias("kind"), pattern.alias("pattern"),
            F.lit(action).alias("action"), day.alias("day"),
        )
        return F.when(when, row)

    parent = F.regexp_replace("host", r"^[^.]*\.", "")
    listed = byte[0] < 80
    entries = F.array(
        entry("ads", "domain", F.col("host"), "add", first, listed),
        entry("ads", "domain", F.col("host"), "remove",
              F.date_add(first, 30 + byte[3] % 60), listed & (byte[2] < 160)),
        entry("ads", "domain", F.col("host"), "add",
              F.date_add(first, F.lit(120)), listed & (byte[3] < 128)),
        entry("adult", "url", F.concat("host", F.lit("/en/")), "add", first, byte[0] >= 200),
        entry("adult", "url", F.concat("host", F.lit("/en")), "add", first, byte[2] >= 230),
        entry("malware", "domain", parent, "add", first, byte[3] < 10),
        entry("malware", "domain", parent, "remove", F.date_add(first, F.lit(20)), byte[3] < 5),
    )
    page_entries = F.array(
        entry("phishing", "url", F.col("page"), "add", first, byte[0] < 8),
        entry("phishing", "url", F.col("page"), "remove", F.date_add(first, F.lit(40)),
              (byte[0] < 8) & (byte[2] < 128)),
    )
    rows = hosts.select(F.explode(entries).alias("e")).union(
        single.select(F.explode(page_entries).alias("e"))
    )
    return rows.where("e is not null").select("e.*")


def op3_url_filter(spark: SparkSession, directory: str) -> DataFrame:
    pages = _table(spark, directory, "pages")
    return url_filter.judge_captures(dated_captures(pages), dated_lists(pages))


def op4_ann(spark: SparkSession, directory: str) -> DataFrame:
    vectors = _table(spark, directory, "embeddings")
    return ann.nearest_neighbours(vectors, F.col("vec_id") % 100 == 0, k=10)


def op5_embedding_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, directory, "embeddings"), least=0.98)


def op6_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    return toxicity.scored_documents(
        _table(spark, directory, "documents"), _table(spark, directory, "labels")
    )


def op7_packing(spark: SparkSession, directory: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(_table(spark, directory, "documents"), path, capacity=4096, end=1)


def op8_piece_codec(spark: SparkSession, directory: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return piece_codec.encoded_documents(_table(spark, directory, "documents"), path)


def op9_minhash_dedup(spark: SparkSession, directory: str) -> DataFrame:
    found = minhash_dedup.near_duplicates(_table(spark, directory, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_language_id(spark: SparkSession, directory: str) -> DataFrame:
    return language_id.identified_documents(_table(spark, directory, "documents"))


def op11_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    counts = token_counts.prefix_counts(_table(spark, directory, "documents"), path)
    return token_counts.within_budget(counts, 1024)


def op12_whitening(spark: SparkSession, directory: str) -> DataFrame:
    return whitening.whiten(_table(spark, directory, "embeddings"), components=16)


def op13_alignment(spark: SparkSession, directory: str) -> DataFrame:
    return alignment.align(
        _table(spark, directory, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_url_filter": op3_url_filter,
    "op4_ann": op4_ann,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_packing": op7_packing,
    "op8_piece_codec": op8_piece_codec,
    "op9_minhash_dedup": op9_minhash_dedup,
    "op10_language_id": op10_language_id,
    "op11_token_counts": op11_token_counts,
    "op12_whitening": op12_whitening,
    "op13_alignment": op13_alignment,
}

_OP2 = r"""
WITH lines AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), common AS (
  SELECT line_key FROM lines WHERE length(line_key) >= 1
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT doc_id, pos, line, c.line_key IS NOT NULL AS gone
  FROM lines LEFT JOIN common c USING (line_key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM marked GROUP BY doc_id
"""

_OP3 = r"""
WITH captures AS (
  SELECT page_id AS capture_id, (DATE '2024-01-01' + ((page_id * 37) % 365)::INT) AS fetched_on,
         rtrim(regexp_extract(lower(trim(url)), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1), '.')
           AS host,
         coalesce(nullif(
           regexp_extract(trim(url), '(?i)^[a-z][a-z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1), ''), '/') AS path
  FROM pages
), hosts AS (
  SELECT host, ('0x' || substr(m, 1, 2))::INT AS b0, ('0x' || substr(m, 3, 2))::INT AS b1,
         ('0x' || substr(m, 5, 2))::INT AS b2, ('0x' || substr(m, 7, 2))::INT AS b3
  FROM (SELECT DISTINCT host, md5(host) AS m FROM captures WHERE host <> '')
), singles AS (
  SELECT page, ('0x' || substr(m, 1, 2))::INT AS b0, ('0x' || substr(m, 3, 2))::INT AS b1,
         ('0x' || substr(m, 5, 2))::INT AS b2
  FROM (SELECT DISTINCT host || path AS page, md5(host || path) AS m FROM captures WHERE host <> '')
), entries AS (
  SELECT 'ads' AS list, 'domain' AS kind, host AS pattern, 'add' AS action,
         DATE '2024-01-01' + b1 AS day FROM hosts WHERE b0 < 80
  UNION ALL SELECT 'ads', 'domain', host, 'remove', DATE '2024-01-01' + (b1 + 30 + b3 % 60)
    FROM hosts WHERE b0 < 80 AND b2 < 160
  UNION ALL SELECT 'ads', 'domain', host, 'add', DATE '2024-01-01' + (b1 + 120)
    FROM hosts WHERE b0 < 80 AND b3 < 128
  UNION ALL SELECT 'adult', 'url', host || '/en/', 'add', DATE '2024-01-01' + b1
    FROM hosts WHERE b0 >= 200
  UNION ALL SELECT 'adult', 'url', host || '/en', 'add', DATE '2024-01-01' + b1
    FROM hosts WHERE b2 >= 230
  UNION ALL SELECT 'malware', 'domain', regexp_replace(host, '^[^.]*\.', ''), 'add',
    DATE '2024-01-01' + b1 FROM hosts WHERE b3 < 10
  UNION ALL SELECT 'malware', 'domain', regexp_replace(host, '^[^.]*\.', ''), 'remove',
    DATE '2024-01-01' + (b1 + 20) FROM hosts WHERE b3 < 5
  UNION ALL SELECT 'phishing', 'url', page, 'add', DATE '2024-01-01' + b1 FROM singles WHERE b0 < 8
  UNION ALL SELECT 'phishing', 'url', page, 'remove', DATE '2024-01-01' + (b1 + 40)
    FROM singles WHERE b0 < 8 AND b2 < 128
), states AS (
  SELECT capture_id, list, kind, pattern,
         arg_max(action, day::VARCHAR || action) AS newest
  FROM captures JOIN entries ON day <= fetched_on AND
    CASE kind WHEN 'domain' THEN host = pattern OR ends_with(host, '.' || pattern)
         ELSE host || path = pattern
           OR starts_with(host || path, pattern || '/') AND NOT ends_with(pattern, '/')
           OR starts_with(host || path, pattern) AND ends_with(pattern, '/') END
  GROUP BY ALL
), active AS (
  SELECT capture_id, count(*) AS n_active, min(pattern) AS first_pattern
  FROM states WHERE newest = 'add' GROUP BY capture_id
)
SELECT capture_id, fetched_on, coalesce(n_active, 0) AS n_active, first_pattern,
       n_active IS NOT NULL AS blocked
FROM captures LEFT JOIN active USING (capture_id)
"""

_VALID = """
  SELECT vec_id, embedding::DOUBLE[] AS e, label FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
"""

_OP5 = f"""
WITH RECURSIVE valid AS ({_VALID}), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM valid a JOIN valid b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach(x, y) AS (
  SELECT vec_id, vec_id FROM valid
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), least AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x
), counts AS (SELECT x AS vec_id, count(*) AS n_links FROM links GROUP BY x)
SELECT v.vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, v.vec_id) AS component_id,
       coalesce(component_id, v.vec_id) = v.vec_id AS kept
FROM embeddings v LEFT JOIN least USING (vec_id) LEFT JOIN counts USING (vec_id)
"""

_OP9 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(
      list_zip(w, w[2:], w[3:], w[4:], w[5:])[:len(w) - 4],
      lambda x: x[1] || ' ' || x[2] || ' ' || x[3] || ' ' || x[4] || ' ' || x[5])) END AS s
  FROM words
), shingles AS (SELECT doc_id, unnest(s) AS g FROM sets
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b USING (g)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sets a ON a.doc_id = x JOIN sets b ON b.doc_id = y
  WHERE 100 * n >= 75 * (len(a.s) + len(b.s) - n)
), reach(x, y) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), least AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least USING (doc_id)
"""

#: ids in these tables are unique, which the SQL relies on
ORACLES: dict[str, str] = {
    "op2_line_dedup": _OP2,
    "op3_url_filter": _OP3,
    "op5_embedding_dedup": _OP5,
    "op9_minhash_dedup": _OP9,
}
