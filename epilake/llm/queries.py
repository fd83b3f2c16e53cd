"""The operators over whole test tables, and the SQL of those that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epilake.llm import chunks, repeats
from epilake.llm.alignment import Tokenizers, align
from epilake.llm.decontaminate import contamination
from epilake.llm.language import predict_language
from epilake.llm.main_text import extract
from epilake.llm.minhash import NearDuplicates, near_duplicates
from epilake.llm.mixing import Mixture, mix
from epilake.llm.negatives import HardNegatives, hard_negatives
from epilake.llm.quality import quality_scores
from epilake.llm.rules import quality_rules
from epilake.llm.sharding import Shards, shards
from epilake.llm.tables import table
from epilake.llm.token_files import TokenFiles, token_output

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def byte_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), NearDuplicates(width=3, percent=85, rows=5))


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mix(table(spark, sf_dir, "documents"), Mixture())
    return rows.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op4_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chunks.without_repeats(table(spark, sf_dir, "documents"))
    size = F.octet_length("text").cast("long")
    return rows.select(
        "doc_id",
        "n_bytes",
        "n_chunks",
        (F.col("n_bytes") - size).alias("n_removed"),
        (F.size("spans") / 2).cast("long").alias("n_spans"),
        (F.size("spans") > 0).alias("repeated"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
        "spans",
        "text",
    )


@query
def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return rows.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


@query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_language(table(spark, sf_dir, "documents"))


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(table(spark, sf_dir, "documents"), TokenFiles(byte_tokenizer(), added=True))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return rows.select(*base)


@query
def op10_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repeats.without_repeats(table(spark, sf_dir, "documents"))
    n_spans = (F.size("spans") / 2).cast("long").alias("n_spans")
    return rows.select("doc_id", "n_bytes", "n_removed", n_spans, "kept_sha256")


def piece_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), Tokenizers(byte_tokenizer(), piece_tokenizer()))


@query
def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir, "documents"), Shards(16))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"), HardNegatives())


ORACLES["op6_decontamination"] = r"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, w[k : k + least(10, len(w)) - 1] AS gram
  FROM item, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS t(k) WHERE len(w) > 0),
doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), CAST([] AS VARCHAR[])) AS w
  FROM documents),
sizes AS (SELECT DISTINCT size FROM win),
place AS (
  SELECT doc_id, k, size, w[k : k + size - 1] AS gram
  FROM doc, sizes, unnest(generate_series(1, len(w) - size + 1)) AS t(k) WHERE len(w) >= size),
hit AS (SELECT doc_id, k, place.size, item_id FROM place JOIN win ON place.size = win.size AND place.gram = win.gram),
words AS (
  SELECT doc_id, count(DISTINCT k + j) AS n_hit
  FROM hit, unnest(generate_series(0, size - 1)) AS t(j) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
  FROM hit GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words ON doc.doc_id = words.doc_id LEFT JOIN items ON doc.doc_id = items.doc_id
"""

ORACLES["op1_minhash"] = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+'), CAST([] AS VARCHAR[])) AS w
  FROM documents),
gram AS (
  SELECT DISTINCT doc_id, w[k : k + least(3, len(w)) - 1] AS g
  FROM doc, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS t(k) WHERE len(w) > 0),
size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both
  FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT x, y FROM shared JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y
  WHERE 100 * n_both >= 85 * (p.n + q.n - n_both)),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM doc
  UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y),
least_id AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, component_id = doc.doc_id AS kept
FROM doc JOIN least_id ON doc.doc_id = x LEFT JOIN size ON size.doc_id = doc.doc_id
"""

ORACLES["op3_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
total AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
    2.0::DOUBLE * source_size AS most, sum(source_size) OVER ()::BIGINT * 150 / 100 AS whole
  FROM total),
level AS (
  SELECT *, (whole - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM weighed),
target AS (
  SELECT source, source_size, least(most, max(share) OVER () * weight) AS target,
    ('0x' || substr(md5('7 ' || coalesce(source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS start
  FROM level),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size,
      ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % (SELECT greatest(1, ceil(count(*) / 4096)) FROM documents), doc_id) - 1 AS place
  FROM sized),
picked AS (
  SELECT doc_id, placed.source, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS each, place, start
  FROM placed JOIN target ON placed.source IS NOT DISTINCT FROM target.source),
counted AS (
  SELECT *, (floor((place + 1) * each + start) - floor(place * each + start))::BIGINT AS copies FROM picked)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM counted
"""

ORACLES["op10_repeated_strings"] = r"""
WITH doc AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
place AS (
  SELECT doc_id, p, md5_number(substr(h, 2 * p + 1, 800)) AS m
  FROM doc, unnest(generate_series(0, n - 400)) AS t(p) WHERE n >= 400),
again AS (SELECT m FROM place GROUP BY m HAVING count(*) > 1),
hit AS (SELECT doc_id, p FROM place WHERE m IN (SELECT m FROM again)),
edge AS (
  SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 400 THEN 0 ELSE 1 END AS new FROM hit),
run AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM edge),
span AS (SELECT doc_id, min(p) AS a, max(p) + 400 AS b FROM run GROUP BY doc_id, k),
part AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS low, a AS high FROM span
  UNION ALL SELECT span.doc_id, max(b), any_value(n) FROM span JOIN doc ON doc.doc_id = span.doc_id GROUP BY span.doc_id),
left_over AS (
  SELECT part.doc_id, string_agg(substr(h, 2 * low + 1, 2 * (high - low)), '' ORDER BY low) AS h
  FROM part JOIN doc ON doc.doc_id = part.doc_id GROUP BY part.doc_id),
gone AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM span GROUP BY doc_id)
SELECT doc.doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(left_over.h, doc.h))) AS kept_sha256
FROM doc LEFT JOIN gone ON gone.doc_id = doc.doc_id LEFT JOIN left_over ON left_over.doc_id = doc.doc_id
"""

ORACLES["op12_sharding"] = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, sha256(coalesce(text, '')) AS key FROM documents),
bits AS (
  SELECT b, b::BIGINT AS c, 0 AS n FROM range(256) AS t(b)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n + 1 FROM bits WHERE n < 8),
tab AS (SELECT list(c ORDER BY b) AS tab FROM bits WHERE n = 8),
bytes AS (
  SELECT DISTINCT sha256(coalesce(text, '')) AS key, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n
  FROM documents),
crc AS (
  SELECT key, 0 AS k, 4294967295::BIGINT AS c FROM bytes
  UNION ALL
  SELECT key, least(k + 1024, n),
    list_reduce([c] || list_transform(range(0, least(1024, n - k)), lambda j : ('0x' || substr(piece, 2 * j + 1, 2))::BIGINT),
      lambda s, b : xor(s >> 8, tab[(xor(s, b) & 255) + 1]))
  FROM (SELECT key, k, c, n, substr(h, 2 * k + 1, 2048) AS piece FROM crc JOIN bytes USING (key) WHERE k < n), tab),
summed AS (SELECT key, xor(c, 4294967295) AS text_crc32 FROM crc JOIN bytes USING (key) WHERE k = n),
grouped AS (SELECT key, sum(size)::BIGINT AS size FROM doc GROUP BY key),
ranked AS (
  SELECT key, size, row_number() OVER w - 1 AS place,
    sum(size) OVER ()::BIGINT - coalesce(sum(size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS rest
  FROM grouped WINDOW w AS (ORDER BY size DESC, key)),
large AS (SELECT coalesce(min(place), 0) AS many FROM ranked WHERE place >= 16 OR size * (16 - place) <= rest),
alone AS (SELECT key, place AS shard FROM ranked, large WHERE place < many),
ordered AS (
  SELECT key, size, row_number() OVER (ORDER BY key) AS k, sum(size) OVER (ORDER BY key)::BIGINT AS upto
  FROM grouped WHERE key NOT IN (SELECT key FROM alone)),
bounds AS (
  SELECT greatest(max(size), (sum(size) + 15 - many) // (16 - many))::BIGINT AS low, sum(size)::BIGINT AS high, 16 - many AS parts
  FROM ordered, large GROUP BY many),
search AS (  -- one capacity is checked greedily, a shard a step; then the next
  SELECT low, high, 0::BIGINT AS taken, 0 AS used, high AS total, parts FROM bounds
  UNION ALL
  SELECT CASE WHEN full_at < total AND used + 1 >= parts THEN (low + high) // 2 + 1 ELSE low END,
    CASE WHEN full_at >= total THEN (low + high) // 2 ELSE high END,
    CASE WHEN full_at >= total OR used + 1 >= parts THEN 0 ELSE full_at END,
    CASE WHEN full_at >= total OR used + 1 >= parts THEN 0 ELSE used + 1 END, total, parts
  FROM (SELECT *, (SELECT max(upto) FROM ordered WHERE upto <= taken + (low + high) // 2)::BIGINT AS full_at
        FROM search WHERE low < high)),
best AS (SELECT min(high) AS capacity FROM search),
walk AS (
  SELECT 0::BIGINT AS taken, 0 AS shard
  UNION ALL
  SELECT (SELECT max(upto) FROM ordered WHERE upto <= taken + capacity)::BIGINT, shard + 1
  FROM walk, best WHERE taken < (SELECT max(upto) FROM ordered)),
placed AS (
  SELECT key, many + (SELECT max(shard) FROM walk WHERE walk.taken < ordered.upto) AS shard FROM ordered, large
  UNION ALL SELECT key, shard FROM alone),
binned AS (
  SELECT doc.*, shard, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
    % (SELECT greatest(1, ceil(count(*) / 8192)) FROM documents)::BIGINT AS bin
  FROM doc JOIN placed USING (key))
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY bin, doc_id, key) - 1 AS slot, CAST(NULL AS INT) AS grown_shard
FROM binned JOIN summed USING (key)
"""

ORACLES["op13_hard_negatives"] = r"""
WITH vec AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x : floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = v.label AS same, v.vec_id, list_dot_product(a.q, v.q)::BIGINT AS score
  FROM vec a JOIN vec v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
negative AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM positive p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
  WHERE 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM negative WHERE rank <= 5
"""
