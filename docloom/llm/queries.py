"""Registered queries of this subpackage, each one operator on its whole table, with DuckDB SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from docloom.llm import bpe, dedup, licenses, mix, near_dedup, nearest, quality, sharding, spelling, sql, substrings, token_files, whitening, wrappers
from docloom.llm.common import load, new_folder, ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def encoded_digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of the round trip through the vocabulary."""
    rows = bpe.round_trip(docs.select("doc_id", "text"), path)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op1_bpe_encoding")
def op1(spark, sf):
    return encoded_digests(load(spark, sf, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query("op2_source_mixing")
def op2(spark, sf):
    return mix.mix(load(spark, sf, "documents"))


@query("op3_html_extraction", r"""
WITH part AS (SELECT page_id, url, list_filter(list_transform(
    string_split_regex(regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's'), '</?(?:p|h1|br)>'),
    lambda x: trim(regexp_replace(regexp_replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'),
        '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks FROM pages)
SELECT page_id, url, coalesce(array_to_string(blocks, chr(10)), '') AS text, CAST(length(coalesce(array_to_string(blocks, chr(10)), '')) AS BIGINT) AS n_chars
FROM part""")
def op3(spark, sf):
    return wrappers.extract(load(spark, sf, "pages"))


@query("op4_license_scan", sql.license_scan())
def op4(spark, sf):
    return licenses.scan(load(spark, sf, "documents")).drop("blocks")


@query("op5_sharding")
def op5(spark, sf):
    return sharding.balanced_shards(load(spark, sf, "documents")).drop("linked")


@query("op6_exact_dedup", r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS x FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, sha256(x) AS text_sha256
FROM t WINDOW g AS (PARTITION BY x)""")
def op6(spark, sf):
    return dedup.exact_groups(load(spark, sf, "documents"))


@query("op7_token_files")
def op7(spark, sf):
    folder = new_folder(spark, "token-files")
    token_files.write_files(load(spark, sf, "documents"), folder, tokenizer_path("word_bpe_49k.json"))
    return token_files.stored_documents(spark, folder)


@query("op9_quality_rules", sql.quality_rules())
def op9(spark, sf):
    rows = quality.verdicts(load(spark, sf, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op10_minhash_dedup", sql.near_groups())
def op10(spark, sf):
    return near_dedup.near_groups(load(spark, sf, "documents"), words=4).drop("fp")


@query("op8_substring_dedup", r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
p AS (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS pos FROM w WHERE len(words) >= 35),
h AS (SELECT doc_id, pos, array_to_string(words[pos:pos + 34], ' ') AS part FROM p),
r AS (SELECT doc_id, list(pos) AS ats FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY part) AS n FROM h) WHERE n > 1 GROUP BY doc_id),
g AS (SELECT doc_id, list_distinct(flatten(list_transform(ats, lambda a: range(a, a + 35)))) AS gone FROM r),
k AS (SELECT w.doc_id, len(w.words) AS n, coalesce(len(gone), 0) AS lost, w.words, gone FROM w LEFT JOIN g USING (doc_id)),
u AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, n + 1)) AS pos FROM k WHERE lost > 0),
v AS (SELECT u.doc_id, string_agg(word, ' ' ORDER BY u.pos) AS kept FROM u LEFT JOIN (SELECT doc_id, unnest(gone) AS pos, 1 AS x FROM g) AS x
      ON u.doc_id = x.doc_id AND u.pos = x.pos WHERE x.x IS NULL GROUP BY u.doc_id)
SELECT k.doc_id, CAST(n AS BIGINT) AS n_words, CAST(lost AS BIGINT) AS n_removed,
       sha256(CASE WHEN lost = 0 THEN array_to_string(words, ' ') ELSE coalesce(v.kept, '') END) AS kept_sha256
FROM k LEFT JOIN v ON v.doc_id = k.doc_id""")
def op8(spark, sf):
    rows = substrings.remove_repeats(load(spark, sf, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_embedding_whitening")
def op11(spark, sf):
    rows = whitening.whiten(load(spark, sf, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


@query("op12_exact_top_k", r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * d.x[i])) AS BIGINT) AS score
  FROM v AS q JOIN v AS d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""")
def op12(spark, sf):
    return nearest.top_neighbours(load(spark, sf, "embeddings"))


@query("op13_spelling_variants")
def op13(spark, sf):
    return spelling.variants(load(spark, sf, "documents"))
