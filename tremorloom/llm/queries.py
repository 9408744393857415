"""One query per operator over its whole tables, with production parameters, and DuckDB statements where SQL can say it."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorloom.llm import common
from tremorloom.llm.bpe import bpe_decode, bpe_encode
from tremorloom.llm.collocations import collocations
from tremorloom.llm.decontaminate import decontaminate
from tremorloom.llm.exact_dedup import BATCHES, exact_dedup, new_index
from tremorloom.llm.language_id import MARGIN_SHARE, language_id, learn_dictionaries
from tremorloom.llm.license_scan import license_scan
from tremorloom.llm.line_dedup import line_dedup
from tremorloom.llm.lm_scoring import lm_scoring
from tremorloom.llm.ngram_join import ngram_join
from tremorloom.llm.packing import pack
from tremorloom.llm.simple8b import read_token_ids, write_token_ids
from tremorloom.llm.token_counts import token_counts
from tremorloom.llm.vector_codes import vector_codes, with_label_error


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(n: int, id_col: str = "doc_id"):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"), words=4, percent=85)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = lm_scoring(docs, remainder(7) != 2)
    return scored.withColumn("held_out", F.coalesce(remainder(7) == 2, F.lit(False)))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dictionaries = learn_dictionaries(docs.where(remainder(5) != 0))
    found = language_id(docs, dictionaries, margin_share=MARGIN_SHARE)
    return found.withColumn("held_out", F.coalesce(remainder(5) == 0, F.lit(False)))


def token_lengths(docs: DataFrame) -> DataFrame:
    """``doc_id, n_tokens``: the tokenizer's tokens of each whole text."""
    return token_counts(docs).select("doc_id", "n_tokens")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(token_lengths(table(spark, sf_dir, "documents")))


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = common.new_path(spark, "token-ids")
    write_token_ids(table(spark, sf_dir, "documents"), folder)
    return with_crc(read_token_ids(spark, folder))


def with_crc(ids: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of read ids."""
    return ids.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = new_index(docs)
    decided = exact_dedup(docs, index, batches=BATCHES)
    index.close()
    return decided.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe_decode(bpe_encode(table(spark, sf_dir, "documents")))
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes(table(spark, sf_dir, "embeddings"))
    return with_label_error(coded.rows).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(coded.digest()).alias("codebooks_sha256")
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_ngram_join, op3_license_scan, op4_lm_scoring, op5_line_dedup,
        op6_language_id, op7_packing, op8_token_output, op9_exact_dedup, op10_decontamination,
        op11_bpe, op12_vector_codes, op13_collocations,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

def _assigned(n: int) -> str:
    """Parts with the nearest entry of codebook ``b{n}``, and their distance."""
    return f"""a{n} AS MATERIALIZED (
            SELECT r, vec_id, label, pos, p, unnest(min(struct_pack(d := d, entry := entry))) FROM (
                SELECT m.*, entry, list_sum(list_transform(list_zip(m.p, b.p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
                FROM m JOIN b{n} AS b USING (pos)
            ) GROUP BY r, vec_id, label, pos, p
        )"""


def _updated(n: int) -> str:
    """Codebook ``b{n}``: floored means of the parts of each entry, unused entries as before."""
    return f"""b{n} AS MATERIALIZED (
            SELECT pos, entry, coalesce(mean, p) AS p FROM b{n - 1} LEFT JOIN (
                SELECT pos, entry, list(mean ORDER BY i) AS mean FROM (
                    SELECT pos, entry, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS mean
                    FROM (SELECT pos, entry, unnest(p) AS x, unnest(range(len(p))) AS i FROM a{n - 1}) GROUP BY pos, entry, i
                ) GROUP BY pos, entry
            ) AS means USING (pos, entry)
        )"""


ORACLES: dict[str, str] = {
    "op2_ngram_join": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
        ), s AS (
            SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END) AS g FROM w
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
        ), l AS (
            SELECT a, b FROM p JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
        ), r AS (
            SELECT a AS doc_id, a AS root FROM l UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.doc_id
        ), m AS (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m.root, d.doc_id))::BIGINT AS component_id
        FROM documents AS d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
    """,
    "op5_line_dedup": """
        WITH l AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS nth FROM documents
        ), k AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
        ), c AS (
            SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
        ), j AS (SELECT k.*, coalesce(k.doc_id < c.keeper, false) AS gone FROM k LEFT JOIN c USING (key))
        SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (NOT gone), '')) AS kept_sha256
        FROM j GROUP BY doc_id
    """,
    "op9_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)
    """,
    "op10_decontamination": f"""
        WITH w AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
        ), b AS (
            SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
        ), v AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS m, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2),
                lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS win FROM b WHERE len(w) > 0
        ), z AS (SELECT DISTINCT m FROM v),
        x AS (
            SELECT doc_id, m, unnest(range(1, len(w) - m + 2)) AS i, unnest(list_transform(range(1, len(w) - m + 2),
                lambda i: array_to_string(w[i:i + m - 1], ' '))) AS win FROM w, z WHERE len(w) >= m
        ), h AS (SELECT doc_id, i, m, item_id FROM x JOIN v USING (m, win)),
        c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM h) GROUP BY doc_id),
        t AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM w LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
    """,
    "op12_vector_codes": f"""
        WITH kept AS (
            SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), m AS MATERIALIZED (
            SELECT r, vec_id, label, pos, v[pos * (len(v) // 16) + 1:(pos + 1) * (len(v) // 16)] AS p
            FROM kept, (SELECT unnest(range(16)) AS pos) AS positions
        ), b0 AS MATERIALIZED (
            SELECT pos, entry, p FROM (SELECT pos, p, row_number() OVER (PARTITION BY pos ORDER BY vec_id, r) - 1 AS entry FROM m) WHERE entry < 64
        ), {_assigned(0)}, {_updated(1)}, {_assigned(1)}, {_updated(2)}, {_assigned(2)},
        o AS (
            SELECT r, any_value(vec_id) AS vec_id, any_value(label) AS label, sum(d)::BIGINT AS error,
                   string_agg(printf('%02x', entry), '' ORDER BY pos) AS code FROM a2 GROUP BY r
        ), h AS (SELECT sha256(string_agg(array_to_string(p, ','), ',' ORDER BY pos, entry)) AS codebooks_sha256 FROM b2)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM o, h
    """,
    "op13_collocations": f"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
        ), w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
        n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
        u AS (SELECT lang, x AS phrase, 1 AS k, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM w) GROUP BY ALL),
        g AS (
            SELECT lang, phrase, k, count(*) AS f FROM (
                SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
                FROM w, (VALUES (2), (3)) AS ks(k) WHERE len(w) >= k
            ) GROUP BY ALL HAVING count(*) >= 10
        ), f AS (SELECT lang, phrase, f FROM u UNION ALL SELECT lang, phrase, f FROM g),
        s AS (SELECT *, string_split(phrase, ' ') AS w FROM g),
        c AS (
            SELECT lang, phrase, f AS a, k, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS tail
            FROM (SELECT *, unnest(range(1, k)) AS cut FROM s)
        ), x AS (
            SELECT c.lang, c.phrase, c.a, cut, h.f AS l, t.f AS r, ((1000000::HUGEINT * a * a) // (h.f::HUGEINT * t.f))::BIGINT AS score
            FROM c JOIN f AS h ON h.lang = c.lang AND h.phrase = c.head JOIN f AS t ON t.lang = c.lang AND t.phrase = c.tail
        ), y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        i AS (
            SELECT lang, phrase, max(f) AS f FROM (
                SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, f FROM s WHERE k = 3
            ) GROUP BY ALL
        )
        SELECT y.lang, row_number() OVER (PARTITION BY y.lang ORDER BY score DESC, a DESC, y.phrase) AS rank, y.phrase, a, l, r, n.n, score
        FROM y JOIN n ON n.lang = y.lang LEFT JOIN i ON i.lang = y.lang AND i.phrase = y.phrase
        WHERE NOT coalesce(100 * i.f >= 50 * a, false)
        QUALIFY rank <= 2000
    """,
}
