"""The operators applied to their whole tables, and the same answers in SQL where SQL has them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwatch.llm import (
    bpe_count,
    byte_codec,
    collocations,
    exact_dedup,
    jaccard_join,
    line_rules,
    packing,
    pii,
    piece_codec,
    quality,
    secret_scan,
    spelling,
    url_filter,
)
from orderwatch.llm.common import read_table

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SPLITS = public_tokenizers.PATTERN


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(read_table(spark, sf_dir, "documents"))
    base = [kind.name for kind in pii.BASE]
    of_kind = lambda name: F.filter("spans", lambda s: s["kind"] == name)
    counts = [F.size(of_kind(name)).cast("long").alias(f"n_{name}") for name in base]
    of_base = pii.span_list(F.filter("spans", lambda s: s["kind"].isin(base)))
    return found.select(
        "doc_id", *counts, F.sha2(of_base, 256).alias("base_sha256"), pii.span_list(F.col("spans")).alias("spans")
    )


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_count.token_counts(read_table(spark, sf_dir, "documents"), WORD_TOKENIZER)


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checksum is taken where the pieces are made, so that only numbers are shuffled."""
    return packed_documents(read_table(spark, sf_dir, "documents"))


def packed_documents(docs: DataFrame) -> DataFrame:
    pieces = packing.token_pieces(docs, WORD_TOKENIZER)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), docs.count())


def similar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(read_table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def piece_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = piece_codec.encode_pieces(read_table(spark, sf_dir, "documents"), PIECE_MODEL)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(read_table(spark, sf_dir, "documents"), RANKS, SPLITS)
    base = secret_scan.KINDS[:3]
    of_kind = lambda name: F.filter("spans", lambda s: s["kind"] == name)
    counts = [F.size(of_kind(name)).cast("long").alias(f"n_{name}") for name in base]
    of_base = pii.span_list(F.filter("spans", lambda s: s["kind"].isin(*base)))
    return found.select(
        "doc_id", *counts, F.sha2(of_base, 256).alias("base_sha256"), pii.span_list(F.col("spans")).alias("spans")
    )


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


def byte_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_codec.encode_bytes(read_table(spark, sf_dir, "documents"), RANKS, SPLITS)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"))


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_url_filter": urls,
    "op2_quality_rules": quality_rules,
    "op3_pii": personal_data,
    "op4_token_counts": token_counts,
    "op5_packing": packed,
    "op6_jaccard_join": similar_documents,
    "op7_piece_codec": piece_codes,
    "op8_secret_scan": secrets,
    "op9_quality_classifier": quality_scores,
    "op10_exact_dedup": exact_copies,
    "op11_byte_codec": byte_codes,
    "op12_spelling_variants": spelling_variants,
    "op13_collocations": phrase_collocations,
}

#: Word sets, all pairs of different sets that share a shingle, and the links followed to their ends.
SIMILAR = r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), shingled AS MATERIALIZED (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
            ELSE list_sort(list_distinct([array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)])) END AS s
        FROM words
    ), sets AS MATERIALIZED (
        SELECT s, len(s) AS n, min(doc_id) AS id FROM shingled WHERE len(s) > 0 GROUP BY s
    ), each AS MATERIALIZED (SELECT id, n, unnest(s) AS shingle FROM sets),
    links AS MATERIALIZED (
        SELECT a.id AS u, b.id AS v
        FROM each a JOIN each b ON a.shingle = b.shingle AND a.id < b.id
        WHERE 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
        GROUP BY a.id, b.id, a.n, b.n
        HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
    ), ways AS MATERIALIZED (SELECT u, v FROM links UNION SELECT v, u FROM links),
    reached AS (
        SELECT id, id AS other FROM sets
        UNION SELECT r.id, l.v FROM reached r JOIN ways l ON l.u = r.other
    ), named AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id)
    SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
    FROM shingled d LEFT JOIN sets t ON t.s = d.s LEFT JOIN named c ON c.id = t.id
"""

#: All phrases of up to five words within pieces, counted by language; every cut of the frequent ones.
COLLOCATIONS = r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ), words AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
    f AS MATERIALIZED (
        SELECT lang, k, phrase, count(*) AS f
        FROM (
            SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
            FROM words, range(1, 6) AS sizes(k)
        ) GROUP BY lang, k, phrase HAVING count(*) >= 100
    ), candidates AS MATERIALIZED (
        SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1
    ), inside AS (
        SELECT DISTINCT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, a
        FROM candidates, range(2, 5) AS sizes(size), range(1, 5) AS places(i) WHERE size < k AND i + size - 1 <= k
    ), kept AS (
        SELECT c.* FROM candidates c
        WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.a >= 100 * c.a)
    ), cuts AS (
        SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, n, cut,
               CAST((1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
        FROM kept c, range(1, 5) AS places(cut), f x, f y, totals t
        WHERE cut < c.k AND t.lang = c.lang
          AND x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut], ' ')
          AND y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1:], ' ')
    ), scored AS (
        SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM scored QUALIFY rank <= 2000
"""

ANSWERS = {
    "op13_collocations": COLLOCATIONS,
    "op6_jaccard_join": SIMILAR,
    "op10_exact_dedup": r"""
        WITH rows AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        ), best AS (
            SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM rows WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST)
        )
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM best
    """,
}
