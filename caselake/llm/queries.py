"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm.alignment import aligned_tokens
from caselake.llm.htmlcrf import extract_main_text, fitted
from caselake.llm.imatch import fingerprints
from caselake.llm.langid import fit, identify, learnable
from caselake.llm.lines import drop_shared_lines
from caselake.llm.minhash import Near, near_duplicates
from caselake.llm.packing import pack
from caselake.llm.personal import personal_data
from caselake.llm.pieces import decode_pieces, encode_pieces
from caselake.llm.rangecoder import read_ids, write_ids
from caselake.llm.revisit import resolve_revisits
from caselake.llm.rows import utf8_sha256
from caselake.llm.spherical import near_vectors
from caselake.llm.variants import spelling_variants
from caselake.session import fresh_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_shared_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", utf8_sha256(F.col("text")).alias("kept_sha256"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, Near(words=3, percent=85)).drop("version")


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file lies; the package is the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs, vocabulary("word_bpe_49k.json"), end_id=2)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = docs.select("doc_id", (~learnable(F.col("doc_id"))).alias("held_out"), "text")
    return identify(held_out, fit(docs.select("doc_id", "text", "lang"))).drop("text")


def captures(pages: DataFrame) -> DataFrame:
    """Captures of every page: itself, a revisit a week later, and the front page of its site.

    One front page in four is a full response, the others revisits, so the
    captures of a large site's front page are many. Every fifth revisit of a
    page names another ETag and every seventh none.
    """
    page, url = F.col("page_id"), F.col("url")
    time = F.lit(1_700_000_000) + page * 60
    etag = F.md5(F.coalesce("html", F.lit("")))
    site = F.regexp_extract(url, "^([a-z]+://[^/]*)", 1)
    edition = F.concat(F.lit("v"), F.floor(page / 400).cast("string"))

    def record(number: int, url: Column, time: Column, kind: Column, etag: Column, payload: Column) -> Column:
        full = F.map_from_arrays(
            F.array(F.lit("Content-Type"), F.lit("Content-Length"), F.lit("ETag")),
            F.array(F.lit("text/html"), F.octet_length(payload).cast("string"), etag),
        )
        short = F.map_from_arrays(
            F.array(F.lit("Date"), F.lit("Content-Length"), F.lit("Set-Cookie")),
            F.array(time.cast("string"), F.lit("0"), F.lit("id")),
        )
        return F.struct(
            (page * 3 + number).alias("record_id"),
            url.alias("url"),
            time.alias("captured_at"),
            kind.alias("kind"),
            etag.alias("etag"),
            F.lit(None).cast("string").alias("last_modified"),
            F.when(kind == "response", full).otherwise(short).alias("headers"),
            F.when(kind == "response", payload).alias("payload"),
        )

    again = F.when(page % 5 == 0, F.lit("other")).when(page % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("W/"), etag))
    front = F.when(page % 4 == 0, F.lit("response")).otherwise(F.lit("revisit"))
    every = F.array(
        record(0, url, time, F.lit("response"), etag, F.coalesce("html", F.lit(""))),
        record(1, F.concat(url, F.lit("#again")), time + 7 * 86_400, F.lit("revisit"), again, F.lit("")),
        record(2, F.concat(F.upper(site), F.lit("/")), time, front, edition, F.concat(site, edition)),
    )
    return pages.select(F.inline(every))


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_revisits(captures(table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.select(
        "record_id",
        "page",
        "status",
        "response_id",
        F.array_join(lines, "\n").alias("headers"),
        F.sha2(F.col("payload").cast("binary"), 256).alias("payload_sha256"),
    )


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "stage-token-ids")
    write_ids(table(spark, sf_dir, "documents").select("doc_id", "text"), path, vocabulary("byte_bpe_50k.json"), end_id=0)
    return read_ids(spark, path)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = vocabulary("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = decode_pieces(encode_pieces(docs, model), model, into="decoded")
    return decoded.select(
        "doc_id",
        F.size("pieces").cast("bigint").alias("n_pieces"),
        F.xxhash64("pieces").alias("pieces_xxhash64"),
        utf8_sha256(F.col("decoded")).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages, fitted(pages)).select("page_id", "url", "text", "n_chars")


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_email",
        "n_ip",
        "n_card",
        "n_phone",
        utf8_sha256(F.array_join("base_spans", ",")).alias("base_sha256"),
        F.array_join("spans", ",").alias("spans"),
    )


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return aligned_tokens(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def queries() -> dict[str, Query]:
    every = (
        op1_line_dedup,
        op2_minhash_near_dedup,
        op3_packing,
        op4_language_id,
        op5_warc_revisits,
        op6_fingerprints,
        op7_token_ids,
        op8_sentencepiece,
        op9_html_extraction,
        op10_embedding_near_dedup,
        op11_spelling_variants,
        op12_pii,
        op13_cross_tokenizer_alignment,
    )
    return {f.__name__: f for f in every}
