"""The registered queries of this subpackage: each applies its operator to a whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrata.llm import archive, decontaminate, html_text, language, merkle, minhash, periodic, personal, pieces, quality, repeats, token_files, urls
from narrata.llm.common import table
from narrata.llm.sql import TWINS  # noqa: F401
from narrata.session import staging_root

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def new_folder(spark: SparkSession, kind: str) -> str:
    return f"{staging_root(spark)}/{kind}-{uuid.uuid4().hex}"


@query
def op1_token_files(spark, sf_dir):
    path = new_folder(spark, "tokens")
    token_files.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.index(spark, path)


@query
def op2_web_archive(spark, sf_dir):
    path = new_folder(spark, "archive")
    archive.write(table(spark, sf_dir, "pages"), path)
    return archive.listing(spark, path)


@query
def op4_quality(spark, sf_dir):
    columns = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept quality".split()
    return quality.judge(table(spark, sf_dir, "documents")).select(*columns)


@query
def op8_url_filter(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))


@query
def op5_pieces(spark, sf_dir):
    return pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op10_decontaminate(spark, sf_dir):
    found = decontaminate.screen(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query
def op7_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    languages, model = language.fit(docs)
    found = language.identify(docs.select("doc_id", "text"), languages, model)
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op9_near_duplicates(spark, sf_dir):
    return minhash.groups(table(spark, sf_dir, "documents"))


@query
def op6_repeats(spark, sf_dir):
    return repeats.digests(table(spark, sf_dir, "documents"))


@query
def op3_html_text(spark, sf_dir):
    return html_text.texts(table(spark, sf_dir, "pages"))


@query
def op11_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    drawn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    found = merkle.manifest(docs, changed={"n_chars": F.when(drawn, more).otherwise(F.col("n_chars").cast("decimal(21,0)"))})
    folded = merkle.folded(F.col("other"), F.col("steps"))
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("steps")).alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


@query
def op12_personal_data(spark, sf_dir):
    found = personal.find(table(spark, sf_dir, "documents"))
    said = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[number(k) for k in personal.KINDS], F.sha2(said("base"), 256).alias("base_sha256"), said("spans").alias("spans"))


@query
def op13_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return periodic.digests(periodic.runs(docs.select("doc_id", periodic.planted(F.col("doc_id"), F.col("text")).alias("text"))))
