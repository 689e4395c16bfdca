"""Preparing a corpus: quality rules, line dedup, near-dedup, source mix, BPE coding.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All
but the last return the columns of documents; n_chars is brought up to date where the
text changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm import bpe_transducer, line_templates, minhash_dedup, quality_rules, source_mix
from matchloom.llm.shared import documents, stored, whole_row

#: Near copies share four fifths of their five-word shingles.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the certified cutoffs keep.

    Null and empty texts have no words and go; rows are judged one by one, also those with a
    null or repeated id; extra columns pass, whatever their names; an empty table stays empty.
    """
    model = quality_rules.fit(stored(quality_rules.rated(docs)), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_rules.keep_good(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of recurring templates, but in the template's first document.

    Null texts stay null; rows with one id are one document, those without an id another; a
    text that loses all lines becomes empty; extra columns pass, whatever their names.
    """
    cut = line_templates.dropped(docs)
    changed = F.when(F.col(f"`{cut.columns[-1]}`") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType)).select([F.col(f"`{c}`") for c in docs.columns])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that with the least id (null ids last, then the first row).

    Rows are told apart by a number of their own, so repeated rows and ids leave one row, and
    a copy without an id goes too. Texts without words are in no group and stay.
    """
    rows = stored(docs.select(F.monotonically_increasing_id().alias("_row"), whole_row(docs).alias("_in")))
    key = F.struct(F.col("_in.doc_id").isNull().alias("none"), F.coalesce("_in.doc_id", F.lit(0)).cast("long").alias("id"), F.col("_row").alias("row"))
    found = stored(minhash_dedup.linked(rows.select(key.alias("_key"), F.col("_in.text").alias("text")), "_key", "text", n=NEAR_WORDS, percent=NEAR_PERCENT))
    gone = found.where("not kept").select(F.col("_key.row").alias("_gone"))
    return rows.join(gone, F.col("_row") == F.col("_gone"), "left_anti").select("_in.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it.

    Texts without words are not taken; null sources are one source; rows with one id share
    their fate; extra columns pass, whatever their names.
    """
    return source_mix.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids, decoded_sha256): ids as little-endian unsigned 32-bit integers.

    Null texts have no ids; every row is encoded by itself; other columns are not returned.
    """
    import public_tokenizers

    coded = bpe_transducer.transcode(docs.select(F.struct("doc_id", "source").alias("_row"), "text"), public_tokenizers.path("word_bpe_49k.json"), id_col="_row")
    return coded.select("_row.doc_id", "_row.source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("lines", lines), ("near", near), ("mix", mix), ("encode", encode)]

#: SQL can't express the line templates, the MinHash groups and the encoding; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
