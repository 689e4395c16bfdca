"""Linking a stream of query records against a stored target index."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.blocking import MAX_CANDIDATES, block_keys, bucket_pairs, capped, normalised, ranked
from ..sources.records import CANDIDATES, MATCHES, RECORD, write_lists
from ..sources.shared import stored


def record_stream(spark: SparkSession, folder: str) -> DataFrame:
    """New TSV files of a folder as a stream of records."""
    schema = ", ".join(f"{c} string" for c in RECORD)
    return spark.readStream.schema(schema).option("sep", "\t").option("header", True).option("quote", "").csv(folder)


def link_stream(records: DataFrame, targets: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, keep: int = MAX_CANDIDATES) -> StreamingQuery:
    """Start linking: keys are stateless, each micro-batch joins the static index and ranks inside the batch.

    `sink` gets (s1_id, cand_id, rule, rank) and the batch number. No state is kept
    between batches, so late or repeated records are linked when they arrive.
    """
    index = capped(block_keys(targets))

    def one(batch: DataFrame, number: int) -> None:
        filled = batch.select(*[F.coalesce(c, F.lit("")).alias(c) for c in RECORD])
        sink(ranked(bucket_pairs(block_keys(normalised(filled)), index), keep), number)

    return records.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def result_stream(records: DataFrame, targets: DataFrame, linker, folder: str, checkpoint: str, profile: str = "index") -> StreamingQuery:
    """Start linking with a model: each micro-batch writes its lists of matches and of candidates.

    The lists of batch n are below folder/matching_results.tsv/batch=n and
    folder/candidate_pairs.tsv/batch=n, so a batch that is run again replaces its own.
    """
    from ..plans.jobs import result_lists, scored_pairs

    def one(batch: DataFrame, number: int) -> None:
        filled = batch.select(*[F.coalesce(c, F.lit("")).alias(c) for c in RECORD])
        queries = stored(normalised(filled, whole=True))
        ids = queries.select(F.col("entity_id").alias("s1_id")).where("s1_id <> ''").distinct()
        matches, found = result_lists(linker, ids, stored(scored_pairs(linker, queries, targets, profile)))
        write_lists(matches, f"{folder}/matching_results.tsv/batch={number}", MATCHES)
        write_lists(found, f"{folder}/candidate_pairs.tsv/batch={number}", CANDIDATES)

    return records.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
