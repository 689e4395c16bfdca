"""Mixing sources to target weights with hash-threshold histograms.

Targets: sources by code point (null last) weigh 5, 2, 1, repeating, and share all words
by weight; a target stops at CAP times its source's size and the excess is reshared by
weight. That is water-filling: the capped sources are those with the smallest
size / weight, found with running sums over the (few) source totals.

Selection: a target is some whole epochs of its source plus a rest. Every document has a
fixed 60-bit hash of its id; per source, words are summed by the hash's leading 12 bits,
a running sum finds the bucket in which the rest is reached, and only this boundary
bucket is refined by the next 12 bits, twice. Documents whose leading 36 bits are below
the limit are taken once more. No documents are sorted; only (source, bucket) sums move.
Limits of a larger rest lie above those of a smaller one, so mixes are nested.

Cases: null sources form one source, the last; a null text has size 0 and is taken 0
times; a null id hashes like an empty one; rows with the same id share their hash, so
they are taken together; very long texts are counted whole; empty tables give empty results;
extra columns pass through `mixed` unchanged and are ignored elsewhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import documents, stored, whole_row

#: Weights by rank of the source, and the most that is taken of a source and a document.
WEIGHTS = (5, 2, 1)
CAP = 3
#: Bits of the hash in all, in one level of the histogram, and levels.
HASH_BITS, LEVEL_BITS, LEVELS = 60, 12, 3
#: Sources whose figures are broadcast at most (about 60 bytes each); more are joined.
BROADCAST_SOURCES = 1 << 16

_WORD = r"[^\x20\x09-\x0D]+"
_REST_BITS = HASH_BITS - LEVEL_BITS * LEVELS


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows with _key (the source, never null), _size (words) and _prefix (leading bits of the id's hash)."""
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    return docs.withColumns(
        {
            "_key": F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")),
            "_size": F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(_WORD)), F.lit(0)).cast("long"),
            "_prefix": F.shiftright(F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long"), _REST_BITS),
        }
    )


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(_key, source_size, target) by source, from rows with _key and _size."""
    totals = rows.groupBy("_key").agg(F.sum("_size").alias("source_size"))
    by_code = W.orderBy(F.col("_key") == "", "_key")
    table = F.array(*[F.lit(w) for w in weights])
    ranked = totals.select("*", F.get(table, (F.row_number().over(by_code) - 1) % len(weights)).alias("w"))
    filling = W.orderBy(F.col("source_size") / F.col("w"), "_key")
    earlier, whole = filling.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    capped = F.coalesce(F.sum(cap * F.col("source_size")).over(earlier), F.lit(0))
    left = F.sum("w").over(whole) - F.coalesce(F.sum("w").over(earlier), F.lit(0))
    stepped = ranked.select("*", F.row_number().over(filling).alias("n"), (F.sum("source_size").over(whole) - capped).alias("words"), left.alias("left"))
    free = F.col("words") * F.col("w") <= cap * F.col("source_size") * F.col("left")  # this source would not exceed its cap
    level = F.min(F.when(free, F.struct("n", "words", "left"))).over(whole)
    share = level["words"] * F.col("w") / level["left"]
    return stepped.select("_key", "source_size", F.least(share, cap * F.col("source_size").cast("double")).alias("target"))


def limits(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(_key, source_size, target, epochs, limit) by source; rows below the limit are taken once more than epochs."""
    goal = targets(rows, weights, cap).withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    goal = stored(goal.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    bound = goal.select(F.col("_key").alias("_k"), "rest", F.lit(0).cast("long").alias("at"))
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        here = rows.select("_key", "_size", "_prefix").join(bound, (F.col("_key") == F.col("_k")) & (F.shiftright("_prefix", shift + LEVEL_BITS) == F.col("at")))
        sums = here.groupBy("_k", "rest", F.shiftright("_prefix", shift).alias("bucket")).agg(F.sum("_size").alias("words"))
        ordered = sums.withColumn("upto", F.sum("words").over(W.partitionBy("_k").orderBy("bucket")))
        first = ordered.where((F.col("upto") >= F.col("rest")) & (F.col("rest") > 0)).groupBy("_k").agg(F.min_by(F.struct("bucket", "words", "upto", "rest"), "bucket").alias("b"))
        bound = stored(first.select("_k", (F.col("b.rest") - F.col("b.upto") + F.col("b.words")).alias("rest"), F.col("b.bucket").alias("at"), F.col("b.words").alias("words")))
    nearer = (F.col("rest") * 2 >= F.col("words")).cast("long")  # the last bucket itself: whichever is nearer
    end = bound.select("_k", (F.col("at") + nearer).alias("limit"))
    return goal.join(end, F.col("_key") == F.col("_k"), "left").select("_key", "source_size", "target", "epochs", F.coalesce("limit", F.lit(0)).alias("limit"))


def taken(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    """The rows with their source's figures and copies, how often the mix takes each."""
    named = by_source.withColumnRenamed("_key", "_source_key")
    named = F.broadcast(named) if by_source.count() <= BROADCAST_SOURCES else named
    joined = rows.join(named, F.col("_key") == F.col("_source_key")).drop("_source_key")
    return joined.withColumn("copies", F.col("epochs") + (F.col("_prefix") < F.col("limit")).cast("long"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents as the mix takes them: each row as often as it is taken, columns as they were, whatever their names."""
    named = [F.col(f"`{c}`").alias(f"_{k}") for k, c in (("id", id_col), ("text", text_col), ("source", source_col))]
    rows = keyed(docs.select(whole_row(docs).alias("_in"), *named), "_id", "_text", "_source").select("_in", "_key", "_size", "_prefix")
    by_source = stored(limits(stored(rows.drop("_in"))))
    repeated = taken(rows, by_source).where("_size > 0 and copies > 0")
    return repeated.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("_in.*")


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(keyed(documents(spark, sf_dir)).select("doc_id", "_key", "_size", "_prefix"))
    out = taken(rows, stored(limits(rows)))
    return out.select("doc_id", F.col("_size").alias("size"), "source_size", "target", (F.col("_size") * F.col("copies")).alias("taken"))


def _level_sql(name: str, before: str, shift: int) -> str:
    return f"""
{name}s AS (SELECT r.k, b.rest, r.prefix >> {shift} AS bucket, sum(r.size) AS words FROM rows_ r JOIN {before} b ON r.k = b.k AND (r.prefix >> {shift + LEVEL_BITS}) = b.at GROUP BY ALL),
{name}c AS (SELECT *, sum(words) OVER (PARTITION BY k ORDER BY bucket) AS upto FROM {name}s),
{name} AS (SELECT k, rest - upto + words AS rest, bucket AS at, words FROM {name}c WHERE rest > 0 AND upto >= rest QUALIFY row_number() OVER (PARTITION BY k ORDER BY bucket) = 1)"""


OP6_SQL = f"""
WITH rows_ AS (
  SELECT doc_id, coalesce('=' || source, '') AS k,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {HASH_BITS // 4}))::BIGINT) >> {_REST_BITS} AS prefix
  FROM documents),
totals AS (SELECT k, sum(size)::BIGINT AS source_size FROM rows_ GROUP BY k),
ranked AS (SELECT *, [{', '.join(map(str, WEIGHTS))}][((row_number() OVER (ORDER BY k = '', k) - 1) % {len(WEIGHTS)} + 1)::INT] AS w FROM totals),
stepped AS (SELECT *, row_number() OVER f AS n,
         sum(source_size) OVER () - coalesce(sum({CAP} * source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words,
         sum(w) OVER () - coalesce(sum(w) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_
         FROM ranked WINDOW f AS (ORDER BY source_size::DOUBLE / w, k)),
level AS (SELECT words, left_ FROM stepped WHERE words * w <= {CAP} * source_size * left_ ORDER BY n LIMIT 1),
goal0 AS (SELECT k, source_size, least((level.words * w)::DOUBLE / level.left_::DOUBLE, {CAP} * source_size::DOUBLE) AS target FROM stepped, level),
goal AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM goal0),
b0 AS (SELECT k, target - epochs * source_size AS rest, 0::BIGINT AS at FROM goal),
{_level_sql('b1', 'b0', 24)},
{_level_sql('b2', 'b1', 12)},
{_level_sql('b3', 'b2', 0)}
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN prefix < coalesce(b3.at + CASE WHEN b3.rest * 2 >= b3.words THEN 1 ELSE 0 END, 0) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rows_ JOIN goal ON rows_.k = goal.k LEFT JOIN b3 ON b3.k = rows_.k
"""
