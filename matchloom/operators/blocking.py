"""Normalised records, blocking keys, capped buckets and ranked candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as X

#: Candidates kept for a query record, records kept in a bucket, length of the prefix key.
MAX_CANDIDATES, MAX_BUCKET, PREFIX = 25, 200, 6


def _named(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("basic", X.name_basic(F.col("business_name"))).withColumn("legal", X.name_legal(F.col("basic")))
    rows = rows.withColumns({"compact": X.compact(F.col("legal")), "tokens": X.tokens(F.col("legal"))})
    return rows.withColumn("ngrams", X.ngrams(F.col("compact")))


def _addressed(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("addr", X.address_basic(F.col("business_address")))
    rows = rows.withColumns({"addr_compact": X.compact(F.col("addr")), "addr_tokens": X.tokens(F.col("addr"))})
    return rows.withColumn("addr_ngrams", X.ngrams(F.col("addr_compact")))


def _placed(rows: DataFrame) -> DataFrame:
    address, country = F.col("business_address"), F.col("country")
    return rows.withColumns({"postal": X.postal_code(address, country), "house": X.house_number(address), "state": X.state(address, country)})


def _apart(rows: DataFrame, views: list[str]) -> DataFrame:
    """The same rows, with the views generated: the optimizer merges no later projection with theirs."""
    return rows.select(*[c for c in rows.columns if c not in views], F.inline(F.array(F.struct(*views))))


def normalised(records: DataFrame, whole: bool = False) -> DataFrame:
    """Records with all views of name and address, and the address's components.

    One projection of all views outgrows compiled code. With `whole`, for a caller that
    needs every view, name, address and components are computed one after the other.
    """
    rows = records.select(F.trim("entity_id").alias("entity_id"), *[F.coalesce(c, F.lit("")).alias(c) for c in ("business_name", "business_address", "country")])
    rows = rows.withColumn("source", F.substring("entity_id", 1, 2))
    for step in (_named, _addressed, _placed):
        before = rows.columns
        rows = step(rows)
        if whole:
            rows = _apart(rows, [c for c in rows.columns if c not in before])
    return rows


def distinctive_tokens(tokens: Column, least: int = 4, keep: int = 2) -> Column:
    """The longest tokens that are no stop words, earlier ones first among equals, once each."""
    placed = F.transform(tokens, lambda t, i: F.struct((-F.length(t)).alias("n"), i.alias("i"), t.alias("t")))
    known = F.filter(placed, lambda x: (x["n"] <= -least) & ~x["t"].isin(P.STOP_WORDS))
    return F.array_distinct(F.transform(F.slice(F.array_sort(known), 1, keep), lambda x: x["t"]))


def _keys(profile: str) -> Column:
    """array<struct<rule, block_key>> of a normalised record under a profile."""
    compact, tokens = F.col("compact"), F.col("tokens")
    name0, addr0 = F.coalesce(F.get(tokens, 0), F.lit("")), F.coalesce(F.get("addr_tokens", 0), F.lit(""))

    def one(rule: int, key: Column) -> Column:
        return F.array(F.struct(F.lit(rule).alias("rule"), key.alias("block_key")))

    if profile == "train":
        parts = [
            one(1, F.nullif(F.col("legal"), F.lit(""))),
            one(2, F.when(F.length(compact) >= PREFIX, F.substring(compact, 1, PREFIX))),
            F.transform(distinctive_tokens(tokens), lambda t: F.struct(F.lit(3).alias("rule"), t.alias("block_key"))),
            one(4, F.lower(F.trim(F.col("postal")))),
            one(5, F.when((F.length(name0) >= 3) & F.col("state").isNotNull(), F.concat(F.col("state"), F.lit("_"), name0))),
            one(6, F.when((F.length(addr0) >= 3) & F.col("house").isNotNull(), F.concat(F.col("house"), F.lit("_"), addr0))),
        ]
    elif profile == "index":
        longest = F.array_min(F.transform(tokens, lambda t, i: F.struct((-F.length(t)).alias("n"), i.alias("i"), t.alias("t"))))
        parts = [
            one(1, F.when(F.length("legal") >= 3, F.concat(F.lit("n_"), "legal"))),
            one(2, F.when(F.length(compact) >= 8, F.concat(F.lit("p_"), F.substring(compact, 1, 8)))),
            one(3, F.when(longest["n"] <= -5, F.concat(F.lit("t_"), longest["t"]))),
            one(4, F.concat(F.lit("z_"), "postal")),
            one(5, F.when(F.size(tokens) > 0, F.concat(F.lit("sn_"), "state", F.lit("_"), name0))),
        ]
    else:
        raise ValueError(f"unknown profile {profile}")
    return F.filter(F.concat(*parts), lambda k: k["block_key"].isNotNull())


def block_keys(records: DataFrame, profile: str = "train") -> DataFrame:
    """(rule, block_key, entity_id, source): the inverted index, or the queries' keys."""
    return records.select("entity_id", "source", F.explode(_keys(profile)).alias("k")).select("k.rule", "k.block_key", "entity_id", "source")


def capped(index: DataFrame, cap: int | None = MAX_BUCKET) -> DataFrame:
    """The first records of each bucket, by source and id. Spark keeps `cap` rows a key before the shuffle."""
    if cap is None:
        return index
    arrival = W.partitionBy("rule", "block_key").orderBy("source", "entity_id")
    return index.withColumn("_n", F.row_number().over(arrival)).where(F.col("_n") <= cap).drop("_n")


def bucket_pairs(queries: DataFrame, index: DataFrame) -> DataFrame:
    """(s1_id, cand_id, rule) for each shared key; at most `cap` rows for a query's key."""
    asked = queries.select("rule", "block_key", F.col("entity_id").alias("s1_id"))
    return asked.join(index.select("rule", "block_key", F.col("entity_id").alias("cand_id")), ["rule", "block_key"]).select("s1_id", "cand_id", "rule")


def ranked(pairs: DataFrame, keep: int | None = MAX_CANDIDATES) -> DataFrame:
    """(s1_id, cand_id, rule, rank): distinct pairs with their most specific rule, the first `keep` by (rule, id)."""
    once = pairs.groupBy("s1_id", "cand_id").agg(F.min("rule").alias("rule"))
    order = W.partitionBy("s1_id").orderBy("rule", "cand_id")
    out = once.withColumn("rank", F.row_number().over(order))
    return out if keep is None else out.where(F.col("rank") <= keep)


def candidates(queries: DataFrame, targets: DataFrame, profile: str = "train", cap: int | None = MAX_BUCKET, keep: int | None = MAX_CANDIDATES, lexical: DataFrame | None = None) -> DataFrame:
    """Ranked candidates of normalised query records among normalised targets.

    The train profile caps buckets; the index profile has none. `lexical` adds pairs
    (s1_id, cand_id) of another retriever, ranked after all rules.

    Only a bucket's first `keep` ids can be kept by any query: all others come after
    those of their bucket in the order (rule, id), also where a rule before holds. So no
    key is joined with more than `keep` rows, and the result is that of the whole join.
    """
    caps = [c for c in (cap if profile == "train" else None, keep) if c is not None]
    index = capped(block_keys(targets, profile), min(caps, default=None))
    pairs = bucket_pairs(block_keys(queries, profile), index)
    if lexical is not None:
        pairs = pairs.unionByName(lexical.select("s1_id", "cand_id", F.lit(9).alias("rule")))
    return ranked(pairs, keep)


def fetched(pairs: DataFrame, targets: DataFrame) -> DataFrame:
    """The candidates' records beside the pairs."""
    return pairs.join(targets.withColumnRenamed("entity_id", "cand_id"), "cand_id")


def target_index(sources: list[DataFrame], per_source: int | None = None) -> DataFrame:
    """Targets once by id (first by source, then name), optionally the first rows of each source by id."""
    rows = sources[0]
    for more in sources[1:]:
        rows = rows.unionByName(more)
    first = W.partitionBy("entity_id").orderBy("business_name", "business_address", "country")
    rows = rows.where(F.trim("entity_id") != "").withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    if per_source is not None:
        order = W.partitionBy(F.substring("entity_id", 1, 2)).orderBy("entity_id")
        rows = rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_source).drop("_n")
    return rows


def records_of(records: DataFrame, lists: DataFrame) -> DataFrame:
    """The records whose id is among those of a truth sample (s1_id, ...)."""
    return records.join(lists.select(F.col("s1_id").alias("entity_id")).distinct(), "entity_id", "left_semi")


def sampled_targets(targets: DataFrame, needed: DataFrame, size: int) -> DataFrame:
    """The needed targets (cand_id), and of each source the first size // 2 by id."""
    wanted = needed.select(F.col("cand_id").alias("entity_id")).distinct().withColumn("_needed", F.lit(True))
    order = W.partitionBy(F.substring("entity_id", 1, 2)).orderBy("entity_id")
    first = targets.select("entity_id").withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= size // 2).select("entity_id", F.lit(True).alias("_first"))
    rows = targets.join(wanted, "entity_id", "left").join(first, "entity_id", "left")
    return rows.where(F.coalesce("_needed", F.lit(False)) | F.coalesce("_first", F.lit(False))).drop("_needed", "_first")
