"""TF-IDF retrieval over character n-grams inside word boundaries."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import stored

#: Vocabulary size, results a query, and n-gram lengths.
MAX_FEATURES, TOP_K, LENGTHS = 15000, 5, (3, 4)
#: Targets in a dense block, and queries broadcast at once.
BLOCK, PASS = 256, 20000


def _grams(texts: DataFrame) -> DataFrame:
    """(id, term, tf) of (id, text): n-grams of each word with a blank at both ends; a shorter word yields itself once."""
    words = F.filter(F.split(F.trim(F.regexp_replace(F.lower("text"), r"(?U)\s+", " ")), " "), lambda w: w != "")

    def of(word, n):
        padded = F.concat(F.lit(" "), word, F.lit(" "))
        runs = F.transform(F.sequence(F.lit(1), F.length(padded) - (n - 1)), lambda i: F.substring(padded, i, F.lit(n)))
        whole = F.when(F.lit(n == LENGTHS[0]), F.array(padded)).otherwise(F.array().cast("array<string>"))
        return F.when(F.length(padded) >= n, runs).otherwise(whole)

    terms = F.flatten(F.transform(words, lambda w: F.concat(*[of(w, n) for n in LENGTHS])))
    return texts.select("id", F.explode(terms).alias("term")).groupBy("id", "term").agg(F.count("*").alias("tf"))


def _unit(weights: DataFrame) -> DataFrame:
    norm = weights.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weights.join(norm, "id").select("id", "term", (F.col("w") / F.col("norm")).alias("w"))


def _units(rows: DataFrame) -> DataFrame:
    """(id, texts) of (id, text): the texts of an id count together."""
    return rows.groupBy("id").agg(F.array_sort(F.collect_list("text")).alias("texts"))


def _classes(units: DataFrame) -> DataFrame:
    """(class, texts, copies): units with the same texts are one class, named by its least id."""
    return units.groupBy("texts").agg(F.min("id").alias("class"), F.count("*").alias("copies"))


def _texts(classes: DataFrame) -> DataFrame:
    return classes.select(F.col("class").alias("id"), F.explode("texts").alias("text"))


def fit(classes: DataFrame, n: int, max_features: int = MAX_FEATURES) -> tuple[DataFrame, DataFrame]:
    """((term, idf) of the vocabulary, unit weights (id, term, w) of the classes) of n targets.

    The vocabulary keeps the terms with most occurrences in all copies, ties by term: a
    partial aggregate and a top-k, never a sort of all rows.
    """
    grams = _grams(_texts(classes))
    weighed = grams.join(classes.select(F.col("class").alias("id"), "copies"), "id")
    counted = weighed.groupBy("term").agg(F.sum(F.col("tf") * F.col("copies")).alias("total"), F.sum("copies").alias("df"))
    kept = counted.orderBy(F.desc("total"), "term").limit(max_features)
    vocabulary = kept.select("term", (F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1).alias("idf"))
    return vocabulary, _weighted(grams, vocabulary)


def _weighted(grams: DataFrame, vocabulary: DataFrame) -> DataFrame:
    return _unit(grams.join(vocabulary, "term").select("id", "term", ((1 + F.log(F.col("tf").cast("double"))) * F.col("idf")).alias("w")))


def _packed(weights: DataFrame, places: dict[str, int]) -> DataFrame:
    """(id, terms, ws): each text's weights as arrays, terms by their place in the vocabulary."""
    table = weights.sparkSession.createDataFrame(list(places.items()), "term string, place int")
    rows = weights.join(F.broadcast(table), "term").groupBy("id").agg(F.collect_list(F.struct("place", "w")).alias("x"))
    return rows.select("id", F.col("x.place").alias("terms"), F.col("x.w").alias("ws"))


class _Best:
    """The best k targets of each query over blocks of targets."""

    def __init__(self, n: int, k: int):
        self.k, self.floor = k, np.zeros(n)
        self.q, self.s, self.ids = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, object)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        q, c = np.nonzero((scores >= self.floor[:, None]) & (scores > 0))
        q, s, names = np.concatenate([self.q, q]), np.concatenate([self.s, scores[q, c]]), np.concatenate([self.ids, ids[c]])
        rank = np.unique(names.astype(str), return_inverse=True)[1] if len(names) else np.zeros(0, np.int64)
        order = np.lexsort((rank, -s, q))
        place = np.arange(len(order)) - np.searchsorted(q[order], q[order], side="left")
        keep = order[place < self.k]
        self.q, self.s, self.ids = q[keep], s[keep], names[keep]
        last = np.flatnonzero(place[place < self.k] == self.k - 1)
        self.floor[self.q[last]] = self.s[last]


def top_k(queries: DataFrame, targets: DataFrame, k: int = TOP_K, max_features: int = MAX_FEATURES) -> DataFrame:
    """(s1_id, cand_id, cosine, rank): the best targets of each query (id, text) with a common term, ties by id.

    Equal texts are scored once: classes of them meet, and a query's best k targets lie in
    its best k classes by (score, least id), of each of which the first k ids can count.
    Scores come from products of blocks: target classes stay where they are as dense blocks
    over the vocabulary (its size is a parameter), query classes are broadcast in passes of
    PASS rows. Rows of pairs that share a term are never made, however common the term.
    """
    spark = targets.sparkSession
    asking, units = stored(_units(queries)), stored(_units(targets))
    classes, ask_classes = stored(_classes(units)), stored(_classes(asking))
    vocabulary, index = fit(classes, targets.count(), max_features)
    known = vocabulary.collect()
    places = {r["term"]: i for i, r in enumerate(known)}
    idf = spark.createDataFrame([(r["term"], r["idf"]) for r in known], "term string, idf double")
    asked = stored(_packed(_weighted(_grams(_texts(ask_classes)), idf), places))
    passes = max(1, -(-asked.count() // PASS))
    width, found = len(places), None
    tasks = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), classes.count() // (2 * BLOCK)))
    packed = stored(_packed(index, places).repartition(tasks, "id"))
    for p in range(passes):
        own = [(r["id"], np.array(r["terms"], np.int64), np.array(r["ws"])) for r in asked.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == p).toLocalIterator()]
        shipped = spark.sparkContext.broadcast(own)

        def run(batches, shipped=shipped):
            rows = shipped.value
            best = _Best(len(rows), k)
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(at, BLOCK).to_pydict()
                    dense = np.zeros((width, len(part["id"])))
                    for c, (terms, ws) in enumerate(zip(part["terms"], part["ws"])):
                        dense[terms, c] = ws
                    scores = np.stack([ws @ dense[terms] for _, terms, ws in rows]) if rows else np.zeros((0, len(part["id"])))
                    best.add(np.round(scores, 9), np.array(part["id"], object))
            names = np.array([i for i, _, _ in rows], object)
            yield pa.RecordBatch.from_arrays([pa.array(names[best.q].tolist(), pa.string()), pa.array(best.ids.tolist(), pa.string()), pa.array(best.s)], names=["asking", "class", "cosine"])

        part = packed.mapInArrow(run, "asking string, class string, cosine double")
        found = part if found is None else found.unionByName(part)
    first = units.withColumn("n", F.row_number().over(W.partitionBy("texts").orderBy("id"))).where(F.col("n") <= k).select("texts", F.col("id").alias("cand_id"))
    first = first.join(classes.select("texts", "class"), "texts").drop("texts")
    places_of = W.partitionBy("asking").orderBy(F.desc("cosine"), "class")
    by_class = found.withColumn("n", F.row_number().over(places_of)).where(F.col("n") <= k).join(first, "class")
    order = W.partitionBy("asking").orderBy(F.desc("cosine"), "cand_id")
    ranked = by_class.select("asking", "cand_id", "cosine", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)
    own = asking.join(ask_classes.select("texts", F.col("class").alias("asking")), "texts").select("asking", F.col("id").alias("s1_id"))
    return own.join(ranked, "asking").select("s1_id", "cand_id", "cosine", "rank")
