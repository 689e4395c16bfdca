"""Blocking recall, entity-level F0.5, threshold search and error analysis."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import stored

# Blend weights and thresholds of the coarse search, and the fine steps.
ALPHAS = [0.0, 0.2, 0.35, 0.5, 0.65, 0.8, 1.0]
TAU_LOW, TAU_STEP, TAU_COUNT = 0.50, 0.02, 24
FINE_ALPHA, FINE_TAU, FINE_STEP = 0.1, 0.04, 0.005
TAU_LEAST, TAU_MOST = 0.40, 0.99


def joined_sets(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """(s1_id, matches, ids) for every truth row; a missing prediction is empty. predicted: (s1_id, ids)."""
    none = F.array().cast("array<string>")
    return truth.join(predicted.select("s1_id", "ids"), "s1_id", "left").withColumn("ids", F.coalesce("ids", none))


def as_sets(pairs: DataFrame) -> DataFrame:
    """(s1_id, ids) of pairs (s1_id, cand_id); a query's ids are at most its ranked candidates."""
    return pairs.groupBy("s1_id").agg(F.array_sort(F.collect_set("cand_id")).alias("ids"))


def blocking_recall(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row: recall over true pairs, and candidates per non-singleton entity and per entity of the truth."""
    both = joined_sets(truth, as_sets(candidates)).select(F.size("matches").alias("n"), F.size(F.array_intersect("matches", "ids")).alias("hit"), F.size("ids").alias("c"))
    real = F.col("n") > 0
    sums = both.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.coalesce(F.sum(F.when(real, F.col("hit"))), F.lit(0)).alias("kept"),
        F.coalesce(F.sum(F.when(real, F.col("c"))), F.lit(0)).alias("c"), F.count_if(real).alias("entities"), F.count("*").alias("rows"),
    )
    return sums.select(
        F.when(F.col("total") > 0, F.round(F.col("kept") / F.col("total"), 5)).otherwise(1.0).alias("blocking_recall"),
        F.col("total").alias("total_true_pairs"), F.col("kept").alias("retained_pairs"), (F.col("total") - F.col("kept")).alias("missed_pairs"),
        F.when(F.col("entities") > 0, F.round(F.col("c") / F.col("entities"), 2)).otherwise(0.0).alias("avg_candidates"),
        F.when(F.col("rows") > 0, F.round(F.col("c") / F.col("rows"), 2)).otherwise(0.0).alias("avg_candidates_all_rows"),
    )


def recall_by(truth: DataFrame, candidates: DataFrame, queries: DataFrame) -> DataFrame:
    """Recall by target source and query country, with totals (a rollup over both)."""
    pairs = truth.select("s1_id", F.explode("matches").alias("cand_id"))
    found = candidates.select("s1_id", "cand_id", F.lit(1).alias("hit"))
    rows = pairs.join(found, ["s1_id", "cand_id"], "left").join(queries.select(F.col("entity_id").alias("s1_id"), "country"), "s1_id")
    return (
        rows.withColumn("target_source", F.substring("cand_id", 1, 2)).rollup("target_source", "country")
        .agg(F.count("*").alias("true_pairs"), F.count("hit").alias("found"), F.round(F.count("hit") / F.count("*"), 5).alias("recall"))
    )


def candidate_audit(candidates: DataFrame, n_queries: DataFrame, n_targets: DataFrame) -> DataFrame:
    """One row: median, p95, p99 of candidates a query with any, and the share of all pairs avoided."""
    sizes = candidates.groupBy("s1_id").agg(F.count("*").alias("c"))
    totals = n_queries.agg(F.count("*").alias("q")).crossJoin(n_targets.agg(F.count("*").alias("t")))  # one row
    stats = sizes.agg(*[F.percentile("c", F.lit(p)).alias(name) for name, p in (("median", 0.5), ("p95", 0.95), ("p99", 0.99))], F.sum("c").alias("pairs"))
    return stats.crossJoin(totals).select("median", "p95", "p99", "pairs", F.round(1 - F.col("pairs") / (F.col("q") * F.col("t")), 9).alias("reduction_ratio"))


def f05(n_true: Column, n_pred: Column, hit: Column) -> tuple[Column, Column, Column]:
    """Precision, recall and F0.5 of an entity from the sizes of truth, prediction and their intersection."""
    p = F.when(n_pred == 0, 1.0).when(n_true == 0, 0.0).otherwise(hit / n_pred)
    r = F.when(n_true == 0, 1.0).when(n_pred == 0, 0.0).otherwise(hit / n_true)
    return p, r, F.when((p > 0) & (r > 0), 1.25 * p * r / (0.25 * p + r)).otherwise(0.0)


def entity_f05(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """(s1_id, precision, recall, f05) of every truth row."""
    both = joined_sets(truth, predicted)
    p, r, f = f05(F.size("matches"), F.size("ids"), F.size(F.array_intersect("matches", "ids")))
    return both.select("s1_id", p.alias("precision"), r.alias("recall"), f.alias("f05"))


def macro_f05(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """One row: means over all truth rows, zeros for an empty truth."""
    names = {"precision": "macro_precision", "recall": "macro_recall", "f05": "macro_f05"}
    return entity_f05(truth, predicted).agg(*[F.coalesce(F.avg(a), F.lit(0.0)).alias(b) for a, b in names.items()], F.count("*").alias("total_entities"))


def _entities(truth: DataFrame, scored: DataFrame, least: float | None = None) -> DataFrame:
    """(n, p1, p2, label): the scored pairs of each entity as lists, beside its number of true matches.

    least: pairs with both scores below it go; no blend with a weight in [0, 1] reaches it.
    """
    pairs = scored.select("s1_id", F.col("p1").cast("double").alias("p1"), F.col("p2").cast("double").alias("p2"), F.coalesce(F.col("label").cast("double"), F.lit(0.0)).alias("label")).where("p1 is not null and p2 is not null")
    pairs = pairs if least is None else pairs.where(F.greatest("p1", "p2") >= least - 1e-8)
    lists = pairs.groupBy("s1_id").agg(F.collect_list(F.struct("p1", "p2", "label")).alias("x"))
    return lists.join(truth.select("s1_id", F.size("matches").alias("n")), "s1_id").where("n is not null").select("n", "x.p1", "x.p2", "x.label")


def _round9(x: np.ndarray) -> np.ndarray:
    """Nine decimals, halves away from zero, as SQL rounds."""
    return np.copysign(np.floor(np.abs(x) * 1e9 + 0.5) / 1e9, x)


def _gained(entities: DataFrame, grid: list) -> DataFrame:
    """(ai, ti, gain): summed over the entities with a prediction, F0.5 less what it would be without one.

    A pair is predicted by all thresholds up to its blended score, so each pair is placed once
    a weight, and the entity's counts at every threshold are sums from the highest place down.
    """
    by_alpha: dict = {}
    for g in grid:
        by_alpha.setdefault(g["alpha"], []).append((float(_round9(np.float64(g["tau"]))), g["ai"], g["ti"]))
    plan = [(alpha, np.array([t for t, _, _ in own]), [a for _, a, _ in own], [t for _, _, t in own]) for alpha, own in ((alpha, sorted(own)) for alpha, own in by_alpha.items())]

    def run(batches):
        gains = [np.zeros(len(taus)) for _, taus, _, _ in plan]
        for batch in batches:
            n, lists = batch.column(0).to_numpy(zero_copy_only=False).astype(float)[:, None], [batch.column(k) for k in (1, 2, 3)]
            p1, p2, label = (x.flatten().to_numpy(zero_copy_only=False) for x in lists)
            entity = np.repeat(np.arange(len(n)), lists[0].value_lengths().to_numpy(zero_copy_only=False))
            for k, (alpha, taus, _, _) in enumerate(plan):
                width = len(taus) + 1
                place = entity * width + np.searchsorted(taus, _round9(alpha * p1 + (1 - alpha) * p2), side="right")
                pred, hit = (np.bincount(place, w, len(n) * width).reshape(-1, width)[:, ::-1].cumsum(axis=1)[:, ::-1][:, 1:] for w in (None, label))
                right = (hit > 0) & (n > 0)
                p, r = np.where(right, hit, 1.0) / np.maximum(pred, 1), np.where(right, hit, 1.0) / np.maximum(n, 1)
                f = np.where(right, 1.25 * p * r / (0.25 * p + r), 0.0)
                gains[k] += np.where(pred > 0, f - (n == 0), 0.0).sum(axis=0)
        for (_, _, ai, ti), gain in zip(plan, gains):
            yield pa.RecordBatch.from_arrays([pa.array(ai, pa.int32()), pa.array(ti, pa.int32()), pa.array(gain)], names=["ai", "ti", "gain"])

    return entities.mapInArrow(run, "ai int, ti int, gain double").groupBy("ai", "ti").agg(F.sum("gain").alias("gain"))


def _macro(truth: DataFrame, entities: DataFrame, grid: DataFrame) -> DataFrame:
    gained = _gained(entities, grid.collect())
    alone = truth.select(F.size("matches").alias("n")).agg(F.count_if(F.col("n") == 0).alias("empty"), F.count("*").alias("rows"))
    every = F.broadcast(grid).join(gained, ["ai", "ti"], "left").crossJoin(alone)
    return every.select("ai", "ti", "alpha", "tau", F.round((F.coalesce("gain", F.lit(0.0)) + F.col("empty")) / F.greatest("rows", F.lit(1)), 9).alias("macro_f05"))


def grid_scores(truth: DataFrame, scored: DataFrame, grid: DataFrame) -> DataFrame:
    """(ai, ti, alpha, tau, macro_f05) over all truth rows. scored: (s1_id, p1, p2, label); grid: (ai, ti, alpha, tau).

    The grid has a few hundred rows by construction and goes to every task. Entities without
    a prediction contribute by the grid-wide difference to all rows, and an entity's pairs
    meet the grid in one task, which returns sums: neither pairs nor entities times grid move.
    """
    bounds = grid.agg(F.min("alpha"), F.max("alpha"), F.min("tau")).first()
    least = bounds[2] if bounds[0] is not None and 0 <= bounds[0] and bounds[1] <= 1 else None
    return _macro(truth, _entities(truth, scored, least), grid)


def _grid(spark, alphas: list[float], taus: list[float]) -> DataFrame:
    return spark.createDataFrame([(i, j, float(a), float(t)) for i, a in enumerate(alphas) for j, t in enumerate(taus)], "ai int, ti int, alpha double, tau double")


def coarse_grid(spark) -> DataFrame:
    return _grid(spark, ALPHAS, [TAU_LOW + TAU_STEP * k for k in range(TAU_COUNT)])


def threshold_search(truth: DataFrame, scored: DataFrame) -> DataFrame:
    """One row: best_alpha, best_threshold, best_val_macro_f05 after the coarse and the fine pass; the first best wins."""
    spark = truth.sparkSession
    entities = stored(_entities(truth, scored, TAU_LEAST))  # both passes read them; their weights are in [0, 1]
    first = _macro(truth, entities, coarse_grid(spark)).orderBy(F.desc("macro_f05"), "ai", "ti").first()
    best = (first["macro_f05"], first["alpha"], first["tau"])
    low, high = max(TAU_LEAST, best[2] - FINE_TAU), min(TAU_MOST, best[2] + FINE_TAU)
    taus = [low + FINE_STEP * k for k in range(round((high - low) / FINE_STEP) + 1)]
    fine = _macro(truth, entities, _grid(spark, [max(0.0, best[1] - FINE_ALPHA), best[1], min(1.0, best[1] + FINE_ALPHA)], taus)).orderBy(F.desc("macro_f05"), "ai", "ti").first()
    if fine["macro_f05"] > best[0]:
        best = (fine["macro_f05"], fine["alpha"], fine["tau"])
    return spark.createDataFrame([(round(best[1], 4), round(best[2], 4), round(best[0], 5))], "best_alpha double, best_threshold double, best_val_macro_f05 double")


def error_analysis(truth: DataFrame, predicted: DataFrame, samples: int = 15) -> DataFrame:
    """(kind, entities, sample): entities with false positives, false negatives and singleton errors, first ids of each."""
    both = joined_sets(truth, predicted)
    wrong, missed, single = F.size(F.array_except("ids", "matches")) > 0, F.size(F.array_except("matches", "ids")) > 0, F.size("matches") == 0
    kinds = F.array_compact(F.array(F.when(single & wrong, F.lit("singleton_error")), F.when(~single & wrong, F.lit("false_positive")), F.when(missed, F.lit("false_negative"))))
    rows = both.select("s1_id", F.explode(kinds).alias("kind"))
    ranked = rows.withColumn("n", F.row_number().over(W.partitionBy("kind").orderBy("s1_id")))
    first = ranked.where(F.col("n") <= samples).groupBy("kind").agg(F.array_join(F.array_sort(F.collect_list("s1_id")), ",").alias("sample"))
    return rows.groupBy("kind").agg(F.count("*").alias("entities")).join(first, "kind")
