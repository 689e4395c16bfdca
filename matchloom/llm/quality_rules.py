"""Quality rules with risk-controlled thresholds.

Every text gets a handful of rates (symbols, repeated words, upper case, ...). For
each stratum and rule, cutoffs are tested on the labelled documents from the most
lenient to the strictest: the exact binomial tail P(X <= k | n, alpha / rules), k of n
good documents rejected, is the p-value of "this cutoff rejects over alpha / rules of
the good". The test of a (stratum, rule) stops at the first cutoff that is not
significant at delta / (strata * rules) - fixed-sequence testing inside, Bonferroni
across - so with probability 1 - delta all certified cutoffs hold together, and then
the rules of a stratum reject at most alpha of its good documents between them. Of
those certified, the one with the best gain (bad rejected less `price` times good
rejected) is applied.

The cutoffs are a table with a row a stratum, tested in small tasks and joined to the
texts' rates (broadcast up to BROADCAST_STRATA strata), so their number has no limit.

Cases: a null text counts as empty (0 words, so the base rule rejects it); a null
stratum is a stratum of its own; a stratum without enough labels gets no cutoffs
(only the base rule); of several labels of a document the smallest quality holds;
rows with the same id count once for the test (the least of their rates) and are judged
one by one; labels that are null or of unknown documents are ignored; very long texts are
rated whole; empty tables give empty results; extra columns pass through untouched,
whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .shared import documents, stored, whole_row
from .textvec import SPACE, buffer_of, hash_spans, mix, owner, segment_sum, slices, spans, windows

#: Parameters: largest share of good documents that the rules may reject in a stratum, chance that any certificate is wrong.
ALPHA, DELTA = 0.05, 0.05
#: Good documents that one rejected bad document outweighs.
PRICE = 20
#: Strata whose cutoffs are broadcast at most (about 60 bytes each).
BROADCAST_STRATA = 1 << 16
BINS = 64
#: Words a text must have, and the largest share of words in repeated 3-word windows.
MIN_WORDS, MAX_REPEAT = 50, 0.5
#: rule -> (rate, sign): sign 1 rejects rates above the cutoff, -1 below. Rates are in 0..1.
RULES = {
    "symbols": ("symbol_rate", 1),
    "upper": ("upper_rate", 1),
    "stutter": ("stutter_rate", 1),
    "repeats": ("repeat_rate", 1),
    "dup_lines": ("dup_line_rate", 1),
    "long_words": ("word_length_rate", 1),
    "short_words": ("word_length_rate", -1),
}
RATES = sorted({rate for rate, _ in RULES.values()})
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

_NEWLINE = np.zeros(256, dtype=bool)
_NEWLINE[0x0A] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LETTER = _UPPER.copy()
_LETTER[ord("a") : ord("z") + 1] = True


def _keyed(hashes: np.ndarray, who: np.ndarray) -> np.ndarray:
    return mix(hashes + who.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def features(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts and rates of every text of the column, as arrays."""
    raw, offs = buffer_of(column)
    n = len(offs) - 1
    starts, ends = spans(raw, offs, SPACE)
    hashes = hash_spans(raw, starts, ends)
    woffs = np.searchsorted(starts, offs)
    n_words = np.diff(woffs)

    inside = ~SPACE[raw] & ((raw & 0xC0) != 0x80)  # first bytes of characters in words
    chars = segment_sum(inside, offs)
    symbols = segment_sum(_SYMBOL[raw], offs)
    upper, letters = segment_sum(_UPPER[raw], offs), segment_sum(_LETTER[raw], offs)

    three, toffs = windows(hashes, woffs, 3)
    who = owner(toffs)
    _, inverse, counts = np.unique(_keyed(three, who), return_inverse=True, return_counts=True)
    first = (np.arange(len(three)) - toffs[who] + woffs[who])[counts[inverse] > 1] if len(three) else np.zeros(0, np.int64)
    repeated = np.zeros(len(hashes), dtype=bool)
    for k in range(3):
        repeated[first + k] = True
    n_repeat = segment_sum(repeated, woffs)

    same = np.zeros(len(hashes), dtype=bool)
    if len(hashes):
        same[1:] = (hashes[1:] == hashes[:-1]) & (owner(woffs)[1:] == owner(woffs)[:-1])

    a, b = spans(raw, offs, _NEWLINE)  # lines with a word hold a byte that is no space
    filled = np.searchsorted(starts, b) > np.searchsorted(starts, a)
    a, b = a[filled], b[filled]
    loffs = np.searchsorted(a, offs)
    keys = _keyed(hash_spans(raw, a, b), owner(loffs))
    new = np.zeros(len(keys), dtype=bool)
    new[np.unique(keys, return_index=True)[1]] = True
    n_lines, n_dup = np.diff(loffs), segment_sum(~new, loffs)

    def rate(part, whole):
        return np.divide(part, whole, out=np.zeros(n), where=whole > 0)

    return {
        "n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": n_dup, "n_repeat_words": n_repeat,
        "symbol_rate": rate(symbols, chars), "upper_rate": rate(upper, letters), "stutter_rate": rate(segment_sum(same, woffs), n_words),
        "repeat_rate": rate(n_repeat, n_words), "dup_line_rate": rate(n_dup, n_lines), "word_length_rate": np.minimum(rate(chars, n_words) / 16, 1.0),
    }


def _types() -> str:
    return ", ".join([f"{c} long" for c in COUNTS] + [f"{r} double" for r in RATES])


def rated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """(doc_id, stratum, counts, rates) of every document: one scan, no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                found = features(part.column(1))
                arrays = [part.column(0), part.column(2), *(pa.array(found[c].astype(np.int64)) for c in COUNTS), *(pa.array(found[r], pa.float64()) for r in RATES)]
                yield pa.RecordBatch.from_arrays(arrays, names=[id_col, "stratum", *COUNTS, *RATES])

    narrow = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"), F.col(stratum_col).cast("string").alias("stratum"))
    return narrow.mapInArrow(run, f"{id_col} {kind}, stratum string, {_types()}")


def log_binomial_tail(k: int, n: int, p: float) -> float:
    """log P(X <= k) for X ~ Binomial(n, p), summed exactly in the log domain."""
    if k >= n:
        return 0.0
    j = np.arange(k + 1)
    steps = np.log(np.maximum(n - j[:-1], 1)) - np.log(j[:-1] + 1) + math.log(p) - math.log1p(-p)
    terms = n * math.log1p(-p) + np.concatenate([[0.0], np.cumsum(steps)])
    top = terms.max()
    return min(0.0, float(top + np.log(np.exp(terms - top).sum())))


def certified(good: np.ndarray, bad: np.ndarray, alpha: float, log_level: float, price: float) -> int | None:
    """The chosen bin: rates in it or stricter are rejected; None where nothing is certified or worth it.

    good, bad: labelled documents by bin, the most extreme (rejected first) first.
    """
    n = int(good.sum())
    chosen, best = None, 0.0
    k = hit = 0
    for i in range(len(good)):
        k, hit = k + int(good[i]), hit + int(bad[i])
        if n == 0 or log_binomial_tail(k, n, alpha) > log_level:
            break
        if hit - price * k > best:
            chosen, best = i, hit - price * k
    return chosen


def _stratum(column):
    """Strata as keys that are never null."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def fit(rates: DataFrame, labels: DataFrame, id_col: str = "doc_id", alpha: float = ALPHA, delta: float = DELTA, price: float = PRICE) -> DataFrame:
    """(_stratum, a column of bins by rule): the certified cutoffs; null where a rule has none."""
    judged = labels.where("quality is not null").groupBy(F.col(id_col).alias("label_id")).agg(F.min("quality").alias("quality"))
    joined = rates.join(judged, F.col(id_col) == F.col("label_id"))
    once = joined.groupBy("label_id").agg(F.min(F.struct(_stratum(F.col("stratum")).alias("_stratum"), "quality", *RATES)).alias("d")).select("d.*")
    bins = [F.struct(F.lit(name).alias("rule"), _level(rate).alias("bin")) for name, (rate, _) in RULES.items()]
    counted = stored(
        once.select("_stratum", "quality", F.explode(F.array(*bins)).alias("b"))
        .groupBy("_stratum", F.col("b.rule").alias("rule"), F.col("b.bin").alias("bin"))
        .agg(F.sum((F.col("quality") >= 1).cast("long")).alias("good"), F.sum((F.col("quality") < 1).cast("long")).alias("bad"))
    )
    strata = counted.select("_stratum").distinct().count()
    log_level, share = math.log(delta / (max(strata, 1) * len(RULES))), alpha / len(RULES)

    def test(pdf: pd.DataFrame) -> pd.DataFrame:
        out = {"_stratum": [pdf["_stratum"].iloc[0]]}
        for name, (_, sign) in RULES.items():
            rows = pdf[pdf["rule"] == name]
            good, bad = (np.bincount(rows["bin"], weights=rows[c], minlength=BINS + 1).astype(np.int64) for c in ("good", "bad"))
            chosen = certified(good[::-sign], bad[::-sign], share, log_level, price)
            out[name] = pd.array([None if chosen is None else BINS - chosen if sign > 0 else chosen], dtype="Int32")
        return pd.DataFrame(out)

    return stored(counted.groupBy("_stratum").applyInPandas(test, "_stratum string, " + ", ".join(f"{name} int" for name in RULES)))


def _level(rate: str):
    return F.least(F.greatest(F.floor(F.col(rate) * BINS).cast("int"), F.lit(0)), F.lit(BINS))


def base_failed(n_words, n_repeat):
    return (n_words < MIN_WORDS) | (100 * n_repeat > 100 * MAX_REPEAT * n_words)


def judged(rows: DataFrame, model: DataFrame, broadcast_strata: int = BROADCAST_STRATA) -> DataFrame:
    """The rows (_stratum, counts, rates, ...) with base_failed and kept."""
    cuts = model.select(F.col("_stratum").alias("_of"), *[F.col(name).alias(f"_cut_{name}") for name in RULES])
    cuts = F.broadcast(cuts) if model.count() <= broadcast_strata else cuts
    rejected = F.lit(False)
    for name, (rate, sign) in RULES.items():
        cut = F.col(f"_cut_{name}")
        rejected |= F.coalesce((_level(rate) >= cut) if sign > 0 else (_level(rate) <= cut), F.lit(False))
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    joined = rows.join(cuts, F.col("_stratum") == F.col("_of"), "left")
    return joined.withColumns({"base_failed": failed, "kept": ~failed & ~rejected}).drop("_of", *[f"_cut_{name}" for name in RULES])


def judge(rates: DataFrame, model: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rated documents with base_failed and kept."""
    return judged(rates.withColumn("_stratum", _stratum(F.col("stratum"))), model).select(id_col, *COUNTS, "base_failed", "kept")


def keep_good(docs: DataFrame, model: DataFrame, text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """The documents that the base rule and the certified cutoffs keep, all columns as they were; no shuffle of texts."""
    text = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            column = batch.column(1).field(text)
            for part in slices(pa.RecordBatch.from_arrays([*batch.columns, column.cast(pa.string())], names=["_stratum", "_in", "text"]), "text"):
                found = features(part.column(2))
                arrays = [part.column(0), part.column(1), *(pa.array(found[c].astype(np.int64)) for c in COUNTS), *(pa.array(found[r], pa.float64()) for r in RATES)]
                yield pa.RecordBatch.from_arrays(arrays, names=["_stratum", "_in", *COUNTS, *RATES])

    rows = docs.select(_stratum(F.col(f"`{stratum_col}`")).alias("_stratum"), whole_row(docs).alias("_in"))
    rated_rows = rows.mapInArrow(run, StructType([*rows.schema.fields, *[StructField(c, LongType()) for c in COUNTS], *[StructField(r, DoubleType()) for r in RATES]]))
    return judged(rated_rows, model).where("kept").select("_in.*")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = stored(rated(documents(spark, sf_dir)))
    return judge(rates, fit(rates, spark.read.parquet(f"{sf_dir}/labels.parquet")))
