"""Constraint queries on inputs and results, and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.records import RECORD, TRUTH


def header_errors(spark: SparkSession, path: str, expected: list[str] = RECORD) -> list[str]:
    """Messages about a file's header; it must be the expected one after trimming and lower-casing."""
    try:
        first = spark.read.text(path).first()
    except Exception as e:  # an unreadable path is a finding, whatever the store says
        return [f"{path}: cannot be read ({type(e).__name__})"]
    if first is None:
        return [f"{path}: empty"]
    if "\t" not in first["value"] and "," in first["value"] and len(expected) > 1:
        return [f"{path}: comma-separated, tabs are needed"]
    found = [c.strip().lower() for c in first["value"].split("\t")]
    return [] if found == expected else [f"{path}: header {found}, expected {expected}"]


def truth_header_errors(spark: SparkSession, path: str) -> list[str]:
    return header_errors(spark, path, TRUTH)


def has_prefix(column: str, prefix: str):
    return F.col(column).startswith(prefix)


def bad_matched_ids(rows: DataFrame) -> DataFrame:
    """(s1_id, invalid): rows of (s1_id, list) whose comma list holds ids of another source than 2 or 3."""
    ids = F.filter(F.transform(F.split("list", ","), lambda x: F.trim(x)), lambda x: x != "")
    invalid = F.filter(ids, lambda x: ~x.rlike("^S[23]-"))
    return rows.select("s1_id", F.array_join(invalid, ",").alias("invalid")).where("invalid <> ''")


def read_ids(rows: DataFrame, column: str = "entity_id") -> DataFrame:
    return rows.select(F.trim(column).alias("id")).where("id <> ''").distinct()


def list_violations(rows: DataFrame, required: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(rule, offender) of a result table (s1_id, list) of comma lists; ids are compared as they stand.

    Rules: dup_row, intra_dup, self_match, wrong_prefix, unknown_id (with `known` ids),
    missing_s1, extra_s1. required, known: (id).
    """
    ids = rows.select("s1_id", F.split("list", ",").alias("ids"), "list")
    each = ids.where("list <> ''").select("s1_id", F.explode("ids").alias("id"))
    out = rows.groupBy("s1_id").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("dup_row").alias("rule"), F.col("s1_id").alias("offender"))
    out = out.unionByName(ids.where("list <> '' and size(ids) <> size(array_distinct(ids))").select(F.lit("intra_dup").alias("rule"), F.col("s1_id").alias("offender")))
    out = out.unionByName(each.where("id = s1_id").select(F.lit("self_match").alias("rule"), F.col("s1_id").alias("offender")))
    out = out.unionByName(each.where(~F.col("id").rlike("^S[23]-")).select(F.lit("wrong_prefix").alias("rule"), F.col("id").alias("offender")))
    if known is not None:
        out = out.unionByName(each.select("id").distinct().join(known, "id", "left_anti").select(F.lit("unknown_id").alias("rule"), F.col("id").alias("offender")))
    have = rows.select(F.col("s1_id").alias("id")).distinct()
    out = out.unionByName(required.join(have, "id", "left_anti").select(F.lit("missing_s1").alias("rule"), F.col("id").alias("offender")))
    return out.unionByName(have.join(required, "id", "left_anti").select(F.lit("extra_s1").alias("rule"), F.col("id").alias("offender"))).distinct()


def list_counters(rows: DataFrame) -> DataFrame:
    """One row about a result table (s1_id, list): rows, different ids, rows with an empty list, ids listed."""
    empty = F.trim(F.coalesce("list", F.lit(""))) == ""
    listed = F.when(empty, 0).otherwise(F.size(F.split("list", ",")))
    return rows.agg(F.count("*").alias("total_rows"), F.count_distinct("s1_id").alias("entities"), F.count_if(empty).alias("empty_rows"), F.coalesce(F.sum(listed), F.lit(0)).cast("long").alias("listed_ids"))


def not_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """(rule, offender): matched ids that are not among the entity's candidates - a warning. Both (s1_id, list)."""
    a, b = (x.where("list <> ''").select("s1_id", F.explode(F.split("list", ",")).alias("id")) for x in (matches, candidates))
    return a.join(b, ["s1_id", "id"], "left_anti").select(F.lit("match_not_candidate").alias("rule"), F.concat_ws(" ", "s1_id", "id").alias("offender")).distinct()


def report(violations: DataFrame, shown: int = 5) -> DataFrame:
    """(rule, total, examples): offenders by rule with the first `shown`, sorted."""
    first = violations.withColumn("n", F.row_number().over(W.partitionBy("rule").orderBy("offender"))).where(F.col("n") <= shown)
    examples = first.groupBy("rule").agg(F.array_join(F.array_sort(F.collect_list("offender")), ", ").alias("examples"))
    return violations.groupBy("rule").agg(F.count("*").alias("total")).join(examples, "rule")


def validate_results(matches: DataFrame, candidates: DataFrame | None, required: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(file, severity, rule, total, examples): passes iff no row is an error."""
    out = report(list_violations(matches, required, known)).select(F.lit("matching").alias("file"), F.lit("error").alias("severity"), "*")
    if candidates is not None:
        out = out.unionByName(report(list_violations(candidates, required, known)).select(F.lit("candidates").alias("file"), F.lit("error").alias("severity"), "*"))
        out = out.unionByName(report(not_candidates(matches, candidates)).select(F.lit("matching").alias("file"), F.lit("warning").alias("severity"), "*"))
    return out


def profile(records: DataFrame) -> DataFrame:
    """One row by source: sizes, missing rates (4 places) and mean lengths of filled fields (2 places)."""
    name, address, country = (F.trim(F.coalesce(c, F.lit(""))) for c in ("business_name", "business_address", "country"))
    n = F.count("*")
    return records.groupBy(F.substring("entity_id", 1, 2).alias("source")).agg(
        n.alias("sample_size"), F.count_if(name == "").alias("missing_name_count"), F.round(F.count_if(name == "") / n, 4).alias("missing_name_pct"),
        F.count_if(address == "").alias("missing_addr_count"), F.round(F.count_if(address == "") / n, 4).alias("missing_addr_pct"),
        F.round(F.count_if(country == "") / n, 4).alias("missing_country_pct"),
        F.coalesce(F.round(F.avg(F.when(name != "", F.length(name))), 2), F.lit(0.0)).alias("avg_name_length"),
        F.coalesce(F.round(F.avg(F.when(address != "", F.length(address))), 2), F.lit(0.0)).alias("avg_addr_length"),
    )


def country_histogram(records: DataFrame) -> DataFrame:
    """(source, country, rows) over filled countries."""
    rows = records.select(F.substring("entity_id", 1, 2).alias("source"), F.trim(F.coalesce("country", F.lit(""))).alias("country"))
    return rows.where("country <> ''").groupBy("source", "country").agg(F.count("*").alias("rows"))
