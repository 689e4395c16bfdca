"""Readers and writers of tab-separated record files, and the tables derived from the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of the files.
RECORD = ["entity_id", "business_name", "business_address", "country"]
TRUTH = ["source1_entity_id", "matched_entity_ids"]
MATCHES, CANDIDATES = TRUTH, ["source1_entity_id", "candidate_entity_ids"]


def _strings(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_tsv(spark: SparkSession, path: str, columns: list[str] = RECORD, quoting: bool = False, limit: int | None = None, use: list[str] | None = None) -> DataFrame:
    """Rows of a TSV with a header: short rows padded, long ones cut, blank ones skipped, nothing null.

    limit: only the first rows. use: only these columns, which prunes the scan.
    """
    reader = spark.read.schema(_strings(columns)).option("sep", "\t").option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", True)
    rows = reader.option("quote", '"' if quoting else "").option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    rows = rows.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns]).where(F.concat(*columns) != "")
    rows = rows if use is None else rows.select(*use)
    return rows if limit is None else rows.limit(limit)


def read_raw_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Index scan: raw lines split at tabs, every field stripped, rows without an id skipped."""
    parts = F.split("value", "\t")
    fields = [F.trim(F.coalesce(F.get(parts, i), F.lit(""))).alias(c) for i, c in enumerate(RECORD)]
    rows = spark.read.text(path).select(F.regexp_replace("value", "\r$", "").alias("value")).select(*fields)
    return rows.where((F.col("entity_id") != "") & (F.lower("entity_id") != RECORD[0]))


def read_truth(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """(s1_id, matches) of a truth file, or of its first rows; of rows with one id the last holds."""
    rows = read_tsv(spark, path, TRUTH, limit=limit).withColumn("place", F.monotonically_increasing_id())
    return truth_lists(rows.groupBy(F.trim(TRUTH[0]).alias(TRUTH[0])).agg(F.max_by(TRUTH[1], "place").alias(TRUTH[1])))


def truth_lists(rows: DataFrame) -> DataFrame:
    """(s1_id, matches): the comma lists as arrays of distinct, non-blank ids."""
    ids = F.array_distinct(F.filter(F.transform(F.split("matched_entity_ids", ","), lambda x: F.trim(x)), lambda x: x != ""))
    return rows.select(F.trim("source1_entity_id").alias("s1_id"), ids.alias("matches"))


def truth_pairs(lists: DataFrame) -> DataFrame:
    return lists.select("s1_id", F.explode("matches").alias("cand_id"))


def write_lists(lists: DataFrame, path: str, header: list[str] = MATCHES) -> None:
    """(s1_id, ids) as a TSV of comma lists, sorted by id."""
    rows = lists.select(F.col("s1_id").alias(header[0]), F.array_join("ids", ",").alias(header[1])).orderBy(header[0])
    rows.write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)


# Tables derived from `part`; these SQL expressions mean the same in Spark and DuckDB.
_CORE = "p_name || ' ' || replace(p_brand, '#', ' ')"
_NUM = "cast(100 + (p_partkey * 37) % 9000 as {s})"
_CITY = "case when p_partkey % 3 = 0 then 'Denver, CO' when p_partkey % 3 = 1 then 'Pune, Maharashtra' else 'Évry' end"
_POSTAL = "' ' || cast(case when p_partkey % 3 = 0 then 80000 + p_partkey % 700 when p_partkey % 3 = 1 then 411000 + p_partkey % 90 else 75001 + p_partkey % 20 end as {s})"
_COUNTRY = "case when p_partkey % 17 = 0 then '' when p_partkey % 3 = 0 then 'US' when p_partkey % 3 = 1 then 'India' else 'France' end"
_ID = "cast(p_partkey as {s})"
_SUFFIX1 = "case p_partkey % 5 when 0 then ' Private Limited' when 1 then ', Inc.' when 2 then ' Corporation' when 3 then ' LLC' else ' SARL' end"
_SUFFIX2 = "case p_partkey % 5 when 1 then ' Incorporated' when 2 then ' Corp' when 3 then '' else ' S.A.R.L.' end"
_SUFFIX3 = "case p_partkey % 5 when 1 then ' inc' when 2 then ' corp.' when 3 then ' llc' else ' sarl' end"

_SOURCES = {
    "er_s1": f"""select 'S1-' || {_ID} as entity_id, {_CORE} || ' & ' || lower(p_type) || {_SUFFIX1} as business_name,
                 {_NUM} || ' Market Street, ' || {_CITY} || {_POSTAL} as business_address, {_COUNTRY} as country from part""",
    "er_s2": f"""select 'S2-' || {_ID} as entity_id,
                 case when p_partkey % 2 = 0 then upper({_CORE} || ' and ' || p_type || {_SUFFIX2}) else {_CORE} || ' and ' || lower(p_type) || {_SUFFIX3} end as business_name,
                 case when p_partkey % 11 = 0 then '' when p_partkey % 7 = 0 then {_NUM} || ' Market St, ' || {_CITY} else {_NUM} || ' Market St, ' || {_CITY} || {_POSTAL} end as business_address,
                 {_COUNTRY} as country from part where p_partkey % 5 <> 0
                 union all
                 select 'S2-D' || {_ID}, {_CORE} || ' & ' || lower(p_type), cast(7 + p_partkey % 50 as {{s}}) || ' Harbor Rd, Austin, TX ' || cast(73301 + p_partkey % 90 as {{s}}), 'US'
                 from part where p_partkey % 10 = 3""",
    "er_s3": f"""select 'S3-' || {_ID} as entity_id, replace(p_brand, '#', ' ') || ' ' || substr(p_name, 1, 2) || substr(p_name, 4) || ' ' || lower(p_type) as business_name,
                 {_NUM} || ' Market Str, ' || {_CITY} || {_POSTAL} as business_address, {_COUNTRY} as country from part where p_partkey % 4 = 0""",
    "er_truth": f"""select 'S1-' || {_ID} as source1_entity_id,
                 case when p_partkey % 5 <> 0 and p_partkey % 4 = 0 then 'S2-' || {_ID} || ',S3-' || {_ID} when p_partkey % 5 <> 0 then 'S2-' || {_ID}
                      when p_partkey % 4 = 0 then 'S3-' || {_ID} else '' end as matched_entity_ids from part""",
}


def source_sql(name: str, dialect: str = "spark") -> str:
    """The SELECT that derives a table from `part` in a dialect (spark or duckdb)."""
    return _SOURCES[name].format(s="string" if dialect == "spark" else "varchar")


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(source_sql(name).replace("from part", "from {part}"), part=spark.read.parquet(f"{sf_dir}/part.parquet"))


def derived_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: derived(spark, sf_dir, name) for name in _SOURCES}
