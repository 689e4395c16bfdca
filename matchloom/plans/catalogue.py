"""All queries by name, and the DuckDB SQL that each is held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as X
from ..operators import blocking as B
from ..operators import decide as D
from ..operators import evaluate as E
from ..operators import features as FT
from ..operators import pairs as TP
from ..operators import tfidf as TF
from ..operators import validate as V
from ..sources import records as R
from ..sources.shared import scratch, stored
from . import oracle as O

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def _query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


class Linkage:
    """The derived tables of a data folder and the steps built on them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._sides = spark, sf_dir, None
        tables = R.derived_all(spark, sf_dir)
        self.queries_raw, self.targets_raw = tables["er_s1"], tables["er_s2"].unionByName(tables["er_s3"])
        self.all_raw = self.queries_raw.unionByName(self.targets_raw)
        self.truth = R.truth_lists(tables["er_truth"])

    def records(self) -> DataFrame:
        return B.normalised(self.all_raw)

    def dealt(self) -> DataFrame:
        """All records dealt over the tasks: a file of few bytes is one split however many rows it has, and views take time."""
        return self.all_raw.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), "entity_id")

    def sides(self) -> tuple[DataFrame, DataFrame]:
        """Both sides' views, computed once however many steps read them."""
        if self._sides is None:
            rows = stored(B.normalised(self.dealt(), whole=True))
            self._sides = rows.where("source = 'S1'"), rows.where("source <> 'S1'")
        return self._sides

    def candidates(self, profile: str = "train") -> DataFrame:
        return B.candidates(*self.sides(), profile=profile)

    def true_pairs(self) -> DataFrame:
        """The true pairs with both records' views."""
        return FT.beside(R.truth_pairs(self.truth), *self.sides())

    def scored(self) -> DataFrame:
        """Candidates with two rule scores, both countries and the label."""
        a, b = self.sides()
        both = FT.beside(self.candidates().select("s1_id", "cand_id"), a, b).join(self.truth, "s1_id")
        tokens, ngrams = S.jaccard(F.col("a_tokens"), F.col("b_tokens")), S.jaccard(F.col("a_ngrams"), F.col("b_ngrams"))
        return both.select(
            "s1_id", "cand_id", F.round(0.5 * tokens + 0.5 * ngrams, 6).alias("p1"), F.round(ngrams, 6).alias("p2"),
            "a_country", "b_country", F.array_contains("matches", F.col("cand_id")).cast("int").alias("label"),
        )

    def predicted(self) -> DataFrame:
        return E.as_sets(self.scored().where("p1 >= 0.5"))

    def faulty(self) -> DataFrame:
        return self.spark.sql(O.faulty_sql().replace("from part", "from {part}"), part=self.spark.read.parquet(f"{self.sf_dir}/part.parquet"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# Text views.

@_query("norm_unicode", f"SELECT doc_id, md5({O.norm('text')}) AS norm FROM documents")
def norm_unicode(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", F.md5(X.normalize_unicode(F.col("text")).cast("binary")).alias("norm"))


@_query("clean_text", "SELECT doc_id, md5(" + O.plain(f"replace({O.norm('text')}, '&', ' and ')") + ") AS cleaned FROM documents")
def clean_text(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", F.md5(X.clean_text(F.col("text")).cast("binary")).alias("cleaned"))


@_query("url_domain_strip", f"SELECT page_id, {O.sub('url', O.P.DOMAIN, chr(92) + '1')} AS stripped FROM pages")
def url_domain_strip(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", X.replaced(F.col("url"), O.P.DOMAIN, "$1").alias("stripped"))


def _view(name: str, column: str, sql: str, spark_column=None):
    @_query(name, O.query(f"SELECT entity_id, {sql} AS {column} FROM rec"))
    def view(spark, sf_dir):
        return Linkage(spark, sf_dir).records().select("entity_id", (spark_column or F.col)(column).alias(column))

    return view


def _register_views():
    for name, column in (("name_basic", "basic"), ("name_legal", "legal"), ("compact", "compact"), ("addr_basic", "addr"), ("addr_compact", "addr_compact"), ("addr_postal", "postal"), ("addr_house", "house"), ("addr_state", "state")):
        _view(name, column, column)
    for name, column in (("tokens", "tokens"), ("addr_tokens", "addr_tokens")):
        _view(name, column, f"array_to_string({column}, '|')", lambda c: F.array_join(c, "|"))
    for name, column in (("ngrams3", "ngrams"), ("addr_ngrams3", "addr_ngrams")):
        _view(name, column, f"array_to_string(list_sort({column}), '|')", lambda c: F.array_join(F.array_sort(c), "|"))
    for rule in range(1, 7):
        _block(rule)


@_query("addr_components", O.query("SELECT entity_id, postal, house, state, postal IS NOT NULL AS has_postal, house IS NOT NULL AS has_house_num, state IS NOT NULL AS has_state FROM rec"))
def addr_components(spark, sf_dir):
    has = {"has_postal": "postal", "has_house_num": "house", "has_state": "state"}
    return Linkage(spark, sf_dir).records().select("entity_id", "postal", "house", "state", *[F.col(c).isNotNull().alias(n) for n, c in has.items()])


# Sources, profiles and validation.

@_query("truth_ingest", O.query("SELECT s1_id, array_to_string(matches, ',') AS matches, len(matches)::INTEGER AS n FROM truth"))
def truth_ingest(spark, sf_dir):
    return Linkage(spark, sf_dir).truth.select("s1_id", F.array_join("matches", ",").alias("matches"), F.size("matches").alias("n"))


@_query("target_index", O.query("SELECT entity_id, business_name, business_address, country FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY entity_id) AS n FROM rec WHERE source <> 'S1') WHERE n <= 1000"))
def target_index(spark, sf_dir):
    """The per-source row cap is the operator's feature."""
    return B.target_index([Linkage(spark, sf_dir).targets_raw], per_source=1000)


@_query("target_index_whole", O.query("SELECT entity_id, business_name, business_address, country FROM rec WHERE source <> 'S1'"))
def target_index_whole(spark, sf_dir):
    """Without the cap, as the reference builds it by default."""
    return B.target_index([Linkage(spark, sf_dir).targets_raw])


@_query("truth_sample_records", O.query("SELECT entity_id, business_name, country FROM er_s1 WHERE entity_id IN (SELECT s1_id FROM truth WHERE len(matches) = 2)"))
def truth_sample_records(spark, sf_dir):
    """The query records of a sample of the truth: here the entities with two matches."""
    link = Linkage(spark, sf_dir)
    return B.records_of(link.queries_raw, link.truth.where("size(matches) = 2")).select("entity_id", "business_name", "country")


@_query("target_sample", O.query("""SELECT entity_id, business_name, country FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY entity_id) AS n FROM rec WHERE source <> 'S1')
  WHERE n <= 50 OR entity_id IN (SELECT unnest(matches) FROM truth WHERE len(matches) = 2)"""))
def target_sample(spark, sf_dir):
    """Targets that a truth sample needs, and the first of each source: the limit is the operator's feature."""
    link = Linkage(spark, sf_dir)
    return B.sampled_targets(link.targets_raw, R.truth_pairs(link.truth.where("size(matches) = 2")), 100).select("entity_id", "business_name", "country")


@_query("sub_counters", O.query("SELECT count(*) AS total_rows, count(DISTINCT s1_id) AS entities, count_if(trim(list) = '') AS empty_rows, sum(CASE WHEN trim(list) = '' THEN 0 ELSE len(string_split(list, ',')) END)::BIGINT AS listed_ids FROM faulty"))
def sub_counters(spark, sf_dir):
    return V.list_counters(Linkage(spark, sf_dir).faulty())


@_query("index_probe", O.query("SELECT count(*) AS indexed FROM rec WHERE source <> 'S1'"))
def index_probe(spark, sf_dir):
    """Rows of a target index that was built and stored, as the probe finds them."""
    from . import jobs as J

    path = scratch(spark)
    J.target_store(spark, path, Linkage(spark, sf_dir).targets_raw)
    return spark.createDataFrame([(J.index_size(spark, path),)], "indexed bigint")


@_query("id_prefixes", O.query("SELECT entity_id, starts_with(entity_id, 'S1-') AS is_s1, starts_with(entity_id, 'S2-') AS is_s2 FROM er_all"))
def id_prefixes(spark, sf_dir):
    return Linkage(spark, sf_dir).all_raw.select("entity_id", V.has_prefix("entity_id", "S1-").alias("is_s1"), V.has_prefix("entity_id", "S2-").alias("is_s2"))


@_query("read_ids", O.query("SELECT DISTINCT trim(entity_id) AS id FROM er_all WHERE trim(entity_id) <> ''"))
def read_ids(spark, sf_dir):
    return V.read_ids(Linkage(spark, sf_dir).all_raw)


_PROFILE = """SELECT source, count(*) AS sample_size, count(*) FILTER (trim(business_name) = '') AS missing_name_count, round(count(*) FILTER (trim(business_name) = '') / count(*)::DOUBLE, 4) AS missing_name_pct,
 count(*) FILTER (trim(business_address) = '') AS missing_addr_count, round(count(*) FILTER (trim(business_address) = '') / count(*)::DOUBLE, 4) AS missing_addr_pct,
 round(count(*) FILTER (trim(country) = '') / count(*)::DOUBLE, 4) AS missing_country_pct,
 coalesce(round(avg(length(trim(business_name))) FILTER (trim(business_name) <> ''), 2), 0.0) AS avg_name_length,
 coalesce(round(avg(length(trim(business_address))) FILTER (trim(business_address) <> ''), 2), 0.0) AS avg_addr_length FROM rec GROUP BY source"""


@_query("profile_sources", O.query(_PROFILE))
def profile_sources(spark, sf_dir):
    return V.profile(Linkage(spark, sf_dir).all_raw)


@_query("country_histogram", O.query("SELECT source, trim(country) AS country, count(*) AS rows FROM rec WHERE trim(country) <> '' GROUP BY ALL"))
def country_histogram(spark, sf_dir):
    return V.country_histogram(Linkage(spark, sf_dir).all_raw)


@_query("bad_matched_ids", O.query("SELECT s1_id, array_to_string(bad, ',') AS invalid FROM (SELECT s1_id, list_filter(list_transform(string_split(list, ','), lambda x: trim(x)), lambda x: x <> '' AND NOT regexp_matches(x, '^S[23]-')) AS bad FROM faulty) WHERE len(bad) > 0"))
def bad_matched_ids(spark, sf_dir):
    return V.bad_matched_ids(Linkage(spark, sf_dir).faulty())


_RULES = {
    "dup_row": "SELECT s1_id AS offender FROM faulty GROUP BY s1_id HAVING count(*) > 1",
    "intra_dup": "SELECT s1_id AS offender FROM faulty WHERE list <> '' AND len(string_split(list, ',')) <> len(list_distinct(string_split(list, ',')))",
    "self_match": "SELECT s1_id AS offender FROM faulty_ids WHERE id = s1_id",
    "wrong_prefix": "SELECT id AS offender FROM faulty_ids WHERE NOT regexp_matches(id, '^S[23]-')",
    "unknown_id": "SELECT id AS offender FROM faulty_ids WHERE id NOT IN (SELECT entity_id FROM rec WHERE source <> 'S1')",
    "missing_s1": "SELECT entity_id AS offender FROM er_s1 WHERE entity_id NOT IN (SELECT s1_id FROM faulty)",
    "extra_s1": "SELECT s1_id AS offender FROM faulty WHERE s1_id NOT IN (SELECT entity_id FROM er_s1)",
}
_ALL_RULES = " UNION ALL ".join(f"SELECT DISTINCT '{name}' AS rule, offender FROM ({sql})" for name, sql in _RULES.items())


def _violations(link: Linkage) -> DataFrame:
    return V.list_violations(link.faulty(), V.read_ids(link.queries_raw), V.read_ids(link.targets_raw))


@_query("sub_violations", O.query(_ALL_RULES))
def sub_violations(spark, sf_dir):
    return _violations(Linkage(spark, sf_dir))


@_query("sub_report", O.query("SELECT rule, count(*) AS total, array_to_string(list_sort(list(offender))[1:5], ', ') AS examples FROM (" + _ALL_RULES + ") GROUP BY rule"))
def sub_report(spark, sf_dir):
    return V.report(_violations(Linkage(spark, sf_dir)))


def _rule(name: str):
    @_query(f"sub_{name}", O.query(f"SELECT DISTINCT offender FROM ({_RULES[name]})"))
    def one(spark, sf_dir):
        return _violations(Linkage(spark, sf_dir)).where(F.col("rule") == name).select("offender")


for _name in ("dup_row", "intra_dup", "self_match", "missing_s1", "extra_s1"):
    _rule(_name)


def _lists(link: Linkage) -> tuple[DataFrame, DataFrame]:
    found = link.candidates().groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_list("cand_id")), ",").alias("list"))
    return link.truth.select("s1_id", F.array_join("matches", ",").alias("list")), found


@_query("sub_match_not_candidate", O.query("SELECT 'match_not_candidate' AS rule, s1_id || ' ' || cand_id AS offender FROM tpairs WHERE (s1_id, cand_id) NOT IN (SELECT s1_id, cand_id FROM cand)"))
def sub_match_not_candidate(spark, sf_dir):
    return V.not_candidates(*_lists(Linkage(spark, sf_dir)))


# Blocking.

def _block(rule: int):
    @_query(f"block_b{rule}", O.query(f"SELECT block_key, entity_id, source FROM keys WHERE rule = {rule}"))
    def block(spark, sf_dir):
        return B.block_keys(Linkage(spark, sf_dir).records()).where(F.col("rule") == rule).select("block_key", "entity_id", "source")


@_query("block_index_profile", O.query("SELECT rule, block_key, entity_id FROM ikeys"))
def block_index_profile(spark, sf_dir):
    return B.block_keys(Linkage(spark, sf_dir).records(), "index").select("rule", "block_key", "entity_id")


@_query("block_cap", O.query("SELECT rule, block_key, entity_id FROM idx"))
def block_cap(spark, sf_dir):
    return B.capped(B.block_keys(Linkage(spark, sf_dir).sides()[1])).select("rule", "block_key", "entity_id")


@_query("candidates_top25", O.query("SELECT s1_id, cand_id, rule, rank::INTEGER AS rank FROM cand"))
def candidates_top25(spark, sf_dir):
    return Linkage(spark, sf_dir).candidates()


@_query("candidates_index_profile", O.query("SELECT s1_id, cand_id, rule, rank::INTEGER AS rank FROM icand"))
def candidates_index_profile(spark, sf_dir):
    return Linkage(spark, sf_dir).candidates("index")


@_query("record_fetch", O.query("SELECT c.s1_id, c.cand_id, r.legal, r.compact, r.addr, r.country, coalesce(r.postal, '') AS postal, coalesce(r.house, '') AS house, coalesce(r.state, '') AS state FROM cand c JOIN rec r ON r.entity_id = c.cand_id"))
def record_fetch(spark, sf_dir):
    link = Linkage(spark, sf_dir)
    found = B.fetched(link.candidates(), link.sides()[1])
    return found.select("s1_id", "cand_id", "legal", "compact", "addr", "country", *[F.coalesce(c, F.lit("")).alias(c) for c in ("postal", "house", "state")])


_GRAMS = " UNION ALL ".join(f"SELECT entity_id, source, unnest(list_transform(range(1, length(w) - {n - 2}), lambda i: substr(w, i::INT, {n}))) AS term FROM w0 WHERE length(w) >= {n}" for n in TF.LENGTHS)
_TFIDF = f""", w0 AS (SELECT entity_id, source, ' ' || unnest({O.words('legal')}) || ' ' AS w FROM rec),
tf AS (SELECT entity_id, source, term, count(*) AS tf FROM ({_GRAMS}) GROUP BY ALL),
voc AS (SELECT term, ln((1 + (SELECT count(*) FROM rec WHERE source <> 'S1')) / (1 + count(*))::DOUBLE) + 1 AS idf FROM tf WHERE source <> 'S1' GROUP BY term ORDER BY sum(tf) DESC, term LIMIT {TF.MAX_FEATURES}),
wt AS (SELECT entity_id, source, term, (1 + ln(tf::DOUBLE)) * idf AS w FROM tf JOIN voc USING (term)),
un AS (SELECT entity_id, source, term, w / sqrt(sum(w * w) OVER (PARTITION BY entity_id)) AS w FROM wt),
cos AS (SELECT q.entity_id AS s1_id, t.entity_id AS cand_id, round(sum(q.w * t.w), 9) AS cosine FROM un q JOIN un t USING (term) WHERE q.source = 'S1' AND t.source <> 'S1' GROUP BY ALL)"""


@_query("tfidf_top5", O.query(f"SELECT s1_id, cand_id, cosine, row_number() OVER (PARTITION BY s1_id ORDER BY cosine DESC, cand_id)::INTEGER AS rank FROM cos QUALIFY rank <= {TF.TOP_K}", _TFIDF))
def tfidf_top5(spark, sf_dir):
    rows = stored(B.normalised(Linkage(spark, sf_dir).dealt()).select("source", F.col("entity_id").alias("id"), F.col("legal").alias("text")))
    return TF.top_k(rows.where("source = 'S1'").drop("source"), rows.where("source <> 'S1'").drop("source"))


# Similarities of the true pairs.

def _similarity(name: str, sql: str, column):
    @_query(f"sim_{name}", O.query(f"SELECT s1_id, cand_id, round({sql}, 9) AS sim FROM sets"))
    def sim(spark, sf_dir):
        return Linkage(spark, sf_dir).true_pairs().select("s1_id", "cand_id", F.round(column(), 9).alias("sim"))


_TOKEN_SET = O.token_set("a_basic", "b_basic", "common", "lefts", "rights", "one", "two")
_similarity("jw", O.jw("a_basic", "b_basic"), lambda: S.jaro_winkler_sim(F.col("a_basic"), F.col("b_basic")))
_similarity("indel", O.indel("a_basic", "b_basic"), lambda: S.indel_ratio(F.col("a_basic"), F.col("b_basic")))
_similarity("token_sort", O.indel("a_sorted", "b_sorted"), lambda: S.token_sort_ratio(F.col("a_basic"), F.col("b_basic")))
_similarity("token_set", _TOKEN_SET, lambda: S.token_set_ratio(F.col("a_basic"), F.col("b_basic")))
_similarity("jaccard", O.jaccard("a_tokens", "b_tokens"), lambda: S.jaccard(F.col("a_tokens"), F.col("b_tokens")))
_similarity("ngram", O.jaccard("a_ngrams", "b_ngrams"), lambda: S.jaccard(F.col("a_ngrams"), F.col("b_ngrams")))
_similarity("prefix", O.prefix("a_compact", "b_compact"), lambda: S.prefix_ratio(F.col("a_compact"), F.col("b_compact")))

# Features of the true pairs.

_JW_LEGAL, _LEN = O.jw("a_legal", "b_legal"), ("length(a_basic)", "length(b_basic)")
_FEATURE_SQL = {
    **{f"name_exact_{v}": O.flag(f"a_{v} <> '' AND a_{v} = b_{v}") for v in ("raw", "basic", "legal", "compact")},
    "name_lev_basic": O.indel("a_basic", "b_basic"), "name_lev_legal": O.indel("a_legal", "b_legal"), "name_jw_basic": O.jw("a_basic", "b_basic"), "name_jw_legal": _JW_LEGAL,
    "name_token_sort": O.indel("a_sorted", "b_sorted"), "name_token_set": _TOKEN_SET, "name_jaccard_tokens": O.jaccard("a_tokens", "b_tokens"), "name_ngram_jaccard": O.jaccard("a_ngrams", "b_ngrams"),
    "name_prefix_sim": O.prefix("a_compact", "b_compact"), "name_first_token_match": O.flag("a_tokens[1] = b_tokens[1]"), "name_last_token_match": O.flag("a_tokens[-1] = b_tokens[-1]"),
    "name_len_diff": f"abs({_LEN[0]} - {_LEN[1]})::DOUBLE", "name_len_ratio": f"CASE WHEN a_basic = '' OR b_basic = '' THEN {_JW_LEGAL} ELSE least({_LEN[0]}, {_LEN[1]})::DOUBLE / greatest({_LEN[0]}, {_LEN[1]}) END",
    "name_tok_diff": "abs(len(a_tokens) - len(b_tokens))::DOUBLE",
    "addr_s1_empty": O.flag("a_addr = ''"), "addr_cand_empty": O.flag("b_addr = ''"), "addr_both_empty": O.flag("a_addr = '' AND b_addr = ''"), "addr_one_empty": O.flag("(a_addr = '') <> (b_addr = '')"),
    "addr_exact": O.flag("a_addr <> '' AND a_addr = b_addr"), "addr_lev": O.indel("a_addr", "b_addr"), "addr_jw": O.jw("a_addr", "b_addr"),
    "addr_token_set": O.token_set("a_addr", "b_addr", "acommon", "alefts", "arights", "aone", "atwo"), "addr_jaccard": O.jaccard("a_at", "b_at"), "addr_ngram": O.jaccard("a_ag", "b_ag"),
    **{f"{c}_{kind}": O.flag(f"a_{c} {op} b_{c}") for c in ("postal", "house", "state") for kind, op in (("exact", "="), ("mismatch", "<>"))},
    "comp_agreements": " + ".join(O.flag(f"a_{c} = b_{c}") for c in ("postal", "house", "state")), "comp_conflicts": " + ".join(O.flag(f"a_{c} <> b_{c}") for c in ("postal", "house", "state")),
}
_INTERACTION_SQL = {
    "name_addr_product": "n * d", "name_addr_mean": "(n + d) / 2", "name_addr_min": "least(n, d)", "name_addr_max": "greatest(n, d)", "name_addr_diff": "abs(n - d)",
    "agreement_count": " + ".join([O.flag("n >= 0.85"), O.flag("d >= 0.80"), *(O.flag(f"a_{c} = b_{c}") for c in ("postal", "house", "state"))]),
    "country_exact": O.flag("c1 <> '' AND c1 = c2"), "country_mismatch": O.flag("c1 <> '' AND c2 <> '' AND c1 <> c2"), "country_missing": O.flag("c1 = '' OR c2 = ''"),
    "is_source2": O.flag("starts_with(cand_id, 'S2-')"), "is_source3": O.flag("starts_with(cand_id, 'S3-')"), "is_empty_addr_high_name": O.flag("b_addr = '' AND n >= 0.90"), "is_weak_name_high_addr": O.flag("n < 0.45 AND d >= 0.85"),
}


def _features(name: str, columns: list[str], sql: str):
    @_query(name, sql)
    def some(spark, sf_dir):
        link = Linkage(spark, sf_dir)
        return FT.features(R.truth_pairs(link.truth), *link.sides()).select("s1_id", "cand_id", *[F.round(c, 9).alias(c) for c in columns])


def _rounded(columns: dict, names: list[str]) -> str:
    return ", ".join(f"round({columns[n]}, 9) AS {n}" for n in names)


_features("feat_name", FT.NAME, O.query(f"SELECT s1_id, cand_id, {_rounded(_FEATURE_SQL, FT.NAME)} FROM sets"))
_features("feat_address", FT.ADDRESS, O.query(f"SELECT s1_id, cand_id, {_rounded(_FEATURE_SQL, FT.ADDRESS)} FROM sets"))
_features("feat_interaction", FT.INTERACTION, O.query(f"SELECT s1_id, cand_id, {_rounded(_INTERACTION_SQL, FT.INTERACTION)} FROM nd", f", nd AS (SELECT *, {_JW_LEGAL} AS n, {O.jw('a_addr', 'b_addr')} AS d FROM sets)"))

# Training data.


@_query("split_entities", O.query(O.split_sql()))
def split_entities(spark, sf_dir):
    return TP.split_entities(Linkage(spark, sf_dir).truth)


@_query("train_pairs", O.query("SELECT * FROM training", O.training_sql()))
def train_pairs(spark, sf_dir):
    link = Linkage(spark, sf_dir)
    return TP.training_pairs(link.truth, link.candidates())


@_query("label_counts", O.query("SELECT label, count(*) AS pairs FROM training GROUP BY label", O.training_sql()))
def label_counts(spark, sf_dir):
    link = Linkage(spark, sf_dir)
    return TP.training_pairs(link.truth, link.candidates()).groupBy("label").agg(F.count("*").alias("pairs"))


@_query("hard_negatives", O.query(f"SELECT s1_id, cand_id, p1 AS p FROM scored WHERE label = 0 AND p1 >= {TP.HARD_THRESHOLD} AND (s1_id, cand_id) NOT IN (SELECT s1_id, cand_id FROM training) ORDER BY p1 DESC, s1_id, cand_id LIMIT {TP.HARD_LIMIT}", O.training_sql()))
def hard_negatives(spark, sf_dir):
    """The limit is the operator's feature."""
    link = Linkage(spark, sf_dir)
    return TP.hard_negatives(link.scored().withColumn("p", F.col("p1")), link.truth, TP.training_pairs(link.truth, link.candidates()))


# Evaluation.

_RECALL = """SELECT CASE WHEN total > 0 THEN round(kept / total::DOUBLE, 5) ELSE 1.0 END AS blocking_recall, total AS total_true_pairs, kept AS retained_pairs, total - kept AS missed_pairs,
 round(c / entities::DOUBLE, 2) AS avg_candidates, round(c / rows_::DOUBLE, 2) AS avg_candidates_all_rows
FROM (SELECT sum(len(matches))::BIGINT AS total, sum(len(list_intersect(matches, ids)))::BIGINT AS kept, (sum(len(ids)) FILTER (len(matches) > 0))::BIGINT AS c, count(*) FILTER (len(matches) > 0) AS entities, count(*) AS rows_
 FROM (SELECT t.matches, coalesce(c.ids, []) AS ids FROM truth t LEFT JOIN (SELECT s1_id, list(cand_id) AS ids FROM cand GROUP BY s1_id) c USING (s1_id)))"""


@_query("blocking_recall", O.query(_RECALL))
def blocking_recall(spark, sf_dir):
    """Both averages: over entities with a match, and over all truth rows."""
    link = Linkage(spark, sf_dir)
    return E.blocking_recall(link.truth, link.candidates())


@_query("blocking_recall_uncapped", O.query(_RECALL.replace("FROM cand GROUP", "FROM (SELECT DISTINCT q.entity_id AS s1_id, t.entity_id AS cand_id FROM keys q JOIN idx t USING (rule, block_key) WHERE q.source = 'S1') GROUP")))
def blocking_recall_uncapped(spark, sf_dir):
    link = Linkage(spark, sf_dir)
    return E.blocking_recall(link.truth, B.candidates(*link.sides(), keep=None))


@_query("recall_by_source", O.query("SELECT left(p.cand_id, 2) AS target_source, q.country, count(*) AS true_pairs, count(c.cand_id) AS found, round(count(c.cand_id) / count(*)::DOUBLE, 5) AS recall FROM tpairs p JOIN er_s1 q ON q.entity_id = p.s1_id LEFT JOIN cand c ON c.s1_id = p.s1_id AND c.cand_id = p.cand_id GROUP BY ROLLUP (left(p.cand_id, 2), q.country)"))
def recall_by_source(spark, sf_dir):
    link = Linkage(spark, sf_dir)
    return E.recall_by(link.truth, link.candidates(), link.queries_raw)


@_query("candidate_audit", O.query("SELECT quantile_cont(c, 0.5)::DOUBLE AS median, quantile_cont(c, 0.95)::DOUBLE AS p95, quantile_cont(c, 0.99)::DOUBLE AS p99, sum(c)::BIGINT AS pairs, round(1 - sum(c) / ((SELECT count(*) FROM er_s1) * (SELECT count(*) FROM rec WHERE source <> 'S1'))::DOUBLE, 9) AS reduction_ratio FROM (SELECT count(*) AS c FROM cand GROUP BY s1_id)"))
def candidate_audit(spark, sf_dir):
    link = Linkage(spark, sf_dir)
    return E.candidate_audit(link.candidates(), link.queries_raw, link.targets_raw)


@_query("entity_f05", O.query(f"SELECT s1_id, round(p, 9) AS precision, round(r, 9) AS recall, round({O.F_SQL}, 9) AS f05 FROM (SELECT s1_id, {O.P_SQL} AS p, {O.R_SQL} AS r FROM sized)"))
def entity_f05(spark, sf_dir):
    link = Linkage(spark, sf_dir)
    return E.entity_f05(link.truth, link.predicted()).select("s1_id", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f05")])


@_query("macro_f05", O.query(f"SELECT round(avg(p), 6) AS macro_precision, round(avg(r), 6) AS macro_recall, round(avg({O.F_SQL}), 6) AS macro_f05, count(*) AS total_entities FROM (SELECT {O.P_SQL} AS p, {O.R_SQL} AS r FROM sized)"))
def macro_f05(spark, sf_dir):
    link = Linkage(spark, sf_dir)
    out = E.macro_f05(link.truth, link.predicted())
    return out.select(*[F.round(c, 6).alias(c) for c in ("macro_precision", "macro_recall", "macro_f05")], "total_entities")


@_query("grid_scores", O.query("SELECT ai::INTEGER AS ai, ti::INTEGER AS ti, round(alpha, 6) AS alpha, round(tau, 6) AS tau, round(macro_f05, 6) AS macro_f05 FROM g", "," + O.grid_sql(O.COARSE_ALPHAS, O.COARSE_TAUS, "g")))
def grid_scores(spark, sf_dir):
    link = Linkage(spark, sf_dir)
    out = E.grid_scores(link.truth, link.scored(), E.coarse_grid(spark))
    return out.select("ai", "ti", *[F.round(c, 6).alias(c) for c in ("alpha", "tau", "macro_f05")])


_BEST = ", best AS (SELECT * FROM g ORDER BY macro_f05 DESC, ai, ti LIMIT 1),"
_FINE_ALPHAS = f"SELECT unnest([0, 1, 2]) AS i, unnest([greatest(0.0, alpha - {E.FINE_ALPHA}), alpha, least(1.0, alpha + {E.FINE_ALPHA})]) AS v FROM best"
_FINE_TAUS = f"SELECT i, greatest(0.40, tau - {E.FINE_TAU})::DOUBLE + {E.FINE_STEP}::DOUBLE * i AS v FROM best, range(40) r(i) WHERE i <= round((least(0.99, tau + {E.FINE_TAU}) - greatest(0.40, tau - {E.FINE_TAU})) / {E.FINE_STEP})"


@_query("threshold_search", O.query("SELECT round(alpha, 4) AS best_alpha, round(tau, 4) AS best_threshold, round(macro_f05, 5) AS best_val_macro_f05 FROM (SELECT 0 AS pass, * FROM best UNION ALL SELECT 1, * FROM f) ORDER BY macro_f05 DESC, pass, ai, ti LIMIT 1", "," + O.grid_sql(O.COARSE_ALPHAS, O.COARSE_TAUS, "g") + _BEST + O.grid_sql(_FINE_ALPHAS, _FINE_TAUS, "f")))
def threshold_search(spark, sf_dir):
    link = Linkage(spark, sf_dir)
    return E.threshold_search(link.truth, link.scored())


_KINDS = """SELECT s1_id, unnest(list_filter([CASE WHEN n = 0 AND m > 0 THEN 'singleton_error' END, CASE WHEN n > 0 AND m > h THEN 'false_positive' END, CASE WHEN n > h THEN 'false_negative' END], lambda x: x IS NOT NULL)) AS kind FROM sized"""


@_query("error_analysis", O.query(f"SELECT kind, count(*) AS entities, array_to_string(list_sort(list(s1_id))[1:15], ',') AS sample FROM ({_KINDS}) GROUP BY kind"))
def error_analysis(spark, sf_dir):
    link = Linkage(spark, sf_dir)
    return E.error_analysis(link.truth, link.predicted())


# Decisions and results.

_SAFE = "p1 >= 0.5 AND (trim(a_country) = '' OR trim(b_country) = '' OR lower(trim(a_country)) = lower(trim(b_country)) OR p1 >= 0.95)"


@_query("safety_filter", O.query(f"SELECT s1_id, cand_id, p1 AS p FROM scored WHERE {_SAFE}"))
def safety_filter(spark, sf_dir):
    return D.safe_matches(Linkage(spark, sf_dir).scored().withColumn("p", F.col("p1")), 0.5).select("s1_id", "cand_id", "p")


@_query("submission_lists", O.query(f"SELECT q.entity_id AS source1_entity_id, coalesce(l.ids, '') AS matched_entity_ids FROM er_s1 q LEFT JOIN (SELECT s1_id, string_agg(cand_id, ',' ORDER BY p1 DESC, cand_id) AS ids FROM scored WHERE {_SAFE} GROUP BY s1_id) l ON l.s1_id = q.entity_id"))
def submission_lists(spark, sf_dir):
    link = Linkage(spark, sf_dir)
    lists = D.match_lists(link.queries_raw.withColumnRenamed("entity_id", "s1_id"), D.safe_matches(link.scored().withColumn("p", F.col("p1")), 0.5))
    return lists.select(F.col("s1_id").alias("source1_entity_id"), F.array_join("ids", ",").alias("matched_entity_ids"))


@_query("hybrid_blend", O.query("SELECT s1_id, cand_id, round(0.55 * p1 + 0.45 * p2, 9) AS p, CASE WHEN 0.55 * p1 + 0.45 * p2 >= 0.72 THEN 1 ELSE 0 END AS predicted FROM scored"))
def hybrid_blend(spark, sf_dir):
    p = D.blended(F.col("p1"), F.col("p2"), 0.55)
    return Linkage(spark, sf_dir).scored().select("s1_id", "cand_id", F.round(p, 9).alias("p"), D.predicted(p, 0.72).alias("predicted"))


def _trained(link: Linkage):
    from . import jobs as J

    a, b = link.sides()
    split = TP.split_entities(link.truth)
    pairs = TP.training_pairs(link.truth, link.candidates()).join(split, "s1_id")
    rows = stored(FT.features(pairs, a, b))
    return J.fitted(rows, link.truth), rows


@_query("hybrid_scores")
def hybrid_scores(spark, sf_dir):
    """Both models' probabilities of the validation pairs (model-backed, no SQL)."""
    linker, rows = _trained(Linkage(spark, sf_dir))
    return linker.probabilities(rows.where("split = 'val'")).select("s1_id", "cand_id", "label", "p1", "p2", "p")


@_query("end_to_end")
def end_to_end(spark, sf_dir):
    """Train, tune on validation pairs, link all candidates and score the validation entities end to end (model-backed, no SQL)."""
    link = Linkage(spark, sf_dir)
    linker, rows = _trained(link)
    split = TP.split_entities(link.truth).where("split = 'val'").select("s1_id")
    held = link.truth.join(split, "s1_id")
    best = E.threshold_search(held, linker.probabilities(rows.where("split = 'val'"))).first()
    linker.alpha, linker.threshold = best["best_alpha"], best["best_threshold"]
    a, b = link.sides()
    found = link.candidates().select("s1_id", "cand_id").join(split, "s1_id")
    countries = a.select(F.col("entity_id").alias("s1_id"), F.col("country").alias("a_country")), b.select(F.col("entity_id").alias("cand_id"), F.col("country").alias("b_country"))
    scored = linker.probabilities(FT.features(found, a, b)).join(countries[0], "s1_id").join(countries[1], "cand_id")
    linked = E.macro_f05(held, E.as_sets(D.safe_matches(scored, linker.threshold)))
    oracle = F.lit(float(best["best_val_macro_f05"])).alias("oracle_candidate_f05")
    return linked.select("macro_precision", "macro_recall", F.col("macro_f05").alias("end_to_end_f05"), oracle, "total_entities")


_register_views()
