"""The 49 pairwise features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as S

# The feature columns, in order.
NAME = [
    "name_exact_raw", "name_exact_basic", "name_exact_legal", "name_exact_compact", "name_lev_basic", "name_lev_legal", "name_jw_basic",
    "name_jw_legal", "name_token_sort", "name_token_set", "name_jaccard_tokens", "name_ngram_jaccard", "name_prefix_sim",
    "name_first_token_match", "name_last_token_match", "name_len_diff", "name_len_ratio", "name_tok_diff",
]
ADDRESS = [
    "addr_s1_empty", "addr_cand_empty", "addr_both_empty", "addr_one_empty", "addr_exact", "addr_lev", "addr_jw", "addr_token_set",
    "addr_jaccard", "addr_ngram", "postal_exact", "postal_mismatch", "house_exact", "house_mismatch", "state_exact", "state_mismatch",
    "comp_agreements", "comp_conflicts",
]
INTERACTION = [
    "name_addr_product", "name_addr_mean", "name_addr_min", "name_addr_max", "name_addr_diff", "agreement_count", "country_exact",
    "country_mismatch", "country_missing", "is_source2", "is_source3", "is_empty_addr_high_name", "is_weak_name_high_addr",
]
FEATURES = NAME + ADDRESS + INTERACTION
_VIEWS = ["business_name", "basic", "legal", "compact", "tokens", "ngrams", "addr", "addr_tokens", "addr_ngrams", "postal", "house", "state", "country"]


def beside(pairs: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """Pairs (s1_id, cand_id, ...) with both records' views, as a_* and b_*; pairs with an unknown side go."""
    a = queries.select(F.col("entity_id").alias("s1_id"), *[F.col(c).alias(f"a_{c}") for c in _VIEWS])
    b = targets.select(F.col("entity_id").alias("cand_id"), *[F.col(c).alias(f"b_{c}") for c in _VIEWS])
    return pairs.join(a, "s1_id").join(b, "cand_id")


def _yes(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("double")


def _same(view: str) -> Column:
    return _yes((F.col(f"a_{view}") != "") & (F.col(f"a_{view}") == F.col(f"b_{view}")))


def _differ(view: str) -> Column:
    return _yes((F.col(f"a_{view}") != "") & (F.col(f"b_{view}") != "") & (F.col(f"a_{view}") != F.col(f"b_{view}")))


def feature_columns(pairs: DataFrame) -> DataFrame:
    """All features beside the pairs' other columns. Similarities of equal string pairs are computed once a batch."""
    def a(v):
        return F.col(f"a_{v}")
    def b(v):
        return F.col(f"b_{v}")

    out = pairs.withColumns(
        {
            "name_lev_basic": S.indel_ratio(a("basic"), b("basic")), "name_lev_legal": S.indel_ratio(a("legal"), b("legal")),
            "name_jw_basic": S.jaro_winkler_sim(a("basic"), b("basic")), "name_jw_legal": S.jaro_winkler_sim(a("legal"), b("legal")),
            "name_token_sort": S.token_sort_ratio(a("basic"), b("basic")), "name_token_set": S.token_set_ratio(a("basic"), b("basic")),
            "addr_lev": S.indel_ratio(a("addr"), b("addr")), "addr_jw": S.jaro_winkler_sim(a("addr"), b("addr")),
            "addr_token_set": S.token_set_ratio(a("addr"), b("addr")),
        }
    )
    la, lb = F.length(a("basic")), F.length(b("basic"))
    first = _yes(F.get(a("tokens"), 0) == F.get(b("tokens"), 0))
    last = _yes((F.size(a("tokens")) > 0) & (F.size(b("tokens")) > 0) & (F.try_element_at(a("tokens"), F.lit(-1)) == F.try_element_at(b("tokens"), F.lit(-1))))
    e1, e2 = a("addr") == "", b("addr") == ""
    filled = ~e1 & ~e2
    out = out.withColumns(
        {
            "name_exact_raw": _same("business_name"), "name_exact_basic": _same("basic"), "name_exact_legal": _same("legal"), "name_exact_compact": _same("compact"),
            "name_jaccard_tokens": S.jaccard(a("tokens"), b("tokens")), "name_ngram_jaccard": S.jaccard(a("ngrams"), b("ngrams")),
            "name_prefix_sim": S.prefix_ratio(a("compact"), b("compact")), "name_first_token_match": first, "name_last_token_match": last,
            "name_len_diff": F.abs(la - lb).cast("double"),
            "name_len_ratio": F.when((la == 0) | (lb == 0), F.col("name_jw_legal")).otherwise(F.least(la, lb) / F.greatest(la, lb)),
            "name_tok_diff": F.abs(F.size(a("tokens")) - F.size(b("tokens"))).cast("double"),
            "addr_s1_empty": _yes(e1), "addr_cand_empty": _yes(e2), "addr_both_empty": _yes(e1 & e2), "addr_one_empty": _yes(e1 != e2),
            "addr_exact": _yes(filled & (a("addr") == b("addr"))),
            "addr_jaccard": S.jaccard(a("addr_tokens"), b("addr_tokens")), "addr_ngram": S.jaccard(a("addr_ngrams"), b("addr_ngrams")),
            **{f"{n}_exact": _same(n) for n in ("postal", "house", "state")}, **{f"{n}_mismatch": _differ(n) for n in ("postal", "house", "state")},
        }
    )
    n, d = F.col("name_jw_legal"), F.col("addr_jw")
    c1, c2 = F.lower(F.trim(a("country"))), F.lower(F.trim(b("country")))
    agree = F.col("postal_exact") + F.col("house_exact") + F.col("state_exact")
    return out.withColumns(
        {
            "comp_agreements": agree, "comp_conflicts": F.col("postal_mismatch") + F.col("house_mismatch") + F.col("state_mismatch"),
            "name_addr_product": n * d, "name_addr_mean": (n + d) / 2, "name_addr_min": F.least(n, d), "name_addr_max": F.greatest(n, d), "name_addr_diff": F.abs(n - d),
            "agreement_count": _yes(n >= 0.85) + _yes(d >= 0.80) + agree,
            "country_exact": _yes((c1 != "") & (c1 == c2)), "country_mismatch": _yes((c1 != "") & (c2 != "") & (c1 != c2)), "country_missing": _yes((c1 == "") | (c2 == "")),
            "is_source2": _yes(F.col("cand_id").startswith("S2-")), "is_source3": _yes(F.col("cand_id").startswith("S3-")),
            "is_empty_addr_high_name": _yes(e2 & (n >= 0.90)), "is_weak_name_high_addr": _yes((n < 0.45) & (d >= 0.85)),
        }
    )


def features(pairs: DataFrame, queries: DataFrame, targets: DataFrame) -> DataFrame:
    """The pairs' own columns and the 49 features, in order."""
    own = pairs.columns
    return feature_columns(beside(pairs, queries, targets)).select(*own, *FEATURES)
