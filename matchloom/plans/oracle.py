"""DuckDB SQL of the record-linkage queries: common table expressions and helpers."""

from __future__ import annotations

from ..functions import patterns as P
from ..operators import evaluate as E
from ..operators import pairs as T
from ..sources.records import source_sql


def norm(x: str) -> str:
    return f"trim(lower(strip_accents({x})))"


def sub(x: str, pattern: str, by: str) -> str:
    return f"regexp_replace({x}, '{pattern}', '{by}', 'gi')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def plain(x: str) -> str:
    return collapse(f"regexp_replace({x}, '[^a-z0-9\\s]', ' ', 'g')")


def name_basic(x: str) -> str:
    ampersand = f"replace({norm(x)}, '&', ' and ')"
    return plain(sub(ampersand, P.DOMAIN, r"\1"))


def address_basic(x: str) -> str:
    out = norm(x)
    for short, long in P.ABBREVIATIONS.items():
        out = sub(out, rf"\b{short}\b", long)
    return plain(out)


def words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


def grams(c: str) -> str:
    return f"CASE WHEN length({c}) >= 3 THEN list_distinct(list_transform(range(1, length({c}) - 1), lambda i: substr({c}, i::INT, 3))) WHEN {c} <> '' THEN [{c}] ELSE [] END"


def _first(x: str, pattern: str, group: int = 1) -> str:
    return f"nullif(regexp_extract({x}, '{pattern}', {group}, 'i'), '')"


def postal(address: str, country: str) -> str:
    hits = {c: _first(address, p) for c, p in P.POSTAL.items()}
    cases = " ".join(f"WHEN '{c}' THEN {hit}" for c, hit in hits.items())
    return f"CASE upper(trim({country})) {cases} ELSE coalesce({', '.join(hits.values())}) END"


def house(address: str) -> str:
    hit = f"lower(coalesce({_first(address, P.HOUSE, 1)}, {_first(address, P.HOUSE, 2)}))"
    return f"CASE WHEN regexp_matches({hit}, '[0-9]') THEN {hit} END"


def state(address: str, country: str) -> str:
    text = norm(address)
    codes = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in P.US_STATES.items())
    us = f"coalesce(CASE {_first(text, P.US_STATE, 1)} {codes} END, {_first(text, P.US_STATE, 2)})"
    india = _first(text, P.INDIA_STATE)
    return f"CASE upper(trim({country})) WHEN 'US' THEN {us} WHEN 'INDIA' THEN {india} WHEN '' THEN coalesce({us}, {india}) END"


def jaccard(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE len(list_intersect({a}, {b}))::DOUBLE / len(list_distinct(list_concat({a}, {b}))) END"


def lcs(a: str, b: str) -> str:
    """The longest common subsequence's length: rows of the table, folded over the characters of a."""
    columns = f"string_split({b}, '')"
    hits = f"list_transform(string_split({a}, ''), lambda ch: list_transform({columns}, lambda x: CASE WHEN x = ch THEN 1 ELSE 0 END))"
    step = "[CASE WHEN hit[j] = 1 THEN (CASE WHEN j > 1 THEN prev[j - 1] ELSE 0 END) + 1 ELSE prev[j] END]"
    row = f"list_reduce(list_concat([[0]], list_transform(range(1, len(hit) + 1), lambda j: {step})), lambda acc, e: list_append(acc, greatest(acc[len(acc)], e[1])))[2:]"
    return f"list_reduce(list_concat([list_transform({columns}, lambda x: 0)], {hits}), lambda prev, hit: {row})[-1]"


def indel(a: str, b: str) -> str:
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 WHEN {a} = {b} THEN 1.0 ELSE 2.0 * ({lcs(a, b)})::DOUBLE / (length({a}) + length({b})) END"


def jw(a: str, b: str) -> str:
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 WHEN {a} = {b} THEN 1.0 ELSE jaro_winkler_similarity({a}, {b}) END"


def sorted_words(x: str) -> str:
    return f"array_to_string(list_sort({words(x)}), ' ')"


def prefix(a: str, b: str) -> str:
    shorter = f"least(length({a}), length({b}))"
    hits = f"len(list_filter(range(1, 11), lambda i: i <= {shorter} AND left({a}, i) = left({b}, i)))"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE {hits}::DOUBLE / {shorter} END"


_STOP = ", ".join(f"'{w}'" for w in P.STOP_WORDS)
_DICE = f"md5('{T.SEED}|' || "

#: Results with seeded faults, derived from the truth; the same text runs in Spark and DuckDB.
FAULTY = """
select case when p_partkey % 50 = 4 then 'S1-X' || cast(p_partkey as {s}) else source1_entity_id end as s1_id,
       case p_partkey % 50 when 2 then 'S2-1,S2-1' when 3 then source1_entity_id when 6 then 'S9-1,S2-999999' when 7 then 'S2-1,' else matched_entity_ids end as list
from ({truth}) t where p_partkey % 50 <> 1
union all select source1_entity_id, matched_entity_ids from ({truth}) u where p_partkey % 50 = 5
"""


def faulty_sql(dialect: str = "spark") -> str:
    truth = source_sql("er_truth", dialect).replace("select ", "select p_partkey, ", 1)
    return FAULTY.format(s="string" if dialect == "spark" else "varchar", truth=truth)


def _common() -> str:
    sources = ",\n".join(f"{n} AS ({source_sql(n, 'duckdb')})" for n in ("er_s1", "er_s2", "er_s3", "er_truth"))
    return f"""
{sources},
er_all AS (SELECT * FROM er_s1 UNION ALL SELECT * FROM er_s2 UNION ALL SELECT * FROM er_s3),
r0 AS (SELECT *, left(entity_id, 2) AS source, {name_basic('business_name')} AS basic, {address_basic('business_address')} AS addr FROM er_all),
r1 AS (SELECT *, coalesce(nullif({collapse(sub('basic', P.LEGAL, ' '))}, ''), basic) AS legal FROM r0),
r2 AS (SELECT *, regexp_replace(legal, '[^a-z0-9]', '', 'g') AS compact, {words('legal')} AS tokens, regexp_replace(addr, '[^a-z0-9]', '', 'g') AS addr_compact, {words('addr')} AS addr_tokens,
       {postal('business_address', 'country')} AS postal, {house('business_address')} AS house, {state('business_address', 'country')} AS state FROM r1),
rec AS (SELECT *, {grams('compact')} AS ngrams, {grams('addr_compact')} AS addr_ngrams FROM r2),
placed AS (SELECT entity_id, source, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS i FROM rec),
top2 AS (SELECT DISTINCT entity_id, source, token FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY length(token) DESC, i) AS n FROM placed WHERE length(token) >= 4 AND token NOT IN ({_STOP})) WHERE n <= 2),
longest AS (SELECT entity_id, source, token FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY length(token) DESC, i) AS n FROM placed) WHERE n = 1),
keys AS (
  SELECT 1 AS rule, legal AS block_key, entity_id, source FROM rec WHERE legal <> ''
  UNION ALL SELECT 2, left(compact, 6), entity_id, source FROM rec WHERE length(compact) >= 6
  UNION ALL SELECT 3, token, entity_id, source FROM top2
  UNION ALL SELECT 4, lower(trim(postal)), entity_id, source FROM rec WHERE postal IS NOT NULL
  UNION ALL SELECT 5, state || '_' || tokens[1], entity_id, source FROM rec WHERE state IS NOT NULL AND length(tokens[1]) >= 3
  UNION ALL SELECT 6, house || '_' || addr_tokens[1], entity_id, source FROM rec WHERE house IS NOT NULL AND length(addr_tokens[1]) >= 3),
ikeys AS (
  SELECT 1 AS rule, 'n_' || legal AS block_key, entity_id, source FROM rec WHERE length(legal) >= 3
  UNION ALL SELECT 2, 'p_' || left(compact, 8), entity_id, source FROM rec WHERE length(compact) >= 8
  UNION ALL SELECT 3, 't_' || token, entity_id, source FROM longest WHERE length(token) >= 5
  UNION ALL SELECT 4, 'z_' || postal, entity_id, source FROM rec WHERE postal IS NOT NULL
  UNION ALL SELECT 5, 'sn_' || state || '_' || tokens[1], entity_id, source FROM rec WHERE state IS NOT NULL AND len(tokens) > 0),
idx AS (SELECT * FROM keys WHERE source <> 'S1' QUALIFY row_number() OVER (PARTITION BY rule, block_key ORDER BY source, entity_id) <= 200),
cand0 AS (SELECT q.entity_id AS s1_id, t.entity_id AS cand_id, min(q.rule) AS rule FROM keys q JOIN idx t ON q.rule = t.rule AND q.block_key = t.block_key WHERE q.source = 'S1' GROUP BY ALL),
cand AS (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY rule, cand_id) AS rank FROM cand0 QUALIFY rank <= 25),
icand0 AS (SELECT q.entity_id AS s1_id, t.entity_id AS cand_id, min(q.rule) AS rule FROM ikeys q JOIN ikeys t ON q.rule = t.rule AND q.block_key = t.block_key WHERE q.source = 'S1' AND t.source <> 'S1' GROUP BY ALL),
icand AS (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY rule, cand_id) AS rank FROM icand0 QUALIFY rank <= 25),
truth AS (SELECT source1_entity_id AS s1_id, CASE WHEN matched_entity_ids = '' THEN [] ELSE string_split(matched_entity_ids, ',') END AS matches FROM er_truth),
tpairs AS (SELECT s1_id, unnest(matches) AS cand_id FROM truth),
side AS (SELECT p.s1_id, p.cand_id, a.business_name AS a_raw, b.business_name AS b_raw, a.basic AS a_basic, b.basic AS b_basic, a.legal AS a_legal, b.legal AS b_legal, a.compact AS a_compact, b.compact AS b_compact,
    a.tokens AS a_tokens, b.tokens AS b_tokens, a.ngrams AS a_ngrams, b.ngrams AS b_ngrams, a.addr AS a_addr, b.addr AS b_addr, a.addr_tokens AS a_at, b.addr_tokens AS b_at, a.addr_ngrams AS a_ag, b.addr_ngrams AS b_ag,
    a.postal AS a_postal, b.postal AS b_postal, a.house AS a_house, b.house AS b_house, a.state AS a_state, b.state AS b_state, lower(trim(a.country)) AS c1, lower(trim(b.country)) AS c2
  FROM tpairs p JOIN rec a ON a.entity_id = p.s1_id JOIN rec b ON b.entity_id = p.cand_id),
setside AS (SELECT *, {sorted_words('a_basic')} AS a_sorted, {sorted_words('b_basic')} AS b_sorted,
    array_to_string(list_sort(list_intersect(list_distinct({words('a_basic')}), {words('b_basic')})), ' ') AS common,
    array_to_string(list_sort(list_filter(list_distinct({words('a_basic')}), lambda t: NOT list_contains({words('b_basic')}, t))), ' ') AS lefts,
    array_to_string(list_sort(list_filter(list_distinct({words('b_basic')}), lambda t: NOT list_contains({words('a_basic')}, t))), ' ') AS rights,
    array_to_string(list_sort(list_intersect(list_distinct(a_at), b_at)), ' ') AS acommon,
    array_to_string(list_sort(list_filter(list_distinct(a_at), lambda t: NOT list_contains(b_at, t))), ' ') AS alefts,
    array_to_string(list_sort(list_filter(list_distinct(b_at), lambda t: NOT list_contains(a_at, t))), ' ') AS arights FROM side),
sets AS (SELECT *, trim(common || ' ' || lefts) AS one, trim(common || ' ' || rights) AS two, trim(acommon || ' ' || alefts) AS aone, trim(acommon || ' ' || arights) AS atwo FROM setside),
scored AS (SELECT c.s1_id, c.cand_id, round(0.5 * ({jaccard('a.tokens', 'b.tokens')}) + 0.5 * ({jaccard('a.ngrams', 'b.ngrams')}), 6) AS p1, round({jaccard('a.ngrams', 'b.ngrams')}, 6) AS p2,
    a.country AS a_country, b.country AS b_country, CASE WHEN list_contains(t.matches, c.cand_id) THEN 1 ELSE 0 END AS label
  FROM cand c JOIN rec a ON a.entity_id = c.s1_id JOIN rec b ON b.entity_id = c.cand_id JOIN truth t ON t.s1_id = c.s1_id),
pred AS (SELECT s1_id, list_sort(list(cand_id)) AS ids FROM scored WHERE p1 >= 0.5 GROUP BY s1_id),
sized AS (SELECT t.s1_id, t.matches, coalesce(p.ids, []) AS ids, len(t.matches) AS n, len(coalesce(p.ids, [])) AS m, len(list_intersect(t.matches, coalesce(p.ids, []))) AS h FROM truth t LEFT JOIN pred p ON p.s1_id = t.s1_id),
faulty AS ({faulty_sql('duckdb')}),
faulty_ids AS (SELECT s1_id, unnest(string_split(list, ',')) AS id FROM faulty WHERE list <> '')
"""


COMMON = _common()


def token_set(a: str, b: str, common: str, lefts: str, rights: str, one: str, two: str) -> str:
    with_common = f"greatest({indel(one, two)}, {indel(common, one)}, {indel(common, two)})"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 WHEN {a} = {b} THEN 1.0 WHEN {common} <> '' AND ({lefts} = '' OR {rights} = '') THEN 1.0 WHEN {common} <> '' THEN {with_common} ELSE {indel(one, two)} END"


P_SQL = "CASE WHEN m = 0 THEN 1.0 WHEN n = 0 THEN 0.0 ELSE h::DOUBLE / m END"
R_SQL = "CASE WHEN n = 0 THEN 1.0 WHEN m = 0 THEN 0.0 ELSE h::DOUBLE / n END"
F_SQL = "CASE WHEN p > 0 AND r > 0 THEN 1.25 * p * r / (0.25 * p + r) ELSE 0.0 END"


def query(select: str, more: str = "") -> str:
    return f"WITH {COMMON}{more} {select}"


def flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"


def split_sql() -> str:
    return f"""SELECT s1_id, CASE WHEN row_number() OVER (ORDER BY {_DICE} s1_id), s1_id) <= floor(count(*) OVER () * {T.TRAIN_SHARE}) THEN 'train' ELSE 'val' END AS split FROM (SELECT DISTINCT s1_id FROM truth)"""


def training_sql() -> str:
    return f""", others AS (SELECT c.s1_id, c.cand_id, CASE WHEN len(t.matches) = 0 THEN 2 ELSE greatest(1, floor({T.NEGATIVES} * len(t.matches))) END AS quota
  FROM cand c JOIN truth t ON t.s1_id = c.s1_id WHERE NOT list_contains(t.matches, c.cand_id)),
training AS (SELECT s1_id, cand_id, 1 AS label FROM tpairs UNION ALL
  SELECT s1_id, cand_id, 0 FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY {_DICE} s1_id || '|' || cand_id), cand_id) AS n FROM others) WHERE n <= quota)"""


def grid_sql(alphas: str, taus: str, name: str) -> str:
    """CTEs that score a grid of (ai, ti, alpha, tau)."""
    return f"""
{name}g AS (SELECT a.i AS ai, t.i AS ti, a.v AS alpha, t.v AS tau FROM ({alphas}) a, ({taus}) t),
{name}e AS (SELECT ai, ti, s1_id, count(*) AS m, sum(label) AS h FROM scored, {name}g WHERE round(alpha * p1 + (1 - alpha) * p2, 9) >= round(tau, 9) GROUP BY ALL),
{name}f AS (SELECT ai, ti, n, {P_SQL} AS p, {R_SQL} AS r FROM {name}e JOIN (SELECT s1_id, len(matches) AS n FROM truth) USING (s1_id)),
{name}s AS (SELECT ai, ti, sum(({F_SQL}) - CASE WHEN n = 0 THEN 1 ELSE 0 END) AS gain FROM {name}f GROUP BY ALL),
{name} AS (SELECT ai, ti, alpha, tau, round((coalesce(gain, 0.0) + (SELECT count(*) FROM truth WHERE len(matches) = 0)) / (SELECT count(*) FROM truth), 9) AS macro_f05 FROM {name}g LEFT JOIN {name}s USING (ai, ti))"""


COARSE_ALPHAS = "SELECT unnest(range({n})) AS i, unnest([{v}]::DOUBLE[]) AS v".format(n=len(E.ALPHAS), v=", ".join(map(str, E.ALPHAS)))
COARSE_TAUS = f"SELECT i, {E.TAU_LOW}::DOUBLE + {E.TAU_STEP}::DOUBLE * i AS v FROM range({E.TAU_COUNT}) r(i)"
