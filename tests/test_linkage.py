"""The record-linkage operators: fixed expectations, properties and small brute force."""

import random

import pytest
from pyspark.sql import functions as F

from matchloom.functions import similarity as S
from matchloom.functions import text as X
from matchloom.operators import blocking as B
from matchloom.operators import decide as D
from matchloom.operators import evaluate as E
from matchloom.operators import features as FT
from matchloom.operators import pairs as TP
from matchloom.operators import tfidf as TF
from matchloom.operators import validate as V
from matchloom.plans.catalogue import Linkage
from matchloom.sources import records as R

SMOKE = "/root/testdata/sf0.001"


def one(spark, build, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(build(*[F.col(k) for k in values]).alias("x")).first()["x"]


@pytest.mark.parametrize("text,expected", [("Bordeaux, Nouvelle-Aquitaine", "bordeaux, nouvelle-aquitaine"), ("Hôtel & Café", "hotel & cafe"), (None, "")])
def test_unicode(spark, text, expected):
    assert one(spark, X.normalize_unicode, t=text) == expected


@pytest.mark.parametrize(
    "name,legal",
    [("Acme Solutions Private Limited", "acme"), ("acme limited liability company", "acme liability"), ("Group Holdings", "group holdings"), ("", "")],
)
def test_legal(spark, name, legal):
    assert one(spark, lambda t: X.name_legal(X.name_basic(t)), t=name) == legal


def test_address_views(spark):
    assert one(spark, X.address_basic, t="123 Main St, Suite 400, Rd 5") == "123 main street suite 400 road 5"
    assert one(spark, X.address_basic, t="Miami, FL 33101") == "miami floor 33101"


@pytest.mark.parametrize(
    "address,country,postal,house,state",
    [
        ("1795 Westchester Drive, High Point, NC 27262", "US", "27262", "1795", "north carolina"),
        ("United Plaza, 12 Main St", "US", None, None, None),
        ("Suite 400, 12 Main St", "", None, "400", None),
        ("12345 Main St, Denver, CO 80202", "US", "12345", "12345", "colorado"),
        ("Near temple in Pune", "", None, None, "indiana"),
        ("Bergstr 7, 10115 Berlin", "Germany", "10115", "10115", None),
    ],
)
def test_components(spark, address, country, postal, house, state):
    assert one(spark, X.postal_code, a=address, c=country) == postal
    assert one(spark, lambda a, c: X.house_number(a), a=address, c=country) == house
    assert one(spark, X.state, a=address, c=country) == state


def test_ngrams(spark):
    assert one(spark, X.ngrams, t="ab") == ["ab"]
    assert one(spark, X.ngrams, t="") == []
    assert one(spark, X.ngrams, t="abcab") == ["abc", "bca", "cab"]


def test_lcs_against_table():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randint(0, 12))) for _ in range(2))
        row = [0] * (len(b) + 1)
        for c in a:
            new = [0]
            for j, d in enumerate(b):
                new.append(row[j] + 1 if c == d else max(row[j + 1], new[j]))
            row = new
        assert S.lcs_length(a, b) == row[-1]


def test_similarity_properties():
    rng = random.Random(2)
    for f in (S.indel, S.token_sort, S.token_set, S.jaro_winkler):
        assert f("", "a") == f("", "") == 0.0 and f("abc d", "abc d") == 1.0
        for _ in range(200):
            a, b = ("".join(rng.choice("ab c") for _ in range(rng.randint(1, 9))).strip() for _ in range(2))
            assert 0.0 <= f(a, b) <= 1.0 + 1e-12
            if f is not S.jaro_winkler:
                assert f(a, b) == pytest.approx(f(b, a))
    assert S.jaro_winkler("martha", "marhta") == pytest.approx(0.9611111)
    assert S.token_set("acme group", "acme group of x") == 1.0


def test_prefix(spark):
    assert one(spark, S.prefix_ratio, a="x" * 20, b="x" * 20) == 0.5
    assert one(spark, S.prefix_ratio, a="", b="x") == 0.0


RECORDS = [("S1-1", "Apex Industrial Corporation", "500 Market Street, Denver, Colorado 80202", "US"), ("S2-1", "Apex Industrial Corp", "500 Market St, Denver, CO 80202", "US"), ("S2-2", "Zeta", "", "")]


def test_blocking_and_features(spark):
    rows = B.normalised(spark.createDataFrame(RECORDS, R.RECORD))
    a, b = rows.where("source = 'S1'"), rows.where("source = 'S2'")
    found = B.candidates(a, b)
    assert [r["cand_id"] for r in found.collect()] == ["S2-1"]
    vector = FT.features(spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S2-2"), ("S1-1", "S2-9")], "s1_id string, cand_id string"), a, b).collect()
    assert len(FT.FEATURES) == 49 and len(vector) == 2
    for r in vector:
        assert all(r[f] is not None and r[f] == r[f] for f in FT.FEATURES)
    empty = next(r for r in vector if r["cand_id"] == "S2-2")
    assert empty["addr_jw"] == 0 and empty["addr_cand_empty"] == 1 and empty["addr_one_empty"] == 1 and empty["addr_both_empty"] == 0


def test_caps(spark):
    many = spark.range(500).select(F.lit(1).alias("rule"), F.lit("k").alias("block_key"), F.format_string("S2-%03d", "id").alias("entity_id"), F.lit("S2").alias("source"))
    assert [r[0] for r in B.capped(many, 3).select("entity_id").orderBy("entity_id").collect()] == ["S2-000", "S2-001", "S2-002"]
    link = Linkage(spark, SMOKE)
    assert link.candidates().groupBy("s1_id").count().agg(F.max("count")).first()[0] <= B.MAX_CANDIDATES


@pytest.mark.parametrize(
    "true,pred,expected", [([], [], (1, 1, 1)), ([], ["x"], (0, 1, 0)), (["x"], [], (1, 0, 0)), (["a", "b"], ["a", "b"], (1, 1, 1)), (["S2-00047", "S3-00812"], ["S2-00047", "S3-00812", "S2-00193"], (2 / 3, 1, 0.714285))]
)
def test_f05(spark, true, pred, expected):
    truth = spark.createDataFrame([("e", true)], "s1_id string, matches array<string>")
    got = E.entity_f05(truth, spark.createDataFrame([("e", pred)], "s1_id string, ids array<string>")).first()
    assert (got["precision"], got["recall"], got["f05"]) == pytest.approx(expected, abs=1e-6)


def test_tfidf_scores_equal_texts_once(spark):
    texts = ["large ring", "hot bolt", "blue ring", "large bolt 7", "hot ring"]
    rows = [(f"S2-{i:03d}", texts[i % 5]) for i in range(60)] + [("S2-900", "zinc"), ("S2-901", None)]
    queries = spark.createDataFrame([(f"S1-{i}", texts[i % 2]) for i in range(7)] + [("S1-x", "qqq"), ("S1-y", None)], "id string, text string")
    targets = spark.createDataFrame(rows, "id string, text string")
    assert TF._classes(TF._units(targets)).count() == 7  # one for each text, and that of no text
    got = {}
    for r in TF.top_k(queries, targets, k=15).orderBy("s1_id", "rank").collect():
        got.setdefault(r["s1_id"], []).append((r["cand_id"], r["cosine"], r["rank"]))
    assert sorted(got) == [f"S1-{i}" for i in range(7)]
    for i in range(7):
        own = got[f"S1-{i}"]
        assert [c for c, _, _ in own[:12]] == [f"S2-{j:03d}" for j in range(60) if j % 5 == i % 2] and [n for _, _, n in own] == list(range(1, 16))
        assert all(x == pytest.approx(1, abs=1e-8) for _, x, _ in own[:12]) and all(x == own[12][1] < 1 for _, x, _ in own[12:])
        assert [c for c, _, _ in own[12:]] == sorted(c for c, _, _ in own[12:]) and own == got[f"S1-{i % 2}"]


def test_grid_places_each_pair_once(spark):
    g = random.Random(8)
    truth = [(f"S1-{i}", [f"S2-{i}-{j}" for j in range(i % 3)]) for i in range(40)]
    pairs = [(s, f"{s.replace('S1', 'S2')}-{j}", g.randint(0, 50) / 50, g.randint(0, 50) / 50, int(j < len(ids))) for s, ids in truth for j in range(g.randint(0, 6))]
    pairs += [("S1-0", "S2-x", None, 0.9, 0), ("S1-none", "S2-y", 1.0, 1.0, 1)]
    lists = spark.createDataFrame(truth, "s1_id string, matches array<string>")
    scored = spark.createDataFrame(pairs, "s1_id string, cand_id string, p1 double, p2 double, label int")
    frame = E.grid_scores(lists, scored, E.coarse_grid(spark))
    assert "CartesianProduct" not in (plan := frame._jdf.queryExecution().optimizedPlan().toString()) and "alpha * p1" not in plan and "MapInArrow" in plan
    for r in frame.collect():
        total = 0.0
        for s, ids in truth:
            hits = [x[4] for x in pairs if x[0] == s and x[2] is not None and round(r["alpha"] * x[2] + (1 - r["alpha"]) * x[3], 9) >= round(r["tau"], 9)]
            n, m, h = len(ids), len(hits), sum(hits)
            p, q = (1.0 if m == 0 else 0.0 if n == 0 else h / m), (1.0 if n == 0 else 0.0 if m == 0 else h / n)
            total += 1.25 * p * q / (0.25 * p + q) if p > 0 and q > 0 else 0.0
        assert r["macro_f05"] == pytest.approx(total / len(truth), abs=2e-9)
    best = E.threshold_search(lists, scored).first()
    assert best["best_val_macro_f05"] >= max(r["macro_f05"] for r in frame.collect()) - 1e-5


def test_threshold_search_groups_the_scores_once(spark, monkeypatch):
    calls, group = [], E._entities
    monkeypatch.setattr(E, "_entities", lambda *a, **b: calls.append(1) or group(*a, **b))
    lists = spark.createDataFrame([("a", ["x"]), ("b", [])], "s1_id string, matches array<string>")
    scored = spark.createDataFrame([("a", 0.9, 0.8, 1), ("a", 0.6, 0.5, 0), ("b", 0.55, 0.7, 0)], "s1_id string, p1 double, p2 double, label int")
    assert E.threshold_search(lists, scored).first()["best_val_macro_f05"] == 1.0 and len(calls) == 1


def test_split_and_pairs(spark):
    link = Linkage(spark, SMOKE)
    split = TP.split_entities(link.truth).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in split} == {"train": 160, "val": 40}
    pairs = TP.training_pairs(link.truth, link.candidates())
    assert pairs.count() == pairs.select("s1_id", "cand_id").distinct().count()


def test_guard(spark):
    rows = spark.createDataFrame([("e", "a", 0.94, "US", "India"), ("e", "b", 0.95, "US", "India"), ("e", "c", 0.6, "US", ""), ("e", "d", 0.4, "US", "US")], "s1_id string, cand_id string, p double, a_country string, b_country string")
    assert {r["cand_id"] for r in D.safe_matches(rows, 0.5).collect()} == {"b", "c"}
    blend = spark.range(1).select(D.blended(F.lit(0.85), F.lit(0.85), 0.6).alias("p")).first()["p"]
    assert blend == pytest.approx(0.85)
    with pytest.raises(ValueError):
        D.blended(None, None, 0.5)


def test_files_and_validator(spark, tmp_path):
    source = tmp_path / "s.tsv"
    source.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS2-1\tA "quoted" name\t1 Main\tUS\nS2-2\tshort\n\nS2-3\ta\tb\tc\textra\n')
    rows = {r["entity_id"]: r for r in R.read_tsv(spark, str(source)).collect()}
    assert set(rows) == {"S2-1", "S2-2", "S2-3"} and rows["S2-2"]["country"] == "" and rows["S2-1"]["business_name"] == 'A "quoted" name'
    assert {r["entity_id"] for r in R.read_raw_tsv(spark, str(source)).collect()} == set(rows)
    assert V.header_errors(spark, str(source)) == [] and V.truth_header_errors(spark, str(source)) and V.header_errors(spark, str(tmp_path / "none"))
    lists = spark.createDataFrame([("S1-1", ["S2-1", "S2-2"]), ("S1-2", [])], "s1_id string, ids array<string>")
    R.write_lists(lists, str(tmp_path / "out"))
    back = {r["s1_id"]: r["matches"] for r in R.read_truth(spark, str(tmp_path / "out")).collect()}
    assert back == {"S1-1": ["S2-1", "S2-2"], "S1-2": []}
    good = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "")], "s1_id string, list string")
    need = spark.createDataFrame([("S1-1",), ("S1-2",)], "id string")
    assert V.validate_results(good, good, need, R.read_tsv(spark, str(source)).select(F.col("entity_id").alias("id"))).count() == 0
    bad = spark.createDataFrame([("S1-1", "S2-1,S2-1"), ("S1-1", "S1-1"), ("S1-9", "S2-1,")], "s1_id string, list string")
    assert {r["rule"] for r in V.list_violations(bad, need).collect()} == {"dup_row", "intra_dup", "self_match", "wrong_prefix", "missing_s1", "extra_s1"}


def test_stream_equals_batch(spark, tmp_path):
    from matchloom.streaming.link import link_stream, record_stream

    link = Linkage(spark, SMOKE)
    link.queries_raw.coalesce(2).write.option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(str(tmp_path / "in"))
    out = []
    _, targets = link.sides()
    query = link_stream(record_stream(spark, str(tmp_path / "in")), targets, lambda df, n: out.extend(df.collect()), str(tmp_path / "state"))
    query.awaitTermination(240)
    assert {tuple(r) for r in out} == {tuple(r) for r in link.candidates().collect()}


def test_models_round_trip(spark, tmp_path):
    from pyspark.sql.functions import rand

    from matchloom.operators import models as M

    rows = spark.range(120).select("id", (F.col("id") % 2).cast("int").alias("label"), *[((F.col("id") % 2) + rand(i) * 0.1).alias(f) for i, f in enumerate(FT.FEATURES)])
    linker = M.HybridLinker(M.train_boosted(rows, {"maxIter": 2}), M.train_forest(rows, {"numTrees": 3}), 0.6, 0.75)
    linker.save(str(tmp_path / "model"))
    again = M.HybridLinker.load(spark, str(tmp_path / "model"))
    assert (again.alpha, again.threshold) == (0.6, 0.75)
    a = [r["p"] for r in linker.probabilities(rows).orderBy("id").collect()]
    assert a == [r["p"] for r in again.probabilities(rows).orderBy("id").collect()] and all(0 <= p <= 1 for p in a)


def test_target_index(spark):
    rows = [(f"S{s}-{i}", f"{c}{i}", "", "US") for s in (2, 3) for i in range(5) for c in "ba"] + [(" ", "x", "", "US")]
    raw = spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string")
    assert {(r["entity_id"], r["business_name"]) for r in B.target_index([raw]).collect()} == {(f"S{s}-{i}", f"a{i}") for s in (2, 3) for i in range(5)}
    assert {r["entity_id"] for r in B.target_index([raw], per_source=2).collect()} == {"S2-0", "S2-1", "S3-0", "S3-1"}


def test_target_index_whole(spark):
    import __spark_entry__ as entry

    sf_dir = "/root/testdata/sf0.01"
    got = [r["entity_id"] for r in entry.queries()["target_index_whole"](spark, sf_dir).collect()]
    assert len(got) > 2000 and sorted(got) == sorted(r["entity_id"] for r in Linkage(spark, sf_dir).targets_raw.collect())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
