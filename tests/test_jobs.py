"""Training, stored index, linking from files, the streams with a model and the command lines."""

import pytest

from matchloom import cli
from matchloom.operators import blocking as B
from matchloom.plans import jobs as J
from matchloom.plans.catalogue import Linkage
from matchloom.sources import records as R
from matchloom.sources.shared import stored

SMOKE = "/root/testdata/sf0.001"
SMALL = {"boosted": {"maxIter": 3, "maxDepth": 3}, "forest": {"numTrees": 3, "maxDepth": 4}}


def tsv(rows, path):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\t".join(rows.columns) + "\n" + "".join("\t".join(r) + "\n" for r in rows.collect()))


@pytest.fixture(scope="module")
def link(spark):
    return Linkage(spark, SMOKE)


@pytest.fixture(scope="module")
def model(link):
    return J.trained(*link.sides(), stored(link.truth), **SMALL)


def test_training(spark, model, tmp_path):
    linker, metrics = model
    assert len(metrics) == 8 and metrics["validation_macro_f05"] > 0.9 and metrics["total_train_pairs"] > metrics["total_val_pairs"] > 0
    J.write_metrics(spark, metrics, str(tmp_path / "m"))
    row = spark.read.json(str(tmp_path / "m")).first().asDict()
    assert set(row) == set(metrics)


def test_hard_negatives_come_twice(spark, link, model):
    from matchloom.operators import features as FT
    from matchloom.operators import pairs as TP

    rows = stored(FT.features(TP.training_pairs(link.truth, link.candidates()), *link.sides()))
    more = J.with_hard_negatives(rows, model[0].first, link.truth)
    extra = more.exceptAll(rows)
    assert more.count() >= rows.count() and extra.where("label = 1").count() == 0


def test_index(spark, link, tmp_path, monkeypatch):
    path = str(tmp_path / "index")
    assert J.index_size(spark, path) == 0
    want = B.target_index([link.targets_raw]).count()
    assert J.target_store(spark, path, link.targets_raw).count() == want == J.index_size(spark, path)
    monkeypatch.setattr(J, "REUSED_FROM", 10)
    assert J.target_store(spark, path, link.targets_raw.limit(1)).count() == want


def test_files_and_command_lines(spark, link, model, tmp_path, monkeypatch, capsys):
    data, out = tmp_path / "data", tmp_path / "out"
    for i in (1, 2, 3):
        side = link.all_raw.where(f"entity_id like 'S{i}-%'")
        tsv(side, data / "test" / f"test_source{i}.tsv")
        tsv(side, data / "train" / f"train_source{i}.tsv")
    tsv(R.derived_all(spark, SMOKE)["er_truth"], data / "train" / "train_ground_truth.tsv")
    fit = J.fitted
    monkeypatch.setattr(J, "fitted", lambda rows, truth, *_: fit(rows, truth, **SMALL))
    assert cli.main(["--mode", "infer", "--data", str(data), "--models", str(tmp_path / "none")]) == 1
    where = ["--data", str(data), "--models", str(tmp_path / "models"), "--output", str(out), "--metrics", str(tmp_path / "metrics")]
    assert cli.main([*where, "--s1-samples", "150", "--target-samples", "100", "--max-test-s1", "120"]) == 0
    lists = {r["s1_id"]: r["matches"] for r in R.read_truth(spark, str(out / "matching_results.tsv")).collect()}
    assert len(lists) == link.queries_raw.count() and 60 < sum(bool(x) for x in lists.values()) <= 120
    check = ["validate", "-m", str(out / "matching_results.tsv"), "-c", str(out / "candidate_pairs.tsv"), "-t", str(data / "test")]
    assert cli.main([*check, "--check-ids"]) == 0
    (data / "test" / "test_source3.tsv").unlink()
    capsys.readouterr()
    assert cli.main([*check, "--check-ids"]) == 0 and "test_source3.tsv not found" in capsys.readouterr().out
    tsv(link.queries_raw.limit(3), data / "test" / "test_source1.tsv")
    assert cli.main(check) == 1 and "extra_s1" in capsys.readouterr().out


def test_stream_with_model(spark, link, model, tmp_path):
    from matchloom.streaming.link import record_stream, result_stream

    few = link.queries_raw.orderBy("entity_id").limit(30)
    tsv(few, tmp_path / "in" / "a.tsv")
    targets = link.sides()[1]
    result_stream(record_stream(spark, str(tmp_path / "in")), targets, model[0], str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(240)
    J.linked(spark, model[0], few, targets, str(tmp_path / "batch"))
    for name in ("matching_results.tsv", "candidate_pairs.tsv"):
        a, b = (sorted((r["s1_id"], r["matches"]) for r in R.read_truth(spark, str(p)).collect()) for p in (tmp_path / "out" / name / "batch=0", tmp_path / "batch" / name))
        assert a == b and len(a) == 30


def test_truth_and_limits(spark, tmp_path):
    path = tmp_path / "t.tsv"
    path.write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1\nS1-2\tS2-2\nS1-1\tS2-3, S2-3,\n")
    assert {r["s1_id"]: r["matches"] for r in R.read_truth(spark, str(path)).collect()} == {"S1-1": ["S2-3"], "S1-2": ["S2-2"]}
    assert {r["s1_id"]: r["matches"] for r in R.read_truth(spark, str(path), 2).collect()} == {"S1-1": ["S2-1"], "S1-2": ["S2-2"]}
    assert R.read_tsv(spark, str(path), R.TRUTH, limit=1, use=R.TRUTH[:1]).collect() == [("S1-1",)]
