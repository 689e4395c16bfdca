"""The pipeline's stages against brute force on a small table with nulls, copies and repeated lines."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from matchloom.llm import line_templates, source_mix

from .test_operators import shingle_set

rng = random.Random(11)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    boiler = prose(60)
    texts = [prose(70) + "\n" + prose(20) for _ in range(30)] + [prose(70) + "\n" + boiler for _ in range(5)]
    near = prose(120).split()
    for k in range(4):
        texts.append(" ".join(near[: 10 * k] + ["x"] + near[10 * k + 1 :]))
    texts += [None, "", "too short", texts[0], texts[0], "spam " * 80]
    rows = [(i, t, rng.choice(["en", None]), rng.choice(["s0", "s1", None]), 0 if t is None else len(t)) for i, t in enumerate(texts)]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, SCHEMA).coalesce(2).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path), {r[0]: r for r in rows}


def test_stages(spark, folder):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.stored(stage(spark, docs, path))
        found[name] = docs.collect()
        if name != "encode":
            assert docs.columns == before.columns and docs.dtypes == before.dtypes

    def passes(t):  # nothing is certified with 20 labels, so the base rule alone holds
        w = (t or "").split()
        seen = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        repeat = {k + d for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for d in range(3)}
        return len(w) >= 50 and 2 * len(repeat) <= len(w)

    good = {i: r[1] for i, r in rows.items() if passes(r[1])}
    assert {r["doc_id"]: r["text"] for r in found["quality"]} == good

    lines = {i: t.split("\n") for i, t in good.items()}
    owners = {}
    for i, own in lines.items():
        for x in own:
            owners.setdefault(x, set()).add(i)
    gone = {x: min(o) for x, o in owners.items() if len(o) >= line_templates.MIN_DOCS and len(x.split()) >= line_templates.MIN_WORDS}
    got = {r["doc_id"]: r for r in found["lines"]}
    exact = {i: "\n".join(x for x in own if gone.get(x, i) == i) for i, own in lines.items()}
    assert set(got) == set(good) and sum(got[i]["text"] != exact[i] for i in good) <= 3  # the near copies' lines may share a template
    assert all(r["n_chars"] == len(r["text"]) for r in found["lines"])

    sets = {i: shingle_set(r["text"], corpus_pipeline.NEAR_WORDS) for i, r in got.items()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in sets:
            if j < i and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= corpus_pipeline.NEAR_PERCENT * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    kept = {i for i in sets if find(i) == i}
    assert {r["doc_id"] for r in found["near"]} == kept

    rows_near = spark.createDataFrame(found["near"], SCHEMA)
    keyed = source_mix.keyed(rows_near)
    copies = Counter({r["doc_id"]: r["copies"] for r in source_mix.taken(keyed, source_mix.limits(keyed)).collect() if r["_size"]})
    assert Counter(r["doc_id"] for r in found["mix"]) == +copies and max(copies.values()) <= 3

    library, text = Tokenizer.from_file(P.path("word_bpe_49k.json")), {r["doc_id"]: r["text"] for r in found["mix"]}
    assert Counter(r["doc_id"] for r in found["encode"]) == +copies
    for r in found["encode"]:
        ids = library.encode(text[r["doc_id"]], add_special_tokens=False).ids
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_empty(spark, folder):
    path, _ = folder
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, path).count() == 0


def test_clashing_columns(spark, folder):
    path, _ = folder
    extra = ["_in", "_row", "_key", "_size", "_prefix", "_n_lines", "_n_dropped", "_gone", "_doc", "target", "source_size", "epochs", "limit", "copies", "class", "kept", "component_id", "_stratum", "stratum", "n_words", "line", "size"]
    docs = spark.read.parquet(f"{path}/documents.parquet").selectExpr("*", *[f"'{c}!' AS `{c}`" for c in extra])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, corpus_pipeline.stored(stage(spark, docs, path))
        assert docs.dtypes == before.dtypes, name
        assert docs.count() and docs.where(" or ".join(f"`{c}` <> '{c}!'" for c in extra)).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, path).count() == docs.count()


def test_near_keeps_one_row_of_a_group(spark):
    copy, own = prose(80), prose(80)
    rows = [(4, copy, "en", "s", 1), (4, own, "en", "s", 2), (2, copy, "en", "s", 3), (2, copy, "en", "s", 4), (None, copy, "en", "s", 5), (None, None, None, None, 6), (None, "", None, None, 7)]
    kept = corpus_pipeline.near(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept if r["text"]) == [(2, copy), (4, own)] and len(kept) == 4
