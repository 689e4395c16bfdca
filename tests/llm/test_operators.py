"""The operators against brute force, and their edge cases: nulls, empty and long texts, ties, repeats, empty tables, extra columns."""

import collections
import hashlib
import math
import random
import re
import tracemalloc
import zlib
from re import _constants as sre_constants
from re import _parser as sre_parser

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from matchloom.llm import bpe_transducer, components, exact_topk, license_scan, line_templates, minhash_dedup, quality_rules, source_mix, suffix_tree_lm, textvec, url_filter, warc_fixity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
rng = random.Random(7)
WORDS = ["alpha", "beta", "gamma", "delta", "Of", "the", "x1", "naïve", "Ωmega", "漢字", "a", "#", "|"]


def prose(n):
    return "".join(rng.choice(WORDS) + rng.choice([" ", " ", "\n", "  ", "\t"]) for _ in range(n))


ODD = [None, "", " \n\t ", "one", "two words", "A b C a B c a b c", "line one two\nline one two\n\nx", "\x00\x01 nul", "x" * 3000, "Σίσυφος ΟΔΟΣ İ ﬁ 👍🏽 <|endoftext|> it's"]


def table(spark, texts, first=0):
    rows = [(first + i, t, ["en", "de", None][i % 3], ["s0", "s1", None][i % 3], 0 if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def words(t):
    return (t or "").encode().split()


def test_words_and_windows():
    texts = ODD + [prose(rng.randint(0, 60)) for _ in range(60)]
    hashes, offs, *_ = textvec.words(pa.array(texts), textvec.LOWER)
    seen = {}
    for i, t in enumerate(texts):
        own = (t or "").encode().lower().split()
        assert offs[i + 1] - offs[i] == len(own)
        for w, h in zip(own, hashes[offs[i] : offs[i + 1]]):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("steps", [10, 12, 14])
def test_thue_morse_words_differ(steps):
    a, b = "a", "b"
    for _ in range(steps):
        a, b = a + b, b + a
    hashes, *_ = textvec.words(pa.array([f"{a} {b}"]))
    assert hashes[0] != hashes[1]
    assert quality_rules.features(pa.array([f"{a}\n{b}"]))["n_dup_lines"].tolist() == [0]


def test_long_words_in_portions(monkeypatch):
    texts = [" ".join("".join(rng.choice("abcXé") for _ in range(rng.randint(1, 60))) for _ in range(40)) for _ in range(20)]
    whole, *_ = textvec.words(pa.array(texts), textvec.LOWER)
    monkeypatch.setattr(textvec, "SEGMENT", 3)
    assert (textvec.words(pa.array(texts), textvec.LOWER)[0] == whole).all()


def test_op1_cascade_is_exact():
    g = np.random.default_rng(1)
    h1, h2 = (g.integers(0, 1 << 63, 20000).astype(np.uint64) for _ in range(2))
    for share in (0.0, 0.001, 0.1, 0.5, 1.0):
        listed = g.random(20000) < share
        assert (url_filter.contains(url_filter.build_cascade(h1, h2, listed), h1, h2) == listed).all()


def test_op1_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/x?y", "http://example.org/en/12", "http://example.org/en", "http://xexample.org/es/", "http://a.com/fr/#f", "http://a.com/de/", "x://b.net/p?q", "x://b.net/p#q", "http://org/", "http://org", "http://long.de/" + "p" * 100_000, "http://" + "h." * 20_000 + "com/fr/"]
    pages = spark.createDataFrame([(i % 12, u, "h") for i, u in enumerate(urls * 2)], "page_id long, url string, rule string")
    listed = spark.createDataFrame([("b.net/p",), ("",), (None,), ("not/there",)], "key string")
    got = collections.Counter((r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, listed).collect())
    expected = collections.Counter()
    for u in urls * 2:
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
        fits = [(r, v) for r, v in url_filter.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
        rule, verdict = max(fits, key=lambda x: len(x[0])) if fits else (None, "block" if host + path == "b.net/p" else "allow")
        expected[(host, path, rule, verdict)] += 1
    assert got == expected
    assert url_filter.judge_urls(pages.limit(0), listed).count() == 0


def test_op1_equal_halves_end():
    g = np.random.default_rng(2)
    h1, h2 = (g.integers(0, 1 << 63, 600).astype(np.uint64) for _ in range(2))
    h1[:200], h2[200:400] = h1[0], h2[200]
    for most in (url_filter.LEVELS, 3, 0):
        for listed in (np.arange(600) % 2 == 0, np.arange(600) == 1, np.ones(600, bool)):
            levels = url_filter.build_cascade(h1, h2, listed, most)
            assert len(levels) <= min(most, 30) + (most < 30) and (url_filter.contains(levels, h1, h2) == listed).all()


def test_op1_rounds(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    found = url_filter.cascade(keys, keys.where("key like '%7'"), shard_keys=500)
    assert found.n_shards > 3
    h1, h2 = url_filter.key_hashes(F.col("key"))
    rows = keys.select("key", h1.alias("h1"), h2.alias("h2"))
    for part in (1, 3):
        told = url_filter.with_hits(rows, found, round_bytes=found.bytes // part + 1).collect()
        assert len(told) == 3000 and all(r["hit"] == r["key"].endswith("7") for r in told)


def brute_top(rows, k=20, step=20):
    out = {}
    q = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(64 * x) for x in v):
            q.setdefault(i, []).append([math.floor(64 * x) for x in v])
    flat = [(i, v) for i, vs in q.items() for v in vs]
    for i, vs in q.items():
        if i % step == 0:
            own = min(vs)
            scores = [(-max(min(sum(a * b for a, b in zip(own, v)), 2**63 - 1), -(2**63)), j) for j, v in flat if j != i and len(v) == len(own)]
            out[i] = [(j, -s) for s, j in sorted(scores)[:k]]
    return out


@pytest.mark.parametrize("scale", [1.0, 1e18])
def test_op2(spark, scale):
    g = np.random.default_rng(3)
    rows = [(i, [float(x) for x in g.integers(-3, 4, 6) / 8 * scale]) for i in range(120)]
    rows += [(None, [0.1] * 6), (200, None), (220, [float("nan")] * 6), (240, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (260, []), (261, []), (280, [0.5] * 3), (281, [0.25] * 3), (20, [0.1] * 6), (5, rows[5][1]), (300, [1e307, -1e307] * 3), (301, [2e306, 2e306, 1.0, 1.0, 1.0, 1.0]), (320, [3e306] * 6), (302, [2.0**30 + 1] * 6), (340, [2.0**29 + 1, -(2.0**29), 1.0, 1.0, 1.0, 1.0])]
    rows += [(k, [float(x) for x in g.integers(-(2**23), 2**23, 300)]) for k in range(400, 440)]  # many dimensions, sums beyond 2**53
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    expected = brute_top(rows)
    for pass_bytes in (1 << 20, 12_000):
        got = collections.defaultdict(list)
        for r in exact_topk.top_k(frame, pass_bytes=pass_bytes).orderBy("query_id", "rank").collect():
            got[r["query_id"]].append((r["vec_id"], r["score"]))
        assert {i: v for i, v in expected.items() if v} == dict(got)
    assert exact_topk.top_k(frame.limit(0)).count() == 0


def test_op2_pruning_is_exact():
    g = np.random.default_rng(4)
    data = np.floor(64 * g.normal(size=(9000, 64)) * np.linspace(2, 0.1, 64))
    whole = [[int(x) for x in row] for row in data]
    for scale, queries in ((1, 50), (2**30, 5)):  # narrow, and wide on both sides
        search = exact_topk.Search(np.arange(queries), data[:queries] * scale, np.full(queries, -np.inf), 20)
        search.add(np.arange(9000), data * scale)
        for q in range(queries):
            full = data[q] @ data.T
            best = sorted((max(-int(full[c]) * scale * scale, -(2**63) + 1), c) for c in range(9000) if c != q)[:20]
            mine = sorted((-s, c) for qq, c, s in zip(search.q, search.c, search.s.tolist()) if qq == q)
            assert best == mine
    # One wide candidate leaves the others' path as it was.
    data[77] *= 2**30
    search = exact_topk.Search(np.arange(50), data[:50], np.full(50, -np.inf), 20)
    search.add(np.arange(9000), data)
    for q in range(50):
        best = sorted((-sum(a * b * (2**30 if c == 77 else 1) for a, b in zip(whole[q], whole[c])), c) for c in [77, *np.argsort(-(data[q] @ data.T))[:40].tolist()] if c != q)
        best = sorted(set(best))[:20]
        mine = sorted((-s, c) for qq, c, s in zip(search.q, search.c, search.s.tolist()) if qq == q)
        assert best == mine


def test_op2_memory_is_that_of_one_batch():
    g = np.random.default_rng(5)
    data = np.floor(64 * g.normal(size=(6000, 16)))
    search = exact_topk.Search(np.arange(6000), data, np.full(6000, -np.inf), 20)
    tracemalloc.start()
    search.add(np.arange(2000), data[:2000])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6  # all pairs at once: 12 million of 24 bytes
    for q in (0, 1999, 5999):
        full = data[q] @ data[:2000].T
        best = sorted((-int(full[c]), c) for c in range(2000) if c != q)[:20]
        assert best == sorted((-s, c) for s, c in zip(search.s[search.q == q].tolist(), search.c[search.q == q].tolist()))


@pytest.mark.parametrize("block_tokens,range_tokens", [(500, 100), (1 << 20, 1 << 21)])
def test_op3(spark, block_tokens, range_tokens):
    texts = ODD + [prose(rng.randint(0, 80)) for _ in range(60)] + [prose(1500)]
    frame = table(spark, texts).withColumn("score", F.lit("x")).withColumn("block", F.lit(1))
    assert block_tokens > 500 or suffix_tree_lm.blocks(frame, block_tokens=block_tokens).count() > 3
    got = {r["doc_id"]: r for r in suffix_tree_lm.score(frame, block_tokens=block_tokens, range_tokens=range_tokens).collect()}
    least = suffix_tree_lm.MIN_NEXT

    docs = {i: [w for w in (t or "").encode().lower().split()] + [None] for i, t in enumerate(texts)}
    train = [i for i in docs if zlib.crc32(str(i).encode()) % 10]
    grams = [collections.Counter(tuple(docs[i][k : k + m]) for i in train for k in range(len(docs[i]) - m + 1)) for m in (1, 2, 3, 4)]
    n, v = sum(grams[0].values()), len(grams[0])
    states = {}

    def p(context, w):
        if not context:
            return (grams[0][(w,)] + 0.1) / (n + 0.1 * (v + 1))
        lower = p(context[1:], w)
        if context not in states:
            return lower
        count = grams[len(context)][(*context, w)]
        return (count - 0.5 if count >= least else 0) / grams[len(context) - 1][context] + states[context] * lower

    for m in (1, 2, 3):
        new = collections.defaultdict(list)
        for g, count in grams[m].items():
            if count >= least and grams[m - 1][g[:-1]] >= suffix_tree_lm.MIN_CONTEXT:
                new[g[:-1]].append((g[-1], count / grams[m - 1][g[:-1]], 0.5 / grams[m - 1][g[:-1]]))
        states |= {c: max(1 - sum(q - d for _, q, d in s), 0) for c, s in new.items() if sum(q * math.log(q / p(c[1:], w)) for w, q, _ in s) >= suffix_tree_lm.DIVERGENCE}
    assert states
    for i, d in docs.items():
        base, score = sum(math.log10(p((), w)) for w in d), sum(math.log10(p(tuple(d[max(0, k - 3) : k]), w)) for k, w in enumerate(d))
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == (len(d), sum(grams[0][(w,)] > 0 for w in d), n)
        assert got[i]["held_out"] == (i not in train)
        assert got[i]["base_score"] == pytest.approx(base, abs=1e-6) and got[i]["score"] == pytest.approx(score)


def test_op3_query(spark):
    frame = table(spark, ODD + [prose(50) for _ in range(20)]).withColumn("score", F.lit(1))
    out = suffix_tree_lm.score(frame)
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"] and out.count() == frame.count()
    assert suffix_tree_lm.score(frame.limit(0)).count() == 0


def test_op3_rare_sharp_contexts(spark):
    texts = [" ".join(f"w{i}x{k}" for k in range(20)) + (" zig zag zog" if i % 4 == 1 else "") for i in range(40)]
    got = {r["doc_id"]: r for r in suffix_tree_lm.score(table(spark, texts)).collect()}
    for i, r in got.items():
        if r["held_out"]:
            assert (r["score"] > r["base_score"] + 1) == (i % 4 == 1)
    assert {r["held_out"] for i, r in got.items() if i % 4 == 1} == {False, True}


def test_op3_rounds(spark, monkeypatch):
    asked, ask = [], suffix_tree_lm._asked
    monkeypatch.setattr(suffix_tree_lm, "_asked", lambda *a: asked.append(1) or ask(*a))
    assert suffix_tree_lm.score(table(spark, ODD + [prose(50) for _ in range(20)]), block_tokens=200).count() == len(ODD) + 20
    assert len(asked) == suffix_tree_lm.DEPTH + 2  # contexts go with the next level's n-grams


def test_op3_first_level_is_not_sorted_again(monkeypatch):
    texts = [np.array([3, 1, 2, 3, 1, 2, 3, 1, 2, 0], np.int32)] * 3
    sizes, vocab = np.array([len(t) for t in texts]), suffix_tree_lm.mix(np.arange(4, dtype=np.uint64) + np.uint64(7))
    block = suffix_tree_lm.Block(sizes, np.array([False, False, True]), vocab, np.concatenate(texts))
    block.tell_words(block.ask_words()[1])
    keys, counts = block.ask_grams()
    row = {"sizes": suffix_tree_lm._pack(sizes), "held": [False, False, True], "vocab": vocab.tobytes(), "tokens": suffix_tree_lm._pack(block.tokens)}
    row["a0"] = [{"range": 0, "sums": [suffix_tree_lm._pack(x) for x in block.ask_words()[1]], "owned": b""}]
    block.tell_grams(counts, np.ones(len(keys), dtype=bool))
    kept = [block.grams[1], block.counts[1][:-1], block.owned[1]]
    monkeypatch.setattr(suffix_tree_lm, "_distinct", None)
    again = suffix_tree_lm._resumed(row | {"first": [suffix_tree_lm._pack(x) for x in kept]}, 1)
    asked, same = block.ask_contexts((20.0, 4.0)), again.ask_contexts((20.0, 4.0))
    assert (asked[0] == same[0]).all() and all((x == y).all() for x, y in zip(asked[1], same[1])) and max(asked[1][0]) > 0


def test_op3_packing():
    for a in (np.zeros(0), np.array([0.5, -1e300]), np.array([-1, 1 << 30], np.int32), np.array([True, False]), np.arange(1000, dtype=np.uint64) << np.uint64(40)):
        b = suffix_tree_lm._unpack(suffix_tree_lm._pack(a), a.dtype.str[1:])
        assert b.dtype == a.dtype and (a == b).all()
    gaps = np.diff(np.sort(np.random.default_rng(1).integers(0, 1 << 62, 3000)))
    assert len(suffix_tree_lm._pack(gaps)) < 0.95 * len(pa.compress(gaps.tobytes(), codec="zstd", asbytes=True))


def test_op4(spark):
    pages = [(i, f"http://h/{i}", "body é " * (i % 7 if i != 333 else 40_000)) for i in range(1200)] + [(3, "http://h/3", "again"), (None, None, None), (None, None, None), (None, "u", "x"), (5000, "u", None)] + [(9, "http://h/9", "body é " * 2)] * 3
    a = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("sha", F.lit("mine"))
    first = warc_fixity.replica(a)
    assert warc_fixity.audit(first, first).count() == 0

    def findings(changed, large=None):
        second = warc_fixity.replica(spark.createDataFrame(changed, "page_id long, url string, html string"), large)
        return sorted((r["id"] or -1, r["status"], r["copies"]) for r in warc_fixity.audit(first, second).collect())

    assert findings([p for p in pages if p[0] != 400]) == [(400, "missing", 1)]  # in the middle of a file
    changed = [p for p in pages if p[0] not in (5000, 20)]
    changed = [(i, u, "X" + h[1:]) if i in (78, 1100) and h else (i, u, h) for i, u, h in changed] + [(4000, "new", "n"), (9, "http://h/9", "body é " * 2), (9, "http://h/9", "other")]
    changed.remove((None, None, None))
    assert findings(changed) == [(-1, "missing", 1), (9, "extra", 1), (9, "extra", 1), (20, "missing", 1), (78, "corrupt", 1), (1100, "corrupt", 1), (4000, "extra", 1), (5000, "missing", 1)]
    swapped = first.withColumn("node", F.when((F.col("group") == 1) & (F.col("node") == 5), 6).when((F.col("group") == 1) & (F.col("node") == 6), 5).otherwise(F.col("node")))
    swapped = warc_fixity._in_order(swapped.withColumnRenamed("node", "rank"), F.col("rank"))
    assert [r["status"] for r in warc_fixity.audit(first, swapped).collect()] == ["moved", "moved"]
    assert warc_fixity.audit(first.limit(0), first.limit(0)).count() == 0
    assert warc_fixity.audit(first, first.limit(0)).agg(F.sum("copies")).first()[0] == len(pages)
    back = a.where("page_id = 8").select(warc_fixity.warc_record(F.col("url"), F.col("html")).alias("r"))
    got = back.select(*[c.alias(n) for n, c in warc_fixity.parse_warc(F.col("r")).items()]).first()
    assert (got["url"], got["body"]) == ("http://h/8", "body é ")


def test_op4_hot_ids_split(spark):
    pages = [(None, f"u{i}", "b") for i in range(300)] + [(7, "u", f"b{i}") for i in range(300)] + [(8, "u", "b")] * 500
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    first = warc_fixity.replica(frame, file_records=50)
    sizes = first.groupBy("group", "part").agg(F.count("*").alias("n"), F.sum("copies").alias("all")).collect()
    assert len(sizes) >= 10 and max(r["n"] for r in sizes) < 100 and sum(r["all"] for r in sizes) == len(pages)
    large = warc_fixity.layout(warc_fixity.runs(warc_fixity.digests(frame)), 50)
    less = warc_fixity.replica(spark.createDataFrame([p for p in pages if p[1] != "u17" and p[2] != "b33"], frame.schema), large)
    assert sorted((r["id"] or 0, r["status"], r["copies"]) for r in warc_fixity.audit(first, less).collect()) == [(0, "missing", 1), (7, "missing", 1)]


def shingle_set(t, n):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("n,percent,block,few", [(3, 85, 1024, 16), (5, 80, 8, 16), (3, 85, 8, 1)])
def test_op5(spark, monkeypatch, n, percent, block, few):
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)  # 8: buckets and families in blocks, or families by centres
    monkeypatch.setattr(minhash_dedup, "FEW_BLOCKS", few)
    base = [prose(rng.randint(30, 90)) for _ in range(12)]
    texts = list(ODD) + ["one", "ONE", "two  WORDS"]
    for b in base:
        for _ in range(rng.randint(0, 25)):
            w = b.split(" ")
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = f"w{rng.randint(0, 9)}"
            texts.append(" ".join(w))
    rng.shuffle(texts)
    sets = [shingle_set(t, n) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    frame = table(spark, texts).withColumn("class", F.lit("mine"))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash_dedup.linked(frame, n=n, percent=percent).collect()}
    assert got == {i: (len(sets[i]), find(i), find(i) == i) for i in range(len(texts))}


def test_op5_classes_that_share_one_id(spark, monkeypatch):
    real = minhash_dedup.sketched
    monkeypatch.setattr(minhash_dedup, "sketched", lambda *x: real(*x).withColumn("class", F.when(F.col("class").isNotNull(), F.lit(7).cast("long"))))
    classes, sketch = minhash_dedup._classes(minhash_dedup.sketched(table(spark, ["a b c d", "A b c d", "e f g h", None])), "doc_id")
    assert sorted(r["_id"] for r in classes.collect()) == [0, 2] and sketch.select("class").distinct().count() == 3


def test_op5_edges(spark):
    assert minhash_dedup.linked(table(spark, ["a b c d"]).limit(0)).count() == 0
    rows = spark.createDataFrame([(1, "same text here"), (1, "same text here"), (None, "same text here"), (2, None)], "doc_id long, text string")
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["component_id"], r["kept"]) for r in minhash_dedup.linked(rows).collect())
    assert got == [(False, 1, 1, True), (False, 1, 1, True), (False, 2, 2, True), (True, 0, 1, False)]


def test_spanning_links_columns(monkeypatch):
    monkeypatch.setattr(minhash_dedup, "COLUMNS", 7)
    sets = [np.arange(k, k + 40, dtype=np.uint64) for k in (0, 2, 4, 100, 101, 300)]
    assert minhash_dedup.spanning_links(sets, None, 85).tolist() == [0, 0, 0, 3, 3, 5]
    assert minhash_dedup.spanning_links(sets[::2], sets[1::2], 85).tolist() == [0, 0, 2, 0, 2, 5]
    assert minhash_dedup.spanning_links(sets[:1], sets[1:2], 85).tolist() == [0, 0]


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(100, 5), (100, 100), (7, 5)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: i // 20 * 20 for i in range(60)} | {100: 0}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_op6(spark):
    texts = [None, "", "a b c"] + [prose(rng.randint(0, 60)) for _ in range(300)]
    frame = table(spark, texts).withColumn("size", F.lit("x"))
    rows = source_mix.keyed(frame)
    got = source_mix.taken(rows, source_mix.limits(rows)).collect()
    size = collections.Counter()
    for r in got:
        assert r["_size"] == len(words(r["text"])) and 0 <= r["copies"] <= 3
        size[r["_key"]] += r["_size"]
    order = sorted(size, key=lambda k: (k == "", k))
    weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(size.values()))
    while open_:
        share = {k: left * weight[k] / sum(weight[x] for x in open_) for k in open_}
        over = {k for k in open_ if share[k] > 3 * size[k]}
        if not over:
            target |= share
            break
        for k in over:
            target[k], left = 3 * size[k], left - 3 * size[k]
        open_ -= over
    largest = max(r["_size"] for r in got)
    for k in order:
        mine = sum(r["_size"] * r["copies"] for r in got if r["_key"] == k)
        assert next(r["target"] for r in got if r["_key"] == k) == pytest.approx(target[k]) and abs(mine - target[k]) <= largest
    assert source_mix.mixed(frame.limit(0)).count() == 0
    assert source_mix.mixed(frame).columns == frame.columns


def test_op7(spark):
    fixed = "This very line recurs in many of the documents here"
    texts = [f"{prose(20)}\n{fixed}\nlog entry number {i} was written by user u{i} at noon today" for i in range(6)] + ["short line\nshort line", None, "", fixed + "\n" + fixed]
    frame = table(spark, texts).withColumn("line", F.lit(1))
    for limit in (1 << 20, 0):  # broadcast and join
        got = {r["doc_id"]: r for r in line_templates.dropped(frame, broadcast_lines=limit).collect()}
        assert len(got) == len(texts)
        assert got[0]["text"] == texts[0] and got[6]["text"] == texts[6] and got[7]["text"] is None and got[8]["text"] == "" and got[9]["text"] == "" and got[9]["_n_dropped"] == 2
        for i in range(1, 6):
            assert fixed not in got[i]["text"] and "log entry" not in got[i]["text"] and got[i]["_n_dropped"] == 2
            assert got[i]["text"] == "\n".join(x for x in texts[i].split("\n") if x != fixed and not x.startswith("log entry"))
    assert line_templates.dropped(frame.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, fixed), (None, fixed), (4, fixed), (4, fixed + "\n" + fixed), (9, fixed)], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["_n_dropped"]) for r in line_templates.dropped(odd).collect()) == [(0, 1), (0, 1), (4, 0), (4, 0), (9, 1)]


def greedy(tokens, least):
    heads, out = [], []
    for i, own in enumerate(tokens):
        share = [sum(x == y for x, y in zip(t, own)) for _, t in heads]
        if share and max(share) >= least:
            k = share.index(max(share))
            heads[k] = (heads[k][0], [x if x == y else None for x, y in zip(heads[k][1], own)])
            out.append(heads[k][0])
        else:
            heads.append((i, list(own)))
            out.append(i)
    return out


@pytest.mark.parametrize("width,kinds", [(8, 3), (9, 4), (10, 3), (17, 2), (40, 2)])
def test_op7_bands_change_nothing(width, kinds):
    g = np.random.default_rng(width)
    tokens = g.integers(0, kinds, (500, width)).astype(np.int32)
    tokens[:, : line_templates.DEPTH] = 7
    expected = greedy(tokens.tolist(), math.ceil(line_templates.SIMILARITY * width))
    for scan in (0, 5, 1 << 30):
        leaf, pairs = line_templates.Leaf(width, scan_heads=scan), []
        for x in range(0, 500, 120):
            pairs += leaf.add(list(range(500))[x : x + 120], tokens[x : x + 120])
        assert len(pairs) == len(set(pairs)) and set(pairs) == {(i, t) for i, t in enumerate(expected) if expected.count(t) > 1}


def test_op7_large_leaf(spark):
    def name(i):
        return "".join("abcdefghij"[int(c)] for c in str(i))

    n = 3000  # one template with a name at word 6, and in the same leaf two smaller ones
    texts = [f"we have sent to Ms {name(i)} a parcel by post" for i in range(n)] + [f"we have sent you some {name(i)} more than was asked" for i in range(5)]
    texts += [f"we have sent {name(i)} {name(i + 7)} of those that are left" for i in range(9)]
    # Lines of the same leaf that share no template: no two agree in enough words.
    apart = [f"we have sent {name(1000 + 7 * i)} {name(3 * i)} {name(5 * i)} {name(11 * i)} {name(i * i)} {name(13 * i)} {name(17 * i)}" for i in range(1, 400)]
    for leaf_lines in (line_templates.LEAF_LINES, 200):
        got = {r["doc_id"]: r["_n_dropped"] for r in line_templates.dropped(table(spark, texts + apart), leaf_lines=leaf_lines).collect()}
        assert {i for i, k in got.items() if not k} == {0, n, n + 5, *range(n + 14, n + 14 + len(apart))} and len(got) == len(texts) + len(apart)


def test_op7_long_and_short_lines(spark):
    passage = " ".join(f"p{k}q" if k % 9 else f"word{'abcdefgh'[k // 9]}" for k in range(60))
    long, other, fifty = (" ".join(c + "abcdefghij"[k // 10] + "abcdefghij"[k % 10] for k in range(n)) for c, n in (("l", 51), ("m", 51), ("n", 50)))
    owners = {passage: [0], passage.replace("p1q", "p99q"): [4], long: [2, 5], other: [6], fifty: [1, 7], "All rights reserved.": [1, 2, 3, 6, 8], "seen in four": [0, 1, 2, 3], "}": list(range(9)), "12 13": list(range(9)), "}  12": list(range(9))}
    texts = ["\n".join(["", *[x for x, own in owners.items() if i in own], "", f"own{i}"]) for i in range(9)]
    gone = {long: 2, "All rights reserved.": 1}
    for limit in (1 << 20, 0):  # broadcast and join
        for r in line_templates.dropped(table(spark, texts), broadcast_lines=limit).collect():
            i = r["doc_id"]
            kept = [x for x in texts[i].split("\n") if gone.get(x, i) == i]
            assert r["text"] == "\n".join(kept) and r["_n_dropped"] == len(texts[i].split("\n")) - len(kept), (limit, i)


def test_op8_counts():
    texts = ODD + [prose(rng.randint(0, 90)) for _ in range(80)]
    found = quality_rules.features(pa.array(texts))
    for i, t in enumerate(texts):
        w, raw = [x.decode() for x in words(t)], t or ""
        seen = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        repeat = {k + d for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for d in range(3)}
        lines, dup = set(), 0
        for x in raw.split("\n"):
            if words(x):
                dup += x in lines
                lines.add(x)
        assert [int(found[c][i]) for c in quality_rules.COUNTS] == [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in raw), dup, len(repeat)]


def test_op8_bound():
    for n, k, p in ((50, 2, 0.1), (400, 0, 0.01), (30, 29, 0.5), (10, 10, 0.3)):
        exact = sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))
        assert math.exp(quality_rules.log_binomial_tail(k, n, p)) == pytest.approx(exact)
    assert quality_rules.certified(np.array([0, 0, 5000]), np.array([9, 9, 0]), 0.01, math.log(1e-4), 20) == 1
    assert quality_rules.certified(np.array([0, 0, 50]), np.array([9, 9, 0]), 0.01, math.log(1e-4), 20) is None


def brute_verdict(rates, labels):
    """(strata, rule) -> cutoff and doc -> kept, by plain loops over documents."""
    quality = {}
    for i, q, _ in labels:
        if q is not None:
            quality[i] = min(q, quality.get(i, 9))
    once = {}
    for r in rates:
        key = (r["stratum"] or "", quality.get(r["doc_id"]), *[r[c] for c in quality_rules.RATES])
        if r["doc_id"] in quality:
            once[r["doc_id"]] = min(key, once.get(r["doc_id"], key))
    strata = {d[0] for d in once.values()}
    level = 0.05 / (max(1, len(strata)) * len(quality_rules.RULES))
    cutoffs = {}
    for s in strata:
        for name, (rate, sign) in quality_rules.RULES.items():
            bins = [(min(64, int(d[2 + quality_rules.RATES.index(rate)] * 64)), d[1]) for d in once.values() if d[0] == s]
            n, best = sum(q >= 1 for _, q in bins), 0
            for cut in range(64, -1, -1) if sign > 0 else range(65):
                hit = [q for b, q in bins if (b >= cut if sign > 0 else b <= cut)]
                k, p = sum(q >= 1 for q in hit), quality_rules.ALPHA / len(quality_rules.RULES)
                term = tail = (1 - p) ** n
                for j in range(k):
                    term *= (n - j) / (j + 1) * p / (1 - p)
                    tail += term
                if n == 0 or tail > level:
                    break
                gain = len(hit) - k - quality_rules.PRICE * k
                if gain > best:
                    best, cutoffs[s, name] = gain, cut
    kept = collections.Counter()
    for r in rates:
        ok = r["n_words"] >= 50 and 100 * r["n_repeat_words"] <= 50 * r["n_words"]
        for name, (rate, sign) in quality_rules.RULES.items():
            cut = cutoffs.get((r["stratum"] or "", name))
            b = min(64, int(r[rate] * 64))
            ok &= cut is None or not (b >= cut if sign > 0 else b <= cut)
        kept[r["doc_id"], ok] += 1
    return cutoffs, kept


def test_op8_fit(spark):
    texts = [" ".join(rng.choice(WORDS[:5]) + str(rng.random()) for _ in range(60)) for _ in range(1300)]
    texts += ["### $$$ " + t for t in [" ".join(f"{x}###" for x in t.split()) for t in texts[:100]]] + ODD
    rows = [(i, t, "en" if i % 13 or i >= 1300 else ["de", None][i % 2], "x", "y") for i, t in enumerate(texts)]
    rows += rows[:40] + [(3, rows[1350][1], "en", "x", "y")]  # repeated rows, and another text with a known id
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string, _in string")
    labels = [(i, 1, 0) for i in range(1300)] + [(i, 0, 0) for i in range(1300, 1400)] + [(50000, 1, 0), (3, None, 0), (1305, 1, 0)]
    label_frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rates = quality_rules.rated(frame)
    model = quality_rules.fit(rates, label_frame)
    cutoffs, kept = brute_verdict(rates.collect(), labels)
    assert cutoffs and {(r["_stratum"][1:], c): r[c] for r in model.collect() for c in quality_rules.RULES if r[c] is not None} == cutoffs
    assert collections.Counter((r["doc_id"], r["kept"]) for r in quality_rules.judge(rates, model).collect()) == kept
    assert not any(kept[i, True] for i in range(1300, 1400))
    for few in (quality_rules.BROADCAST_STRATA, 0):  # broadcast and join
        good = quality_rules.judged(rates.withColumn("_stratum", quality_rules._stratum(F.col("stratum"))), model, few)
        assert good.where("kept").count() == sum(n for (_, ok), n in kept.items() if ok)
    good = quality_rules.keep_good(frame, model)
    assert good.columns == frame.columns and collections.Counter(r["doc_id"] for r in good.collect()) == collections.Counter({i: n for (i, ok), n in kept.items() if ok})
    none = quality_rules.fit(rates.limit(0), label_frame)
    assert quality_rules.judge(rates, none).where("kept").count() == quality_rules.judge(rates, none).where("not base_failed").count()


def test_op8_many_strata(spark):
    rates = quality_rules.rated(table(spark, [prose(60) for _ in range(400)]).withColumn("lang", F.col("doc_id").cast("string")))
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    assert quality_rules.fit(rates, labels).count() == 400  # none is pooled


def test_op9(spark):
    texts = ODD + ["Licensed under CC BY-NC 4.0. All rights reserved", "the GNU General Public License, version 3 / cc  by CC-BY", "ccby general public licenses", "MIT License and the MIT license", "© CC BY é"]
    for t in texts:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = "".join(c if ord(c) > 127 or c in "0123456789abcdefghijklmnopqrstuvwxyz" else " " for c in low).split(" ")
        w = [x for x in w if x]
        places = sorted((k, l) for p, l in license_scan.BASE.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split())
        n, found = license_scan.scan_text((t or "").encode())
        assert n == len(w) and sorted((a, l) for a, _, q, l, _ in found if q == 0) == places
    labels = {l for _, _, _, l, _ in license_scan.scan_text(texts[-5].encode())[1]}
    assert labels == {"cc-by", "cc-by-nc", "reserved"}
    assert len(license_scan.rules()) > 200
    spans = license_scan.resolve([(0, 10, 2, 5, "a", "a"), (2, 8, 3, 6, "b", "b"), (2, 8, 1, 7, "c", "c"), (2, 8, 0, 0, "base", "base"), (20, 30, 4, 1, "d", "d"), (20, 30, 4, 2, "e", "e")])
    assert [s[4] for s in spans] == ["a", "base", "b", "d"]
    assert license_scan.scan(table(spark, ODD).limit(0)).count() == 0


def ways(parsed):
    """An example of every alternative of a parsed expression, without what it can do without."""
    out = [""]
    for op, arg in parsed:
        if op is sre_constants.LITERAL:
            new = [chr(arg)]
        elif op is sre_constants.IN:
            kind, first = arg[0]
            new = ["2"] if kind is sre_constants.CATEGORY else [chr(first)] if kind is sre_constants.LITERAL else [chr(first[0])]
        elif op is sre_constants.BRANCH:
            new = [x for branch in arg[1] for x in ways(branch)]
        elif op is sre_constants.SUBPATTERN:
            new = ways(arg[3])
        elif op in (sre_constants.MAX_REPEAT, sre_constants.MIN_REPEAT):
            new = [x * arg[0] for x in ways(arg[2])] if arg[0] else [""]
        elif op is sre_constants.ANY:
            new = ["x"]
        else:
            assert op in (sre_constants.ASSERT, sre_constants.ASSERT_NOT), op
            new = [""]
        out = [a + b for a in out for b in new]
    return out


def test_op9_gates_lose_nothing():
    scanner, tried = license_scan.scanner(), 0
    for _, rule, _, _, expression in license_scan.rules():
        for example in sorted(set(ways(sre_parser.parse(expression.decode())))):
            flat = example.encode()
            ungated = [m.span() for m in re.finditer(expression, flat)]
            assert ungated and not scanner.hopeless(flat), (rule, example)
            assert [d[:2] for d in scanner.detections(flat) if d[5] == rule] == ungated, (rule, example)
            tried += 1
    assert tried > 1000
    for text, wanted in (
        ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by-4.0"),
        ("Released under the Creative Commons Zero 1.0 Universal license", "cc0-1.0"),
        ("Distributed under the Expat license", "mit"),
        ("See the MIT for details", "mit"),
        ("Permission to use, copy, modify, and/or distribute this software for any purpose", "isc"),
    ):
        assert wanted in {d[3] for d in license_scan.scan_text(text.encode())[1]}


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_op10(name):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path(name))
    with open(P.path(name), "rb") as f:
        mine = bpe_transducer.Vocabulary(f.read())
    texts = [t or "" for t in ODD] + [prose(60) for _ in range(30)] + ["the" * 2500, "ab" * 2500 + "!", "".join(rng.choice("aeinorst") for _ in range(6000))]
    for t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        packed = mine.encode(t)
        assert b"".join(mine.portions(t)) == packed
        assert np.frombuffer(packed, "<u4").tolist() == ids
        for portion in (1, 7, 1 << 16):
            assert bpe_transducer.decode(mine, packed, portion) == library.decode(ids, skip_special_tokens=False)


def test_op10_long_words_and_heap(monkeypatch):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    texts = ["".join(rng.choice("aeinorst") for _ in range(80_000)), "é" * 3000 + " " + "日本" * 900, prose(400) + "<|endoftext|>" + prose(30)]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        library = Tokenizer.from_file(P.path(name))
        with open(P.path(name), "rb") as f:
            mine = bpe_transducer.Vocabulary(f.read())
        whole = []
        for portion in (1 << 16, 100):
            monkeypatch.setattr(bpe_transducer, "PORTION", portion)
            whole.append([mine.encode(t) for t in texts])
            assert portion > 100 or max(len(p) for t in texts for p in mine.portions(t)) < 4 * 4000
        assert whole[0] == whole[1] == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        symbols = [mine.table[b] for b in "".join(rng.choice("aeinorst ") for _ in range(3000)).encode()]
        by_heap = mine.merged(symbols)
        monkeypatch.setattr(bpe_transducer, "HEAP_SYMBOLS", 1 << 30)
        assert mine.merged(symbols) == by_heap
        monkeypatch.setattr(bpe_transducer, "HEAP_SYMBOLS", 48)


def test_op10_frame(spark):
    P = pytest.importorskip("public_tokenizers")
    frame = table(spark, ODD).withColumn("ids", F.lit(1))
    out = bpe_transducer.transcode(frame, P.path("word_bpe_49k.json")).collect()
    assert len(out) == len(ODD) and {r["doc_id"]: bytes(r["ids"]) for r in out}[0] == b""
    assert hashlib.sha256(b"").hexdigest() == hashlib.sha256(bytes(out[1]["ids"])).hexdigest()
    digests = {r["doc_id"]: r for r in bpe_transducer.fingerprints(frame, P.path("word_bpe_49k.json")).collect()}
    for r in out:
        d = digests[r["doc_id"]]
        assert (d["n_tokens"], d["ids_sha256"], d["decoded_sha256"]) == (len(r["ids"]) // 4, hashlib.sha256(bytes(r["ids"])).hexdigest(), hashlib.sha256(r["decoded"].encode()).hexdigest())
    assert bpe_transducer.transcode(frame.limit(0), P.path("word_bpe_49k.json")).count() == 0
    assert bpe_transducer.fingerprints(frame.limit(0), P.path("word_bpe_49k.json")).count() == 0
