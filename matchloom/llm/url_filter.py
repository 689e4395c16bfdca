"""URL filters by a Bloom filter cascade: exact membership over a known key universe, without joins.

The universe is every key the corpus can ask for. Level 1 holds the listed keys; the
unlisted keys that it lets through go into level 2, the listed keys that level 2 lets
through into level 3, and so on until nothing passes wrongly. A key is listed iff the
first level that misses it has an even number, or it passes an odd number of levels.

Keys are cut into shards by their hash, each of about SHARD_KEYS keys, and every shard
gets a cascade of its own in one small task. Together they take about 1.44 log2(U/S) + 4
bits a listed key. Every level draws its bits from all 128 bits of a key's hash, so its
errors are independent of the other levels' and halve from level to level; what is left
after LEVELS levels (as a rule nothing) ends the cascade as an explicit list.

There are two cascades: one of the rules, whose number the caller bounds, and one of the
list. Lookups run inside the scan against broadcast shards. If the list's shards exceed
ROUND_BYTES together, the rows are written once, apart by the round that holds their
shard, and every round reads its own rows alone: a broadcast is bounded whatever the
list's size, and rows are read once. Repeated and very frequent keys cost nothing: only
distinct keys are built from, and rows are never dealt by their key.

Keys are told apart by 128 bits of hash. Cases: null urls and urls without "://" have an
empty host and path, fit no rule and are not listed; very long urls are keys like others;
a null or repeated page id is judged row by row; empty tables give empty results and an
empty list lists nothing; extra columns of the pages are not returned.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StructField, StructType

from .shared import ascii_lower, stored
from .textvec import mix

#: Rules of the query: (host and path prefix, verdict); a rule fits its host and all subdomains.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
SHARD_KEYS = 1 << 16
#: Most bytes of cascades in one broadcast.
ROUND_BYTES = 64 << 20

#: Levels of Bloom filters at most; about log2 of the shard's keys are needed.
LEVELS = 48

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _positions(h1: np.ndarray, h2: np.ndarray, level: int):
    """Two hashes of the whole key for this level."""
    salt = np.uint64((level + 1) * int(_STEP) % (1 << 64))
    a = mix(mix(h1 + salt) ^ h2)
    return a, mix(mix(h2 ^ salt) + h1) | np.uint64(1)


class Level:
    """One Bloom filter: m bits, k positions a key; or (m = 0) the listed keys themselves, 16 bytes each."""

    def __init__(self, m: int, k: int, number: int, bits: np.ndarray):
        self.m, self.k, self.number, self.bits = m, k, number, bits

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray, rate: float, number: int) -> Level:
        k = max(1, round(math.log2(1 / rate)))
        m = max(64, math.ceil(len(h1) * k / math.log(2)))
        bits = np.zeros(m, dtype=bool)
        a, b = _positions(h1, h2, number)
        for _ in range(k):
            bits[a % np.uint64(m)] = True
            a = a + b
        return cls(m, k, number, np.packbits(bits))

    @classmethod
    def explicit(cls, h1: np.ndarray, h2: np.ndarray, number: int) -> Level:
        return cls(0, 0, number, np.stack([h1, h2], axis=1).view(np.uint8).ravel())

    def passes(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        if not self.m:
            own = set(map(tuple, self.bits.view(np.uint64).reshape(-1, 2).tolist()))
            return np.fromiter((key in own for key in zip(h1.tolist(), h2.tolist())), bool, len(h1))
        a, b = _positions(h1, h2, self.number)
        out = np.ones(len(h1), dtype=bool)
        for _ in range(self.k):
            at = a % np.uint64(self.m)
            out &= (self.bits[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8) & 1).astype(bool)
            a = a + b
        return out


def build_cascade(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray, most: int = LEVELS) -> list[Level]:
    """The levels that tell the listed of these distinct keys from the others; the last is explicit if `most` don't do."""
    levels: list[Level] = []
    inside, outside = np.flatnonzero(listed), np.flatnonzero(~listed)
    while len(inside):
        if len(levels) == most:
            levels.append(Level.explicit(h1[inside], h2[inside], most))
            break
        rate = min(0.5, math.sqrt(0.5) * len(inside) / max(1, len(outside))) if not levels else 0.5
        level = Level.build(h1[inside], h2[inside], max(rate, 2.0**-40), len(levels))
        levels.append(level)
        inside, outside = outside[level.passes(h1[outside], h2[outside])], inside
    return levels


def contains(levels: list[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether each key of the universe is listed."""
    out = np.full(len(h1), len(levels) % 2 == 1)
    rest = np.arange(len(h1))
    for i, level in enumerate(levels):
        through = level.passes(h1[rest], h2[rest])
        out[rest[~through]] = i % 2 == 1
        rest = rest[through]
    return out


def key_hashes(key) -> tuple:
    """Two 64-bit hashes of a key column."""
    return F.xxhash64(key), F.xxhash64(F.lit(7), key)


class Cascade:
    """A sharded cascade; `shards` is a stored DataFrame (shard, m, k, bits by level)."""

    def __init__(self, shards: DataFrame, n_shards: int):
        self.shards, self.n_shards = shards, n_shards
        self.bytes = shards.agg(F.sum(F.expr("aggregate(bits, 0L, (s, b) -> s + octet_length(b) + 64)"))).first()[0] or 0


def cascade(universe: DataFrame, listed: DataFrame, shard_keys: int = SHARD_KEYS) -> Cascade:
    """Build from the key column of `universe` (all keys that will be asked for) and of `listed`; repeats are fine."""
    both = universe.select("key", F.lit(False).alias("listed")).unionByName(listed.select("key", F.lit(True).alias("listed"))).where("key is not null")
    h1, h2 = key_hashes(F.col("key"))
    keys = stored(both.select(h1.alias("h1"), h2.alias("h2"), "listed").groupBy("h1", "h2").agg(F.max("listed").alias("listed")))
    n_shards = max(1, math.ceil(keys.count() / shard_keys))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        levels = build_cascade(pdf["h1"].to_numpy().view(np.uint64), pdf["h2"].to_numpy().view(np.uint64), pdf["listed"].to_numpy())
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "m": [[x.m for x in levels]], "k": [[x.k for x in levels]], "bits": [[x.bits.tobytes() for x in levels]]})

    sharded = keys.withColumn("shard", F.pmod("h1", F.lit(n_shards)))
    return Cascade(stored(sharded.groupBy("shard").applyInPandas(build, "shard long, m array<long>, k array<long>, bits array<binary>")), n_shards)


def _shipped(found: Cascade, r: int, rounds: int):
    """This round's cascades by shard, broadcast: at most about ROUND_BYTES. Shards that list nothing are left out."""
    own = {s["shard"]: (s["m"], s["k"], [bytes(x) for x in s["bits"]]) for s in found.shards.where((F.pmod("shard", F.lit(rounds)) == r) & (F.size("m") > 0)).toLocalIterator()}
    return found.shards.sparkSession.sparkContext.broadcast(own)


def _unpacked(shipped) -> dict[int, list[Level]]:
    return {s: [Level(m, k, i, np.frombuffer(x, np.uint8)) for i, (m, k, x) in enumerate(zip(*v))] for s, v in shipped.value.items()}


def _told(cascades: dict[int, list[Level]], n_shards: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    hit = np.zeros(len(h1), dtype=bool)
    shard = h1 % n_shards
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    for group in np.split(order, cuts) if len(order) else []:
        levels = cascades.get(int(shard[group[0]]))
        if levels:
            hit[group] = contains(levels, h1[group].view(np.uint64), h2[group].view(np.uint64))
    return hit


def with_hits(rows: DataFrame, found: Cascade, h1: str = "h1", h2: str = "h2", out: str = "hit", round_bytes: int = ROUND_BYTES) -> DataFrame:
    """The rows plus `out`: whether the key with the hashes in columns h1 and h2 is listed."""
    n, rounds = found.n_shards, max(1, math.ceil(found.bytes / round_bytes))
    if rounds > 1:
        rows = stored(rows.withColumn("_round", F.pmod(F.pmod(h1, F.lit(n)), F.lit(rounds)).cast("int")), partition_by="_round")
    told = None
    for r in range(rounds):
        part = rows.where(F.col("_round") == r).drop("_round") if rounds > 1 else rows
        shipped = _shipped(found, r, rounds)

        def run(batches, shipped=shipped):
            cascades = _unpacked(shipped)
            for batch in batches:
                a, b = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (h1, h2))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_told(cascades, n, a, b))], names=[*batch.schema.names, out])

        part = part.mapInArrow(run, StructType([*part.schema.fields, StructField(out, BooleanType())]))
        told = part if told is None else told.unionByName(part)
    return told


def with_rule_hits(rows: DataFrame, found: Cascade, h1: str, h2: str, out: str) -> DataFrame:
    """The rows plus `out`, an array: whether each key of the array columns h1 and h2 is listed. One broadcast: for lists that the caller bounds."""
    n, shipped = found.n_shards, _shipped(found, 0, 1)

    def run(batches):
        cascades = _unpacked(shipped)
        for batch in batches:
            a, b = (batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in (h1, h2))
            sizes = np.concatenate([[0], np.cumsum(batch.column(h1).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))])
            hit = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(_told(cascades, n, a, b)))
            yield pa.RecordBatch.from_arrays([*batch.columns, hit], names=[*batch.schema.names, out])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(out, ArrayType(BooleanType()))]))


def split_url(url) -> tuple:
    """(host, path): after the first "://" up to / ? # or the end, A-Z lower-cased; then up to ? or #."""
    after = F.coalesce(F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))), F.lit(""))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def _probes(rules) -> list:
    """Key columns of a url under every shape (labels of the host, length of the path) that a rule has."""
    shapes = sorted({(rule.split("/", 1)[0].count(".") + 1, len(rule) - rule.index("/")) for rule, _ in rules})
    return [F.concat(F.substring_index("host", ".", -labels), F.substring("path", 1, length)) for labels, length in shapes]


def judge_urls(pages: DataFrame, listed: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(page_id, host, path, rule, verdict): the longest fitting rule's verdict, else block iff host + path is listed.

    `listed` has a column key (host and path).
    """
    host, path = split_url(F.col(url_col).cast("string"))
    urls = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    probes, key = F.array(*_probes(rules)), F.concat("host", "path")
    ruling = pages.sparkSession.createDataFrame([(rule,) for rule, _ in rules], "key string")
    by_rule = cascade(urls.select(F.explode(F.array_distinct(probes)).alias("key")), ruling)
    by_list = cascade(urls.select(key.alias("key")), listed.where("key <> ''").select("key"))
    asked = urls.select("*", F.transform(probes, lambda k: key_hashes(k)[0]).alias("r1"), F.transform(probes, lambda k: key_hashes(k)[1]).alias("r2"), *[h.alias(f"h{i}") for i, h in enumerate(key_hashes(key), 1)])
    told = with_hits(with_rule_hits(asked, by_rule, "r1", "r2", "fits"), by_list, round_bytes=round_bytes)
    fitting = F.filter(probes, lambda k, i: F.get(F.col("fits"), i))
    longest = F.array_max(F.transform(fitting, lambda k: F.struct(F.length(k).alias("n"), k.alias("rule"))))["rule"]
    verdicts = F.create_map(*[F.lit(x) for rule in rules for x in rule])
    return told.select(id_col, "host", "path", longest.alias("rule"), F.coalesce(F.try_element_at(verdicts, longest), F.when(F.col("hit"), "block").otherwise("allow")).alias("verdict"))


def stand_in_list(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """The query's list: a sixteenth of the pages' host + path keys, by hash. A bought list would be read here."""
    host, path = split_url(F.col(url_col).cast("string"))
    key = F.concat(host, path)
    return pages.select(key.alias("key")).where((F.substring(F.md5(F.col("key").cast("binary")), 1, 1) == "0") & (F.col("key") != "")).distinct()


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge_urls(pages, stand_in_list(pages))


_FITS = " ".join(f"WHEN (host = '{r.split('/')[0]}' OR ends_with(host, '.{r.split('/')[0]}')) AND starts_with(path, '{r[r.index('/'):]}') THEN '{r}'" for r, _ in sorted(RULES, key=lambda r: -len(r[0])))
_VERDICT = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in RULES)
OP1_SQL = f"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS a FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(a, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(a, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (SELECT *, CASE {_FITS} END AS rule FROM parts)
SELECT page_id, host, path, rule,
       coalesce(CASE rule {_VERDICT} END, CASE WHEN host || path <> '' AND substr(md5(host || path), 1, 1) = '0' THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled
"""
