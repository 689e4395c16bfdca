"""Near-duplicate documents by MinHash with banding, verification and components.

1. One scan turns every text into its set of word shingles (64-bit hashes), and emits a
   128-bit digest of the set, its size and a signature of BANDS * ROWS universal hash
   minima (multiply-add modulo 2**64, upper half). Texts with equal sets form a class;
   all later steps work on classes, so exact copies cost nothing however many there are.
2. Banding: classes that agree in all ROWS minima of some band share a bucket. A pair at
   the threshold 0.85 is missed by all bands with probability 7e-9.
3. Buckets are never expanded into all pairs. Each class is compared, by signature, with
   its buckets' pivot (a min-aggregate); classes at CLOSE or more join the pivot's family,
   and families are components of these pairs. In buckets that hold several families, the
   classes that are not in the pivot's are looked through against those that could agree
   with them: shares of equal minima are a metric, so a class that agrees with the pivot
   too well can't be near one that doesn't. Two families are joined if any two of their
   classes agree well enough to be linked (the test dismisses a true link with a
   probability of about 1e-6). So every possible link is inside one family.
4. Families are confirmed exactly: their texts are shingled again. A family of up to BLOCK
   classes (or BLOCK_SHINGLES shingles) is one task that gets all intersection sizes from
   products of incidence matrices. One of up to FEW_BLOCKS such blocks is compared in pairs
   of blocks. Of a larger one about the square root of its classes, by hash, become centres, and every class is compared with them in blocks. Jaccard
   distance is a metric as well, so two linked classes of which one is linked to a centre
   are both in the centre's wider ball: what is left are the classes that visit the ball
   of a centre of another component, and those that no centre is linked to. The former
   are compared with the ball, the latter go into another round with new centres (and
   after ROUNDS are compared in pairs of blocks). Tasks return spanning sets of their
   links, at most one row a class, however many pairs are linked.
5. Components by alternating large-star and small-star.

Classes are told apart by 128 bits, shingles by 64 bits.

Cases: null and empty texts, and texts without words, have no set and are alone; texts
with fewer words than a shingle have their whole sequence as the only one; very long
texts are shingled whole; rows with the same id are classed by their own texts; a null id
never is a component's smallest unless all are null (then the component is null and
nothing is kept); empty tables give empty results; extra columns pass by.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import connected_components
from .shared import documents, stored
from .textvec import LOWER, U64, mix, owner, slices, windows, words

BANDS, ROWS = 32, 5
#: Two sets are linked when 100 * |A & B| >= PERCENT * |A | B|; WORDS words make a shingle.
PERCENT, WORDS = 85, 3
CLOSE = 0.6
BLOCK, BLOCK_SHINGLES, COLUMNS = 1024, 1 << 21, 4096
#: Classes whose texts are fetched by a broadcast at most (40 bytes each), and blocks of a family that are compared in pairs at most.
BROADCAST_CLASSES, FEW_BLOCKS = 1 << 20, 16
#: Rounds of centres before what is left of a family is compared in pairs of blocks.
ROUNDS = 3
#: Signature agreement is a mean of BANDS * ROWS draws; so many standard deviations are allowed for.
DEVIATIONS = 5.0

_N = BANDS * ROWS
_RNG = np.random.default_rng(20240229)
_MULT = _RNG.integers(1, 1 << 63, _N, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_PLUS = _RNG.integers(0, 1 << 63, _N, dtype=np.int64).astype(U64)


def shingle_sets(column: pa.Array, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and their offsets."""
    hashes, offs, *_ = words(column, LOWER)
    counts = np.diff(offs)
    runs, roffs = windows(hashes, offs, n)
    who = owner(roffs)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        extra = np.empty(len(short), dtype=U64)
        for k in range(1, n):
            own = short[counts[short] == k]
            acc = np.full(len(own), k, dtype=U64)
            for j in range(k):
                acc = mix(acc * U64(0xA24BAED4963EE407) + hashes[offs[own] + j])
            extra[counts[short] == k] = acc
        runs, who = np.concatenate([runs, extra]), np.concatenate([who, short])
    order = np.lexsort((runs, who))
    runs, who = runs[order], who[order]
    new = np.ones(len(runs), dtype=bool)
    new[1:] = (runs[1:] != runs[:-1]) | (who[1:] != who[:-1])
    runs, who = runs[new], who[new]
    return runs, np.searchsorted(who, np.arange(len(counts) + 1))


def signatures(runs: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """(texts, BANDS * ROWS) uint32 minima; rows of empty sets are undefined."""
    out = np.zeros((len(offs) - 1, _N), dtype=np.uint32)
    full = np.flatnonzero(np.diff(offs) > 0)
    if not len(full):
        return out
    at = offs[full]
    scratch = np.empty(len(runs), dtype=U64)
    for k in range(_N):
        np.multiply(runs, _MULT[k], out=scratch)
        scratch += _PLUS[k]
        out[full, k] = (np.minimum.reduceat(scratch, at) >> U64(32)).astype(np.uint32)
    return out


def _class_ids(runs: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit ids of each set: mixed sums of the mixed shingles, with the size."""
    ids = []
    for salt, step in ((0x5851F42D4C957F2D, 0x9E3779B97F4A7C15), (0x14057B7EF767814F, 0xD1342543DE82EF95)):
        sums = np.concatenate([[U64(0)], np.cumsum(mix(runs ^ U64(salt)), dtype=U64)])
        ids.append(mix(sums[offs[1:]] - sums[offs[:-1]] + np.diff(offs).astype(U64) * U64(step)).view(np.int64))
    return ids[0], ids[1]


def sketched(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS) -> DataFrame:
    """(id, n_shingles, class, check, sig): the last three are null for texts without words."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                runs, offs = shingle_sets(part.column(1), n)
                sizes, none = np.diff(offs), np.diff(offs) == 0
                sig = [None if z else s.tobytes() for z, s in zip(none, signatures(runs, offs))]
                ids = [pa.array(x, mask=none) for x in _class_ids(runs, offs)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), *ids, pa.array(sig, pa.binary())], names=[id_col, "n_shingles", "class", "check", "sig"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"{id_col} {kind}, n_shingles long, class long, check long, sig binary")


def _classes(sketch: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """The classes (class, raw, check, _id, sig, n_shingles), and the sketch by them. Sets that share the first id alone get classes of their own."""

    def grouped(rows: DataFrame) -> DataFrame:
        least = [F.min("raw").alias("raw"), F.min("check").alias("check"), F.max("check").alias("last")]
        return stored(rows.where("class is not null").groupBy("class").agg(F.min(id_col).alias("_id"), F.any_value("sig").alias("sig"), F.any_value("n_shingles").alias("n_shingles"), *least))

    sketch = sketch.withColumn("raw", F.col("class"))
    classes = grouped(sketch)
    twins = classes.where("check <> last").select(F.col("class").alias("twin"))
    if not twins.isEmpty():  # by the birthday bound, a handful among some 1e10 classes
        renamed = sketch.join(F.broadcast(twins), F.col("class") == F.col("twin"), "left")
        sketch = stored(renamed.withColumn("class", F.when(F.col("twin").isNull(), F.col("class")).otherwise(F.xxhash64("raw", "check"))).drop("twin"))
        classes = grouped(sketch)
    return classes.drop("last"), sketch


def _bands(classes: DataFrame) -> DataFrame:
    """(band, key, class): a row for each band of each class."""

    def run(batches):
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint32).reshape(batch.num_rows, BANDS, ROWS).astype(U64)
            acc = np.zeros(sig.shape[:2], dtype=U64)
            for k in range(ROWS):
                acc = mix(acc * U64(0x9FB21C651E98DF25) + sig[:, :, k])
            key = mix(acc + np.arange(BANDS, dtype=U64) * U64(0x9E3779B97F4A7C15)).view(np.int64)
            who = np.repeat(batch.column(0).to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(who)], names=["key", "class"])

    return classes.select("class", "sig").mapInArrow(run, "key long, class long")


def _least_agreement(percent: int) -> int:
    j = percent / 100
    return int(np.floor(_N * (j - DEVIATIONS * np.sqrt(j * (1 - j) / _N))))


def _to_pivots(buckets: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, pivot, agree): how many minima each class shares with its buckets' pivots."""

    def agree(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint32).reshape(batch.num_rows, _N) for i in (2, 3))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array((a == b).sum(axis=1).astype(np.int32))], names=["class", "pivot", "agree"])

    pairs = buckets.where("class <> pivot").select("class", "pivot").distinct()
    left, right = (classes.select(F.col("class").alias(f"_{c}"), F.col("sig").alias(f"s{c}")) for c in ("class", "pivot"))
    both = pairs.join(left, F.col("class") == F.col("_class")).join(right, F.col("pivot") == F.col("_pivot"))
    return both.select("class", "pivot", "sclass", "spivot").mapInArrow(agree, "class long, pivot long, agree int")


def _families(edges: DataFrame) -> DataFrame:
    """(class, family) of the classes in any pair."""
    return stored(connected_components(edges)).select(F.col("node").alias("class"), F.col("component").alias("family"))


def _across(buckets: DataFrame, agreed: DataFrame, families: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(u, v): two classes for each two families that share a bucket and may hold a link."""
    least = _least_agreement(percent)
    whose = families.select(F.col("class").alias("_c"), "family")
    named = buckets.join(whose, F.col("class") == F.col("_c"), "left").withColumn("family", F.coalesce("family", "class"))
    several = named.groupBy(F.col("key").alias("_k")).agg(F.min("family").alias("lo"), F.max("family").alias("hi"), F.max(F.when(F.col("class") == F.col("pivot"), F.col("family"))).alias("own_family")).where("lo < hi")
    rows = stored(named.drop("_c").join(several, F.col("key") == F.col("_k")).select("key", "class", "pivot", "family", (F.col("family") != F.col("own_family")).alias("apart")))
    if rows.isEmpty():
        return families.select(F.col("class").alias("u"), F.col("class").alias("v")).limit(0)
    near = agreed.select(F.col("class").alias("_c"), F.col("pivot").alias("_p"), "agree")
    rows = rows.join(near, (F.col("class") == F.col("_c")) & (F.col("pivot") == F.col("_p")), "left").withColumn("agree", F.coalesce("agree", F.lit(_N)))
    counts = rows.groupBy("key").agg(F.count_if("apart").alias("n"), F.max(F.when(F.col("apart"), F.col("agree"))).alias("most")).where("n > 0")
    # Two classes that agree in `least` places differ by at most _N - least in what they share with the pivot.
    rows = rows.select("key", "class", "family", "agree", "apart").join(counts.withColumnRenamed("key", "_k"), F.col("key") == F.col("_k")).where(F.col("apart") | (F.col("agree") <= F.col("most") + (_N - least)))
    sizes = rows.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("b"), F.ceil(F.count_if("apart") / BLOCK).cast("int").alias("blocks")).withColumnRenamed("key", "_k")
    rows = rows.drop("_k").join(sizes, F.col("key") == F.col("_k"))
    # Blocks i of the classes apart meet blocks j of all: a pair of families apart from each other is met as well.
    left = rows.where("apart").withColumns({"side": F.lit(0), "i": F.pmod(F.xxhash64("class"), "blocks").cast("int"), "j": F.explode(F.sequence(F.lit(0), F.col("b") - 1))})
    right = rows.withColumns({"side": F.lit(1), "j": F.pmod(F.xxhash64(F.lit(1), "class"), "b").cast("int"), "i": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))})
    dealt = left.select("key", "i", "j", "side", "class", "family").unionByName(right.select("key", "i", "j", "side", "class", "family"))
    dealt = dealt.join(classes.select(F.col("class").alias("_c"), "sig"), F.col("class") == F.col("_c")).drop("_c")

    def compare(table: pa.Table) -> pa.Table:
        side, family, who = (table.column(c).to_numpy() for c in ("side", "family", "class"))
        small = (np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype=np.uint32).reshape(len(who), _N) & np.uint32(0xFF)).astype(np.uint8)
        seen: dict = {}
        columns = np.flatnonzero(side == 1)
        for x in np.flatnonzero(side == 0):
            ys = columns[family[columns] != family[x]]
            for y in ys[(small[ys] == small[x]).sum(axis=1) >= least] if len(ys) else ():
                seen.setdefault((min(family[x], family[y]), max(family[x], family[y])), (who[x], who[y]))
        return pa.table({"u": pa.array([int(u) for u, _ in seen.values()], pa.int64()), "v": pa.array([int(v) for _, v in seen.values()], pa.int64())})

    return dealt.groupBy("key", "i", "j").applyInArrow(compare, "u long, v long").distinct()


def _shingled(classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(class, shingles) of these classes (class, raw, check, _id), from one text of each."""

    def again(batches):
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                runs, offs = shingle_sets(part.column(3), n)
                raw, check = _class_ids(runs, offs)
                right_one = (raw == part.column(1).to_numpy()) & (check == part.column(2).to_numpy())  # rows may share an id
                sets = [runs[offs[i] : offs[i + 1]].tobytes() for i in range(len(raw))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["class", "shingles"]).filter(pa.array(right_one))

    texts = docs.select(F.col(id_col).alias("_own"), F.col(text_col).cast("string").alias("text"))
    wanted = classes.select("class", "raw", "check", "_id")
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_CLASSES else wanted  # else the texts are shuffled, about once the input
    picked = texts.join(wanted, F.col("_own").eqNullSafe(F.col("_id"))).select("class", "raw", "check", "text")
    return picked.mapInArrow(again, "class long, shingles binary").dropDuplicates(["class"])


def _shared(a: list[np.ndarray], b: list[np.ndarray] | None) -> np.ndarray:
    """The sizes of all intersections of sets of a with those of b (or of a), by products of incidence matrices."""
    sets = a + (b or [])
    _, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.where(counts > 1, np.cumsum(counts > 1) - 1, -1)[inverse]  # a shingle of one set meets nothing
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    both = np.zeros((len(a), len(b) if b else len(a)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    for first in range(0, int((counts > 1).sum()), COLUMNS):
        lo, hi = np.searchsorted(column, [first, first + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        part[row[lo:hi], column[lo:hi] - first] = 1
        both += part[: len(a)] @ (part[len(a) :] if b else part).T
    return both.astype(np.float64)


def _similar(both: np.ndarray, a: list[np.ndarray], b: list[np.ndarray] | None, percent: float) -> np.ndarray:
    one, two = (np.array([len(x) for x in sets]) for sets in (a, a if b is None else b))
    return 100 * both >= percent * (one[:, None] + two[None, :] - both)


def _spread(link: np.ndarray, square: bool) -> np.ndarray:
    """For every row (then, unless the matrix is of one set of sets, every column) the least index it is linked to, over any steps."""
    n = len(link)
    label, far = np.arange(n if square else sum(link.shape)), sum(link.shape)
    while True:
        x, y = (label, label) if square else (label[:n], label[n:])
        x = np.minimum(x, np.where(link, y[None, :], far).min(axis=1, initial=far))
        y = np.minimum(y, np.where(link, x[:, None], far).min(axis=0, initial=far))
        new = np.minimum(x, y) if square else np.concatenate([x, y])
        if (new == label).all():
            return label
        label = new


def spanning_links(a: list[np.ndarray], b: list[np.ndarray] | None, percent: int) -> np.ndarray:
    """For every set of a (then of b), the index of the least set it is linked to, over any steps, by links in a or between a and b."""
    return _spread(_similar(_shared(a, b), a, b, percent), b is None)


def _edges(who: np.ndarray, label: np.ndarray) -> pa.Table:
    moved = label != np.arange(len(who))
    return pa.table({"u": pa.array(who[moved], pa.int64()), "v": pa.array(who[label[moved]], pa.int64())})


def _sets(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    return table.column("class").to_numpy(), [np.frombuffer(x, U64) for x in table.column("shingles").to_pylist()]


def _within(rows: DataFrame, percent: int) -> DataFrame:
    """Spanning links of the rows (family, class, shingles) of each small family: one task a family."""

    def confirm(table: pa.Table) -> pa.Table:
        who, found = _sets(table.sort_by("class"))
        return _edges(who, spanning_links(found, None, percent))

    return rows.select("family", "class", "shingles").groupBy("family").applyInArrow(confirm, "u long, v long")


def _between(rows: DataFrame, percent: int) -> DataFrame:
    """Spanning links between the sides 0 and 1 of each group: rows (a, b, i, j, side, class, shingles)."""

    def confirm(table: pa.Table) -> pa.Table:
        table = table.sort_by([("side", "ascending"), ("class", "ascending")])
        who, found = _sets(table)
        cut = int((table.column("side").to_numpy() == 0).sum())
        return _edges(who, spanning_links(found[:cut], found[cut:], percent)) if 0 < cut < len(who) else _edges(who[:0], np.zeros(0, np.int64))

    return rows.select("a", "b", "i", "j", "side", "class", "shingles").groupBy("a", "b", "i", "j").applyInArrow(confirm, "u long, v long")


def _blocks(count, shingles):
    return F.greatest(F.ceil(count / BLOCK), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")


def _crossed(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows (a, b, side, ...) dealt to blocks (i, j): those of side 0 to every j, those of side 1 to every i. sizes: (a, b, n0, n1) blocks."""
    of = sizes.select(F.col("a").alias("_a"), F.col("b").alias("_b"), "n0", "n1")
    rows = rows.join(of, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")))
    first = F.col("side") == 0
    rows = rows.withColumn("own", F.pmod(F.xxhash64("class", "side"), F.when(first, F.col("n0")).otherwise(F.col("n1"))).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(first, F.col("n1")).otherwise(F.col("n0")) - 1)))
    return rows.withColumns({"i": F.when(first, F.col("own")).otherwise(F.col("other")), "j": F.when(first, F.col("other")).otherwise(F.col("own"))})


def _by_centres(rows: DataFrame, percent: int, salt: int) -> tuple[DataFrame, DataFrame]:
    """(links, what no centre is linked to) of the rows (family, class, n_shingles, shingles, n) of large families; n: classes of the family."""
    rows = rows.withColumn("centre", F.pmod(F.xxhash64(F.lit(salt), "class"), F.greatest(F.floor(F.sqrt("n")), F.lit(1)).cast("long")) == 0)
    size = rows.groupBy("family").agg(_blocks(F.count("*"), F.sum("n_shingles")).alias("n1"), _blocks(F.count_if("centre"), F.sum(F.when(F.col("centre"), F.col("n_shingles")))).alias("n0")).where("n0 > 0")
    size = size.select(F.col("family").alias("a"), F.lit(0).cast("long").alias("b"), "n0", "n1")
    sides = rows.select(F.col("family").alias("a"), F.lit(0).cast("long").alias("b"), "class", "shingles", "n_shingles", F.explode(F.when(F.col("centre"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))).alias("side"))
    ball = 2 * percent - 100  # linked to a class that is linked to the centre

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("side", "ascending"), ("class", "ascending")])
        who, found = _sets(table)
        cut = int((table.column("side").to_numpy() == 0).sum())
        out = {"kind": [], "u": [], "v": []}
        if 0 < cut < len(who):
            a, b = found[:cut], found[cut:]
            both = _shared(a, b)
            link = _similar(both, a, b, percent)
            label = _spread(link, False)
            moved = np.flatnonzero(label != np.arange(len(who)))
            first = np.where(link.any(axis=0), link.argmax(axis=0), -1)  # a class's centre of this block: the least it is linked to
            held = np.flatnonzero(first >= 0)
            c, m = np.nonzero(_similar(both, a, b, ball) & (label[:cut, None] != label[None, cut:]))
            for kind, u, v in ((0, who[moved], who[label[moved]]), (1, who[cut + held], who[first[held]]), (2, who[cut + m], who[c])):
                out["kind"] += [kind] * len(u)
                out["u"] += u.tolist()
                out["v"] += v.tolist()
        return pa.table({"kind": pa.array(out["kind"], pa.int32()), "u": pa.array(out["u"], pa.int64()), "v": pa.array(out["v"], pa.int64())})

    dealt = _crossed(sides, size).select("a", "i", "j", "side", "class", "shingles")
    found = stored(dealt.groupBy("a", "i", "j").applyInArrow(compare, "kind int, u long, v long"))
    links = found.where("kind = 0").select("u", "v")
    centre_of = stored(found.where("kind = 1").groupBy("u").agg(F.min("v").alias("centre")))
    parts = stored(connected_components(links))
    visits = found.where("kind = 2").select(F.col("u").alias("class"), F.col("v").alias("ball"))
    for c in ("class", "ball"):  # only between components
        visits = visits.join(parts.select(F.col("node").alias("_n"), F.col("component").alias(f"of_{c}")), F.col(c) == F.col("_n"), "left").drop("_n")
    visits = visits.where(F.coalesce("of_class", "class") != F.coalesce("of_ball", "ball")).select("class", "ball").distinct()
    visits = stored(visits)
    if not visits.isEmpty():
        sets = rows.select("class", "shingles", "n_shingles")
        balls = visits.select("ball").distinct().join(centre_of, F.col("ball") == F.col("centre")).select(F.col("ball").alias("a"), F.col("u").alias("class"), F.lit(1).alias("side"))
        guests = visits.select(F.col("ball").alias("a"), "class", F.lit(0).alias("side")).unionByName(balls).withColumn("b", F.lit(0).cast("long"))
        guests = stored(guests.join(sets, "class"))
        one = F.col("side") == 0
        sizes = guests.groupBy("a", "b").agg(_blocks(F.count_if(one), F.sum(F.when(one, F.col("n_shingles")))).alias("n0"), _blocks(F.count_if(~one), F.sum(F.when(~one, F.col("n_shingles")))).alias("n1")).where("n0 > 0 and n1 > 0")
        links = links.unionByName(_between(_crossed(guests, sizes), percent))
    loose = rows.drop("centre", "n").join(centre_of.select(F.col("u").alias("_u")), F.col("class") == F.col("_u"), "left_anti")
    return stored(links), stored(loose)


def _confirmed(families: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> DataFrame:
    """(u, v): links that span each family's components, confirmed on the full sets."""
    members = classes.select("class", "raw", "check", "_id", "n_shingles").join(families, "class")
    sizes = members.groupBy("family").agg(_blocks(F.count("*"), F.sum("n_shingles")).alias("blocks"), F.count("*").alias("n"))
    named = stored(members.join(sizes, "family"))
    sets = _shingled(named, docs, id_col, text_col, n)
    rows = named.select("family", "class", "n_shingles", "blocks", "n").join(sets, "class")
    most = named.agg(F.max("blocks")).first()[0] or 0
    if most <= 1:
        return stored(_within(rows, percent))
    rows = stored(rows)
    links, left = _settled(rows, percent)
    if most > FEW_BLOCKS:
        for salt in range(ROUNDS):
            more, left = _by_centres(left, percent, salt)
            again = left.groupBy("family").agg(_blocks(F.count("*"), F.sum("n_shingles")).alias("blocks"), F.count("*").alias("n")).withColumnRenamed("family", "_f")
            few, left = _settled(stored(left.join(again, F.col("family") == F.col("_f")).drop("_f")), percent)
            links = links.unionByName(more).unionByName(few)
            if left.isEmpty():
                break
        links = links.unionByName(_in_pairs(left, percent))
    return stored(links)


def _settled(rows: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(links of the small families, the rows of the others) of rows (family, class, n_shingles, shingles, blocks, n)."""
    few = rows.where((F.col("blocks") > 1) & (F.col("blocks") <= FEW_BLOCKS))
    return _within(rows.where("blocks = 1"), percent).unionByName(_in_pairs(few, percent)), rows.where(F.col("blocks") > FEW_BLOCKS).drop("blocks")


def _in_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Spanning links of families, by all pairs of their blocks."""
    family = [F.col("family").alias("a"), F.lit(0).cast("long").alias("b")]
    blocks = rows.groupBy(*family).agg(_blocks(F.count("*"), F.sum("n_shingles")).alias("n0")).select("a", "b", "n0", F.col("n0").alias("n1"))
    return _between(_crossed(rows.select(*family, "class", "shingles", F.explode(F.array(F.lit(0), F.lit(1))).alias("side")), blocks), percent)


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, class, component_id, kept) of every row; component_id is the least id reachable."""
    classes, sketch = _classes(stored(sketched(docs, id_col, text_col, n)), id_col)
    bands = _bands(classes)
    shared = bands.groupBy("key").agg(F.count("*").alias("size"), F.min("class").alias("pivot")).where("size > 1").select(F.col("key").alias("_k"), "pivot")
    buckets = stored(bands.join(shared, F.col("key") == F.col("_k")).select("key", "class", "pivot"))
    maybe = stored(classes.join(buckets.select("class").distinct(), "class", "left_semi"))  # in any shared bucket

    agreed = stored(_to_pivots(buckets, maybe))
    close = agreed.where(F.col("agree") >= int(CLOSE * _N)).select(F.col("class").alias("u"), F.col("pivot").alias("v"))
    families = _families(close)
    more = stored(_across(buckets, agreed, families, maybe, percent))
    if not more.isEmpty():
        families = _families(close.unionByName(more))
    components = stored(connected_components(_confirmed(families, maybe, docs, id_col, text_col, n, percent)))

    labels = classes.select(F.col("class"), "_id").join(components.select(F.col("node").alias("class"), "component"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = labels.groupBy("component").agg(F.min("_id").alias("component_id"))
    final = labels.join(least, "component").select(F.col("class").alias("_class"), "component_id")
    out = sketch.drop("sig").join(final, F.col("class") == F.col("_class"), "left").withColumn("component_id", F.when(F.col("class").isNull(), F.col(id_col)).otherwise(F.col("component_id")))
    return out.select(id_col, "n_shingles", "class", "component_id", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)).alias("kept"))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(documents(spark, sf_dir)).drop("class")
