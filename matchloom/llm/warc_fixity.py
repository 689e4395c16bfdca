"""Merkle fixity audit of WARC replicas.

Pages become WARC response records, placed one after another (by id, then digest) in
files: FILE_IDS ids to a file, and a group of ids with over FILE_RECORDS different
records is split into several files by digest, so no file grows with the data. Equal
records (same id, same bytes) lie next to each other and are kept as one run with its
number of copies, so a page that is there a billion times is one row. The layout (how many
files a group has) belongs to the first replica; others are laid out by it.

A replica's fixity tree has a leaf for every run - SHA-256 over offset, length, copies and
record digest - and a node for every FANOUT neighbours: over the runs of a file in offset
order, then over the files of a group, then over groups, up to one root. Node ids are
positions, so equal ranges of two replicas have equal ids.

The audit compares the roots, then only the children of nodes that differ, level by level.
In the offset ranges that differ in the end, records are aligned by id and digest, so a
record lost in the middle of a file is one finding although all later offsets differ. What
is in one replica alone is `corrupt` where the other has other bytes for the same id,
else `missing` or `extra`; `moved` are common records of another rank among the file's
common records. Undamaged ranges are never opened again.

Cases: null urls and bodies are written as empty; repeated rows are records of their own;
null ids come first, in group 0; empty tables have no root and no findings; long bodies
stay whole; extra columns are ignored. All steps are DataFrame operations; a node takes
fewer than 2 * FANOUT children.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import stored

#: Ids in one group; different records in a file, about; children of a tree node.
FILE_IDS, FILE_RECORDS, FANOUT = 512, 1024, 32
#: Groups of several files that are broadcast at most (24 bytes each); more are joined.
BROADCAST_GROUPS = 1 << 16

_PLACE = ["group", "part", "node"]


def warc_record(url, body):
    """The bytes of a WARC/1.1 response record with this target and payload."""
    payload = F.coalesce(body, F.lit("")).cast("binary")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head.cast("binary"), payload, F.lit("\r\n\r\n").cast("binary"))


def parse_warc(record) -> dict:
    """Columns url, length and body of a record's bytes."""
    text = record.cast("string")
    head = F.substring_index(text, "\r\n\r\n", 1)
    length = F.regexp_extract(head, r"Content-Length: (\d+)", 1).cast("int")
    body = F.substring(record, F.octet_length(head) + 5, length)
    return {"url": F.regexp_extract(head, r"WARC-Target-URI: ([^\r]*)", 1), "length": length, "body": body.cast("string")}


def digests(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", **more) -> DataFrame:
    """(id, length, sha, ...) of the pages' records; the bytes are hashed where they are read."""
    record = warc_record(F.col(url_col).cast("string"), F.col(body_col).cast("string"))
    return pages.select(F.col(id_col).cast("long").alias("id"), F.octet_length(record).cast("long").alias("length"), F.sha2(record, 256).alias("sha"), *[c.alias(n) for n, c in more.items()])


def runs(records: DataFrame) -> DataFrame:
    """Equal records as one row with copies, and their group."""
    return records.groupBy(*records.columns).agg(F.count("*").alias("copies")).withColumn("group", F.expr(f"coalesce(id div {FILE_IDS}, 0L)"))


def layout(own: DataFrame, file_records: int = FILE_RECORDS) -> DataFrame:
    """(of, splits): into how many files the records of a large group go."""
    return stored(own.groupBy(F.col("group").alias("of")).agg(F.count("*").alias("n")).where(F.col("n") > file_records).select("of", F.ceil(F.col("n") / file_records).cast("long").alias("splits")))


def placed(own: DataFrame, large: DataFrame) -> DataFrame:
    """The runs with part (the file in the group), node (the place in the file) and offset."""
    large = F.broadcast(large) if large.count() <= BROADCAST_GROUPS else large
    prefix = F.conv(F.substring("sha", 1, 7), 16, 10).cast("long")
    rows = own.join(large, F.col("group") == F.col("of"), "left").withColumn("part", F.coalesce(F.shiftright(prefix * F.col("splits"), 28), F.lit(0).cast("long"))).drop("of", "splits")
    return _in_order(rows, F.col("id").asc_nulls_first(), F.col("sha"))


def _in_order(rows: DataFrame, *order) -> DataFrame:
    file = W.partitionBy("group", "part").orderBy(*order)
    before = F.sum(F.col("length") * F.col("copies")).over(file.rowsBetween(W.unboundedPreceding, -1))
    return rows.withColumn("node", F.row_number().over(file).cast("long") - 1).withColumn("offset", F.coalesce(before, F.lit(0).cast("long")))


def replica(pages: DataFrame, large: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", file_records: int = FILE_RECORDS) -> DataFrame:
    """(id, length, sha, copies, group, part, node, offset); large: the layout of the replica that this one is audited against."""
    own = stored(runs(digests(pages, id_col, url_col, body_col)))
    return placed(own, layout(own, file_records) if large is None else large)


def _steps(*replicas: DataFrame) -> list[str]:
    """The places that are divided by FANOUT from level to level, until one root is left."""
    out = []
    tops = [r.agg(*[F.max(F.abs(F.col(c))).alias(c) for c in _PLACE]).first() for r in replicas]
    for c in reversed(_PLACE):
        most, height = max((t[c] or 0 for t in tops), default=0), 0
        while FANOUT**height <= most:
            height += 1
        out += [c] * height
    return out


def _parent(step: str) -> list:
    return [F.expr(f"`{c}` div {FANOUT}").alias(c) if c == step else F.col(c) for c in _PLACE]


def tree(records: DataFrame, steps: list[str]) -> list[DataFrame]:
    """The levels (group, part, node, hash) from the runs to the root. The first above the runs is stored; those above it are small."""
    leaf = F.sha2(F.concat_ws(":", *[F.col(c).cast("string") for c in ("offset", "length", "copies", "sha")]), 256)
    levels = [records.select(*_PLACE, leaf.alias("hash"))]
    for step in steps:
        child = F.struct(F.col(step).alias("at"), "hash")
        children = F.transform(F.array_sort(F.collect_list(child)), lambda c: F.concat_ws("=", c["at"].cast("string"), c["hash"]))
        up = [c.alias(f"_{n}") for n, c in zip(_PLACE, _parent(step))]
        above = levels[-1].groupBy(*up).agg(F.sha2(F.array_join(children, ","), 256).alias("hash"))
        above = above.select(*[F.col(f"_{c}").alias(c) for c in _PLACE], "hash")
        levels.append(stored(above) if len(levels) == 1 else above)
    return levels


def damaged(first: list[DataFrame], second: list[DataFrame], steps: list[str]) -> DataFrame | None:
    """The places (group, part, node) at which two replicas' runs differ; None where the roots are equal."""
    suspects = None
    for k in range(len(steps), -1, -1):
        sides = []
        for side, tag in ((first[k], "a"), (second[k], "b")):
            if suspects is not None:
                up = suspects.select(*[F.col(c).alias(f"_{c}") for c in _PLACE])
                same = [F.col(f"_{c}") == (F.expr(f"`{c}` div {FANOUT}") if c == steps[k] else F.col(c)) for c in _PLACE]
                side = side.join(up, same, "left_semi")
            sides.append(side.withColumnRenamed("hash", tag))
        suspects = sides[0].join(sides[1], _PLACE, "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select(*_PLACE)
        if k == len(steps) and suspects.isEmpty():
            return None
    return stored(suspects)


def _within(value, most):
    return F.greatest(F.least(value, most), F.lit(0).cast("long"))


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """(group, part, node, id, offset, length, sha, status, copies) of the records that differ; places are those of the first replica, of the second for `extra`."""
    steps = _steps(first, second)
    where = damaged(tree(first, steps), tree(second, steps), steps)
    at = (first.limit(0) if where is None else where).select(*[F.col(c).alias(f"_{c}") for c in _PLACE])
    keys = ["group", "part", "id", "sha"]

    def own(side: DataFrame, tag: str) -> DataFrame:
        rows = side.join(at, [F.col(c) == F.col(f"_{c}") for c in _PLACE], "left_semi")
        place = F.min(F.struct("node", "offset", "length")).alias(tag)
        return rows.groupBy(*keys).agg(F.sum("copies").alias(f"n{tag}"), place).select(*[F.col(c).alias(f"{c}_{tag}") for c in keys], f"n{tag}", tag)

    both = own(first, "a").join(own(second, "b"), [F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b")) for c in keys], "full_outer")
    na, nb = (F.coalesce(F.col(n), F.lit(0).cast("long")) for n in ("na", "nb"))
    none = F.lit(0).cast("long")
    rows = both.select(
        *[F.when(F.col("na").isNotNull(), F.col(f"{c}_a")).otherwise(F.col(f"{c}_b")).alias(c) for c in keys], "a", "b",
        F.least(na, nb).alias("common"), F.greatest(na - nb, none).alias("gone"), F.greatest(nb - na, none).alias("new"),
    )
    ident = W.partitionBy("group", "part", "id")
    earlier = ident.orderBy("sha").rowsBetween(W.unboundedPreceding, -1)
    corrupt = _within(F.sum("new").over(ident) - F.coalesce(F.sum("gone").over(earlier), none), F.col("gone"))
    paired = _within(F.sum("gone").over(ident) - F.coalesce(F.sum("new").over(earlier), none), F.col("new"))
    file = W.partitionBy("group", "part", F.col("common") > 0)
    moved = (F.col("common") > 0) & (F.row_number().over(file.orderBy("a.node")) != F.row_number().over(file.orderBy("b.node")))
    rows = rows.withColumns({"corrupt": corrupt, "extra": F.col("new") - paired, "moved": F.when(moved, F.col("common")).otherwise(none)}).withColumn("missing", F.col("gone") - F.col("corrupt"))
    kinds = F.array(*[F.struct(F.lit(s).alias("status"), F.col(s).alias("copies"), F.when(F.lit(s) == "extra", F.col("b")).otherwise(F.col("a")).alias("at")) for s in ("corrupt", "missing", "moved", "extra")])
    found = rows.select("group", "part", "id", "sha", F.explode(F.filter(kinds, lambda k: k["copies"] > 0)).alias("k"))
    return found.select("group", "part", "k.at.node", "id", "k.at.offset", "k.at.length", "sha", "k.status", "k.copies")


#: The query's stand-in damage in the second replica: one page id in so many has another first character, one in so many is lost.
DAMAGE_STEP, DAMAGE_REST = 97, 13
LOST_STEP, LOST_REST = 389, 7


def op4_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record with its place, digest and the audit's finding against a copy of the files with planted damage."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    flipped = F.when(F.col("page_id") % DAMAGE_STEP == DAMAGE_REST, F.concat(F.lit("~"), F.substring("html", 2, 1 << 30))).otherwise(F.col("html"))
    other = warc_record(F.col("url"), flipped)
    lost = F.coalesce(F.col("page_id") % LOST_STEP == LOST_REST, F.lit(False))
    own = stored(runs(digests(pages, other_length=F.octet_length(other).cast("long"), other_sha=F.sha2(other, 256), lost=lost)))
    first = stored(placed(own, layout(own)))
    kept = first.where("not lost").select("id", F.col("other_length").alias("length"), F.col("other_sha").alias("sha"), "copies", "group", "part", F.col("node").alias("rank"))
    second = stored(_in_order(kept, F.col("rank")).drop("rank"))
    hurt = F.col("status") == "corrupt"
    bad = audit(first, second).where("status <> 'extra'").groupBy(*[F.col(c).alias(f"_{c}") for c in _PLACE]).agg(F.sum(F.when(hurt, F.col("copies")).otherwise(0)).alias("corrupt"), F.sum(F.when(F.col("status") == "missing", F.col("copies")).otherwise(0)).alias("missing"))
    joined = first.join(bad, [F.col(c) == F.col(f"_{c}") for c in _PLACE], "left").withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    intact = F.col("copies") - F.coalesce("corrupt", F.lit(0)) - F.coalesce("missing", F.lit(0))
    status = F.when(F.col("nth") <= intact, "intact").when(F.col("nth") <= intact + F.coalesce("corrupt", F.lit(0)), "corrupt").otherwise("missing")
    return joined.select(F.col("id").alias("page_id"), F.concat_ws("-", F.col("group").cast("string"), F.col("part").cast("string")).alias("warc_file"), (F.col("offset") + (F.col("nth") - 1) * F.col("length")).alias("offset"), "length", "sha", status.alias("status"))


def _record_sql(body: str) -> str:
    line = "chr(13) || chr(10)"
    return f"""'WARC/1.1' || {line} || 'WARC-Type: response' || {line} || 'WARC-Target-URI: ' || coalesce(url, '') || {line}
  || 'Content-Type: text/html' || {line} || 'Content-Length: ' || strlen(coalesce({body}, '')) || {line} || {line} || coalesce({body}, '') || {line} || {line}"""


#: Both replicas are written out and their records compared one by one, without a tree.
OP4_SQL = f"""
WITH r AS (SELECT page_id, coalesce(page_id // {FILE_IDS}, 0) AS g, {_record_sql('html')} AS record,
  {_record_sql(f"(CASE WHEN page_id % {DAMAGE_STEP} = {DAMAGE_REST} THEN '~' || substr(html, 2) ELSE html END)")} AS other,
  coalesce(page_id % {LOST_STEP} = {LOST_REST}, false) AS lost FROM pages),
h AS (SELECT page_id, g, strlen(record)::BIGINT AS length, sha256(record) AS sha, sha256(other) AS sha2, lost FROM r),
large AS (SELECT g, count(*) AS n FROM (SELECT DISTINCT g, page_id, sha FROM h) GROUP BY g),
p AS (SELECT h.*, CASE WHEN n > {FILE_RECORDS} THEN (('0x' || substr(sha, 1, 7))::BIGINT * ceil(n / {FILE_RECORDS})::BIGINT) >> 28 ELSE 0 END AS part FROM h JOIN large USING (g)),
a AS (SELECT *, row_number() OVER (PARTITION BY g, part, page_id, sha) AS nth,
      coalesce(sum(length) OVER (PARTITION BY g, part ORDER BY page_id NULLS FIRST, sha ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS upto FROM p),
f AS (SELECT page_id, g, part, length, sha, nth, min(upto) OVER (PARTITION BY g, part, page_id, sha) + (nth - 1) * length AS place FROM a),
na AS (SELECT g, part, page_id, sha, count(*) AS na FROM p GROUP BY ALL),
nb AS (SELECT g, part, page_id, sha2 AS sha, count(*) AS nb FROM p WHERE NOT lost GROUP BY ALL),
d AS (SELECT coalesce(na.g, nb.g) AS g, coalesce(na.part, nb.part) AS part, coalesce(na.page_id, nb.page_id) AS page_id, coalesce(na.sha, nb.sha) AS sha,
      greatest(coalesce(na, 0) - coalesce(nb, 0), 0) AS gone, greatest(coalesce(nb, 0) - coalesce(na, 0), 0) AS new_, coalesce(na, 0) AS na
      FROM na FULL JOIN nb ON na.g = nb.g AND na.part = nb.part AND na.sha = nb.sha AND na.page_id IS NOT DISTINCT FROM nb.page_id),
e AS (SELECT *, greatest(least(sum(new_) OVER (PARTITION BY g, part, page_id) - coalesce(sum(gone) OVER (PARTITION BY g, part, page_id ORDER BY sha ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), gone), 0) AS corrupt FROM d)
SELECT f.page_id, f.g || '-' || f.part AS warc_file, place::BIGINT AS "offset", f.length, f.sha,
       CASE WHEN nth <= na - gone THEN 'intact' WHEN nth <= na - gone + corrupt THEN 'corrupt' ELSE 'missing' END AS status
FROM f JOIN e ON f.g = e.g AND f.part = e.part AND f.sha = e.sha AND f.page_id IS NOT DISTINCT FROM e.page_id
"""
