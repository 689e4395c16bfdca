"""Line dedup with a fixed-depth log-template tree.

A line's words, with A-Z lower-cased and words that hold a digit replaced by a wildcard,
are sorted into a tree of fixed depth: first by their number, then by the leading DEPTH
words. In a leaf, lines are grouped greedily, the most frequent first: a line joins the
template that agrees with it in the largest share of positions, if that is at least
SIMILARITY, and positions that differ become wildcards; else it opens a template. Only
leaves with several different lines need this; a line alone in its leaf is its template.

A template found in at least MIN_DOCS documents recurs: its lines are dropped from all
documents but the first (the least id), so that what is dropped is still there once.

Some lines are compared as they are as well, digits and all (but for the case of A-Z and
the spaces between words), outside the tree: those with over LONG_WORDS words recur from
two documents on, those with fewer than MIN_WORDS words, of which one has a letter, from
SHORT_DOCS documents on.

Counting is by partial sums over (line, document), so a very common line is one row a
task. A leaf's lines, sorted by Spark, stream through a task that holds templates alone.
Past SCAN_HEADS templates a line is compared with those that share a band of words with it;
no template that it can join shares none, so the result is that of comparing all. A leaf of
over LEAF_LINES lines is dealt by hash to several tasks, and then their templates are
grouped among themselves: all at once where few are left, else in rounds, by one band of
words after another, so that any two that can be joined meet, until a cycle of rounds joins
none. Positions are compared by 16-bit digests of their words.

Cases: a null text stays null and has no lines; empty texts, and lines without words, stay
as they are; rows with the same id are one document; rows without an id count as one
document, which is never the first; very long texts and lines are handled whole; an empty
table gives an empty result; extra columns pass through `dropped` unchanged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .shared import documents, fresh, stored
from .textvec import LOWER, U64, mix, segment_sum, slices, spans, words

DEPTH = 3
SIMILARITY = 0.7
MIN_DOCS, MIN_WORDS = 3, 8
LONG_WORDS, LONG_DOCS, SHORT_DOCS = 50, 2, 5
#: A line is compared with all templates of its leaf up to this number of them.
SCAN_HEADS = 256
#: Lines, or templates, of one leaf that are grouped in one task, about.
LEAF_LINES = 1 << 13
#: Lines that are broadcast at most (8 or 16 bytes each); more are joined.
BROADCAST_LINES = 1 << 20

_WILD = U64(0x2545F4914F6CDD1D)
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x80:] = _LETTER[ord("a") : ord("z") + 1] = _LETTER[ord("A") : ord("Z") + 1] = True
_NEWLINE = np.zeros(256, dtype=bool)
_NEWLINE[0x0A] = True


def _sequence(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the values in each range [begin, end)."""
    place = mix(np.arange(int((end - begin).max(initial=0)), dtype=U64) + U64(0xD1342543DE82EF95))
    n = end - begin
    who = np.repeat(np.arange(len(n)), n)
    inner = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
    sums = np.concatenate([[U64(0)], np.cumsum(mix(values[np.repeat(begin, n) + inner] ^ place[inner]), dtype=U64)])
    stop = np.cumsum(n)
    return mix(sums[stop] - sums[stop - n] + n.astype(U64) * U64(0x9E3779B97F4A7C15))


def lines_of(column: pa.Array):
    """Of all lines with words: text index, start, end, leaf, hash as a template, hash as it is, words' digests; and raw bytes.

    A line has the hash 0 where it is not compared in that way.
    """
    hashes, _, starts, ends, raw, offs = words(column, LOWER)
    digits = np.concatenate([[0], np.cumsum(_DIGIT[raw])])
    masked = np.where(digits[ends] > digits[starts], _WILD, hashes)
    a, b = spans(raw, offs, _NEWLINE)
    first, last = np.searchsorted(starts, a), np.searchsorted(starts, b)
    some = last > first
    a, b, first, last = a[some], b[some], first[some], last[some]
    letters = np.concatenate([[0], np.cumsum(_LETTER[raw])])
    text = np.searchsorted(offs, a, side="right") - 1
    count = (last - first).astype(U64)
    leaf = mix(_sequence(masked, first, np.minimum(last, first + DEPTH)) + count * U64(0xBF58476D1CE4E5B9))
    short = last - first < MIN_WORDS
    line = np.where(short, U64(0), _sequence(masked, first, last))
    same = np.where(np.where(short, letters[b] > letters[a], last - first > LONG_WORDS), mix(_sequence(hashes, first, last) ^ U64(0x94D049BB133111EB)), U64(0))
    digests = (masked >> U64(48)).astype(np.uint16)
    return text, a, b, leaf.view(np.int64), line.view(np.int64), same.view(np.int64), first, last, digests, raw, offs


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, leaf, line, digests, least): every different line of each text once in each way it is compared.

    Lines of templates have no `least`; those compared as they are have no leaf and digests,
    and recur from `least` documents on.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                text, _, _, leaf, line, same, first, last, digests, _, _ = lines_of(part.column(1))

                def once(key):
                    _, one = np.unique(mix(key.view(U64) + text.astype(U64) * U64(0x9E3779B97F4A7C15)), return_index=True)
                    return one[key[one] != 0]

                one, as_is = once(line), once(same)
                packed = [digests[x:y].tobytes() for x, y in zip(first[one], last[one])]
                least = np.where(last[as_is] - first[as_is] > LONG_WORDS, LONG_DOCS, SHORT_DOCS)
                none = len(as_is)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.concatenate([text[one], text[as_is]]))), pa.concat_arrays([pa.array(leaf[one]), pa.nulls(none, pa.int64())]), pa.array(np.concatenate([line[one], same[as_is]])),
                        pa.concat_arrays([pa.array(packed, pa.binary()), pa.nulls(none, pa.binary())]), pa.concat_arrays([pa.nulls(len(one), pa.int32()), pa.array(least, pa.int32())]),
                    ],
                    names=["doc", "leaf", "line", "digests", "least"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc long, leaf long, line long, digests binary, least int")


class Leaf:
    """The templates of one leaf. Its lines come in by descending count; tokens: the digests of their words."""

    def __init__(self, width: int, similarity: float = SIMILARITY, scan_heads: int = SCAN_HEADS):
        self.least, self.scan_heads = math.ceil(similarity * width), scan_heads
        self.templates = np.empty((16, width), dtype=np.int32)
        self.heads: list[int] = []
        self.alone: list[bool] = []
        # One band more than positions that may differ, so a template that a line can join has one band without a difference.
        start = min(DEPTH, self.least - 1)  # the leading words are the leaf's own
        self.cuts = np.linspace(start, width, width - self.least + 2).astype(int)
        self.early: list[np.ndarray] = []  # the heads before there was an index
        self.by_band: dict[int, list[int]] = {}

    def _bands(self, tokens: np.ndarray) -> list[list[int]]:
        flat, row = tokens.astype(U64).ravel(), np.arange(len(tokens)) * tokens.shape[1]
        return np.stack([mix(_sequence(flat, row + x, row + y) + U64(x)) for x, y in zip(self.cuts[:-1], self.cuts[1:])], axis=1).tolist()

    def _index(self, t: int, bands: list[int]) -> None:
        # By the head's words: where a template still has no wildcard, they are its own.
        for band in bands:
            self.by_band.setdefault(band, []).append(t)

    def add(self, lines: list[int], tokens: np.ndarray) -> list[tuple[int, int]]:
        """(line, template) of the lines that join a template, and of each template's first line when it is first joined."""
        pairs, bands = [], None
        for i, line in enumerate(lines):
            n, near = len(self.heads), None
            if n > self.scan_heads:
                if bands is None:
                    for t, own in enumerate(self._bands(np.array(self.early)) if self.early else []):
                        self._index(t, own)
                    self.early, bands = [], [[]] * i + self._bands(tokens[i:])
                near = np.array(sorted({t for band in bands[i] for t in self.by_band.get(band, ())}), dtype=np.int64)
            agree = ((self.templates[:n] if near is None else self.templates[near]) == tokens[i]) & (tokens[i] >= 0)
            share = agree.sum(axis=1)
            best = int(share.argmax()) if len(share) else -1
            if best >= 0 and share[best] >= self.least:
                t = best if near is None else int(near[best])
                self.templates[t][~agree[best]] = -1
                pairs += [(self.heads[t], self.heads[t])] * self.alone[t] + [(line, self.heads[t])]
                self.alone[t] = False
                continue
            if n == len(self.templates):
                self.templates = np.concatenate([self.templates, np.empty_like(self.templates)])
            self.templates[n] = tokens[i]
            if near is None:
                self.early.append(tokens[i])
            else:
                self._index(n, bands[i])
            self.heads.append(line)
            self.alone.append(True)
        return pairs


_GROUPED = "line long, template long, leaf long, n long, tokens binary"


def _grouped(rows: DataFrame, kind) -> DataFrame:
    """(line, template) of the lines that share a template with another in their node and part; and, where `more`, a row (line, null, leaf, n, tokens) for each template.

    A part's lines come together, the most frequent first. kind: the type of the digests.
    """

    def run(batches):
        at, leaves, heads = None, {}, []

        def closed():
            out = [(h, None, leaf, n, t.templates[k].tobytes()) for t, own in leaves.values() for k, h in enumerate(t.heads) for leaf, n in [own[h]]] if heads else []
            heads.clear()
            return out

        def batch_of(pairs):
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["line", "template", "leaf", "n", "tokens"])

        for batch in batches:
            nodes, parts = batch.column("node").to_numpy(), batch.column("part").to_numpy()
            lines, packed, more = (batch.column(c).to_pylist() for c in ("line", "digests", "more"))
            owner, counts = batch.column("leaf").to_pylist(), batch.column("n").to_pylist()
            widths = np.array([len(p) // np.dtype(kind).itemsize for p in packed], dtype=np.int64)
            new = np.ones(len(nodes), dtype=bool)
            new[1:] = (nodes[1:] != nodes[:-1]) | (parts[1:] != parts[:-1]) | (widths[1:] != widths[:-1])  # one width a leaf, unless two leaves' hashes are equal
            cuts, out = [*np.flatnonzero(new), len(nodes)], []
            for x, y in zip(cuts[:-1], cuts[1:]):
                if (nodes[x], parts[x]) != at:
                    out += closed()
                    at, leaves = (nodes[x], parts[x]), {}
                w = int(widths[x])
                leaf, own = leaves.setdefault(w, (Leaf(w), {}))
                out += [(*p, None, None, None) for p in leaf.add(lines[x:y], np.frombuffer(b"".join(packed[x:y]), dtype=kind).reshape(-1, w).astype(np.int32))]
                if more[x]:
                    heads.append(True)
                    own.update(zip(lines[x:y], zip(owner[x:y], counts[x:y])))
                    own = {h: own[h] for h in leaf.heads}
                    leaves[w] = (leaf, own)
            yield batch_of(out)
        yield batch_of(closed())

    ordered = rows.repartition("node", "part").sortWithinPartitions("node", "part", F.desc("n"), "line")
    return ordered.select("node", "part", "more", "leaf", "line", "n", "digests").mapInArrow(run, _GROUPED)


def _banded(heads: DataFrame, r: int) -> DataFrame:
    """The templates (leaf, line, n, digests) with band: a hash of their r-th band of words, counted round; and bands, how many they have."""

    def run(batches):
        for batch in batches:
            band, bands = [], []
            for packed in batch.column("digests").to_pylist():
                tokens = np.frombuffer(packed, dtype=np.int32)
                cuts = Leaf(len(tokens)).cuts
                bands.append(len(cuts) - 1)
                x, y = cuts[r % bands[-1]], cuts[r % bands[-1] + 1]
                band.append(int(mix(_sequence(tokens.astype(U64), np.array([x]), np.array([y])) + U64(x)).view(np.int64)[0]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(band, pa.int64()), pa.array(bands, pa.int32())], names=[*batch.schema.names, "band", "bands"])

    return heads.mapInArrow(run, "leaf long, line long, n long, digests binary, band long, bands int")


def _merged(pairs: DataFrame, heads: DataFrame, leaf_lines: int) -> DataFrame:
    """(line, template) when the templates of large leaves' parts are grouped among themselves as well."""
    r = idle = 0
    while True:
        banded = stored(_banded(heads, r))
        sizes = banded.groupBy("leaf").agg(F.count("*").alias("size"))
        named = banded.join(sizes, "leaf").withColumn("more", F.col("size") > leaf_lines)
        named = stored(named.withColumn("node", F.when(F.col("more"), F.xxhash64("leaf", "band")).otherwise(F.col("leaf"))))
        state = named.agg(F.count("*").alias("n"), F.max(F.when(F.col("more"), F.col("bands"))).alias("bands")).first()
        if not state["n"] or idle > (state["bands"] or 0):
            return pairs
        groups = named.groupBy(F.col("node").alias("of")).agg(F.ceil(F.count("*") / leaf_lines).cast("int").alias("parts"))
        rows = named.join(groups, F.col("node") == F.col("of")).withColumn("part", F.pmod(F.xxhash64(F.lit(r), "line"), F.col("parts")).cast("int"))
        out = stored(_grouped(rows, np.int32))
        moves = out.where("template is not null").select(F.col("line").alias("of"), F.col("template").alias("to"))
        further = pairs.join(moves, F.col("template") == F.col("of"), "left").select("line", F.coalesce("to", "template").alias("template"))
        first = moves.join(pairs.select(F.col("line").alias("known")), F.col("of") == F.col("known"), "left_anti").select(F.col("of").alias("line"), F.col("to").alias("template"))
        pairs = stored(further.unionByName(first))
        heads = out.where("template is null").select("leaf", "line", "n", F.col("tokens").alias("digests"))
        r, idle = r + 1, idle + 1 if moves.isEmpty() else 0


def templates(found: DataFrame, broadcast_lines: int = BROADCAST_LINES, leaf_lines: int = LEAF_LINES) -> DataFrame:
    """(line, template) of the lines that share a template with another line; found: stored occurrences."""
    lines = stored(found.groupBy("leaf", "line").agg(F.count("*").alias("n")))
    leaves = lines.groupBy("leaf").agg(F.count("*").alias("size")).where("size > 1")
    chosen = stored(lines.join(leaves, "leaf").select("leaf", "line", "n", F.ceil(F.col("size") / leaf_lines).cast("int").alias("parts")))
    state = chosen.agg(F.count("*").alias("n"), F.max("parts").alias("parts")).first()
    wanted = chosen.select(F.col("line").alias("l"))
    wanted = F.broadcast(wanted) if state["n"] <= broadcast_lines else wanted  # 8 bytes a line; most lines' digests then stay where they are
    digests = found.select(F.col("line").alias("l"), "digests").join(wanted, "l", "left_semi").groupBy("l").agg(F.any_value("digests").alias("digests"))
    rows = chosen.join(digests, F.col("line") == F.col("l")).withColumns({"node": F.col("leaf"), "part": F.pmod(F.xxhash64("line"), F.col("parts")).cast("int"), "more": F.col("parts") > 1})
    out = stored(_grouped(rows, np.uint16))
    pairs = out.where("template is not null").select("line", "template")
    return _merged(pairs, out.where("template is null").select("leaf", "line", "n", F.col("tokens").alias("digests")), leaf_lines) if (state["parts"] or 0) > 1 else pairs


def recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, broadcast_lines: int = BROADCAST_LINES, leaf_lines: int = LEAF_LINES) -> tuple[DataFrame, DataFrame]:
    """((line, first) of all recurring lines, the occurrences). first: the least id with the template, or with the line as it is."""
    found = stored(occurrences(docs, id_col, text_col))
    in_tree = found.where("least is null")
    named = templates(in_tree, broadcast_lines, leaf_lines)
    each = in_tree.select("doc", "line").distinct()
    merged = each.join(named, "line", "left_semi").join(named, "line").select(F.col("template"), "doc").distinct()
    single = each.join(named, "line", "left_anti").select(F.col("line").alias("template"), "doc")
    counted = single.unionByName(merged).groupBy("template").agg(F.count("*").alias("docs"), F.min("doc").alias("first")).where(F.col("docs") >= min_docs).select("template", "first")
    again = stored(counted)
    by_template = named.join(again, "template").select("line", "first")
    alone = again.join(named.select(F.col("line").alias("template")), "template", "left_anti").select(F.col("template").alias("line"), "first")
    as_is = found.where("least is not null").select("doc", "line", "least").distinct().groupBy("line").agg(F.count("*").alias("docs"), F.min("doc").alias("first"), F.min("least").alias("least"))
    return stored(alone.unionByName(by_template).unionByName(as_is.where("docs >= least").select("line", "first"))), found


def _cut(part: pa.RecordBatch, at: int, gone) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The texts of column `at` without the lines that gone(text, line) marks; numbers of lines and of those dropped."""
    column = part.column(at)
    text, a, b, _, line, same, _, _, _, raw, offs = lines_of(column)
    drop = gone(text, line) | gone(text, same)
    n_lines = segment_sum(_NEWLINE[raw], offs) + np.asarray(column.is_valid())
    dropped = np.bincount(text[drop], minlength=part.num_rows)
    texts = column.to_pylist()
    for i in np.flatnonzero(dropped):
        x, y = np.searchsorted(text, i), np.searchsorted(text, i, side="right")  # text ascends
        cut = {int(at_) for at_ in a[x:y][drop[x:y]] - offs[i]}
        kept, place = [], 0
        for piece in raw[offs[i] : offs[i + 1]].tobytes().split(b"\n"):
            if place not in cut:
                kept.append(piece)
            place += len(piece) + 1
        texts[i] = b"\n".join(kept).decode("utf-8", "replace")
    return pa.array(texts, pa.string()), n_lines, dropped


def dropped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, broadcast_lines: int = BROADCAST_LINES, leaf_lines: int = LEAF_LINES) -> DataFrame:
    """The documents with recurring lines cut from text_col, and two more columns: the numbers of lines and of those dropped.

    They are named _n_lines and _n_dropped, with more underscores where docs has such columns.
    """
    again, found = recurring(docs, id_col, text_col, min_docs, broadcast_lines, leaf_lines)
    docs = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    names = list(docs.columns)
    own = [fresh(docs, c) for c in ("_n_lines", "_n_dropped")]
    schema = StructType([*docs.schema.fields, *[StructField(c, LongType()) for c in own]])
    who, at = names.index(id_col), names.index(text_col)

    def rebuilt(part: pa.RecordBatch, gone) -> pa.RecordBatch:
        texts, n_lines, n_dropped = _cut(part, at, gone)
        columns = list(part.columns)[: len(names)]
        columns[at] = texts
        return pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=[*names, *own])

    if again.count() <= broadcast_lines:
        rows = again.orderBy("line").toPandas()
        none = np.int64(np.iinfo(np.int64).min)
        shipped = docs.sparkSession.sparkContext.broadcast((rows["line"].to_numpy(np.int64), rows["first"].fillna(none).to_numpy(np.int64)))

        def run(batches):
            keys, firsts = shipped.value
            for batch in batches:
                for part in slices(batch, text_col, 2 << 20):
                    ids = part.column(who).cast(pa.int64()).fill_null(none).to_numpy()

                    def gone(text, line):
                        if not len(keys):
                            return np.zeros(len(line), dtype=bool)
                        place = np.minimum(np.searchsorted(keys, line), len(keys) - 1)
                        return (keys[place] == line) & (firsts[place] != ids[text])

                    yield rebuilt(part, gone)

        return docs.mapInArrow(run, schema)

    gone_rows = found.select("doc", "line").join(again, "line").where(~F.col("doc").eqNullSafe(F.col("first"))).groupBy("doc").agg(F.collect_set("line").alias("gone"))
    doc, marks = fresh(docs, "_doc"), fresh(docs, "_gone")
    joined = docs.join(gone_rows.select(F.col("doc").alias(doc), F.col("gone").alias(marks)), F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(f"`{doc}`")), "left").drop(doc)

    def run_joined(batches):
        for batch in batches:
            for part in slices(batch, text_col, 2 << 20):
                marked = part.column(part.num_columns - 1).to_pylist()

                def gone(text, line):
                    out = np.zeros(len(line), dtype=bool)
                    for i in np.unique(text):
                        if marked[i]:
                            own = text == i
                            out[own] = np.isin(line[own], np.array(marked[i], np.int64))
                    return out

                yield rebuilt(part, gone)

    return joined.mapInArrow(run_joined, schema)


def op7_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dropped(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), "text")
