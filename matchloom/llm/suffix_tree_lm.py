"""Language-model scoring by a probabilistic suffix tree over words.

Model. The root predicts with additive smoothing (`base`). A context of 1 to DEPTH words
seen at least MIN_CONTEXT times is a candidate; its explicit successors are those seen
MIN_NEXT times or more. It becomes a state if its next-word distribution diverges from
that of its longest shorter state: sum over successors of count * ln(ratio) is at least
DIVERGENCE nats an occurrence. A state predicts a successor with (count - DISCOUNT) /
occurrences, and gives the mass left to the distribution of its next shorter state, so
every distribution sums to 1. A word is predicted by the longest suffix of its history
that is a state.

Execution. Texts are packed once into blocks of about BLOCK_TOKENS tokens (local word
numbers and their 64-bit hashes) in the shared folder. Everything that concerns the whole
corpus - words, n-grams level by level, context sums - goes through one exchange: each
block sends every different key once with its local figures, in packed sorted runs cut
by ranges of the hash; each range is summed up in one small task and the sums go back to
the blocks that asked. Which n-grams a level needs follows from counts alone, so they are
asked for together with the contexts of the level before: DEPTH + 2 rounds. Blocks and
answers are tables bucketed by block, so an answer moves once, and a block takes up its
state again from them without a shuffle; of the first and largest level it keeps the
numbering, so that is not sorted again. Ranges cut by hash are even however frequent a
word is, since a key is one entry a block; their number grows with the corpus, and so does
the tree. No table of words or n-grams is broadcast or collected: the driver gets two totals.

Keys are told apart by 64 bits. Cases: a null or empty text is its end token alone; a
null id counts as the empty text for the split (so it is held out); repeated rows count
and are scored one by one; a text longer than a block is a block of its own; with no
training texts every probability is that of the root with N = V = 0; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents, removed, scratch, settings, stored, written_once
from .textvec import LOWER, U64, mix, segment_sum, slices, words

#: A context seen less often than MIN_NEXT has no explicit successor: MIN_CONTEXT cuts nothing that DIVERGENCE could keep.
DEPTH, MIN_CONTEXT, MIN_NEXT = 3, 3, 3
DISCOUNT, DIVERGENCE = 0.5, 0.05
#: Additive smoothing of the root.
ADDED = 0.1
BLOCK_TOKENS, RANGE_TOKENS, LEAST_RANGES = 1 << 19, 1 << 20, 12
#: Blocks in one Arrow batch; buckets of the blocks' tables at most.
ROWS, MOST_BUCKETS = 1, 20_000
#: One document in FOLDS is held out, by crc32 of its id.
FOLDS = 10

_END = U64(0x8A5CD789635D2DFF)
_CODEC = "zstd"


def _pack(a: np.ndarray) -> bytes:
    """Compressed by the numbers' bytes: all lowest ones, then all of the next place, and so on."""
    if not len(a):
        return b""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T)
    return len(a).to_bytes(8, "little") + a.dtype.str[1:].encode().ljust(4) + pa.compress(planes, codec=_CODEC, asbytes=True)


def _unpack(b: bytes, kind: str) -> np.ndarray:
    if not b:
        return np.zeros(0, kind)
    n, dtype = int.from_bytes(b[:8], "little"), np.dtype(b[8:12].decode().strip())
    planes = np.frombuffer(pa.decompress(memoryview(b)[12:], decompressed_size=n * dtype.itemsize, codec=_CODEC), np.uint8)
    return np.ascontiguousarray(planes.reshape(dtype.itemsize, n).T).view(dtype).ravel()


def _pack_keys(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=U64(0)))


def _unpack_keys(b: bytes) -> np.ndarray:
    return np.cumsum(_unpack(b, "u8"), dtype=U64)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, a place of each, and each place's index among them. (np.unique's stable sort takes three times as long.)"""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    inverse = np.empty(len(keys), dtype=np.int32)
    inverse[order] = np.cumsum(new, dtype=np.int32) - 1
    return ordered[new], order[new], inverse


_BLOCKS = "block long, ids array<long>, held array<boolean>, sizes binary, vocab binary, tokens binary, n_tokens long"


def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The texts as blocks: ids, held_out flags, tokens by text, the block's words (most frequent first) and their numbers."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), (F.crc32(key) % FOLDS == 0).alias("held"))

    def run(batches):
        place = TaskContext.get().partitionId() << 32
        held_back: list = []

        def packed():
            nonlocal place
            ids = [i for p in held_back for i in p[0]]
            flags = [f for p in held_back for f in p[1]]
            sizes, hashes = np.concatenate([p[2] for p in held_back]), np.concatenate([p[3] for p in held_back])
            vocab, _, inverse = _distinct(hashes)
            order = np.argsort(-np.bincount(inverse), kind="stable")
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            columns = [[place], [ids], [flags], [_pack(sizes)], [vocab[order].tobytes()], [_pack(rank[inverse])], [len(hashes)]]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
            place += 1
            held_back.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["block", "ids", "held", "sizes", "vocab", "tokens", "n_tokens"])

        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                hashes, offs, *_ = words(part.column(1), LOWER)
                sizes = np.diff(offs) + 1
                held_back.append((part.column(0).to_pylist(), part.column(2).to_pylist(), sizes, np.insert(hashes, offs[1:], _END)))
                if sum(len(p[3]) for p in held_back) >= block_tokens:
                    yield packed()
        if held_back:
            yield packed()

    return rows.mapInArrow(run, _BLOCKS)


class Block:
    """One block's tokens, and its figures as the answers to its questions come in.

    ask_...() gives the keys (sorted, unique) and the values of the next question;
    tell_...() takes the sums over all blocks. Questions: words; then n-grams level by
    level; and, when their counts are back, the contexts of that level, which go together
    with the n-grams of the next: those follow from counts alone. Only numbers of n-grams,
    their counts and the masses of contexts are kept: keys follow from the words,
    probabilities from all levels so far.
    """

    def __init__(self, sizes: np.ndarray, held: np.ndarray, vocab: np.ndarray, tokens: np.ndarray):
        self.sizes, self.held, self.vocab, self.tokens = sizes, held, vocab, tokens
        #: By level: what a token ends, as its number among the n-grams that can still matter (else -1); their counts; which of them this block answers for.
        self.grams: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.owned: list[np.ndarray] = []
        #: By level: what each n-gram as a context gives to its successors.
        self.mass: list[np.ndarray] = []

    def ask_words(self):
        counts, order = np.bincount(self.tokens[np.repeat(~self.held, self.sizes)], minlength=len(self.vocab)), np.argsort(self.vocab)
        return self.vocab[order], [counts[order].astype(np.float64)]

    def tell_words(self, sums: list[np.ndarray]) -> None:
        self.words = np.empty(len(self.vocab))
        self.words[np.argsort(self.vocab)] = sums[0]
        self._add(self.words, np.zeros(len(self.vocab), dtype=bool), self.tokens)

    def _add(self, counts: np.ndarray, owned: np.ndarray, inverse: np.ndarray, at: np.ndarray | None = None) -> None:
        """A new level: the counts of n-grams, and which of them each token (at: of those alone) ends."""
        kept = counts >= min(MIN_CONTEXT, MIN_NEXT)
        grams = np.where(kept, np.cumsum(kept, dtype=np.int32) - np.int32(1), np.int32(-1))[inverse]
        if at is not None:
            some, grams = grams, np.full(len(self.tokens), -1, np.int32)
            grams[at] = some
        self.level(grams, counts[kept], owned[kept])

    def level(self, grams: np.ndarray, counts: np.ndarray, owned: np.ndarray) -> None:
        self.grams.append(grams)
        self.counts.append(np.append(counts, 0.0))  # the last is that of number -1
        self.owned.append(owned)

    def _follow(self, k: int) -> np.ndarray:
        """The tokens that level k can change: those whose context, the n-gram that ended one token earlier in the text, is frequent."""
        follows = np.ones(len(self.tokens) + 1, dtype=bool)
        follows[np.cumsum(self.sizes)] = False
        return np.flatnonzero((self.counts[k] >= MIN_CONTEXT)[self.grams[k][:-1]] & follows[1:-1]).astype(np.int32) + np.int32(1)

    def _contexts(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The contexts of level k that occur here, as numbers of n-grams in the order of their keys, and a place of each."""
        at = self._follow(k) - np.int32(1)
        place = np.full(len(self.counts[k]) - 1, -1, np.int32)
        place[self.grams[k][at]] = at
        used = np.flatnonzero(place >= 0)
        if k == 0:  # words are numbered by frequency, longer n-grams by their keys
            used = used[np.argsort(self._keys(place[used], 0))]
        return used, place[used]

    def _explicit(self, k: int) -> np.ndarray:
        """The tokens of level k that can be explicit: a longer n-gram is no more frequent than its suffix."""
        at = self._follow(k)
        return at[(self.counts[k] >= MIN_NEXT)[self.grams[k][at]]]

    def _keys(self, at: np.ndarray, k: int) -> np.ndarray:
        """Keys of the n-grams of k + 1 words that end at these tokens."""
        keys = self.vocab[self.tokens[at - np.int32(k)]]
        for j in range(1, k + 1):
            keys = mix(keys * U64(0x9FB21C651E98DF25) + self.vocab[self.tokens[at - np.int32(k - j)]] + U64(j))
        return keys

    def ask_grams(self):
        """The next level's n-grams (context, token) with a frequent context, and their counts in training texts."""
        k = len(self.grams) - 1
        at = self._explicit(k)
        keys, _, inverse = _distinct(self._keys(at, k + 1))
        return keys, [np.bincount(inverse, weights=np.repeat(~self.held, self.sizes)[at], minlength=len(keys))]

    def tell_grams(self, sums: list[np.ndarray], owned: np.ndarray) -> None:
        k = len(self.grams) - 1
        at = self._explicit(k)
        self._add(sums[0], owned, _distinct(self._keys(at, k + 1))[2], at)

    def ask_contexts(self, totals):
        """Each context's explicit mass (occurrences, in units of DISCOUNT) and divergence, over the n-grams that this block answers for."""
        k = len(self.mass)
        numbers, place = self._contexts(k)
        keys = self._keys(place, k)
        rank = np.empty(len(self.counts[k]), np.int32)
        rank[numbers] = np.arange(len(numbers), dtype=np.int32)
        ends = np.flatnonzero(self.grams[k + 1] >= 0).astype(np.int32)
        at = np.empty(len(self.owned[k + 1]), np.int32)
        at[self.grams[k + 1][ends]] = ends  # a place of each n-gram
        mine = np.flatnonzero(self.owned[k + 1] & (self.counts[k + 1][:-1] >= MIN_NEXT))
        at, told = at[mine], self.counts[k + 1][mine]
        context = self.grams[k][at - 1]
        of, share = rank[context], told / self.counts[k][context]
        mass = np.bincount(of, weights=told / DISCOUNT - 1, minlength=len(keys))
        gain = np.bincount(of, weights=share * np.log(share / self._lower(at, totals)), minlength=len(keys))
        return keys, [mass, gain]

    def tell_contexts(self, sums: list[np.ndarray]) -> None:
        """sums[0]: what a state gives to its successors, by context; 0 where it is none."""
        k = len(self.mass)
        mass = np.zeros(len(self.counts[k]) - 1)
        mass[self._contexts(k)[0]] = sums[0]
        self.mass.append(mass)

    def ask(self, totals) -> list:
        """The next questions: on n-grams or words, and on contexts (None: no such question)."""
        if not self.grams:
            return [self.ask_words(), None]
        return [self.ask_grams() if len(self.grams) <= DEPTH else None, self.ask_contexts(totals) if len(self.grams) > 1 else None]

    def _root(self, totals) -> np.ndarray:
        n, v = totals
        return (self.words + ADDED) / (n + ADDED * (v + 1))

    def _step(self, k: int, at: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Probabilities by contexts of up to k + 1 words, from those by contexts of up to k."""
        context, ends = self.grams[k][at - 1], self.grams[k + 1][at]
        mass, occurrences = self.mass[k], self.counts[k][:-1]
        p = np.maximum(1 - DISCOUNT * mass / occurrences, 0.0)[context] * p
        some = np.flatnonzero((ends >= 0) & (mass > 0)[context])
        counts, context = self.counts[k + 1][ends[some]], context[some]
        p[some] += np.where(counts >= MIN_NEXT, (counts - DISCOUNT) / occurrences[context], 0.0)
        return p

    def _lower(self, at: np.ndarray, totals) -> np.ndarray:
        """Probabilities of tokens by the levels whose masses are known."""
        p = self._root(totals)[self.tokens[at]]
        for k in range(len(self.mass)):
            p = self._step(k, at, p)
        return p

    def scores(self, totals):
        offs, root = np.concatenate([[0], np.cumsum(self.sizes)]), self._root(totals)
        p = root[self.tokens]
        for k in range(DEPTH):
            at = self._follow(k)
            p[at] = self._step(k, at, p[at])
        return self.sizes, segment_sum((self.words > 0)[self.tokens], offs), segment_sum(np.log10(root)[self.tokens], offs), segment_sum(np.log10(p), offs)


def given(mass: np.ndarray, gain: np.ndarray) -> np.ndarray:
    """What each context gives to its successors: nothing, if its divergence makes it no state."""
    return np.where(gain >= DIVERGENCE, mass, 0.0)


def _edges(ranges: int) -> np.ndarray:
    return np.array([(r << 64) // ranges for r in range(1, ranges)], dtype=U64)


def _load(row: dict) -> Block:
    return Block(_unpack(row["sizes"], "i8"), np.array(row["held"], bool), np.frombuffer(row["vocab"], U64), _unpack(row["tokens"], "i4"))


def _parts(answers: list[dict], ranges: int, contexts: bool) -> tuple[list[np.ndarray], np.ndarray] | None:
    """The sums that a block asked for and what it owns, in the order of its keys. None: it asked nothing of the kind."""
    parts = sorted((a for a in answers if (a["range"] >= ranges) == contexts), key=lambda a: a["range"])
    if not parts:
        return None
    sums = [np.concatenate([_unpack(a["sums"][i], "f8").astype(np.float64) for a in parts]) for i in range(len(parts[0]["sums"]))]
    return sums, np.concatenate([_unpack(a["owned"], "b1") for a in parts])


def _resumed(row: dict, ranges: int) -> Block:
    """The block after all answers so far: a0 on words, first (what the answers on the first n-grams make, or a1 they themselves), a2 and so on."""
    block = _load(row)
    if "a0" in row:
        block.tell_words(_parts(row["a0"], ranges, False)[0])
    if "first" in row:
        grams, counts, owned = row["first"]
        block.level(_unpack(grams, "i4"), _unpack(counts, "f8").astype(np.float64), _unpack(owned, "b1"))
    for r in range(1, DEPTH + 2):
        if f"a{r}" in row:
            if grams := _parts(row[f"a{r}"], ranges, False):
                block.tell_grams(*grams)
            if contexts := _parts(row[f"a{r}"], ranges, True):
                block.tell_contexts(contexts[0])
    return block


_ASKED = "range int, block long, keys binary, sums array<binary>"
_ANSWERED = "block long, range int, sums array<binary>, owned binary, n double, v double"


def _asked(packed: DataFrame, totals, ranges: int) -> DataFrame:
    """(range, block, keys, values) of the blocks' next questions; those on contexts have ranges of their own. An empty question still asks its first range, once."""
    edges = _edges(ranges)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                for i, question in enumerate(_resumed(row, ranges).ask(totals)):
                    if question is None:
                        continue
                    keys, values = question
                    cuts = [0, *np.searchsorted(keys, edges, side="left"), len(keys)]
                    own = [r for r in range(ranges) if cuts[r + 1] > cuts[r]] or [0]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([i * ranges + r for r in own], pa.int32()), pa.array([row["block"]] * len(own), pa.int64()), pa.array([_pack_keys(keys[cuts[r] : cuts[r + 1]]) for r in own], pa.binary()),
                            pa.array([[_pack(_small(v[cuts[r] : cuts[r + 1]])) for v in values] for r in own], pa.list_(pa.binary())),
                        ],
                        names=["range", "block", "keys", "sums"],
                    )

    return packed.mapInArrow(run, _ASKED)


def _small(v: np.ndarray) -> np.ndarray:
    """Whole figures as integers: they pack better."""
    whole = v.astype(np.uint32)
    return whole if len(v) and (whole == v).all() else v


def _summed(asked: DataFrame, r: int, ranges: int) -> DataFrame:
    """Each range's sums by key, sent back to the blocks that asked; owned: whether this block answers for the n-gram."""

    def add(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("block").to_numpy(), kind="stable")
        names = table.column("block").to_numpy()[order]
        keys = [_unpack_keys(table.column("keys")[int(i)].as_py()) for i in order]
        values = [[_unpack(x, "f8").astype(np.float64) for x in table.column("sums")[int(i)].as_py()] for i in order]
        every = np.concatenate(keys)
        _, one, inverse = _distinct(every)
        sums = [np.bincount(inverse, weights=np.concatenate([v[k] for v in values]), minlength=len(one)) for k in range(len(values[0]))]
        contexts = table.column("range")[0].as_py() >= ranges
        owned = np.zeros(len(every) if r and not contexts else 0, dtype=bool)
        if contexts:  # only the masses of states go back
            sums = [given(*sums)]
        elif r:  # n-grams: one block, whichever, answers for each in its context's sums
            owned[one] = True
        cuts = np.cumsum([0, *map(len, keys)])
        out = {"block": [], "sums": [], "owned": []}
        for i, name in enumerate(names):
            part = inverse[cuts[i] : cuts[i + 1]]
            out["block"].append(int(name))
            out["sums"].append([_pack(_small(s[part])) for s in sums])
            out["owned"].append(_pack(owned[cuts[i] : cuts[i + 1]]))
        n = len(names)
        once = [1.0] + [0.0] * (n - 1)  # totals of the range, on its first row
        return pa.table(
            {
                "block": pa.array(out["block"], pa.int64()), "range": table.column("range").take(pa.array(order)).cast(pa.int32()),
                "sums": pa.array(out["sums"], pa.list_(pa.binary())), "owned": pa.array(out["owned"], pa.binary()),
                "n": pa.array([x * float(sums[0].sum()) for x in once]), "v": pa.array([x * float((sums[0] > 0).sum()) for x in once]),
            }
        )

    return asked.groupBy("range").applyInArrow(add, _ANSWERED)


def _first(answered: DataFrame, ranges: int) -> DataFrame:
    """The level of the first n-grams as the blocks keep it, from the answers (column a1): it is the largest, and isn't sorted again."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = _resumed(row, ranges)
                level = [_pack(block.grams[1]), _pack(_small(block.counts[1][:-1])), _pack(block.owned[1])]
                yield pa.RecordBatch.from_arrays([pa.array([row["block"]], pa.int64()), pa.array([level], pa.list_(pa.binary()))], names=["block", "first"])

    return answered.mapInArrow(run, "block long, first array<binary>")


def _by_block(rows: DataFrame, buckets: int, path: str) -> DataFrame:
    """The rows as a table at a path of the shared folder that is bucketed by block: joins of such tables move nothing. (What is large in them is packed already.)"""
    name = f"matchloom_{uuid.uuid4().hex}"
    with written_once(rows.sparkSession):
        rows.write.option("path", path).option("compression", "none").bucketBy(buckets, "block").saveAsTable(name)
    return rows.sparkSession.table(name)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS, range_tokens: int = RANGE_TOKENS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    first = scratch(spark)
    blocks(docs, id_col, text_col, block_tokens).write.option("compression", "none").parquet(first)
    packed = spark.read.schema(_BLOCKS).parquet(first)
    size = packed.agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("blocks")).first()
    ranges, buckets = max(LEAST_RANGES, math.ceil((size["tokens"] or 0) / range_tokens)), max(1, min(size["blocks"], MOST_BUCKETS))

    def answered(rows: DataFrame, r: int) -> DataFrame:
        """By block, the answers to the next questions of these blocks."""
        answers = _summed(_asked(rows, totals, ranges), r, ranges).repartition(buckets, "block")
        return answers.groupBy("block").agg(F.collect_list(F.struct("range", "sums", "owned")).alias(f"a{r}"), *([] if r else [F.sum("n").alias("n"), F.sum("v").alias("v")]))

    # Rows are blocks of some MB here: an Arrow batch takes ROWS of them, however many a task has.
    with settings(spark, spark_sql_execution_arrow_maxRecordsPerBatch=str(ROWS)):
        paths, totals = [scratch(spark) for _ in range(DEPTH + 2)], (0.0, 0.0)
        known = _by_block(packed.repartition(buckets, "block"), buckets, paths[0])
        removed(spark, first)
        for r in range(DEPTH + 1):
            new = answered(known, r)
            new = _by_block(_first(known.join(new.hint("merge"), "block"), ranges) if r == 1 else new, buckets, paths[r + 1])
            if r == 0:
                totals = tuple(x or 0.0 for x in new.agg(F.sum("n"), F.sum("v")).first())
                new = new.drop("n", "v")
            known = known.join(new.hint("merge"), "block")
        told = known.join(answered(known, DEPTH + 1).hint("merge"), "block")
        n_train = int(totals[0])

        def run(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    sizes, n_known, base, total = _resumed(row, ranges).scores(totals)
                    arrays = [pa.array(row["ids"], pa.int64()), pa.array(row["held"], pa.bool_()), pa.array(sizes, pa.int64()), pa.array(n_known, pa.int64()), pa.array([n_train] * len(sizes), pa.int64()), pa.array(base), pa.array(total)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        out = stored(told.mapInArrow(run, "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
        for path in paths:
            removed(spark, path)
    return out.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)


def op3_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))
