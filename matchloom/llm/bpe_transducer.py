"""BPE encoding by a bounded-lookahead streaming transducer, and incremental decoding.

Lookahead. Run the merges on a word's prefix w and on the whole word. At any rank both
runs agree left of some frontier, which starts at the end of w and moves left only when
a merge u+v crosses it in one run alone - by len(u), with u the common token left of it.
The next crossing merge u'+v' has a higher rank, and v' starts where u stood, so u is a
prefix of v'. The longest such chain of merges, found in one pass over the merge list,
bounds how far the frontier ever moves: tokens that end at least that far before the end
of the buffer are final whatever follows. A merge list is assumed proper (a merge's parts
are made by earlier merges), as every trained list is.

The encoder keeps a buffer of a few lookaheads, emits what is final and forgets it; ids
come out in portions, and words are taken from the text one after another. Words that fit
in the buffer go through a bounded cache. The decoder is a state machine that takes ids in
any portions and keeps at most an unfinished UTF-8 character. So beyond the text itself
(and, for vocabularies that normalise, its normalised copy) `fingerprints` needs constant
memory; `transcode` holds a row's ids and decoded text, since it returns them.

Cases: a null text counts as empty and gives no ids and an empty text; the strings of
special tokens in a text become their ids, as the public library does by default; very
long words stream; repeated rows are encoded one by one; an empty table gives an empty
result; extra columns of the input are not returned.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents
from .textvec import slices

#: Entries of one generation of the word cache (two are kept), and the longest word in it.
CACHE_WORDS, CACHE_LENGTH = 300_000, 64
#: Symbols from which merges are taken from a heap; ids in one portion.
HEAP_SYMBOLS, PORTION = 48, 1 << 16
_END = ""
#: The split pattern that the byte-level pre-tokenizer uses when it has none of its own (a fixed value).
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def sufficient_lookahead(merges: Iterable[tuple[str, str]]) -> int:
    """Symbols before the end of a prefix within which its tokens may still change."""
    reach: dict[str, int] = {}
    longest = 0
    for left, right in merges:
        before = max((reach.get(right[:k], 0) for k in range(1, len(right) + 1)), default=0)
        mine = len(left) + before
        longest = max(longest, mine)
        if mine > reach.get(left, 0):
            reach[left] = mine
    return longest


class _Words(dict):
    """word -> packed ids, two generations of bounded size."""

    def __init__(self, encode, limit: int):
        super().__init__()
        self.encode, self.limit, self.old = encode, limit, {}

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            found = self.encode(word)
        if len(word) <= CACHE_LENGTH:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[word] = found
        return found


class Vocabulary:
    """A BPE vocabulary in the public JSON form of the tokenizers library."""

    def __init__(self, blob: str | bytes):
        spec = json.loads(blob)
        model = spec["model"]
        if model["type"] != "BPE":
            raise ValueError("not a BPE vocabulary")
        self.suffix = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        short = (lambda s: s.removesuffix(self.suffix) + _END if s.endswith(self.suffix) else s) if self.suffix else (lambda s: s)
        self.ids = {short(t): i for t, i in model["vocab"].items()}
        self.ranks = {(short(a), short(b)): r for r, (a, b) in enumerate(pairs)}
        self.lookahead = sufficient_lookahead(list(self.ranks))
        self.window = 2 * self.lookahead + 64
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = 1 + max([*self.ids.values(), *self.special.values()])
        self.pieces = [""] * size
        for t, i in model["vocab"].items():
            self.pieces[i] = t
        for t, i in self.special.items():
            self.pieces[i] = t
        self.splits_special = re.compile("(" + "|".join(sorted(map(re.escape, self.special), key=len, reverse=True)) + ")") if self.special else None

        steps = self._flat(spec.get("normalizer"), "normalizers")
        known = {"NFC", "Lowercase", "Replace"}
        if any(s["type"] not in known for s in steps):
            raise ValueError("unknown normalizer")
        self.nfc, self.lower = any(s["type"] == "NFC" for s in steps), any(s["type"] == "Lowercase" for s in steps)
        self.replace = [(regex.compile(s["pattern"]["Regex"]), s["content"]) for s in steps if s["type"] == "Replace"]
        steps = self._flat(spec.get("pre_tokenizer"), "pretokenizers")
        own = [s["pattern"]["Regex"] for s in steps if s["type"] == "Split"]
        byte_level = next(s for s in steps if s["type"] == "ByteLevel")
        if byte_level.get("add_prefix_space"):
            raise ValueError("prefix spaces are not supported")
        self.pattern = regex.compile(own[0] if own else BYTE_LEVEL_PATTERN)
        self.spaced = spec.get("decoder") is None
        symbols = byte_symbols()
        self.table = {b: symbols[b] for b in range(256)}
        self.back = {ord(s): b for b, s in enumerate(symbols)}
        self.bytes_of = [None if i in set(self.special.values()) else t.translate(self.back).encode("latin-1") if not self.suffix else b"" for i, t in enumerate(self.pieces)]
        self.words = _Words(self._word, CACHE_WORDS)

    @staticmethod
    def _flat(step: dict | None, key: str) -> list[dict]:
        return [] if step is None else step[key] if step["type"] == "Sequence" else [step]

    def merged(self, symbols: list[str]) -> list[str]:
        """All merges on these symbols, in the order of their ranks, left to right."""
        if len(symbols) >= HEAP_SYMBOLS:
            return self._merged_by_heap(symbols)
        rank, none = self.ranks.get, len(self.ranks)
        out = list(symbols)
        levels = [rank(p, none) for p in zip(out, out[1:])]
        while levels:
            best = min(levels)
            if best == none:
                break
            i = levels.index(best)
            out[i : i + 2] = [out[i] + out[i + 1]]
            del levels[i]
            if i:
                levels[i - 1] = rank((out[i - 1], out[i]), none)
            if i < len(levels):
                levels[i] = rank((out[i], out[i + 1]), none)
        return out

    def _merged_by_heap(self, symbols: list[str]) -> list[str]:
        """The same in O(n log n): a linked list of the symbols, and a heap of (rank, place) of neighbours."""
        rank, n = self.ranks.get, len(symbols)
        out, after, before = list(symbols), [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i) for i, p in enumerate(zip(out, out[1:])) if (r := rank(p)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if j < 0 or out[i] is None or rank((out[i], out[j])) != r:
                continue  # one of the two was merged since
            out[i], out[j] = out[i] + out[j], None
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (new := rank((out[i], out[k]))) is not None:
                    heapq.heappush(heap, (new, i))
            k = before[i]
            if k >= 0 and (new := rank((out[k], out[i]))) is not None:
                heapq.heappush(heap, (new, k))
        return [x for x in out if x is not None]

    def stream(self, symbols: Iterable[str]) -> Iterator[str]:
        """The tokens of one word's symbols, each as soon as it is final; memory is a window."""
        buffer: list[str] = []
        for s in symbols:
            buffer.append(s)
            if len(buffer) >= self.window:
                end, stable = 0, len(buffer) - self.lookahead
                for token in self.merged(buffer):
                    if end + self._width(token) > stable:
                        break
                    end += self._width(token)
                    yield token
                buffer = buffer[end:]
        yield from self.merged(buffer)

    @staticmethod
    def _width(token: str) -> int:
        return len(token) - token.endswith(_END)

    def _symbols(self, word: str) -> Iterator[str]:
        for at in range(0, len(word), PORTION):
            part = [self.table[b] for b in word[at : at + PORTION].encode("utf-8", "replace")]
            if self.suffix and at + PORTION >= len(word):
                part[-1] += _END
            yield from part

    def _word(self, word: str) -> bytes:
        if len(word) >= self.window:
            return np.array([self.ids[t] for t in self.stream(self._symbols(word))], dtype="<u4").tobytes()
        symbols = [*map(self.table.__getitem__, word.encode("utf-8", "replace"))]
        if self.suffix:
            symbols[-1] += _END
        tokens = self.merged(symbols)
        return struct.pack(f"<{len(tokens)}I", *map(self.ids.__getitem__, tokens))

    def _runs(self, part: str) -> Iterator[list[str]]:
        """The part's words in lists; of a long part, a list at a time."""
        if len(part) <= PORTION:
            yield self.pattern.findall(part)
            return
        found = self.pattern.finditer(part)
        while some := [m.group() for m in islice(found, PORTION >> 3)]:
            yield some

    def _parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text's parts, and whether each is the string of a special token."""
        at = 0
        for m in self.splits_special.finditer(text) if self.splits_special else ():
            yield text[at : m.start()], False
            yield m.group(), True
            at = m.end()
        yield text[at:] if at else text, False

    def portions(self, text: str) -> Iterator[bytes]:
        """The text's ids as little-endian unsigned 32-bit integers, in portions of about PORTION ids at most."""
        out, size = [], 0
        for part, special in self._parts(text):
            if special:
                out.append(np.array([self.special[part]], dtype="<u4").tobytes())
                continue
            if self.nfc and not part.isascii():
                part = unicodedata.normalize("NFC", part)
            if self.lower:
                for pattern, content in self.replace:
                    if not (content == " " and pattern.pattern == r"\s+"):  # the split drops white space anyway
                        part = pattern.sub(content, part)
                part = part.replace("Σ", "σ").lower()  # by character, without the final sigma
            for words in self._runs(part):
                if len(part) <= PORTION or max(map(len, words)) <= PORTION:
                    packed = b"".join(map(self.words.__getitem__, words))
                    out.append(packed)
                    size += len(packed)
                else:
                    for word in words:
                        tokens = self.stream(self._symbols(word))
                        while some := [self.ids[t] for t in islice(tokens, PORTION)]:
                            yield b"".join(out)
                            out, size = [np.array(some, dtype="<u4").tobytes()], 4 * len(some)
                if size >= 4 * PORTION:
                    yield b"".join(out)
                    out, size = [], 0
        yield b"".join(out)

    def encode(self, text: str) -> bytes:
        """All ids of the text."""
        return b"".join(self.portions(text))


class Decoder:
    """ids in portions -> text in portions. State: whether a piece was seen, and unfinished bytes."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.begun = vocabulary, False
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: np.ndarray) -> str:
        pieces = self.v.pieces
        if self.v.spaced:
            text = " ".join(map(pieces.__getitem__, ids.tolist()))
            text = " " + text if self.begun and len(ids) else text
            self.begun |= bool(len(ids))
            return text
        out = []
        for i in ids.tolist():
            raw = self.v.bytes_of[i]
            out.append(self.utf8.decode(b"", True) + pieces[i] if raw is None else self.utf8.decode(raw))
        return "".join(out)

    def finish(self) -> str:
        return self.utf8.decode(b"", True)


def decode(vocabulary: Vocabulary, ids: bytes, portion: int = 65536) -> str:
    machine, whole = Decoder(vocabulary), np.frombuffer(ids, dtype="<u4")
    return "".join([machine.feed(whole[k : k + portion]) for k in range(0, len(whole), portion)] + [machine.finish()])


@lru_cache(maxsize=2)
def _parsed(blob: bytes) -> Vocabulary:
    return Vocabulary(blob)


def _shipped(spark: SparkSession, path: str):
    """The vocabulary file, read by the driver; its size is fixed by the file (about 2 MB)."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def transcode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): each whole text's ids (binary, little-endian uint32) and their decoded text.

    One scan without a shuffle; a row's text, ids and decoded text are held at a time.
    """
    shipped = _shipped(docs.sparkSession, path)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        v = _parsed(shipped.value)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                ids = [v.encode(t or "") for t in part.column(1).to_pylist()]
                texts = [decode(v, i) for i in ids]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array(texts, pa.string())], names=[id_col, "ids", "decoded"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"{id_col} {kind}, ids binary, decoded string")


def fingerprints(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the digests of what transcode returns, from streams of ids."""
    shipped = _shipped(docs.sparkSession, path)
    kind = docs.schema[id_col].dataType.simpleString()

    def one(v: Vocabulary, text: str):
        machine, n, ids, decoded = Decoder(v), 0, hashlib.sha256(), hashlib.sha256()
        for portion in v.portions(text):
            ids.update(portion)
            decoded.update(machine.feed(np.frombuffer(portion, dtype="<u4")).encode("utf-8", "replace"))
            n += len(portion) // 4
        decoded.update(machine.finish().encode("utf-8", "replace"))
        return n, ids.hexdigest(), decoded.hexdigest()

    def run(batches):
        v = _parsed(shipped.value)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                n, ids, texts = zip(*[one(v, t or "") for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"{id_col} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_bpe_transducer(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return fingerprints(documents(spark, sf_dir), vocabulary)
