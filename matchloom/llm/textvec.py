"""Vectorised text primitives on Arrow buffers: words, lines and their hashes.

All functions work on the UTF-8 bytes of a whole Arrow string column at once, so a
document costs no Python-level loop. Hashes are 64-bit: a span's bytes are taken by
eights, each is mixed together with its place in the span, and the sum is mixed with the
length. (A polynomial modulo 2**64 would not do: Thue-Morse words meet under every base.)
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_STEP, _PLACE = U64(0x9E3779B97F4A7C15), U64(0x2127599BF4325C37)
#: Masks that keep the first k of eight bytes.
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=U64)
#: Eights of long spans hashed at a time; bounds the temporary arrays (about 80 bytes each).
SEGMENT = 1 << 18

#: The bytes that end a word (space and \t \n \v \f \r).
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that are in no alphanumeric word, after lower-casing A-Z.
NON_ALNUM = np.zeros(256, dtype=bool)
NON_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
SAME = np.arange(256, dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3: a bijection that spreads every bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(33)
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def buffer_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and its len + 1 offsets into them; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = 4 << 20):
    """The batch in parts of about `limit` bytes of text; a longer text stands alone."""
    sizes = np.cumsum(np.diff(buffer_of(batch.column(batch.schema.get_field_index(text)))[1]))
    at = 0
    while at < batch.num_rows:
        base = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, base + limit, side="right")))
        yield batch.slice(at, end - at)
        at = end


def spans(raw: np.ndarray, offs: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes outside `stop`, broken at texts' ends."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~stop[raw]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    edges = offs[:-1][offs[:-1] < len(raw)]
    starts[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = offs[1:] - 1
    last = last[last >= 0]
    ends[last] = inside[last]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = SAME) -> np.ndarray:
    """A 64-bit hash of the bytes of each span after folding: every eight bytes are mixed with their place before they are summed."""
    sizes = ends - starts
    folded = np.zeros(len(raw) + 8, dtype=np.uint8)
    np.take(fold, raw, out=folded[: len(raw)])
    eights = np.ndarray((len(raw) + 1,), dtype="<u8", buffer=folded.data, strides=(1,))
    out = mix((eights[starts] & _KEEP[np.minimum(sizes, 8)]) ^ _PLACE) if len(starts) else np.zeros(0, U64)
    long = np.flatnonzero(sizes > 8)
    upto = np.cumsum((sizes[long] - 1) // 8)  # further eights of the long spans
    for at in range(0, int(upto[-1]) if len(long) else 0, SEGMENT):
        index = np.arange(at, min(at + SEGMENT, int(upto[-1])))
        who = np.searchsorted(upto, index, side="right")
        whose = long[who]
        inner = index - np.concatenate([[0], upto])[who] + 1
        value = eights[starts[whose] + 8 * inner] & _KEEP[np.minimum(sizes[whose] - 8 * inner, 8)]
        np.add.at(out, whose, mix(value ^ mix(inner.astype(U64) * _STEP + _PLACE)))
    return mix(out + sizes.astype(U64) * U64(0xD6E8FEB86659FD93))


def words(column: pa.Array, fold: np.ndarray = SAME, stop: np.ndarray = SPACE):
    """(hashes, word offsets by text, starts, ends, raw bytes, text offsets) of the column's words."""
    raw, offs = buffer_of(column)
    starts, ends = spans(raw, offs, stop)
    return hash_spans(raw, starts, ends, fold), np.searchsorted(starts, offs), starts, ends, raw, offs


def owner(offs: np.ndarray) -> np.ndarray:
    """The index of the text of each item, from the offsets of the texts' items."""
    return np.repeat(np.arange(len(offs) - 1), np.diff(offs))


def windows(hashes: np.ndarray, offs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words inside a text, and the offsets of each text's runs."""
    counts = np.maximum(np.diff(offs) - (n - 1), 0)
    out = np.concatenate([[0], np.cumsum(counts)])
    if not out[-1]:
        return np.zeros(0, U64), out
    first = np.arange(out[-1]) + np.repeat(offs[:-1] - out[:-1], counts)
    acc = hashes[first]
    for k in range(1, n):
        acc = acc * U64(0x9FB21C651E98DF25) + hashes[first + k]
    return mix(acc), out


def segment_sum(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sums of the values between neighbouring offsets."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[offs[1:]] - sums[offs[:-1]]
