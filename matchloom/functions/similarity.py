"""String similarities of pairs: InDel and Jaro-Winkler in Arrow batches, set measures natively.

Shared guard: an empty side gives 0, equal non-empty sides give 1.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, bit-parallel: one integer holds a whole row of the table."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def indel(a: str, b: str) -> float:
    """Normalised insertions and deletions: 2 LCS / (n + m)."""
    if not a or not b:
        return 0.0
    return 1.0 if a == b else 2.0 * lcs_length(a, b) / (len(a) + len(b))


def token_sort(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    return 1.0 if a == b else indel(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """Best InDel among the common words and the common words with either side's rest."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    x, y = set(a.split()), set(b.split())
    common, left, right = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if common and (not left or not right):
        return 1.0
    one, two = f"{common} {left}".strip(), f"{common} {right}".strip()
    return max([indel(one, two), *([indel(common, one), indel(common, two)] if common else [])])


def jaro_winkler(a: str, b: str) -> float:
    """Jaro, raised by a common prefix of up to 4 characters where it is above 0.7."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used = [False] * len(b)
    mine = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                mine.append(c)
                break
    m = len(mine)
    if not m:
        return 0.0
    swaps = sum(x != y for x, y in zip(mine, (b[j] for j in range(len(b)) if used[j]))) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)


def _pairwise(f):
    @F.pandas_udf(DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        known: dict = {}
        out = []
        for pair in zip(a, b):
            if pair not in known:
                known[pair] = f(pair[0] or "", pair[1] or "")
            out.append(known[pair])
        return pd.Series(out, dtype="float64")

    return run


indel_ratio, token_sort_ratio, token_set_ratio, jaro_winkler_sim = map(_pairwise, (indel, token_sort, token_set, jaro_winkler))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; an empty one gives 0."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def prefix_ratio(a: Column, b: Column, longest: int = 10) -> Column:
    """Common prefix of up to `longest` characters over the shorter whole length."""
    hits = F.filter(F.sequence(F.lit(1), F.lit(longest)), lambda i: (i <= F.least(F.length(a), F.length(b))) & (F.left(a, i) == F.left(b, i)))
    return F.when((a == "") | (b == ""), 0.0).otherwise(F.size(hits) / F.least(F.length(a), F.length(b)))
