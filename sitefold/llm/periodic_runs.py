"""Periodic runs of words through the longest-previous-factor array.

A run is a stretch of consecutive words with smallest period q and at least max(LEAST, TIMES * q) words that no
neighbouring word extends keeping that period. A text's runs come from its suffix array and LCP array: these
give the longest-previous-factor array, and that the LZ blocks (overlapping sources allowed). A run that touches
or crosses a block's start has one of its periods beside that start, so it is found by extending from there to
both sides (Main); one that lies strictly inside a block is a copy of a run inside the block's source, which
ends earlier, so it is copied from there in order of starts, kept in buckets (Kolpakov and Kucherov).

A run of at least max(24, 3q) words repeats 16 of its words in a row, q words on, and every word of it lies in
such a repeated stretch. So a text is first reduced to its stretches of words that lie in repeated windows, which
hashes find and never miss; hash collisions only add stretches. Texts without one have no run, and a run and the
words that would extend it lie in one stretch. The exact work runs on word numbers, stretch by stretch.

Null text counts as empty; an empty text has no words, no runs, and the digests of the empty string. An empty
table has no rows. Rows are treated one by one, so ties and repeats do not matter; a null id is an ordinary one.
A text is read whole, in time n log n; a stretch of n words needs about 8 n log2(n) bytes while it is
searched. Other input columns are not read, so none clashes.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sitefold.llm.common import documents

#: A run's least words, and least number of its periods.
LEAST, TIMES = 24, 3
#: Words of a window that must repeat: the least of max(LEAST - q, (TIMES - 1) * q) over all q is 16.
WINDOW = 16
#: Words of the texts that are searched for repeated windows at once; a longer text is searched alone.
TOGETHER = 1 << 19

_U = np.uint64
Run = tuple[int, int, int]


# --- suffix order -----------------------------------------------------------------------------------------------


def rank_levels(x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Ranks of the substrings of 1, 2, 4, ... words, as long as two of them are equal, and the suffix array.

    Each level has one more entry, -1, for the end of the text. A substring that the end cuts short differs
    from all others.
    """
    n = len(x)
    _, r = np.unique(x, return_inverse=True)
    levels, step = [], 1
    while True:
        r = np.append(r, -1).astype(np.int64)
        if r.max() == n - 1:
            sa = np.empty(n, np.int64)
            sa[r[:n]] = np.arange(n)
            return levels, sa
        levels.append(r.astype(np.int32))
        ahead = np.full(n, -1, np.int64)
        ahead[: max(0, n - step)] = r[step:n]
        key = r[:n] * (n + 1) + ahead + 1
        order = np.argsort(key)
        new = np.ones(n, bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        r = np.empty(n, np.int64)
        r[order] = np.cumsum(new) - 1
        step *= 2


def common(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Words that the suffixes at i and j (different, up to n) have in common at their start."""
    out = np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][i + out] == levels[k][j + out]
        out += same.astype(np.int64) << k
    return out


def longest_previous(sa: np.ndarray, lcp: np.ndarray) -> tuple[list[int], list[int]]:
    """For each place the longest factor that also starts earlier, and where; 0 and -1 without one.

    lcp[k] belongs to sa[k - 1] and sa[k].
    """
    n = len(sa)
    length, source = [0] * n, [-1] * n
    stack = [(-1, 0)]
    for at, near in zip([*sa.tolist(), -1], [*lcp.tolist(), 0]):
        while at < stack[-1][0]:
            place, below = stack.pop()
            if below >= near:
                length[place], source[place] = below, stack[-1][0] if below else -1
            else:
                length[place], source[place] = near, at
            near = min(near, below)
        stack.append((at, near))
    return length, source


def blocks(length: list[int]) -> list[int]:
    """Starts of the LZ blocks, and the text's end."""
    at, out = 0, [0]
    while at < len(length):
        at += max(1, length[at])
        out.append(at)
    return out


# --- runs -------------------------------------------------------------------------------------------------------

#: Pairs of places compared at once.
PAIRS = 1 << 20


def _around(starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(block start, period) for each start and every period that a run ending in its block can have.

    With the former block of a words and this one of b, such a run has fewer than a + q words before the start, so
    TIMES * q < a + b + q.
    """
    sizes = np.diff(starts)
    most = (np.append(0, sizes) + np.append(sizes, 0)) // (TIMES - 1) + 1
    ends = np.cumsum(most)
    for low in range(0, int(ends[-1]), PAIRS):
        k = np.arange(low, min(low + PAIRS, int(ends[-1])))
        owner = np.searchsorted(ends, k, "right")
        yield starts[owner], k - (ends[owner] - most[owner]) + 1


def stretch_runs(x: np.ndarray) -> set[Run]:
    """All runs (start, end, period) of a sequence of word numbers."""
    n = len(x)
    if n < LEAST:
        return set()
    levels, sa = rank_levels(x)
    back, _ = rank_levels(x[::-1])
    lcp = np.append(0, common(levels, sa[:-1], sa[1:]))
    length, source = longest_previous(sa, lcp)
    cuts = blocks(length)

    period: dict[tuple[int, int], int] = {}

    def extend(i: np.ndarray, j: np.ndarray) -> None:
        """Stretches that keep the period j - i around places i < j."""
        ahead = common(levels, i, j)
        behind = common(back, n - i, n - j)  # of what ends before i and before j
        q = j - i
        long = q + ahead + behind >= np.maximum(LEAST, TIMES * q)
        for run in zip((i - behind)[long].tolist(), (j + ahead)[long].tolist(), q[long].tolist()):
            period[run[:2]] = min(run[2], period.get(run[:2], run[2]))

    for at, q in _around(np.array(cuts)):
        right = at + q <= n
        extend(at[right], (at + q)[right])
        left = at - q >= 0
        extend((at - q)[left], at[left])

    # Copies, in order of starts; what is copied can lie in the source of the same block again.
    buckets: dict[int, set[tuple[int, int]]] = {}
    starts: list[int] = []

    def add(start: int, end: int, q: int) -> None:
        if start not in buckets:
            buckets[start] = set()
            insort(starts, start)
        buckets[start].add((end, q))

    for (start, end), q in sorted(period.items()):
        add(start, end, q)
    for at, stop in zip(cuts, cuts[1:]):
        if stop - at <= LEAST:
            continue
        by = at - source[at]
        k = bisect_right(starts, source[at])
        while k < len(starts) and starts[k] < stop - by:
            for end, q in [*buckets[starts[k]]]:
                if end + by < stop:
                    add(starts[k] + by, end + by, q)
            k += 1
    return {(start, end, q) for start in starts for end, q in buckets[start]}


def repeated_windows(h: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Whether each word lies in a window of WINDOW words that occurs twice in its text, given the words' hashes."""
    n = len(h)
    covered = np.zeros(n, bool)
    if n < WINDOW:
        return covered
    g, step = h, 1
    while step < WINDOW:
        m = len(g) - step
        g = (g[:m] * _U(0x9E3779B97F4A7C15) ^ (g[step:] >> _U(29))) * _U(0xBF58476D1CE4E5B9) + g[step:]
        step *= 2
    inside = np.flatnonzero(owner[: len(g)] == owner[WINDOW - 1 :])
    g = (g[inside] ^ (g[inside] >> _U(32))) * _U(0x94D049BB133111EB) + owner[inside].astype(_U) * _U(0xD6E8FEB86659FD93)
    order = np.argsort(g)
    same = g[order[1:]] == g[order[:-1]]
    if same.any():
        twice = np.zeros(len(g), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        edge = np.zeros(n + 1, np.int64)
        at = inside[twice]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + WINDOW, -1)
        covered = np.cumsum(edge)[:n] > 0
    return covered


def runs(words: list[bytes], covered: np.ndarray | None = None) -> list[Run]:
    """All runs (start, end, period) of a text's words, by start, then period."""
    if covered is None:
        covered = repeated_windows(_hashes(words), np.zeros(len(words), np.int64))
    edges = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])).astype(np.int8)))
    out = []
    for low, high in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if high - low >= LEAST:
            number: dict[bytes, int] = {}
            x = np.fromiter((number.setdefault(w, len(number)) for w in words[low:high]), np.int64, high - low)
            out += [(low + s, low + e, q) for s, e, q in stretch_runs(x)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(hash, words), np.int64, len(words)).view(_U)


def kept(n: int, found: list[Run]) -> np.ndarray:
    """Whether each of n words stays: no run holds it behind the run's first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, end, q in found:
        edge[start + q] += 1
        edge[end] -= 1
    return np.cumsum(edge)[:n] == 0


# --- tables -----------------------------------------------------------------------------------------------------

RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _together(texts: list[list[bytes]]) -> Iterator[tuple[list[bytes], list[Run]]]:
    """Each text with its runs; the first search goes over many texts at once."""
    low = 0
    while low < len(texts):
        high, n = low, 0
        while high < len(texts) and (high == low or n + len(texts[high]) <= TOGETHER):
            n += len(texts[high])
            high += 1
        part = texts[low:high]
        sizes = [len(w) for w in part]
        h = np.concatenate([_hashes(w) for w in part])
        covered = repeated_windows(h, np.repeat(np.arange(len(part)), sizes))
        ends = np.cumsum([0, *sizes])
        for k, words in enumerate(part):
            here = covered[ends[k] : ends[k + 1]]
            yield words, runs(words, here) if here.any() else []
        low = high


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", change=None) -> DataFrame:
    """key, n_words, runs (start, length, period) by start, then period, and the text collapsed to its kept words.

    change(key, words) may put other words in the place of a text's words first. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [_words(t) for t in b.column(1).to_pylist()]
            if change is not None:
                texts = [change(k, w) for k, w in zip(b.column(0).to_pylist(), texts)]
            found, left = [], []
            for words, rs in _together(texts):
                found.append([{"start": s, "length": e - s, "period": q} for s, e, q in rs])
                stay = words if not rs else [w for w, yes in zip(words, kept(len(words), rs).tolist()) if yes]
                left.append(b" ".join(stay).decode())
            cols = [b.column(0), pa.array(map(len, texts), pa.int64()), pa.array(found, RUNS), pa.array(left, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=[key, "n_words", "runs", "collapsed"])

    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key), F.col(text))
    return rows.mapInArrow(run, f"`{key}` {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's change: the words of a tenth of the documents go round from some word on."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The number of runs, the strongest one, and digests of all runs and of the collapsed text.

    Exponents are compared as exact fractions by cross products.
    """
    item = lambda x: F.concat_ws(",", x["start"].cast("string"), x["length"].cast("string"), x["period"].cast("string"))
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    more = lambda best, x: best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"])
    # Runs come by start, then period, so the first of equals stays.
    best = F.aggregate("runs", none, lambda a, x: F.when(more(a, x), x).otherwise(a))
    rows = found.withColumn("_best", best)
    return rows.select(
        F.col(key),
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(F.transform("runs", item), "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13(spark, sf_dir: str) -> DataFrame:
    return digest(periodic_runs(documents(spark, sf_dir), change=planted))
