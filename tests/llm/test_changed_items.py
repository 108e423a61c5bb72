"""Whole items with any tokens substituted are found as far as verification admits them."""

import random

import numpy as np

from sitefold.llm import decontamination as D

DOCS = "doc_id long, text string"


def test_every_admitted_pattern_holds_a_seed():
    for n in range(1, D.WINDOW + 2 * D.AROUND + 1):
        p = np.arange(1 << n, dtype=np.uint32)
        least = max(D.MIN_SHARE * n, min(n, 6))
        hit = np.zeros(len(p), bool)
        for m in [*D.MASKS, *[D.TEN] * (n == 10), *["1" * n] * (n < 3)]:
            left = np.full(len(p), (1 << max(0, n - len(m) + 1)) - 1, np.uint32)
            for i, c in enumerate(m):
                if c == "1":
                    left &= p >> np.uint32(i)
            hit |= left != 0
        assert hit[np.bitwise_count(p) >= least].all(), n


def changed(r, words, places):
    return [f"zz{r.randrange(10**9)}" if i in places else w for i, w in enumerate(words)]


def admitted(equal):
    """Brute force: equal tells for each token of a whole item whether it is as in the document."""
    n = len(equal)
    if n < D.WINDOW:
        return sum(equal) >= min(n, max(6, D.MIN_SHARE * n))
    places = [equal[max(0, w - D.AROUND) : w + D.WINDOW + D.AROUND] for w in range(n - D.WINDOW + 1)]
    return any(sum(x) >= D.MIN_SHARE * len(x) for x in places)


def test_items_with_substitutions_equal_brute_force(spark):
    r = random.Random(9)
    items, rows, want = [], [], {}
    fixed = [(11, {0}), (11, {10}), (11, {0, 5, 10}), (10, {2, 3, 6, 7}), (15, {3, 4, 5, 9, 10, 11}), (7, {3}), (6, {3}), (2, set()), (1, set())]
    for k in range(400):
        n = r.choice([5, 7, 8, 9, 10, 11, 12, 16, 18, 20, 25, 30, 45])
        n, places = fixed[k] if k < len(fixed) else (n, set(r.sample(range(n), r.randrange(0, n // 2 + 1))))
        words = [f"w{k}x{i}" for i in range(n)]
        before, after = ([f"b{r.randrange(10**9)}" for _ in range(r.choice([0, 3, 40]))] for _ in range(2))
        items.append((k, " ".join(words)))
        rows.append((k, " ".join(before + changed(r, words, places) + after)))
        want[k] = [k] if admitted([i not in places for i in range(n)]) else []
    assert 100 < sum(map(bool, want.values())) < 400
    docs, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string")
    for bound in (D.MOST_BROADCAST, -1):  # broadcast and shuffled
        D.MOST_BROADCAST, kept = bound, D.MOST_BROADCAST
        try:
            got = {x.doc_id: x["items"] for x in D.leaks(docs, bench).collect()}
        finally:
            D.MOST_BROADCAST = kept
        assert {k: (got[k], want[k]) for k in want if got[k] != want[k]} == {}
