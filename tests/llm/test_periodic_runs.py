"""Runs against all periods of a text, edge cases and the query against a plain second implementation."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from sitefold.llm import periodic_runs as P

DIR = "/root/testdata/sf0.001"


def plain_runs(words):
    """Every period in turn: stretches of words equal to the word q on. Of one stretch the smallest period counts."""
    n, seen, out = len(words), set(), []
    for q in range(1, n // 3 + 1):
        at = 0
        while at < n - q:
            end = at
            while end < n - q and words[end] == words[end + q]:
                end += 1
            if end - at + q >= max(24, 3 * q) and (at, end + q) not in seen:
                seen.add((at, end + q))
                out.append((at, end + q, q))
            at = end + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def made(rng, kind):
    n = rng.randrange(0, 160)
    if kind == 0:
        return [rng.choice("ab") for _ in range(n)]
    if kind == 1:
        w = []
        while len(w) < n:
            w += [rng.choice("abc") for _ in range(rng.randrange(1, 9))] * rng.randrange(1, 12) + [rng.choice("abc")]
        return w
    if kind == 2:
        base = [rng.choice("ab") for _ in range(rng.randrange(5, 40))]
        return [x for _ in range(5) for x in base * rng.randrange(1, 4) + [rng.choice("xy")]]
    if kind == 3:
        a, b = ["a"], ["a", "b"]
        while len(b) < 200:
            a, b = b, b + a
        return b[:n] + b[: rng.randrange(1, 50)] * 4
    block = ["a"] * rng.randrange(20, 40) + ["b"]
    return (block * rng.randrange(1, 6) + ["c"]) * rng.randrange(1, 6)


@pytest.mark.parametrize("kind", range(5))
def test_all_runs(kind):
    rng = random.Random(kind)
    for _ in range(60):
        w = [x.encode() for x in made(rng, kind)]
        expected = plain_runs(w)
        assert P.runs(w) == expected
        # Without the reduction to repeated windows as well.
        assert sorted(P.stretch_runs(P.np.array([x[0] for x in w])), key=lambda r: (r[0], r[2])) == expected


def test_factors_and_blocks():
    x = P.np.array([ord(c) for c in "abaababaabaab"])
    levels, sa = P.rank_levels(x)
    assert sa.tolist() == sorted(range(len(x)), key=lambda i: x[i:].tolist())
    lcp = P.np.append(0, P.common(levels, sa[:-1], sa[1:]))
    length, source = P.longest_previous(sa, lcp)
    text = x.tolist()
    common = lambda i, j: next((k for k in range(len(text) - j) if text[i + k] != text[j + k]), len(text) - j)
    for j in range(len(text)):
        assert length[j] == max((common(i, j) for i in range(j)), default=0)
        assert not length[j] or common(source[j], j) == length[j] and source[j] < j
    assert P.blocks(length)[-1] == len(text)


def test_long_texts_take_time_in_proportion():
    rng = random.Random(1)
    w = [b"%d" % rng.randrange(5000) for _ in range(50_000)]
    assert P.runs(w) == []
    assert P.runs(w * 4) == [(0, 200_000, 50_000)]
    assert P.runs([b"a"] * 100_000) == [(0, 100_000, 1)]


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a " * 30), (None, "a " * 30), (4, "  x y " * 30), (5, "x y z " * 9 + "x y")]
    docs = spark.createDataFrame([(a, b, "c") for a, b in rows], "doc_id bigint, text string, runs string")
    out = P.periodic_runs(docs)
    assert out.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = sorted((r.doc_id if r.doc_id is not None else 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect())
    assert got[:2] == [(0, 30, [(0, 30, 1)], "a")] * 2
    assert [g[1] for g in got[2:5]] == [0, 0, 0] and [g[3] for g in got[2:5]] == [""] * 3
    assert got[5][2] == [(0, 60, 2)] and got[5][3] == "  x y"  # only the six ASCII characters part words
    assert got[6][2] == [(0, 29, 3)] and got[6][3] == "x y z"
    assert P.digest(P.periodic_runs(docs.limit(0))).count() == 0


def test_query_equals_plain_twin(spark):
    got = {r.doc_id: r for r in P.op13(spark, DIR).collect()}
    docs = spark.read.parquet(f"{DIR}/documents.parquet").collect()
    assert len(got) == len(docs)
    n_found = 0
    for d in docs:
        w = (d.text or "").encode().split()
        h = zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        if len(w) > 1000:  # the twin takes the square of the length
            continue
        found = plain_runs(w)
        n_found += len(found)
        r = got[d.doc_id]
        best = max(found, key=lambda x: (Fraction(x[1] - x[0], x[2]), -x[0], -x[2]), default=None)
        expected = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(found), *expected)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{e - s},{q}\n" for s, e, q in found).encode()).hexdigest()
        left = [x for k, x in enumerate(w) if not any(s + q <= k < e for s, e, q in found)]
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(left)).hexdigest()
    assert n_found > 5
