"""Codes, errors and codebooks against a plain implementation over all parts, and edge cases."""

import hashlib
import math
import random

from sitefold.llm import vector_codes as V

KIND = "vec_id bigint, embedding array<float>, label int, error string"


def plain(rows, entries=64, rounds=2):
    good = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    ints = [(r, [math.floor(256 * x) for x in r[1]]) for r in good]
    ints.sort(key=lambda p: (p[0][0] is None, p[0][0], p[1]))
    width = len(ints[0][1]) // 16
    parts = [[tuple(v[p * width : (p + 1) * width]) for _, v in ints] for p in range(16)]
    books = [[*column[:entries]] for column in parts]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, column in enumerate(parts):
            of = [[] for _ in books[p]]
            for x in column:
                of[near(x, books[p])[1]].append(x)
            books[p] = [tuple(sum(c) // len(xs) for c in zip(*xs)) if xs else e for xs, e in zip(of, books[p])]
    out, sums = [], {}
    for k, (r, _) in enumerate(ints):
        found = [near(parts[p][k], books[p]) for p in range(16)]
        out.append((r[0], r[2], [c for _, c in found], sum(e for e, _ in found)))
        sums[r[2]] = sums.get(r[2], 0) + out[-1][3]
    order = lambda x: (x[0] is None, x[0] or 0, x[2], x[1] or 0)
    return sorted(((*o, sums[o[1]]) for o in out), key=order), books


def both(spark, rows, **how):
    out, books = V.compress(spark.createDataFrame(rows, KIND), **how)
    order = lambda x: (x[0] is None, x[0] or 0, x[2], x[1] or 0)
    return sorted(map(tuple, out.collect()), key=order), [[tuple(e) for e in b] for b in books.tolist()]


def test_equals_plain_with_hot_parts_and_labels(spark):
    rng = random.Random(4)
    vector = lambda: [rng.choice((-0.5, -0.123, 0.0, 0.25, 0.3)) if rng.random() < 0.5 else rng.uniform(-1, 1) for _ in range(32)]
    same = vector()
    rows = [(k, same if k % 3 == 0 else vector(), rng.choice((None, 1, 1, 1, 2)), "x") for k in range(300)]
    rng.shuffle(rows)
    assert both(spark, rows) == plain(rows)
    assert both(spark, rows, entries=5, rounds=3) == plain(rows, 5, 3)
    # Every part is hot, and none is.
    hot = V.HOT
    try:
        for V.HOT in (1 << 20, 1):
            assert both(spark, rows) == plain(rows)
    finally:
        V.HOT = hot


def test_edges(spark):
    nan, inf = math.nan, math.inf
    good = [[(k * 7 + c) % 5 / 3 for c in range(16)] for k in range(6)]
    bad = [None, [], [None] * 16, [nan] + [0.0] * 15, [0.0] * 15 + [inf], [0.0] * 15 + [-inf]]
    rows = [(k, v, None, "x") for k, v in enumerate(good)] + [(2, good[2], None, "x"), (None, good[1], 3, "x")] + [(k, v, 3, "x") for k, v in enumerate(bad)]
    got, books = both(spark, rows)
    assert (got, books) == plain(rows) and len(got) == 8
    # Other widths than the first row's have no code; a first width without 16 parts leaves no row.
    wide = rows + [(9, [0.5] * 32, 1, "x"), (9, [0.5] * 17, 1, "x")]
    assert both(spark, wide)[0] == got
    assert both(spark, [(-1, [1.0] * 17, 1, "x"), *rows]) == ([], [[]] * 16)
    assert both(spark, rows[-3:]) == ([], [[]] * 16) == both(spark, [])
    # Very large components stay inside 64 bits.
    far, _ = both(spark, [(0, [3e38] * 16, 1, "x"), (1, [-3e38] * 16, 1, "x")], entries=1)
    assert [r[3] for r in far] == [16 * V.MOST**2] * 2


def test_digest_of_codebooks(spark):
    directory = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{directory}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    expected, books = plain(rows)
    got = sorted(V.op11(spark, directory).collect())
    text = ",".join(str(x) for b in books for e in b for x in e)
    assert {r.codebooks_sha256 for r in got} == {hashlib.sha256(text.encode()).hexdigest()}
    assert [(r.vec_id, r.code, r.error, r.label_error) for r in got] == [(e[0], "".join(f"{c:02x}" for c in e[2]), e[3], e[4]) for e in expected]
