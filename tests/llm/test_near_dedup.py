import random
from collections import defaultdict

from sitefold.llm import near_dedup


def sets(text, n):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(rows, n, percent=80):
    """Smallest id reachable, by all pairs of different sets."""
    by = defaultdict(list)
    for i, t in rows:
        by[sets(t, n)].append(i)
    groups = [s for s in by if s]
    up = {s: s for s in groups}

    def find(s):
        while up[s] is not s:
            s = up[s]
        return s

    for i, a in enumerate(groups):
        for b in groups[i + 1 :]:
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                up[find(a)] = find(b)
    least = {}
    for s in groups:
        r = find(s)
        ids = [i for i in by[s] if i is not None]
        least[r] = min([least[r], *ids] if r in least else ids, default=None) if ids or r in least else None
    return {(i, t): (len(sets(t, n)), i if not sets(t, n) else least[find(sets(t, n))]) for i, t in rows}


def corpus(seed):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(400)}"
    base = [word() for _ in range(60)]
    texts = []
    for rate in [0.0, 0.02, 0.04, 0.06, 0.08] * 30:  # a hot group whose pairs lie on both sides of the threshold
        texts.append(" ".join(word() if r.random() < rate else w for w in base))
    for _ in range(60):
        t = [word() for _ in range(r.randrange(1, 40))]
        texts += [" ".join(t)] * r.randrange(1, 3) + [" ".join(t[:-1] + [word()])]
    texts += ["", None, "one", "ONE", "one two", " one\ttwo\n", "one\x85two"]
    return list(enumerate(texts, 1))


def test_components_equal_all_pairs(spark):
    for seed, n in ((1, 2), (2, 5)):
        rows = corpus(seed)
        df = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("doc_id", "id")
        got = near_dedup.near_duplicates(df, "id", shingle_words=n, block=40).collect()
        want = brute(rows, n)
        text = dict(rows)
        assert {(x.doc, text[x.doc]): (x.n_shingles, x.component) for x in got} == want


def test_repeated_and_null_ids(spark):
    a, b = " ".join(f"a{k}" for k in range(50)), " ".join(f"b{k}" for k in range(50))
    rows = [(7, a), (7, a), (7, b), (9, b), (None, a), (None, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'clash' AS component", "1 AS class")
    got = sorted(((x.doc, x.n_shingles, x.component) for x in near_dedup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(7, 46, 7), (7, 46, 7), (7, 46, 7), (9, 46, 7), (None, 46, 7), (None, 0, None), (3, 0, 3)], key=str)
    kept = sorted(((x.doc_id, x.text) for x in near_dedup.keep_first(df).collect()), key=str)
    assert kept == sorted([(7, a), (7, b), (None, None), (3, "")], key=str)
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0
