import math
import zlib
from collections import Counter
from itertools import product

import public_tokenizers

from sitefold.llm import lm_scoring as lm

PIECES = [(" ", 0.1), (" a", 0.2), ("a", 0.15), ("b", 0.15), ("ab", 0.1), ("bab", 0.1)] + [(f"<{k}>", 0.2 / 256) for k in range(256)]


def lattice(pieces=PIECES):
    return lm.Lattice([p for p, _ in pieces], [w for _, w in pieces])


def by_segmentation(word, pieces):
    """The sum over all segmentations, listed one by one."""
    s, weights = " " + word, dict(pieces)
    total = 0.0
    for cuts in product((0, 1), repeat=len(s) - 1):
        parts, part = [], s[0]
        for c, cut in zip(s[1:], cuts):
            if cut:
                parts.append(part)
                part = c
            else:
                part += c
        w = 1.0
        for p in [*parts, part]:
            spelled = math.prod(weights[f"<{b}>"] for b in p.encode()) if len(p) == 1 and p not in dict(pieces[:-256]) else 0.0
            w *= dict(pieces[:-256]).get(p, spelled)
        total += w
    return total


def test_marginal_is_the_sum_over_segmentations():
    x = lattice()
    for word in ("a", "ab", "abab", "babbab", "aéb", "zz", "bb b".replace(" ", "é")):
        assert math.isclose(math.exp(x.log_probability(word)), by_segmentation(word, PIECES), rel_tol=1e-9)


def test_expected_counts_add_up_and_a_round_raises_the_likelihood():
    x, words = lattice(), {"abab": 3, "bab": 2, "aé": 1}
    counts = [0.0] * len(PIECES)
    for w, c in words.items():
        x.expect(w, c, counts)
    covered = sum(n * len(p if p[0] != "<" else "") for n, (p, _) in zip(counts, PIECES))
    assert math.isclose(covered, sum(c * (len(w) + 1) for w, c in words.items()) - words["aé"], rel_tol=1e-9)
    total = sum(counts)
    new = [(p, max(n, 1e-12) / total) for n, (p, _) in zip(counts, PIECES)]
    like = lambda m: sum(c * m.log_probability(w) for w, c in words.items())
    assert like(lattice(new)) > like(x)


def test_long_words_stay_finite():
    assert math.isfinite(lattice().log_probability("ab" * 20000))


def test_base_equals_brute_force_and_sources_of_scores_agree(spark):
    rows = [(k, f"The quick {'fox' if k % 3 else 'ox'} no{k % 7} sees THE word{k % 11}") for k in range(60)] + [(60, None), (61, ""), (5, "The quick fox no5 sees THE word5"), (None, "unseen Words")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS word")
    held = lambda k: zlib.crc32(("" if k is None else str(k)).encode()) % 10 == 0
    c = Counter()
    for k, t in rows:
        if not held(k):
            c.update((t or "").encode().lower().split())
            c[b""] += 1
    n, v = sum(c.values()), len(c)
    out = []
    for common in (3, 10**6):
        got = lm.score(df, public_tokenizers.path("piece_bpe_32k.model"), most_common=common).collect()
        assert len(got) == len(rows)
        for x in got:
            text = next(t for k, t in rows if k == x.doc_id)
            words = [*(text or "").encode().lower().split(), b""]
            assert (x.held_out, x.n_tokens, x.n_known, x.train_tokens) == (held(x.doc_id), len(words), sum(c[w] > 0 for w in words), n)
            assert math.isclose(x.base_score, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words), rel_tol=1e-9)
            assert x.score < 0 and math.isfinite(x.score)
        out.append({x.doc_id: round(x.score, 9) for x in got})
    assert out[0] == out[1]
    none = lm.score(df.where("doc_id IS NULL").selectExpr("CAST(1 AS long) AS doc_id", "CAST(NULL AS string) AS text").limit(0), public_tokenizers.path("piece_bpe_32k.model"))
    assert none.count() == 0


def test_scores_equal_brute_force(spark):
    """The whole model over listed segmentations: weights by rank, one round of expected counts, then all arcs of a text."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = [(k, t) for k, t in enumerate(["the cat sat", "The dog", "a cat and a dog", "dogs sit", None, "", "cats zat", "the the the"] * 3)]
    pieces = dict(lm.load_pieces(path))

    def segmentations(word):
        s = " " + word
        for cuts in product((0, 1), repeat=len(s) - 1):
            parts = "".join(c + "|" * cut for c, cut in zip(s, (*cuts, 0))).split("|")
            if all(p in pieces for p in parts):
                yield parts

    held = lambda k: zlib.crc32(str(k).encode()) % 10 == 0
    c = Counter()
    for k, t in rows:
        if not held(k):
            c.update([*(t or "").lower().split(), ""])
    n, v = sum(c.values()), len(c)
    expected = Counter()
    for w in filter(None, c):
        found = [(parts, math.prod(pieces[p] for p in parts)) for parts in segmentations(w)]
        for parts, x in found:
            for p in parts:
                expected[p] += c[w] * x / sum(y for _, y in found)
    total = sum(expected.values()) + lm.ADDED * len(pieces)
    weight = {p: (expected[p] + lm.ADDED) / total for p in pieces}
    marginal = lambda w: sum(math.prod(weight[p] for p in parts) for parts in segmentations(w))
    arc = lambda w: c[w] / (n + v) + (v / (n + v) * marginal(w) if w else 0)
    got = lm.score(spark.createDataFrame(rows, "doc_id long, text string"), path).collect()
    for x in got:
        words = [*(dict(rows)[x.doc_id] or "").lower().split(), ""]
        assert math.isclose(x.score, sum(math.log10(arc(w)) for w in words), rel_tol=1e-9)
