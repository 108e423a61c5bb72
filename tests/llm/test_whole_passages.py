"""Repeated passages go whatever stands beside them."""

import random

from sitefold.llm import line_dedup

DOCS = "doc_id long, text string"


def passage(r, *sizes):
    return "\n".join(" ".join(f"w{r.randrange(10**7)}" for _ in range(n)) for n in sizes)


def test_adjacent_passages_of_equal_count_both_go(spark):
    r = random.Random(11)
    rows, want = [], {}
    for k in range(0, 120, 3):
        p, q = passage(r, 30, 35), passage(r, 20, 20, 20)
        own = [passage(r, 30) for _ in range(2)]
        rows += [(k, f"{p}\n{q}"), (k + 1, f"{own[0]}\n{p}"), (k + 2, f"{q}\n{own[1]}")]
        want |= {k: f"{p}\n{q}", k + 1: own[0], k + 2: own[1]}
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, DOCS)).collect()
    assert {x.doc_id: x.text for x in out} == want


def test_a_passage_is_cut_alike_below_different_repeated_lines(spark):
    r = random.Random(12)
    heads = [passage(r, 4) for _ in range(20)]
    rows, want = [], {}
    for k in range(0, 160, 2):
        p, far = passage(r, 18, 18, 18), passage(r, 30)
        one, two = heads[k % 20], heads[(k + 7) % 20]
        rows += [(k, f"{one}\n{far}\n{p}"), (k + 1, f"{two}\n{far[::-1]}\n{p}")]
        want |= {k: rows[-2][1], k + 1: f"{two}\n{far[::-1]}"}
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, DOCS)).collect()
    assert {x.doc_id: x.text for x in out} == want
