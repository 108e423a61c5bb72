"""Queries whose input must not be narrowed, against brute force over small tables."""

from collections import defaultdict
from itertools import combinations

from sitefold.queries import QUERIES


def test_jaccard_pairs_do_not_depend_on_how_far_apart_the_ids_are(spark, tmp_path):
    names = ["red bolt", "bolt red", "red ring", "blue ring gear", "gear ring", "red", "", None]
    rows = [(k * 150, f"B{k % 2}", names[k % 8 if k < 16 else k % 5]) for k in range(40)]
    spark.createDataFrame(rows, "p_partkey long, p_brand string, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    words = lambda n: set((n or "").split())
    want = {}
    for (a, x, n), (b, y, m) in combinations(rows, 2):
        score = len(words(n) & words(m)) / max(1, len(words(n) | words(m)))
        if x == y and score >= 0.4:
            want[a, b] = round(score, 6)
    got = [tuple(r) for r in QUERIES["c5_jaccard_all_pairs"](spark, str(tmp_path)).collect()]
    assert len(got) == len(want) and {(a, b): s for a, b, s in got} == want
    assert max(b - a for a, b in want) > 200 and len(set(want.values())) > 2


def test_names_of_all_customers_are_reviewed(spark):
    d = "/root/testdata/sf0.001"
    groups = defaultdict(list)
    for r in spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", "c_mktsegment").collect():
        groups[r.c_mktsegment, r.c_custkey // 30, r.c_custkey // 20 % 3].append(r.c_custkey)
    want = sorted((str(a), str(b)) for g in groups.values() if 2 <= len(g) <= 12 for a, b in combinations(sorted(g), 2))
    assert sorted(map(tuple, QUERIES["j5_name_review_all"](spark, d).collect())) == want
    assert len({k for pair in want for k in pair}) > sum(map(len, groups.values())) / 2


def test_every_customer_is_in_a_component_and_every_order_is_merged_once(spark):
    d = "/root/testdata/sf0.001"
    customers = {r.c_custkey for r in spark.read.parquet(f"{d}/customer.parquet").select("c_custkey").collect()}
    got = {r.node: r.component for r in QUERIES["j6_components_all"](spark, d).collect()}
    assert customers <= set(got) and all(got[k] == got[k - k % 10] for k in customers)
    orders = spark.read.parquet(f"{d}/orders.parquet")
    assert sorted(map(tuple, QUERIES["j10_anti_merge_all"](spark, d).collect())) == sorted(map(tuple, orders.select("o_orderkey", "o_custkey").collect()))
    assert orders.where("o_orderstatus = 'O'").count() > 0


def test_parts_of_one_word_set_meet_in_blocks(spark, tmp_path, monkeypatch):
    """Many more copies of a name than a block holds, with equal ids and parts without a brand or a word among them."""
    monkeypatch.setattr("sitefold.queries.PAIR_BLOCK", 3)
    rows = [(k, "B", "red bolt") for k in range(40)] + [(k, "B", "red bolt ring") for k in range(38, 50)] + [(60, None, "red bolt"), (61, "B", ""), (62, "B", None), (63, "B", "gear")]
    spark.createDataFrame(rows, "p_partkey long, p_brand string, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    words = lambda n: set((n or "").split())
    score = lambda a, b: round(len(words(a) & words(b)) / max(1, len(words(a) | words(b))), 6)
    want = sorted((a, b, score(n, m)) for a, x, n in rows for b, y, m in rows if a < b and x == y == "B" and score(n, m) >= 0.4)
    assert sorted(map(tuple, QUERIES["c5_jaccard_all_pairs"](spark, str(tmp_path)).collect())) == want and len(want) > 1000
