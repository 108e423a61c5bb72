"""Quality rules, source mixing, line dedup and decontamination against brute force, and their defined edge cases."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from sitefold.llm import decontamination, line_dedup, mixing, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


def prose(r, n, words=400):
    return " ".join(f"{r.choice('bcdfgklmnprst')}{r.choice('aeiou')}{r.randrange(words)}" for _ in range(n))


def base_measures(text):
    ws = WORD.findall(text or "")
    win = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    seen = Counter(win)
    hit = {i + k for i, w in enumerate(win) if seen[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_quality_measures_equal_brute_force(spark):
    r = random.Random(3)
    texts = [None, "", " \n\t", "a b", "a b c", "a b c a b c a b c", "x # y\nx # y\n\n  \nx # y", "é ü 数据\x85z\xa0w", "\n".join(prose(r, 12, 6) for _ in range(30)), prose(r, 6000, 5)]
    rows = [(k, t, "s") for k, t in enumerate(texts)] + [(9, texts[9], "s"), (None, "a b c", "s")]
    got = quality_rules.judge(table(spark, rows).withColumn("n_words", F.lit("clash"))).collect()
    assert len(got) == len(rows)
    for x in got:
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == base_measures(x.text), x.text
        assert x.base_failed == (x.n_words < 50 or 100 * x.n_repeat_words > 50 * x.n_words)
        assert not (x.base_failed and x.kept)
    assert quality_rules.judge(table(spark, [])).count() == 0


def test_quality_keeps_prose_and_rejects_junk(spark):
    stops = {"en": "the and of to in is", "fr": "la les et des une dans", "de": "der die und das von mit", "es": "el los que por con para"}
    r = random.Random(8)
    rows = [(k, " ".join(f"{r.choice(t.split())} {prose(r, 2, 10**6)}" for _ in range(30)), "s") for k, t in enumerate(stops.values())]
    rows.append((10, " ".join(f"w{i}&&& #x{i} %%%{i}$$$" for i in range(60)), "s"))
    words = rows[0][1].split()
    rows.append((11, " ".join(w + " |" * (i % 3 == 0) for i, w in enumerate(words)), "s"))  # cells of a menu
    rows.append((12, " ".join(w + " &" * (i % 20 == 0) for i, w in enumerate(words)), "s"))
    kept = {r.doc_id for r in quality_rules.keep_good(table(spark, rows)).collect()}
    assert kept == {0, 1, 2, 3, 12}


def test_mixing_reaches_targets_and_reruns_agree(spark):
    r = random.Random(4)
    rows = [(k, prose(r, r.randrange(20, 60)), s) for k, s in enumerate(["a"] * 600 + ["b"] * 300 + ["c"] * 20 + [None] * 200)] + [(5000, None, "d"), (5000, None, "d")]
    out = mixing.mix(table(spark, rows).withColumn("size", F.lit(-1))).cache()
    by = {x.source: x for x in out.groupBy("source").agg(F.sum("size").alias("size"), F.first("source_size").alias("n"), F.first("target").alias("t"), F.sum(F.col("copies") * F.col("size")).alias("taken")).collect()}
    total = sum(x.size for x in by.values())
    assert by["d"].t == 0 and by["c"].t == 3 * by["c"].n == by["c"].taken and all(x.size == x.n for x in by.values())
    weights = {"a": 1, "b": 2, "c": 3, "d": 1, None: 2}  # by name, null last: 1, 2, 3, 1, 2
    free = [s for s in by if by[s].t < 3 * by[s].n]
    assert abs(sum(x.t for x in by.values()) - total) < 1e-6 and len({round(by[s].t / weights[s], 6) for s in free}) == 1
    assert all(abs(x.taken - x.t) <= 0.15 * x.t for s, x in by.items() if s != "d")
    again = mixing.mix(table(spark, rows).repartition(3))
    assert sorted(map(str, out.select("doc_id", "copies").collect())) == sorted(map(str, again.select("doc_id", "copies").collect()))
    assert mixing.emit(out).count() == out.agg(F.sum("copies")).first()[0]
    assert mixing.mix(table(spark, [])).count() == 0


def test_line_dedup_cuts_planted_passages_and_leaves_the_rest(spark):
    r = random.Random(5)
    passages = ["\n".join(prose(r, n, 10**6) for n in sizes) for sizes in ([60], [20, 25, 30], [12] * 9, [70, 5, 40])]
    rows, planted = [], defaultdict(list)
    for k in range(60):
        body = [prose(r, r.randrange(5, 40), 10**6) for _ in range(r.randrange(1, 8))]
        if k % 2:
            p = passages[k // 2 % 4]
            at = r.randrange(len(body) + 1)
            body[at:at] = p.split("\n")
            planted[p].append(k)
        if k % 5 == 0:
            body.append("All rights reserved.")
        if k % 7 == 0:
            body.insert(0, "")
        rows.append((k, "\n".join(body), "s"))
    rows += [(3, rows[3][1], "s"), (None, rows[8][1], "s"), (70, None, "s"), (71, "", "s"), (72, rows[4][1], "s")]
    out = line_dedup.dedup_lines(table(spark, rows).withColumn("emptied", F.lit(1))).collect()
    assert len(out) == len(rows)
    text = {x.doc_id: x for x in out}
    cut = {k for ks in planted.values() for k in ks[1:]}
    for p, ks in planted.items():
        assert p in text[ks[0]].text
        for k in ks[1:]:
            assert p not in text[k].text
            left = [x for x in p.split("\n") if x in text[k].text.split("\n")]
            assert sum(len(x.split()) for x in left) <= 0.2 * len(p.split()), (k, left)
    for k in range(60):
        if k not in cut:
            assert text[k].text == rows[k][1] and not text[k].emptied
        else:
            own = [x for x in rows[k][1].split("\n") if not any(x in p.split("\n") for p in passages) and "rights" not in x]
            assert set(own) <= set(text[k].text.split("\n"))
    assert text[72].emptied == (len(rows[4][1].split()) >= 50) and text[70].text is None and text[71].text == ""
    assert text[None].n_words_removed in (0, len(rows[8][1].split()))
    assert line_dedup.dedup_lines(table(spark, [])).count() == 0


def test_one_line_that_every_document_holds(spark):
    r = random.Random(6)
    line = prose(r, 80)
    rows = [(k, f"{prose(r, 30, 10**6)}\n{line}\n{prose(r, 30, 10**6)}", "s") for k in range(300)]
    out = line_dedup.dedup_lines(table(spark, rows))
    assert [x.doc_id for x in out.where(F.col("text").contains(line)).collect()] == [0]
    assert out.agg(F.sum("n_lines_removed")).first()[0] == 299


def test_decontamination_finds_changed_passages_and_spares_clean_text(spark):
    r = random.Random(7)
    items = [prose(r, r.randrange(16, 50), 300) for _ in range(12)] + ["Short one here, right", None, ""]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows, want = [], {}
    for k in range(120):
        words = prose(r, r.randrange(0, 120), 300).split()
        want[k] = set()
        if k % 4 == 0:
            j = r.randrange(12)
            p = items[j].split()
            if k % 8 == 0:  # every ninth word changed
                p = [f"zz{r.randrange(999)}" if i % 9 == 4 else w for i, w in enumerate(p)]
            if k % 12 == 0:
                p = p[: max(14, len(p) // 2)]
            at = r.randrange(len(words) + 1)
            words[at:at] = [w.upper() + "," if k % 3 else w for w in p]
            want[k] = {j}
        rows.append((k, " ".join(words), "s"))
    rows += [(200, f"x y {items[12].upper()}! z", "s"), (201, None, "s"), (202, "", "s"), (1, rows[1][1], "s"), (None, items[3], "s")]
    want |= {200: {12}, 201: set(), 202: set(), None: {3}}
    docs = table(spark, rows).withColumn("item_id", F.lit("clash"))
    for bound in (decontamination.MOST_BROADCAST, -1):  # broadcast and shuffled
        decontamination.MOST_BROADCAST, kept = bound, decontamination.MOST_BROADCAST
        try:
            out = decontamination.leaks(docs, bench).collect()
        finally:
            decontamination.MOST_BROADCAST = kept
        assert len(out) == len(rows)
        assert {x.doc_id: set(x["items"]) for x in out} == want
        assert all(x.leaked == bool(x["items"]) for x in out)
    assert decontamination.leaks(docs.limit(0), bench).count() == 0 and decontamination.leaks(docs, bench.limit(0)).where("leaked").count() == 0


def test_decontamination_on_shipped_documents_equals_a_plain_search(spark):
    d = "/root/testdata/sf0.001"
    docs, bench = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")
    plain = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    items = {r.item_id: plain(r.text) for r in bench.collect()}
    want = {r.doc_id: {i for i, t in items.items() if f" {t} " in f" {plain(r.text)} "} for r in docs.collect()}
    got = {r.doc_id: set(r["items"]) for r in decontamination.leaks(docs, bench).collect()}
    assert all(want[k] <= got[k] for k in want)
    assert sum(map(bool, got.values())) <= sum(map(bool, want.values())) + 2
