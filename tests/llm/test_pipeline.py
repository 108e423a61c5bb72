import random
import re

import corpus_pipeline
from sitefold.llm import common, quality_rules


def test_stages_on_shipped_documents(spark):
    d = "/root/testdata/sf0.001"
    docs = common.documents(spark, d)
    benchmark = [" ".join(re.findall(r"[^\W_]+", r.text.lower())) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, common.materialise(stage(spark, docs, d), name)
        seen[name] = before, docs
        if name != "source_mixing":
            assert docs.dtypes == before.dtypes
    before, after = seen["quality_rules"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in quality_rules.judge(before).where("kept").collect()}
    before, after = seen["line_dedup"]
    texts = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        lines = texts[r.doc_id].split("\n")
        assert r.n_chars == len(r.text) and all(x in lines for x in r.text.split("\n"))
    before, after = seen["near_dedup"]
    shingles = lambda t: {tuple(w[i : i + 5]) for w in [t.encode().lower().split()] for i in range(max(1, len(w) - 4))}
    sets, kept = {r.doc_id: shingles(r.text) for r in before.collect()}, {r.doc_id for r in after.collect()}
    near = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    links = {k: [o for o in sets if o != k and near(sets[k], sets[o])] for k in sets}
    for k in sets:
        group, todo = {k}, [k]
        while todo:
            new = set(links[todo.pop()]) - group
            group |= new
            todo += new
        assert kept & group == {min(group)}
    before, after = seen["decontamination"]
    plain = {r.doc_id: " ".join(re.findall(r"[^\W_]+", r.text.lower())) for r in before.collect()}
    left = {r.doc_id for r in after.collect()}
    assert all(k not in left for k, t in plain.items() if any(b in t for b in benchmark))
    before, after = seen["source_mixing"]
    taken = {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert max(taken.values()) <= 3 and set(taken) <= {r.doc_id for r in before.collect()}


def made(spark, tmp_path):
    """Nulls, empty texts, repeats, a null source, a very long text, and columns named like inner ones."""
    r = random.Random(9)
    prose = lambda n: " ".join(r.choice(["the", "of", "and", "is"]) if k % 3 else f"w{r.randrange(10**6)}" for k in range(n))
    texts = [prose(80) for _ in range(12)] + [prose(200_000)]
    rows = [(k, t, ("a", "b", None)[k % 3], 1, "k", "size", True) for k, t in enumerate(texts)]
    rows += [rows[0], rows[0], (50, texts[1], "b", 1, "k", "size", True), (60, None, "a", 1, None, None, None), (61, "", None, 1, None, None, None), (None, texts[2] + " end", None, None, None, None, None), (62, "short", "a", 1, "k", "s", False)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, copy int, component string, _k string, kept boolean")
    bench = spark.createDataFrame([(1, " ".join(texts[5].split()[10:40])), (2, None), (3, "")], "item_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    return docs


def test_odd_rows_pass_through_all_stages(spark, tmp_path):
    docs = made(spark, tmp_path)
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = common.materialise(stage(spark, docs, str(tmp_path)), name)
        assert after.dtypes == docs.dtypes
        docs = after
        kept.append(sorted((x.doc_id is None, x.doc_id) for x in after.select("doc_id").collect()))
    ids = [[k for missing, k in x if not missing] for x in kept]
    assert ids[0] == [0, 0, 0, *range(1, 13), 50] and (True, None) in kept[0]  # null, empty and short texts go
    assert ids[2] == [*range(13)] and ids[3] == [k for k in range(13) if k != 5]  # one of each group stays, the leaked one goes
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} <= {*ids[3]} and out
    assert sorted(map(str, out)) == sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).collect()))


def test_empty_table_passes_through_all_stages(spark, tmp_path):
    docs = made(spark, tmp_path / "made")
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.read.parquet(f"{tmp_path}/made/benchmark.parquet").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
