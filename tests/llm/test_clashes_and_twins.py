"""Columns named like inner ones change nothing, and line dedup equals a plain second implementation."""

import random
import struct
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from sitefold.llm import decontamination, line_dedup, mixing, near_dedup, quality_rules, secret_scans

NAMES = "k K2 cut n_words n_lines _k _k2 _cut _lines _words id _id _t _doc _items _n _w _l _g _p _n_lines _kept _row _text _source _size _total _target h hs j n s c ch place text_ blob item t doc component group class at seed".split()


def rows(n=90):
    r = random.Random(2)
    word = lambda: f"{r.choice(['the', 'and', 'of'])} w{r.randrange(10**6)}"
    shared = "\n".join(" ".join(word() for _ in range(20)) for _ in range(4))
    texts = [" ".join(word() for _ in range(r.randrange(10, 60))) + (f"\n{shared}" if k % 3 == 0 else "") for k in range(n)]
    return [(k, t, f"s{k % 4}") for k, t in enumerate([*texts, texts[1], None, ""])]


def by(df, *cols):
    return sorted((tuple(str(r[c]) for c in cols) for r in df.collect()))


def test_clashing_names(spark):
    plain = spark.createDataFrame(rows(), "doc_id long, text string, source string")
    wide = plain.select("*", *[F.lit(f"user {n}").alias(n) for n in dict.fromkeys(x for x in NAMES if x.lower() not in ("k2",))])
    bench = spark.createDataFrame([(1, rows()[3][1])], "item_id long, text string")
    for f, cols in (
        (line_dedup.dedup_lines, ("doc_id", "text", "n_lines_removed", "n_words_removed", "emptied")),
        (lambda d: decontamination.leaks(d, bench), ("doc_id", "leaked", "items", "n_equal")),
        (quality_rules.keep_good, ("doc_id", "text")),
        (quality_rules.judge, ("doc_id", "n_words", "kept", "symbol_ratio")),
        (mixing.mix, ("doc_id", "size", "source_size", "target", "copies")),
        (lambda d: mixing.emit(mixing.mix(d)), ("doc_id", "copy")),
        (near_dedup.keep_first, ("doc_id", "text")),
        (near_dedup.near_duplicates, ("doc", "n_shingles", "component")),
        (secret_scans.scan, ("doc_id", "blob", "spans")),
    ):
        got = f(wide)
        assert by(got, *cols) == by(f(plain), *cols)
        kept = [c for c in got.columns if c in NAMES and c not in cols and c not in ("k", "group", "component", "n_words")]
        assert got.where(" OR ".join(f"`{c}` <> 'user {c}'" for c in kept) or "false").count() == 0
    for f in (line_dedup.dedup_lines, lambda d: decontamination.leaks(d, bench), quality_rules.keep_good, mixing.mix, near_dedup.keep_first, secret_scans.scan):
        assert f(wide.limit(0)).count() == 0


def test_a_filter_on_the_verdict_ends(spark):
    docs = spark.createDataFrame([(k, " ".join(f"the w{i * k}" for i in range(4000))) for k in range(200)], "doc_id long, text string")
    judged = quality_rules.judge(docs)
    assert judged.where("kept").count() == sum(r.kept for r in judged.select("kept").collect())
    assert "Generate" in judged.where("kept")._jdf.queryExecution().optimizedPlan().toString()


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def twin(docs, min_words, chunk_lines):
    """The rule of line_dedup over plain lists: text left of every (id, text)."""
    docs = list(dict.fromkeys((i, t) for i, t in docs if t is not None))
    lines = [[(i, x) for i, x in enumerate(t.split("\n")) if x.strip(" \t\n\x0b\f\r")] for _, t in docs]
    count, before, after = Counter(), defaultdict(set), defaultdict(set)
    for ls in lines:
        for j, (_, x) in enumerate(ls):
            count[x] += 1
            before[x].add(ls[j - 1][1] if j else None)
            after[x].add(ls[j + 1][1] if j + 1 < len(ls) else None)
    h = lambda x: xxhash.xxh64_intdigest(x.encode(), 42)
    found = defaultdict(list)
    per_doc = []
    for d, ls in enumerate(lines):
        chunks, last = [], None  # last: j, lines of the chunk so far back to its edge
        run = []
        for j, (_, x) in enumerate(ls):
            if count[x] < 2:
                continue
            edge = not (run and run[-1] == j - 1 and len(after[ls[j - 1][1]]) == 1 and len(before[x]) == 1)
            run = [j] if edge else [*run, j]
            # The last two lines before this one; across an edge the rolling hash knows one line only.
            seed = 42
            earlier = [q for q in range(j) if count[ls[q][1]] > 1][-2:]
            edge_before = bool(earlier) and last is not None and last[1]
            if earlier:
                if len(earlier) == 2 and not edge_before:
                    seed = xxhash.xxh64_intdigest(struct.pack("<q", signed(h(ls[earlier[0]][1]))), seed)
                seed = xxhash.xxh64_intdigest(struct.pack("<q", signed(h(ls[earlier[1 if len(earlier) == 2 else 0]][1]))), seed)
            if edge or signed(seed) % chunk_lines == 0:
                chunks.append([j])
            else:
                chunks[-1].append(j)
            last = (j, edge)
        per_doc.append(chunks)
        for c in chunks:
            found["\n".join(ls[j][1] for j in c)].append((docs[d][0] is None, docs[d][0] or 0, d, c[0]))
    out = {}
    for d, ls in enumerate(lines):
        repeated = [(c, min(found[b])[2:] == (d, c[0]), sum(len(ls[j][1].split()) for j in c)) for c in per_doc[d] if len(found[b := "\n".join(ls[j][1] for j in c)]) > 1]
        stretches = []
        for c, first, w in repeated:
            if stretches and stretches[-1][-1][0][-1] + 1 == c[0]:
                stretches[-1].append((c, first, w))
            else:
                stretches.append([(c, first, w)])
        gone = {ls[j][0] for s in stretches if sum(w for *_, w in s) >= min_words for c, first, _ in s if not first for j in c}
        out[docs[d]] = "\n".join(x for i, x in enumerate(docs[d][1].split("\n")) if i not in gone)
    return out


@pytest.mark.parametrize("chunk_lines,min_words,hash_bits", [(1, 8, 64), (8, 12, 64), (10**9, 1, 64), (3, 10, 2)])
def test_line_dedup_equals_a_plain_twin(spark, chunk_lines, min_words, hash_bits):
    r = random.Random(chunk_lines)
    line = lambda n: " ".join(f"w{r.randrange(10**6)}" for _ in range(n))
    passages = [[line(r.randrange(1, 7)) for _ in range(r.randrange(1, 14))] for _ in range(12)] + [["a"], ["b c"]]
    docs = []
    for k in range(70):
        body = []
        for _ in range(r.randrange(0, 6)):
            body += r.choice([[line(5)], r.choice(passages), [""], ["  "], passages[0][-3:], r.choice(passages)[:4]])
        docs.append((k, "\n".join(body)))
    docs += [docs[5], docs[7], (500, None), (501, "")]
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), min_words=min_words, chunk_lines=chunk_lines, hash_bits=hash_bits).collect()
    want = twin(docs, min_words, chunk_lines)
    assert len(got) == len(docs)
    texts = defaultdict(list)
    for i, t in docs:
        texts[i].append(t)
    for x in got:
        if x.doc_id == 500:
            assert x.text is None
        else:
            assert x.text in [want[x.doc_id, t] for t in texts[x.doc_id]], (x.doc_id, texts[x.doc_id])
    assert sum(len(v.split()) for v in want.values()) < sum(len((t or "").split()) for _, t in dict.fromkeys(docs))
