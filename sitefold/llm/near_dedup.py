"""MinHash near-duplicates through a multi-index Hamming join.

A document's set of word shingles gives a signature of b-bit minimum hashes. The signature-distance of
two documents is the number of differing values. Signatures are cut into CHUNKS chunks; within a
distance of CHUNKS * (errors + 1) - 1 some chunk of both differs in at most `errors` values, so with an
index key for each chunk and each way to leave out that many of its values, every pair within that
distance shares a key. Pairs beyond it share one by chance as well: at a similarity of 0.8 one pair in
about a million shares none.

Sharing a key only makes a candidate; links are confirmed on the full sets. To lose none without
forming all pairs of a large bucket: (1) equal sets are one class from the start; (2) all of a bucket
are compared with its smallest class, and components are formed; (3) in buckets that still hold
several components, classes are dealt into blocks, and pairs of blocks compare their classes of
different components in place, so that rows grow with the bucket's size times its number of blocks and
only new links come out. Blocks are bounded by classes and by shingles, so that long texts make them smaller.
Block links tie the first components together; that is the final result. A group of n near copies that lie on
both sides of the threshold still costs up to n * n / 2 comparisons of sets, dealt out by pairs of blocks.

Null and empty texts have an empty set: n_shingles 0, linked with nothing. Equal rows get equal results;
rows that share an id but not a text are classes of their own, and the smallest id of all rows in a
component is its id. A null id is in a component as any other and never its smallest. Other input
columns are not read by near_duplicates() and kept as they are by keep_first(); none clashes. An empty table
gives an empty table. A text is read whole: its set is as large as it has different shingles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from sitefold.llm.common import documents, fresh, materialise, row_key
from sitefold.operators.components import components

#: Values in a signature, chunks, values left out of a chunk's key, bits of a value.
SIGNATURE, CHUNKS, ERRORS, BITS = 32, 8, 1, 16
#: Classes in a block, shingles of all of them on average, and words whose hashes a worker keeps.
BLOCK, MOST_IN_BLOCK, MOST_WORDS = 1024, 1 << 19, 300_000

_U = np.uint64


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        self[word] = n = xxhash.xxh64_intdigest(word)
        return n


_hashes = _WordHashes()
_MULTIPLIERS = (np.random.default_rng(20).integers(1, 1 << 63, SIGNATURE, dtype=np.uint64) << _U(1)) | _U(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles; of the whole sequence if it is shorter."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    size = min(n, len(h))
    acc = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        acc = acc * _U(0x2545F4914F6CDD1D) + h[k : len(h) - size + 1 + k]
    return np.unique(_mixed(acc))


def signature(x: np.ndarray) -> list[int]:
    if len(x) > 4096:
        low = np.array([(x * m).min() for m in _MULTIPLIERS])
    else:
        low = (x[None] * _MULTIPLIERS[:, None]).min(1)
    return (_mixed(low) & _U((1 << BITS) - 1)).astype(np.int32).tolist()


def linked(a: np.ndarray | frozenset, b: np.ndarray | frozenset, percent: int) -> bool:
    """Whether the sets' intersection is at least percent of their union."""
    x, y = len(a), len(b)
    if 100 * min(x, y) < percent * max(x, y) or not x:
        return False
    both = len(a & b) if isinstance(a, frozenset) else len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (x + y - both)


def signatures(docs: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """(doc, k, n_shingles, class, sig): class is a digest of the set, null for the empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, digest, sig = [], [], []
            for t in b.column(2).to_pylist():
                x = shingles(t, n)
                size.append(len(x))
                digest.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None)
                sig.append(signature(x) if len(x) else None)
            cols = [b.column(0), b.column(1), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc", "k", "n_shingles", "class", "sig"])

    rows = docs.select(F.col(key).alias("doc"), row_key(key, text).alias("k"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc {dict(docs.dtypes)[key]}, k binary, n_shingles bigint, class binary, sig array<int>")


#: Places of a signature that a key holds: each chunk, in each way to leave out ERRORS of its values.
KEYS = [tuple(c * (SIGNATURE // CHUNKS) + p for p in way) for c in range(CHUNKS) for way in combinations(range(SIGNATURE // CHUNKS), SIGNATURE // CHUNKS - ERRORS)]


def index_keys(sig: Column) -> Column:
    return F.array(*[F.xxhash64(F.lit(q), *[F.get(sig, F.lit(p)) for p in key]) for q, key in enumerate(KEYS)])


def shared_before(sigs: np.ndarray, q: int) -> np.ndarray:
    """For all pairs of signatures (rows), whether they share a key before key q, whose bucket then compares them."""
    out = np.zeros((len(sigs), len(sigs)), bool)
    for key in KEYS[:q]:
        same = np.ones_like(out)
        for p in key:
            same &= sigs[:, p, None] == sigs[None, :, p]
        out |= same
    return out


def _confirm(pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """pairs (src, dst, a, b) with texts a and b, to the linked (src, dst). Rows of one dst come together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, other = None, None
        for b in batches:
            keep = []
            dst = b.column(1).to_pylist()
            for k, d in enumerate(dst):
                if d != last:
                    last, other = d, shingles(b.column(3)[k].as_py(), n)
                keep.append(linked(shingles(b.column(2)[k].as_py(), n), other, percent))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(mask), b.column(1).filter(mask)], names=["src", "dst"])

    return pairs.select("src", "dst", "a", "b").mapInArrow(run, "src binary, dst binary")


#: Shingles of one pair of blocks up to which they are held as sets.
MOST_IN_SETS = 1 << 20


#: Classes of a pair of blocks from which pairs are first held against the keys before; fewer are just compared.
MANY = 16


def _compare_blocks(rows: DataFrame, n: int, percent: int) -> DataFrame:
    """rows (bucket, bi, bj, q, block, class, component, text, sig), each pair of blocks together, to new links.

    q is the bucket's key. In a large group a pair is compared at the first key that its ends share only.
    """

    def links(group: list[tuple]) -> list[tuple[bytes, bytes]]:
        sets = [shingles(g[4], n) for g in group]
        if sum(map(len, sets)) <= MOST_IN_SETS:
            sets = [frozenset(x.tolist()) for x in sets]
        up: dict[bytes, bytes] = {}

        def find(x):
            while (y := up.get(x, x)) != x:
                x = y
            return x

        out = []
        apart = len({g[1] for g in group}) > 1
        pairs = combinations(range(len(group)), 2)
        if len(group) > MANY:
            todo = ~shared_before(np.array([g[5] for g in group], np.int32), group[0][0])
            pairs = np.argwhere(np.triu(todo, 1)).tolist()
        for i, j in pairs:
            if apart and group[i][1] == group[j][1]:
                continue
            a, b = find(group[i][3]), find(group[j][3])
            if a != b and linked(sets[i], sets[j], percent):
                up[max(a, b)] = min(a, b)
                out.append((group[i][2], group[j][2]))
        return out

    def batch(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.binary()) for k in (0, 1)], names=["src", "dst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group = None, []
        for b in batches:
            for bucket, bi, bj, *rest in zip(*(c.to_pylist() for c in b.columns)):
                if (bucket, bi, bj) != at:
                    yield batch(links(group))
                    at, group = (bucket, bi, bj), []
                group.append(tuple(rest))
        yield batch(links(group))

    rows = rows.select("bucket", "bi", "bj", "q", "block", "class", "component", "text", "sig").repartition("bucket", "bi", "bj").sortWithinPartitions("bucket", "bi", "bj")
    return rows.mapInArrow(run, "src binary, dst binary")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle_words: int = 5, percent: int = 80, block: int = BLOCK) -> DataFrame:
    """(doc, k, n_shingles, component, group): every row with the smallest id of its component. group is the
    component's own key, null for an empty set; only repeated ids make it differ from component."""
    rows = materialise(signatures(docs, key, text, shingle_words), "signatures")
    classes = rows.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc").alias("least"), F.min("k").alias("k"), F.first("sig").alias("sig"), F.max("n_shingles").alias("n"))
    keys = classes.select("class", "n", F.posexplode(index_keys(F.col("sig"))).alias("q", "bucket"))
    buckets = keys.groupBy("bucket").agg(F.min("class").alias("first"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles")).where("size > 1")
    members = materialise(keys.drop("n").join(buckets, "bucket"), "buckets")

    wanted = classes.select("class", "k", "sig").join(members.select("class").distinct(), "class", "left_semi")
    found = docs.select(row_key(key, text).alias("k"), F.col(text).alias("text")).join(wanted, "k")
    texts = materialise(found.dropDuplicates(["k"]).select("class", "text", "sig"), "texts")

    pairs = members.where(F.col("class") != F.col("first")).select(F.col("class").alias("src"), F.col("first").alias("dst")).distinct()
    pairs = pairs.join(texts.select(F.col("class").alias("src"), F.col("text").alias("a")), "src")
    pairs = pairs.join(texts.select(F.col("class").alias("dst"), F.col("text").alias("b")), "dst")
    star = materialise(_confirm(pairs, shingle_words, percent), "star-links")
    joined = materialise(components(star).select(F.col("node").alias("class"), "component"), "star-components")

    now = members.where("size > 2").join(joined, "class", "left").select("bucket", "q", "class", "size", "shingles", F.coalesce("component", "class").alias("component"))
    open_ = now.groupBy("bucket", "q", "size").agg(F.min("component").alias("_a"), F.max("component").alias("_b"), F.sum(F.xxhash64("class").cast("decimal(38,0)")).alias("_all"))
    open_ = open_.where("_a <> _b").groupBy("size", "_all").agg(F.min(F.struct("q", "bucket")).alias("_b"))
    open_ = open_.select("_b.bucket")  # buckets of the same classes count once, at their first key
    dealt = now.join(open_, "bucket", "left_semi").withColumn("_n", F.ceil(F.greatest(F.col("size") / block, F.col("shingles") / MOST_IN_BLOCK)).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("class"), F.col("_n")).cast("int")).withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    dealt = dealt.select("bucket", "q", F.least("block", "_o").alias("bi"), F.greatest("block", "_o").alias("bj"), "block", "class", "component")
    more = materialise(_compare_blocks(dealt.join(texts, "class"), shingle_words, percent), "block-links")

    # The second round of components runs over the first ones' names, as far as block links touch them.
    of = lambda c, into: joined.select(F.col("class").alias(c), F.col("component").alias(into))
    over = more.join(of("src", "_a"), "src", "left").join(of("dst", "_b"), "dst", "left").select(F.coalesce("_a", "src").alias("src"), F.coalesce("_b", "dst").alias("dst"))
    final = materialise(components(materialise(over, "component-links")).select(F.col("node").alias("_first"), F.col("component").alias("_c")), "components")
    named = classes.select("class", "least").join(joined, "class", "left").withColumn("_first", F.coalesce("component", "class")).drop("component")
    named = named.join(final, "_first", "left").withColumn("_c", F.coalesce("_c", "_first"))
    least = named.groupBy("_c").agg(F.min("least").alias("component"))
    named = named.join(least, "_c").select("class", "component", F.col("_c").alias("group"))
    return rows.drop("sig").join(named, "class", "left").select("doc", "k", "n_shingles", F.coalesce("component", "doc").alias("component"), "group")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row of each component: the one with its smallest id. Documents with an empty set all stay."""
    found = near_duplicates(docs, key, text, **how)
    kept = found.where((F.col("doc") == F.col("component")) | F.col("component").isNull() | (F.col("n_shingles") == 0))
    kept = kept.groupBy(F.coalesce("group", "k")).agg(F.min("k").alias("_k"))
    (k,) = fresh(docs.columns, "_k")
    kept = kept.select(F.col("_k").alias(k)).distinct()
    return docs.withColumn(k, row_key(key, text)).join(kept, k).dropDuplicates([k]).select(*docs.columns)


def op6(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(documents(spark, sf_dir), shingle_words=2, percent=80)
    return out.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), F.col("doc").eqNullSafe(F.col("component")).alias("kept"))


SQL = r"""WITH RECURSIVE
w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0b\f\r]+'), lambda x: x <> '') ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 2 THEN [ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))] WHEN len(ws) = 1 THEN ws ELSE [] END) g FROM w),
u AS (SELECT doc_id, unnest(g) x FROM s),
f AS (SELECT x FROM u GROUP BY x HAVING count(*) > 1),
r AS (SELECT doc_id, x FROM u JOIN f USING (x)),
n AS (SELECT doc_id, len(g)::BIGINT n FROM s),
p AS (SELECT a.doc_id i, b.doc_id j, count(*) c FROM r a JOIN r b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT i, j FROM p JOIN n a ON a.doc_id = i JOIN n b ON b.doc_id = j WHERE 100 * c >= 80 * (a.n + b.n - c)),
h AS (SELECT i, j FROM e UNION ALL SELECT j, i FROM e),
t(doc_id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT h.j, t.c FROM t JOIN h ON h.i = t.doc_id)
SELECT doc_id, n n_shingles, component_id, doc_id = component_id kept FROM n JOIN (SELECT doc_id, min(c) component_id FROM t GROUP BY ALL) USING (doc_id)"""
