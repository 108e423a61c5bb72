"""Product codes of vectors, fitted over the distinct integer parts of each position.

Components become integers floor(SCALE * x), and vectors are cut into POSITIONS equal parts. Equal parts of a
position are one weighted row, counted before they are shuffled; Lloyd's rounds run over these rows only: tasks
add up weights and weighted components for each entry, and a row for each position and entry comes to the driver,
which is as many as the codebooks have. Codes and errors of the distinct parts are then joined back to the vectors.
Parts that hold more than 1 / HOT of a position's vectors, at most HOT for each position, are joined by broadcast,
all others by shuffle, so that a part which many vectors share comes to no single task. Labels' sums are joined back
alike.

Rows whose vector is null, or holds null or non-finite components, are dropped; so are those whose width is not
that of the kept row with the smallest id, or is no multiple of POSITIONS, as no code exists for them. Repeated
and null ids are rows like others; the first ENTRIES rows by id (nulls last), then by components, start the
codebooks, fewer if there are fewer. Equal distances go to the lower entry, null labels are one label, and an empty
table has no rows. Components saturate at 2**28 (an x of 2**20 or more in size), so that distances of parts of up to 32
components fit 64 bits. Other input columns are not read, so none clashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sitefold.llm.common import materialise

SCALE, POSITIONS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: A key is hot when more than 1 / HOT of all rows have it.
HOT = 1024
#: The largest component, and distances computed at once.
MOST, CELLS = 1 << 28, 1 << 22

Books = np.ndarray  # positions x entries x components


def integers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.greatest(F.lit(-MOST), F.least(F.lit(MOST), F.floor(x.cast("double") * SCALE))).cast("int"))


def cut(rows: DataFrame, key: str, vector: str, label: str) -> tuple[DataFrame, int]:
    """(row, id, label, parts) of the kept rows, written, and their width; parts is an array of arrays."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    good = rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0)).where(~F.exists(vector, bad))
    good = good.select(F.col(key).alias("id"), F.col(label).alias("label"), integers(F.col(vector)).alias("v"))
    good = materialise(good.withColumn("row", F.monotonically_increasing_id()), "vectors")
    first = good.orderBy(F.col("id").asc_nulls_last(), "v").select(F.size("v")).first()
    width = first[0] // POSITIONS if first and first[0] % POSITIONS == 0 else 0
    parts = F.array(*[F.slice("v", p * width + 1, max(width, 1)) for p in range(POSITIONS)])
    return good.where(F.size("v") == width * POSITIONS).select("row", "id", "label", "v", parts.alias("parts")), width


def first_books(vectors: DataFrame, width: int, entries: int) -> Books:
    rows = vectors.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    return np.array([r[0] for r in rows], np.int64).reshape(len(rows), POSITIONS, width).swapaxes(0, 1)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lowest entry of least squared distance for each row of x, and that distance."""
    code, error = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    step = max(1, CELLS // len(book))
    for low in range(0, len(x), step):
        part = x[low : low + step]
        far = np.zeros((len(part), len(book)), np.int64)
        for c in range(x.shape[1]):
            far += (part[:, c, None] - book[None, :, c]) ** 2
        code[low : low + step] = far.argmin(1)
        error[low : low + step] = far.min(1)
    return code, error


def _by_position(b: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(position, rows, their parts, their weights) of a batch (position, part, weight)."""
    where = b.column(0).to_numpy(zero_copy_only=False)
    x = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)
    weight = b.column(2).to_numpy(zero_copy_only=False)
    for p in np.unique(where).tolist():
        at = np.flatnonzero(where == p)
        yield p, at, x[at], weight[at]


def lloyd_round(distinct: DataFrame, books: Books) -> Books:
    """Every entry moved to the floor of the weighted mean of its parts; unused ones stay."""
    entries, width = books.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((POSITIONS, entries, 1 + width), np.int64)
        for b in batches:
            for p, _, x, weight in _by_position(b, width):
                code, _ = nearest(x, books[p])
                np.add.at(total[p], code, np.column_stack([weight, x * weight[:, None]]))
        p, e = np.nonzero(total[:, :, 0])
        cols = [pa.array(p, pa.int32()), pa.array(e, pa.int32()), *(pa.array(total[p, e, k]) for k in range(1 + width))]
        yield pa.RecordBatch.from_arrays(cols, names=["p", "e", "n", *(f"s{k}" for k in range(width))])

    sums = ", ".join(f"s{k} bigint" for k in range(width))
    rows = distinct.mapInArrow(run, f"p int, e int, n bigint, {sums}")
    moved = books.copy()
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    for r in rows.groupBy("p", "e").agg(F.sum("n").alias("n"), *[exact(f"s{k}") for k in range(width)]).collect():
        moved[r["p"], r["e"]] = [int(r[f"s{k}"]) // r["n"] for k in range(width)]
    return moved


def assign(distinct: DataFrame, books: Books) -> DataFrame:
    """distinct with the code and error of each part."""
    width = books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code, error = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows, np.int64)
            for p, at, x, _ in _by_position(b, width):
                code[at], error[at] = nearest(x, books[p])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(code), pa.array(error)], names=["position", "part", "weight", "code", "error"])

    return distinct.mapInArrow(run, "position int, part array<int>, weight bigint, code int, error bigint")


def join_back(rows: DataFrame, table: DataFrame, keys: list[str], n_rows: int) -> DataFrame:
    """rows joined with table (keys, weight, ...), in which each key of rows has one row. Null equals null.

    Keys of more than n_rows / HOT rows are broadcast: at most HOT of them for n_rows, whatever the data.
    """
    hot = table.where(F.col("weight") * HOT > n_rows).drop("weight")
    match = lambda a, b: [F.expr(f"{a}.`{k}` <=> {b}.`{k}`") for k in keys]
    own = [F.col(f"r.{c}") for c in rows.columns]
    new = [c for c in table.columns if c not in (*keys, "weight")]
    r = rows.alias("r")
    few = F.broadcast(hot.alias("h"))
    one = r.join(few, match("r", "h")).select(*own, *[F.col(f"h.{c}") for c in new])
    rest = r.join(few, match("r", "h"), "left_anti").alias("r").join(table.alias("t").where(F.col("weight") * HOT <= n_rows), match("r", "t"))
    return one.unionByName(rest.select(*own, *[F.col(f"t.{c}") for c in new]))


def compress(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Books]:
    """(id, label, codes, error, label_error) of every kept row, and the codebooks."""
    vectors, width = cut(rows, key, vector, label)
    n = vectors.count() if width else 0
    if not n:
        kinds = dict(rows.dtypes)
        return rows.sparkSession.createDataFrame([], f"id {kinds[key]}, label {kinds[label]}, codes array<int>, error bigint, label_error bigint"), np.zeros((POSITIONS, 0, 0), np.int64)
    books = first_books(vectors, width, entries)
    exploded = vectors.select("row", F.posexplode("parts").alias("position", "part"))
    distinct = materialise(exploded.groupBy("position", "part").agg(F.count(F.lit(1)).alias("weight")), "distinct-parts")
    for _ in range(rounds):
        books = lloyd_round(distinct, books)
    coded = materialise(assign(distinct, books), "coded-parts")
    found = join_back(exploded, coded, ["position", "part"], n).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("position", "code"))).alias("c"), F.sum("error").alias("error"))
    each = vectors.select("row", "id", "label").join(found.select("row", F.col("c.code").alias("codes"), "error"), "row").drop("row")
    each = materialise(each, "vector-codes")
    sums = materialise(each.groupBy("label").agg(F.count(F.lit(1)).alias("weight"), F.sum("error").alias("label_error")), "label-errors")
    return join_back(each, sums, ["label"], n), books


def op11(spark, sf_dir: str) -> DataFrame:
    out, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return out.select(F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _round_sql(k: int) -> str:
    """Assignment a<k> with the codebooks b<k>, and the codebooks b<k + 1> after it."""
    return f"""
a{k} AS MATERIALIZED (SELECT row, p, x, unnest(m) FROM (SELECT d.row, d.p, any_value(d.x) x,
        min({{'error': list_sum(list_transform(list_zip(d.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': b.e}}) m
      FROM d JOIN b{k} b USING (p) GROUP BY d.row, d.p)),
m{k} AS (SELECT p, e, i, floor(sum(x[i])::DECIMAL(38, 0) / count(*))::BIGINT f FROM a{k}, range(1, (SELECT w + 1 FROM w)) t(i) GROUP BY ALL),
b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(n.x, b.x) x FROM b{k} b LEFT JOIN (SELECT p, e, list(f ORDER BY i) x FROM m{k} GROUP BY ALL) n USING (p, e)),"""


SQL = f"""WITH
k AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS row FROM (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
w AS (SELECT len(v) // {POSITIONS} w FROM k WHERE row = 0),
d AS MATERIALIZED (SELECT row, p, v[p * w + 1 : (p + 1) * w] x FROM k, w, range({POSITIONS}) t(p)),
b0 AS (SELECT p, row e, x FROM d WHERE row < {ENTRIES}),{"".join(map(_round_sql, range(ROUNDS + 1)))}
c AS (SELECT row, string_agg(printf('%02x', e), '' ORDER BY p) code, sum(error)::BIGINT error FROM a{ROUNDS} GROUP BY row),
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT label_error, codebooks_sha256 FROM k JOIN c USING (row), h"""
