"""CSV read by splits, against Python's reader, at any split size."""

import csv
import random

import pytest

from sitefold.sources.files import read_csv, with_seq


@pytest.fixture
def split_size(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum") if spark.conf.get(k, None)}
    yield lambda n: [spark.conf.set(k, v) for k, v in (("spark.sql.files.maxPartitionBytes", n), ("spark.sql.files.openCostInBytes", 0))]
    for k, v in old.items():
        spark.conf.set(k, v)


def cells(rng, plain):
    bits = ["a", "b ", "é", "5\" pipe", "", "12"] if plain else ["a", "x\ny", 'say ""hi""', ",", "\n\n", "", "é", '"', "\n,\n", "z" * 40, '",\n"']
    return "".join(rng.sample(bits, rng.randrange(3)))


@pytest.mark.parametrize("plain", [True, False])
def test_rows_are_the_same_at_any_split_size(spark, tmp_path, split_size, plain):
    rng = random.Random(3)
    want = {}
    for name in "pq":
        rows = [[str(k), cells(rng, plain), cells(rng, plain), "end"] for k in range(120)]
        path = tmp_path / f"{name}.csv"
        with path.open("w", encoding="utf-8-sig" if name == "q" else "utf-8", newline="") as f:
            w = csv.writer(f, lineterminator="\r\n" if name == "q" else "\n")
            w.writerow(["k", "x", "y y", "z"])
            w.writerows(rows)
        want[name] = [(k, x or None, y or None, z) for k, x, y, z in rows]
    several = 0
    for size in (64, 333, 1 << 20):
        split_size(size)
        df = read_csv(spark, str(tmp_path))
        several = max(several, df.select("_file_block").distinct().count())
        assert df.columns[:4] == ["k", "x", "y y", "z"]
        got = with_seq(df).orderBy("seq").collect()
        assert len({r.seq for r in got}) == 240
        for name in "pq":
            mine = [tuple(r[:5]) for r in (tuple(r[c] for c in ("k", "x", "y y", "z", "file")) for r in got) if r[4].endswith(f"{name}.csv")]
            assert [r[:4] for r in mine] == want[name], (size, name)
    assert several > 2
