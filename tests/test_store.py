"""Versions of tables, and answers that survive a stopped run."""

import pytest

from sitefold.operators import geocode
from sitefold.plans.store import Conflict, Table


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def held(df):
    return sorted(r.v for r in df.collect())


def test_a_reader_keeps_its_version_and_one_writer_wins(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    assert not table.versioned and table.read() is None and table.manifest() == (0, {})
    assert table.commit(table.write(rows(spark, 1, 2)), 0) == 1
    reader = table.read()
    slow, quick = table.write(rows(spark, 3)), Table(spark, str(tmp_path / "t"))
    assert held(table.read()) == [1, 2]  # written, but in no version
    assert quick.commit(quick.write(rows(spark, 4)), 1) == 2
    assert held(reader) == [1, 2] and held(table.read()) == [4] and held(table.read(1)) == [1, 2]
    with pytest.raises(Conflict):
        table.commit(slow, 1)
    assert held(table.read()) == [4]
    # Both look before either creates: creation itself fails for the second.
    late = Table(spark, str(tmp_path / "t"))
    late.manifest = lambda version=None: (1, {})
    with pytest.raises(Conflict):
        late.commit(slow, 1)
    (tmp_path / "t" / "_versions" / "00000003.json").write_text('{"": "da')  # a manifest half written
    assert held(table.read()) == [4]


def test_parts_and_vacuum(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    some = spark.createDataFrame([("a:b", 1), ("c", 2), ("c", 3)], "k string, v int")
    table.commit(table.write(some, "k"), 0)
    assert {*table.manifest()[1]} == {"a:b", "c"} and table.read().columns == ["k", "v"]
    table.commit(table.write(some.where("v = 3"), "k"), 1)
    assert held(table.read()) == [1, 3]
    table.commit({}, 2, gone={"a:b"})
    assert held(table.read()) == [3] and table.write(some.limit(0), "k") == {}
    table.vacuum(keep=1)
    assert table._versions() == [3] and held(table.read()) == [3]


def test_a_stopped_lane_loses_one_round_at_most(spark, tmp_path):
    index = spark.createDataFrame([(f"v2|q|{k}", f"k{k}", k, "QQ", f"s{k}", "c", "p") for k in range(23)], "qkey string, key string, seq bigint, iso2 string, street string, city string, postcode string")
    asked = tmp_path / "asked"

    def provider(parts, stop=None):
        with open(asked, "a") as f:
            f.write(parts["qkey"] + "\n")
        if stop is not None and parts["qkey"].endswith(f"|{stop}"):
            import os

            os._exit(1)  # the worker dies
        return {"lat": 1.0, "lon": 2.0, "precision": "street", "provider": "p"} if parts["street"] else None

    table = Table(spark, str(tmp_path / "cache"))
    with pytest.raises(Exception):
        geocode.ask(table, index, lambda p: provider(p, stop=13), lanes=2, each=3)
    answered = table.read_log(0).count()
    assert 12 <= answered + 2 * 3 and answered >= 6 and table.read() is None  # whole rounds only
    before = asked.read_text().splitlines()
    cache = geocode.ask(table, index, provider, lanes=2, each=3)
    assert cache.count() == 23 and cache.where("tries <> 1").count() == 0
    again = asked.read_text().splitlines()[len(before) :]
    assert len(again) == 23 - answered  # what the log had is not asked once more
    assert table.manifest()[0] == 2 and geocode.ask(table, index, provider).count() == 23 and table.manifest()[0] == 2
