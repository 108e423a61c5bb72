import glob
import gzip
import hashlib
import http.client
import io
import zlib

from sitefold.llm import warc


def zlib_member(raw):
    squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
    return squeeze.compress(raw) + squeeze.flush()


class FakeSocket:
    def __init__(self, data):
        self.data = data

    def makefile(self, *_):
        return io.BytesIO(self.data)


def test_round_trip_and_revisits(spark, tmp_path):
    big, other = "x" * 1500 + "é", "y" * 999
    rows = [(1, "http://a/", big), (2, "http://b/\r\nX: y", big), (5, None, big), (3, "u", other), (4, "u", other), (6, "u", None), (7, "u", ""), (None, "n", big), (5, "again", big), (8, "u", "a\r\n\r\nb")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'clash' AS payload_digest")
    folder = str(tmp_path / "warc")
    index = warc.write(warc.plan(pages), folder)
    got = warc.read(index, folder).collect()
    assert len(got) == len(rows) == index.count()
    html = {1: big, 2: big, 5: big, 3: other, 4: other, 6: "", 7: "", None: big, 8: "a\r\n\r\nb"}
    for x in got:
        body = html[x.page_id].encode()
        assert (x.payload_bytes, x.payload_digest) == (len(body), hashlib.sha1(body).hexdigest())
        assert (x.record_type, x.refers_to) == (("revisit", 5) if x.page_id in (1, 2, None) else ("response", None))
        assert x.payload == (None if x.record_type == "revisit" else body)
    ids = {}
    for f in glob.glob(f"{folder}/*.warc.gz"):
        for member in gzip.open(f).read().split(b"WARC/1.1\r\n")[1:]:
            fields, _ = warc.parse(zlib_member(b"WARC/1.1\r\n" + member))
            ids.setdefault(fields["warc-record-id"], []).append(fields)
    assert len(ids) == len(rows) - 1  # the two equal rows of page 5 share theirs
    for fields in [x for same in ids.values() for x in same]:
        if fields["warc-type"] == "revisit":  # refers to a record that is there
            assert ids[fields["warc-refers-to"]][0]["x-page-id"] == fields["x-refers-to-page-id"] == "5"
    some = warc.read(index.where("page_id IN (3, 8)"), folder).collect()
    assert sorted(x.page_id for x in some) == [3, 8]
    assert warc.read(warc.write(warc.plan(pages.limit(0)), folder), folder).count() == 0


def test_archives_are_cut_and_are_standard_gzip(spark, tmp_path):
    pages = spark.createDataFrame([(k, "u", f"{k} " * 2000) for k in range(20)], "page_id long, url string, html string").coalesce(1)
    folder = str(tmp_path / "w")
    index = warc.write(warc.plan(pages), folder, most=200)
    assert warc.read(index, folder).count() == 20
    files = glob.glob(f"{folder}/*.warc.gz")
    for f in files:
        for member in gzip.open(f).read().split(b"WARC/1.1\r\n")[1:]:
            fields, _, block = member.partition(b"\r\n\r\n")
            response = http.client.HTTPResponse(FakeSocket(block))
            response.begin()
            html = response.read()
            assert response.status == 200 and html.split()[0] * 2000 == html.replace(b" ", b"") and block.endswith(html + b"\r\n\r\n")
    assert len(files) > 1 and sum(gzip.open(f).read().count(b"WARC/1.1\r\n") for f in files) == 20
