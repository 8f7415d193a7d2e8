import hashlib
import io
import zlib

import pytest

from llm_helpers import SF
from weeklens.llm import warc
from weeklens.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string"


def brute(rows, least=1000):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if j is not None and (h or "").encode() == data]
        first = max(same) if same and len(data) >= least else i
        again = first != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def digest(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_whole_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert digest(QUERIES["op10_warc"](spark, SF)) == brute(rows)


def test_edge_rows(spark):
    big, other = "<p>é</p>" * 200, "x" * 1000
    rows = [(1, "http://a/", big), (9, "http://a b/\r\nX: y", big), (4, None, big), (2, "u", "short"), (3, "u", "short"), (5, "u", None),
            (6, "", ""), (None, "n", big), (7, "u", other), (7, "u", other), (8, "u", "y" * 3_000_000), ((1 << 62) + 1, "u", "\r\n\r\n")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as payload", "'y' as sha", "'z' as name")
    assert digest(warc.archive_round_trip(df)) == brute(rows)


def test_archives_hold_what_was_written(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"page {i % 40} " * 300) for i in range(100)]
    manifest = warc.write_archives(spark.createDataFrame(rows, SCHEMA), str(tmp_path), archive_bytes=4000)
    files = manifest.collect()
    assert sum(r["records"] for r in files) == 100 and len(files) > 4
    assert sum(r["bytes"] for r in files) == sum((tmp_path / r["path"].rsplit("/")[-1]).stat().st_size for r in files)
    got = {r["page_id"]: r for r in warc.read_archives(manifest).collect()}
    for i, url, html in rows:
        assert got[i]["url"] == url and got[i]["record_type"] == ("response" if i >= 60 else "revisit")
        assert got[i]["payload"] is None if i < 60 else bytes(got[i]["payload"]) == html.encode()
        assert i >= 60 or got[got[i]["refers_to"]]["payload_digest"] == got[i]["payload_digest"]


def test_empty_table(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


class Trickle(io.BytesIO):
    def read(self, n=-1):
        return super().read(7)


def members(n=3):
    return [warc.build_record(i, "http://h/", b"payload %d" % i * 50, False, None) for i in range(n)]


def test_reader_is_incremental():
    got = list(warc.read_records(Trickle(b"".join(members()))))
    assert [r["page_id"] for r in got] == [0, 1, 2] and got[2]["payload"] == b"payload 2" * 50
    assert list(warc.read_records(io.BytesIO(b""))) == []


def repacked(change):
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(change(zlib.decompress(members(1)[0], 31))) + z.flush()


@pytest.mark.parametrize("data", [
    repacked(lambda x: x.replace(b"payload 0pay", b"payload 1pay")),  # digest
    repacked(lambda x: x[:-4]),  # no end of the record
    repacked(lambda x: x + b"more"),
    repacked(lambda x: x.replace(b"Content-Length: ", b"Content-Length: 1", 1)),
    repacked(lambda x: b"HTTP" + x),
    b"".join(members())[:-9],  # cut short
])
def test_corrupt_archives_are_refused(data):
    with pytest.raises((warc.CorruptRecord, zlib.error)):
        list(warc.read_records(io.BytesIO(data)))
