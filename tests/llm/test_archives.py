import io
import zipfile

import pytest
from pyspark.sql import types as T

from sievemill.llm import archives as A

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("path", T.StringType()), T.StructField("payload_key", T.StringType())])


def package(members):
    out = io.BytesIO()
    w = A.PackageWriter(out)
    for name, chunks in members:
        w.member(name, iter(chunks))
    w.close()
    return out.getvalue()


def test_others_read_what_we_write():
    raw = package([("archive/a", [b"xy", b"z"]), ("indexes/b", [])])
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        assert z.testzip() is None and z.read("archive/a") == b"xyz" and z.read("indexes/b") == b""


def test_we_read_what_others_write():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr("archive/data.warc.gz", b"0123456789")
        with z.open("indexes/index.cdxj", "w", force_zip64=True) as f:
            f.write(b"1 2 3 data.warc.gz\nk 5 4 data.warc.gz\n")
        z.writestr("deflated", b"a" * 100, zipfile.ZIP_DEFLATED)
        z.comment = b"PK\x05\x06 a comment that looks like an end"
    raw = out.getvalue()
    r = A.PackageReader(io.BytesIO(raw), len(raw))
    assert [m.name for m in r.members] == ["archive/data.warc.gz", "indexes/index.cdxj"]
    assert [r.read(p, n) for p, n in r.index()] == [b"234", b"5678"]


def test_wide_offsets(monkeypatch):
    monkeypatch.setattr(A, "FULL32", 40)  # as if 40 bytes were 4 GB
    raw = package([("archive/a", [b"x" * 100]), ("archive/b", [b"y" * 50])])
    r = A.PackageReader(io.BytesIO(raw), len(raw))
    assert [r.read(r.data_start(m), m.size) for m in r.members] == [b"x" * 100, b"y" * 50]


def test_damage_is_an_error():
    raw = package([("archive/a", [b"xyz"])])
    for bad in (b"", raw[:-5], b"no zip at all", raw[:10]):
        with pytest.raises(ValueError):
            A.PackageReader(io.BytesIO(bad), len(bad))


def test_records_round_trip():
    payload = "é\r\n\r\n<p>".encode()
    got = A.parse_record(A.record(7, "http://a\r\nX: y", payload, A.base32_sha1(payload), None))
    assert got["payload"] == payload and got["headers"]["WARC-Type"] == "response" and "X" not in got["headers"]
    got = A.parse_record(A.record(7, "", payload, A.base32_sha1(payload), 9))
    assert got["payload"] == b"" and got["http"]["Content-Length"] == str(len(payload)) and got["headers"]["WARC-Refers-To"] == "<urn:x-page:9>"


def want(rows, least=0):
    best = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= least:
            best[h or ""] = max(i, best.get(h or "", i))
    out = []
    for i, u, h in rows:
        p = (h or "").encode()
        top = best.get(h or "", i) if i is not None and len(p) >= least else i
        out.append((i, u or "", len(p), A.base32_sha1(p), "response" if top == i else "revisit", None if top == i else top))
    return sorted(out, key=str)


ROWS = [(1, "http://a", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (3, None, None), (4, "u", ""), (5, "u", "é" * 70000), (None, "n", "<p>x</p>"), (6, "v", "only"), (6, "v", "only"), (2, "w", "other")] + [(100 + i, f"http://h/{i}", "hot") for i in range(300)]


@pytest.mark.parametrize("least", [0, 5])
def test_pages_come_back(spark, least):
    pages = spark.createDataFrame([(*r, "p", "k") for r in ROWS], SCHEMA).repartition(3)
    got = [tuple(r) for r in A.read_packages(*A.write_packages(pages, least)).collect()]
    assert sorted(got, key=str) == want(ROWS, least)


def test_packages_roll_over(spark, monkeypatch):
    monkeypatch.setattr(A, "ROLL", 2000)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in ROWS[9:60]]), pa.array(["u"] * 51), pa.array(["h"] * 51), pa.nulls(51, pa.int64())], names=["a", "b", "c", "d"])
    made = list(A._write(A.qualified(spark, A.new_path(spark, "rolled")))(iter([batch])))
    assert len(made) > 2 and sum(b.column(1)[0].as_py() for b in made) == 51


def test_query(spark, sf):
    rows = [(r.page_id, None, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    got = sorted(((r.page_id, "", r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in A.op9_zip_warc(spark, sf).collect()), key=str)
    assert got == want(rows)


def test_empty(spark):
    assert A.read_packages(*A.write_packages(spark.createDataFrame([], SCHEMA))).count() == 0


def test_paths_are_those_of_the_cluster(spark, tmp_path):
    assert A.qualified(spark, str(tmp_path)) == f"file://{tmp_path}" == A.qualified(spark, f"file:{tmp_path}") == A.qualified(spark, f"file://{tmp_path}")
    with pytest.raises(Exception):  # noqa: B017
        A.qualified(spark, "viewfs://nowhere/x")
