import base64
import hashlib
import io
import zipfile

import duckdb
import pytest

from seriesloom.llm import warc as W
from seriesloom.llm.base import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


def test_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    cur = con.execute(ORACLES["op8_warc"])
    names = [d[0] for d in cur.description]
    got = QUERIES["op8_warc"](spark, SF)
    assert sorted(map(tuple, got.select(names).collect())) == sorted(cur.fetchall())


def test_revisits_and_cases(spark, tmp_path):
    rows = [
        (1, "http://a/1", "same"), (5, "http://a/5", "same"), (3, None, "same"), (2, "u", None), (4, "u", ""),
        (7, "u", "own\r\n\r\nbody é"), (7, "u", "own\r\n\r\nbody é"), (None, "u", "same"), (9, "u", "x" * 3_000_000),
    ]
    df = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, record_type string")
    root = str(tmp_path / "out")
    got = W.read_records(W.write_packages(df, root, package_bytes=400), root).collect()
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        top = max((k for k, _, h in rows if (h or "") == (html or "") and k is not None))
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want.append((i, len(raw), digest, "response" if i == top else "revisit", None if i == top else top))
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    none = W.write_packages(df.limit(0), str(tmp_path / "none"))
    assert none.count() == 0 and W.read_records(none, root).count() == 0


@pytest.mark.parametrize("zip64", [False, True])
def test_directories(zip64):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name in ("a", "dir/b"):
            with z.open(name, "w", force_zip64=zip64) as f:
                f.write(name.encode() * 5)
        z.comment = b"PK comment"
    raw = out.getvalue()
    if zip64:  # a ZIP64 end record and locator before the plain end
        import struct

        end = raw.rfind(b"PK\x05\x06")
        count, size, start = struct.unpack_from("<HII", raw, end + 10)
        record = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, count, count, size, start)
        locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, end, 1)
        tail = raw[end : end + 8] + struct.pack("<HHII", 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF) + raw[end + 20 :]
        raw = raw[:end] + record + locator + tail
    f = io.BytesIO(raw)
    members = W.central_directory(f, len(raw))
    assert [m.name for m in members] == ["a", "dir/b"]
    for m in members:
        at = W.data_offset(f, m)
        assert raw[at : at + m.stored_size] == m.name.encode() * 5
    with pytest.raises(ValueError):
        W.central_directory(io.BytesIO(b"no zip"), 6)


def test_compressed_members_are_refused():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", "x" * 100)
    f = io.BytesIO(out.getvalue())
    with pytest.raises(ValueError):
        W.data_offset(f, W.central_directory(f, len(out.getvalue()))[0])
