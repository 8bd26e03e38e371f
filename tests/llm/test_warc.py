"""Archives against plain readers and a brute-force choice of revisits."""

import glob
import hashlib
import io
import random
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from strata.llm import warc
from tests.conftest import SMALL

PAGES = "page_id long, url string, html string"


def written(spark, rows, path, **options):
    frame = spark.createDataFrame(rows, PAGES).withColumns({n: F.lit("mine") for n in ("id", "key", "payload", "leader", "archive", "frame")})
    warc.write_archives(frame, path, **options)
    return warc.read_archives(spark, path)


def chosen(rows):
    """(id, size, digest, type, refers_to) page by page."""
    out = []
    for own, _, html in rows:
        body = (html or "").encode()
        equal = [i for i, _, h in rows if (h or "").encode() == body and i is not None]
        leader = max(equal, default=None)
        again = len(body) >= 1000 and leader is not None and leader != own
        out.append((own, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", leader if again else None))
    return sorted(out, key=str)


def found(frame):
    to = lambda v: None if v is None else int(v)
    return sorted(((to(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], to(r["refers_to"])) for r in frame.collect()), key=str)


def test_pages_come_back(spark, folder):
    draw = random.Random(5)
    body = lambda n: "".join(draw.choice("abc <p>é\n\r") for _ in range(n))
    shared, short, exact = body(3000), body(400), "x" * 1000
    rows = [(i, f"http://h/{i}", body(draw.randrange(0, 2500))) for i in range(60)]
    rows += [(100 + i, "http://copies/", shared) for i in range(25)] + [(200 + i, "u", short) for i in range(5)]
    rows += [(300, "a b\r\nX: y", exact), (301, None, exact), (302, "", "x" * 999), (303, "u", "x" * 999), (304, "u", None), (305, "u", ""), (306, "u", "z" * 300_000)]
    rows += [(None, "n", shared), (None, None, None), (None, "m", "q" * 2000), (None, "m", "q" * 2000), (307, "twice", "t" * 1500), (307, "twice", "t" * 1500)]
    back = written(spark, rows, folder + "/a", archive_bytes=40_000)
    assert found(back) == chosen(rows)
    html = {(r["page_id"], r["record_type"]): r["payload"] for r in back.collect()}
    assert html["306", "response"] == b"z" * 300_000 and html["301", "response"] == exact.encode() and html["300", "revisit"] is None
    assert back.filter("page_id = '300'").first()["target_uri"] == "a%20b%0D%0AX:%20y"
    assert back.filter("page_id = '301'").first()["target_uri"] == "about:blank"


def test_each_archive_stands_alone(spark, folder):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").repartition(2)
    warc.write_archives(pages, folder + "/a", archive_bytes=60_000)
    files, records = glob.glob(folder + "/a/**/part-*", recursive=True), 0
    assert len(files) > 2
    index = {(r["archive"], r["offset"]): r for r in warc.read_archives(spark, "file://" + folder + "/a").collect()}
    for name in files:
        data = open(name, "rb").read()
        magic, size = struct.unpack_from("<II", data, 0)
        assert magic == 0x184D2A5D
        # The dictionary frame, then frames that any reader decompresses in a row once it has the dictionary.
        dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
        plain = zstandard.ZstdDecompressor(dict_data=dictionary)
        whole = plain.stream_reader(io.BytesIO(data), read_across_frames=True).read()
        each = [record for _, _, record in warc.archive_records(data)]
        assert whole == b"".join(each) and each[0].startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        assert sum(len(r) for r in each) <= 60_000 or len(each) == 2
        for offset, length, record in list(warc.archive_records(data))[1:]:
            row = index["file:" + name, offset]
            assert plain.decompress(data[offset : offset + row["length"]]) == record and length == row["length"]
            records += 1
    assert records == pages.count() == len(index)


def test_a_dictionary_pays(spark):
    rows = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    held = [warc.page_record(str(r["page_id"]), r["url"], r["html"].encode(), "response", None, "2024-01-01T00:00:00Z") for r in rows]
    plain = sum(len(zstandard.ZstdCompressor(level=warc.LEVEL).compress(r)) for r in held)
    assert sum(map(len, archive := list(warc.archive_frames(held)))) < plain and len(archive) == len(held) + 1


def test_changed_bytes_are_refused():
    frames = list(warc.archive_frames([warc.page_record("1", "u", b"x" * 50, "response", None, "2024-01-01T00:00:00Z")]))
    data = bytearray(b"".join(frames))
    assert [r for _, _, r in warc.archive_records(bytes(data))]
    data[-6] ^= 1
    with pytest.raises((zstandard.ZstdError, ValueError)):
        list(warc.archive_records(bytes(data)))


def test_no_pages(spark, folder):
    assert written(spark, [], folder + "/a").collect() == []
    one = written(spark, [(1, "u", None)], folder + "/b")
    assert found(one) == [(1, 0, hashlib.sha1(b"").hexdigest(), "response", None)]
