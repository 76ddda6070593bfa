from __future__ import annotations

import base64
import hashlib
import random
import struct

import pytest
import zstandard

from promolens.llm import warc
from promolens.llm.common import checkpoint_folder
from promolens.llm.queries import QUERIES

COLUMNS = "page_id long, url string, html string, row string, first string, bundle string, sha1 string"
ODD = [(None, "u", "x"), (None, None, "x"), (3, None, None), (4, "a\r\nWARC-Type: x", ""), (5, "u", "same"), (5, "u", "same"), (2, "v", "same"), (9, "w", "same"), (6, "x", "é 日本 \r\n\r\n WARC/1.1 " * 9), (7, "y", "long " * 200_000)]


def plain(rows, least=0):
    """What every page must give, from sorting all of them."""
    first: dict = {}
    out = []
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        body = (html or "").encode()
        known = body in first and len(body) >= least
        out.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if known else "response", first[body] if known else None))
        first.setdefault(body, i)
    return sorted(out, key=repr)


def found(frame):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in frame.collect()), key=repr)


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], COLUMNS)


def many(n=400):
    rng = random.Random(21)
    texts = ["".join(rng.choice("abc <>é") for _ in range(rng.randrange(0, 3000))) for _ in range(n // 2)]
    rows = [(i, f"http://e.org/{i}", rng.choice(texts)) for i in range(n)]
    rng.shuffle(rows)
    return rows + [(n + k, None, "one text that a third of all pages share") for k in range(n // 2)]


@pytest.mark.parametrize("least", [0, 5, 2000])
def test_round_trip(spark, pages, least):
    rows = ODD + many()
    folder = checkpoint_folder(spark)
    index = warc.write(pages(rows), folder, least=least, frame=5000, bundle=20_000)
    assert found(warc.read(spark, folder, payloads=False)) == plain(rows, least)
    whole = warc.read(spark, folder).collect()
    texts: dict = {}
    for r in whole:
        assert (r.payload is None) == (r.record_type == "revisit")
        if r.payload is not None:
            texts.setdefault(r.page_id, []).append(bytes(r.payload))
    assert len({r.record_id for r in whole}) == len(rows) == index.count() and index.select("bundle").distinct().count() > 5
    want: dict = {}
    for i, _, html in rows:
        want.setdefault(i, set()).add((html or "").encode())
    assert all(set(bodies) <= want[i] for i, bodies in texts.items())
    assert "a%0D%0AWARC-Type:%20x" in {r.url for r in whole if r.page_id == 4}


def test_lookup_reads_the_asked_frames(spark, pages):
    folder = checkpoint_folder(spark)
    index = warc.write(pages(many()), folder, frame=5000, bundle=20_000)
    wanted = index.filter("page_id % 7 = 0").select("record_id")
    got = warc.lookup(index, folder, wanted.union(wanted).union(spark.createDataFrame([("urn:x-page:1:x",)], "record_id string"))).collect()
    whole = {r.record_id: r for r in warc.read(spark, folder).collect()}
    assert len(got) == wanted.count() and all(whole[r.record_id] == r for r in got)


def test_bundles_are_zstandard_and_seekable(spark, pages, tmp_path):
    index = warc.write(pages(many(60)).coalesce(1), str(tmp_path / "a"), frame=5000)
    for name in {r.bundle for r in index.collect()}:
        data = (tmp_path / "a" / "bundles" / name).read_bytes()
        text = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        places = [at for _, _, at in warc.parse(text)]
        count, _, magic = struct.unpack("<IBI", data[-9:])
        assert magic == 0x8F92EAB1 and count > 3 and len(places) == index.filter(index.bundle == name).count()
        reader = warc.BundleReader(str(tmp_path / "a" / "bundles"), name)
        assert b"".join(map(reader.frame, range(count))) == text
        for r in index.collect():
            assert reader.frame(r.frame)[r.offset :].startswith(b"WARC/1.1") and r.length > 0
    with pytest.raises(ValueError, match="payload"):
        list(warc.parse(warc.record(1, 1, None, b"abc", hashlib.sha1(b"abc").hexdigest(), None, "x").replace(b"abc", b"abd")))


def test_empty(spark, pages):
    folder = checkpoint_folder(spark)
    assert warc.write(pages([]), folder).count() == 0 and warc.read(spark, folder).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html").collect()]
    assert found(QUERIES["op11_warc"](spark, folder)) == plain(rows)
