"""Damaged files of every codec, and what is kept and set aside of them."""

import bz2
import gzip
import os
import zlib

import pytest
import zstandard
from pyspark.sql import types as T

from trendlake.sources import quarantine as qr

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.StringType())])
PACK = {"gz": gzip.compress, "bz2": bz2.compress, "zst": zstandard.ZstdCompressor(write_checksum=True).compress, "deflate": zlib.compress}


def text(n, first=0):
    return "".join(f'{{"id":{first + i},"s":"x{i * 7919}"}}\n' for i in range(n)).encode()


@pytest.mark.parametrize("codec", PACK)
def test_whole_streams_come_back_and_damaged_ones_raise(codec):
    data = text(30_000)
    packed = PACK[codec](data)
    pieces = list(qr.inflated(codec, packed))
    assert b"".join(pieces) == data
    if codec != "zst":
        assert max(map(len, pieces)) <= qr.PIECE
    assert b"".join(qr.inflated(codec, packed + PACK[codec](b"more"))) == data + b"more"  # several members
    for broken in (packed[:-1], packed[: len(packed) // 2], packed[:5], b"", b"plain text", packed[:100] + b"\0" * 400 + packed[500:]):
        with pytest.raises(ValueError):
            b"".join(qr.inflated(codec, broken))


def test_streams_without_a_decoder_raise():
    with pytest.raises(ValueError, match="no decoder"):
        list(qr.inflated("lz4", b"abc"))


def test_lines_do_not_depend_on_the_pieces():
    data = b"a\nbb\r\n\r\nccc\rdd\n\n" + b"e" * 50 + b"\r"
    want = data.splitlines()
    for n in (1, 2, 3, 7, 100):
        assert list(qr.lines(data[i : i + n] for i in range(0, len(data), n))) == want
    assert list(qr.lines([])) == []


def test_every_file_is_accounted_for(spark, tmp_path):
    def put(name, data):
        os.makedirs(os.path.dirname(tmp_path / name), exist_ok=True)
        (tmp_path / name).write_bytes(data)

    for k, (codec, pack) in enumerate(PACK.items()):
        put(f"day=1/whole.json.{codec}", pack(text(500, 1000 * k)))
        put(f"day=2/half.json.{codec}", pack(text(20_000))[: -200])
    put("day=1/plain.json", text(40, 9000) + b'{"id": 1, "s": "cut of')
    put("day=2/more.txt", b'\n  \n{"id":9100,"s":"\xff"}\n{"id":9101}\r\n{"id":"no number"}\n')
    put("day=3/odd.snappy", b"abc")
    put("day=3/without_name", text(3))
    rows, bad = qr.read_with_quarantine(spark, str(tmp_path), SCHEMA)
    ids = sorted(r.id for r in rows.collect())
    assert ids == sorted([1000 * k + i for k in range(4) for i in range(500)] + list(range(9000, 9040)) + [9101])
    report = {os.path.basename(r.file): (r.kept, r.malformed, r.damaged) for r in qr.landing_report(rows, bad).collect()}
    want = {f"whole.json.{c}": (500, 0, False) for c in PACK} | {f"half.json.{c}": (0, 0, True) for c in PACK}
    assert report == want | {"plain.json": (40, 1, False), "more.txt": (1, 2, False), "odd.snappy": (0, 0, True), "without_name": (0, 0, True)}
    lost = {os.path.basename(r.file): r.lines for r in bad.where("kind = 'file'").collect()}
    assert 0 < lost["half.json.gz"] < 20_000 and lost["without_name"] is None
    empty = tmp_path / "empty"
    empty.mkdir()
    rows, bad = qr.read_with_quarantine(spark, str(empty), SCHEMA)
    assert rows.count() == bad.count() == 0
