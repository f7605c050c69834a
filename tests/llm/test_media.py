import gzip
import hashlib
import io
import struct
import time
import zipfile
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.llm import media

from .common import awkward, frame


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=300), st.sampled_from(["png", "bmp", "wav", "au"]))
def test_round_trip(text, kind):
    raw = text.encode()
    payload = raw + bytes(-len(raw) % 64 if raw else 64)
    stored = media.store(payload, kind)
    assert media.load(stored, kind) == payload
    assert media.sniff(stored) == [(kind, 0, len(stored))]
    assert media.sniff(b"BM RIFF .snd" + stored + b"GIF89a") == [(kind, 12, len(stored))]


def test_other_formats():
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("a", "b")
    gif = b"GIF89a\x01\x00\x01\x00\x80\x00\x00\x00\x00\x00\xff\xff\xff,\x00\x00\x00\x00\x01\x00\x01\x00\x00\x02\x02D\x01\x00;"
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xda\x00\x02data\xff\x00more\xff\xd9"
    pdf = b"%PDF-1.4\nbody\nstartxref\n9\n%%EOF"
    for kind, blob in (("gzip", gzip.compress(b"x" * 500)), ("zip", z.getvalue()), ("gif", gif), ("jpeg", jpeg), ("pdf", pdf)):
        assert media.sniff(b"junk" + blob + b"tail") == [(kind, 4, len(blob))]
        assert media.sniff(blob[: len(blob) // 2]) == []
    assert media.sniff(None) == media.sniff(b"") == media.sniff(b"plain BM text RIFF") == []


def test_containers():
    webp = b"RIFF" + struct.pack("<I", 4 + 8 + 6) + b"WEBPVP8L" + struct.pack("<I", 5) + b"abcde\0"
    page = lambda flags, data: b"OggS\0" + bytes([flags]) + bytes(8) + b"\1\2\3\4" + bytes(8) + bytes([1, len(data)]) + data
    ogg = page(2, b"head") + page(0, b"body" * 9) + page(4, b"end")
    box = lambda kind, data: struct.pack(">I", 8 + len(data)) + kind + data
    mp4 = box(b"ftyp", b"isom\0\0\0\0") + box(b"mdat", b"x" * 40) + box(b"moov", b"y" * 12)
    entry = lambda tag, kind, n, v: struct.pack("<HHII", tag, kind, n, v)
    tiff = b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", 3) + entry(256, 3, 1, 4) + entry(273, 4, 1, 50) + entry(279, 4, 1, 16) + struct.pack("<I", 0) + b"p" * 16
    for kind, blob in (("webp", webp), ("ogg", ogg), ("mp4", mp4), ("tiff", tiff)):
        assert media.sniff(b"junk" + blob + b"tail") == [(kind, 4, len(blob))], kind
        assert media.sniff(blob[: len(blob) // 2]) == []


def test_many_chance_hits_take_linear_time():
    for magic, kind, _ in media.MAGICS:
        if kind != "gzip":
            began = time.time()
            media.sniff((magic + b"PK\x05\x06") * 60_000)
            assert time.time() - began < 5, kind


def test_broken_png_is_dropped_and_types_are_corrected():
    png = media.store(bytes(64), "png")
    assert media.sniff(png[:40] + b"\x01" + png[41:]) == []
    assert media.true_type(png, "image/gif") == "image/png" and media.true_type(b"text", "text/plain") == "text/plain"


def test_frame(spark):
    rows = awkward()
    got = sorted(((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in media.text_media(frame(spark, rows)).collect()), key=str)

    def want(d, t):
        raw = (t or "").encode()
        p = raw + bytes(-len(raw) % 64 if raw else 64)
        return d, len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])

    assert got == sorted((want(r[0], r[1]) for r in rows), key=str)
    by_text = {}
    ids = {r[0]: r[1] or "" for r in rows if r[0] is not None}
    for r in media.text_media(frame(spark, rows)).where("doc_id is not null").collect():
        assert by_text.setdefault(ids[r["doc_id"]], (r["media_sha256"], r["feature"])) == (r["media_sha256"], r["feature"])
    assert media.text_media(frame(spark, [])).count() == 0


def test_sniffed_columns(spark):
    png = media.store(bytes(64), "png")
    f = spark.createDataFrame([(1, bytearray(png), "image/gif"), (2, bytearray(b"x" + png), "text/html"), (3, None, "text/plain")], "k int, b binary, d string")
    got = {r["k"]: r for r in media.sniffed(f, "b", "d").collect()}
    assert got[1]["media_type"] == "image/png" and got[2]["media_type"] == "text/html" and got[3]["media_type"] == "text/plain"
    assert bytes(got[2]["media"][0]["bytes"]) == png and got[3]["media"] == []


def test_unknown_format():
    with pytest.raises(ValueError):
        media.store(b"", "tiff")
