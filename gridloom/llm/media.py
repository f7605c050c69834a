"""Media columns: what a binary column really holds, by signature sniffing.

An Aho-Corasick automaton finds every known magic number in one pass over the bytes; a validator for each format
then confirms structure and lengths from the found place, so that a chance match of a short magic is dropped.
The media found give the true type, correct a wrongly declared one, and carve media that stand inside other bytes.
"""

import hashlib
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops

# Magic numbers, the formats that have them, and how many bytes of the format stand before them.
MAGICS = [
    (b"\x89PNG\r\n\x1a\n", "png", 0),
    (b"\xff\xd8\xff", "jpeg", 0),
    (b"GIF87a", "gif", 0),
    (b"GIF89a", "gif", 0),
    (b"BM", "bmp", 0),
    (b"RIFF", "riff", 0),
    (b".snd", "au", 0),
    (b"\x1f\x8b\x08", "gzip", 0),
    (b"PK\x03\x04", "zip", 0),
    (b"%PDF-", "pdf", 0),
    (b"II*\x00", "tiff", 0),
    (b"MM\x00*", "tiff", 0),
    (b"OggS", "ogg", 0),
    (b"ftyp", "mp4", 4),
]
# Marks that end or close a format.
MARKS = [(b"startxref", "xref"), (b"%%EOF", "eof"), (b"PK\x05\x06", "zip end")]
MIME = {
    "png": "image/png", "jpeg": "image/jpeg", "gif": "image/gif", "bmp": "image/bmp", "tiff": "image/tiff", "webp": "image/webp", "wav": "audio/wav", "au": "audio/basic", "ogg": "application/ogg",
    "mp4": "video/mp4", "gzip": "application/gzip", "zip": "application/zip", "pdf": "application/pdf",
}


class Media(NamedTuple):
    kind: str
    start: int
    length: int


def _png(b: memoryview, at: int) -> int | None:
    p, first = at + 8, True
    while p + 12 <= len(b):
        size, kind = struct.unpack_from(">I4s", b, p)
        if p + 12 + size > len(b) or first != (kind == b"IHDR"):
            return None
        if zlib.crc32(b[p + 4 : p + 8 + size]) != struct.unpack_from(">I", b, p + 8 + size)[0]:
            return None
        p, first = p + 12 + size, False
        if kind == b"IEND":
            return p - at
    return None


def _jpeg(b: memoryview, at: int) -> int | None:
    blob, p = b.obj, at + 2
    while p + 4 <= len(b):
        if b[p] != 0xFF:
            return None
        code = b[p + 1]
        if code == 0xD9:
            return p + 2 - at
        if code in (0x01, 0xFF) or 0xD0 <= code <= 0xD8:
            p += 1 if code == 0xFF else 2
            continue
        size = struct.unpack_from(">H", b, p + 2)[0]
        if size < 2 or code < 0xC0:
            return None
        p += 2 + size
        if code == 0xDA:  # entropy-coded data up to the next marker that is no restart and no stuffed byte
            q = blob.find(b"\xff", p)
            while q >= 0 and q + 1 < len(b) and (b[q + 1] == 0 or 0xD0 <= b[q + 1] <= 0xD7):
                q = blob.find(b"\xff", q + 2)
            if q < 0:
                return None
            p = q
    return p + 2 - at if p + 2 <= len(b) and b[p] == 0xFF and b[p + 1] == 0xD9 else None


def _gif(b: memoryview, at: int) -> int | None:
    def blocks(p: int) -> int:
        while p < len(b) and b[p]:
            p += 1 + b[p]
        return p + 1

    if at + 13 > len(b):
        return None
    flags = b[at + 10]
    p = at + 13 + (3 << ((flags & 7) + 1) if flags & 0x80 else 0)
    while p < len(b):
        if b[p] == 0x3B:
            return p + 1 - at
        if b[p] == 0x21:
            p = blocks(p + 2)
        elif b[p] == 0x2C and p + 10 <= len(b):
            own = b[p + 9]
            p = blocks(p + 11 + (3 << ((own & 7) + 1) if own & 0x80 else 0))
        else:
            return None
    return None


def _bmp(b: memoryview, at: int) -> int | None:
    if at + 54 > len(b):
        return None
    size, reserved, offset, head, width, height, planes, depth, packed = struct.unpack_from("<IIIIiiHHI", b, at + 2)
    if reserved or head not in (40, 52, 56, 108, 124) or planes != 1 or depth not in (1, 4, 8, 16, 24, 32) or width <= 0 or packed:
        return None
    need = offset + (width * depth + 31) // 32 * 4 * abs(height)
    return size if offset >= 14 + head and need == size and at + size <= len(b) else None


def _riff(b: memoryview, at: int) -> tuple[str, int] | None:
    """A sound (chunks of format and data) or a picture in the same container."""
    if at + 12 > len(b):
        return None
    form, end = bytes(b[at + 8 : at + 12]), at + 8 + struct.unpack_from("<I", b, at + 4)[0]
    p, seen = at + 12, set()
    if form not in (b"WAVE", b"WEBP") or end > len(b):
        return None
    while p + 8 <= end:
        kind, size = struct.unpack_from("<4sI", b, p)
        seen.add(kind)
        p += 8 + size + size % 2
    if p != end:
        return None
    if form == b"WAVE":
        return ("wav", end - at) if {b"fmt ", b"data"} <= seen else None
    return ("webp", end - at) if seen & {b"VP8 ", b"VP8L", b"VP8X"} else None


def _tiff(b: memoryview, at: int) -> int | None:
    """Walks the directories; the picture ends with the last of its directories, values and strips or tiles."""
    order = "<" if b[at] == 0x49 else ">"
    sizes, end, seen = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}, 8, set()
    if at + 8 > len(b):
        return None
    p = struct.unpack_from(order + "I", b, at + 4)[0]
    while p:
        if p in seen or p < 8 or at + p + 2 > len(b):
            return None
        seen.add(p)
        n = struct.unpack_from(order + "H", b, at + p)[0]
        if not n or at + p + 6 + 12 * n > len(b):
            return None
        values: dict[int, tuple[int, ...]] = {}
        for k in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", b, at + p + 2 + 12 * k)
            size = sizes.get(kind, 0) * count
            if not size:
                return None
            place = p + 2 + 12 * k + 8 if size <= 4 else struct.unpack_from(order + "I", b, at + p + 2 + 12 * k + 8)[0]
            if at + place + size > len(b):
                return None
            end = max(end, place + size)
            if tag in (273, 279, 324, 325) and kind in (3, 4):
                values[tag] = struct.unpack_from(order + str(count) + ("H" if kind == 3 else "I"), b, at + place)
        for starts, lengths in ((273, 279), (324, 325)):
            for a, length in zip(values.get(starts, ()), values.get(lengths, ()), strict=False):
                if at + a + length > len(b):
                    return None
                end = max(end, a + length)
        end = max(end, p + 6 + 12 * n)
        p = struct.unpack_from(order + "I", b, at + p + 2 + 12 * n)[0]
    return end if seen else None


def _ogg(b: memoryview, at: int) -> int | None:
    """Pages of one stream, from the one that begins it to the one that ends it."""
    p, serial = at, None
    while p + 27 <= len(b) and bytes(b[p : p + 5]) == b"OggS\0":
        flags, own, n = b[p + 5], bytes(b[p + 14 : p + 18]), b[p + 26]
        if p + 27 + n > len(b) or (serial is None) != bool(flags & 2) or serial not in (None, own):
            return None
        serial = own
        p += 27 + n + sum(b[p + 27 : p + 27 + n])
        if flags & 4:
            return p - at if p <= len(b) else None
    return None


def _mp4(b: memoryview, at: int) -> int | None:
    """Boxes one after the other, as long as their kinds are known, with a movie among them."""
    p, seen = at, set()
    while p + 8 <= len(b):
        size, kind = struct.unpack_from(">I4s", b, p)
        head = 8
        if size == 1 and p + 16 <= len(b):
            size, head = struct.unpack_from(">Q", b, p + 8)[0], 16
        if kind not in (b"ftyp", b"moov", b"mdat", b"free", b"skip", b"moof", b"mfra", b"sidx", b"uuid", b"wide", b"meta", b"styp") or size < head or p + size > len(b):
            break
        seen.add(kind)
        p += size
    return p - at if {b"ftyp", b"moov"} <= seen else None


def _au(b: memoryview, at: int) -> int | None:
    if at + 24 > len(b):
        return None
    offset, size, coding, rate, channels = struct.unpack_from(">IIIII", b, at + 4)
    ok = offset >= 24 and 1 <= coding <= 27 and rate and 1 <= channels <= 256 and size != 0xFFFFFFFF and at + offset + size <= len(b)
    return offset + size if ok else None


def _gzip(b: memoryview, at: int) -> int | None:
    d = zlib.decompressobj(31)
    try:
        p = at
        while p < len(b) and not d.eof:
            d.decompress(bytes(b[p : p + 65536]))
            p += 65536
    except zlib.error:
        return None
    return min(p, len(b)) - len(d.unused_data) - at if d.eof else None


def _zip_starts(b: memoryview, ends: list[int]) -> dict[int, int]:
    """Where the archives start that the end records found close, and where they end; the first record of a start counts."""
    out: dict[int, int] = {}
    for p in ends:
        if p + 22 <= len(b):
            size, offset, note = struct.unpack_from("<IIH", b, p + 12)
            at = p - size - offset
            if at >= 0 and bytes(b[at + offset : at + offset + 4]) == b"PK\x01\x02" and p + 22 + note <= len(b):
                out.setdefault(at, p + 22 + note)
    return out


def _next(places: list[int], at: int) -> int | None:
    k = bisect_left(places, at)
    return places[k] if k < len(places) else None


_CHECK = {"png": _png, "jpeg": _jpeg, "gif": _gif, "bmp": _bmp, "au": _au, "gzip": _gzip, "tiff": _tiff, "ogg": _ogg, "mp4": _mp4}


@cache
def _automaton():
    import ahocorasick

    out = ahocorasick.Automaton()
    for magic, kind, before in MAGICS:
        out.add_word(magic.decode("latin-1"), (kind, len(magic) + before, True))
    for mark, kind in MARKS:
        out.add_word(mark.decode("latin-1"), (kind, len(mark), False))
    out.make_automaton()
    return out


def sniff(blob: bytes | None) -> list[Media]:
    """The media in a blob in order of place; what stands inside confirmed media is part of them. Null and empty: none."""
    found: list[Media] = []
    if not blob:
        return found
    blob = bytes(blob)
    view, end = memoryview(blob), 0
    hits: list[tuple[int, str]] = []
    marks: dict[str, list[int]] = {kind: [] for _, kind in MARKS}
    for last, (kind, size, starts) in _automaton().iter(blob.decode("latin-1")):
        if starts:
            hits.append((last - size + 1, kind))
        else:
            marks[kind].append(last - size + 1)
    archives = _zip_starts(view, marks["zip end"])
    for at, kind in sorted(h for h in hits if h[0] >= 0):
        if at < end:
            continue
        length = None
        if kind == "riff":
            kind, length = _riff(view, at) or (kind, None)
        elif kind == "zip":
            length = archives[at] - at if at in archives else None
        elif kind == "pdf":
            xref = _next(marks["xref"], at)
            last = None if xref is None else _next(marks["eof"], xref)
            length = None if last is None else last + 5 - at
        else:
            length = _CHECK[kind](view, at)
        if length:
            found.append(Media(kind, at, length))
            end = at + length
    return found


def true_type(blob: bytes | None, declared: str | None) -> str | None:
    """The type of media that fill the blob from its start; else what was declared."""
    found = sniff(blob)
    return MIME[found[0].kind] if found and found[0].start == 0 else declared


def store(payload: bytes, kind: str) -> bytes:
    """A payload (a multiple of 64 bytes) as 8-bit samples of an image 64 wide or of a sound with one channel."""
    rows = len(payload) // 64
    if kind == "bmp":
        palette = b"".join(bytes((k, k, k, 0)) for k in range(256))
        size = 54 + len(palette) + len(payload)
        upward = b"".join(payload[64 * r : 64 * r + 64] for r in range(rows - 1, -1, -1))
        return b"BM" + struct.pack("<IIIIiiHHIIiiII", size, 0, 54 + len(palette), 40, 64, rows, 1, 8, 0, len(payload), 2835, 2835, 256, 0) + palette + upward
    if kind == "png":
        lines = b"".join(b"\0" + payload[64 * r : 64 * r + 64] for r in range(rows))
        chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
        return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 64, rows, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines, 1)) + chunk(b"IEND", b"")
    if kind == "wav":
        body = b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 8000, 8000, 1, 8) + b"data" + struct.pack("<I", len(payload)) + payload
        return b"RIFF" + struct.pack("<I", len(body)) + body
    if kind == "au":
        return b".snd" + struct.pack(">IIIII", 24, len(payload), 2, 8000, 1) + payload
    raise ValueError(kind)


def load(media: bytes, kind: str) -> bytes:
    """The samples of what ``store`` has made."""
    if kind == "bmp":
        raw = media[struct.unpack_from("<I", media, 10)[0] :]
        return b"".join(raw[p : p + 64] for p in range(len(raw) - 64, -1, -64))
    if kind == "png":
        size = struct.unpack_from(">I", media, 33)[0]
        lines = zlib.decompress(media[41 : 41 + size])
        return b"".join(lines[p + 1 : p + 65] for p in range(0, len(lines), 65))
    if kind == "wav":
        return media[44:]
    if kind == "au":
        return media[24:]
    raise ValueError(kind)


_STORED = ("wav", "bmp", "png", "au")
#: What stands around stored media in a blob, so that carving has work to do.
_HEAD, _TAIL = b"part 1\r\nBM .snd RIFF\r\n", b"\r\nend"


def pack_text(text: str | None) -> tuple[int, bytes, str]:
    """Bytes of the text, a blob with the payload as media in it, and the type that the blob is declared to have."""
    raw = (text or "").encode()
    payload = raw + bytes(-len(raw) % 64 if raw else 64)
    pick = zlib.crc32(payload)
    return len(raw), _HEAD + store(payload, _STORED[pick % 4]) + _TAIL, MIME[_STORED[pick // 4 % 4]]


SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in textops.slices(batches):
        out: list[list] = [[] for _ in range(8)]
        for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            n, blob, declared = pack_text(text)
            found = sniff(blob)
            item = found[0]
            media = blob[item.start : item.start + item.length]
            payload = load(media, item.kind)
            wrong = int(MIME[item.kind] != declared)
            feature = f"type={item.kind};declared={declared};corrected={wrong};start={item.start};length={item.length};found={len(found)};mean={sum(payload) * 1000 // len(payload)};distinct={len(set(payload))}"
            for column, value in zip(out, (doc, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.string() if k in (3, 6, 7) else pa.int64()) for k, x in enumerate(out)], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])


def text_media(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Texts as media and back: one row a document (repeated rows repeat), in one pass without a shuffle.

    A null text counts as empty and still has 64 bytes of payload; other columns are ignored; a null id stays null.
    """
    return documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(_rows, SCHEMA)


def sniffed(frame: DataFrame, blob: str, declared: str) -> DataFrame:
    """``frame`` with ``media_type`` (the corrected type) and ``media`` (what was found: kind, start, length, bytes).

    Null blobs keep their declared type and have no media. Columns of these names are replaced.
    """
    schema = "array<struct<kind: string, start: long, length: long, bytes: binary>>"

    def found(blobs: pd.Series) -> pd.Series:
        return blobs.map(lambda b: [{"kind": m.kind, "start": m.start, "length": m.length, "bytes": b[m.start : m.start + m.length]} for m in sniff(b)])

    mime = F.create_map(*[F.lit(x) for pair in MIME.items() for x in pair])
    out = frame.withColumn("media", F.pandas_udf(found, schema)(F.col(blob)))
    first = F.get(F.col("media"), F.lit(0))
    return out.withColumn("media_type", F.when(first["start"] == 0, mime[first["kind"]]).otherwise(F.col(declared)))
