"""Ogg pages: writing, checksum verification, packet reassembly, demultiplexing and timestamps.

The container follows RFC 3533. A document's bytes are stored as unsigned 8-bit samples in one
logical stream; a second one, multiplexed with it, carries a checksum of every sample packet.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import map_texts

RATE = 8000
PACKET = 4096
_HEADER = struct.Struct("<4sBBqIIIB")
_REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))
SAMPLES, MARKS = 1, 2


def page_crc(data: bytes) -> int:
    """Ogg's checksum: polynomial 0x04c11db7, most significant bit first, start value 0.

    It is zlib's checksum of the bit-reversed bytes without the inversions, itself bit-reversed.
    """
    crc = zlib.crc32(data.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(crc.to_bytes(4, "little").translate(_REVERSED), "big")


class StreamWriter:
    """One logical stream: packets in, finished pages out."""

    def __init__(self, serial: int):
        self.serial, self.seq = serial, 0
        self.lacing, self.body, self.granule, self.fresh = bytearray(), bytearray(), -1, True

    def packet(self, data: bytes, granule: int) -> bytes:
        """Pages that became full while ``data`` was added."""
        out, at, whole = b"", 0, len(data) // 255
        segments = [255] * whole + [len(data) - 255 * whole]
        for size in segments:
            if len(self.lacing) == 255:
                out += self.flush(continues=at > 0)
            self.lacing.append(size)
            self.body += data[at : at + size]
            at += size
        self.granule = granule
        return out

    def flush(self, continues: bool = False, last: bool = False) -> bytes:
        """The page so far; ``continues``: its last packet goes on in the next page."""
        kind = (0 if self.fresh else 1) | (2 if self.seq == 0 else 0) | (4 if last else 0)
        head = _HEADER.pack(b"OggS", 0, kind, self.granule, self.serial, self.seq, 0, len(self.lacing))
        page = bytearray(head + self.lacing + self.body)
        page[22:26] = page_crc(bytes(page)).to_bytes(4, "little")
        self.seq += 1
        self.lacing, self.body, self.granule, self.fresh = bytearray(), bytearray(), -1, not continues
        return bytes(page)


@dataclass
class Stream:
    """What one logical stream holds after parsing."""

    packets: list[bytes] = field(default_factory=list)
    granules: list[int] = field(default_factory=list)  # of the page on which each packet ends
    pages: int = 0
    bad_pages: int = 0
    gaps: int = 0
    ended: bool = False


class Streams(dict):
    """Logical streams by serial number, and the damaged pages of the file, whose serial can't be trusted."""

    bad_pages = 0


def parse(data: bytes) -> Streams:
    """Logical streams by serial number; a stream has a page at least that is whole.

    A page with a wrong checksum or a cut tail is skipped and counted; the packet that it would have
    continued is dropped, and parsing goes on at the next capture pattern.
    """
    streams, damaged = Streams(), Counter()
    partial: dict[int, bytearray | None] = {}
    expected: dict[int, int] = {}
    at = data.find(b"OggS")
    while at >= 0:
        if at + 27 > len(data):
            break
        _, _, kind, granule, serial, seq, crc, n = _HEADER.unpack_from(data, at)
        lacing = data[at + 27 : at + 27 + n]
        size = 27 + n + sum(lacing)
        page = data[at : at + size]
        if len(lacing) < n or len(page) < size or page_crc(page[:22] + b"\0\0\0\0" + page[26:]) != crc:
            damaged[serial] += 1
            at = data.find(b"OggS", at + 4)
            continue
        s = streams.setdefault(serial, Stream())
        s.pages += 1
        s.gaps += seq != expected.get(serial, seq)
        lost = seq != expected.get(serial, seq)
        expected[serial] = seq + 1
        open_packet = partial.get(serial)
        if kind & 1 and (open_packet is None or lost):
            open_packet = None  # its beginning is missing
        elif not kind & 1:
            open_packet = bytearray()
        body = 27 + n
        for lace in lacing:
            if open_packet is not None:
                open_packet += page[body : body + lace]
            body += lace
            if lace < 255:
                if open_packet is not None:
                    s.packets.append(bytes(open_packet))
                    s.granules.append(granule)
                open_packet = bytearray()
        partial[serial] = open_packet if lacing and lacing[-1] == 255 else None
        s.ended |= bool(kind & 4)
        at = data.find(b"OggS", at + size)
    streams.bad_pages = sum(damaged.values())
    for serial, s in streams.items():
        s.bad_pages = damaged[serial]
    return streams


_SAMPLES_HEAD = b"u8pcm\0\0\1"


def rates(streams: Streams) -> dict[int, int | None]:
    """Granules a second of every stream: its header's, else the only one that headers of the file give, as multiplexed streams share a clock."""
    own = {n: struct.unpack_from("<I", s.packets[0], 8)[0] or None for n, s in streams.items() if s.packets and len(s.packets[0]) >= 20 and s.packets[0].startswith(_SAMPLES_HEAD)}
    known = {r for r in own.values() if r}
    shared = known.pop() if len(known) == 1 else None
    return {n: own.get(n) or shared for n in streams}


def store(payload: bytes, rate: int = RATE, packet: int = PACKET) -> bytes:
    """``payload`` as 8-bit samples and the marks of its packets, multiplexed into one Ogg file."""
    samples, marks = StreamWriter(SAMPLES), StreamWriter(MARKS)
    samples.packet(_SAMPLES_HEAD + struct.pack("<IQ", rate, len(payload)), 0)
    marks.packet(b"crc32\0\0\1" + struct.pack("<I", packet), 0)
    out = [samples.flush(), marks.flush()]
    for start in range(0, len(payload), packet):
        part = payload[start : start + packet]
        end = start + len(part)
        out.append(samples.packet(part, end))
        out.append(marks.packet(zlib.crc32(part).to_bytes(4, "little"), end))
    return b"".join([*out, samples.flush(last=True), marks.flush(last=True)])


def load(data: bytes) -> dict:
    """The samples read back, and what the container says about them."""
    streams = parse(data)
    s, m = streams.get(SAMPLES, Stream()), streams.get(MARKS, Stream())
    rate = rates(streams).get(SAMPLES) or RATE
    body = s.packets[1:]
    ends = [g for g in s.granules if g >= 0]
    return {
        "payload": b"".join(body),
        "packets": len(body),
        "pages": sum(x.pages for x in streams.values()),
        "bad_pages": streams.bad_pages,
        "streams": len(streams),
        "marks_ok": [zlib.crc32(p).to_bytes(4, "little") for p in body] == m.packets[1:],
        "rate": rate,
        "end_ms": ends[-1] * 1000 // rate if ends else 0,
    }


def payload_of(text: bytes | None) -> bytes:
    """UTF-8 and zero bytes up to a positive multiple of 64."""
    raw = text or b""
    return raw + bytes(-len(raw) % 64 or (0 if raw else 64))


def describe(got: dict) -> str:
    """The feature string: container facts and statistics of the samples."""
    x = np.frombuffer(got["payload"], dtype=np.uint8)
    counts = np.bincount(x, minlength=256)
    n = max(1, len(x))
    mean = int((counts * np.arange(256)).sum()) * 1000 // n
    level = x >= 128
    crossings = int(np.count_nonzero(level[1:] != level[:-1])) if len(x) else 0
    return (
        f"streams={got['streams']};pages={got['pages']};bad={got['bad_pages']};packets={got['packets']};marks={'ok' if got['marks_ok'] else 'bad'};"
        f"rate={got['rate']};end_ms={got['end_ms']};mean_milli={mean};distinct={int(np.count_nonzero(counts))};crossings={crossings}"
    )


def to_ogg(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep``, ``n_bytes`` and ``media``: each text as an Ogg file of 8-bit samples."""

    def make():
        return lambda texts: {"n_bytes": [len(t or b"") for t in texts], "media": [store(payload_of(t)) for t in texts]}

    return map_texts(docs, keep, text_col, "n_bytes bigint, media binary", make)


def read_ogg(df: DataFrame, keep: list[str], media_col: str = "media") -> DataFrame:
    """``keep`` and, per file of ``media_col``, one row for each logical stream's packet:
    ``serial``, ``packet_no``, ``granule`` (null inside a page run), ``ms`` (by the stream's own rate; null if none is known), ``packet``, ``stream_bad_pages``.

    A null or foreign file has no packets; damaged pages are skipped and counted.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            at, cols = [], {k: [] for k in ("serial", "packet_no", "granule", "ms", "packet", "stream_bad_pages")}
            for i, data in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                streams = parse(data or b"")
                clock = rates(streams)
                for serial, s in sorted(streams.items()):
                    for no, (packet, granule) in enumerate(zip(s.packets, s.granules)):
                        at.append(i)
                        cols["serial"].append(serial)
                        cols["packet_no"].append(no)
                        cols["granule"].append(granule if granule >= 0 else None)
                        cols["ms"].append(granule * 1000 // clock[serial] if granule >= 0 and clock[serial] else None)
                        cols["packet"].append(packet)
                        cols["stream_bad_pages"].append(s.bad_pages)
            kinds = {"packet": pa.binary()}
            left = [batch.column(i).take(pa.array(at, pa.int64())) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*left, *(pa.array(v, kinds.get(k, pa.int64())) for k, v in cols.items())], names=[*keep, *cols])

    return df.select(*keep, media_col).mapInArrow(
        run, f"{fields}, serial bigint, packet_no bigint, granule bigint, ms bigint, packet binary, stream_bad_pages bigint"
    )


def media_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store every text, read the stored bytes back and digest both.

    A null text counts as empty, its payload is 64 zero bytes. Values depend on the text alone, so
    equal texts and repeated rows agree; an empty table gives an empty result.
    """

    def one(text):
        media = store(payload_of(text))
        got = load(media)
        payload = got["payload"]
        return (
            len(text or b""),
            len(payload),
            hashlib.sha256(payload).hexdigest(),
            zlib.crc32(payload[-64:]),
            len(media),
            hashlib.sha256(media).hexdigest(),
            describe(got),
        )

    names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def make():
        return lambda texts: dict(zip(names, map(list, zip(*map(one, texts))), strict=True)) if texts else {n: [] for n in names}

    schema = "n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"
    return map_texts(docs, [id_col], text_col, schema, make)
