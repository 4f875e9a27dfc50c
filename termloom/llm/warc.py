"""WARC archives as seekable Zstandard bundles.

A task writes its pages as WARC 1.1 records, groups them into frames of about ``FRAME`` bytes that are compressed
each by itself, and appends to every bundle a record index and a seek table, both in skippable frames: to a
Zstandard reader the bundle is one plain stream of records. The seek table is that of the public seekable format
(compressed and plain size of each frame, then a footer), so a frame is found from the end of the file; the record
index maps a record id to (frame, offset in the plain frame, length), and is also what writing returns.

Of records with the same payload of at least ``LEAST_REVISIT`` bytes, the one with the smallest id is a response
and the others are revisits of it without payload.

Defined results: null HTML is an empty payload. A null id is written as ``null`` and read as null; it is a revisit
if another record with its payload has an id. Rows that repeat the smallest id of a payload are all responses. Line
ends in URLs are escaped, a null URL is ``urn:none``. An empty table gives an empty index.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import column
from termloom.llm.files import new_file, open_file
from termloom.operators.lookup import Dictionary, salted_join
from termloom.session import materialize, scratch_path

LEAST_REVISIT = 100
FRAME = 1 << 20
BUNDLE = 64 << 20
LEVEL = 3
# Pages carry no time of their own.
DATE = "1970-01-01T00:00:00Z"

# The public seekable format and the revisit profile.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEK_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_ID = "urn:page:"
INDEX = "page_id bigint, uri string, frame int, offset int, length int"
RECORD = "page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    kind = "response" if refers_to is None else "revisit"
    block = http.encode() + (payload if refers_to is None else b"")
    target = "urn:none" if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<{_ID}{'null' if page_id is None else page_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": target,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    if refers_to is not None:
        fields |= {"WARC-Refers-To": f"<{_ID}{refers_to}>", "WARC-Profile": PROFILE}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return head.encode("utf-8", "replace") + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines if ": " in line)


def _page(uri: str) -> int | None:
    text = uri.strip("<>").removeprefix(_ID)
    return None if text == "null" else int(text)


def parse(data: bytes, at: int = 0) -> tuple[dict, int]:
    """The record at ``at``, with its payload, and the place behind it."""
    cut = data.index(b"\r\n\r\n", at) + 4
    fields = _fields(data[at:cut])
    end = cut + int(fields["Content-Length"])
    body = data.index(b"\r\n\r\n", cut, end) + 4
    payload, revisit = data[body:end], fields["WARC-Type"] == "revisit"
    size = int(_fields(data[cut:body])["Content-Length"])
    digest = hashlib.sha256(payload).hexdigest()
    stated = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if not revisit and (len(payload) != size or digest != stated):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    found = {
        "page_id": _page(fields["WARC-Record-ID"]),
        "record_type": fields["WARC-Type"],
        "refers_to": _page(fields["WARC-Refers-To"]) if revisit else None,
        "payload_bytes": size,
        "payload_digest": stated,
        "payload": payload,
        "url": fields["WARC-Target-URI"],
    }
    return found, end + 4


class BundleWriter:
    """One bundle; records go to the open frame, which is closed when it is full."""

    def __init__(self, folder: str):
        self.uri, self.stream = new_file(folder, ".warc.zst")
        self.frames: list[tuple[int, int]] = []
        self.index: list[tuple] = []
        self.open: list[bytes] = []
        self.filled = self.size = 0
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, page_id: int | None, data: bytes) -> None:
        self.index.append((page_id, self.uri, len(self.frames), self.filled, len(data)))
        self.open.append(data)
        self.filled += len(data)
        if self.filled >= FRAME:
            self._close_frame()

    def _close_frame(self) -> None:
        packed = self.compressor.compress(b"".join(self.open))
        self.stream.write(packed)
        self.frames.append((len(packed), self.filled))
        self.size += len(packed)
        self.open, self.filled = [], 0

    def close(self) -> pd.DataFrame:
        if self.open:
            self._close_frame()
        index = json.dumps([(p, *place) for p, _, *place in self.index], separators=(",", ":")).encode()
        index = self.compressor.compress(index)
        self.stream.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        frames = [*self.frames, (8 + len(index), 0)]
        table = b"".join(struct.pack("<II", *sizes) for sizes in frames) + struct.pack("<IBI", len(frames), 0, SEEK_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)
        self.stream.close()
        frame = pd.DataFrame(self.index, columns=["page_id", "uri", "frame", "offset", "length"])
        frame["page_id"] = frame["page_id"].astype("Int64")
        return frame


class Bundle:
    """A bundle read through its seek table."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.size()
        n, checksums, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or checksums:
            raise ValueError("no seek table")
        table = self._at(size - 9 - 8 * n, 8 * n)
        self.frames, start = [], 0
        for packed, plain in struct.iter_unpack("<II", table):
            self.frames.append((start, packed, plain))
            start += packed

    def _at(self, start: int, size: int) -> bytes:
        self.stream.seek(start)
        return self.stream.read(size)

    def frame(self, number: int) -> bytes:
        start, packed, plain = self.frames[number]
        return zstandard.ZstdDecompressor().decompress(self._at(start, packed), max_output_size=plain)

    def index(self) -> list[tuple]:
        """(page_id, frame, offset, length) of every record, from the bundle itself."""
        start, packed, _ = self.frames[-1]
        return [tuple(x) for x in json.loads(zstandard.ZstdDecompressor().decompress(self._at(start, packed)[8:]))]

    def records(self) -> Iterator[dict]:
        for number, (_, _, plain) in enumerate(self.frames):
            data, at = self.frame(number) if plain else b"", 0
            while at < len(data):
                found, at = parse(data, at)
                yield found


def with_revisits(pages: DataFrame, html: str = "html", page_id: str = "page_id") -> DataFrame:
    """``(page_id, url, html, digest, first)``: ``first`` is the id a payload was first seen with, if it was
    seen more than once.

    Payloads seen once are left out of what is joined, so that it stays small; it is broadcast when measured to
    be, else joined with frequent payloads cut into slices.
    """
    body = F.coalesce(column(html), F.lit(""))
    rows = pages.select(
        column(page_id).alias("page_id"), column("url").alias("url"), body.alias("html"), F.sha2(body, 256).alias("digest")
    )
    counts = rows.where(F.octet_length("html") >= LEAST_REVISIT).groupBy("digest")
    several = counts.agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = Dictionary(materialize(several, "payloads"))
    if firsts.fits():
        return rows.join(F.broadcast(firsts.df.select("digest", "first")), "digest", "left")
    return salted_join(rows, firsts.df.select("digest", "first"), "digest", "left", firsts.df.select("digest", "n"))


def write_warc(pages: DataFrame, folder: str, html: str = "html", page_id: str = "page_id") -> DataFrame:
    """Writes bundles below ``folder``; the record index ``(page_id, uri, frame, offset, length)``."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bundle = None
        for batch in batches:
            ids = [None if pd.isna(x) else int(x) for x in batch["page_id"].astype("Int64")]
            firsts = [None if pd.isna(x) else int(x) for x in batch["first"].astype("Int64")]
            for page, url, body, digest, first in zip(ids, batch["url"], batch["html"], batch["digest"], firsts):
                bundle = bundle or BundleWriter(folder)
                refers_to = None if first == page else first
                bundle.add(page, record(page, url, body.encode("utf-8", "replace"), digest, refers_to))
                if bundle.size >= BUNDLE:
                    yield bundle.close()
                    bundle = None
        if bundle:
            yield bundle.close()

    rows = with_revisits(pages, html, page_id).select("page_id", "url", "html", "digest", "first")
    return materialize(rows.mapInPandas(write, INDEX), "index")


def read_warc(index: DataFrame, payloads: bool = False) -> DataFrame:
    """Every record of the bundles an index names, read from the bundles; with ``payloads`` also url and payload."""
    names = [f.split()[0] for f in RECORD.split(", ")] + ["url", "payload"] * payloads

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["uri"]:
                with open_file(uri) as stream:
                    bundle = Bundle(stream)
                    rows = [{k: r[k] for k in names} for r in bundle.records()] if not payloads else None
                    for frame in [rows] if rows is not None else ([{k: r[k] for k in names}] for r in bundle.records()):
                        yield _typed(pd.DataFrame(frame, columns=names))

    bundles = materialize(index.select("uri").distinct(), "bundles")
    schema = RECORD + ", url string, payload binary" * payloads
    return bundles.repartition(max(1, bundles.count())).mapInPandas(read, schema)


def _typed(frame: pd.DataFrame) -> pd.DataFrame:
    for name in ("page_id", "refers_to"):
        frame[name] = frame[name].astype("Int64")
    return frame


def fetch(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """The records of the ids in ``wanted``: one seek and one frame each, or several from one frame."""
    names = [f.split()[0] for f in RECORD.split(", ")] + ["url", "payload"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri, rows in batch.groupby("uri"):
                with open_file(uri) as stream:
                    bundle = Bundle(stream)
                    for number, places in rows.groupby("frame"):
                        data = bundle.frame(int(number))
                        found = [parse(data, int(at))[0] for at in places["offset"]]
                        yield _typed(pd.DataFrame(found, columns=names))

    places = index.join(wanted.select("page_id").distinct(), "page_id").select("uri", "frame", "offset")
    return places.sortWithinPartitions("uri", "frame").mapInPandas(read, RECORD + ", url string, payload binary")


def warc_folder(pages: DataFrame) -> str:
    """A new folder in the shared scratch space."""
    return scratch_path(pages.sparkSession, "warc")
