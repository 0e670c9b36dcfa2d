"""Operator 9: media columns over content-addressed payloads in tar shards.

A payload (a text's UTF-8 bytes, filled up with zero bytes to a positive multiple of
64) is stored losslessly as an 8-bit greyscale PNG, 64 samples wide, named by the
SHA-256 of the payload, in tar shards in a shared folder. A table's rows carry only
digest, shard, offset and length. Metadata columns come from range reads of the
first 33 bytes of each stored form; payload features from reading it whole.

Shards are written map-side: texts are never shuffled. A shard holds equal payloads
once; which of several shards' copies a digest refers to is settled on the small
index. A task that is tried again writes new shards, and only those of the attempt
that succeeded are in the index, which is itself a table in the shared folder.

Defined cases: a null text is an empty one, and an empty one has a payload of 64
zero bytes; repeated rows give a row each, with equal values; ids may be null; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm._arrow import blocks
from foliant.llm.shared import cut, shared_dir, small_batches

WIDTH = 64
SHARD_BYTES = 64 << 20
HEADER_BYTES = 33
_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def payload_of(raw: bytes) -> bytes:
    return raw + bytes(max(WIDTH, -(-len(raw) // WIDTH) * WIDTH) - len(raw))


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode_png(payload: bytes, level: int = 2) -> bytes:
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    filtered = np.zeros((len(rows), WIDTH + 1), np.uint8)  # filter 0 before each row
    filtered[:, 1:] = rows
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(filtered.tobytes(), level)) + _chunk(b"IEND", b"")


def read_header(head: bytes) -> tuple[int, int, int, int]:
    """Width, height, bits and colour type from the first 33 bytes of a PNG."""
    if head[:8] != _SIGNATURE or head[12:16] != b"IHDR" or zlib.crc32(head[12:29]) != struct.unpack(">I", head[29:33])[0]:
        raise ValueError("no PNG header")
    return struct.unpack(">IIBB", head[16:26])


def decode_png(media: bytes) -> bytes:
    width, height, bits, colour = read_header(media[:HEADER_BYTES])
    if (width, bits, colour) != (WIDTH, 8, 0):
        raise ValueError("not one of our images")
    at, data = 8, []
    while at < len(media):
        size, kind = struct.unpack(">I4s", media[at : at + 8])
        if kind == b"IDAT":
            data.append(media[at + 8 : at + 8 + size])
        at += size + 12
    rows = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(height, WIDTH + 1)
    return rows[:, 1:].tobytes()


def tar_header(name: str, size: int) -> bytes:
    """A ustar header of a regular file."""
    head = bytearray(512)
    for at, text in ((0, name), (100, "0000644\0"), (108, "0000000\0"), (116, "0000000\0"), (124, f"{size:011o}\0"), (136, "00000000000\0"), (148, " " * 8), (156, "0"), (257, "ustar\x0000")):
        head[at : at + len(text)] = text.encode()
    head[148:156] = f"{sum(head):06o}\0 ".encode()
    return bytes(head)


class ShardWriter:
    """Tar shards of about ``limit`` bytes in a folder, each with every payload once."""

    def __init__(self, folder: str, limit: int):
        self.fs, self.base = pafs.FileSystem.from_uri(folder)
        self.folder, self.limit, self.out = folder, limit, None

    def add(self, digest: str, payload: bytes) -> tuple[str, int, int, str]:
        """Shard, offset, length and SHA-256 of the stored form."""
        if self.out is not None and self.at >= self.limit:
            self.close()
        if self.out is None:
            name = f"shard-{uuid.uuid4().hex}.tar"
            self.shard, self.at, self.known = f"{self.folder}/{name}", 0, {}
            self.out = self.fs.open_output_stream(f"{self.base}/{name}")
        if digest not in self.known:
            media = encode_png(payload)
            self.out.write(tar_header(f"{digest}.png", len(media)) + media + bytes(-len(media) % 512))
            self.known[digest] = (self.shard, self.at + 512, len(media), hashlib.sha256(media).hexdigest())
            self.at += 512 + len(media) + -len(media) % 512
        return self.known[digest]

    def close(self) -> None:
        if self.out is not None:
            self.out.write(bytes(1024))
            self.out.close()
            self.out = None


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write every payload to shards; the index: id, n_bytes, payload_bytes, digest, shard, offset, length, media_sha256."""
    small_batches(docs)
    folder = folder or f"{shared_dir(docs.sparkSession)}/media-{uuid.uuid4().hex}"
    fs, base = pafs.FileSystem.from_uri(folder)
    fs.create_dir(base, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ShardWriter(folder, shard_bytes)
        for batch in batches:
            for block in blocks(batch.column(1)):
                raw, off, rows = block.data.tobytes(), block.offsets.tolist(), []
                for i in range(len(block)):
                    payload = payload_of(raw[off[i] : off[i + 1]])
                    digest = hashlib.sha256(payload).hexdigest()
                    rows.append((off[i + 1] - off[i], len(payload), digest, *writer.add(digest, payload)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, len(block)), *(pa.array(c) for c in zip(*rows, strict=True))], ["id", "n_bytes", "payload_bytes", "digest", "shard", "offset", "length", "media_sha256"])
        writer.close()

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return cut(source.mapInArrow(run, "id long, n_bytes long, payload_bytes long, digest string, shard string, offset long, length long, media_sha256 string"))


def places(index: DataFrame) -> DataFrame:
    """One place (shard, offset, length) per digest: the least of its copies, so equal texts have equal values."""
    return index.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("p")).select("digest", "p.*")


def _by_shard(place: DataFrame) -> DataFrame:
    n = max(1, place.sparkSession.sparkContext.defaultParallelism)
    return place.repartition(4 * n, "shard", F.floor(F.col("offset") / (8 << 20))).sortWithinPartitions("shard", "offset")


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Iterator[tuple]]]:
    """Each batch with an iterator of (open shard, offset, length)."""
    now: list = [None, None]

    def opened(batch: pa.RecordBatch) -> Iterator[tuple]:
        for shard, offset, length in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
            if now[0] != shard:
                if now[1] is not None:
                    now[1].close()
                fs, path = pafs.FileSystem.from_uri(shard)
                now[:] = [shard, fs.open_input_file(path)]
            yield now[1], offset, length

    for batch in batches:
        yield batch, opened(batch)


def headers(place: DataFrame) -> DataFrame:
    """(digest, width, height, bits, colour) by range reads of the first 33 bytes only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ranges in _ranges(batches):
            got = [read_header(f.read_at(HEADER_BYTES, offset)) for f, offset, _ in ranges]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([g[i] for g in got], pa.int32()) for i in range(4))], ["digest", "width", "height", "bits", "colour"])

    return _by_shard(place.select("digest", "shard", "offset", "length")).mapInArrow(run, "digest string, width int, height int, bits int, colour int")


def features(place: DataFrame) -> DataFrame:
    """(digest, width, height, bits, colour, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, mean, distinct) of what is stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ranges in _ranges(batches):
            rows = []
            for f, offset, length in ranges:
                head = read_header(f.read_at(HEADER_BYTES, offset))
                media = f.read_at(length, offset)
                payload = decode_png(media)
                samples = np.frombuffer(payload, np.uint8)
                rows.append((*head, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), float(samples.mean()), int(np.count_nonzero(np.bincount(samples, minlength=256)))))
            kinds = [pa.int32()] * 4 + [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds))], ["digest", "width", "height", "bits", "colour", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "mean", "distinct"])

    schema = "digest string, width int, height int, bits int, colour int, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, mean double, distinct int"
    return _by_shard(place.select("digest", "shard", "offset", "length")).mapInArrow(run, schema)


def media_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Every document with its payload's place and what was read back."""
    index = store(docs, id_col, text_col, folder)
    place = cut(places(index))
    read = place.join(features(place), "digest")
    feature = F.format_string("png:%dx%d:%dbit:gray%d;mean=%.3f;distinct=%d", "width", "height", "bits", "colour", "mean", "distinct")
    return index.select(F.col("id").alias(id_col), "n_bytes", "digest").join(read, "digest").select(id_col, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"), "digest", "shard", "offset", "length")
