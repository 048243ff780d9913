"""Media columns as content-defined chunks.

A text's payload is kept as 8-bit samples of a WAV file. A rolling gear hash cuts the payload where its content says so; every
chunk is named by its digest. Chunks that stand in one place only go with their file; the others are kept once, in a chunk
table that Spark deduplicates by digest, and come back by a join. A file is its ordered list of chunks: it is put together
again, verified against its digest, and features are computed from what was read back.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import save

BLOCK, FILL = 192, b" "
LEAST, MOST, CUT_BITS = 512, 16384, 11
#: Up to so many digests of shared chunks are broadcast (under 64 MB), beyond it they are joined by a shuffle.
MOST_SHARED = 1 << 20
RATE = 8000
_GEAR = np.random.default_rng(11).integers(0, 2**32, 256, dtype=np.uint32)


def payload_of(text: bytes) -> bytes:
    return text + FILL * (max(BLOCK, -(-len(text) // BLOCK) * BLOCK) - len(text))


def wav_header(n: int) -> bytes:
    """RIFF header of n mono samples of 8 bits."""
    u32, u16 = (lambda x: int(x).to_bytes(4, "little")), (lambda x: int(x).to_bytes(2, "little"))
    return b"RIFF" + u32(36 + n) + b"WAVEfmt " + u32(16) + u16(1) + u16(1) + u32(RATE) + u32(RATE) + u16(1) + u16(8) + b"data" + u32(n)


def cut_points(payload: bytes) -> list[int]:
    """Ends of the chunks: where the top bits of the gear hash of the last 32 bytes are zero, at least LEAST and at most MOST apart."""
    h = _GEAR[np.frombuffer(payload, np.uint8)]
    for w in (1, 2, 4, 8, 16):  # doubles the window each time
        wide = h.copy()
        wide[w:] += h[:-w] << np.uint32(w)
        h = wide
    ends, at = [], 0
    for c in (np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist():
        while c - at > MOST:
            at += MOST
            ends.append(at)
        if c - at >= LEAST:
            at = c
            ends.append(at)
    while len(payload) - at > MOST:
        at += MOST
        ends.append(at)
    return ends if at == len(payload) else [*ends, len(payload)]


def chunks_of(text: bytes) -> list[bytes]:
    payload = payload_of(text)
    ends = cut_points(payload)
    return [wav_header(len(payload)), *(payload[a:b] for a, b in zip([0, *ends], ends))]


def _digest(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()[:16]


def _file_key(text: bytes) -> bytes:
    return _digest(text)


def _chunk_rows(with_bytes: bool):
    """(file, pos, n, digest, media, z) of the chunks of each distinct text; media, the file's whole digest, stands in the first."""

    def run(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=9, write_content_size=True, write_checksum=False)
        seen = set()
        for batch in batches:
            cols = [[], [], [], [], [], []]
            for value in batch.column(0):
                text = (value.as_py() or "").encode()
                file = _file_key(text)
                if file in seen:
                    continue
                seen.add(file)
                parts = chunks_of(text)
                whole = hashlib.sha256(b"".join(parts)).digest() if with_bytes else None
                for i, part in enumerate(parts):
                    for c, v in zip(cols, (file, i, len(parts), _digest(part), whole if i == 0 else None, pack.compress(part) if with_bytes else None)):
                        c.append(v)
            kinds = (pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["file", "pos", "n", "digest", "media", "z"])

    return run


_CHUNK = "file binary, pos int, n int, digest binary, media binary, z binary"


def _feature(samples: np.ndarray, chunks: int) -> str:
    x = samples.astype(np.int64)
    return f"{chunks}:{int(x.sum())}:{int((x * x).sum())}:{int(np.count_nonzero(np.diff(x >= 128)))}:{int(x.max())}"


def _rebuilt(batches):
    """Files put together from their chunks, which come sorted by file and place."""
    import zstandard

    unpack = zstandard.ZstdDecompressor()

    def done(file, media, parts):
        stored = b"".join(unpack.decompress(z) for z in parts)
        if hashlib.sha256(stored).digest() != media:
            raise ValueError(f"stored media of {file.hex()} is damaged")
        payload = stored[44:]
        return file, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stored), media.hex(), _feature(np.frombuffer(payload, np.uint8), len(parts) - 1)

    kinds = (pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
    names = ["file", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    now, media, parts = None, None, []
    for batch in batches:
        out = []
        for file, pos, n, whole, z in zip(*(batch.column(c).to_pylist() for c in ("file", "pos", "n", "media", "z"))):
            if file != now:
                now, parts = file, []
            if pos != len(parts):  # the same text from another task
                continue
            media = whole if pos == 0 else media
            parts.append(z)
            if len(parts) == n:
                out.append(done(file, media, parts))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, kinds)], names)


def store_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature.

    A null text is an empty one: its payload is one block of filling. Equal texts are stored once and have equal values.
    feature: chunks, sum and sum of squares of samples, crossings of the middle value and largest sample, joined by colons.
    Repeated rows and null ids each give a row; other columns are ignored. A file that does not read back as it was stored fails
    the job.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(text.alias("text"))
    place = F.xxhash64("file", "pos")
    refs = texts.mapInArrow(_chunk_rows(False), _CHUNK).groupBy("digest").agg(F.min(place).alias("a"), F.max(place).alias("b"))
    shared = save(refs.where("a <> b").select("digest"), "shared")
    near = F.broadcast(shared) if shared.count() <= MOST_SHARED else shared
    rows = texts.mapInArrow(_chunk_rows(True), _CHUNK)
    own = rows.join(near, "digest", "left_anti").select("file", "pos", "n", "media", "z")
    lists = rows.join(near, "digest", "left_semi").select("file", "pos", "n", "media", "digest")
    table = rows.join(near, "digest", "left_semi").select("digest", "z").dropDuplicates(["digest"])
    back = lists.join(table, "digest").select("file", "pos", "n", "media", "z")
    # range-free and even: a file's chunks meet by its digest, and each task sends a text once
    sorted_chunks = own.unionByName(back).repartition("file").sortWithinPartitions("file", "pos")
    media = sorted_chunks.mapInArrow(_rebuilt, "file binary, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), F.unhex(F.substring(F.sha2(text, 256), 1, 32)).alias("file"))
    return keyed.join(media, "file").drop("file")
