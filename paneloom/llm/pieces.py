"""SentencePiece encoding and decoding by a table of distinct chunks.

No piece of the model has a whitespace marker after another character (checked when the model is loaded), so merges never
cross from a word to the marker of the next: a marked word has the same ids wherever it stands. Texts are taken in runs of bounded
size. A run becomes the places of its words as numbers into its own list of distinct words, and that list, cut by hash into parts.
All lists of a part meet in one task, where each distinct word of the corpus is segmented once; its ids go back to every
run that has it, and are joined to the places there. What moves is each run's distinct words and numbers, never texts.
Lists and places are made in two passes over the texts, which costs less than a table of both. Runs are named by their content, so
that a table that reads differently the second time fails the job instead of giving wrong ids.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Characters of a run; a longer text is a run of its own.
RUN_CHARS = 6_000_000
#: Parts of the table of distinct words: so many, and more by the root of the corpus' size in units of so many bytes, so that a
#: part and a run's share of it both stay moderate.
PARTS, PARTS_BYTES = 64, 1 << 26
_RUNS = re.compile(f"{MARK}+[^{MARK}]*")
_STEP = "run string, part int, doc_ids array<long>, blob binary"


def keys_of(text: str) -> list[str]:
    """The marked words of a text, each without its first marker."""
    if not text:
        return []
    if "  " not in text and text[0] != " " and MARK not in text:
        return text.split(" ")
    return [c[1:] for c in _RUNS.findall(MARK + text.replace(" ", MARK))]


def _squeezed(*arrays: np.ndarray) -> bytes:
    """Whole numbers below 2^32, least bytes together: lengths of the arrays first."""
    import zstandard

    flat = np.concatenate([[len(arrays)], [len(x) for x in arrays], *arrays]).astype(np.uint32)
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(flat.view(np.uint8).reshape(-1, 4).T).tobytes())


def _numbers(blob: bytes) -> list[np.ndarray]:
    import zstandard

    flat = np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1).T).view(np.uint32).ravel().astype(np.int64)
    n = flat[1 : 1 + flat[0]]
    return np.split(flat[1 + len(n) :], np.cumsum(n)[:-1])


def _packed(strings: list[str]) -> bytes:
    import zstandard

    column = pa.array(strings, pa.large_string())
    offsets, data = column.buffers()[1:]
    sizes = np.diff(np.frombuffer(offsets, np.int64)[: len(strings) + 1]).astype(np.uint32)
    return zstandard.ZstdCompressor(level=3).compress(np.uint32(len(strings)).tobytes() + sizes.tobytes() + (data.to_pybytes() if data else b""))


def _strings(blob: bytes) -> list[str]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    offsets = np.concatenate([[0], np.cumsum(np.frombuffer(raw, np.uint32, n, 4).astype(np.int64))])
    return pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw[4 + 4 * n :])]).to_pylist()


class Segmenter:
    """What the library makes of a marked word: its ids as text, and the text they decode to."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        if any(MARK in self.sp.id_to_piece(i).lstrip(MARK) for i in range(self.sp.get_piece_size())):
            raise ValueError("pieces of this model cross whitespace markers")
        self.lone = self.sp.piece_to_id(MARK)
        self.lead = self.sp.encode("a")

    def ids(self, keys: list[str]) -> list[list[int]]:
        ids = self.sp.encode([k.replace(MARK, " ") for k in keys], num_threads=1) if keys else []
        return [x if k else [self.lone] for k, x in zip(keys, ids)]

    def texts(self, ids: list[list[int]]) -> list[str]:
        return [t[1:] for t in self.sp.decode([self.lead + x for x in ids], num_threads=1)] if ids else []


def _runs(batches, run_chars: int):
    """(ids, texts) of consecutive rows of about run_chars characters."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            text = text.as_py() or ""
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
            if size >= run_chars:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _cut(parts: int, words_of: bool, run_chars: int):
    """For each run a row for each part of its words, or else a row of its places (part -1)."""

    def run(batches):
        for i, (ids, texts) in enumerate(_runs(batches, run_chars)):
            index: dict[str, int] = {}
            codes, sizes = [], []
            for text in texts:
                words = keys_of(text)
                sizes.append(len(words))
                codes.append(np.array([index.setdefault(w, len(index)) for w in words], np.int64))
            codes = np.concatenate(codes)
            often = np.argsort(-np.bincount(codes, minlength=len(index)), kind="stable")
            words = np.array([*index, ""], object)[:-1][often]
            part = np.array([zlib.crc32(w.encode()) % parts for w in words], np.int64)
            order = np.argsort(part, kind="stable")
            told = hashlib.sha256("\n".join(index).encode() + codes.tobytes() + str((ids, sizes)).encode()).hexdigest()[:24]
            name = f"{TaskContext.get().partitionId()}-{i}-{told}"
            if words_of:
                used, first = np.unique(part[order], return_index=True)
                used, blobs = used.tolist(), [_packed(x.tolist()) for x in np.split(words[order], first[1:])] if len(used) else []
                doc_ids = [None] * len(used)
            else:
                rank = np.empty(len(index), np.int64)
                rank[often] = np.arange(len(index))
                used, blobs, doc_ids = [-1], [_squeezed(np.array(sizes), rank[codes], order)], [ids]
            kinds = [pa.string(), pa.int32(), pa.list_(pa.int64()), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(([name] * len(used), used, doc_ids, blobs), kinds)], ["run", "part", "doc_ids", "blob"])

    return run


def _segmented(model_path: str):
    """The lists of words of a part, in consecutive rows, become lists of ids; each word is segmented once."""

    def run(batches):
        segment, part, known = Segmenter(model_path), None, {}
        for batch in batches:
            out = []
            for now, blob in zip(batch.column("part").to_pylist(), batch.column("blob")):
                if now != part:
                    part, known = now, {}
                words = _strings(blob.as_py())
                fresh = [w for w in words if w not in known]
                known |= zip(fresh, segment.ids(fresh))
                ids = [known[w] for w in words]
                out.append(_squeezed(np.array([len(x) for x in ids]), np.array([y for x in ids for y in x])))
            cols = [batch.column("run"), batch.column("part"), pa.nulls(len(out), pa.list_(pa.int64())), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["run", "part", "doc_ids", "blob"])

    return run


def _joined(model_path: str, keep_ids: bool):
    """The rows of a run, consecutive and by part, become a row for each of its documents."""

    def run(batches):
        segment = Segmenter(model_path)
        name, doc_ids, places, ids, texts = None, None, None, [], []

        def told():
            sizes, codes, order = places or [[]] * 3
            if places is None or len(ids) != len(order):
                raise ValueError(f"the texts of run {name} did not read alike twice")
            of_ids, of_texts = np.empty((2, len(order)), object)
            of_ids[order], of_texts[order] = ids, texts
            split = np.split(codes, np.cumsum(sizes)[:-1])
            for at in range(0, len(doc_ids), 2000):
                rows = [(",".join(of_ids[c].tolist()), "".join(of_texts[c].tolist())[1:]) for c in split[at : at + 2000]]
                yield _digests(pa.array(doc_ids[at : at + 2000], pa.int64()), rows, keep_ids)

        for batch in batches:
            for now, part, own, blob in zip(batch.column("run").to_pylist(), batch.column("part").to_pylist(), batch.column("doc_ids"), batch.column("blob")):
                if now != name:
                    if name is not None:
                        yield from told()
                    name, places, ids, texts = now, None, [], []
                numbers = _numbers(blob.as_py())
                if part < 0:
                    doc_ids, places = own.as_py(), numbers
                else:
                    lists = [x.tolist() for x in np.split(numbers[1], np.cumsum(numbers[0])[:-1])]
                    ids += [",".join(map(str, x)) for x in lists]
                    texts += segment.texts(lists)
        if name is not None:
            yield from told()

    return run


def _digests(doc_ids: pa.Array, rows: list[tuple[str, str]], keep_ids: bool) -> pa.RecordBatch:
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    n = [ids.count(",") + 1 if ids else 0 for ids, _ in rows]
    cols = [doc_ids, pa.array(n, pa.int64()), pa.array([sha(ids) for ids, _ in rows], pa.string()), pa.array([sha(text) for _, text in rows], pa.string())]
    if keep_ids:
        flat = np.fromstring(",".join(ids for ids, _ in rows if ids), np.int32, sep=",") if any(n) else np.zeros(0, np.int32)
        cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(flat)))
    return pa.RecordBatch.from_arrays(cols, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: 4 + keep_ids])


def encode(
    docs: DataFrame, model_path: str, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text", run_chars: int = RUN_CHARS
) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids (array<int>).

    Ids are those of the library for the whole text, without begin and end; decoded is what it decodes them to. A null or empty
    text has no ids and decodes to nothing; a very long one is a run of its own. Repeated rows and null ids each give a row; other
    columns are ignored, whatever their names. An empty table gives an empty result. docs is read twice and must read alike, as
    files do. run_chars: characters that a task holds as one run; shorter ones take less memory and more time.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(PARTS * max(1.0, (size / PARTS_BYTES) ** 0.5))
    words = docs.mapInArrow(_cut(parts, True, run_chars), _STEP).repartition(F.col("part")).sortWithinPartitions("part").mapInArrow(_segmented(model_path), _STEP)
    both = docs.mapInArrow(_cut(parts, False, run_chars), _STEP).unionByName(words).repartition(F.col("run")).sortWithinPartitions("run", "part")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return both.mapInArrow(_joined(model_path, keep_ids), schema)
