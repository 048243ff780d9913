"""Alignment of two tokenizers over the same bytes.

A text with a space before it is cut into marked words: a space and what follows up to the next one. Neither tokenizer crosses the border
before a space that follows a character that is not white space, so a marked word has the same tokens wherever it stands, and each
task segments the distinct ones. Tokens of a run of texts then are arrays of ids and byte offsets.

A token overlaps with the token of the other side that covers its start, and of two tokens that overlap, the later start is covered by the
other. So the links of a run are two backward `merge_asof` joins, of each side's starts to the other's, keyed by document, less what
both of them find. Where tokens of both sides end at one byte, a group ends.

Links are counted by id pair over the whole corpus: runs send their distinct pairs with counts, the sums and each B id's highest go
back to the runs that have the pair, and are added up by document there.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import save

#: Characters of a run; a longer text is a run of its own.
RUN_CHARS = 400_000
#: Texts, or runs of numbers, that go to Python at once.
ROWS, RUNS = 200, 4
#: Distinct words whose tokens a task remembers between runs, and characters that go to a tokenizer as one text.
KNOWN, JOINED = 150_000, 2_000
#: Words that are segmented, or aligned, at once; a longer text is taken piece by piece.
WORDS = 40_000
#: Pairs with their counts are broadcast up to this number (32 MB), and joined by a shuffle beyond it.
MOST_PAIRS = 1 << 20
_SHIFT = 32
_MARK = "▁"
_BORDER, _ODD = re.compile(r"(?<=\S)(?= )"), re.compile(r"\s(?= |\Z)")


def _byte_alphabet() -> dict[str, int]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Ids and bytes of both sides. A: byte-level BPE of the tokenizers library; B: pieces of the sentencepiece library."""

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; each thread of the library would keep memory of its own
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        alphabet = _byte_alphabet()
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        with open(byte_path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        self.a_bytes = [b""] * (1 + max([*vocabulary.values(), *self.a.get_added_tokens_decoder()]))
        for token, i in vocabulary.items():
            self.a_bytes[i] = token.encode() if token in special else bytes(alphabet[c] for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace(_MARK, " ").encode() for p in pieces]
        if any(_MARK in p.lstrip(_MARK) for p in pieces):
            raise ValueError("pieces of this model cross whitespace markers")
        self.lone = self.b.piece_to_id(_MARK)

    def _whole(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of A and B of one text that begins with a space."""
        return self.a.encode(text, add_special_tokens=False).ids, self.b.encode(text[1:], num_threads=1) if text != " " else [self.lone]

    def words(self, words: list[str]) -> tuple["Lists", "Lists", np.ndarray]:
        """Ids of A and of B of each marked word, and whether both sides give its bytes back. Words that a space may follow are put together
        to texts of about JOINED characters, and their ids are cut at the words' ends."""
        own, texts, at = [], [], 0
        while at < len(words):
            to, size = at, 0
            while to < len(words) and size < JOINED and not words[to][-1].isspace():
                size += len(words[to])
                to += 1
            own.append(words[at : max(to, at + 1)])
            texts.append("".join(own[-1]))
            at += len(own[-1])
        sizes = np.fromiter((len(w.encode()) for w in words), np.int64, len(words))
        sides = [x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)], self.b.encode([t[1:] for t in texts], num_threads=1)
        lists_a, lists_b, good, first = [], [], np.ones(len(words), bool), 0
        for part, text, a, b in zip(own, texts, *sides):
            b = b if text != " " else [self.lone]
            ends = np.cumsum(sizes[first : first + len(part)])
            cuts = [self._cuts(ids, raw, text, ends) for ids, raw in ((a, self.a_bytes), (b, self.b_bytes))]
            if any(c is None for c in cuts):  # some word has other bytes: each on its own
                for i, w in enumerate(part):
                    told = self._whole(w)
                    good[first + i] = all(b"".join([raw[x] for x in ids]) == w.encode() for ids, raw in zip(told, (self.a_bytes, self.b_bytes)))
                    lists_a.append((told[0] if good[first + i] else [], [len(told[0]) if good[first + i] else 0]))
                    lists_b.append((told[1] if good[first + i] else [], [len(told[1]) if good[first + i] else 0]))
            else:
                lists_a.append((a, cuts[0]))
                lists_b.append((b, cuts[1]))
            first += len(part)
        return Lists.of(lists_a), Lists.of(lists_b), good

    @staticmethod
    def _cuts(ids: list[int], raw: list[bytes], text: str, ends: np.ndarray) -> np.ndarray | None:
        """How many of the ids each word has, None unless they are the text's bytes and cut at all ends."""
        parts = [raw[i] for i in ids]
        if b"".join(parts) != text.encode():
            return None
        at = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        place = np.searchsorted(at, ends)
        return np.diff(place, prepend=-1) if (at[place] == ends).all() else None


class Lists:
    """Lists of numbers, put together."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.sizes = flat, sizes

    @classmethod
    def of(cls, parts: list[tuple]) -> "Lists":
        join = lambda i, kind: np.concatenate([np.zeros(0, kind), *[np.asarray(x[i], kind) for x in parts]])
        return cls(join(0, np.int32), join(1, np.int64))

    def more(self, other: "Lists") -> "Lists":
        return Lists(np.concatenate([self.flat, other.flat]), np.concatenate([self.sizes, other.sizes]))

    def gathered(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the lists that codes name, one list after the other, and the length of each."""
        starts, n = (np.cumsum(self.sizes) - self.sizes)[codes], self.sizes[codes]
        ends = np.cumsum(n)
        place = np.arange(int(n.sum())) + np.repeat(starts - (ends - n), n)
        return self.flat[place].astype(np.int64), n


def marked_words(text: str) -> list[str]:
    """A space and the text, cut before each space that follows a character other than white space."""
    text = " " + text
    if _ODD.search(text):
        return _BORDER.split(text)
    return [" " + w for w in text[1:].split(" ")]


def linked(starts_a: np.ndarray, doc_a: np.ndarray, starts_b: np.ndarray, doc_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of all tokens of A and B whose bytes overlap. Starts ascend; the tokens of a document cover the same bytes on both sides."""
    import pandas as pd

    a = pd.DataFrame({"start": starts_a, "doc": doc_a, "i": np.arange(len(starts_a)), "start_a": starts_a})
    b = pd.DataFrame({"start": starts_b, "doc": doc_b, "j": np.arange(len(starts_b)), "start_b": starts_b})
    over_a = pd.merge_asof(a, b, on="start", by="doc")
    over_b = pd.merge_asof(b, a, on="start", by="doc")
    over_b = over_b[over_b["start_a"] < over_b["start_b"]]  # equal starts were found from the other side
    return np.concatenate([over_a["i"], over_b["i"]]).astype(np.int64), np.concatenate([over_a["j"], over_b["j"]]).astype(np.int64)


def _grouped(ids_a, ends_a, doc_a, ids_b, ends_b, doc_b, n_docs: int, tables) -> tuple[np.ndarray, list[str]]:
    """Groups of each document, and their text 'a1,a2|b1;a3|b2'."""
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    of_a, of_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
    last_a, last_b = ends_a == common[of_a], ends_b == common[of_b]
    groups = np.bincount(doc_a[last_a], minlength=n_docs)
    # tokens of A, then of B, of each group
    before_b, upto_a = np.searchsorted(of_b, of_a, "left"), np.searchsorted(of_a, of_b, "right")
    out = np.empty(len(ids_a) + len(ids_b), object)
    comma, bar, semicolon = tables
    out[np.arange(len(ids_a)) + before_b] = np.where(last_a, bar[ids_a], comma[ids_a])
    out[np.arange(len(ids_b)) + upto_a] = np.where(last_b, semicolon[ids_b], comma[ids_b])
    ends = np.cumsum(np.bincount(doc_a, minlength=n_docs) + np.bincount(doc_b, minlength=n_docs))
    return groups, ["".join(part.tolist())[:-1] for part in np.split(out, ends[:-1])]


def _squeezed(x: np.ndarray) -> bytes:
    """Whole numbers below 2^32, bytes of one place together."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes())


def _numbers(blob: bytes) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view(np.uint32).ravel().astype(np.int64)


def _runs(batches, id_type):
    """(ids, texts) of consecutive rows of about RUN_CHARS characters."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, text in enumerate(batch.column("text")):
            ids.append(batch.column("doc_id")[i])
            texts.append(text.as_py() or "")
            size += len(texts[-1])
            if size >= RUN_CHARS:
                yield pa.array([x.as_py() for x in ids], id_type), texts
                ids, texts, size = [], [], 0
    if ids:
        yield pa.array([x.as_py() for x in ids], id_type), texts


_RUN = ["run", "doc_ids", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "counts", "places"]


def _aligned(byte_path: str, piece_path: str, keep_groups: bool, schema: pa.Schema):
    """A row for each run of texts: numbers of its documents, distinct id pairs with counts, and the pair of every link."""

    def run(batches):
        both = Tokenizers(byte_path, piece_path)
        size_a, size_b = (np.array([len(x) for x in side], np.int64) for side in (both.a_bytes, both.b_bytes))
        n = max(len(size_a), len(size_b))
        tables = [np.array([f"{i}{end}" for i in range(n)], object) for end in ",|;"]
        id_type = schema.field("doc_ids").type.value_type
        for at, (doc_ids, texts) in enumerate(_runs(batches, id_type)):
            if at == 0 or len(known) > KNOWN:
                known, lists_a, lists_b, good = defaultdict(itertools.count().__next__), Lists.of([]), Lists.of([]), np.zeros(0, bool)
            had, codes, sizes = len(known), [], []
            for text in texts:
                words = marked_words(text) if text else []
                sizes.append(len(words))
                codes.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
            codes, doc_of = np.concatenate(codes), np.repeat(np.arange(len(texts)), sizes)
            fresh = itertools.islice(known, had, None)
            while some := list(itertools.islice(fresh, WORDS)):
                fresh_a, fresh_b, fresh_good = both.words(some)
                lists_a, lists_b, good = lists_a.more(fresh_a), lists_b.more(fresh_b), np.concatenate([good, fresh_good])
            bad = doc_of[~good[codes]]
            if len(bad):  # documents with such a word have no tokens
                keep = ~np.isin(doc_of, bad)
                codes, doc_of = codes[keep], doc_of[keep]
            counts_of, links, groups = np.zeros((4, len(texts)), np.int64), [np.zeros(0, np.int64)], [[] for _ in texts]
            shas = [hashlib.sha256() for _ in texts]
            for lo in range(0, len(codes), WORDS):  # borders of words are borders of groups
                part, docs = codes[lo : lo + WORDS], doc_of[lo : lo + WORDS]
                ids_a, n_a = lists_a.gathered(part)
                ids_b, n_b = lists_b.gathered(part)
                base, n_docs = docs[0], docs[-1] - docs[0] + 1
                doc_a, doc_b = np.repeat(docs - base, n_a), np.repeat(docs - base, n_b)
                ends_a, ends_b = np.cumsum(size_a[ids_a]), np.cumsum(size_b[ids_b])
                i, j = linked(ends_a - size_a[ids_a], doc_a, ends_b - size_b[ids_b], doc_b)
                links.append((ids_a[i] << _SHIFT | ids_b[j])[np.argsort(doc_a[i], kind="stable")])
                n_groups, told = _grouped(ids_a, ends_a, doc_a, ids_b, ends_b, doc_b, n_docs, tables)
                for row, x in zip(counts_of, (*(np.bincount(d, minlength=n_docs) for d in (doc_a, doc_b)), n_groups, np.bincount(doc_a[i], minlength=n_docs))):
                    row[base : base + n_docs] += x
                for d, text in enumerate(told, base):
                    if text and keep_groups:
                        groups[d].append(text)
                    elif text:
                        shas[d].update((b";" if groups[d] else b"") + text.encode())
                        groups[d] = True
            groups = [";".join(g) if keep_groups else sha.hexdigest() if g else "" for g, sha in zip(groups, shas)]
            pairs, places, counts = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
            name = f"{TaskContext.get().partitionId()}-{at}"
            values = [name, doc_ids.to_pylist(), *counts_of, groups, pairs, counts, _squeezed(places)]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    return run


def _summed(batches):
    """Runs with the corpus counts of their pairs become rows of their documents."""
    for batch in batches:
        for i in range(batch.num_rows):
            one = lambda c: batch.column(c)[i].values  # noqa: E731, B023
            n_links, at = one("n_links").to_numpy(), _numbers(batch.column("places")[i].as_py())
            told = one("told")
            count, best = (np.concatenate([x, [0]])[at] for x in (told.field("n").to_numpy(), told.field("best").to_numpy(zero_copy_only=False).astype(np.int64)))
            ends = np.cumsum(n_links)
            sums = [np.diff(np.concatenate([[0], np.concatenate([[0], np.cumsum(x)])[ends]])) for x in (best, count)]
            columns = [one(c) for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")] + [pa.array(x, pa.int64()) for x in sums] + [one("groups")]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])


def align(
    docs: DataFrame, byte_path: str, piece_path: str, keep_groups: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs). Documents has one row per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups, as
    'a1,a2|b1;a3|b2,b3', or its SHA-256 where keep_groups is false. Pairs has a_id, b_id, n (links of the corpus) and best (no A id has
    more with this B id, ties included).

    n_best counts the links whose pair is best, count_sum adds their counts. A null or empty text, and one whose bytes either side does
    not give back, has no tokens: zeros and ''. Repeated rows count as often as they stand; null ids give rows too, and ids keep their
    type. A very long text is a run of its own. Other columns are ignored, whatever their names. Empty tables give empty results.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    own = docs.schema["doc_id"].dataType
    longs, kinds = T.ArrayType(T.LongType()), [T.StringType(), T.ArrayType(own), *[T.ArrayType(T.LongType())] * 4, T.ArrayType(T.StringType())]
    schema = T.StructType([T.StructField(c, t) for c, t in zip(_RUN, [*kinds, longs, longs, T.BinaryType()])])
    from pyspark.sql.pandas.types import to_arrow_schema

    runs = docs.mapInArrow(_aligned(byte_path, piece_path, keep_groups, to_arrow_schema(schema)), schema)
    runs = save(runs, "runs", ROWS)
    every = runs.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x")).groupBy(F.col("x.pairs").alias("pair"))
    every = every.agg(F.sum("x.counts").alias("n")).withColumn("b_id", F.col("pair").bitwiseAND((1 << _SHIFT) - 1))
    pairs = every.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b_id")))
    pairs = save(pairs.select("pair", F.shiftright("pair", _SHIFT).alias("a_id"), "b_id", "n", "best"), "pairs")
    counts = pairs.select("pair", "n", "best")
    counts = F.broadcast(counts) if counts.count() <= MOST_PAIRS else counts
    asked = runs.select("run", F.posexplode("pairs").alias("i", "pair")).join(counts, "pair")
    told = asked.groupBy("run").agg(F.array_sort(F.collect_list(F.struct("i", "n", "best"))).alias("told"))
    full = runs.drop("pairs", "counts").join(told, "run", "left")
    full = full.withColumn("told", F.coalesce("told", F.array().cast("array<struct<i:int,n:bigint,best:boolean>>")))
    out = T.StructType([T.StructField("doc_id", own), *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]])
    rows = save(full.mapInArrow(_summed, out.add("groups", T.StringType())), "aligned", RUNS)
    return rows, pairs.select("a_id", "b_id", "n", "best")
