"""Near-duplicate groups by SimHash, compared bit-sliced.

Fingerprints that differ in at most RADIUS of 64 bits agree in one of RADIUS + 1 bands of bits at least, so each is put into a bucket for
each band. A bucket that holds more than BUCKET different fingerprints is split: of two of them that agree in its bits, the remaining bits
agree in one of RADIUS + 1 further bands, and so on, LEVELS times. That loses no pair, and what still agrees then has few bits left
to differ in; a bucket that is yet too large is dealt to blocks, and each two blocks are compared. Equal fingerprints are one from the start.

Fingerprints of a block are compared through bit planes: plane b holds bit b of 64 fingerprints in a word. The planes in which a
fingerprint differs from the lanes are summed by carry-save adders into counters of ones, twos and fours, for all lanes at once and eight
planes at a time, and a fingerprint whose lanes have all passed the radius is abandoned. What a block gives is a forest that
connects what links, not its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ngram_join import MOST_IDS, components
from .store import drop, save

RADIUS = 4
#: Different fingerprints of a bucket that are compared with each other at once; larger buckets are split.
BUCKET = 4096
#: Times that a bucket is split by further bands before it is dealt to blocks.
LEVELS = 4
#: Buckets are compared together up to so many fingerprints: a link is one whatever buckets its ends are of.
TOGETHER = 512
#: Fingerprints that are held against a block at once.
TILE = 256
#: Shingles whose bits are counted at once, and texts that go to Python at once.
COUNTED, ROWS = 1 << 16, 500
ALL = (1 << 64) - 1


def fingerprint(text: str | None, k: int = 4) -> int:
    """64 bits, each set where over half the hashes of the k-word shingles have it. Without words it is zero."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    raw = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > k:
        starts, ends = starts[: 1 - k], ends[k - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, len(starts), COUNTED):
        hashes = b"".join([digest(raw[s:e], 42) for s, e in zip(starts[at : at + COUNTED].tolist(), ends[at : at + COUNTED].tolist())])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def _fingerprints(k: int):
    def run(batches):
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), k) for t in batch.column("text")), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return run


def masks() -> list[dict[int, list[int]]]:
    """For each level the bits of its bands, by the bits of the band they split (0: none)."""
    levels, known = [], [0]
    for _ in range(LEVELS):
        level = {}
        for had in known:
            rest = [b for b in range(64) if not had >> b & 1]
            bands = np.array_split(np.array(rest), RADIUS + 1)
            level[had] = [had | sum(1 << int(b) for b in band) for band in bands]
        levels.append(level)
        known = [m for own in level.values() for m in own]
    return levels


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _full_add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and carry of three planes."""
    either = a ^ b
    return either ^ c, (a & b) | (either & c)


def pairs_within(fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """(i, j), i < j, of all of these that differ in at most `radius` bits, which is below 8."""
    n = len(fps)
    words = -(-n // 64)
    bits = np.zeros((64, words * 64), np.uint8)
    bits[:, :n] = np.unpackbits(fps.astype(">u8").view(np.uint8).reshape(n, 8), axis=1).T
    planes = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    lanes = np.arange(words * 64)
    found_i, found_j = [], []
    for at in range(0, n, TILE):
        rows = np.arange(at, min(n, at + TILE))
        base = at // 64  # lanes before these rows were told by the rows before
        closed = (lanes[None, base * 64 :] <= rows[:, None]) | (lanes[None, base * 64 :] >= n)
        over = np.packbits(closed, axis=1, bitorder="little").view(np.uint64)
        own = bits[:, rows].astype(np.uint64) * np.uint64(ALL)
        ones, twos, fours = (np.zeros_like(over) for _ in range(3))
        for first in range(0, 64, 8):
            d = [planes[b, None, base:] ^ own[b, :, None] for b in range(first, first + 8)]
            ones, t1 = _full_add(ones, d[0], d[1])
            ones, t2 = _full_add(ones, d[2], d[3])
            ones, t3 = _full_add(ones, d[4], d[5])
            ones, t4 = _full_add(ones, d[6], d[7])
            twos, f1 = _full_add(twos, t1, t2)
            twos, f2 = _full_add(twos, t3, t4)
            fours, eights = _full_add(fours, f1, f2)
            over = over | eights | _above(ones, twos, fours, radius)
            live = (~over).any(1)
            if not live.all():
                rows, over, ones, twos, fours, own = rows[live], over[live], ones[live], twos[live], fours[live], own[:, live]
                if not len(rows):
                    break
        if len(rows):
            i, j = np.nonzero(np.unpackbits((~over).view(np.uint8), axis=1, bitorder="little"))
            found_i.append(rows[i])
            found_j.append(j + base * 64)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_i]), np.concatenate([none, *found_j])


def _above(ones: np.ndarray, twos: np.ndarray, fours: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count in these three planes is above the radius."""
    above, equal = np.zeros_like(ones), np.full_like(ones, ALL)
    for plane, bit in ((fours, 4), (twos, 2), (ones, 1)):
        if radius & bit:
            equal &= plane
        else:
            above |= equal & plane
            equal &= ~plane
    return above


def _forest(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what links among these: each to the first one that it reaches."""
    i, j = pairs_within(fps)
    at = np.arange(len(fps))
    while len(i):
        before = at.copy()
        np.minimum.at(at, j, at[i])
        np.minimum.at(at, i, at[j])
        at = at[at]
        if (at == before).all():
            break
    own = np.flatnonzero(at < np.arange(len(fps)))
    return fps[own], fps[at[own]]


def _compared(batches):
    """Rows (mask, value, deal, fp), those of a bucket consecutive, become edges (a, b)."""
    held, key = [], None

    def told():
        fps = np.unique(np.concatenate(held)) if held else np.zeros(0, np.uint64)
        a, b = _forest(fps)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("mask", "value", "deal")])
        fps = batch.column("fp").to_numpy().view(np.uint64)
        starts = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(0)])) if len(fps) else np.zeros(0, int)
        for lo, hi in zip(starts, np.append(starts[1:], len(fps))):
            now = tuple(keys[:, lo])
            if now != key and sum(map(len, held)) >= TOGETHER:
                yield told()
                held = []
            key = now
            held.append(fps[lo:hi])
    yield told()


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= MOST_IDS else df


def _buckets(fps: DataFrame) -> DataFrame:
    """(mask, value, deal, fp): each two fingerprints (fp) within the radius are in a bucket together."""
    now, out = fps.select("fp", F.lit(0).cast("long").alias("mask")), []
    for level, bands in enumerate(masks()):
        if level == 0:
            keyed = now.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in bands[0]])).alias("mask"))
        else:
            spark = fps.sparkSession
            further = spark.createDataFrame([(_signed(had), [_signed(m) for m in own]) for had, own in bands.items()], "mask long, bands array<long>")
            keyed = now.join(F.broadcast(further), "mask").select("fp", F.explode("bands").alias("mask"))
        keyed = keyed.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        hot = save(keyed.groupBy("mask", "value").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET), "hot")
        if hot.isEmpty():
            out.append(keyed.withColumn("deal", F.lit(0).cast("long")))
            break
        hint = _small(hot)
        out.append(keyed.join(hint, ["mask", "value"], "left_anti").withColumn("deal", F.lit(0).cast("long")))
        now = keyed.join(hint, ["mask", "value"]).select("fp", "mask", "value", "n")
        if level == LEVELS - 1:  # each two blocks of what is left
            blocks = F.ceil(2 * F.col("n") / BUCKET).cast("long")
            dealt = now.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")))
            other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
            dealt = dealt.select("fp", "mask", "value", "own", "blocks", other.alias("other"))
            deal = F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")
            out.append(dealt.select("fp", "mask", "value", deal.alias("deal")))
        else:
            now = save(now.select("fp", "mask"), "split")
    united = out[0].select("mask", "value", "deal", "fp")
    for more in out[1:]:
        united = united.unionByName(more.select("mask", "value", "deal", "fp"))
    return united


def near_duplicates(docs: DataFrame, k: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, fp (the 64 bits as a signed number), component_id.

    Two rows link when their fingerprints differ in at most RADIUS bits; component_id is the smallest id reachable by links, the row's own
    included. Null and blank texts have fingerprint zero and link like any other; a text of fewer than k words is one shingle; a very
    long one is counted piece by piece. Equal texts and repeated rows share a fingerprint and keep a row each. Null ids name a
    component only if all its ids are null. Ids keep their type and must have an order. Other columns are ignored, whatever their
    names. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = f"doc_id {own.schema['doc_id'].dataType.simpleString()}, fp long"
    rows = save(own.mapInArrow(_fingerprints(k), kind), "fingerprints", ROWS)
    fps = save(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = _buckets(fps).repartition(parts, "mask", "value", "deal").sortWithinPartitions("mask", "value", "deal")
    edges = save(edges.mapInArrow(_compared, "a long, b long").distinct(), "edges")
    comp = components(edges)
    member = comp.withColumnRenamed("node", "fp").join(fps, "fp")
    named = save(member.groupBy("comp").agg(F.min("least").alias("component_id")), "named")
    linked = member.join(_small(named), "comp").select("fp", "component_id")
    told = save(fps.join(_small(linked), "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id")), "components")
    drop(edges, comp, named, fps)
    return rows.join(_small(told), "fp", "left").select("doc_id", "fp", "component_id")
