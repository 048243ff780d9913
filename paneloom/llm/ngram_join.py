"""Jaccard join of documents on word shingles with adaptive multi-match prefixes.

Method. All shingles are ordered by a hash. If two sets reach the similarity, then for every l they share at least l
shingles among their first ``n - ceil(t n) + l`` each. A shingle that many documents hold ("hot") makes a costly join key,
so each document lengthens its prefix until the number of matches then required exceeds the number of hot shingles in it:
some of the required matches must then be on cheap shingles, and only those are joined. Among the lengths that allow this,
the one with the least estimated candidate cost is taken. Every pair in a bucket of a cheap shingle, which has few holders, is
formed, counted against the required number of matches and verified.

Documents whose shingles are hot nearly throughout (large groups of near copies, texts made of common passages) have no such
length. They are grouped by a hot shingle, and each is told by its difference from a centre, the shingles that most of the group
have. With p the centre's size, d and e the shingles that a document lacks and has besides, and o the differences that two
documents share, their sets have p - d1 - d2 + o shingles in common of p + e1 + e2 - o. So they link exactly when

    (100 + pct) o >= c1 + c2 - (100 - pct) p        with  c = 100 d + pct e

Pairs with c1 + c2 <= (100 - pct) p link whatever they share: they are counted by rank, and an edge of each to the document of the
least c joins them, without forming pairs. All other pairs must share differences: they are found by prefixes of the differences,
rarest first, again with the number of matches that a document's c asks for, and are paired in blocks of bounded size, which give
counts and a spanning forest instead of pairs. What is in no group or in different ones is joined by equal parts of the sets: a
set is split by hash into one part more than a link may have differences, so that one part at least is equal.

Before the sets of a candidate are fetched, small parity sketches of both are compared: every shingle flips one bit, so the
bits in which two sketches differ are at most as many as the shingles that only one of the sets has. A pair with more such bits
than a link may have differences is no link; this rejects most near misses and never a link.

Copies with equal shingle sets are one node throughout. Sets are compared by 64-bit hashes of shingles, and a set is named
by a 64-bit hash; both make an error only on a hash collision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import drop, save
from .text import mix, shingle_sets

#: A shingle held by so many documents is hot. Doubled until at most MOST_HOT shingles are, which bounds the broadcast to 8 MB.
HOT_DF, MOST_HOT = 32, 1 << 20
#: Counts of shingles above this are told to the cost estimate (all others count as unshared), within the same bound.
WARM_DF = 4
#: Matches that any prefix may ask for, besides two fifths of the shortest prefix's length.
EXTRA = 24
#: Cost of verifying a candidate, in joined rows: two sets travel for it.
VERIFY = 400
#: A filter on node ids is broadcast up to this count (16 MB), and joined by a shuffle beyond it.
MOST_IDS = 1 << 21
#: Holders of a part of hot documents' sets, or of a difference, are paired in blocks of about so many.
BLOCK = 256
#: A centre is taken from about so many documents of its group; a document is told by its difference from it where that has at
#: most this share of the centre's size.
VOTERS, APART = 64, 0.5
#: Texts or sets, which may be long, go to Python by so many at once.
ROWS = 1000
#: 64-bit words of a parity sketch. Sketches of so many nodes (16 MB) are broadcast; more are joined by a shuffle.
SKETCH, MOST_SKETCHES = 8, 1 << 17


def _need(n, pct: int):
    """ceil(pct/100 * n) in integers."""
    return -((-pct * n) // 100)


def _reach(n, pct: int, up: bool):
    """Most matches that a prefix may ask for; documents that are joined on all their levels hold the upper value, which is no
    less than the lower one of any document they may link with."""
    extra = (100 - pct) * n * (1000 if up else 10 * pct)
    return 1 + EXTRA + (-(-extra // 250_000) if up else extra // 250_000)


def _classes(n: int, pct: int) -> list[int]:
    """Bounds of size classes up to n's: linked sets are of the same class or of neighbouring ones."""
    bounds = [1]
    while len(bounds) < 3 or bounds[-3] <= n:
        bounds.append(bounds[-1] * 100 // pct + 1)
    return bounds


def _name(s: np.ndarray) -> int:
    return int(np.array([mix(s + np.uint64(77)).sum() + np.uint64(len(s))], np.uint64).view(np.int64)[0])


def _sketch(s: np.ndarray) -> np.ndarray:
    """Parity of the number of elements at each of 64 * SKETCH places."""
    odd = np.bincount((s % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(batches, k: int):
    for batch in batches:
        yield batch.column(0), list(shingle_sets(batch.column(1), k))


def _prefixes(pct: int, k: int):
    def run(batches):
        for ids, sets in _sets(batches, k):
            n = [len(s) for s in sets]
            keep = [min(m, m - _need(m, pct) + _reach(m, pct, True)) for m in n]
            yield pa.RecordBatch.from_arrays(
                [
                    ids.cast(pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array([_name(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([s[:m].view(np.int64) for s, m in zip(sets, keep)], pa.list_(pa.int64())),
                    pa.array([_sketch(s) for s in sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "node", "prefix", "sketch"],
            )

    return run


def _keys(pct: int, known, bar: int):
    """Rows (tok, node, n, lvl, l, h): the join keys of each node. l: matches asked for, of which h can be hot. A row of level 0
    tells that the node is hot throughout; its tok is the first hot shingle of the count, in powers of two, that most of them have."""

    def run(batches):
        hots, dfs = known.value
        for batch in batches:
            out = [[] for _ in range(6)]
            nodes, sizes = batch.column("node").to_numpy(), batch.column("n").to_numpy()
            for node, n, toks in zip(nodes, sizes, batch.column("prefix")):
                toks = toks.values.to_numpy()
                p0 = int(n - _need(n, pct) + 1)
                at = np.minimum(np.searchsorted(hots, toks), len(hots) - 1)
                df = np.where(hots[at] == toks, dfs[at], 1)
                is_hot = df >= bar
                lvl = np.maximum(1, np.arange(1, len(toks) + 1) - p0 + 1)
                most = min(int(_reach(n, pct, False)), len(toks) - p0 + 1)
                n_hot = np.cumsum(is_hot)[p0 - 1 : p0 - 1 + most]
                asked = np.arange(1, most + 1)
                free = np.flatnonzero(n_hot < asked)
                if len(free):  # a row for each key and each other holder of it, a verification for each so many shared ones
                    near = np.cumsum(np.where(is_hot, 0, df - 1))[p0 - 1 : p0 - 1 + most][free]
                    best = free[np.argmin(p0 + asked[free] - n_hot[free] + near * (1 + VERIFY / (asked[free] - n_hot[free])))]
                    l, h = int(asked[best]), int(n_hot[best])
                    use = ~is_hot & (lvl <= l)
                    rows = toks[use], lvl[use]
                else:
                    l, h = int(n) + 1, 0
                    powers = np.log2(df[is_hot]).astype(np.int64)
                    group = toks[is_hot][powers == np.bincount(powers).argmax()][0]
                    rows = np.append(toks[~is_hot], group), np.append(lvl[~is_hot], 0)
                m = len(rows[0])
                for c, v in zip(out, (rows[0], np.full(m, node), np.full(m, n), rows[1], np.full(m, l), np.full(m, h))):
                    c.append(v)
            cols = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c).cast(t) for c, t in zip(cols, kinds)], ["tok", "node", "n", "lvl", "l", "h"])

    return run


def _parts(pct: int):
    """Rows for the parts of a hot document's set, for its size class and the one below."""

    def run(batches):
        for batch in batches:
            toks, nodes, sizes, groups, owns = [], [], [], [], []
            for node, toks_of in zip(batch.column("node").to_pylist(), batch.column("toks")):
                s = toks_of.values.to_numpy().view(np.uint64)
                bounds = _classes(len(s), pct)
                own = len(bounds) - 3 - (bounds[-3] > len(s))
                for g in range(max(0, own - 1), own + 1):
                    parts = (100 - pct) * (bounds[g + 1] + bounds[g + 2] - 2) // (100 + pct) + 1
                    at = ((s >> np.uint64(13)) % np.uint64(parts)).astype(np.int64)
                    sums = np.zeros(parts, np.uint64)
                    np.add.at(sums, at, mix(s + np.uint64(3)))
                    toks.append(mix(sums + np.uint64(g * 1_000_003 + 1) * (np.arange(parts, dtype=np.uint64) * np.uint64(2) + np.uint64(1))).view(np.int64))
                    for c, v in zip((nodes, sizes, groups, owns), (node, len(s), g, own)):
                        c.append(np.broadcast_to(np.asarray(v, np.int64), parts))
            cols = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in (toks, nodes, sizes, groups, owns)]
            yield pa.RecordBatch.from_arrays(cols, ["tok", "node", "n", "part_class", "own_class"])

    return run


def _set_rows(k: int):
    def run(batches):
        for _, sets in _sets(batches, k):
            sets = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([_name(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "set"])

    return run


def _as_longs(batches):
    for batch in batches:
        sets = [np.frombuffer(raw.as_buffer(), np.int64) for raw in batch.column("set")]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "toks"])


def _linked(x: bytes, y: bytes, pct: int) -> bool:
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    z = np.concatenate([x, y])
    z.sort(kind="stable")
    both = int(np.count_nonzero(z[1:] == z[:-1]))
    return 100 * both >= pct * (len(x) + len(y) - both)


def _verified(pct: int):
    """Pairs that link, of rows (a, b, set_a, set_b)."""

    def run(batches):
        for batch in batches:
            keep = [i for i, (x, y) in enumerate(zip(batch.column("set_a"), batch.column("set_b"))) if _linked(x.as_buffer(), y.as_buffer(), pct)]
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node of edges (a, b): least label of the neighbours, then of the label's own node, until nothing changes."""
    both = save(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    comp = save(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("comp")), "comp")
    while True:
        # the label tables are small unless billions of rows link: broadcast, a node with many edges is no key of a shuffle
        near = both.join(_if_small(comp.withColumnRenamed("node", "b")), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("m"))
        hop = _if_small(comp.select(F.col("node").alias("comp"), F.col("comp").alias("far")))
        new = comp.join(near, "node").join(hop, "comp").select("node", F.least("comp", "m", "far").alias("new"), F.col("comp").alias("old"))
        new = save(new, "comp")
        done = new.where("new < old").isEmpty()
        drop(comp)
        comp = new.select("node", F.col("new").alias("comp"))
        comp._saved_at = new._saved_at
        if done:
            drop(both)
            return comp


class _Texts:
    """Sets of nodes, made again from the texts of one document of each node."""

    def __init__(self, docs: DataFrame, rows: DataFrame, k: int):
        self.docs, self.rows, self.k = docs, rows, k

    def of(self, nodes: DataFrame) -> DataFrame:
        heads = self.rows.join(nodes.select("node"), "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
        heads = save(heads, "heads")
        ids = heads.select("doc_id").distinct()
        if heads.count() <= MOST_IDS:
            ids = F.broadcast(ids)
        found = self.docs.join(ids, self.docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi").mapInArrow(_set_rows(self.k), "node long, set binary")
        return found.dropDuplicates(["node"])


def _sketched(pairs: DataFrame, sketches: DataFrame, pct: int) -> DataFrame:
    """Pairs (a, b) whose sketches differ in no more bits than their sets may in shingles."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    known = save(sketches.join(ends, "node", "left_semi"), "sketches")
    if known.count() <= MOST_SKETCHES:
        known = F.broadcast(known)
    a, b = (known.select(F.col("node").alias(c), F.col("sketch").alias(f"sketch_{c}"), F.col("n").alias(f"n{c}")) for c in "ab")
    differ = F.expr(" + ".join(f"bit_count(sketch_a[{i}] ^ sketch_b[{i}])" for i in range(SKETCH)))
    return pairs.join(b, "b").join(a, "a").where((100 + pct) * differ <= (100 - pct) * (F.col("na") + F.col("nb"))).select("a", "b")


def links(pairs: DataFrame, texts: _Texts, sketches: DataFrame, pct: int) -> DataFrame:
    """The pairs of `pairs` (a, b), each there once, that link."""
    every = save(pairs.select("a", "b"), "candidates")
    if every.isEmpty():
        return every
    pairs = save(_sketched(every, sketches, pct), "pairs")
    drop(every)
    if pairs.isEmpty():
        return pairs
    sets = save(texts.of(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()), "sets", ROWS)
    # pairs are the streamed side of both joins: the engine splits the partition of a document with many pairs
    a, b = (sets.select(F.col("node").alias(c), F.col("set").alias(f"set_{c}")) for c in "ab")
    found = pairs.join(b.hint("merge"), "b").join(a.hint("merge"), "a").select("a", "b", "set_a", "set_b").mapInArrow(_verified(pct), "a long, b long")
    found = save(found, "links", ROWS)
    drop(pairs, sets)
    return found


def _alike(pct: int, x: str, y: str):
    """Sizes x and y allow the similarity."""
    return 100 * F.least(x, y) >= pct * F.greatest(x, y)


def _matched_pairs(cheap: DataFrame, pct: int) -> DataFrame:
    """(a, b): every pair that shares as many cheap shingles of its prefixes as a link must. Two documents that are hot throughout
    are left out: they are joined another way."""
    pairs = cheap.select(F.posexplode("held").alias("i", "x"), "held").select("x", F.explode(F.expr("slice(held, i + 2, size(held))")).alias("y"))
    pairs = pairs.where("x.lvl <= least(x.l, y.l) and y.lvl <= least(x.l, y.l) and not (x.l > x.n and y.l > y.n)").where(_alike(pct, "x.n", "y.n"))
    asked = F.expr("case when x.l <= y.l then x.l - x.h else y.l - y.h end")
    return pairs.groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b")).agg(F.count("*").alias("m"), F.max(asked).alias("asked")).where("m >= asked").select("a", "b")


def _if_small(df: DataFrame) -> DataFrame:
    """df to be broadcast, if its rows, of a few numbers each, are at most MOST_IDS."""
    return F.broadcast(df) if df.count() <= MOST_IDS else df


def _centres(sets: DataFrame) -> DataFrame:
    """(grp, centre, centre_set, salts): the shingles that most of a group's voters have, and a name that equal centres share."""
    size = sets.groupBy("grp").agg(F.count("*").alias("size")).where("size > 1")
    voters = sets.join(_if_small(size), "grp").where(F.pmod(F.xxhash64("node"), F.col("size")) < VOTERS)
    votes = voters.select("grp", "size", F.explode("toks").alias("tok")).groupBy("grp", "size", "tok").agg(F.count("*").alias("n"))
    most = voters.groupBy("grp").agg(F.count("*").alias("m"))
    held = votes.join(_if_small(most), "grp").where("2 * n > m").groupBy("grp", "size").agg(F.array_sort(F.collect_list("tok")).alias("centre_set"))
    return held.select("grp", F.xxhash64("centre_set").alias("centre"), "centre_set", F.ceil(F.col("size") / 4096).cast("int").alias("salts"))


def _differences(pct: int):
    """Rows (node, n, centre, p, c, diff); centre is null where the difference is too large to be of use."""

    def run(batches):
        for batch in batches:
            cs, ps, diffs, names = [], [], [], []
            for toks, core, name in zip(batch.column("toks"), batch.column("centre_set"), batch.column("centre").to_pylist()):
                s, m = toks.values.to_numpy(), core.values.to_numpy() if core.is_valid else np.zeros(0, np.int64)
                extra, lacks = np.setdiff1d(s, m, assume_unique=True), np.setdiff1d(m, s, assume_unique=True)
                near = len(extra) + len(lacks) <= APART * len(m)
                cs.append(pct * len(extra) + 100 * len(lacks))
                ps.append(len(m))
                diffs.append(np.concatenate([extra, lacks]) if near else np.zeros(0, np.int64))
                names.append(name if near else None)
            cols = [batch.column("node"), batch.column("n"), pa.array(names, pa.int64()), pa.array(ps, pa.int64()), pa.array(cs, pa.int64()), pa.array(diffs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, ["node", "n", "centre", "p", "c", "diff"])

    return run


def _ranked(near: DataFrame, pct: int) -> DataFrame:
    """(a, b, m): links of pairs with c1 + c2 <= (100 - pct) p: their number m for each document, and an edge to the least c."""
    budget = (100 - pct) * F.col("p")
    many = near.where(F.col("c") <= budget).groupBy("centre", "p", "c").agg(F.count("*").alias("n"))
    many = save(many, "ranks")
    told = many.select("centre", F.col("c").alias("at"), "n", F.lit(None).cast("long").alias("c"))
    asks = many.select("centre", (budget - F.col("c")).alias("at"), F.lit(0).cast("long").alias("n"), "c")
    upto = F.sum("n").over(Window.partitionBy("centre").orderBy("at").rangeBetween(Window.unboundedPreceding, 0))
    upto = told.unionByName(asks).withColumn("m", upto).where("c is not null").select("centre", "c", "m")
    first = near.groupBy("centre").agg(F.min(F.struct("c", "node")).alias("first"))
    out = near.join(_if_small(save(upto, "upto")), ["centre", "c"]).join(_if_small(save(first, "first")), "centre")
    out = out.select(F.col("node").alias("a"), F.col("first.node").alias("b"), (F.col("m") - (2 * F.col("c") <= budget).cast("long")).alias("m"))
    return out.where("m > 0")


def _difference_keys(pct: int, known, warm: int):
    """Rows (centre, tok, node, p, c, diff): the prefix of each document's difference, rarest first. Shingles that are in no other
    difference of the centre are left out of both where all counts from 2 on are known."""

    def run(batches):
        names, dfs = known.value
        for batch in batches:
            out = [[] for _ in range(6)]
            for centre, node, p, c, diff in zip(*(batch.column(x).to_pylist() for x in ("centre", "node", "p", "c")), batch.column("diff")):
                toks = diff.values.to_numpy()
                name = mix(toks.view(np.uint64) ^ np.uint64(centre % 2**64)).view(np.int64)
                at = np.minimum(np.searchsorted(names, name), len(names) - 1)
                df = np.where(names[at] == name, dfs[at], 1)
                order = np.lexsort((toks, df))
                asked = max(1, -(-(c - (100 - pct) * p) // 100))
                shared = np.flatnonzero(df[order] >= warm) if warm == 2 else np.arange(len(toks))
                prefix = shared[shared < len(toks) - asked + 1]
                rest = toks[order[shared]]
                for col, v in zip(out, (centre, toks[order[prefix]], node, p, c, rest)):
                    col += v.tolist() if col is out[1] else [v] * len(prefix)
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds)], ["centre", "tok", "node", "p", "c", "diff"])

    return run


def _forest(link: np.ndarray, x: np.ndarray, y: np.ndarray):
    """(a, b, m) of the rows x and columns y that link: the number of links and the least node of what they are connected with."""
    keep_x, keep_y = link.any(1), link.any(0)
    link, x, y = link[keep_x][:, keep_y], x[keep_x], y[keep_y]
    if not len(x):
        return []
    top = np.iinfo(np.int64).max
    at_x, at_y = x.copy(), y.copy()
    while True:
        new_y = np.minimum(at_y, np.where(link, at_x[:, None], top).min(0))
        new_x = np.minimum(at_x, np.where(link, new_y[None, :], top).min(1))
        if (new_x == at_x).all() and (new_y == at_y).all():
            return [(x, at_x, link.sum(1)), (y, at_y, link.sum(0))]
        at_x, at_y = new_x, new_y


def _block_links(tok: int, rows: list, pct: int):
    """Links of one block of holders of a difference: rows (side, node, p, c, diff)."""
    x, y = ([r for r in rows if r[0] == side] for side in (0, 1))
    if not x or not y:
        return []
    tokens = np.intersect1d(np.concatenate([r[4] for r in x]), np.concatenate([r[4] for r in y]))
    every, before = [], []
    for side in (x, y):
        full, early = np.zeros((2, len(side), len(tokens)), np.float32)
        for i, r in enumerate(side):
            place = np.searchsorted(tokens, r[4])
            place[place == len(tokens)] = 0
            here = tokens[place] == r[4]
            full[i, place[here]] = 1
            early[i, place[here & (np.arange(len(r[4])) < np.flatnonzero(r[4] == tok)[0])]] = 1
        every.append(full)
        before.append(early)
    (nx, cx), (ny, cy) = ((np.array([r[1] for r in side]), np.array([r[3] for r in side])) for side in (x, y))
    p = x[0][2]
    over = cx[:, None] + cy[None, :] - (100 - pct) * p
    far_x = 2 * cx > (100 - pct) * p  # two far ones meet twice
    link = (over > 0) & ((100 + pct) * (every[0] @ every[1].T) >= over) & (before[0] @ before[1].T == 0) & (nx[:, None] != ny[None, :])
    return _forest(link & (~far_x[:, None] | (nx[:, None] < ny[None, :])), nx, ny)


def _blocks(pct: int):
    """Rows (a, b, m) of blocks, each of which stands in consecutive rows."""

    def run(batches):
        key, rows = None, []

        def told():
            found = _block_links(key[1], rows, pct) if rows else []
            a, b, m = (np.concatenate(c) for c in zip(*found)) if found else [np.zeros(0, np.int64)] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, b, m)], ["a", "b", "m"])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("centre", "tok", "bx", "by", "side", "node", "p", "c")]
            for *now, side, node, p, c, diff in zip(*cols, batch.column("diff")):
                if now != key:
                    if rows:
                        yield told()
                    key, rows = now, []
                rows.append((side, node, p, c, diff.values.to_numpy()))
        yield told()

    return run


def _sharing(near: DataFrame, pct: int) -> DataFrame:
    """(a, b, m): links of pairs of one centre that need shared differences, as counts and spanning forests of blocks."""
    spark = near.sparkSession
    counts = near.select("centre", F.explode("diff").alias("tok")).groupBy("centre", "tok").agg(F.count("*").alias("df")).where("df > 1")
    counts = save(counts, "difference_counts")
    warm = 2
    while (told := counts.where(F.col("df") >= warm)).count() > MOST_HOT:
        warm *= 2
    told = told.toArrow()
    name = mix(told.column("tok").to_numpy().view(np.uint64) ^ told.column("centre").to_numpy().view(np.uint64)).view(np.int64)
    order = np.argsort(name)
    known = [name[order], told.column("df").to_numpy()[order]] if len(told) else [np.zeros(1, np.int64), np.zeros(1, np.int64)]
    keys = near.mapInArrow(_difference_keys(pct, spark.sparkContext.broadcast(known), warm), "centre long, tok long, node long, p long, c long, diff array<long>")
    keys = save(keys.withColumn("far", 2 * F.col("c") > (100 - pct) * F.col("p")), "difference_keys")
    # two documents that are both near the centre never need shared differences: each pair has a far one as its second
    size = keys.groupBy("centre", "tok").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("nx"), F.ceil(F.count_if("far") / BLOCK).cast("int").alias("ny"), F.count("*").alias("n"))
    size = save(size.where("ny > 0 and n > 1").drop("n"), "difference_sizes")
    keys = keys.join(_if_small(size), ["centre", "tok"])
    deal = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    x = keys.withColumn("bx", deal("nx")).withColumn("by", each("ny")).withColumn("side", F.lit(0))
    y = keys.where("far").withColumn("by", deal("ny")).withColumn("bx", each("nx")).withColumn("side", F.lit(1))
    both = x.unionByName(y).select("centre", "tok", "bx", "by", "side", "node", "p", "c", "diff")
    block = ["centre", "tok", "bx", "by"]
    found = both.repartition(*block).sortWithinPartitions(*block).mapInArrow(_blocks(pct), "a long, b long, m long")
    found = save(found, "sharing")
    drop(counts)
    return found


def _part_pairs(parts: DataFrame, sketches: DataFrame, pct: int) -> DataFrame:
    """(a, b): every pair with an equal part, of the lower of their size classes, that is not of one centre and whose sketches allow
    a link."""
    apart = F.max(F.col("centre").isNull()) | (F.min("centre") < F.max("centre"))
    sizes = parts.groupBy("tok").agg(F.count("*").alias("m"), apart.alias("apart")).where("m > 1 and apart").select("tok", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    here = parts.join(_if_small(save(sizes, "open")), "tok")
    here = save(here.join(sketches.select("node", "sketch"), "node"), "open_parts")
    # holders of a part are dealt by node to blocks of about BLOCK; each pair of blocks is a join key of its own
    here = here.withColumn("own_block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    x, y = (here.select("tok", "own_block", other.alias("block"), *[F.col(c).alias(c + s) for c in ("node", "n", "centre", "part_class", "own_class", "sketch")]) for s in "xy")
    x, y = x.withColumnsRenamed({"own_block": "bx", "block": "by"}), y.withColumnsRenamed({"own_block": "by", "block": "bx"})
    differ = " + ".join(f"bit_count(sketchx[{i}] ^ sketchy[{i}])" for i in range(SKETCH))
    allowed = F.expr(f"{100 + pct} * ({differ}) <= {100 - pct} * (nx + ny)") & F.expr("nodex < nodey and part_classx = least(own_classx, own_classy) and coalesce(centrex <> centrey, true)")
    return x.join(y, ["tok", "bx", "by"]).where(allowed & _alike(pct, "nx", "ny")).select(F.col("nodex").alias("a"), F.col("nodey").alias("b")).distinct()


def _dense_links(dense: DataFrame, texts: _Texts, sketches: DataFrame, pct: int) -> tuple[DataFrame, DataFrame]:
    """Of documents that are hot throughout (node, n, grp): pairs (a, b) to be verified, and links told as (a, b, m)."""
    sets = texts.of(dense.select("node"))
    longs = sets.mapInArrow(_as_longs, "node long, toks array<long>")
    longs = save(longs.join(dense, "node"), "dense_sets", ROWS)
    centres = save(_centres(longs), "centres")
    salted = longs.join(_if_small(save(centres.select("grp", "salts"), "salts")), "grp", "left").withColumn("salt", F.pmod(F.xxhash64("node"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
    centres = centres.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    told = salted.join(centres, ["grp", "salt"], "left").select("node", "n", "toks", "centre", "centre_set")
    told = save(told.mapInArrow(_differences(pct), "node long, n long, centre long, p long, c long, diff array<long>"), "differences", ROWS)
    near = told.where("centre is not null").select("centre", "node", "p", "c", "diff")
    found = _ranked(near, pct).unionByName(_sharing(near, pct))
    parts = longs.select("node", F.col("toks")).mapInArrow(_parts(pct), "tok long, node long, n long, part_class long, own_class long")
    parts = save(parts.join(told.select("node", "centre"), "node"), "parts")
    pairs = save(_part_pairs(parts, sketches, pct), "part_pairs")
    found = save(found, "told")
    drop(longs, parts, told)
    return pairs, found


def near_duplicates(docs: DataFrame, k: int = 5, pct: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, n_links.

    Two texts link when ``100 * intersection >= pct * union`` of their sets of k-word shingles. component_id is the smallest id
    that is reachable by links; n_links counts the different sets that the row's set links to (0: none). Null or blank texts have
    no shingles and link with nothing: component_id is their own id. Repeated rows and equal texts are one node and keep a row
    each. A null id never names a component unless all its ids are null. A very long text is a longer set and nothing else. Other
    columns are ignored, whatever their names. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    full = save(docs.mapInArrow(_prefixes(pct, k), "doc_id long, n long, node long, prefix array<long>, sketch array<long>"), "shingled", ROWS)
    rows = save(full.select("doc_id", "n", "node"), "rows")
    # only nodes of several rows need be made distinct: the others keep where they are
    again = save(rows.where("node is not null").groupBy("node").agg(F.count("*").alias("m")).where("m > 1").select("node"), "copies")
    hint = _if_small(again)
    once = full.where("node is not null").select("node", "n", "prefix", "sketch")
    nodes = save(once.join(hint, "node", "left_anti").unionByName(once.join(hint, "node", "left_semi").dropDuplicates(["node"])), "nodes")
    drop(full, again)
    sketches = nodes.select("node", "n", "sketch")

    counts = save(nodes.select(F.explode("prefix").alias("tok")).groupBy("tok").agg(F.count("*").alias("df")).where(F.col("df") >= WARM_DF), "df")
    warm, bar = WARM_DF, HOT_DF
    while (told := counts.where(F.col("df") >= warm)).count() > MOST_HOT:
        warm *= 2
    bar = max(bar, warm)
    told = told.orderBy("tok").toArrow()
    known = [told.column(c).to_numpy() for c in ("tok", "df")] if len(told) else [np.zeros(1, np.int64), np.zeros(1, np.int64)]
    keyed = nodes.select("node", "n", "prefix").mapInArrow(_keys(pct, spark.sparkContext.broadcast(known), bar), "tok long, node long, n int, lvl int, l int, h int")
    # a cheap shingle has fewer than `bar` holders: its bucket is one small row
    held = keyed.where("lvl > 0").repartition("tok").groupBy("tok").agg(F.array_sort(F.collect_list(F.struct("node", "n", "lvl", "l", "h"))).alias("held"))
    cheap = save(held.where("size(held) > 1").select("held"), "buckets")
    texts = _Texts(docs, rows, k)
    dense = save(keyed.where("lvl = 0").select("node", F.col("n").cast("long"), F.col("tok").alias("grp")), "dense")
    pairs, found = _dense_links(dense, texts, sketches, pct)
    # a pair with an equal part has a document that is hot throughout at both ends, a pair with cheap matches has not
    pairs = save(_matched_pairs(cheap, pct).unionByName(pairs), "candidates")
    drop(counts, cheap)
    verified = links(pairs, texts, sketches, pct)
    found = save(found.unionByName(verified.select("a", "b", F.lit(1).cast("long").alias("m"))).unionByName(verified.select(F.col("b").alias("a"), F.col("a").alias("b"), F.lit(1).cast("long").alias("m"))), "found")
    comp = components(found.where("a <> b"))

    ids = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least_id"))
    degree = found.groupBy(F.col("a").alias("node")).agg(F.sum("m").alias("n_links"))
    member = comp.join(ids, "node")
    least = member.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    linked = member.join(least, "comp").select("node", "component_id")
    named = ids.join(linked, "node", "left").join(degree, "node", "left").select("node", F.coalesce("component_id", "least_id").alias("component_id"), "n_links")
    return rows.join(named, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")
    )
