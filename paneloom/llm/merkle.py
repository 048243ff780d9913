"""Merkle manifest of a table, with a proof for every row by pointer jumping.

Every row is a leaf. The leaves of a group stand in order; every two consecutive nodes become one node of the level above (the last
may be alone) until one is left, the group's subroot. The subroots, in the order of their groups, become the root likewise.

Digests are made in runs of 2^HEIGHT consecutive nodes, so a tree of any size takes a few passes. A node then knows the step to its
parent: its sibling and the side it stands on. For the proofs each node holds a pointer to an ancestor and the segment of steps up to it.
A round joins the nodes with themselves: the pointer goes on to the ancestor's own ancestor and both segments are put together, which
doubles the distance. After round r only nodes on every 2^r-th level are still pointed to, so the others are left out. After as many
rounds as the depth has binary digits every leaf has the whole way to the root.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .prefix_sums import running_sums
from .store import drop, save

#: Levels that are made in one task from a run of consecutive nodes.
HEIGHT = 8
#: The joined side of a round is broadcast up to so many bytes of segments, and joined by a shuffle beyond.
MOST_BYTES = 1 << 22
#: Groups up to this count are broadcast to their rows (at most 64 MB).
MOST_GROUPS = 1 << 19
#: The tree over the subroots has this in place of a group's number.
_TOP = -1
#: A step of a proof is its side, then the sibling's 32 bytes; a node that is alone has a step of the first byte only.
ALONE, LEFT, RIGHT = b"\0", b"\1", b"\2"
_STEP = 33
_NODE = {"grp": T.LongType, "n": T.LongType, "level": T.IntegerType, "pos": T.LongType, "digest": T.BinaryType, "step": T.BinaryType}


def leaf_digest(*fields: Column) -> Column:
    """Digest of a row: its fields in order, each as '-' if null, else as its length in UTF-8 bytes, a colon and its value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _digest(*nodes: bytes) -> bytes:
    return hashlib.sha256("".join(x.hex() for x in nodes).encode()).digest()


def _grown(base: int):
    """Runs of nodes of level `base` become rows for these nodes and those above them. step is null for the last ones made, which are
    the tree's root or go on to the next pass."""

    def run(batches):
        for batch in batches:
            held = batch.column("held")
            flat, at = held.flatten(), 0
            digests = flat.field("digest").to_pylist()
            lower, upper = [], []
            for grp, n, first, count in zip(*(batch.column(c).to_pylist() for c in ("grp", "n", "first")), held.value_lengths().to_pylist()):
                nodes, pos, total = digests[at : at + count], first, -(-n >> base)
                at += count
                for level in range(base, base + HEIGHT + 1):
                    last = total == 1 or level == base + HEIGHT
                    steps = [None] * len(nodes) if last else _steps(nodes)
                    (lower if level == base else upper).extend((grp, n, level, pos + i, x, step) for i, (x, step) in enumerate(zip(nodes, steps)))
                    if last:
                        break
                    nodes, pos, total = [_digest(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)], pos >> 1, -(-total >> 1)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            out = [pa.array([r[i] for r in lower + upper], kind) for i, kind in enumerate(kinds)]
            names = ["grp", "n", "level", "pos", "digest", "step"]
            if base == 0 and flat.type.get_field_index("row") >= 0:
                out.append(pa.concat_arrays([flat.field("row"), pa.nulls(len(upper), flat.field("row").type)]))
                names.append("row")
            yield pa.RecordBatch.from_arrays(out, names)

    return run


def _steps(nodes: list[bytes]) -> list[bytes]:
    """The step of each of these consecutive nodes, the first of which is a left one."""
    out = [ALONE] * len(nodes)
    for i in range(0, len(nodes) - 1, 2):
        out[i], out[i + 1] = RIGHT + nodes[i + 1], LEFT + nodes[i]
    return out


def _depth(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    return max(0, n - 1).bit_length()


def _trees(leaves: DataFrame, most: int) -> list[DataFrame]:
    """Tables (grp, n, level, pos, digest, step[, row]) of the trees over leaves (grp, n, pos, digest[, row]), the largest of which has
    `most`; only leaves have a row. Nodes on the bounds of two passes are in both, in the first without a step."""
    now, out = leaves, []
    for base in range(0, max(1, _depth(most)), HEIGHT):
        own = [c for c in ("pos", "digest", "row") if c in now.columns]
        runs = now.groupBy("grp", "n", F.shiftright("pos", HEIGHT).alias("block"))
        runs = runs.agg(F.min("pos").alias("first"), F.array_sort(F.collect_list(F.struct(*own))).alias("held"))
        kind = T.StructType([T.StructField(c, t()) for c, t in _NODE.items()])
        if "row" in own:
            kind = kind.add("row", now.schema["row"].dataType)
        out.append(save(runs.mapInArrow(_grown(base), kind), "nodes", 100))
        now = out[-1].where("step is null").where(F.expr(f"level = {base + HEIGHT} and n > shiftleft(1L, level)")).select("grp", "n", "pos", "digest")
    return out


def _united(tables: list[DataFrame]) -> DataFrame:
    out = tables[0].drop("row")
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _tops(tables: list[DataFrame]) -> DataFrame:
    """(grp, digest) of the last node of each tree."""
    return _united(tables).where("step is null").where(F.expr("n <= shiftleft(1L, level)")).select("grp", "digest")


def _pointers(nodes: DataFrame, groups_depth: int) -> DataFrame:
    """Nodes (g, l, p) with a pointer (to_g, to_l, to_p) to their parent and the step to it as segment `way`. A group's last node is a leaf of
    the tree over the groups. A null pointer means that the segment ends at the root."""
    g, level, pos = F.col("grp"), F.col("level"), F.col("pos")
    lone = F.col("step").isNull()
    ends = lone | F.expr("n <= shiftleft(1L, level + 1)")
    final = ends & ((g == _TOP) | F.lit(groups_depth == 0))
    up = ends & (g != _TOP)
    to = {
        "to_g": F.when(up, F.lit(_TOP).cast("long")).otherwise(g),
        "to_l": F.when(up, F.lit(0)).otherwise(level + 1),
        "to_p": F.when(up, g).otherwise(F.shiftright(pos, 1)),
    }
    own = nodes.where("step is not null or (level = 0 and n = 1 and grp <> -1)")
    return own.select(
        g.alias("g"), level.alias("l"), pos.alias("p"), F.coalesce("step", F.lit(b"")).alias("way"), *[F.when(~final, c).alias(k) for k, c in to.items()],
        *[c for c in nodes.columns if c == "row"],
    )


def _jump(left: DataFrame, ancestors: DataFrame, small: bool) -> DataFrame:
    """left with pointers and segments that go on by those of the ancestors they point to. A row whose segment is whole stays as it is."""
    far = ancestors.select(*[F.col(c).alias("_" + c) for c in ("g", "l", "p", "to_g", "to_l", "to_p", "way")])
    far = F.broadcast(far) if small else far.hint("merge")
    met = left.where("to_g is not null").join(far, [F.col(f"to_{c}") == F.col(f"_{c}") for c in "glp"])
    moved = {f"to_{c}": F.col(f"_to_{c}") for c in "glp"} | {"way": F.concat("way", "_way")}
    met = met.select(*[moved.get(c, F.col(c)).alias(c) for c in left.columns])
    return left.where("to_g is null").unionByName(met)


def manifest(
    docs: DataFrame,
    fields: tuple = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "lang",
    order: str = "doc_id",
    also: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of docs: the order column, the columns of `also`, leaf, subroot, root (binary), and proof, the steps from leaf to root.

    Leaves of a group ascend by the order column, nulls first; ties stand by their digests, and repeated rows are leaves each. Groups
    are ordered as UTF-8 bytes, null first, and null is a group of its own. Null fields have a digest of their own ('-'), an empty text
    is not a null one, and a very long text is hashed whole. A lone leaf is its own subroot, a lone subroot the root, and a proof
    may be empty. An empty table gives an empty result. Columns of docs that are not named are ignored, whatever their names.
    """
    also = also or {}
    digest = F.unhex(leaf_digest(*[F.col(c) for c in fields]))
    row = [F.col(order).alias("key"), *[c.alias(f"also_{i}") for i, c in enumerate(also.values())]]
    leaves = docs.select(F.col(group).cast("string").alias("name"), digest.alias("digest"), F.struct(*row, digest.alias("leaf")).alias("row"))
    leaves = save(leaves, "leaves")
    counts = save(leaves.groupBy("name").agg(F.count("*").alias("n")), "counts")
    n_groups, most = counts.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    groups = save(running_sums(counts, [F.col("name").asc_nulls_first()], {"grp": F.lit(1), "start": F.col("n")}), "groups")
    hint = F.broadcast(groups) if n_groups <= MOST_GROUPS else groups
    placed = running_sums(leaves, [F.col("name").asc_nulls_first(), F.col("row.key").asc_nulls_first(), F.col("digest")], {"at": F.lit(1)})
    placed = placed.withColumnRenamed("name", "_name").join(hint, F.col("_name").eqNullSafe(F.col("name")))
    trees = _trees(placed.select("grp", "n", (F.col("at") - F.col("start")).alias("pos"), "digest", "row"), most)
    subroots = save(_tops(trees), "subroots")
    over = _trees(subroots.select(F.lit(_TOP).cast("long").alias("grp"), F.lit(n_groups).cast("long").alias("n"), F.col("grp").alias("pos"), "digest"), n_groups)
    root = _tops(over).first()

    high = _depth(n_groups)
    now = save(_pointers(trees[0].where("level = 0"), high), "ways")
    inner = save(_pointers(_united(trees).where("level > 0"), high).unionByName(_pointers(_united(over), high)), "pointers")
    drop(leaves, counts, *trees, *over)
    depth, far = max(1, _depth(most)) + high, 1
    while far < depth:
        small = inner.count() * (far * _STEP + 48) <= MOST_BYTES
        moved = save(_jump(now, inner, small), "ways")
        # leaves will point to every 2 far-th level from here on
        kept = save(_jump(inner.where((F.col("g") == _TOP) | (F.col("l") % (2 * far) == 0)), inner, small), "pointers")
        drop(now, inner)
        now, inner, far = moved, kept, 2 * far
    drop(inner)
    subroots = subroots.select(F.col("grp").alias("g"), F.col("digest").alias("subroot"))
    out = now.join(F.broadcast(subroots) if n_groups <= MOST_GROUPS else subroots, "g")
    named = [F.col(f"row.also_{i}").alias(name) for i, name in enumerate(also)]
    return out.select(F.col("row.key").alias(order), *named, "row.leaf", "subroot", F.lit(root and bytes(root["digest"])).cast("binary").alias("root"), F.col("way").alias("proof"))


def fold(proved: DataFrame, claim: Column) -> DataFrame:
    """proved, a manifest, with proof_sha256 (of the siblings from leaf to root), folded_root (what the proof makes of the claimed digest
    of the leaf, or of the leaf itself where the claim is null) and verified. A claim is binary; proofs of any length are folded."""
    kept = proved.columns
    kind = T.StructType([*proved.schema.fields, T.StructField("proof_sha256", T.StringType()), T.StructField("folded_root", T.BinaryType())])

    def run(batches):
        for batch in batches:
            shas, roots = [], []
            for node, way in zip(batch.column("_claim").to_pylist(), batch.column("proof").to_pylist()):
                told, at = hashlib.sha256(), 0
                while at < len(way):
                    side, other = way[at : at + 1], way[at + 1 : at + _STEP]
                    if side == ALONE:
                        node, at = _digest(node), at + 1
                        continue
                    told.update(other.hex().encode())
                    node, at = _digest(other, node) if side == LEFT else _digest(node, other), at + _STEP
                shas.append(told.hexdigest())
                roots.append(node)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(shas, pa.string()), pa.array(roots, pa.binary())], kind.names)

    out = proved.withColumn("_claim", F.coalesce(claim, F.col("leaf"))).mapInArrow(run, kind)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
