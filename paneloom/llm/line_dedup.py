"""Removal of lines that spread over many sites.

Lines that stand in as many rows as the wanted number of sites are sketched: a HyperLogLog sketch of the sites of each line,
merged by aggregation. Where the estimate is too near the threshold for the sketch's error, distinct sites are counted exactly.
Texts are cleaned where they are read: the hashes of the lines that go are broadcast, and only if they are too many for that do
texts meet them by a join.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import drop, quoted, save

LG_K = 12
ERROR = 3 * 1.04 / 2 ** (LG_K / 2)
#: Lines that go, of 16 bytes each, are broadcast up to this count (32 MB).
MOST_LINES = 1 << 21


def _hashes(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), lambda x: F.xxhash64(F.trim(x)))


def _lines(keyed: DataFrame, min_chars: int) -> DataFrame:
    """(id, own_id, own_row, site, pos, h) of every line of at least min_chars characters without outer spaces."""
    each = keyed.select("id", "own_id", "own_row", "site", F.posexplode(F.split("text", "\n")).alias("pos", "line")).withColumn("line", F.trim("line"))
    return each.where(F.length("line") >= min_chars).select("id", "own_id", "own_row", "site", "pos", F.xxhash64("line").alias("h"))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= MOST_LINES else df


def _kept(lines: Column, gone: Column) -> Column:
    return F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(gone, i)), "\n")


def _looked_up(spread: DataFrame):
    """A function of a row's line hashes and its two names: the places of the lines that go (null: none)."""
    told = spread.orderBy("h").toArrow()
    known = spread.sparkSession.sparkContext.broadcast([told.column(c).to_numpy() for c in ("h", "owner")])

    @F.pandas_udf("array<int>")
    def places(hashes: pd.Series, own_id: pd.Series, own_row: pd.Series) -> pd.Series:
        names, owners = known.value
        out = np.empty(len(hashes), object)
        if not len(names) or not len(hashes):
            return pd.Series(out)
        sizes = np.array([0 if x is None else len(x) for x in hashes])
        flat = np.concatenate([np.zeros(0, np.int64), *(x for x in hashes if x is not None)])
        row = np.repeat(np.arange(len(sizes)), sizes)
        at = np.minimum(np.searchsorted(names, flat), len(names) - 1)
        goes = np.flatnonzero((names[at] == flat) & (owners[at] != own_id.to_numpy()[row]) & (owners[at] != own_row.to_numpy()[row]))
        rows, first = np.unique(row[goes], return_index=True)
        places = goes - (np.cumsum(sizes) - sizes)[row[goes]]
        for r, found in zip(rows, np.split(places.astype(np.int32), first[1:])):
            out[r] = found
        return pd.Series(out)

    return places


def dedup_lines(docs: DataFrame, min_sites: int = 5, min_chars: int = 20, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """docs with text_col cleaned, and n_lines and n_removed added (in place of columns of these names).

    A line (without outer spaces, at least min_chars characters) that stands in rows of min_sites distinct sites or more is
    boilerplate. It stays in the rows of the smallest id that has it and goes from all others, at each place where it stands.
    Where only rows without an id have it, it stays in the row of the smallest hash of the text. Null sites are one site. A null
    text stays null and has no lines; a text may become empty. Repeated rows are treated alike. A very long text is cleaned in one
    pass over its lines. Other columns stay, whatever their names. No row is dropped; an empty table stays empty.
    """
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    text, doc_id = F.col(text_col).cast("string"), F.col(id_col)
    own_row = F.xxhash64(doc_id, text, F.lit("row"))
    own_id = F.when(doc_id.isNotNull(), F.xxhash64(doc_id, F.lit("id"))).otherwise(own_row)
    keyed = docs.select(F.struct(*[F.col(quoted(c)) for c in own]).alias("row"), doc_id.alias("id"), own_id.alias("own_id"), own_row.alias("own_row"), F.xxhash64(F.col(site_col)).alias("site"), text.alias("text"))
    lines = _lines(keyed, min_chars)
    often = lines.groupBy("h").agg(F.count("*").alias("n"), F.min_by("own_id", F.struct(F.col("id").isNull(), "id", "own_row")).alias("owner")).where(F.col("n") >= min_sites)
    often = save(often.select("h", "owner"), "often")
    held = save(lines.join(_small(often.select("h")), "h").select("h", "site"), "held")
    sketched = held.groupBy("h").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch")).select("h", F.hll_sketch_estimate("sketch").alias("sites"))
    sketched = save(sketched, "sketched")
    sure = sketched.where(F.col("sites") * (1 - ERROR) > min_sites).select("h")
    near = sketched.where((F.col("sites") * (1 - ERROR) <= min_sites) & (F.col("sites") * (1 + ERROR) >= min_sites)).select("h")
    exact = held.join(_small(near), "h", "left_semi").groupBy("h").agg(F.countDistinct("site").alias("sites")).where(F.col("sites") >= min_sites).select("h")
    spread = save(often.join(sure.union(exact), "h", "left_semi"), "spread")
    drop(often, held, sketched)

    if spread.count() <= MOST_LINES:
        marked = keyed.withColumn("gone", _looked_up(spread)(_hashes(F.col("text")), "own_id", "own_row"))
    else:
        gone = lines.join(spread, "h").where("owner <> own_id and owner <> own_row").groupBy("own_row").agg(F.collect_set("pos").alias("gone"))
        marked = keyed.join(gone, "own_row", "left")
    marked = marked.withColumn("lines", F.split("text", "\n"))
    cleaned = F.when(F.col("gone").isNull(), F.col("text")).otherwise(_kept(F.col("lines"), F.col("gone")))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("long")
    n_gone = F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long")
    return marked.select(*[(cleaned if c == text_col else F.col("row").getField(c)).alias(c) for c in own], n_lines.alias("n_lines"), n_gone.alias("n_removed"))
