"""Mixing sources to target weights, with DataFrame functions only.

Every row gets a hash-random key. Within each source rows are sorted by it, range by range: the sums of the ranges give each
range its offset, a window inside the range the rest, so that the prefix sums of word counts need no task that holds a source.
Each source is cut at its exact budget; where the budget exceeds the source, whole passes come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .prefix_sums import running_sums
from .store import save

WEIGHTS = (3, 1, 2)
#: Rows of a range of keys, on average over all rows.
RANGE_ROWS = 10_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def random_key(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("none"))


def targets(sizes: DataFrame, share: float, most: int, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(skey, source_size, target) of (skey, source, source_size).

    Weights repeat over the sources by code point, null last. A source gets at most `most` times its size; what it cannot take
    goes to the others by weight. Sorted by that limit for one unit of weight, the saturated sources are a prefix, whose end
    is found from running sums.
    """
    ranked = running_sums(sizes, [F.col("source").asc_nulls_last()], {"place": F.lit(1)})
    unit = 1
    for w in weights:
        unit *= w
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("w", weight.cast("long")).withColumn("cap", F.col("source_size") * most)
    ranked = running_sums(ranked.withColumn("per", F.expr(f"cap * {unit} div w")), [F.col("per"), F.col("place")], {"cap_before": F.col("cap"), "w_before": F.col("w")})
    ranked = save(ranked, "sources")
    total, w_all = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(1))).first()
    goal = share * total
    level = (F.lit(goal) - F.col("cap_before")) / (F.lit(w_all) - F.col("w_before")).cast("double")
    fits = ranked.withColumn("level", level).where(F.col("level") * F.col("w") <= F.col("cap"))
    first = fits.agg(F.min_by("level", F.struct("per", "place"))).first()[0]
    target = F.least(F.col("cap").cast("double"), F.lit(float(first if first is not None else most * total)) * F.col("w"))
    return ranked.select("skey", "source_size", target.alias("target"))


def mix(docs: DataFrame, share: float = 1.5, most: int = 2, weights: tuple[int, ...] = WEIGHTS, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of docs: doc_id, source, size (words), source_size, target (its source's), taken, key, skey, passes, rest.

    taken counts the words that the mix takes, repeats included: `passes` times the whole row, and of the source's `rest` words
    what comes next by key. The sum over a source is its target, rounded. A null text has no words; a null source is a source,
    the last one; null ids share a key. Repeated rows are rows of their own. A source without words gets nothing. Equal keys
    are ordered by id and size, beyond which rows have the same result or may swap it. Other columns are ignored.
    """
    slim = save(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size"), random_key(F.col(id_col), seed).alias("key"), _source_key(F.col(source_col)).alias("skey")), "slim")
    n_ranges = 1 + slim.count() // RANGE_ROWS
    goals = targets(slim.groupBy("skey", "source").agg(F.sum("size").alias("source_size")), share, most, weights)
    budget = F.floor(F.col("target") + 0.5)
    passes = F.expr(f"case when source_size > 0 then cast(floor(target + 0.5) as bigint) div source_size else 0 end")
    goals = save(goals.withColumn("passes", passes).withColumn("rest", budget - F.col("passes") * F.col("source_size")), "goals")

    slim = slim.withColumn("range", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * n_ranges / F.lit(2.0**32)))
    before = Window.partitionBy("skey").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slim.groupBy("skey", "range").agg(F.sum("size").alias("words")).withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
    inside = Window.partitionBy("skey", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = slim.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(offsets.join(goals, "skey"), ["skey", "range"])
    taken = F.col("passes") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("offset") - F.col("inside")))
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "key", "skey", "passes", "rest")


def mixed_documents(docs: DataFrame, share: float = 1.5, most: int = 2, weights: tuple[int, ...] = WEIGHTS, seed: int = 0) -> DataFrame:
    """The rows that the mix takes, each as often as it is taken, with all columns of docs.

    Each source's cut is told by the last key it takes; the row at the cut is kept whole. Rows without words, nulls among them, are
    not taken. Repeated rows are taken alike. Other columns stay, whatever their names; an empty table stays empty.
    """
    plan = mix(docs, share, most, weights, seed)
    cut = plan.groupBy("skey").agg(F.first("passes").alias("passes"), F.max(F.when(F.col("taken") > F.col("passes") * F.col("size"), F.struct("key", "doc_id", "size"))).alias("cut"))
    cut = save(cut, "cuts")
    # the columns of docs travel as one, so that their names clash with nothing
    own = F.struct(random_key(F.col("doc_id"), seed).alias("key"), F.col("doc_id"), n_words(F.col("text")).alias("size"))
    marked = docs.select(F.struct("*").alias("row"), _source_key(F.col("source")).alias("skey"), own.alias("own")).join(F.broadcast(cut), "skey")
    copies = F.when(F.col("own.size") == 0, 0).otherwise(F.col("passes") + F.when(F.col("own") <= F.col("cut"), 1).otherwise(0)).cast("int")
    return marked.select("row", F.explode(F.array_repeat(F.lit(0), copies))).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
