"""URL filter: host and path rules first, then the ratio of two character language models.

Urls that a rule allows or blocks train one smoothed variable-order Markov model each: counts of every character after its
contexts of 0 to ORDER characters, interpolated from short to long contexts by the share of new continuations
(Witten and Bell's estimate). Contexts are kept by all their bytes, and counts are tables that grow with the urls. A url is scored by the difference of log-likelihoods for each character; on urls that were held
out, the score is calibrated as the logarithm of the odds that the url is one to accept.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import save

#: (verdict, host and path), as the contract of the query gives them.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
ORDER = 5
#: A gram is a number of ORDER + 1 characters of BITS bits: the 256 bytes, the end of a url, and what stands before its start.
BITS, END, START = 9, 256, 257
#: Characters that may come next.
CHARS = 257
USES = ("n0", "n1", "m0", "m1")
#: Values of grams are broadcast up to this count (16 MB), and joined by a shuffle beyond it.
MOST_GRAMS = 1 << 20
#: Scores are calibrated on a histogram of this many bins of width BIN around 0, at the ends open.
BINS, BIN = 801, 0.01
HELD_OUT = 5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    parts = lambda i: F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*+)([^?#]*+)", i), F.lit(""))
    return F.translate(parts(1), _UPPER, _LOWER), parts(2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        h, _, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return rule, verdict


def _grams(urls: list) -> tuple[np.ndarray, np.ndarray]:
    """For each character (byte, or the end) of all urls, the gram of its ORDER characters before and itself; url of each."""
    raw = [u.encode() for u in urls]
    sizes = np.array([len(r) + 1 for r in raw])
    own, ends = np.repeat(np.arange(len(raw)), sizes), np.cumsum(sizes)
    chars = np.full(int(ends[-1]), END, np.int64)
    inner = np.ones(len(chars), bool)
    inner[ends - 1] = False
    chars[inner] = np.frombuffer(b"".join(raw), np.uint8)
    at = np.arange(len(chars)) - np.repeat(ends - sizes, sizes)
    grams = chars.copy()
    for k in range(1, ORDER + 1):
        back = np.full(len(chars), START, np.int64)
        back[k:] = chars[:-k]
        grams |= np.where(at >= k, back, START) << (BITS * k)
    return grams, own


def _counts(batches):
    """Rows (g, n0, n1, m0, m1): uses of each gram in urls of side 0 and 1, in all that train and in those not held; zeros in others."""
    for batch in batches:
        if not batch.num_rows:
            continue
        grams, own = _grams(batch.column("url").fill_null("").to_pylist())
        side, held = batch.column("side").fill_null(2).to_numpy(zero_copy_only=False)[own], batch.column("held").to_numpy(zero_copy_only=False)[own]
        keys, at = np.unique(grams, return_inverse=True)
        uses = [np.bincount(at[use], minlength=len(keys)) for use in (side == 0, side == 1, (side == 0) & ~held, (side == 1) & ~held)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (keys, *uses)], ["g", *USES])


def _placed(batches):
    for batch in batches:
        if batch.num_rows:
            grams, own = _grams(batch.column("url").fill_null("").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("h").take(pa.array(own)), batch.column("held").take(pa.array(own)), pa.array(grams)], ["h", "held", "g"])


def gram_values(counts: DataFrame) -> DataFrame:
    """(g, all, taught) of each gram of counts: difference of the log-likelihoods of its last character on both sides.

    A context is looked up by all its characters. Level k has the grams of k characters and the one after them; its counts are sums of
    the level above, a context has no more rows than there are characters, and its probabilities lean on those of the level below.
    """
    levels = [counts]
    for k in range(ORDER, 0, -1):
        shorter = levels[0].groupBy(F.col("g").bitwiseAND((1 << BITS * k) - 1).alias("g")).agg(*[F.sum(c).alias(c) for c in USES])
        levels.insert(0, save(shorter, "level"))
    known = None
    for k, level in enumerate(levels):
        each = Window.partitionBy(F.shiftright("g", BITS))
        parts = level.select("g", *USES, *[F.sum(c).over(each).alias("t" + c) for c in USES], *[F.sum((F.col(c) > 0).cast("long")).over(each).alias("k" + c) for c in USES])
        if known is None:
            parts = parts.select("*", *[F.lit(1 / CHARS).alias("p" + c) for c in USES])
        else:
            parts = parts.withColumn("short", F.col("g").bitwiseAND(known[1])).join(known[0], "short")
        now = [F.when(F.col("t" + c) > 0, (F.col(c) + F.col("k" + c) * F.col("p" + c)) / (F.col("t" + c) + F.col("k" + c))).otherwise(F.col("p" + c)).alias("p" + c) for c in USES]
        out = save(parts.select("g", *now), "chances")
        known = (out.withColumnRenamed("g", "short"), (1 << BITS * (k + 1)) - 1)
    return out.select("g", (F.log("pn0") - F.log("pn1")).alias("all"), (F.log("pm0") - F.log("pm1")).alias("taught"))


def calibrate(bins: dict[tuple[int, int], int]) -> tuple[float, float]:
    """(slope, offset) of the log odds of side 0 by score, by Newton's method on the histogram, both sides weighing the same."""
    total = [max(1, sum(n for (s, _), n in bins.items() if s == side)) for side in (0, 1)]
    data = [((b - BINS // 2) * BIN, 1.0 - s, n / total[s]) for (s, b), n in sorted(bins.items())]
    a, c = 1.0, 0.0
    for _ in range(50):
        g = [1e-3 * (1.0 - a), 0.0]
        h = [1e-3, 0.0, 1e-6]
        for x, y, w in data:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, a * x + c))))
            g[0] += w * (y - p) * x
            g[1] += w * (y - p)
            v = w * p * (1 - p)
            h[0] += v * x * x
            h[1] += v * x
            h[2] += v
        det = h[0] * h[2] - h[1] * h[1]
        a, c = a + (h[2] * g[0] - h[1] * g[1]) / det, c + (h[0] * g[1] - h[1] * g[0]) / det
        a, c = max(0.0, min(1e3, a)), max(-1e3, min(1e3, c))
    return a, c


def filter_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of pages: page_id, host, path, rule, verdict, score (null where a rule decides), accept_odds.

    accept_odds is the calibrated logarithm of odds; a url without a rule is allowed from 0 on. A null url, or one without "://",
    has an empty host and path and is judged by its characters (a null url as an empty text). If no url is allowed or none is
    blocked by rules there is nothing to compare: score and odds are 0 and the rest is allowed. The score is
    calibrated on one in five of the distinct hashes of urls with a rule, by models of the others; then all urls with a rule train.
    Repeated rows get equal results and count as often as they stand; ids of any type, null ones too, are kept. A very long url is
    judged whole. Other columns are ignored, whatever their names; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col(url_col))
    known = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    known = known.withColumn("rule", rule).withColumn("by_rule", verdict).withColumn("h", F.xxhash64("url"))
    side = F.when(F.col("by_rule") == "allow", 0).when(F.col("by_rule") == "block", 1)
    used = known.select("h", "url", side.alias("side"), (F.col("by_rule").isNotNull() & (F.pmod("h", F.lit(HELD_OUT)) == 0)).alias("held"))
    counts = used.select("url", "side", "held").mapInArrow(_counts, "g long, n0 long, n1 long, m0 long, m1 long")
    counts = save(counts.groupBy("g").agg(*[F.sum(c).alias(c) for c in USES]), "grams")
    total = counts.agg(F.count("*").alias("grams"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in USES]).first()
    values = gram_values(counts)
    if total.grams <= MOST_GRAMS:
        values = F.broadcast(values)
    value = F.when(F.col("held"), F.col("taught") if total.m0 and total.m1 else F.lit(0.0)).otherwise(F.col("all") if total.n0 and total.n1 else F.lit(0.0))
    each = used.where("held or side is null").select("h", "url", "held").dropDuplicates(["h"]).mapInArrow(_placed, "h long, held boolean, g long")
    # rounded, as the order of a sum is not fixed
    scores = save(each.join(values, "g").groupBy("h", "held").agg(F.round(F.avg(value), 12).alias("score")), "scores")
    bin_of = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.round(F.col("score") / BIN).cast("int") + BINS // 2))
    held = used.where("held").select("h", "side").join(scores.where("held").select("h", "score"), "h")
    bins = {(r.side, r.bin): r.n for r in held.groupBy("side", bin_of.alias("bin")).agg(F.count("*").alias("n")).collect()}
    slope, offset = calibrate(bins) if len({s for s, _ in bins}) == 2 else (1.0, 0.0)
    free = known.where("by_rule is null").join(scores.where("not held").select("h", "score"), "h")
    odds = F.round(F.col("score") * slope + offset, 9)
    free = free.select("page_id", "host", "path", "rule", F.when(odds >= 0, "allow").otherwise("block").alias("verdict"), "score", odds.alias("accept_odds"))
    none = F.lit(None).cast("double")
    return known.where("by_rule is not null").select("page_id", "host", "path", "rule", F.col("by_rule").alias("verdict"), none.alias("score"), none.alias("accept_odds")).unionByName(free)
