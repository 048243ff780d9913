"""Expected fetch partitions of sources, from a specification of each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .normalise import digits6

C = F.col
#: What a specification's mode may be.
MODES = ("day", "weekday", "month", "quarter_end", "year", "range", "snapshot", "symbol")


def expected_partitions(specs: DataFrame, symbols: DataFrame | None = None) -> DataFrame:
    """(api_name, dimension, symbol, partition, start_date, end_date): what should have landed by specs (api_name, mode, start, end, dimensions).

    day, weekday (Monday to Friday): one partition yyyymmdd for each; month: yyyymm, year: yyyy, with the days of it that lie within the range;
    quarter_end: the last days of quarters within it; range: start_end; snapshot: 'latest', on the end day; symbol: one for each of the
    distinct symbols (symbol), as six digits, over the whole range. All of it for each of the dimensions (such as exchanges), or once with a
    null one where there are none. A range that ends before it starts expects nothing; an unknown mode raises.
    """
    start, end, mode = C("start"), C("end"), C("mode")
    known = F.when(mode.isin(*MODES), mode).otherwise(F.raise_error(F.concat(F.lit("unknown mode: "), F.coalesce("mode", F.lit("null")))))
    base = specs.select("api_name", known.alias("mode"), C("start").cast("date").alias("start"), C("end").cast("date").alias("end"), F.explode_outer("dimensions").alias("dimension"))
    base = base.where("start <= end")
    days = lambda first, step: F.sequence(first, C("end"), F.expr(step))
    each = F.when(mode.isin("day", "weekday"), days(start, "interval 1 day")).when(mode == "month", days(F.trunc("start", "month"), "interval 1 month"))
    each = each.when(mode == "quarter_end", days(F.trunc("start", "quarter"), "interval 3 months")).when(mode == "year", days(F.trunc("start", "year"), "interval 1 year"))
    rows = base.withColumn("at", F.explode(each.otherwise(F.array(start))))
    at = F.when(mode == "quarter_end", F.last_day(F.add_months("at", 2))).otherwise(C("at"))
    rows = rows.withColumn("at", at).where("(mode <> 'weekday' or weekday(at) < 5) and (mode <> 'quarter_end' or at between start and end)")
    one_day, text = mode.isin("day", "weekday", "quarter_end"), lambda c, form: F.date_format(c, form)
    whole = mode.isin("range", "symbol")
    name = F.when(one_day, text("at", "yyyyMMdd")).when(mode == "month", text("at", "yyyyMM")).when(mode == "year", text("at", "yyyy"))
    name = name.when(mode == "snapshot", "latest").otherwise(F.concat(text("start", "yyyyMMdd"), F.lit("_"), text("end", "yyyyMMdd")))
    upto = F.when(mode == "month", F.last_day("at")).otherwise(F.make_date(F.year("at"), F.lit(12), F.lit(31)))
    first = F.when(one_day, C("at")).when(mode == "snapshot", end).when(whole, start).otherwise(F.greatest("at", "start"))
    last = F.when(one_day, C("at")).when(whole | (mode == "snapshot"), end).otherwise(F.least(upto, end))
    out = rows.select("api_name", "mode", "dimension", name.alias("partition"), first.alias("start_date"), last.alias("end_date"))
    columns = ("api_name", "dimension", "symbol", "partition", "start_date", "end_date")
    plain = out.where("mode <> 'symbol'").withColumn("symbol", F.lit(None).cast("string")).select(*columns)
    if symbols is None:
        return plain
    listed = symbols.where("trim(symbol) <> ''").select(digits6(C("symbol")).alias("symbol")).distinct()
    return plain.unionByName(_by_symbol(out.where("mode = 'symbol'"), listed).select(*columns))


def _by_symbol(specs: DataFrame, listed: DataFrame) -> DataFrame:
    """Every specification with every symbol. Both are few, their product is not: symbols are packed by hash, each specification meets each
    pack, and the meetings are dealt over as many tasks as a shuffle has, which take as many rows each however few bytes come in."""
    tasks = int(specs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packs = 4 * tasks
    packed = listed.groupBy(F.pmod(F.xxhash64("symbol"), F.lit(packs)).cast("int").alias("_pack")).agg(F.collect_list("symbol").alias("_symbols"))
    met = specs.withColumn("_pack", F.explode(F.sequence(F.lit(0), F.lit(packs - 1)))).repartition(tasks, "_pack")
    # not by a broadcast of either, which would leave the product to the few tasks of the other
    return met.join(packed.hint("shuffle_hash"), "_pack").withColumn("symbol", F.explode("_symbols")).drop("_pack", "_symbols")


def missing_partitions(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Expected partitions that have not landed (api_name, dimension, symbol, partition); nulls are equal to nulls."""
    keys = ("api_name", "dimension", "symbol", "partition")
    same = F.lit(True)
    for k in keys:
        same = same & expected[k].eqNullSafe(landed[k])
    return expected.join(landed.select(*keys).hint("merge"), same, "left_anti")
