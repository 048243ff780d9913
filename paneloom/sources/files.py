"""Files of a raw lake: inventories, point reads, lists and registries."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lake import partition_bucket
from ..operators.normalise import digits6, to_day

C = F.col


def _parts(path):
    """Map of the key=value folders of a path."""
    pairs = F.filter(F.split(path, "/"), lambda x: x.contains("="))
    return F.map_from_entries(F.transform(pairs, lambda x: F.struct(F.substring_index(x, "=", 1), F.substring_index(x, "=", -1))))


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """path, bytes, digest, family, api, partition of every Parquet file under root/family/api/key=value/...

    The files' bytes are hashed where they are read; no file's content is shuffled. Files above 2 GB cannot be hashed this way."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    below = F.regexp_replace(C("path"), "^.*?" + root.removeprefix("file:").strip("/").replace(".", r"\.") + "/", "")
    return files.select(below.alias("path"), C("length").alias("bytes"), F.sha2("content", 256).alias("digest")).select(
        "*", F.split("path", "/")[0].alias("family"), F.split("path", "/")[1].alias("api"), _parts(C("path")).alias("partition")
    )


def row_counts(spark: SparkSession, root: str, date_column: str | None = None) -> DataFrame:
    """path, rows and, with a date column, its first and last day, of every file of one schema under root; one pass over the data."""
    rows = spark.read.option("recursiveFileLookup", "true").parquet(root)
    day = to_day(C(date_column)) if date_column else F.lit(None).cast("date")
    return rows.groupBy(C("_metadata.file_path").alias("path")).agg(F.count("*").alias("rows"), F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def bucketed(inv: DataFrame) -> DataFrame:
    """The inventory with the bucket that each file is compacted into."""
    return inv.withColumn("bucket", partition_bucket("partition"))


def verify(inv: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files of the manifest (path, digest) whose digest differs or that are gone."""
    seen = inv.select("path", C("digest").alias("actual"))
    return manifest.join(seen, "path", "left").where(~C("digest").eqNullSafe(C("actual")))


def selected_partitions(inv: DataFrame, key: str, values: list[str], day_key: str, start: str, end: str) -> DataFrame:
    """The inventory with `selected` and a reason where a file is not; raises if nothing is selected."""
    ok = F.upper(C("partition")[key]).isin(*[v.upper() for v in values]) & C("partition")[day_key].between(start, end)
    out = inv.withColumn("selected", F.coalesce(ok, F.lit(False))).withColumn("reason", F.when(C("selected"), "").otherwise("filtered out"))
    if out.where("selected").isEmpty():
        raise ValueError("no file is selected")
    return out


def read_partition(spark: SparkSession, root: str, **keys: str) -> DataFrame:
    """Rows of one partition; only its folder is read."""
    df = spark.read.parquet(root)
    for k, v in keys.items():
        df = df.where(C(k) == v)
    return df


def read_texts(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """A CSV file whose values all stay texts, empty ones too; a missing column raises."""
    df = spark.read.csv(path, header=True, inferSchema=False, nullValue="\0", emptyValue="")
    if gone := [c for c in required if c not in df.columns]:
        raise ValueError(f"{path} misses columns {gone}")
    return df


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The entries of a JSON registry {"sources": [...]}; an api that is there twice raises."""
    rows = spark.read.json(path, multiLine=True).select(F.inline("sources"))
    if not rows.groupBy("api_name").count().where("count > 1").isEmpty():
        raise ValueError("duplicate api_name")
    return rows


def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    """(symbol): the distinct six-digit codes of a text or CSV list."""
    code = F.regexp_extract("value", "([0-9]{1,6})", 1)
    return spark.read.text(path).where(code != "").select(digits6(code).alias("symbol")).distinct()


# Date columns in the order in which they are looked for, quarter ends, and columns of membership snapshots. ----------------
DATE_COLUMNS = ("trade_date", "ann_date", "end_date", "report_date", "date")
QUARTER_ENDS = ("0331", "0630", "0930", "1231")
SNAPSHOT_COLUMNS = ("index_name", "index_code", "snapshot_date", "asset", "asset_name", "is_member", "source", "ingested_at")


def drive_inventory(spark: SparkSession, root: str, schema_root: str | None = None) -> DataFrame:
    """The bucketed inventory with rows, and the first and last day of each file: by the first of DATE_COLUMNS that the files have,
    else by what their folders say (year, window, snapshot)."""
    inv = bucketed(inventory(spark, root))
    names = spark.read.option("recursiveFileLookup", "true").parquet(schema_root or root).columns
    found = row_counts(spark, schema_root or root, next((c for c in DATE_COLUMNS if c in names), None))
    below = F.regexp_replace(C("path"), "^.*?" + root.removeprefix("file:").strip("/").replace(".", r"\.") + "/", "")
    p = C("partition")
    year = F.coalesce(p["year"], F.substring(p["snapshot"], 1, 4))
    first = F.coalesce("min_date", to_day(F.coalesce(p["start_date"], p["trade_date"])), F.make_date(year.try_cast("int"), F.lit(1), F.lit(1)))
    last = F.coalesce("max_date", to_day(F.coalesce(p["end_date"], p["trade_date"])), F.make_date(year.try_cast("int"), F.lit(12), F.lit(31)))
    return inv.join(found.withColumn("path", below), "path", "left").withColumn("min_date", first).withColumn("max_date", last)


def read_partition_metadata(spark: SparkSession, root: str, **keys: str) -> DataFrame:
    """The JSON sidecars of one partition's folder."""
    folder = "/".join(f"{k}={v}" for k, v in keys.items())
    return spark.read.json(f"{root}/{folder}/metadata.json", multiLine=True)


def read_snapshots(spark: SparkSession, root: str, index_name: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Membership snapshots of one index, with all of SNAPSHOT_COLUMNS; only its folder is read, and a missing one raises."""
    rows = spark.read.parquet(f"{root}/index_name={index_name}").withColumn("index_name", F.lit(index_name))
    day = C("snapshot_date").cast("date")
    rows = rows if start is None else rows.where(day >= F.lit(start).cast("date"))
    rows = rows if end is None else rows.where(day <= F.lit(end).cast("date"))
    return rows.select(*[C(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in SNAPSHOT_COLUMNS])


def read_outputs(spark: SparkSession, path: str, required: tuple[str, ...], optional: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The named result tables of a run, one CSV folder each; a required one that is missing raises, an optional one is left out."""
    out = {name: spark.read.csv(f"{path}/{name}", header=True, inferSchema=True) for name in required}
    for name in optional:
        try:
            out[name] = spark.read.csv(f"{path}/{name}", header=True, inferSchema=True)
        except AnalysisException:
            continue
    return out


def read_list(spark: SparkSession, path: str, column: str, override: list[str] | None = None) -> DataFrame:
    """(place, value) of a CSV list in the order of the file, blanks left out; an override wins. An empty list raises."""
    if wanted := [v.strip() for v in override or () if v and v.strip()]:
        return spark.createDataFrame(list(enumerate(wanted)), "place long, value string")
    rows = read_texts(spark, path, (column,)).select(F.monotonically_increasing_id().alias("place"), F.trim(column).alias("value")).where("value <> ''")
    if rows.isEmpty():
        raise ValueError(f"{path} has no values of {column}")
    return rows


def read_days(spark: SparkSession, path: str, start: str, end: str, override: list[str] | None = None) -> DataFrame:
    """(place, value): trading days (yyyymmdd) of a calendar file within a range."""
    days = read_list(spark, path, "trade_date", override)
    return days if override else days.where(C("value").between(start, end))


def report_days(start: str, end: str) -> list[str]:
    """Quarter ends (yyyymmdd) within a range."""
    return [day for year in range(int(start[:4]), int(end[:4]) + 1) for q in QUARTER_ENDS if start <= (day := f"{year}{q}") <= end]


def read_ordered_symbols(spark: SparkSession, path: str) -> DataFrame:
    """(place, symbol): the distinct six-digit codes of a text or CSV list, each at its first place."""
    code = F.regexp_extract("value", "([0-9]{1,6})", 1)
    rows = spark.read.text(path).select(F.monotonically_increasing_id().alias("place"), code.alias("code")).where("code <> ''")
    return rows.groupBy(digits6(C("code")).alias("symbol")).agg(F.min("place").alias("place")).select("place", "symbol")
