"""Inventory of Parquet files from their footers, each read by the task that has its path. Data pages are read of a day column alone, where
it holds texts or the footer has no statistics of it."""

from __future__ import annotations

import fnmatch
import hashlib
from datetime import date, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lake import partition_bucket

C = F.col
#: Bytes that are hashed at once, and rows of a day column that are read at once where the footer does not tell.
PIECE, ROWS = 1 << 20, 1 << 16

# Date columns in the order in which they are looked for. -------------------------------------------------------------------
DATE_COLUMNS = ("trade_date", "ann_date", "end_date", "report_date", "date")

_SCHEMA = (
    "uri string, rows long, columns array<string>, types array<string>, column_count int, fingerprint string, date_column string, "
    "first_day string, last_day string, digest string, status string, error_message string, bytes long"
)


def _day(value) -> str:
    """yyyymmdd of a date, a timestamp, a number or a text; '' if it has fewer than eight digits."""
    if isinstance(value, (date, datetime)):
        return value.strftime("%Y%m%d")
    digits = "".join(c for c in str("" if value is None else value) if c in "0123456789")
    return digits[:8] if len(digits) >= 8 else ""


def _days(file, name: str) -> tuple[str, str]:
    """First and last day of a column: from the row groups' statistics, else from the column."""
    meta = file.metadata
    at = file.schema_arrow.get_field_index(name)
    text = pa.types.is_string(file.schema_arrow.field(at).type) or pa.types.is_large_string(file.schema_arrow.field(at).type)
    at = next((i for i in range(meta.num_columns) if meta.row_group(0).column(i).path_in_schema == name), None) if meta.num_row_groups else None
    found = []
    for g in range(meta.num_row_groups) if at is not None else ():
        stats = meta.row_group(g).column(at).statistics
        if stats is None or not stats.has_min_max or text:
            # long texts have cut statistics, and texts of several forms no order of days
            if stats is not None and stats.has_null_count and stats.null_count == meta.row_group(g).num_rows:
                continue
            for batch in file.iter_batches(ROWS, [g], [name]):
                found += [d for d in map(_day, batch.column(0).unique().to_pylist()) if d]
        else:
            found += [d for d in (_day(stats.min), _day(stats.max)) if d]
        found = [min(found), max(found)] if found else []
    return (found[0], found[-1]) if found else ("", "")


def file_system(location: str):
    """(file system, path) of a location such as /a, file:/a or hdfs://host/a."""
    from pyarrow import fs

    if ":" in location.split("/")[0] and not location.startswith("file:"):
        return fs.FileSystem.from_uri(location)
    return fs.LocalFileSystem(), "/" + location.removeprefix("file:").lstrip("/")


def _prefix(location: str) -> str:
    """What stands before the path in a location."""
    path = file_system(location)[1]
    return "file:" if location.startswith(("/", "file:")) else location[: location.rfind(path.rstrip("/"))]


def _listed(glob: str):
    """Folders become their files with sizes, hidden ones left out."""

    def run(batches):
        from pyarrow import fs

        for batch in batches:
            for folder in batch.column(0).to_pylist():
                system, path = file_system(folder)
                found = [] if system.get_file_info(path).type == fs.FileType.NotFound else system.get_file_info(fs.FileSelector(path, recursive=True))
                own = [f for f in found if f.is_file and fnmatch.fnmatch(f.base_name, glob)]
                own = [f for f in own if not any(part[:1] in "._" and "=" not in part for part in f.path[len(path) :].strip("/").split("/"))]
                columns = [pa.array([_prefix(folder) + f.path for f in own], pa.string()), pa.array([f.size for f in own], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["uri", "bytes"])

    return run


def _folders(root: str, depth: int) -> list[str]:
    """Folders so many levels below the root; files above that level are not of the lake."""
    from pyarrow import fs

    system, path = file_system(root)
    here = [path]
    for _ in range(depth):
        here = [f.path for p in here for f in system.get_file_info(fs.FileSelector(p, allow_not_found=True)) if f.type == fs.FileType.Directory]
    return [_prefix(root) + p for p in here]


def _read(uri: str, digests: bool) -> tuple:
    import pyarrow.parquet as pq

    system, path = file_system(uri)
    told = ""
    if digests:
        sha = hashlib.sha256()
        with system.open_input_stream(path) as stream:
            while piece := stream.read(PIECE):
                sha.update(piece)
        told = sha.hexdigest()
    with system.open_input_file(path) as source:
        file = pq.ParquetFile(source)
        names = file.schema_arrow.names
        types = [str(t) for t in file.schema_arrow.types]
        print_ = hashlib.sha256("\n".join(f"{n}\t{t}" for n, t in zip(names, types)).encode()).hexdigest()
        column, first, last = "", "", ""
        for name in DATE_COLUMNS:
            if name in names:
                first, last = _days(file, name)
                if first:
                    column = name
                    break
        return uri, file.metadata.num_rows, names, types, len(names), print_, column, first, last, told, "ok", ""


def _footers(digests: bool):
    def run(batches):
        for batch in batches:
            out = []
            for uri, size in zip(*(batch.column(c).to_pylist() for c in ("uri", "bytes"))):
                try:
                    out.append((*_read(uri, digests), size))
                except Exception as e:  # a row about the file, whatever is wrong with it
                    out.append((uri, None, [], [], None, None, "", "", "", "", "unreadable", f"{type(e).__name__}: {e}"[:500], size))
            kinds = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.int32(), *[pa.string()] * 7, pa.int64()]
            names = [c.split()[0] for c in _SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 13, kinds)], names)

    return run


def _day8(text):
    return F.when(F.length(F.regexp_replace(text, "[^0-9]", "")) >= 8, F.substring(F.regexp_replace(text, "[^0-9]", ""), 1, 8))


def _as_date(text):
    return F.to_date(F.try_to_timestamp(text, F.lit("yyyyMMdd")))


def footer_inventory(
    spark: SparkSession, root: str, levels: tuple[str, ...] = ("family", "api"), digests: bool = True, strict: bool = False,
    start: str = "", end: str = "", glob: str = "*.parquet", bucket: Column | None = None,
) -> DataFrame:
    """One row for each Parquet file below root/level/.../key=value/...: path (below root), location, bytes, the levels, partition (map), bucket_kind and
    bucket_value, rows, columns, types, column_count, fingerprint of names and types, date_column, min_date, max_date, snapshot_date,
    digest (SHA-256 of the file, '' unless asked for), status and error_message.

    Files may differ in columns and types, and each has its own date column: the first of DATE_COLUMNS with a day in it. Where there is
    none, the days are those of a window, snapshot or year of the folders (date_column partition.window and so on), else null. An
    unreadable or empty file is a row with status 'unreadable', or raises where strict. Files of any size are hashed in pieces. Folders are
    listed in tasks, one for each folder of the last level. The bucket is that of `lake.partition_bucket` for raw files;
    `lake.landed_bucket` is that of a compacted store.
    """
    folders = spark.createDataFrame([(f,) for f in _folders(root, len(levels))], "folder string")
    files = folders.repartition(spark.sparkContext.defaultParallelism).mapInArrow(_listed(glob), "uri string, bytes long")
    files = files.repartition(spark.sparkContext.defaultParallelism * 4, "uri")
    inv = files.mapInArrow(_footers(digests), _SCHEMA)
    if strict:
        fails = F.raise_error(F.concat(F.lit("unreadable file: "), "uri", F.lit(" "), "error_message"))
        inv = inv.withColumn("status", F.when(C("status") == "ok", "ok").otherwise(fails))
    below = F.regexp_replace(C("uri"), "^.*?" + root.split(":", 1)[-1].strip("/").replace(".", r"\.") + "/", "")
    parts = F.filter(F.split("path", "/"), lambda x: x.contains("="))
    value = lambda x: F.substring(x, F.instr(x, "=") + 1, F.length(x))
    plain = lambda x: F.coalesce(F.try_url_decode(F.replace(value(x), F.lit("+"), F.lit("%2B"))), value(x))
    parts = F.map_from_entries(F.transform(parts, lambda x: F.struct(F.substring_index(x, "=", 1), plain(x))))
    inv = inv.withColumn("path", below).withColumn("partition", parts).withColumn("bucket", partition_bucket("partition", start, end) if bucket is None else bucket)
    p = C("partition")
    window = F.split(F.regexp_replace(F.coalesce(p["window"], F.concat_ws("_", p["start_date"], p["end_date"])), "-", ""), "_")
    window = F.filter(F.transform(window, _day8), lambda x: x.isNotNull())
    in_window, snapshot = F.size(window) >= 2, _day8(p["snapshot"])
    year = F.substring(F.regexp_replace(p["year"], "[^0-9]", ""), 1, 4)
    own = C("date_column") != ""
    kind = F.when(own, C("date_column")).when(in_window, "partition.window").when(snapshot.isNotNull(), "partition.snapshot").when(F.length(year) == 4, "partition.year")
    pick = lambda mine, i, edge: F.when(own, C(mine)).when(in_window, F.element_at(window, i)).when(snapshot.isNotNull(), snapshot).when(F.length(year) == 4, F.concat(year, F.lit(edge)))
    return inv.select(
        "path", C("uri").alias("location"), "bytes", *[F.get(F.split("path", "/"), i).alias(level) for i, level in enumerate(levels)], "partition",
        F.substring_index("bucket", "=", 1).alias("bucket_kind"), F.expr("substring(bucket, instr(bucket, '=') + 1)").alias("bucket_value"),
        "rows", "columns", "types", "column_count", "fingerprint", F.coalesce(kind, F.lit("")).alias("date_column"),
        _as_date(pick("first_day", 1, "0101")).alias("min_date"), _as_date(pick("last_day", -1, "1231")).alias("max_date"),
        _as_date(snapshot).alias("snapshot_date"), "digest", "status", "error_message",
    )


def of_version(inv: DataFrame, version: str, level: str = "version") -> tuple[DataFrame, int]:
    """The files of one dataset version, and how many others there are."""
    return inv.where(C(level) == version), inv.where(~C(level).eqNullSafe(F.lit(version))).count()


def inventory_summary(inv: DataFrame, keys: tuple[str, ...] = ("api",)) -> DataFrame:
    """For each of the keys: files, ok and unreadable ones, rows, bytes, first and last day."""
    ok = C("status") == "ok"
    return inv.groupBy(*keys).agg(
        F.count("*").alias("files"), F.count_if(ok).alias("ok_files"), F.count_if(~ok).alias("unreadable_files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.sum("bytes").alias("bytes"), F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"),
    )


# Which type a column gets where files differ: the wider of two numbers, else a text. ------------------------------------------------------
_NUMBERS = ("int8", "int16", "int32", "int64", "float", "double")
_SPARK = {"int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "float": "float", "double": "double", "bool": "boolean", "string": "string", "large_string": "string", "date32[day]": "date", "null": "string"}


def common_types(inv: DataFrame) -> DataFrame:
    """(column, type): the least type that holds a column's values in all files: equal types stay, numbers widen (a whole number beside a
    fraction is a double), a column without values takes the others' type, and all else is a text."""
    pairs = inv.where("status = 'ok'").select(F.explode(F.arrays_zip("columns", "types")).alias("x")).select(C("x.columns").alias("column"), C("x.types").alias("kind"))
    kinds = pairs.where("kind <> 'null'").groupBy("column").agg(F.collect_set("kind").alias("kinds"))
    kinds = pairs.select("column").distinct().join(kinds, "column", "left").withColumn("kinds", F.coalesce("kinds", F.array()))
    places = F.transform("kinds", lambda k: F.array_position(F.array(*[F.lit(n) for n in _NUMBERS]), k))
    numbers = F.forall(places, lambda i: i > 0) & (F.size("kinds") > 0)
    mixed = F.exists(places, lambda i: i <= 4) & F.exists(places, lambda i: i == 5)
    widest = F.element_at(F.array(*[F.lit(_SPARK[n]) for n in _NUMBERS]), F.array_max(places).cast("int"))
    one = F.create_map(*[F.lit(x) for pair in _SPARK.items() for x in pair])[F.get("kinds", 0)]
    stamps = F.forall("kinds", lambda k: k.startswith("timestamp"))
    wide = F.when(numbers & mixed, "double").when(numbers, widest)
    return kinds.select("column", F.coalesce(wide, F.when(F.size("kinds") == 1, one), F.when((F.size("kinds") > 0) & stamps, "timestamp"), F.lit("string")).alias("type"))


def read_mixed(spark: SparkSession, inv: DataFrame) -> DataFrame:
    """The rows of all readable files of an inventory as one table, whose columns have their common types. One read for each different
    schema, with that schema; columns that a file lacks are null."""
    kinds = {r["column"]: r["type"] for r in common_types(inv).collect()}  # a row for each column
    groups = inv.where("status = 'ok'").groupBy("fingerprint").agg(F.collect_list("location").alias("paths"))
    out = None
    for r in groups.toLocalIterator():  # paths, which the driver plans a read by in any case
        part = spark.read.parquet(*r["paths"])
        part = part.select(*[(C(f"`{c}`") if c in part.columns else F.lit(None)).cast(t).alias(c) for c, t in sorted(kinds.items())])
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no readable file")
    return out
