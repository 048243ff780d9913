"""Tables written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where that is unset, a temporary one of this session, in local mode only: on a cluster
    executors would write what nobody else can read."""
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir") or spark.conf.get("paneloom.shared.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("paneloom.shared.dir", path)
    return path.rstrip("/")


def save(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: lineage ends here, and a lost executor costs nothing. batch: most
    rows that go to a Python function at once in this write, where rows are large."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(BATCH)
    if batch:
        spark.conf.set(BATCH, str(batch))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(BATCH, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def drop(*tables: DataFrame) -> None:
    """Deletes saved tables that nothing will read again."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._saved_at)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def quoted(name: str) -> str:
    """A column's name, so that dots in it are no paths."""
    return "`" + name.replace("`", "``") + "`"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def share(spark: SparkSession, model):
    """A function that gives the model on executors: its data is broadcast, its class travels with the job."""
    kind, data = type(model), spark.sparkContext.broadcast(vars(model))

    def get():
        out = kind.__new__(kind)
        out.__dict__.update(data.value)
        return out

    return get
