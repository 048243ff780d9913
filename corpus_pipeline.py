"""A training corpus from documents, stage by stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneloom.llm import line_dedup, mixing, ngram_join, pieces, quality, registry
from paneloom.llm.store import documents, drop, quoted, save


#: What goes to a Python function at once: rows, and bytes of them. Executors hold a few such batches for each task, whatever the texts' lengths.
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20
#: Characters that are segmented together in the pieces stage.
RUN_CHARS = 1_500_000


def _bounded(spark: SparkSession) -> None:
    """Small batches from here on in this session, in the stages' writes too, which happen after a stage has returned."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def _fields(docs: DataFrame, row: str) -> list[Column]:
    """The columns of docs out of the column that holds them all, where their names clash with nothing."""
    return [F.col(row).getField(c).alias(c) for c in docs.columns]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go. A null text is judged as an empty one and repeated rows alike; without labels of two grades all stay.
    An empty table stays empty; a very long text is judged whole; ties with the cut stay."""
    _bounded(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rated = quality.rate(docs.select(F.struct("*").alias("row"), "doc_id", "text"), labels)
    return rated.where("keep").select(*_fields(docs, "row"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that spread over many sites go, however short they are; n_chars follows the text. Every row stays: a null text stays null,
    a text may become empty, and of ties and repeated rows all keep a line whose smallest id is theirs."""
    _bounded(spark)
    clean = line_dedup.dedup_lines(docs, min_chars=1).select(*[F.col(quoted(c)) for c in docs.columns])
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: of the smallest id (null ids last), then of the smallest hash of id and text.

    A row is told by its id and text: an id that stands on two texts goes only where its text does. Of repeated rows that of the
    smallest hash of its columns stays. Rows without words, nulls among them, are no copies, and all stay. An empty table stays empty; a
    very long text is a longer set of shingles and nothing else.
    """
    _bounded(spark)
    keyed = docs.select(F.struct("*").alias("row"), F.xxhash64("doc_id", "text").alias("name"), "doc_id", "text")
    groups = ngram_join.near_duplicates(keyed, k=5, pct=80, id_col="name").where("n_shingles > 0")
    groups = groups.groupBy(F.col("doc_id").alias("name"), "component_id").agg(F.count("*").alias("n"))
    groups = save(groups.join(keyed.select("name", "doc_id").distinct(), "name"), "groups")
    first = groups.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "name")).alias("first"), F.count("*").alias("rows"))
    gone = save(groups.join(first.where("rows > 1"), "component_id").where("name <> first.name").select("name"), "gone")
    again = save(groups.where("n > 1").select("name"), "again")
    drop(groups)
    gone, again = (F.broadcast(x) if x.count() <= ngram_join.MOST_IDS else x for x in (gone, again))
    left = keyed.join(gone, "name", "left_anti").select("row", "name")
    one = left.join(again, "name", "left_semi").groupBy("name").agg(F.min_by("row", F.struct(F.xxhash64(F.to_json("row")), F.to_json("row"))).alias("row"))
    return left.join(again, "name", "left_anti").select(*_fields(docs, "row")).unionByName(one.select(*_fields(docs, "row")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: equal ids by size, repeated rows alike; rows without words, nulls among them, go. An
    empty table stays empty; a very long text is a row like any other, and the one at its source's cut is kept whole."""
    _bounded(spark)
    return mixing.mixed_documents(docs)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, checked by what they decode to: one row for each row, repeated ones too. A null or empty text has no ids; a
    very long one is encoded whole; an empty table stays empty."""
    _bounded(spark)
    return pieces.encode(docs, registry.model_path(), keep_ids=True, run_chars=RUN_CHARS)


STAGES = [("quality", quality_stage), ("lines", line_stage), ("near_duplicates", near_stage), ("mixing", mixing_stage), ("pieces", pieces_stage)]

#: The classifier and the tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage's table is deleted once the next one is written."""
    docs, before = documents(spark, sf_dir), None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = save(docs, name)
            drop(*([before] if before else []))
            before = docs
    return docs
