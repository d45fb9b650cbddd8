"""Training documents from `documents`: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from closebook.llm import decontamination, jaccard_join, line_dedup, mixing, quality_classifier
from closebook.llm.storage import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.train(docs, quality_classifier.ratings_of(labels))
    return quality_classifier.selected(docs, model, quality_classifier.LEAST_GRADE,
                                       quality_classifier.LEAST_TAIL)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies and near copies of lines go, and documents of nothing else with them."""
    before, = line_dedup.free_names(docs.columns, "before")
    clean = line_dedup.deduplicate(docs.withColumn(before, F.length("text")))
    emptied = (F.col(before) > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return clean.where(~F.coalesce(emptied, F.lit(False))) \
        .withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        .select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id.

    A null id is the smallest.  Of rows of equal id and text, unless without words, one stays.
    """
    keyed = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    repeated = stored(keyed.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).groupBy("_row").agg(
        F.count("*").alias("rows")).where("rows > 1").select("_row"), "repeated")
    single = keyed.join(repeated, "_row", "left_anti").select(*docs.columns, "_row")
    rows = single.unionByName(
        keyed.join(repeated, "_row", "left_semi").groupBy("_row").agg(
            F.min(F.struct(*docs.columns)).alias("s")).select("s.*", "_row"))
    found = jaccard_join.near_duplicates(rows, id_col="_row").select(
        F.col("doc_id").alias("_row"), "component_id").distinct()
    kept = rows.select("doc_id", "_row").join(found, "_row").groupBy("component_id").agg(
        F.min(F.struct("doc_id", "_row")).alias("s")).select("s._row")
    return rows.join(kept, "_row", "left_semi").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go; the verdict depends on the text only."""
    keyed = docs.withColumn("_row", F.xxhash64("text"))
    found = decontamination.contamination(
        keyed.select(F.col("_row").alias("doc_id"), "text"),
        spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = found.where("contaminated").select(F.col("doc_id").alias("_row")).distinct()
    return keyed.join(hit, "_row", "left_anti").select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with the number of times it takes each as `copies`.

    Rows of equal id, text and source share what the mix takes of them: each gets the even part,
    and as many as are left over one more.
    """
    keyed = docs.withColumn("_row", F.xxhash64("doc_id", "text", "source"))
    taken = stored(
        mixing.mix(keyed.select(F.col("_row").alias("doc_id"), "text", "source"))
        .groupBy(F.col("doc_id").alias("_row")).agg(F.sum("copies").alias("total"),
                                                    F.count("*").alias("alike")), "taken")
    even = F.expr("cast(total div alike as int)")
    order = Window.partitionBy("_row").orderBy(*[c for c in docs.columns if c != "text"])
    evenly = keyed.join(taken.where("total > 0 and total % alike = 0"), "_row").withColumn(
        "copies", even)
    shared = keyed.join(taken.where("total % alike > 0"), "_row").withColumn(
        "copies", even + (F.row_number().over(order) <= F.expr("total % alike")).cast("int"))
    return evenly.unionByName(shared).where("copies > 0").select(*docs.columns, "copies")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("line dedup", repeated_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mixture),
]

#: the stages train a model and sample, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
