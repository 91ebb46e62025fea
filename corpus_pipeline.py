"""A training corpus from ``documents``: five stages, each written as Parquet and reread.

1. language: documents whose language is rejected go (no letter, or too far from every centroid);
2. near duplicates: of documents linked by five-word shingles at 0.8 or more, the smallest id stays;
3. repeats: bytes covered by a 200-byte string that occurs elsewhere go, the document stays;
4. mixture: sources are passed and drawn to their target weights, repeats as repeated rows;
5. tokens: whole texts as ids, with the text they decode to.

All but the last return the columns of ``documents``.
"""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import bpe, jaccard, language, mixing, repeats
from tessella.llm.common import new_folder, table
from tessella.llm.queries import tokenizer_file

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language.  The classifier learns from the given documents."""
    predict = language.language_of(language.fit(docs))
    return docs.select(*COLUMNS).where(~predict("text")["rejected"])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id; documents
    without words all stay.  Of rows with the group's smallest id, one stays."""
    found = jaccard.near_duplicates(docs, width=5, share=80)
    keep = found.where("n_shingles > 0 AND doc_id <=> component_id").groupBy("doc_id").agg(F.min("text_hash").alias("text_hash"))
    keep = keep.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    hashed = docs.select(*COLUMNS, F.xxhash64("text").alias("_own"))
    kept = hashed.join(keep, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_hash")), "left_semi")
    # several rows may have the same id and text; they meet in partial results, a row a task
    rest = F.min(F.struct("source", "lang", "n_chars", "text")).alias("rest")
    one = kept.groupBy("doc_id", "_own").agg(rest).select("doc_id", "rest.text", "rest.lang", "rest.source", "rest.n_chars")
    wordless = F.coalesce(~F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(True))
    return one.unionByName(docs.select(*COLUMNS).where(wordless))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated strings; a character that was cut in part goes; null stays null."""
    cut = repeats.remove_repeats(docs.select(*COLUMNS), into="_cut")
    text = F.when(F.col("text").isNotNull(), F.arrow_udf(_characters, "string")("_cut.kept"))
    return cut.withColumn("text", F.when(F.col("_cut.n_removed") > 0, text).otherwise(F.col("text"))).select(
        "doc_id", "text", "lang", "source", F.when(F.col("_cut.n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
    )


def _characters(raw: pa.Array) -> pa.Array:
    return pa.array([b.decode("utf-8", "ignore") if b is not None else None for b in raw.to_pylist()], pa.string())


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a row for each time that it takes a document."""
    weights = mixing.quality_weights(table(spark, sf_dir, "labels"))
    rows = mixing.keyed(docs.select(*COLUMNS), weights)
    plan = mixing.mixing_plan(rows.select("doc_id", "source", "size", "key"))
    taken = mixing.apply_plan(rows, plan).where("passes > 0")
    return taken.withColumn("_pass", F.explode(F.sequence(F.lit(1).cast("long"), F.col("passes")))).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids, decoded``."""
    coded = bpe.coded(docs.select("doc_id", "lang", "source", "text"), tokenizer_file(), "ids", "decoded")
    return coded.select("doc_id", "lang", "source", F.size("code.ids").cast("long").alias("n_tokens"), "code.ids", "code.decoded")


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("repeats", without_repeats),
    ("mixture", mixed),
    ("tokens", tokens),
]

#: SQL has neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
