"""Inputs of the registered queries, derived from the given tables."""

import io
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import grids
from tessella.functions.lambdas import computed
from tessella.functions.strings import WORD_CHAR, fold_case, words_of
from tessella.operators.tiles import grid_features
from tessella.runtime import spread

#: Shape of the small grids made from the 64 values of an embedding.
SIDE = 8

#: Signature length and band size that suit 112 features.
FEAT_M, FEAT_B = 32, 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars"), "doc_id")


def key_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R: parts and their sizes.  S: what line items name, part and quantity."""
    parts = table(spark, sf_dir, "part").select(F.concat_ws(":", "p_partkey", "p_size").alias("element"))
    lines = table(spark, sf_dir, "lineitem")
    named = F.concat_ws(":", "l_partkey", F.col("l_quantity").cast("int")).alias("element")
    return parts.withColumn("label", F.lit("R")).unionByName(lines.select(named, F.lit("S").alias("label")))


def word_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``label, elements``: R holds the words of each document, S those of each conversation turn."""
    words = F.array_remove(words_of(fold_case(F.col("text"))), "").alias("elements")
    turns = table(spark, sf_dir, "conversations")
    return docs(spark, sf_dir).select(F.lit("R").alias("label"), words).unionByName(
        turns.select(F.lit("S").alias("label"), words)
    )


def _line_date(doc_id: Column, line: Column) -> Column:
    days = F.pmod(doc_id * 3 + line, F.lit(1461)).cast("int")
    return F.date_add(F.lit("2004-01-01").cast("date"), days)


def _plain(line: Column) -> Column:
    """The line without tag brackets, which the files have no other way to write."""
    return F.replace(line, F.lit("<"), F.lit(" "))


def posts_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_name, year, month, body``: every line of every document is a dated post."""
    lines = docs(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    day = _line_date(F.col("doc_id"), F.col("pos"))
    return lines.select(
        F.concat(F.lit("doc."), "doc_id").alias("file_name"),
        F.date_format(day, "yyyy").alias("year"),
        F.date_format(day, "MMMM").alias("month"),
        _plain(F.col("line")).alias("body"),
    )


def blog_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_name, content``: the same posts as marked-up files, one per document.

    Long documents end in a part that has no body, as a broken file would.
    """

    def marked(line: Column, pos: Column) -> Column:
        return F.concat(
            F.lit("<date>"),
            F.date_format(_line_date(F.col("doc_id"), pos), "d,MMMM,yyyy"),
            F.lit("</date>\r\n<post>\r\n"),
            _plain(line),
            F.lit("\r\n</post>\r\n\r\n"),
        )

    entries = F.array_join(F.transform(F.split("text", "\n"), marked), "")
    broken = F.when(F.col("n_chars") > 2000, F.lit("<date>1,May\r\n")).otherwise(F.lit(""))
    return docs(spark, sf_dir).select(
        F.concat(F.lit("doc."), "doc_id").alias("file_name"),
        F.concat(F.lit("<Blog>\r\n\r\n"), entries, broken, F.lit("</Blog>\r\n")).alias("content"),
    )


def blog_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_name``: a name for every word, and for every second pair of words, of every item, as
    its fourth field."""
    items = table(spark, sf_dir, "benchmark")
    found = lambda pattern: F.regexp_extract_all(F.lower("text"), F.lit(pattern), 0)
    words, pairs = found(f"{WORD_CHAR}+"), found(f"{WORD_CHAR}+[ -]{WORD_CHAR}+")
    stems = items.select("item_id", F.explode(computed(F.concat(words, pairs))).alias("term"))
    return stems.select(F.concat(F.lit("b"), "item_id", F.lit(".x.y."), "term", F.lit(".z.xml")).alias("file_name"))


def gray8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vec_id, label, v``: embeddings as 8x8 grids of integers, row-major."""
    cells = F.transform(
        "embedding", lambda x: F.floor((x.cast("double") + 1) * F.lit(127.5)).cast("int")
    )
    vectors = spread(table(spark, sf_dir, "embeddings"), "vec_id")
    return vectors.select("vec_id", "label", cells.alias("v"))


def intensity4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vec_id, v``: the same values as 4x4 pixels of four channels, reduced to intensity."""
    return gray8(spark, sf_dir).select("vec_id", grids.intensity(F.col("v"), 16).alias("v"))


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_name, content``: the same values as zipped 4x4 images of four channels.

    The last digit of an id says what is wrong with its archive: 4 cells of two bytes, 5 a file cut
    in half, 6 a row too few, 7 a channel too few, 8 no image, 9 an image that does not decode.
    """
    cells = F.transform(F.col("v"), lambda x: F.least(F.greatest(x, F.lit(0)), F.lit(255)))
    zipped = F.arrow_udf(_zipped, "binary")
    return gray8(spark, sf_dir).select(
        F.concat(F.lit("e"), "vec_id", F.lit(".zip")).alias("file_name"), zipped(F.col("vec_id"), cells).alias("content")
    )


def _zipped(ids: pa.Array, cells: pa.Array) -> pa.Array:
    out = []
    for i, values in zip(ids.to_pylist(), cells.to_pylist()):
        wrong = i % 10
        image = np.array(values, np.uint16 if wrong == 4 else np.uint8).reshape(4, 4, 4)
        image = image[:3] if wrong == 6 else image[:, :, :3] if wrong == 7 else image
        member = io.BytesIO()
        np.save(member, image)
        data = member.getvalue()[:40] if wrong == 9 else member.getvalue()
        file = io.BytesIO()
        with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as zf:
            zf.writestr("notes.txt" if wrong == 8 else "image.npy", data)
        content = file.getvalue()
        out.append(content[: len(content) // 2] if wrong == 5 else content)
    return pa.array(out, pa.binary())


def feat(spark: SparkSession, sf_dir: str, block: int = 1) -> DataFrame:
    """``vec_id, features``."""
    return grid_features(gray8(spark, sf_dir), "vec_id", SIDE, SIDE, block)


def exemplars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vec_id``: one candidate per label, the lowest id of each."""
    vectors = table(spark, sf_dir, "embeddings")
    return vectors.groupBy("label").agg(F.min("vec_id").alias("vec_id")).select("vec_id")


def fixed_basis(width: int, k: int) -> list[list[float]]:
    """A ``width x k`` matrix given by a formula."""
    return [[((pos * 7 + comp * 13) % 11 - 5) / 10.0 for comp in range(k)] for pos in range(width)]
