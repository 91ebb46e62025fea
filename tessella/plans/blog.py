"""Industry mentions per month over a folder of blog files."""

from pyspark.sql import DataFrame, SparkSession

from tessella.operators import posts as P
from tessella.operators.text import vocabulary
from tessella.sources.files import list_files, read_records, read_whole_text


def industry_mentions(contents: DataFrame, file_names: DataFrame, field: int = 3) -> DataFrame:
    """``year_month, term, n`` from file contents and from the names that give the terms."""
    return P.drop_zero(P.term_mentions(P.posts(contents), vocabulary(file_names, field)))


def blog_industry_mentions(
    spark: SparkSession, folder: str, field: int = 3, whole_files: bool = False, grouped: bool = True
) -> DataFrame:
    """``term, months`` (or ``year_month, term, n`` if not grouped) of all files of a folder.

    Files are read as records that end with ``</post>``, which splits large files over
    tasks; ``whole_files`` reads each as one row.
    """
    contents = read_whole_text(spark, folder) if whole_files else read_records(spark, folder, "</post>")
    mentions = industry_mentions(contents, list_files(spark, folder), field)
    return P.months_per_term(mentions) if grouped else mentions
