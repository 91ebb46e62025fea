"""Tokens, word counts and per-document term frequencies."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions.lambdas import bind, indices
from tessella.functions.strings import file_field, fold_case, words_of


def tokenize(docs: DataFrame, column: str = "text", *keep: str) -> DataFrame:
    """One row per word, in column ``word``, beside the columns named in ``keep``."""
    words = docs.select(*keep, F.explode(words_of(F.col(column))).alias("word"))
    return words.where(F.col("word") != "")


def folded_tokens(docs: DataFrame, column: str = "text", *keep: str) -> DataFrame:
    """As :func:`tokenize`, lower-cased; the text is folded once, before it is cut."""
    words = docs.select(*keep, F.explode(words_of(fold_case(F.col(column)))).alias("word"))
    return words.where(F.col("word") != "")


def word_count(docs: DataFrame, column: str = "text") -> DataFrame:
    """``word, n`` over all documents, without regard to case."""
    return folded_tokens(docs, column).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def term_frequency(docs: DataFrame, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """``id, word, n``: counts within each document row.

    A document is one row, so its words are counted where the row is: sort them, find
    where each run starts, take the run lengths.  No shuffle.
    """

    def runs(words):
        def starts_run(i):
            return (i == 0) | (F.get(words, i) != F.get(words, i - 1))

        starts = F.filter(indices(F.size(words)), starts_run)
        return bind(
            F.concat(starts, F.array(F.size(words))),
            lambda cuts: F.transform(
                indices(F.size(cuts) - 1),
                lambda i: F.struct(
                    F.get(words, F.get(cuts, i)).alias("word"),
                    (F.get(cuts, i + 1) - F.get(cuts, i)).cast("bigint").alias("n"),
                ),
            ),
        )

    words = F.sort_array(F.array_remove(words_of(fold_case(F.col(column))), ""))
    counted = docs.select(id_column, F.inline(bind(words, runs)))
    return counted


def sum_partials(frequencies: DataFrame) -> DataFrame:
    """``word, n`` from per-document counts."""
    return frequencies.groupBy("word").agg(F.sum("n").alias("n"))


def sort_output(df: DataFrame, *columns: str) -> DataFrame:
    """Key order, for a final listing only."""
    return df.orderBy(*columns)


def vocabulary(file_names: DataFrame, index: int = 3, column: str = "file_name") -> DataFrame:
    """Distinct ``index``-th file-name fields as ``term``; names too short give none."""
    terms = file_names.select(file_field(F.col(column), index).alias("term"))
    return terms.where(F.col("term") != "").distinct()


def short_names(file_names: DataFrame, index: int = 3, column: str = "file_name") -> DataFrame:
    """File names that :func:`vocabulary` leaves out."""
    field = file_field(F.col(column), index)
    return file_names.where(field.isNull() | (field == "")).select(column)
