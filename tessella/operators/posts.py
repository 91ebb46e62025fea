"""Dated posts in marked-up files, and mentions of a vocabulary in them."""

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions import markup
from tessella.functions.strings import NON_WORD_CHAR, WORD_CHAR, match_key
from tessella.runtime import BROADCAST_ROWS, fits_broadcast


def split_records(df: DataFrame, column: str, delimiter: str, *keep: str, out: str = "part") -> DataFrame:
    """One row per part of ``column`` between delimiters; blank parts are dropped."""
    parts = df.select(*keep, F.explode(markup.split_on(F.col(column), delimiter)).alias(out))
    return parts.where(F.col(out).rlike(r"(?U)\S"))


def parse_posts(contents: DataFrame) -> DataFrame:
    """``file_name, year, month, body`` of every part of ``file_name, content``.

    Parts without a full date and a body have NULLs; see :func:`posts` and
    :func:`rejected_posts`.  The parser accepts whole files and records cut at
    ``</post>`` alike.
    """
    blogs = split_records(contents, "content", "</Blog>", "file_name")
    clean = blogs.select("file_name", markup.clean_markup(F.col("part")).alias("part"))
    parts = split_records(clean, "part", "</post>", "file_name")
    date, body = markup.date_text(F.col("part")), markup.body_text(F.col("part"))
    return parts.select(
        "file_name",
        markup.date_field(date, 2).alias("year"),
        markup.date_field(date, 1).alias("month"),
        body.alias("body"),
    )


def _is_post() -> Column:
    return F.col("year").isNotNull() & F.col("month").isNotNull() & F.col("body").isNotNull()


def posts(contents: DataFrame) -> DataFrame:
    """``file_name, year, month, body``, one row per post."""
    return parse_posts(contents).where(_is_post())


def rejected_posts(contents: DataFrame) -> DataFrame:
    """``file_name, n``: parts per file that are not blank and yet no posts."""
    bad = parse_posts(contents).where(~_is_post())
    return bad.groupBy("file_name").agg(F.count(F.lit(1)).alias("n"))


def term_keys(terms: DataFrame) -> DataFrame:
    """``term, key, runs, word_first`` of a vocabulary (column ``term``).

    ``key`` is the term in comparison form.  It is a sequence of runs, word characters and others
    in turn: ``runs`` counts them and ``word_first`` says which kind begins.
    """
    keyed = terms.where(F.col("term") != "").select("term").distinct().withColumn("key", match_key(F.col("term")))
    runs = F.regexp_extract_all("key", F.lit(f"{WORD_CHAR}+|{NON_WORD_CHAR}+"), 0)
    return keyed.withColumn("runs", F.size(runs)).withColumn("word_first", F.col("key").rlike(f"^{WORD_CHAR}"))


#: Most different counts kept in a task before they are sent on.
COUNTS = 1_000_000

_WORD = re.compile(r"\w+")


def _gram_counts(shapes: list[tuple[int, bool]], wanted) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts per month of every sequence of whole runs that has one of the shapes.

    Equal sequences are counted from the left without overlap, as a pattern's matches are.
    """

    def send(counts: dict[tuple[str | None, str], int]) -> pa.RecordBatch:
        months, keys = zip(*counts) if counts else ((), ())
        columns = [pa.array(months, pa.string()), pa.array(keys, pa.string()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["year_month", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = wanted.value if wanted is not None else None
        counts: dict[tuple[str | None, str], int] = {}
        for batch in batches:
            for month, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if body is None:
                    continue
                edges = [e for m in _WORD.finditer(body) for e in m.span()]
                for runs, word_first in shapes:
                    free: dict[str, int] = {}  # where the last one counted ends
                    for at in range(0 if word_first else 1, len(edges) - runs, 2):
                        start, stop = edges[at], edges[at + runs]
                        gram = body[start:stop]
                        if keep is not None and gram not in keep:
                            continue
                        if runs > 1:
                            if free.get(gram, 0) > start:
                                continue
                            free[gram] = stop
                        counts[month, gram] = counts.get((month, gram), 0) + 1
                if len(counts) >= COUNTS:
                    yield send(counts)
                    counts = {}
        yield send(counts)

    return run


def term_mentions(
    dated: DataFrame, terms: DataFrame, max_broadcast_terms: int = BROADCAST_ROWS
) -> DataFrame:
    """``year_month, term, n``: whole-word mentions of each term, where there are any.

    ``dated`` has ``year, month, body``; ``terms`` has ``term``.  A term's edges are word
    boundaries, so a mention is a sequence of whole runs (words and what stands between
    them) that equals the term.  One pass over the bodies counts the sequences of as many runs as terms
    have, per task and month, and the counts meet the terms by key; no post is paired with a
    term.  A key that is everywhere reaches the join as one row a month.

    A vocabulary of at most ``max_broadcast_terms`` terms is sent to the tasks, which then count
    its sequences alone; of a larger one only the shapes are.  The plan is the same.
    """
    keyed = term_keys(terms)
    shapes = [(r.runs, r.word_first) for r in keyed.select("runs", "word_first").distinct().collect()]
    few = fits_broadcast(keyed, max_broadcast_terms)
    wanted = dated.sparkSession.sparkContext.broadcast({r.key for r in keyed.select("key").collect()}) if few else None
    month = markup.year_month(F.col("year"), F.col("month")).alias("year_month")
    bodies = dated.select(month, match_key(F.col("body")).alias("body"))
    found = bodies.mapInArrow(_gram_counts(sorted(shapes), wanted), "year_month string, key string, n long")
    summed = found.groupBy("year_month", "key").agg(F.sum("n").alias("n"))
    vocabulary = keyed.select("term", "key")
    return summed.join(F.broadcast(vocabulary) if few else vocabulary, "key").select("year_month", "term", "n")


def term_mentions_by_scan(dated: DataFrame, terms: list[str]) -> DataFrame:
    """The same counts by scanning each body once per term, for a handful of terms.

    The terms are constants of the plan; nothing is joined.
    """
    counts = F.array(
        *(
            F.struct(F.lit(t).alias("term"), markup.count_term(F.col("body"), F.lit(t)).alias("n"))
            for t in terms
        )
    )
    rows = dated.select(
        markup.year_month(F.col("year"), F.col("month")).alias("year_month"), F.inline(counts)
    )
    return drop_zero(rows.groupBy("year_month", "term").agg(F.sum("n").alias("n")))


def drop_zero(mentions: DataFrame) -> DataFrame:
    return mentions.where("n > 0")


def months_per_term(mentions: DataFrame) -> DataFrame:
    """``term, months``: the months of each term with their counts, sorted by month.

    The input has one row per month and term, so a list is as long as the calendar.
    """
    months = F.array_sort(F.collect_list(F.struct("year_month", "n")))
    return mentions.groupBy("term").agg(months.alias("months"))
