"""Cleaning and cutting of dated posts, and whole-word term counts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessella.functions.strings import WORD_CHAR, match_key


def quoted(text: Column) -> Column:
    """Regex that matches ``text`` literally."""
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def split_on(content: Column, delimiter: str) -> Column:
    """Parts of ``content`` between occurrences of a literal, case-sensitive delimiter."""
    return F.split(content, rf"\Q{delimiter}\E")


def strip_open_tag(content: Column, tag: str, eat_space: bool = True) -> Column:
    """Remove ``<tag>`` in any letter case, and the whitespace after it if asked."""
    return F.regexp_replace(content, rf"(?iU)<{tag}>" + (r"\s*" if eat_space else ""), "")


def strip_crlf(content: Column) -> Column:
    """Delete CR-LF pairs; the words around one are joined, a bare LF stays."""
    return F.replace(content, F.lit("\r\n"), F.lit(""))


def clean_markup(content: Column) -> Column:
    """Drop blog and post open tags and CR-LF pairs, in the order the parser needs."""
    return strip_open_tag(strip_crlf(strip_open_tag(content, "Blog")), "post", eat_space=False)


def date_text(part: Column) -> Column:
    """Date part of one post: what stands before the close tag, open tag removed."""
    return strip_open_tag(F.get(split_on(part, "</date>"), F.lit(0)), "date")


def body_text(part: Column) -> Column:
    """Body of one post: what stands between the first and the second date close tag."""
    return F.get(split_on(part, "</date>"), F.lit(1))


def date_field(date: Column, index: int) -> Column:
    """Field of a ``day,month,year`` text, NULL when there are fewer."""
    return F.get(F.split(date, ","), F.lit(index))


def post_date(date: Column) -> Column:
    """The date as a DATE, NULL when it is not of the form ``1,January,2004``."""
    return F.try_to_date(date, "d,MMMM,yyyy")


def year_month(year: Column, month: Column) -> Column:
    return F.concat(year, F.lit("-"), month)


def count_keyed(body_key: Column, term_key: Column) -> Column:
    """Non-overlapping whole-word occurrences, both sides in comparison form already."""
    edge = rf"(?:(?<={WORD_CHAR})(?!{WORD_CHAR})|(?<!{WORD_CHAR})(?={WORD_CHAR}))"
    return F.regexp_count(body_key, F.concat(F.lit(edge), quoted(term_key), F.lit(edge)))


def count_term(body: Column, term: Column) -> Column:
    """Non-overlapping, case-insensitive, whole-word occurrences of ``term``.

    The term is matched literally.  This is the one-pair form; to count a whole
    vocabulary use :func:`tessella.operators.posts.term_mentions`.
    """
    return count_keyed(match_key(body), match_key(term))
