"""Words, keys and file-name fields."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes equal to those of Python's str.split() and of \w in
# a str pattern, in Java regex syntax.
WHITESPACE = r"[\t-\r\x1c-\x1f\x85\p{Z}]"
WORD_CHAR = r"[\p{L}\p{N}_]"
# The complement; most characters are settled by the first, cheaper part.
NON_WORD_CHAR = r"[[^a-zA-Z0-9_]&&[^\p{L}\p{N}]]"

# Letters that a case-insensitive Unicode match treats as equal although
# lower-casing keeps them apart.
CASE_PARTNERS_FROM = "İıſµςϐϑϕϖϰϱϵ"
CASE_PARTNERS_TO = "iisμσβθφπκρε"


def words_of(text: Column) -> Column:
    """Array of whitespace-separated words of ``text``; punctuation is kept.

    A leading or trailing separator leaves an empty string at that end, which
    :func:`tessella.operators.text.tokenize` drops.
    """
    return F.split(text, WHITESPACE + "+")


def fold_case(text: Column) -> Column:
    """Lower-case, for counting words without regard to case."""
    return F.lower(text)


def match_key(text: Column) -> Column:
    """Case-insensitive comparison key used when matching terms in bodies.

    Partners are mapped before lowering and once more after it, which makes a last sigma of a word ``ς``.
    """
    key = F.lower(F.translate(text, CASE_PARTNERS_FROM, CASE_PARTNERS_TO))
    return F.translate(key, CASE_PARTNERS_FROM, CASE_PARTNERS_TO)


def base_name(path: Column) -> Column:
    """Last ``/``-part of a path, whatever its depth."""
    return F.element_at(F.split(path, "/"), -1)


def file_field(name: Column, index: int) -> Column:
    """``index``-th dot-separated field of a file name, NULL when there are fewer."""
    return F.get(F.split(name, r"\."), F.lit(index))


def tile_id(image: Column, index: Column) -> Column:
    """``image-index``."""
    return F.concat_ws("-", image, index.cast("string"))


def tile_image(tile: Column) -> Column:
    """Image part of a tile id; dashes inside the image name are kept."""
    return F.regexp_extract(tile, r"^(.*)-(\d+)$", 1)


def tile_index(tile: Column) -> Column:
    """Index part of a tile id."""
    return F.regexp_extract(tile, r"^(.*)-(\d+)$", 2).cast("int")


def text_key_bucket(key: Column, buckets: int) -> Column:
    """Sum of the code points of a text key, modulo ``buckets``."""
    total = F.aggregate(F.split(key, ""), F.lit(0).cast("bigint"), lambda acc, ch: acc + F.ascii(ch))
    return F.pmod(total, F.lit(buckets)).cast("int")


def number_key_bucket(key: Column, buckets: int) -> Column:
    """Integer key modulo ``buckets``, never negative."""
    return F.pmod(key.cast("bigint"), F.lit(buckets)).cast("int")
