"""Text and path expressions: line counting, labels from paths, report lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The line boundaries of Python's str.splitlines, in Java regex
# syntax. "\r\n" is one boundary; each of the others is one boundary alone:
# \n, \r, \x0b (VT), \x0c (FF), \x1c, \x1d, \x1e, \x85 (NEL), U+2028, U+2029.
LINE_BREAK = r"\r\n|[\n\r\x{0B}\x{0C}\x{1C}\x{1D}\x{1E}\x{85}\x{2028}\x{2029}]"
ENDS_WITH_BREAK = r"(" + LINE_BREAK + r")\z"

# Fixed value: label = name of the directory holding the file.
PARENT_DIR = r"([^/]+)/[^/]+$"
# Fixed value: file name without its last extension.
FILE_STEM = r"([^/]+?)(\.[^./]*)?$"
# Fixed value: the report line of the line counter.
REPORT_FORMAT = "Number of lines in %s: %d"


def line_break_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(LINE_BREAK))


def line_count(text: Column) -> Column:
    """Number of lines as ``str.splitlines`` counts them.

    Every boundary ends a line; a final line without a boundary counts too; an
    empty text has no lines. Null stays null.
    """
    unterminated = (F.length(text) > 0) & ~text.rlike(ENDS_WITH_BREAK)
    return line_break_count(text) + F.when(unterminated, 1).otherwise(0).cast("bigint")


def parent_dir(path: Column) -> Column:
    return F.regexp_extract(path, PARENT_DIR, 1)


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, FILE_STEM, 1)


def report_line(path: Column, n: Column) -> Column:
    return F.format_string(REPORT_FORMAT, path, n)


def plain_path(path: Column, decode: bool = True) -> Column:
    """A path as its owner writes it: URL escapes of ``_metadata.file_path`` undone once, no ``file:`` scheme."""
    if decode:
        path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(path, "^file:/*(?=/)", "")
