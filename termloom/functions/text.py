"""Text, path and report expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token delimiters and the characters a term may be made of.
# \p{Alnum} is ASCII [a-zA-Z0-9] in Java regular expressions. Spelled as ranges, the negated class is a
# chain of range tests and measured several times slower; matching runs of characters was slower, too.
DELIMITERS = r" \t\n\r\f"
TERM_CHARS = r"\p{Alnum}"
# What Java's \s matches, used to cut trailing blanks off matrix lines.
BLANKS = " \t\n\x0b\f\r"


def split_tokens(text: Column) -> Column:
    """Array of whitespace-delimited tokens; a blank at either end yields an empty string there."""
    return F.split(text, f"[{DELIMITERS}]+")


def clean_text(text: Column, keep: str = TERM_CHARS, lowercase: bool = False) -> Column:
    """Delete every character that is neither a delimiter nor in the class body ``keep``.

    Deleting inside the whole text and then splitting gives the same terms as splitting first and
    cleaning each token, with one regular expression pass per row in place of one per token.
    """
    if lowercase:
        text = F.lower(text)
    return F.regexp_replace(text, f"[^{keep}{DELIMITERS}]", "")


def path_text(uri: Column) -> Column:
    """A file URI with its percent escapes resolved; ``+`` is a plain character in a path."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def folder_of(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def file_of(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def doc_name_of(path: Column) -> Column:
    """``<folder>.<file name up to its first dot>``: the name a document dictionary lists."""
    return F.concat_ws(".", folder_of(path), F.substring_index(file_of(path), ".", 1))


def listed_name_of(path: Column) -> Column:
    """``<folder>.<whole file name>``: the inventory form, extension kept."""
    return F.concat_ws(".", folder_of(path), file_of(path))


def class_of(doc_name: Column) -> Column:
    """Class of a document: its name up to the first dot, or all of it when there is none."""
    return F.substring_index(doc_name, ".", 1)


def fields_of(line: Column) -> Column:
    """Blank-separated fields. Trailing blanks add no field, a leading blank adds an empty one."""
    return F.split(F.rtrim(line, F.lit(BLANKS)), r"\s+")
