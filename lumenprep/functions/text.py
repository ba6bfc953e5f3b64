"""Text functions with the exact meaning of Python's str methods, as built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that str.isspace() accepts, as the inside of a character class (for Java and RE2 alike).
WHITE = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def tokens(c: Column) -> Column:
    """str.split(): runs of anything but white space."""
    return F.regexp_extract_all(c, F.lit(f"[^{WHITE}]+"), F.lit(0))


def word_count(c: Column) -> Column:
    """How many tokens there are: what stands between white space and isn't empty, which costs less than to match each token.

    The class asks first for printable ASCII, which most characters are.
    """
    return F.size(F.array_remove(F.split(c, f"[[^\\x21-\\x7e]&&[{WHITE}]]"), "")).cast("long")


def strip(c: Column) -> Column:
    """str.strip()."""
    return F.regexp_replace(c, f"^[{WHITE}]+|[{WHITE}]+$", "")


def is_url(c: Column) -> Column:
    return F.coalesce(F.startswith(c, F.lit("http://")) | F.startswith(c, F.lit("https://")), F.lit(False))


def sanitize_repo_id(c: Column) -> Column:
    return F.replace(c, F.lit("/"), F.lit("__"))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def stem(path: Column) -> Column:
    """Path.stem: the name without its last suffix; a leading dot is no suffix."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]+$", "")


def suffix(path: Column) -> Column:
    """Path.suffix, with its dot."""
    return F.regexp_extract(file_name(path), r"(?<=.)(\.[^.]+)$", 1)
