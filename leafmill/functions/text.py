"""String expressions with the white-space rules of Python text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters that Python's str.strip() and \s treat as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set for use inside a Java pattern that has the flag U.
SPACE = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """Remove white space at both ends. Linear and regex-free, unlike ``\\s+$``."""
    return F.btrim(text, F.lit(WHITESPACE))


def unix_newlines(text: Column) -> Column:
    """``\\r\\n`` and lone ``\\r`` become ``\\n``, as when Python reads in text mode."""
    return F.regexp_replace(text, "\r\n?", "\n")


def squeeze(text: Column) -> Column:
    """Every run of white space becomes one blank."""
    return F.regexp_replace(text, f"(?U){SPACE}+", " ")


def listed_name(encoded: Column) -> Column:
    """The plain form of a name in ``_metadata``, which is written as in a URI."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/]+\z", 0)


def file_stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(?s)(?<=.)\.[^.]+\z", "")


def file_ext(name: Column) -> Column:
    """The last suffix without its dot; a name that only starts with a dot has none."""
    return F.regexp_extract(name, r"(?s)^.+\.([^.]+)\z", 1)


def human_size(size: Column) -> Column:
    """Bytes below 1 KiB, whole KB below 1 MiB, else MB with one decimal; halves go to even."""
    kb, mb = size / F.lit(1024.0), size / F.lit(1024.0 * 1024.0)
    return (
        F.when(size < 1024, F.format_string("%d B", size))
        .when(size < 1024 * 1024, F.format_string("%.0f KB", F.bround(kb, 0)))
        .otherwise(F.format_string("%.1f MB", F.bround(mb, 1)))
    )
