"""Text normalisers. `trim` strips spaces only, as in SQL."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(name: str) -> Column:
    """Proper nouns and keys: outer spaces go, case stays."""
    return F.trim(F.col(name))


def code(name: str) -> Column:
    """Classification codes: no outer spaces, lower case."""
    return F.lower(F.trim(F.col(name)))


def trimmed_or_null(name: str) -> Column:
    """Like `trimmed`, and a blank text counts as absent."""
    return F.nullif(trimmed(name), F.lit(""))


def code_or_null(name: str) -> Column:
    """Like `code`, and a blank text counts as absent."""
    return F.nullif(code(name), F.lit(""))
