"""Words as all operators here take them: runs without space, tab, line feed, VT, FF or CR."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
_SPACE_RUN = r"[\x20\x09-\x0D]+"


def word_array(text: Column) -> Column:
    """The words of a text as an array; NULL and blank texts have none."""
    trimmed = F.btrim(text, F.lit(SPACES))
    none = F.array().cast("array<string>")
    return F.when(F.length(trimmed) > 0, F.split(trimmed, _SPACE_RUN)).otherwise(none)


def word_count(text: Column) -> Column:
    return F.size(word_array(text)).cast("bigint")
