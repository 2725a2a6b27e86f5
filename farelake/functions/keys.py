"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text that stands for a null key part.
NULL_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: Column) -> Column:
    """Hex MD5 of the parts as text, joined by ``-``, with nulls replaced by a fixed text."""
    texts = [F.coalesce(part.cast("string"), F.lit(NULL_PART)) for part in parts]
    return F.md5(F.concat_ws("-", *texts))
