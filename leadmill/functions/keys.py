"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The text a surrogate key hashes in place of NULL, and its separator.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"


def _texts(cols: tuple[str, ...], null_text: str) -> str:
    return ", ".join(f"coalesce(cast({c} AS STRING), '{null_text}')" for c in cols)


def surrogate_key(*cols: str) -> Column:
    """MD5 over the text forms of the columns; NULLs hash as a fixed text, so the key is never NULL."""
    return F.expr(f"md5(concat_ws('{KEY_SEPARATOR}', {_texts(cols, NULL_KEY_TEXT)}))")


def packed_key(key: str, *cols: str) -> Column:
    """A stored key for the way through shuffles: empty where it is the surrogate key of the columns.

    Hashes do not compress, and their hex text is longer than most ids. Any other key goes along as it is, behind a mark.
    """
    return F.when(F.col(key).eqNullSafe(surrogate_key(*cols)), "").otherwise(F.concat(F.lit("="), F.col(key)))


def unpacked_key(packed: str, *cols: str) -> Column:
    """The key that ``packed_key`` packed, from the same columns; NULL where that is NULL."""
    return F.when(F.col(packed) == "", surrogate_key(*cols)).otherwise(F.expr(f"substring({packed}, 2)"))


def fact_key(*cols: str) -> Column:
    """MD5 over the columns glued together without separator, NULL as empty text."""
    return F.expr(f"md5(concat({_texts(cols, '')}))")
