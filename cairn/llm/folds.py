"""Which rows a model may learn from."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def crc_fold(id_col: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as an empty text."""
    ids = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(ids.cast("string"), F.lit("")).cast("binary")) % folds
