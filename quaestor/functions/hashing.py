"""Surrogate and change hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quaestor.functions.numeric import col

# Separator and NULL marker used inside hashed strings.
HASH_SEP = "|"
NULL_MARKER = "_null_"


def hash_input(*cols) -> Column:
    return F.concat_ws(HASH_SEP, *[F.coalesce(col(c).cast("string"), F.lit(NULL_MARKER)) for c in cols])


def surrogate_hash(*cols) -> Column:
    """MD5 over the ordered key columns (staging surrogate key)."""
    return F.md5(hash_input(*cols))


def change_hash(*cols) -> Column:
    """SHA-256 over the tracked attribute columns (SCD2 change test)."""
    return F.sha2(hash_input(*cols), 256)


def row_identifier(*cols) -> Column:
    """Key columns joined by ':' (B13)."""
    return F.concat_ws(":", *[F.coalesce(col(c).cast("string"), F.lit("")) for c in cols])
