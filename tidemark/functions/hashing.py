"""Row fingerprint for lineage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


DIGEST_BYTES = 16


def row_digest(cols: list[str]) -> Column:
    """The first 16 bytes of the SHA-256 over the values joined by '|': the identity of a row's content.

    128 bits tell any number of rows apart that a table can hold, and a digest does not compress: half of it is half the
    bytes in every shuffle and layer.  Bytes sort as their hex text does.

    Hashes the raw text fields; NULL is spelled 'nan' because concat_ws would
    otherwise skip it and shift the fields.
    """
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("nan")) for c in cols]
    return F.unhex(F.left(F.sha2(F.concat_ws("|", *parts), 256), F.lit(2 * DIGEST_BYTES)))


def row_hash(digest: Column, width: int = 16) -> Column:
    """The first ``width`` hex of the digest: for display; two rows may share it."""
    return F.lower(F.hex(F.substring(digest, 1, width // 2)))
