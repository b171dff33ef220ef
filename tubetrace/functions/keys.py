"""Business keys and the ids derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "_"


def business_key(*parts) -> Column:
    """Parts joined by the key separator; null when any part is null."""
    cols = [_col(p).cast("string") for p in parts]
    return F.when(_all_present(cols), F.concat_ws(SEPARATOR, *cols))


def union_id(*parts) -> Column:
    """Key of an accumulated statistics row: parts joined, nulls skipped."""
    return F.concat_ws(SEPARATOR, *[_col(p).cast("string") for p in parts])


def hash_id(space: str | Column, key) -> Column:
    """Stateless non-negative 63-bit id of ``key`` within an id space.

    The same key always gives the same id, so replays and retries are idempotent and
    no lookup is needed. Two of n keys share an id with probability about n*n/2**64;
    use ``identity.assign_mapped_ids`` where that is too much.
    """
    space = F.lit(space) if isinstance(space, str) else space
    return F.xxhash64(space, _col(key)).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))


def store_key(key) -> Column:
    """Row key of the keyed stores: hex digest of the business key."""
    return F.md5(_col(key).cast("binary"))


def _all_present(cols: list[Column]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & c.isNotNull()
    return cond


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value
