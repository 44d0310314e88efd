"""Hashed keys and personal-data masking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions._cols import ColumnOrName, as_col

__all__ = ["surrogate_key", "mask_partial", "mask_email", "row_checksum", "SURROGATE_NULL"]

# Fixed value: keys must equal those already stored by existing users of the key function.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*fields: ColumnOrName, null_token: str = SURROGATE_NULL) -> Column:
    """md5 over the dash-joined text of ``fields``; pass ``null_token=""`` to treat NULL as empty."""
    parts = [F.coalesce(as_col(f).cast("string"), F.lit(null_token)) for f in fields]
    return F.md5(F.concat_ws("-", *parts))


def mask_partial(value: ColumnOrName, keep: int = 1) -> Column:
    """Keep the first ``keep`` characters and replace each of the others with ``*``."""
    text = as_col(value).cast("string")
    return F.concat(
        F.substring(text, 1, keep),
        F.repeat(F.lit("*"), F.greatest(F.length(text) - keep, F.lit(0))),
    )


def mask_email(value: ColumnOrName, keep: int = 1) -> Column:
    """Mask the local part only, so that grouping by mail domain still works."""
    text = as_col(value)
    at = F.instr(text, "@")
    local = F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(text)
    domain = F.when(at > 0, F.substring(text, at, F.length(text))).otherwise(F.lit(""))
    return F.concat(mask_partial(local, keep), domain)


def row_checksum(*columns: ColumnOrName) -> Column:
    """Order-independent aggregate over whole rows: sum of the 64-bit row hashes, so copies count."""
    return F.sum(F.xxhash64(*[as_col(c) for c in columns]).cast("decimal(38,0)"))
