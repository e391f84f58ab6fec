"""Reproducible pseudo-random numbers that depend on the row key and a seed only.

Nothing here depends on how rows are laid out in partitions, so samples and splits are the same
for any cluster size and survive the loss of an executor.
"""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_hex(key: str | Sequence[str], seed: int | str) -> Column:
    """md5 of `key:seed` as 32 hex digits; the order of these strings is a random order of the rows."""
    keys = [key] if isinstance(key, str) else list(key)
    return F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def hash_int(hex_digits: Column) -> Column:
    """The first eight hex digits as an integer in [0, 2^32)."""
    return F.conv(F.substring(hex_digits, 1, 8), 16, 10).cast("long")


def hash_unit(hex_digits: Column) -> Column:
    """The first eight hex digits as a number in [0, 1)."""
    return hash_int(hex_digits) / F.lit(4294967296.0)


def hash_long(hex_digits: Column) -> Column:
    """The first fifteen hex digits as an integer in [0, 2^60), wide enough to pick among any number of rows."""
    return F.conv(F.substring(hex_digits, 1, 15), 16, 10).cast("long")
