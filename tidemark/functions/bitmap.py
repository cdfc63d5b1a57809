"""Bitmap offsets for unique-visitor counting.

The offset of a user id is a polynomial hash of its decimal text, ``h = h * seed + char`` over the
characters, kept to the low bits of a bitmap of ``2^bits`` positions. Masking after every step gives the
same low bits as 64-bit wrap-around followed by one mask, and never overflows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hash seed and bitmap size (2^29 bits, 64 MB) of the unique-visitor bitmap.
SEED = 61
BITS = 29


def offset(user_id: str | Column, seed: int = SEED, bits: int = BITS) -> Column:
    uid = F.col(user_id) if isinstance(user_id, str) else user_id
    mask = (1 << bits) - 1
    chars = F.split(uid.cast("string"), "")
    return F.aggregate(chars, F.lit(0).cast("long"),
                       lambda acc, c: (acc * seed + F.ascii(c)).bitwiseAND(F.lit(mask).cast("long")))
