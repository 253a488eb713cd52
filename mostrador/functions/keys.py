"""Customer identifiers in one canonical spelling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_uuid(c: Column) -> Column:
    """Lower-case hyphenated UUID from any accepted spelling, NULL if it is none.

    Accepted: any letter case, missing hyphens, surrounding braces, ``urn:`` and ``uuid:``.
    """
    bare = F.replace(F.replace(F.trim(c), F.lit("urn:"), F.lit("")), F.lit("uuid:"), F.lit(""))
    digits = F.lower(F.replace(F.btrim(bare, F.lit("{}")), F.lit("-"), F.lit("")))
    cut = [F.substring(digits, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(digits.rlike("^[0-9a-f]{32}$"), F.concat_ws("-", *cut))
