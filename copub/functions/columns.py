"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes stored in the cosine column when a year of the period has no
# collaborator (fixed values of the reported table).
NEITHER_YEAR = 99.0
ONLY_SECOND_YEAR = 98.0
ONLY_FIRST_YEAR = 97.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_id(c: Column | str) -> Column:
    """Id text or number -> bigint; malformed values become NULL."""
    return _col(c).try_cast("bigint")


def year_from_text(c: Column | str) -> Column:
    """Year = first four characters of the value, as int ('2019-03-01' -> 2019)."""
    return F.substring(_col(c).cast("string"), 1, 4).try_cast("int")


def author_ids(authors: Column | str) -> Column:
    """array<struct<id, ...>> -> sorted distinct bigint ids, NULL ids dropped.

    Built from code-generated array functions only (field extraction,
    element-wise ``try_cast``, ``array_except``, ``sort_array``): no lambda.
    """
    ids = _col(authors)["id"].try_cast("array<bigint>")
    return F.sort_array(F.array_except(ids, F.array(F.lit(None).cast("bigint"))))


def ratio(num: Column, den: Column) -> Column:
    """num / den as double; NULL when den is 0 (ANSI-safe)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def cosine_or_sentinel(
    s1: Column, s2: Column, dot: Column, sq1: Column, sq2: Column, measure: str = "similarity"
) -> Column:
    """Cosine of the two years' collaborator vectors, or a code.

    ``s1``/``s2`` are the vector sums (0 = the year has no collaborator),
    ``dot`` the dot product and ``sq1``/``sq2`` the squared norms.  NULL sums
    mean the author has no collaborator at all.  ``measure='distance'`` stores
    ``1 - cosine`` when both years are present; the codes are unchanged.
    """
    if measure not in ("similarity", "distance"):
        raise ValueError("measure must be 'similarity' or 'distance'")
    # one root, so equal vectors give exactly 1; rounding may not lift the rest above it
    cos = F.least(F.lit(1.0), dot.cast("double") / F.sqrt(sq1.cast("double") * sq2.cast("double")))
    if measure == "distance":
        cos = F.lit(1.0) - cos
    s1 = F.coalesce(s1, F.lit(0))
    s2 = F.coalesce(s2, F.lit(0))
    return (
        F.when((s1 == 0) & (s2 == 0), F.lit(NEITHER_YEAR))
        .when(s1 == 0, F.lit(ONLY_SECOND_YEAR))
        .when(s2 == 0, F.lit(ONLY_FIRST_YEAR))
        .otherwise(cos)
    )
