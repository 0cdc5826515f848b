"""Column helpers. All are built-in expressions, so plans stay on the JVM side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def asc_last(c: str | Column) -> Column:
    return _col(c).asc_nulls_last()


def desc_last(c: str | Column) -> Column:
    return _col(c).desc_nulls_last()


def year_span(lo: str | Column, hi: str | Column) -> Column:
    """``(1914-1935)``; null when either end is."""
    return F.concat(F.lit("("), _col(lo).cast("string"), F.lit("-"), _col(hi).cast("string"), F.lit(")"))


def ratio(a: str | Column, b: str | Column) -> Column:
    """Double division; a zero denominator gives null instead of an error."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))


def rounded_mean(total: str | Column, n: str | Column) -> Column:
    """Mean rounded half up to a whole number, from an exact sum and count."""
    return F.round(ratio(total, n)).cast("long")


def rounded_units(x: str | Column, unit: int = 1) -> Column:
    """``x`` in whole units: 100 turns cents into whole dollars."""
    return F.round(_col(x) / F.lit(unit)).cast("long")


def remap(c: str | Column, mapping: Mapping[str, str]) -> Column:
    """Replace known values, keep the rest."""
    if not mapping:
        return _col(c)
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[_col(c)], _col(c))


def first_item(c: str | Column, sep: str = ",") -> Column:
    return F.trim(F.split_part(_col(c), F.lit(sep), F.lit(1)))


def list_position(c: str | Column, values: Sequence[str]) -> Column:
    """Sort key that follows ``values``; anything else comes last."""
    at = F.array_position(F.array(*[F.lit(v) for v in values]), _col(c))
    return F.when(at > 0, at).otherwise(F.lit(len(values) + 1))


def first_seen(sightings: str | Column, field: str) -> Column:
    """Distinct ``field`` values of an array of structs, in the order the structs sort.

    ``array_distinct`` keeps the first copy, so putting the order fields first in the struct
    lists each value where it was first seen.
    """
    return F.array_distinct(F.transform(F.array_sort(_col(sightings)), lambda s: s[field]))


def joined(values: str | Column, sep: str = ",") -> Column:
    return F.array_join(_col(values), sep)


def padded(c: str | Column, width: int, align: str = "left") -> Column:
    """Pad to at least ``width``; longer text is kept whole (``lpad`` and ``rpad`` would cut it)."""
    text = F.coalesce(_col(c).cast("string"), F.lit(""))
    if width <= 0:
        return text
    return F.format_string(f"%{'' if align == 'right' else '-'}{width}s", text)
