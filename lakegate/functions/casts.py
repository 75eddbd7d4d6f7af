"""Lenient text-to-number casts that behave the same with ANSI mode on or off.

The curated table is defined by the *non-ANSI* cast: a fraction is cut off
(``'2024.7'`` -> 2024), a bare fraction is zero (``'.5'`` -> 0) and anything
else that is not a number is NULL. ``cast`` raises on such text under ANSI and
``try_cast`` returns NULL for fractions, so neither is enough alone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters a Spark string-to-integer cast trims on both ends.
_PAD = r"[\x00-\x20\x7f]*"
_WHOLE_PART = rf"^{_PAD}([+-]?[0-9]+)\.[0-9]*{_PAD}\z"
_BARE_FRACTION = rf"^{_PAD}[+-]?\.[0-9]*{_PAD}\z"


def _lenient_integral(text: Column, type_name: str) -> Column:
    # Plain integers take the first branch and never reach a regular expression.
    return F.coalesce(
        text.try_cast(type_name),
        F.when(text.rlike(_BARE_FRACTION), F.lit(0).cast(type_name)).otherwise(
            F.regexp_extract(text, _WHOLE_PART, 1).try_cast(type_name)
        ),
    )


def lenient_int(text: Column) -> Column:
    return _lenient_integral(text, "int")


def lenient_long(text: Column) -> Column:
    return _lenient_integral(text, "bigint")


def lenient_double(text: Column) -> Column:
    return text.try_cast("double")
