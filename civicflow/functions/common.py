"""Small column helpers shared by the function modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def idiv(a: Column, b: Column | int) -> Column:
    """Floor division of integers, exact (no rounding through a double)."""
    b = F.lit(b) if isinstance(b, int) else b
    return ((a - F.pmod(a, b)) / b).cast("long")


# decimal text with an optional exponent, or infinity / NaN.  Type suffixes
# (5d, 6.1f), which a Java cast takes, are text.
_NUMBER = r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"


def to_double(c: Column) -> Column:
    """Text or number → double; anything that is no number → NULL."""
    # typeof folds to a constant: a numeric column is cast without the text test
    return F.when((F.typeof(c) != "string") | c.cast("string").rlike(_NUMBER), c.try_cast("double"))


def ntz(text: str) -> Column:
    """A ``timestamp_ntz`` literal from ``yyyy-MM-dd[ HH:mm:ss]`` text."""
    return F.lit(text).cast("timestamp_ntz")
