"""Report date normalisation as one column expression (no Python per row).

A date field of a JSON document may hold epoch seconds (integer or
fraction), text in one of five layouts, or junk.  Falsy values (NULL, JSON
null, 0, "", false, empty containers) give NULL, as does text that matches
no layout.  Epoch seconds are read in UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text layouts, tried in this order (Python strptime
# layouts %Y-%m-%d, %d/%m/%Y, %Y/%m/%d, %Y-%m-%dT%H:%M:%S.%f, %Y-%m-%dT%H:%M:%S
# written as Spark datetime patterns; single-digit fields are accepted).
DATE_PATTERNS = (
    "yyyy-M-d",
    "d/M/yyyy",
    "yyyy/M/d",
    "yyyy-M-d'T'H:m:s.SSSSSS",
    "yyyy-M-d'T'H:m:s",
)

_NUMBER_KINDS = ("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE")
# epoch seconds beyond year 9999 cannot be a timestamp
_MAX_EPOCH = 253402300799



def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


# Digit-shape guard of each layout: a layout is only tried on text of its
# shape, so a parse attempt that is bound to fail (and to throw inside the
# parser) is skipped.  Each guard admits everything its layout can parse.
_D = "[0-9]+"
LAYOUT_GUARDS = (
    rf"^{_D}-{_D}-{_D}$",
    rf"^{_D}/{_D}/{_D}$",
    rf"^{_D}/{_D}/{_D}$",
    rf"^{_D}-{_D}-{_D}T{_D}:{_D}:{_D}\.{_D}$",
    rf"^{_D}-{_D}-{_D}T{_D}:{_D}:{_D}$",
)


def parse_date_text(text: Column) -> Column:
    """Text → ``timestamp_ntz`` using the first layout that parses the whole text."""
    s = F.regexp_replace(text, r"^\s+|\s+$", "")
    tried = [F.when(s.rlike(guard), F.try_to_timestamp(s, F.lit(p)))
             for p, guard in zip(DATE_PATTERNS, LAYOUT_GUARDS)]
    return F.coalesce(*tried).cast("timestamp_ntz")


def epoch_seconds(secs: Column) -> Column:
    """Epoch seconds (decimal) → UTC ``timestamp_ntz``, no session zone involved."""
    return F.when(F.abs(secs) <= _MAX_EPOCH, _epoch() + F.make_dt_interval(secs=secs.cast("decimal(18,6)")))


def normalize_date(v: Column) -> Column:
    """Variant date field → ``timestamp_ntz`` (see module doc).

    Kind and text are read where every row needs them: Spark evaluates an
    expression once for each row only if no branch decides whether it is
    needed; in a branch for texts each layout would read the text again.
    """
    kind = F.schema_of_variant(v)
    is_number = kind.isin(*_NUMBER_KINDS) | kind.startswith("DECIMAL")
    text = F.try_variant_get(v, "$", "string")
    # from the text: a variant's own cast to a decimal is set up anew for each row
    secs = text.try_cast("decimal(38,6)")
    # the kinds exclude each other; NULL and JSON null have none of them
    return F.coalesce(
        parse_date_text(F.when(kind == "STRING", text)),
        F.when(is_number, F.when(secs != 0, epoch_seconds(secs))),
        # a JSON true is the integer 1 to Python
        F.when((kind == "BOOLEAN") & (text == "true"), epoch_seconds(F.lit(1))))
