"""Range checks and reject reasons for bronze events (column expressions).

All checks are NULL-safe: a missing or unparseable field fails its check.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicflow.functions.common import idiv, to_double

# Reject reason texts and the log-line layout, which must equal
# the reference's output.
REASON_LATITUDE = "latitude invalide"
REASON_LONGITUDE = "longitude invalide"
REASON_VALUE = "valeur invalide"
REASON_SEPARATOR = ", "
# our addition for timestamp text that does not parse (the reference fails the run)
REASON_TIMESTAMP = "timestamp invalide"
# our addition for rows without an id, which no keyed table could hold
REASON_ID = "id manquant"
# Fixed value: share of bad rows above which a run is flagged
ERROR_RATE_THRESHOLD = 0.05


def in_range(c: Column, low: float, high: float) -> Column:
    """Inclusive range test; NULL and NaN fail."""
    v = to_double(c)
    return F.coalesce(v.between(F.lit(low), F.lit(high)) & ~F.isnan(v), F.lit(False))


def latitude_ok(c: Column) -> Column:
    return in_range(c, -90.0, 90.0)


def longitude_ok(c: Column) -> Column:
    return in_range(c, -180.0, 180.0)


def value_ok(c: Column) -> Column:
    """Numeric and >= 0 (0 and +inf pass; text, NULL, negatives, NaN fail).

    Spark orders NaN above every number, so NaN >= 0 is true: test it apart.
    """
    v = to_double(c)
    return F.coalesce((v >= 0) & ~F.isnan(v), F.lit(False))


def timestamp_ok(text: Column, parsed: Column) -> Column:
    """A timestamp is bad only when text is present but does not parse."""
    return text.isNull() | parsed.isNotNull()


def reasons(lat_ok: Column, lon_ok: Column, val_ok: Column, ts_ok: Column | None = None,
            id_ok: Column | None = None) -> Column:
    """array<string> of failed checks, in the reference order."""
    items = [
        F.when(~lat_ok, F.lit(REASON_LATITUDE)),
        F.when(~lon_ok, F.lit(REASON_LONGITUDE)),
        F.when(~val_ok, F.lit(REASON_VALUE)),
    ]
    if ts_ok is not None:
        items.append(F.when(~ts_ok, F.lit(REASON_TIMESTAMP)))
    if id_ok is not None:
        items.append(F.when(~id_ok, F.lit(REASON_ID)))
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def reason_text(reason_array: Column) -> Column:
    return F.array_join(reason_array, REASON_SEPARATOR)


def reject_message(run_id: Column, row_id: Column, reason_str: Column) -> Column:
    """``Run:<run> | ID:<id> | Rejet: <reasons>``."""
    return F.concat(F.lit("Run:"), run_id, F.lit(" | ID:"), F.coalesce(row_id, F.lit("N/A")),
                    F.lit(" | Rejet: "), reason_str)


def error_pct_text(bad: Column, total: Column) -> Column:
    """bad/total as a percent text with two decimals, e.g. ``8.21%``.

    Rounded half-up in integer arithmetic so the text never depends on how a
    double is printed.
    """
    bp = idiv(bad.cast("long") * 20000 + total, total * 2)
    return F.when(total > 0, F.concat(
        idiv(bp, 100).cast("string"), F.lit("."), F.lpad(F.pmod(bp, F.lit(100)).cast("string"), 2, "0"),
        F.lit("%")))
