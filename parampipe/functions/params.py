"""Parameter values: single value, comma list, month range, period ends.

All rules are Column expressions, so a table of parameter specifications is
expanded where it lies.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: months are written as yyyyMM text.
MONTH_FORMAT = "yyyyMM"
MONTH_PATTERN = r"[0-9]{4}(0[1-9]|1[0-2])"

# Range option letter -> the month number divides evenly by it.
PERIOD_MONTHS = {"Q": 3, "H": 6, "Y": 12}

_RANGE = r"^(\d{6}):(\d{6})(?:~(.*))?$"


def month_key(column: Column | str) -> Column:
    """`yyyyMM` text of a date or timestamp column.

    Integer arithmetic instead of a formatter: stays inside generated code and
    does not depend on the session time zone for zone-less timestamps.
    """
    c = F.col(column) if isinstance(column, str) else column
    return F.lpad((F.year(c) * 100 + F.month(c)).cast("string"), 6, "0")


def month_start(month: Column) -> Column:
    """First day of a `yyyyMM` text; raises for text that is no month."""
    day = F.try_to_date(month, MONTH_FORMAT)
    return F.when(
        day.isNull() & month.isNotNull(),
        F.raise_error(F.concat(F.lit("not a yyyyMM month: "), month)).cast("date"),
    ).otherwise(day)


def month_sequence(first: Column, last: Column) -> Column:
    """All months from `first` to `last`, both included; none when reversed."""
    lo, hi = month_start(first), month_start(last)
    return F.when(lo > hi, F.array().cast("array<string>")).otherwise(
        F.transform(
            F.sequence(lo, hi, F.expr("interval 1 month")),
            lambda d: F.date_format(d, MONTH_FORMAT),
        )
    )


def period_ends(months: Column, option: Column) -> Column:
    """Keep quarter (Q), half-year (H) or year (Y) ends; other options keep all."""
    step = F.lit(1)
    for letter, every in PERIOD_MONTHS.items():
        step = F.when(F.upper(F.trim(option)) == letter, F.lit(every)).otherwise(step)
    return F.filter(months, lambda m: F.substring(m, 5, 2).cast("int") % step == 0)


def split_list(spec: Column) -> Column:
    """Items of a comma list, trimmed, empty items dropped."""
    return F.filter(
        F.transform(F.split(spec, ","), lambda item: F.trim(item)), lambda item: item != ""
    )


def expand_spec(spec: Column | str) -> Column:
    """Array of values of one parameter specification.

    ``202401:202403`` gives every month, ``202401:202412~Q`` the quarter ends,
    ``a, b`` the items, anything else itself. A reversed plain range raises; a
    reversed range with an option is empty.
    """
    text = F.trim(F.col(spec) if isinstance(spec, str) else spec)
    first = F.regexp_extract(text, _RANGE, 1)
    last = F.regexp_extract(text, _RANGE, 2)
    has_option = text.contains("~")
    months = month_sequence(first, last)
    return (
        F.when(
            text.rlike(_RANGE) & ~has_option & (first > last),
            F.raise_error(F.concat(F.lit("reversed month range: "), text)).cast("array<string>"),
        )
        .when(
            text.rlike(_RANGE),
            F.when(has_option, period_ends(months, F.regexp_extract(text, _RANGE, 3))).otherwise(
                months
            ),
        )
        .when(text.contains(","), split_list(text))
        .otherwise(F.array(text))
    )


def parse_overrides(pairs: Column) -> Column:
    """Map from an array of ``key=value`` texts; the first ``=`` splits."""
    checked = F.transform(
        pairs,
        lambda p: F.when(
            p.contains("="),
            F.struct(
                F.trim(F.substring_index(p, "=", 1)).alias("key"),
                F.trim(F.regexp_replace(p, r"(?s)^[^=]*=", "")).alias("value"),
            ),
        ).otherwise(
            F.raise_error(F.concat(F.lit("not key=value: "), p)).cast(
                "struct<key:string,value:string>"
            )
        ),
    )
    return _entries_to_map(checked)


def override_params(base: Column, overrides: Column) -> Column:
    """`base` with the entries of `overrides` replacing or extending it."""
    kept = F.map_filter(base, lambda k, _v: ~F.array_contains(F.map_keys(overrides), k))
    return F.map_concat(kept, overrides)


def _entries_to_map(entries: Column) -> Column:
    # a key given twice keeps its last value, whatever the session's
    # duplicate-key policy is
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    last = F.transform(
        keys, lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"]
    )
    return F.map_from_arrays(keys, last)
