"""Date texts in templates: format models, and the ranges of time that a text stands for.

A model made of falling units (year, month, day, ...) is monotone: a later time never has
a smaller text. So a test of such a text is a test of the column against the start or
the end of the period the text names, which a scan can use.
"""

from __future__ import annotations

import datetime as dt
import re

# Units of a format model from large to small, in the template's spelling,
# in Spark's and in Python's.
MODEL_UNITS = (
    ("YYYY", "yyyy", "%Y"),
    ("MM", "MM", "%m"),
    ("DD", "dd", "%d"),
    ("HH24", "HH", "%H"),
    ("MI", "mm", "%M"),
    ("SS", "ss", "%S"),
)
# Units of TRUNC, as the number of model units that are kept.
TRUNC_UNITS = {"YYYY": 1, "YEAR": 1, "YY": 1, "MM": 2, "MONTH": 2, "MON": 2, "DD": 3, "DDD": 3, "DAY": 3}

_TOKEN = re.compile(r"YYYY|MM|DD|HH24|MI|SS|[-/.:_ ]", re.IGNORECASE)
_COLUMN = r"([\w.\"`]+)"
_NAME = r"[A-Za-z_][A-Za-z0-9_]*"
_TEXT = rf"TO_CHAR\s*\(\s*{_COLUMN}\s*,\s*'([^']*)'\s*\)"
_TEST = re.compile(rf"{_TEXT}\s*(>=|<=|=|<|>)\s*:({_NAME})\b", re.IGNORECASE)
_BETWEEN = re.compile(rf"{_TEXT}\s+BETWEEN\s+:({_NAME})\s+AND\s+:({_NAME})\b", re.IGNORECASE)
_ANY_TEXT = re.compile(_TEXT, re.IGNORECASE)
_YEAR = re.compile(
    rf"(?:EXTRACT\s*\(\s*YEAR\s+FROM\s+{_COLUMN}\s*\)|\bYEAR\s*\(\s*{_COLUMN}\s*\))"
    rf"(?=\s*(?:>=|<=|=|<|>)\s*:|\s+BETWEEN\s+:)",
    re.IGNORECASE,
)
_TRUNC = re.compile(
    rf"TRUNC\s*\(\s*{_COLUMN}\s*,\s*'(\w+)'\s*\)\s*(>=|<=|=|<|>)\s*"
    rf"TO_DATE\s*\(\s*:({_NAME})\s*,\s*'([^']*)'\s*\)",
    re.IGNORECASE,
)
_PARSE = re.compile(r"(\bTO_(?:DATE|TIMESTAMP)\s*\([^()']*,\s*')([^']*)('\s*\))", re.IGNORECASE)


def _tokens(model: str) -> list[str] | None:
    """Units and separators of a model, None where it holds anything else."""
    parts = _TOKEN.findall(model)
    return [p.upper() for p in parts] if "".join(parts) == model else None


def model_parts(model: str) -> list[str] | None:
    """Tokens of a monotone model, None for any other text."""
    parts = _tokens(model)
    units = [p for p in parts or () if p.isalnum()]
    return parts if units and units == [u[0] for u in MODEL_UNITS[: len(units)]] else None


def _spelled(model: str, way: int) -> str:
    names = {u[0]: u[way] for u in MODEL_UNITS}
    return "".join(names.get(p, p) for p in _tokens(model))


def spark_format(model: str) -> str:
    return _spelled(model, 1)


def unit_count(model: str) -> int:
    """Number of units a model has: 1 for years, 2 for months and so on."""
    return sum(p.isalnum() for p in model_parts(model))


def normalize(statement: str) -> str:
    """Year tests and truncated dates as tests of date texts, format models of TO_DATE in Spark's spelling."""

    def truncated(hit: re.Match) -> str:
        column, unit, sign, name, model = hit.groups()
        kept = TRUNC_UNITS.get(unit.upper())
        if kept and model_parts(model) and unit_count(model) == kept:
            return f"TO_CHAR({column}, '{model}') {sign} :{name}"
        return hit.group()

    text = _TRUNC.sub(truncated, statement)
    text = _YEAR.sub(lambda m: f"TO_CHAR({m.group(1) or m.group(2)}, 'YYYY')", text)

    def parsed(hit: re.Match) -> str:
        model = hit.group(2)
        if model_parts(model) and model == model.upper():
            model = spark_format(model)
        return hit.group(1) + model + hit.group(3)

    return _PARSE.sub(parsed, text)


def tests(statement: str) -> list[tuple[str, str, str, str]]:
    """(column, model, sign, parameter) of every test of a date text."""
    return [t for t in _TEST.findall(statement) if model_parts(t[1])]


def ranges(statement: str) -> list[tuple[str, str, str, str]]:
    """(column, model, first, last) of every BETWEEN of a date text."""
    return [t for t in _BETWEEN.findall(statement) if model_parts(t[1])]


def without_ranges(statement: str) -> str:
    return _BETWEEN.sub(" ", statement)


def rewrite(statement: str, test, between) -> str:
    """Replace tests by `test(column, model, sign, name)`, BETWEEN by `between(column, model,
    first, last)`, and other date texts by Spark's form of them."""

    def change(use):
        return lambda m: use(*m.groups()) if model_parts(m.group(2)) else m.group()

    text = _BETWEEN.sub(change(between), statement)
    text = _TEST.sub(change(test), text)
    # a model that is not monotone is still a text
    return _ANY_TEXT.sub(lambda m: key_sql(*m.groups()) if _tokens(m.group(2)) else m.group(), text)


def key_sql(column: str, model: str) -> str:
    """The date text of a column; months by arithmetic, which needs no formatter."""
    if model.upper() == "YYYYMM":
        return f"lpad(cast(year({column}) * 100 + month({column}) as string), 6, '0')"
    return f"date_format({column}, '{spark_format(model)}')"


def period(value: str, model: str) -> tuple[dt.datetime, dt.datetime]:
    """Start of the period a text names, and start of the next; ValueError for any other text."""
    way = _spelled(model, 2)
    try:
        start = dt.datetime.strptime(value, way)
    except ValueError:
        start = None
    if start is None or start.strftime(way).rjust(len(value), "0") != value:
        month = " month" if model.upper() == "YYYYMM" else ""
        raise ValueError(f"not a {spark_format(model)}{month}: {value}")
    units = unit_count(model)
    if units == 1:
        return start, start.replace(year=start.year + 1)
    if units == 2:
        return start, (start + dt.timedelta(days=31)).replace(day=1)
    return start, start + dt.timedelta(**{("days", "hours", "minutes", "seconds")[units - 3]: 1})


def literal(moment: dt.datetime, model: str) -> str:
    """A SQL literal: a day where the model has no smaller unit, so that any column type compares."""
    if unit_count(model) <= 3:
        return f"DATE'{moment:%Y-%m-%d}'"
    return f"TIMESTAMP_NTZ'{moment:%Y-%m-%d %H:%M:%S}'"


def range_test(column: str, model: str, sign: str, first: str, last: str | None = None) -> str:
    """A test of a date text against known values as a test of the column."""
    start, _ = period(first, model)
    _, stop = period(last if last is not None else first, model)
    lo, hi = literal(start, model), literal(stop, model)
    return {
        "=": f"({column} >= {lo} AND {column} < {hi})",
        ">=": f"({column} >= {lo})",
        "<": f"({column} < {lo})",
        "<=": f"({column} < {hi})",
        ">": f"({column} >= {hi})",
    }[sign]
