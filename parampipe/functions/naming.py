"""Names of cases, files, parts and tables, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parameters that name a part before any other, in this order.
SUFFIX_KEYS = ("clsYymm", "baseYymm")

# File endings removed to get a file's name.
CSV_ENDINGS = r"\.csv(\.gz)?$"

PART_SEPARATOR = "__"
_TRAILING_DIGITS = r"(?U)_(\d+)$"


def safe_label(value: Column) -> Column:
    """Only word characters (any script) and hyphens."""
    return F.regexp_replace(value, r"(?U)[^\w\-]", "")


def case_suffix(params: Column, keys: Column | None = None) -> Column:
    """``_<value>`` of the parameter that names the part, or empty text.

    `params` is a map; `keys` (default: all its keys) are the parameters used.
    """
    used = F.map_keys(params) if keys is None else keys
    key = F.array_min(used)
    for name in reversed(SUFFIX_KEYS):
        key = F.when(F.array_contains(used, name), F.lit(name)).otherwise(key)
    value = F.try_element_at(params, key)
    return F.coalesce(F.concat(F.lit("_"), safe_label(value)), F.lit(""))


def split_suffix(name: Column) -> Column:
    """Struct (base, suffix) of ``name_<digits>``; base in upper case."""
    digits = F.regexp_extract(name, _TRAILING_DIGITS, 1)
    suffix = F.when(digits != "", F.concat(F.lit("_"), digits)).otherwise("")
    stem = F.regexp_replace(name, r"(?<=[^/])\.[^./]+$", "")
    base = F.when(digits != "", F.regexp_replace(name, _TRAILING_DIGITS, "")).otherwise(stem)
    return F.struct(F.upper(base).alias("base"), suffix.alias("suffix"))


def _sorted_pairs(params: Column, pair) -> Column:
    return F.transform(
        F.array_sort(F.map_keys(params)), lambda k: pair(k, F.element_at(params, k))
    )


def case_label(template: Column, host: Column, params: Column) -> Column:
    """``template__host__key_value...``; no host part when host is empty."""
    pairs = _sorted_pairs(
        params, lambda k, v: F.concat(k, F.lit("_"), F.replace(v, F.lit(" "), F.lit("_")))
    )
    host_part = F.when(F.coalesce(host, F.lit("")) != "", F.array(host)).otherwise(
        F.array().cast("array<string>")
    )
    return F.array_join(F.concat(F.array(template), host_part, pairs), PART_SEPARATOR)


def describe_case(params: Column) -> Column:
    """``k=v, k=v`` in key order, or ``-`` for a case without parameters."""
    text = F.array_join(_sorted_pairs(params, lambda k, v: F.concat(k, F.lit("="), v)), ", ")
    return F.when(text == "", "-").otherwise(text)


def template_of_file(file_name: Column) -> Column:
    """Template name in an extract's file name: the text before the first ``__``."""
    return F.substring_index(F.regexp_replace(file_name, CSV_ENDINGS, ""), PART_SEPARATOR, 1)


def table_of_template(text: Column, stem: Column) -> Column:
    """Table named by ``--[table]`` on the first non-empty line, else the file stem."""
    hint = F.regexp_extract(text, r"^\s*--\[([^\n]+)\][ \t\r]*(?:\n|$)", 1)
    return F.coalesce(F.nullif(F.trim(hint), F.lit("")), stem)
