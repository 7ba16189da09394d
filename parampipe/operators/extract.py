"""Parameterised extracts: one case, or every case in one pass over the data."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parampipe.functions import blocks as B
from parampipe.functions import date_texts as D
from parampipe.functions import templates as T
from parampipe.functions.params import month_key, month_start
from parampipe.operators.cases import case_table
from parampipe.session import is_small, materialize

# A case list up to this many rows is sent to every executor.
BROADCAST_CASES = 100_000
# More cases, or more tables named by them, are refused: an error, never a cut.
MOST_CASES = 10_000_000
MOST_TABLES = 1_000


def extract(spark: SparkSession, template: str, params: dict[str, str]) -> DataFrame:
    """Run a template for one case; values travel as typed parameter markers.

    Comparisons of date texts (``TO_CHAR`` with a model of falling units, ``EXTRACT(YEAR)``,
    ``TRUNC``) with a parameter become ranges on the column, so the scan skips row groups
    outside the period.
    """
    statement = D.normalize(T.to_markers(template))
    names = T.marker_names(statement)
    missing = [n for n in names if n not in params]
    if missing:
        raise ValueError(f"missing params {missing}")
    values = {n: str(params[n]) for n in names}
    text = D.rewrite(
        statement,
        lambda column, model, sign, name: D.range_test(column, model, sign, values[name]),
        lambda column, model, first, last: D.range_test(column, model, "=", values[first], values[last]),
    )
    return spark.sql(text, args={n: values[n] for n in T.marker_names(text)})


def extract_cases(
    spark: SparkSession,
    template: str,
    params: dict[str, str],
    mode: str = "product",
    cases: DataFrame | None = None,
    scan_per_case: bool = False,
) -> DataFrame:
    """Run a template for all cases at once; the case columns come first.

    The template becomes a lateral subquery of the case table. Spark turns the
    equality with a parameter into an equi-join with the case table, and one range
    over all wanted months reaches the scan, so the fact table is read once however
    many cases there are. A month range (BETWEEN) meets the months of its case.

    Parameters inside subqueries are carried along as keys (`_lifted`), WITH tables are
    read where they are used.

    A template that cannot be joined that way (no parameter in an equality, OR, or
    another test in an aggregate) raises, unless `scan_per_case` asks for one scan for
    every case. Parameters in table names make one statement for
    each table.
    """
    statement = B.inline_tables(D.normalize(T.to_markers(template)))
    names = T.marker_names(statement)
    if not names:
        return spark.sql(D.rewrite(statement, lambda *_: "", lambda *_: ""))
    if cases is None:
        cases = case_table(spark, params, names, mode)
    cases = cases.select(*names).distinct()
    if not is_small(cases, BROADCAST_CASES):
        if not is_small(cases, MOST_CASES):
            raise ValueError(f"more than {MOST_CASES} cases")
        # written, so that the planner knows its size and broadcasts it only if it may
        cases = materialize(cases, "cases")

    if T.table_names(statement):
        return _union_over_tables(spark, statement, cases, names, scan_per_case)
    try:
        lifted = _lifted(spark, statement, cases)
        loose, apart = T.unequal_markers(lifted.plain), T.keeps_rows_apart(lifted.plain)
        if not apart:
            loose = sorted({*loose, *[n for _c, _m, *pair in D.ranges(lifted.plain) for n in pair]})
        # where rows stay apart, one equality joins and other tests filter what it joins
        wide = [n for _c, model, *pair in D.ranges(lifted.plain) if model.upper() != "YYYYMM" for n in pair]
        joined = lifted.joined or set(T.marker_names(lifted.plain)) - {*loose, *wide}
        if not joined and apart:
            lifted = joined = _interval_keys(spark, lifted, names)
        if joined and (apart or not loose):
            try:
                return _joined_cases(spark, lifted, names)
            except AnalysisException as error:
                if not lifted.own_cases:
                    raise
                raise ValueError(f"{error.getCondition()}: ask for scan_per_case") from error
        raise ValueError(f"no equality for params {loose or names}: ask for scan_per_case")
    except ValueError:
        if not scan_per_case:
            raise
    return _union_of_cases(spark, template, cases, names)


@dataclass
class _Lifted:
    """A statement without parameters below its own tables, and what stands for them.

    `cases` has further columns: the values of scalar blocks. `joined` tells that a key
    of the cases is equal to a column; `own_cases` that the statement reads the case
    table itself, for blocks that depend on its rows.
    """

    statement: str
    cases: DataFrame
    joined: bool = False
    own_cases: bool = False
    # the statement as it is checked: blocks that depend on its rows are mere conditions
    plain: str = ""
    views: tuple[str, ...] = ()


def _lifted(spark: SparkSession, statement: str, cases: DataFrame) -> _Lifted:
    """Parameters of nested blocks as keys: every block is worked out for all cases at once.

    An IN block that must hold becomes a table of its different (case, value) rows, joined
    to the block around it. A scalar block becomes a value, and EXISTS a flag, of the case.
    A block that reads the tables around it stays, and its parameters are those of a case
    table among them; that needs an equality around it. The rest raises.
    """
    found = B.nested_blocks(statement)
    out = _Lifted(statement, cases)
    edits, plain, views = B.Edits(statement), B.Edits(statement), []
    for i, block in enumerate(found):
        text = statement[block.start : block.end]
        names = T.marker_names(text)
        try:
            rows = extract_cases(spark, text, {}, cases=cases.select(*names).distinct())
        except AnalysisException as error:
            if not (error.getCondition() or "").startswith(("UNRESOLVED_COLUMN", "MISSING_ATTRIBUTES")):
                raise
            if block.around != (0, len(statement)):
                raise ValueError(f"params {names} in a block within a derived table") from error
            out.own_cases = True
            for name in names:
                text = T.replace_marker(text, name, f"case_row.{_HIDDEN}{name}")
            edits.replace(block.start, block.end, text)
            word = _WORD_BEFORE.search(statement, 0, statement.rindex("(", 0, block.start))
            plain.replace(word.start() if word else block.start - 1, block.end + 1, "true")
            continue
        *keys, value = rows.columns if len(rows.columns) == len(names) + 1 else [*names, None]
        if block.kind == B.EXISTS:
            flags = rows.select(*names).distinct().withColumn(f"value_{i}", F.lit(True))
            out.cases = out.cases.join(flags, names, "left").withColumn(f"value_{i}", F.coalesce(f"value_{i}", F.lit(False)))
            opened = statement.rindex("(", 0, block.start)
            word = _WORD_BEFORE.search(statement, 0, opened)
            holds = "false" if word.group(1) else "true"
            edits.replace(word.start(), block.end + 1, f"case_row.{_HIDDEN}value_{i} = {holds}")
        elif value is None:
            raise ValueError(f"params {names} in a block of several columns")
        elif block.kind == B.IN:
            if not B.must_hold(statement, block):
                raise ValueError(f"params {names} in an IN that need not hold")
            view = f"case_keys_{uuid.uuid4().hex}"
            # different rows only, so that a join with them repeats nothing
            different = rows.toDF(*[f"{_HIDDEN}{k}" for k in keys], f"{_HIDDEN}value").distinct()
            different.select(*[F.col(c).alias(f"{c}_{i}") for c in different.columns]).createOrReplaceTempView(view)
            views.append(view)
            test = " AND ".join(f"keys_{i}.{_HIDDEN}{k}_{i} = case_row.{_HIDDEN}{k}" for k in keys)
            edits.add(block.around, f"{view} keys_{i}", test)
            opened = statement.rindex("(", 0, block.start)
            word = _WORD_BEFORE.search(statement, 0, opened)
            edits.replace(word.start(), block.end + 1, f"= keys_{i}.{_HIDDEN}value_{i}")
            out.joined = True
        else:
            one = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.first(value).alias("v"))
            several = F.raise_error(F.lit("a scalar subquery of a case has more than one row"))
            one = one.select(*keys, F.when(F.col("n") > 1, several.cast(rows.schema[-1].dataType)).otherwise(F.col("v")).alias(f"value_{i}"))
            out.cases = out.cases.join(one, keys, "left")
            opened = statement.rindex("(", 0, block.start)
            edits.replace(opened, block.end + 1, f"case_row.{_HIDDEN}value_{i}")
    plain.spans += [s for s in edits.spans if not any(p[0] <= s[0] and s[1] <= p[1] for p in plain.spans)]
    out.statement, out.plain, out.views = edits.applied(), plain.applied(), tuple(views)
    return out


# Cells that the values of a range column are dealt into, as a power of two.
CELL_BITS = 12
_PARSED = r"(?:TO_DATE|TO_TIMESTAMP|DATE|TIMESTAMP)\s*\(\s*:\w+\s*(?:,\s*'[^']*'\s*)?\)"
_VALUE = (
    rf"(?:(?:ADD_MONTHS|DATE_ADD)\s*\(\s*{_PARSED}\s*,\s*\d+\s*\)|{_PARSED}"
    r"|CAST\s*\(\s*:\w+\s+AS\s+\w+(?:\s*\([\d,\s]*\))?\s*\)|:\w+)(?!\s*[-+*/|%])"
)
# a whole side of a comparison: nothing in front of it but the start of a condition
_STARTS = r"(?:\bWHERE|\bAND|\()\s*"
_BOUND = re.compile(rf"{_STARTS}([A-Za-z_`][\w.`]*)\s*(>=|<=|<|>)\s*({_VALUE})", re.IGNORECASE)
_BOUND_TURNED = re.compile(
    rf"{_STARTS}({_VALUE})\s*(>=|<=|<|>)\s*([A-Za-z_`][\w.`]*)(?![\w.`])(?!\s*[-+*/|%(])", re.IGNORECASE
)
_BOUND_BETWEEN = re.compile(
    rf"{_STARTS}([A-Za-z_`][\w.`]*)\s+BETWEEN\s+({_VALUE})\s+AND\s+({_VALUE})", re.IGNORECASE
)


def _column_bounds(statement: str) -> dict[str, tuple[list[str], list[str]]]:
    """Lower and upper bounds, as SQL over markers, of every column that must keep to them."""
    found: dict[str, tuple[list[str], list[str]]] = {}

    def note(column: str, sign: str, value: str) -> None:
        found.setdefault(column.lower(), ([], []))[sign[0] == "<"].append(value)

    for column, sign, value in _BOUND.findall(statement):
        note(column, sign, value)
    for value, sign, column in _BOUND_TURNED.findall(statement):
        note(column, "<" if sign[0] == ">" else ">", value)
    for column, low, high in _BOUND_BETWEEN.findall(statement):
        note(column, ">", low)
        note(column, "<", high)
    return found


def _interval_keys(spark: SparkSession, lifted: _Lifted, names: list[str]) -> _Lifted | None:
    """Ranges as an equality: the case's interval cut into dyadic cells, each row in one cell of every size.

    The column that most parameters bound is dealt into 2 ** `CELL_BITS` cells between the
    least and the greatest bound, what lies outside into the first or last. An interval is
    the union of two cells of every size at most, no two overlapping; a row meets it in
    exactly one of them, so the join repeats nothing, and the tests of the template stay.
    Rows are repeated once for every size that some case uses. None where no column of a
    single table expression is bounded.
    """
    if lifted.own_cases or T.has_choices(lifted.plain):
        return None
    statement = D.rewrite(lifted.statement, _as_column_test, _as_column_range)
    bounds = _column_bounds(statement)
    if not bounds:
        return None
    column = max(bounds, key=lambda c: (len(bounds[c][0]) > 0) + (len(bounds[c][1]) > 0))
    around = (0, len(statement))
    at = B.clauses(statement, around)
    tables = statement[at.after_from : at.after_tables]
    if T.marker_names(tables):
        return None
    kind = spark.sql(f"SELECT {column} AS c FROM {tables} LIMIT 0").schema["c"].dataType.simpleString()
    if kind in ("date", "timestamp", "timestamp_ntz"):
        # whole days: a day is never later than another moment of a later day
        number = "cast(datediff(cast({} as date), DATE'1970-01-01') as double)"
    elif kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        number = "cast({} as double)"
    else:
        return None

    def of_case(value: str) -> Column:
        text = value
        for name in T.marker_names(value):
            text = T.replace_marker(text, name, f"`{name}`")
        return F.expr(number.format(text))

    lows, highs = bounds[column]
    cases, ends = lifted.cases, []
    for side, values, pick in (("_low", lows, F.greatest), ("_high", highs, F.least)):
        known = [of_case(v) for v in values]
        if known:
            cases = cases.withColumn(side, known[0] if len(known) == 1 else pick(*known))
            # a null bound is met by no row
            cases, ends = cases.where(F.col(side).isNotNull()), [*ends, side]
    lo, hi = cases.agg(F.min(F.least(*ends) if len(ends) > 1 else ends[0]), F.max(F.greatest(*ends) if len(ends) > 1 else ends[0])).first()
    lo, hi = (0.0, 1.0) if lo is None else (float(lo), float(hi))
    last = (1 << CELL_BITS) - 1
    width = max((hi - lo) / last, 2.0**-30)

    def cell(value: str) -> str:
        return f"cast(greatest(0.0D, least({float(last)}D, floor(({value} - {lo!r}D) / {width!r}D))) as int)"

    first = F.expr(cell("_low")) if lows else F.lit(0)
    final = F.expr(cell("_high")) if highs else F.lit(last)
    cases = cases.withColumn("_first", first).withColumn("_last", final).where("_first <= _last")
    sizes = cases.withColumn("cell_size", F.explode(F.sequence(F.lit(0), F.lit(CELL_BITS))))
    step = "shiftleft(1, cell_size)"
    ends_of = f"array(_first + {step} - 1 - pmod(_first + {step} - 1, {step}), _last + 1 - pmod(_last + 1, {step}) - {step})"
    cells = sizes.withColumn("cell", F.explode(F.array_distinct(F.expr(f"transform({ends_of}, x -> x div {step})"))))
    inside = f"cell * {step} >= _first and (cell + 1) * {step} - 1 <= _last"
    above = f"(cell div 2) * {step} * 2 >= _first and (cell div 2 + 1) * {step} * 2 - 1 <= _last"
    cells = cells.where(f"({inside}) and (cell_size = {CELL_BITS} or not ({above}))")
    cells = cells.withColumn("cell", F.col("cell").cast("int")).drop("_low", "_high", "_first", "_last")
    cells = materialize(cells, "cells")
    used = sorted(r[0] for r in cells.select("cell_size").distinct().collect())
    test = [
        f"case_row.{_HIDDEN}cell_size = case_sizes.{_HIDDEN}size",
        f"case_row.{_HIDDEN}cell = shiftright({cell(number.format(column))}, case_sizes.{_HIDDEN}size)",
    ]
    edits = B.Edits(statement)
    listed = ", ".join(map(str, used)) if used else "cast(null as int)"
    edits.multiply(around, f"LATERAL VIEW explode(array({listed})) case_sizes AS {_HIDDEN}size", " AND ".join(test))
    return _Lifted(edits.applied(), cells, True, False, lifted.plain, lifted.views)


def _as_column_test(column: str, model: str, sign: str, name: str) -> str:
    """A one-sided test of a date text as a test of the column, for a parameter not known yet."""
    if sign == "=":
        return f"{D.key_sql(column, model)} = :{name}"
    exact = f"{D.key_sql(column, model)} {sign} :{name}"
    if D.unit_count(model) > 3:
        return f"({exact})"
    start = f"to_date(:{name}, '{D.spark_format(model)}')"
    if sign in (">=", "<"):
        return f"({column} {sign} {start})"
    end = f"date_add({start}, 1)" if D.unit_count(model) == 3 else f"add_months({start}, {(0, 12, 1)[D.unit_count(model)]})"
    return f"({column} {'>=' if sign == '>' else '<'} {end})"


def _as_column_range(column: str, model: str, first: str, last: str) -> str:
    return f"{_as_column_test(column, model, '>=', first)} AND {_as_column_test(column, model, '<=', last)}"


_WORD_BEFORE = re.compile(r"\b(NOT\s+)?(?:EXISTS|IN)\s*$", re.IGNORECASE)
# Columns of the case table inside a statement: never those of a template's own tables.
_HIDDEN = "_case_key_"


def _joined_cases(spark: SparkSession, lifted: _Lifted, names: list[str]) -> DataFrame:
    statement, cases = lifted.statement, lifted.cases
    wanted = {(model.upper(), name) for _c, model, sign, name in D.tests(statement) if sign == "="}
    wanted |= {(model.upper(), name) for _c, model, *pair in D.ranges(statement) for name in pair}
    bounds = _period_bounds(cases, wanted)
    parts = {}
    for i, (_column, model, first, last) in enumerate(D.ranges(statement)):
        if model.upper() == "YYYYMM":
            parts[first, last] = f"month_of_range_{i}"
            cases = cases.withColumn(parts[first, last], F.explode(_months(first, last)))
    view = f"case_table_{uuid.uuid4().hex}"
    hidden = {c: f"{_HIDDEN}{c}" for c in cases.columns}
    cases.withColumnsRenamed(hidden).createOrReplaceTempView(view)

    def same(column: str, model: str, key: str, first: str, last: str) -> str:
        if (model.upper(), first) not in bounds or (model.upper(), last) not in bounds:
            return "false"
        lo, hi = bounds[model.upper(), first][0], bounds[model.upper(), last][1]
        return (
            f"({D.key_sql(column, model)} = case_row.{_HIDDEN}{key} AND {column} >= {D.literal(lo, model)}"
            f" AND {column} < {D.literal(hi, model)})"
        )

    def test(column: str, model: str, sign: str, name: str) -> str:
        if sign == "=":
            return same(column, model, name, name, name)
        return f"({D.key_sql(column, model)} {sign} :{name})"

    def between(column: str, model: str, first: str, last: str) -> str:
        if (first, last) in parts and model.upper() == "YYYYMM":
            return same(column, model, parts[first, last], first, last)
        return f"({D.key_sql(column, model)} BETWEEN :{first} AND :{last})"

    body = D.rewrite(statement, test, between)
    for name in names:
        body = T.replace_marker(body, name, f"case_row.{hidden[name]}")
    row = "case_row"
    if lifted.own_cases:
        # the statement's own case table hides the one outside
        row, edits = "case_outside", B.Edits(body)
        same = " AND ".join(f"case_row.{hidden[c]} <=> {row}.{hidden[c]}" for c in (*names, *parts.values()))
        edits.add((0, len(body)), f"{view} case_row", same)
        body = edits.applied()
    columns = ", ".join(f"{row}.{hidden[n]} AS `{n}`" for n in names)
    try:
        found = spark.sql(f"SELECT {columns}, extract_row.* FROM {view} {row}, LATERAL ({body}) extract_row")
    finally:
        for name in (view, *lifted.views):
            spark.catalog.dropTempView(name)
    return found.drop(*[c for c in found.columns if c.startswith(_HIDDEN)])


def _months(first: str, last: str) -> Column:
    """Month texts from one case column to another; none for a reversed range."""
    start, stop = month_start(F.col(first)), month_start(F.col(last))
    days = F.sequence(start, stop, F.expr("interval 1 month"))
    texts = F.transform(days, lambda d: F.date_format(d, "yyyyMM"))
    return F.when(start <= stop, texts).otherwise(F.array().cast("array<string>"))


def _union_over_tables(
    spark: SparkSession, statement: str, cases: DataFrame, names: list[str], scan_per_case: bool
) -> DataFrame:
    """One statement for every table the cases name."""
    inside = T.table_names(statement)
    wanted = cases.select(*inside).distinct()
    if not is_small(wanted, MOST_TABLES):
        raise ValueError(f"more than {MOST_TABLES} tables")
    others = [n for n in names if n not in inside]
    united = None
    for row in wanted.collect():
        text, mine = statement, F.lit(True)
        for name in inside:
            value = row[name].replace("'", "''")
            text = T.replace_marker(text, name, f"'{value}'")
            mine = mine & (F.col(name) == row[name])
        own = cases.where(mine).select(*others).distinct() if others else None
        one = extract_cases(spark, text, {}, cases=own, scan_per_case=scan_per_case)
        one = one.select(*[(F.lit(row[n]) if n in inside else F.col(n)).alias(n) for n in names],
                         *[c for c in one.columns if c not in others])
        united = one if united is None else united.unionByName(one)
    if united is None:
        raise ValueError("the case table is empty")
    return united


def _month_bounds(cases: DataFrame, names: list[str]) -> dict[str, tuple[dt.date, dt.date]]:
    """First day and day after the last over all cases; one tiny job."""
    bounds = _period_bounds(cases, {("YYYYMM", n) for n in names})
    return {name: (lo.date(), hi.date()) for (_m, name), (lo, hi) in bounds.items()}


def _period_bounds(cases: DataFrame, wanted: set[tuple[str, str]]) -> dict:
    """Start of the first period and end of the last over all cases, by (model, parameter).

    One tiny job; a text that does not follow its model raises.
    """
    keys = sorted(wanted)
    if not keys:
        return {}
    aggregates = []
    for i, (model, name) in enumerate(keys):
        text, form = F.col(name), D.spark_format(model)
        right = F.date_format(F.try_to_timestamp(text, F.lit(form)), form) == text
        aggregates += [F.min(text).alias(f"lo_{i}"), F.max(text).alias(f"hi_{i}")]
        aggregates.append(F.min(F.when(text.isNotNull() & ~F.coalesce(right, F.lit(False)), text)).alias(f"bad_{i}"))
    row, bounds = cases.agg(*aggregates).first(), {}
    for i, (model, name) in enumerate(keys):
        if row[f"bad_{i}"] is not None:
            D.period(row[f"bad_{i}"], model)
            raise ValueError(f"not a {D.spark_format(model)}: {row[f'bad_{i}']}")
        # texts of one model are ordered as their periods are
        if row[f"lo_{i}"] is not None:
            bounds[model, name] = (D.period(row[f"lo_{i}"], model)[0], D.period(row[f"hi_{i}"], model)[1])
    return bounds


def _union_of_cases(
    spark: SparkSession, template: str, cases: DataFrame, names: list[str]
) -> DataFrame:
    # one scan per case, as the caller asked
    united = None
    for row in cases.toLocalIterator():
        values = row.asDict()
        one = extract(spark, template, values)
        one = one.select(*[F.lit(values[n]).alias(n) for n in names], "*")
        united = one if united is None else united.unionAll(one)
    if united is None:
        raise ValueError("the case table is empty")
    return united


def extract_by_month(fact: DataFrame, date_column: str, cases: DataFrame, key: str) -> DataFrame:
    """Rows of `fact` whose month is in the case column `key`, with the case columns."""
    cases = cases.distinct()
    lo, hi = _month_bounds(cases, [key]).get(key, (None, None))
    in_range = F.lit(False)
    if lo is not None:
        in_range = (F.col(date_column) >= F.lit(lo)) & (F.col(date_column) < F.lit(hi))
    small = F.broadcast(cases) if is_small(cases, BROADCAST_CASES) else cases
    keyed = fact.where(in_range).withColumn(key, month_key(date_column))
    return keyed.join(small, key)
