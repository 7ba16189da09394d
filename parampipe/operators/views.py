"""One logical table over many part tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parampipe.functions.naming import PART_SEPARATOR


def part_tables(spark: SparkSession, schema: str, base: str) -> list[str]:
    """Tables of `schema` named ``<base>__...``, in name order.

    The prefix is literal; ``_`` is no wildcard.
    """
    prefix = f"{base}{PART_SEPARATOR}".upper()
    names = [t.name for t in spark.catalog.listTables(schema) if not t.isTemporary]
    return sorted(n for n in names if n.upper().startswith(prefix))


def create_union_view(spark: SparkSession, schema: str, base: str) -> list[str]:
    """Create or replace the view `base` over its part tables; returns the parts.

    Columns go by position and take the type that holds all parts. Without
    parts the view is left as it is.
    """
    parts = part_tables(spark, schema, base)
    if parts:
        schemas = [spark.table(f"`{schema}`.`{p}`").schema for p in parts]
        target = common_schema(schemas)
        selects = [
            f"SELECT {_cast_list(own, target)} FROM `{schema}`.`{p}`"
            for p, own in zip(parts, schemas)
        ]
        body = "\nUNION ALL\n".join(selects)
        spark.sql(f"CREATE OR REPLACE VIEW `{schema}`.`{base}` AS\n{body}")
    return parts


def _cast_list(own: T.StructType, target: T.StructType) -> str:
    return ", ".join(
        f"{_cast(_quoted(o.name), o.dataType, t.dataType)} AS {_quoted(t.name)}"
        for o, t in zip(own.fields, target.fields)
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _cast(value: str, own: T.DataType, target: T.DataType, depth: int = 0) -> str:
    """SQL of a value in the target type. Structs go by field name, a missing field is NULL."""
    if _ddl(own) == _ddl(target):
        return value
    kinds = {type(own), type(target)}
    if kinds == {T.StructType}:
        fields = {f.name.lower(): f for f in own.fields}
        parts = []
        for f in target.fields:
            found = fields.get(f.name.lower())
            inner = (
                _cast(f"{value}.{_quoted(found.name)}", found.dataType, f.dataType, depth)
                if found
                else f"CAST(NULL AS {_ddl(f.dataType)})"
            )
            parts.append(f"{inner} AS {_quoted(f.name)}")
        return f"IF({value} IS NULL, NULL, struct({', '.join(parts)}))"
    item = f"e{depth}"
    if kinds == {T.ArrayType}:
        return f"transform({value}, {item} -> {_cast(item, own.elementType, target.elementType, depth + 1)})"
    if kinds == {T.MapType}:
        key = _cast(f"{item}.key", own.keyType, target.keyType, depth + 1)
        inner = _cast(f"{item}.value", own.valueType, target.valueType, depth + 1)
        return f"map_from_entries(transform(map_entries({value}), {item} -> struct({key} AS key, {inner} AS value)))"
    return f"CAST({value} AS {_ddl(target)})"


def _ddl(kind: T.DataType) -> str:
    if isinstance(kind, T.StructType):
        return f"struct<{', '.join(f'{_quoted(f.name)}: {_ddl(f.dataType)}' for f in kind.fields)}>"
    if isinstance(kind, T.ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"map<{_ddl(kind.keyType)}, {_ddl(kind.valueType)}>"
    return kind.simpleString()


def union_parts(parts: list[DataFrame]) -> DataFrame:
    """UNION ALL by position; differing types are widened, in the last resort to text."""
    target = common_schema([p.schema for p in parts])
    return reduce(DataFrame.unionAll, [_as_target(p, target) for p in parts])


def _as_target(part: DataFrame, target: T.StructType) -> DataFrame:
    """Columns by position, in the names and types of `target`."""
    casts = [
        F.expr(_cast(_quoted(own.name), own.dataType, f.dataType)).alias(f.name)
        for own, f in zip(part.schema.fields, target.fields)
    ]
    return part.select(*casts)


# Footers read at a time by the driver; each is one small job.
FOOTERS_AT_ONCE = 16


def part_schemas(spark: SparkSession, paths: list[str]) -> list[T.StructType]:
    """Schema of every Parquet folder, from one footer of each."""
    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        return list(pool.map(lambda path: spark.read.parquet(path).schema, paths))


def union_folders(
    spark: SparkSession, paths: list[str], schemas: list[T.StructType] | None = None
) -> DataFrame:
    """`union_parts` over Parquet folders, with one scan for all folders of one schema.

    The plan grows with the number of different schemas, not of parts, so thousands of
    parts are planned, listed (by a job) and read as one table would be. `schemas` saves
    reading the footers where they are known. Names come from the first folder.
    """
    found = schemas or part_schemas(spark, paths)
    target = common_schema(found)
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for path, schema in zip(paths, found, strict=True):
        groups.setdefault(_ddl(schema), (schema, []))[1].append(path)
    scans = [spark.read.schema(schema).parquet(*own) for schema, own in groups.values()]
    return reduce(DataFrame.unionAll, [_as_target(scan, target) for scan in scans])


# Whole-number types by width, and the digits each needs as a decimal.
_WHOLE: dict[T.DataType, int] = {
    T.ByteType(): 3,
    T.ShortType(): 5,
    T.IntegerType(): 10,
    T.LongType(): 19,
}
# Fixed value: digits a decimal can have.
MOST_DIGITS = 38
_BINARY_FRACTIONS = (T.FloatType(), T.DoubleType())


def common_schema(schemas: list[T.StructType]) -> T.StructType:
    """Column types every part fits into; names come from the first part."""
    widths = {len(s.fields) for s in schemas}
    if len(widths) != 1:
        raise ValueError("parts have different numbers of columns")
    fields = []
    for column in zip(*[s.fields for s in schemas]):
        fields.append(T.StructField(column[0].name, _common([f.dataType for f in column])))
    return T.StructType(fields)


def _common(types: list[T.DataType]) -> T.DataType:
    """The type all others fit into; of nested types part by part, structs with all fields."""
    types = list({_ddl(t): t for t in types if not isinstance(t, T.NullType)}.values())
    if len(types) < 2:
        return types[0] if types else T.StringType()
    kinds = {type(t) for t in types}
    if kinds == {T.StructType}:
        fields: dict[str, list[T.StructField]] = {}
        for field in (f for t in types for f in t.fields):
            fields.setdefault(field.name.lower(), []).append(field)
        return T.StructType(
            [T.StructField(same[0].name, _common([f.dataType for f in same])) for same in fields.values()]
        )
    if kinds == {T.ArrayType}:
        return T.ArrayType(_common([t.elementType for t in types]))
    if kinds == {T.MapType}:
        return T.MapType(_common([t.keyType for t in types]), _common([t.valueType for t in types]))
    if all(t in _WHOLE for t in types):
        return max(types, key=_WHOLE.__getitem__)
    if all(isinstance(t, T.NumericType) for t in types):
        if any(t in _BINARY_FRACTIONS for t in types):
            # as in SQL: beside a binary fraction a number is approximate
            return T.DoubleType()
        decimals = [t if isinstance(t, T.DecimalType) else T.DecimalType(_WHOLE[t], 0) for t in types]
        scale = max(d.scale for d in decimals)
        digits = max(d.precision - d.scale for d in decimals) + scale
        return T.DecimalType(digits, scale) if digits <= MOST_DIGITS else T.StringType()
    days = (T.DateType(), T.TimestampNTZType())
    if all(t in days for t in types):
        return T.TimestampNTZType()
    return T.StringType()
