"""Registered queries: parameterised extracts, cases and names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parampipe.functions import naming as N
from parampipe.functions.params import month_key, override_params, parse_overrides
from parampipe.operators import cases as C
from parampipe.operators import extract as X
from parampipe.operators import filters as FL
from parampipe.operators import ledger as LG
from parampipe.operators import load as L
from parampipe.operators import runs as R
from parampipe.operators import sinks as S
from parampipe.plans.inputs import register, table
from parampipe.session import new_scratch
from parampipe.sources import files as SRC

ORDERS_OF_MONTH = """select * from orders
where TO_CHAR(o_orderdate, 'YYYYMM') = :clsYymm
"""

LINES_OF_MONTH = """SELECT
    l_orderkey,
    l_linenumber,
    l_partkey,
    l_quantity,
    l_extendedprice,
    l_shipdate
FROM
    lineitem
WHERE  TO_CHAR(l_shipdate, 'YYYYMM') = ':clsYymm_bf'
    ;
"""

ORDERS_OF_MONTH_AND_STATUS = """select * from orders
where TO_CHAR(o_orderdate, 'YYYYMM') = {#clsYymm} and o_orderstatus = ${status}
"""

TOTALS_OF_MONTH = """select count(*) as order_count,
       cast(sum(cast(o_totalprice as decimal(18, 2))) as double) as order_value
from orders where TO_CHAR(o_orderdate, 'YYYYMM') = :clsYymm
"""

LITERAL_PARAMS = """select o_orderkey, o_orderpriority, o_orderdate, '12:MI:SS' as clock
from orders -- the day is :not_a_param
where o_orderpriority like '${p}%' and o_orderdate >= to_date('${m}01', 'yyyyMMdd')
  and date_format(o_orderdate, 'HH:mm:ss') <> '${m}' /* done */;
/* end */"""

LITERAL_EQUALITY = """select o_orderkey, o_orderpriority from orders
where o_orderpriority = '${no}-${word}' and o_orderstatus <> 'HH24:MI:SS' /* done */"""

MONTH_BETWEEN = "select o_orderkey, o_orderdate from orders where TO_CHAR(o_orderdate, 'YYYYMM') between :a and :b"

FROM_TABLE = """select count(*) as row_count from ${kind}_rows
where TO_CHAR(day, 'YYYYMM') = :m"""


def all_months(spark: SparkSession, sf_dir: str, name: str = "orders", column: str = "o_orderdate") -> str:
    """The range from the first to the last month a table holds."""
    ends = table(spark, sf_dir, name).agg(
        F.date_format(F.min(column), "yyyyMM").alias("a"), F.date_format(F.max(column), "yyyyMM").alias("b")
    ).first()
    return f"{ends['a']}:{ends['b']}"



def extract_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, "orders")
    return X.extract(spark, ORDERS_OF_MONTH, {"clsYymm": "199503"})


def extract_projected(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, "lineitem")
    return X.extract(spark, LINES_OF_MONTH, {"clsYymm": "199504", "clsYymm_bf": "199503"})


def full_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, "customer")
    return X.extract(spark, "SELECT * FROM customer", {})


def _orders_by_case(spark: SparkSession, sf_dir: str, spec: str) -> DataFrame:
    """Extract for all months of `spec`, written by case and read back."""
    register(spark, sf_dir, "orders")
    rows = X.extract_cases(spark, ORDERS_OF_MONTH, {"clsYymm": spec})
    path = new_scratch(spark, "extract")
    S.write_extract(rows, path, ["clsYymm"])
    return SRC.read_parquet(spark, path, rows.schema)


def extract_month_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_by_case(spark, sf_dir, all_months(spark, sf_dir))


def extract_month_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_by_case(spark, sf_dir, "199501, ,199507")


def extract_quarter_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_by_case(spark, sf_dir, all_months(spark, sf_dir) + "~Q")


def extract_half_year_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_by_case(spark, sf_dir, all_months(spark, sf_dir) + "~H")


def extract_year_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_by_case(spark, sf_dir, all_months(spark, sf_dir) + "~Y")


def extract_by_month_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same extract through the DataFrame operator."""
    months = C.case_table(spark, {"clsYymm": all_months(spark, sf_dir, "lineitem", "l_shipdate")})
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return X.extract_by_month(lines, "l_shipdate", months, "clsYymm")


def extract_two_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, "orders")
    params = {"clsYymm": all_months(spark, sf_dir), "status": "F,O,P", "unused": "1,2"}
    rows = X.extract_cases(spark, ORDERS_OF_MONTH_AND_STATUS, params)
    path = new_scratch(spark, "extract")
    S.write_extract(rows, path, ["clsYymm", "status"])
    return SRC.read_parquet(spark, path, rows.schema)


def extract_csv_by_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract as gzip CSV, one folder per case."""
    register(spark, sf_dir, "orders")
    rows = X.extract_cases(spark, ORDERS_OF_MONTH, {"clsYymm": all_months(spark, sf_dir)})
    path = new_scratch(spark, "extract")
    S.write_extract(rows, path, ["clsYymm"], fmt="csv")
    return SRC.read_csv(spark, path, rows.schema)


def _run_twice(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A run over some months, then one over all of them; returns output and ledger."""
    register(spark, sf_dir, "orders")
    path, ledger = new_scratch(spark, "extract"), new_scratch(spark, "ledger")
    for batch, months in (("20240101_000000", "199501:199712"), ("20240102_000000", all_months(spark, sf_dir))):
        R.run_extract(
            spark, "01_orders", ORDERS_OF_MONTH, {"clsYymm": months}, path, ledger, batch, "local"
        )
    return path, ledger


def extract_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run extracts only what the first left open."""
    path, _ledger = _run_twice(spark, sf_dir)
    rows = table(spark, sf_dir, "orders").withColumn("clsYymm", F.lit(""))
    return SRC.read_parquet(spark, path, rows.schema)


def extract_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ledger row per case with its row count, months without rows included."""
    _path, ledger = _run_twice(spark, sf_dir)
    return LG.read_ledger(spark, ledger).select(
        "batch_ts", "host", "sql_file", "params", "sql_hash", "status", "rows"
    )


def extract_case_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, "orders")
    return X.extract_cases(spark, TOTALS_OF_MONTH, {"clsYymm": all_months(spark, sf_dir)})


def _run_orders(spark, text, params, paths, batch, **options) -> DataFrame:
    return R.run_extract(spark, "01_orders", text, params, *paths, batch, "local", **options)


def extract_bad_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month fails while it runs: it alone is FAIL, the others are written."""
    register(spark, sf_dir, "orders")
    paths = new_scratch(spark, "extract"), new_scratch(spark, "ledger")
    text = """select o_orderkey, 1 div (199503 - cast(date_format(o_orderdate, 'yyyyMM') as int)) as x
        from orders where TO_CHAR(o_orderdate, 'YYYYMM') = :m"""
    found = _run_orders(spark, text, {"m": "199501:199506"}, paths, "20240101_000000")
    fields = "o_orderkey bigint, x bigint, m string"
    written = SRC.read_parquet(spark, paths[0], T.StructType.fromDDL(fields))
    output = written.groupBy(F.concat(F.lit("m="), "m").alias("params")).agg(
        F.count(F.lit(1)).alias("written")
    )
    return found.join(output, "params", "left").select(
        "params", "status", "rows", F.col("error_message").contains("DIVIDE_BY_ZERO").alias("zero"), "written"
    )


def extract_case_emptied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The template changes so that a month has no rows: its old output goes."""
    register(spark, sf_dir, "orders")
    paths = new_scratch(spark, "extract"), new_scratch(spark, "ledger")
    changed = ORDERS_OF_MONTH + " and month(o_orderdate) <> 2"
    for batch, text in (("20240101_000000", ORDERS_OF_MONTH), ("20240102_000000", changed)):
        _run_orders(spark, text, {"clsYymm": "199601:199606"}, paths, batch)
    rows = table(spark, sf_dir, "orders").withColumn("clsYymm", F.lit(""))
    return SRC.read_parquet(spark, paths[0], rows.schema)


def extract_without_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A template without parameters is one case, extracted once."""
    register(spark, sf_dir, "customer")
    paths = new_scratch(spark, "extract"), new_scratch(spark, "ledger")
    for batch in ("20240101_000000", "20240102_000000"):
        _run_orders(spark, "SELECT * FROM customer", {}, paths, batch)
    return LG.read_ledger(spark, paths[1]).select("batch_ts", "params", "status", "rows")


def extract_literal_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placeholders inside literals, comments, and texts that only look like placeholders:
    one case, many with an equality, and many with a scan for each."""
    register(spark, sf_dir, "orders")
    one = X.extract(spark, LITERAL_PARAMS, {"p": "1-UR", "m": "199603"}).select(
        F.lit("one").alias("kind"), "o_orderkey", "clock"
    )
    params = {"no": "1,3", "word": "URGENT,MEDIUM"}
    joined = X.extract_cases(spark, LITERAL_EQUALITY, params).select(
        F.concat("no", F.lit("-"), "word").alias("kind"), "o_orderkey", F.lit("").alias("clock")
    )
    each = X.extract_cases(
        spark, LITERAL_PARAMS, {"p": "1,2", "m": "199701"}, scan_per_case=True
    ).select(F.concat(F.lit("each "), "p").alias("kind"), "o_orderkey", "clock")
    return one.unionAll(joined).unionAll(each)


def extract_table_param(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table is a parameter, for one case and for many."""
    register(spark, sf_dir, "orders", "lineitem")
    spark.sql("create or replace temp view orders_rows as select o_orderdate as day from orders")
    spark.sql("create or replace temp view lineitem_rows as select l_shipdate as day from lineitem")
    one = X.extract(spark, FROM_TABLE, {"kind": "orders", "m": "199603"})
    many = X.extract_cases(spark, FROM_TABLE, {"kind": "orders,lineitem", "m": "199601:199612"})
    return one.select(F.lit("one").alias("kind"), F.lit("199603").alias("m"), "row_count").unionByName(many)


def extract_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month ranges as cases, answered in one scan."""
    register(spark, sf_dir, "orders")
    params = {"a": "199601:199612", "b": "199604,199609"}
    return X.extract_cases(spark, MONTH_BETWEEN, params).select("a", "b", "o_orderkey")


def cases_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = C.case_table(spark, {"cls_yymm": all_months(spark, sf_dir), "status": "F,O,P"})
    orders = table(spark, sf_dir, "orders").select(
        month_key("o_orderdate").alias("cls_yymm"), F.col("o_orderstatus").alias("status")
    )
    return C.rows_by_case(cases, orders, ["cls_yymm", "status"])


def cases_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, "orders")
    params = {"clsYymm": all_months(spark, sf_dir), "status": "F,O,P,F,O,P,F,O,P,F,O,P"}
    return X.extract_cases(spark, ORDERS_OF_MONTH_AND_STATUS, params, mode="zip")


def empty_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month without rows still gives files with a header, and counts as OK."""
    register(spark, sf_dir, "orders")
    rows = X.extract(spark, ORDERS_OF_MONTH, {"clsYymm": "190001"})
    path = new_scratch(spark, "empty")
    S.write_csv(rows, path)
    back = SRC.read_csv_raw(spark, path)
    return back.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("clsYymm=190001").alias("params"),
        F.lit("OK").alias("status"),
        "row_count",
        F.lit(",".join(back.columns)).alias("header"),
    )


def case_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    base = F.create_map(
        F.lit("baseYymm"), F.lit("190001"), F.lit("a_priority"), F.col("o_orderpriority")
    )
    given = parse_overrides(
        F.array(F.concat(F.lit(" baseYymm = "), month_key("o_orderdate")), F.lit("extra=a=b"))
    )
    params = override_params(base, given)
    return orders.select(
        "o_orderkey",
        N.case_suffix(params).alias("month_suffix"),
        N.case_suffix(params, F.array(F.lit("extra"), F.lit("a_priority"))).alias("first_suffix"),
        F.try_element_at(params, F.lit("extra")).alias("extra"),
    )


def case_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = F.create_map(
        F.lit("prio"), F.col("o_orderpriority"), F.lit("clsYymm"), month_key("o_orderdate")
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        N.case_label(F.lit("01_orders"), F.col("o_orderstatus"), params).alias("label"),
        N.describe_case(params).alias("params"),
    )


def suffix_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(
        F.col("p_type") == "PROMO", F.concat("p_name", F.lit(".v1"))
    ).otherwise(F.concat("p_name", F.lit("_"), F.col("p_size")))
    return table(spark, sf_dir, "part").select(
        "p_partkey", N.split_suffix(name).alias("s")
    ).select("p_partkey", "s.base", "s.suffix")


def file_template_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files per table; files whose template is missing are counted as skipped."""
    orders = table(spark, sf_dir, "orders")
    priority = F.replace("o_orderpriority", F.lit(" "), F.lit("_"))
    files = orders.select(
        F.concat(
            priority,
            F.lit("__"),
            F.col("o_orderstatus"),
            F.lit("__clsYymm_"),
            month_key("o_orderdate"),
            F.lit(".csv.gz"),
        ).alias("file_name")
    ).distinct().withColumn("template", N.template_of_file(F.col("file_name")))
    corpus = orders.where(F.col("o_orderpriority") != "5-LOW").select(
        priority.alias("template"),
        F.when(
            F.col("o_orderpriority").endswith("H"),
            F.concat(F.lit("\n--[ T_"), F.col("o_orderpriority"), F.lit("]\nselect 1")),
        ).otherwise("select 1").alias("text"),
    ).distinct()
    templates = corpus.select(
        "template", N.table_of_template(F.col("text"), F.col("template")).alias("table_name")
    )
    matched = L.match_templates(files, templates).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("files")
    ).withColumn("status", F.lit("matched"))
    skipped = L.match_templates(files, templates, "left_anti").groupBy(
        F.col("template").alias("table_name")
    ).agg(F.count(F.lit(1)).alias("files")).withColumn("status", F.lit("skipped"))
    return matched.unionByName(skipped)


def substring_any_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return part.where(FL.contains_any(F.col("p_name"), " RING, bolt"))


def membership_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts in wanted folders whose brand is sold by type SMALL as well."""
    part = table(spark, sf_dir, "part")
    chosen = part.where(FL.in_folders(F.col("p_type"), ["/PROMO/", "ECONOMY", "LARGE\\"]))
    targets = part.where((F.col("p_type") == "SMALL") & (F.col("p_size") > 45))
    kept = FL.for_targets(chosen, F.col("p_brand"), targets, F.lower("p_brand"))
    return kept.select("p_partkey", "p_brand", "p_type")


def suffix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    suffix = F.when(F.col("o_orderstatus") == "P", "").otherwise(
        F.concat(F.lit("_"), month_key("o_orderdate"))
    )
    return orders.select("o_orderkey", suffix.alias("file_suffix")).where(
        FL.suffix_has_values(F.col("file_suffix"), ["1995", "07"])
    )


# What a parameter selects inside a block of the statement, one template for each kind.
NESTED = {
    "in": """select o_orderkey as id, o_custkey as n from orders
        where o_custkey in (select c_custkey from customer where c_mktsegment = :segment)""",
    "in_total": """select o_custkey as id, count(*) as n from orders
        where TO_CHAR(o_orderdate, 'YYYYMM') = :month and o_custkey in
          (select c_custkey from customer where c_mktsegment = ':segment') group by o_custkey;""",
    "exists": """select o.o_orderkey as id, o.o_custkey as n from orders o
        where TO_CHAR(o.o_orderdate, 'YYYYMM') = :month and exists
          (select 1 from lineitem l where l.l_orderkey = o.o_orderkey and l.l_returnflag = :flag)""",
    "not_exists": """select o_orderkey as id, o_custkey as n from orders o
        where TO_CHAR(o_orderdate, 'YYYYMM') = :month and not exists
          (select 1 from lineitem l where l.l_orderkey = o.o_orderkey and l.l_returnflag = :flag)""",
    "scalar": """select o_orderkey as id, o_custkey as n from orders
        where TO_CHAR(o_orderdate, 'YYYYMM') = :month and o_totalprice >
          (select avg(o_totalprice) from orders where TO_CHAR(o_orderdate, 'YYYYMM') = :month)""",
    "cte": """with some as (select c_custkey, c_nationkey from customer where c_mktsegment = :segment),
        totals as (select c_nationkey, count(*) as customers from some group by c_nationkey)
        select n_nationkey as id, t.customers as n from nation join totals t on t.c_nationkey = n_nationkey""",
}


def extract_subquery_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters inside IN, EXISTS, scalar and WITH blocks, all cases in one pass."""
    register(spark, sf_dir, "orders", "customer", "lineitem", "nation")
    params = {"segment": "BUILDING,MACHINERY,AUTOMOBILE", "month": "199501:199612", "flag": "R,N"}
    united = None
    for kind, template in NESTED.items():
        rows = X.extract_cases(spark, template, params)
        given = F.concat_ws("/", *[c for c in rows.columns if c in params])
        one = rows.select(F.lit(kind).alias("kind"), given.alias("params"), F.col("id").cast("bigint").alias("id"), F.col("n").cast("bigint").alias("n"))
        united = one if united is None else united.unionByName(one)
    return united


def extract_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges and one-sided tests for a case of every day or price, without a nested loop."""
    register(spark, sf_dir, "orders", "lineitem")
    days = spark.sql("select explode(sequence(date'1995-01-01', date'1997-09-26')) as d")
    weeks = days.select(F.date_format("d", "yyyy-MM-dd").alias("a"), F.date_format(F.date_add("d", 7), "yyyy-MM-dd").alias("b"))
    week = X.extract_cases(
        spark, "select l_orderkey from lineitem where l_shipdate >= to_date(:a) and l_shipdate < to_date(:b)", {}, cases=weeks
    )
    prices = spark.range(1000).select((F.col("id") * 350).cast("string").alias("price"))
    price = X.extract_cases(spark, "select o_orderkey from orders where o_totalprice >= cast(:price as double)", {}, cases=prices)
    months = X.extract_cases(
        spark, "select o_orderkey from orders where TO_CHAR(o_orderdate, 'YYYYMM') <= :m", {"m": "199501:199712"}
    )
    return (
        week.groupBy(F.lit("week").alias("kind"), F.col("a").alias("given")).agg(F.count(F.lit(1)).alias("n"))
        .unionByName(price.groupBy(F.lit("price").alias("kind"), F.col("price").alias("given")).agg(F.count(F.lit(1)).alias("n")))
        .unionByName(months.groupBy(F.lit("month").alias("kind"), F.col("m").alias("given")).agg(F.count(F.lit(1)).alias("n")))
    )


def extract_date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years, days, hours and truncated dates as tests of a column's range."""
    register(spark, sf_dir, "orders", "events")
    forms = {
        "year": "select o_orderkey as id, o_orderdate as moment from orders where extract(year from o_orderdate) = :p",
        "dashed": "select o_orderkey as id, o_orderdate as moment from orders where TO_CHAR(o_orderdate, 'YYYY-MM') = :p",
        "day": "select o_orderkey as id, o_orderdate as moment from orders where TO_CHAR(o_orderdate, 'YYYYMMDD') = :p",
        "trunc": "select o_orderkey as id, o_orderdate as moment from orders where trunc(o_orderdate, 'MM') = to_date(:p, 'YYYYMM')",
        "hour": "select event_id as id, ts as moment from events where TO_CHAR(ts, 'YYYYMMDD HH24') = :p",
    }
    values = {
        "year": ["1995", "1997", "1999"],
        "dashed": ["1995-03", "1996-12"],
        "day": ["19950301", "19950715", "19960229"],
        "trunc": ["199503", "199802"],
        "hour": ["20240103 05", "20240110 23"],
    }
    united = None
    for kind, template in forms.items():
        one = X.extract(spark, template, {"p": values[kind][0]}).withColumn("p", F.lit(values[kind][0]))
        cases = X.extract_cases(spark, template, {"p": ",".join(values[kind])})
        for way, rows in (("one", one), ("many", cases)):
            rows = rows.select(F.lit(f"{kind} {way}").alias("kind"), "p", "id", "moment")
            united = rows if united is None else united.unionByName(rows)
    return united


QUERIES = {
    f.__name__: f
    for f in (
        extract_month,
        extract_projected,
        full_copy,
        extract_month_range,
        extract_month_list,
        extract_quarter_ends,
        extract_half_year_ends,
        extract_year_ends,
        extract_by_month_key,
        extract_two_params,
        extract_csv_by_case,
        extract_pending,
        extract_ledger,
        extract_case_totals,
        extract_bad_case,
        extract_case_emptied,
        extract_without_params,
        extract_literal_params,
        extract_table_param,
        extract_between,
        extract_subquery_params,
        extract_ranges,
        extract_date_texts,
        cases_product,
        cases_zip,
        empty_extract,
        case_suffix,
        case_label,
        suffix_split,
        file_template_match,
        substring_any_filter,
        membership_filter,
        suffix_filter,
    )
}

_MONTH = "strftime(o_orderdate, '%Y%m')"
_MONTHS = """(select strftime(m, '%Y%m') as cls_yymm
  from (select unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), interval 1 month)) as m from orders))"""
_ORDERS_WITH_MONTH = f"select *, {_MONTH} as clsYymm from orders"
_TEMPLATE = ORDERS_OF_MONTH.strip().replace("'", "''")
_MONTH_NO = "extract(month from o_orderdate)"

ORACLE = {
    "extract_month": f"select * from orders where {_MONTH} = '199503'",
    "extract_projected": """select l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice,
        l_shipdate from lineitem where strftime(l_shipdate, '%Y%m') = '199503'""",
    "full_copy": "select * from customer",
    "extract_month_range": f"""select o.*, m.cls_yymm as clsYymm from orders o
        join {_MONTHS} m on strftime(o.o_orderdate, '%Y%m') = m.cls_yymm""",
    "extract_month_list": f"{_ORDERS_WITH_MONTH} where {_MONTH} in ('199501', '199507')",
    "extract_quarter_ends": f"{_ORDERS_WITH_MONTH} where {_MONTH_NO} in (3, 6, 9, 12)",
    "extract_half_year_ends": f"{_ORDERS_WITH_MONTH} where {_MONTH_NO} in (6, 12)",
    "extract_year_ends": f"{_ORDERS_WITH_MONTH} where {_MONTH_NO} = 12",
    "extract_by_month_key": """select l_orderkey, l_linenumber, l_shipdate,
        strftime(l_shipdate, '%Y%m') as clsYymm from lineitem""",
    "extract_two_params": f"select *, {_MONTH} as clsYymm, o_orderstatus as status from orders",
    "extract_csv_by_case": _ORDERS_WITH_MONTH,
    "extract_pending": _ORDERS_WITH_MONTH,
    "extract_ledger": f"""select case when m.cls_yymm <= '199712' then '20240101_000000'
        else '20240102_000000' end as batch_ts, 'local' as host, '01_orders' as sql_file,
        'clsYymm=' || m.cls_yymm as params, md5('{_TEMPLATE}') as sql_hash, 'OK' as status,
        count(o_orderkey) as rows
        from {_MONTHS} m left join orders o on strftime(o.o_orderdate, '%Y%m') = m.cls_yymm
        group by m.cls_yymm""",
    "extract_case_totals": f"""select m.cls_yymm as clsYymm, count(o_orderkey) as order_count,
        cast(sum(cast(o_totalprice as decimal(18, 2))) as double) as order_value
        from {_MONTHS} m left join orders o on strftime(o.o_orderdate, '%Y%m') = m.cls_yymm
        group by m.cls_yymm""",
    "extract_bad_case": f"""select 'm=' || m as params, case when m = '199503' then 'FAIL' else 'OK' end as status,
          case when m = '199503' then 0 else n end as rows, m = '199503' as zero,
          case when m = '199503' then null else n end as written
        from (select {_MONTH} as m, count(*) as n from orders where {_MONTH} between '199501' and '199506' group by 1)""",
    "extract_case_emptied": f"""{_ORDERS_WITH_MONTH} where {_MONTH} between '199601' and '199606' and {_MONTH} <> '199602'""",
    "extract_without_params": """select '20240101_000000' as batch_ts, '-' as params, 'OK' as status,
        count(*) as rows from customer""",
    "extract_literal_params": """select 'one' as kind, o_orderkey, '12:MI:SS' as clock from orders
        where o_orderpriority like '1-UR%' and o_orderdate >= timestamp '1996-03-01'
        union all select o_orderpriority, o_orderkey, '' from orders
          where o_orderpriority in ('1-URGENT', '3-MEDIUM', '1-MEDIUM', '3-URGENT')
        union all select 'each ' || substr(o_orderpriority, 1, 1), o_orderkey, '12:MI:SS' from orders
          where substr(o_orderpriority, 1, 1) in ('1', '2') and o_orderdate >= timestamp '1997-01-01'""",
    "extract_table_param": """with d as (select 'orders' as kind, o_orderdate as day from orders
          union all select 'lineitem', l_shipdate from lineitem),
        m as (select unnest(range(199601, 199613))::varchar as m)
        select 'one' as kind, '199603' as m, count(*) as row_count from orders
          where strftime(o_orderdate, '%Y%m') = '199603'
        union all select k.kind, m.m, count(d.day) from (values ('orders'), ('lineitem')) k(kind) cross join m
          left join d on d.kind = k.kind and strftime(d.day, '%Y%m') = m.m group by all""",
    "extract_between": f"""select a, b, o_orderkey from orders
        join (select unnest(range(199601, 199613))::varchar as a) on {_MONTH} >= a
        join (values ('199604'), ('199609')) v(b) on {_MONTH} <= b""",
    "extract_subquery_params": f"""with s as (select unnest(['BUILDING', 'MACHINERY', 'AUTOMOBILE']) as segment),
        f as (select unnest(['R', 'N']) as flag),
        o as (select *, {_MONTH} as month from orders), p as (select * from o where month between '199501' and '199612'),
        a as (select month, avg(o_totalprice) as price from p group by month)
        select 'in' as kind, c_mktsegment as params, o_orderkey as id, o_custkey as n
          from orders join customer on c_custkey = o_custkey join s on segment = c_mktsegment
        union all select 'in_total', month || '/' || c_mktsegment, o_custkey, count(*)
          from p join customer on c_custkey = o_custkey join s on segment = c_mktsegment group by all
        union all select 'exists', flag || '/' || month, o_orderkey, o_custkey from p cross join f
          where exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = flag)
        union all select 'not_exists', flag || '/' || month, o_orderkey, o_custkey from p cross join f
          where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = flag)
        union all select 'scalar', month, o_orderkey, o_custkey from p join a using (month) where o_totalprice > price
        union all select 'cte', c_mktsegment, c_nationkey, count(*) from customer join s on segment = c_mktsegment
          join nation on n_nationkey = c_nationkey group by all""",
    "extract_ranges": f"""with d as (select unnest(generate_series(date '1995-01-01', date '1997-09-26', interval 1 day)) as a),
        p as (select unnest(range(1000)) * 350 as price)
        select 'week' as kind, strftime(a, '%Y-%m-%d') as given, count(*) as n
          from lineitem join d on l_shipdate >= a and l_shipdate < a + interval 7 day group by all
        union all select 'price', price::varchar, count(*) from orders join p on o_totalprice >= price group by all
        union all select 'month', m.cls_yymm, count(*) from orders join {_MONTHS} m on {_MONTH} <= m.cls_yymm
          where m.cls_yymm between '199501' and '199712' group by all""",
    "extract_date_texts": """with v as (select * from (values ('year', '1995', 1), ('year', '1997', 2), ('year', '1999', 2),
          ('dashed', '1995-03', 1), ('dashed', '1996-12', 2), ('day', '19950301', 1), ('day', '19950715', 2),
          ('day', '19960229', 2), ('trunc', '199503', 1), ('trunc', '199802', 2), ('hour', '20240103 05', 1),
          ('hour', '20240110 23', 2)) t(form, p, place)),
        x as (select o_orderkey as id, o_orderdate as moment, unnest(['year', 'dashed', 'day', 'trunc']) as form,
            unnest([strftime(o_orderdate, '%Y'), strftime(o_orderdate, '%Y-%m'), strftime(o_orderdate, '%Y%m%d'),
              strftime(o_orderdate, '%Y%m')]) as p from orders
          union all select event_id, ts, 'hour', strftime(ts, '%Y%m%d %H') from events),
        r as (select x.form, x.p, id, moment, place from x join v on x.form = v.form and x.p = v.p)
        select form || ' many' as kind, p, id, moment from r
        union all select form || ' one', p, id, moment from r where place = 1""",
    "cases_product": f"""select m.cls_yymm, s.status, count(o_orderkey) as row_count
        from {_MONTHS} m cross join (values ('F'), ('O'), ('P')) s(status)
        left join orders o on strftime(o.o_orderdate, '%Y%m') = m.cls_yymm and o_orderstatus = s.status
        group by m.cls_yymm, s.status""",
    "cases_zip": f"""select o.*, c.clsYymm, c.status from orders o join (values
        ('199501', 'F'), ('199502', 'O'), ('199503', 'P'), ('199504', 'F'), ('199505', 'O'),
        ('199506', 'P'), ('199507', 'F'), ('199508', 'O'), ('199509', 'P'), ('199510', 'F'),
        ('199511', 'O'), ('199512', 'P')) c(clsYymm, status)
        on {_MONTH} = c.clsYymm and o_orderstatus = c.status""",
    "empty_extract": f"""select 'clsYymm=190001' as params, 'OK' as status, count(*) as row_count,
        'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' as header
        from orders where {_MONTH} = '190001'""",
    "case_suffix": f"""select o_orderkey, '_' || {_MONTH} as month_suffix,
        '_' || regexp_replace(o_orderpriority, '[^\\w\\-]', '', 'g') as first_suffix,
        'a=b' as extra from orders""",
    "case_label": f"""select o_orderkey,
        '01_orders__' || o_orderstatus || '__clsYymm_' || {_MONTH} || '__prio_'
          || replace(o_orderpriority, ' ', '_') as label,
        'clsYymm=' || {_MONTH} || ', prio=' || o_orderpriority as params from orders""",
    "suffix_split": """select p_partkey, upper(p_name) as base,
        case when p_type = 'PROMO' then '' else '_' || p_size end as suffix from part""",
    "file_template_match": f"""with f as (select distinct o_orderpriority p, o_orderstatus s, {_MONTH} m from orders)
        select case when p like '%H' then 'T_' || p else replace(p, ' ', '_') end as table_name,
          count(*) as files, case when p = '5-LOW' then 'skipped' else 'matched' end as status
        from f group by p""",
    "substring_any_filter": """select p_partkey, p_name from part
        where lower(p_name) like '%ring%' or lower(p_name) like '%bolt%'""",
    "membership_filter": """select p_partkey, p_brand, p_type from part
        where p_type in ('PROMO', 'ECONOMY', 'LARGE')
          and p_brand in (select p_brand from part where p_type = 'SMALL' and p_size > 45)""",
    "suffix_filter": f"""select * from (select o_orderkey,
          case when o_orderstatus = 'P' then '' else '_' || {_MONTH} end as file_suffix from orders)
        where file_suffix = '' or (file_suffix like '%1995%' and file_suffix like '%07%')""",
}
