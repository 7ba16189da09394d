"""Registered queries: ordered SQL steps, the report they end in, and SQL coverage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parampipe.operators import extract as X
from parampipe.operators import ledger as LG
from parampipe.operators import load as L
from parampipe.operators import sinks as S
from parampipe.plans import folder as FD
from parampipe.plans import steps as ST
from parampipe.plans.extract_queries import ORDERS_OF_MONTH, all_months
from parampipe.plans.inputs import register
from parampipe.session import new_scratch, write_text
from parampipe.sources import files as SRC

VALUE_STEPS = {
    "10_monthly.sql": """
        CREATE OR REPLACE TEMP VIEW step_monthly AS
        SELECT o_custkey, cast(extract(year FROM o_orderdate) AS bigint) AS order_year,
               sum(cast(o_totalprice AS decimal(18, 2))) AS order_value
        FROM orders GROUP BY 1, 2;
    """,
    "20_nation.sql": """
        CREATE OR REPLACE TEMP VIEW step_nation AS
        SELECT r_name, n_name, order_year, sum(order_value) AS order_value
        FROM step_monthly
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        GROUP BY 1, 2, 3;
    """,
    "30_rank.sql": """
        SELECT r_name, n_name, order_year, cast(order_value AS double) AS order_value,
               rank() OVER (PARTITION BY r_name, order_year ORDER BY order_value DESC, n_name) AS place
        FROM step_nation;
    """,
    "90_other.txt": "not selected by the filter",
}

COUNT_STEPS = {
    "10_count.sql": "CREATE OR REPLACE TEMP VIEW step_count AS SELECT count(*) AS n FROM orders",
    "20_broken.sql": "SELECT no_such_column FROM orders",
    "25_late.sql": "CREATE OR REPLACE TEMP VIEW step_late AS SELECT CAST(o_orderpriority AS int) AS p FROM orders",
    "30_report.sql": "CREATE OR REPLACE TEMP VIEW step_report AS SELECT n FROM step_count;"
    " SELECT n FROM step_report",
}

VIEW_STEP = {
    "10_by_status.sql": "CREATE OR REPLACE TEMP VIEW step_by_status AS "
    "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1 -- for the next; step"
}

PER_MONTH_STEP = {
    "10_per_month.sql": """
        SELECT clsYymm AS cls_yymm, count(*) AS order_count,
               cast(sum(cast(o_totalprice AS decimal(18, 2))) AS double) AS order_value
        FROM {table} GROUP BY 1
    """
}


def sql_step_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir, "orders", "customer", "nation", "region")
    result, _ledger = ST.run_steps(spark, VALUE_STEPS, "20240101_000000", name_filter=".SQL")
    return result


def report_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The step result as a CSV report."""
    report = sql_step_chain(spark, sf_dir)
    path = new_scratch(spark, "report")
    S.write_csv(report, path, compression="none")
    return SRC.read_csv(spark, path, report.schema)


def step_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A failing step, also one that fails only when it is worked out, is recorded and the
    next one runs; a succeeded one is skipped."""
    register(spark, sf_dir, "orders")
    _first, ledger = ST.run_steps(spark, COUNT_STEPS, "20240101_000000")
    done = ST.done_steps(ledger, LG.success_keys(ledger))
    again = dict(COUNT_STEPS, **{"30_report.sql": COUNT_STEPS["30_report.sql"] + " ORDER BY n"})
    result, ledger = ST.run_steps(spark, again, "20240102_000000", done)
    return ledger.select("sql_file", "status", "sql_hash", result.scalar().alias("orders"))


def step_new_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A step that is skipped in another session still gives its views to the next one."""
    register(spark, sf_dir, "orders")
    _none, ledger = ST.run_steps(spark, VIEW_STEP, "20240101_000000")
    later = spark.newSession()
    ledger = later.createDataFrame(ledger.collect(), LG.LEDGER_SCHEMA)
    done = ST.done_steps(ledger, LG.success_keys(ledger))
    steps = {**VIEW_STEP, "20_top.sql": "SELECT o_orderstatus, n FROM step_by_status WHERE n > 0"}
    result, _ledger = ST.run_steps(later, steps, "20240102_000000", done)
    return spark.read.schema(result.schema).parquet(result.scratch_path)


def _sql(text: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        register(spark, sf_dir, "customer", "orders", "events")
        result, _ledger = ST.run_steps(spark, {"10_step.sql": text}, "20240101_000000")
        return result

    return run


# SQL any step may use. Joins and windows run over grouped rows, so a customer
# or user with very many rows does not land in one task.
SEMI_ANTI = """
SELECT c_mktsegment, count(*) AS customers, sum(has_orders) AS with_orders
FROM (
  SELECT c_mktsegment, 1 AS has_orders FROM customer
  LEFT SEMI JOIN (SELECT DISTINCT o_custkey FROM orders) ON c_custkey = o_custkey
  UNION ALL
  SELECT c_mktsegment, 0 FROM customer
  LEFT ANTI JOIN (SELECT DISTINCT o_custkey FROM orders) ON c_custkey = o_custkey
) GROUP BY 1
"""
ROLLUP = """
SELECT c_mktsegment, o_orderstatus, sum(n) AS order_count FROM (
  SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2
) JOIN customer ON o_custkey = c_custkey
GROUP BY ROLLUP (c_mktsegment, o_orderstatus)
"""
WINDOW = """
SELECT user_id, day, day_value,
       cast(sum(day_value) OVER (PARTITION BY user_id ORDER BY day) AS double) AS running_value
FROM (
  SELECT user_id, cast(ts AS date) AS day, sum(cast(value AS decimal(18, 2))) AS day_value
  FROM events GROUP BY 1, 2
)
"""
SET_OPS = """
SELECT 'both' AS side, k FROM (SELECT c_custkey AS k FROM customer INTERSECT SELECT DISTINCT o_custkey FROM orders)
UNION ALL
SELECT 'customer only', k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT DISTINCT o_custkey FROM orders)
"""

step_semi_anti = _sql(SEMI_ANTI)
step_rollup = _sql(ROLLUP)
step_window = _sql(WINDOW)
step_set_ops = _sql(SET_OPS)


def monthly_report(spark: SparkSession, sf_dir: str, months: str) -> DataFrame:
    """Extract by month, load with history, then one SQL step: orders and value per month."""
    register(spark, sf_dir, "orders")
    rows = X.extract_cases(spark, ORDERS_OF_MONTH, {"clsYymm": months})
    root = new_scratch(spark, "monthly")
    S.write_extract(rows, f"{root}/extract", ["clsYymm"])
    extract = SRC.read_parquet(spark, f"{root}/extract", rows.schema)
    target = L.Target(spark, f"{root}/warehouse", "local", "monthly")
    L.load_parts(target, "ORDERS", extract, "clsYymm")
    # a name of its own: two runs in one session do not meet
    view = f"orders_loaded_{uuid.uuid4().hex}"
    target.table("ORDERS", rows.schema).createOrReplaceTempView(view)
    steps = {n: t.replace("{table}", view) for n, t in PER_MONTH_STEP.items()}
    result, _ledger = ST.run_steps(spark, steps, "20240101_000000")
    spark.catalog.dropTempView(view)
    return result


FOLDER = {
    "2_orders_rest.sql": """--[ORDERS__REST]
select o_orderkey, o_custkey, o_totalprice, o_orderdate from orders
where TO_CHAR(o_orderdate, 'YYYYMM') = :m and o_orderstatus <> '${done}'""",
    "1_orders_done.sql": """--[ORDERS__DONE]
select o_orderkey, o_custkey, o_totalprice, o_orderdate from orders
where TO_CHAR(o_orderdate, 'YYYYMM') = :m and o_orderstatus = '${done}'""",
    "sub/10_nation.sql": "select n_nationkey, n_name from nation",
}
FOLDER_STEPS = {
    "10_value.sql": "CREATE OR REPLACE TEMP VIEW folder_value AS SELECT m, o_custkey, count(*) AS n,"
    " sum(cast(o_totalprice AS decimal(18, 2))) AS v FROM ORDERS GROUP BY 1, 2",
    "20_nation.sql": "SELECT m, n_name, sum(n) AS order_count, cast(sum(v) AS double) AS order_value"
    " FROM folder_value JOIN customer ON o_custkey = c_custkey"
    " JOIN `10_nation` ON c_nationkey = n_nationkey GROUP BY 1, 2",
}


def folder_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of templates run twice: the second run finds nothing left but the steps."""
    register(spark, sf_dir, "orders", "nation", "customer")
    root = new_scratch(spark, "folder")
    for name, text in FOLDER.items():
        write_text(spark, f"{root}/sql/{name}", text)
    params = {"m": all_months(spark, sf_dir), "done": "F"}
    for batch in ("20240101_000000", "20240102_000000"):
        run = FD.run_folder(spark, f"{root}/sql", params, f"{root}/out", batch, FOLDER_STEPS)
    attempts = run.ledger.agg(F.count_if(F.col("status") == LG.OK))
    return run.result.select(
        "*", run.files.agg(F.count_distinct("file_hash")).scalar().alias("files"), attempts.scalar().alias("attempts")
    )


def _folder_of(spark: SparkSession, root: str, templates: dict[str, str]) -> str:
    for name, text in templates.items():
        write_text(spark, f"{root}/sql/{name}", text)
    return f"{root}/sql"


SHARED_STEP = {"1.sql": "SELECT m, o_orderstatus, count(*) AS n FROM ORD GROUP BY 1, 2"}


def _orders_of(status: str) -> str:
    return f"--[ORD]\nselect o_orderkey, o_orderstatus from orders where TO_CHAR(o_orderdate, 'YYYYMM') = :m and o_orderstatus = '{status}'"


def folder_shared_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two templates fill one table, in two runs: every row is there once."""
    register(spark, sf_dir, "orders")
    root = new_scratch(spark, "shared")
    sql = _folder_of(spark, root, {"01_a.sql": _orders_of("O"), "02_b.sql": _orders_of("F")})
    for batch in ("20240101_000000", "20240102_000000"):
        run = FD.run_folder(spark, sql, {"m": "199501:199506"}, f"{root}/out", batch, SHARED_STEP)
    return run.result


def folder_changed_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A template is written anew: its rows replace its old ones, also where it has none now."""
    register(spark, sf_dir, "orders")
    root = new_scratch(spark, "changed")
    sql = _folder_of(spark, root, {"01_a.sql": _orders_of("O"), "02_b.sql": _orders_of("F")})
    FD.run_folder(spark, sql, {"m": "199501:199506"}, f"{root}/out", "20240101_000000", SHARED_STEP)
    write_text(spark, f"{sql}/01_a.sql", _orders_of("P") + " and month(o_orderdate) <> 3")
    return FD.run_folder(spark, sql, {"m": "199501:199506"}, f"{root}/out", "20240102_000000", SHARED_STEP).result


def folder_plain_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closing signs, times in literals and comments with colons keep no template from running."""
    register(spark, sf_dir, "orders")
    root = new_scratch(spark, "plain")
    templates = {
        "01_a.sql": "-- at 12:MI\nselect o_orderkey, '10:MI:SS' as clock, TO_CHAR(o_orderdate, 'HH24:MI:SS') as hour\n"
        "from orders where TO_CHAR(o_orderdate, 'YYYYMM') = ':m'\n;\n",
        "02_b.sql": "select count(*) as n from orders where TO_CHAR(o_orderdate, 'YYYYMM') = {#m}\n/\n",
    }
    steps = {"1.sql": "SELECT a.m, a.o_orderkey, a.clock, a.hour, b.n FROM `01_A` a JOIN `02_B` b ON a.m = b.m;"}
    run = FD.run_folder(spark, _folder_of(spark, root, templates), {"m": "199501,199502"}, f"{root}/out", "20240101_000000", steps)
    found = run.lint.where("status = 'FAIL'").agg(F.count(F.lit(1))).scalar()
    return run.result.withColumn("findings", found)


def extract_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_report(spark, sf_dir, all_months(spark, sf_dir))


QUERIES = {
    "sql_step_chain": sql_step_chain,
    "report_export": report_export,
    "step_ledger": step_ledger,
    "step_new_session": step_new_session,
    "step_semi_anti": step_semi_anti,
    "step_rollup": step_rollup,
    "step_window": step_window,
    "step_set_ops": step_set_ops,
    "folder_run": folder_run,
    "folder_shared_table": folder_shared_table,
    "folder_changed_template": folder_changed_template,
    "folder_plain_templates": folder_plain_templates,
    "extract_load_report": extract_load_report,
}

_CHAIN = """with m as (select o_custkey, extract(year from o_orderdate) as order_year,
      sum(cast(o_totalprice as decimal(18, 2))) as v from orders group by 1, 2),
    n as (select r_name, n_name, order_year, sum(v) as v from m
      join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
      join region on n_regionkey = r_regionkey group by 1, 2, 3)
    select r_name, n_name, order_year, cast(v as double) as order_value,
      rank() over (partition by r_name, order_year order by v desc, n_name) as place from n"""
_HAS = "(select o_custkey from orders)"

ORACLE = {
    "sql_step_chain": _CHAIN,
    "report_export": _CHAIN,
    "step_ledger": f"""select s.sql_file, s.status, md5(s.sql) as sql_hash,
        (select count(*) from orders) as orders from (values
          ('20_broken.sql', 'FAIL', '{COUNT_STEPS["20_broken.sql"]}'),
          ('25_late.sql', 'FAIL', '{COUNT_STEPS["25_late.sql"]}'),
          ('30_report.sql', 'OK', '{COUNT_STEPS["30_report.sql"]} ORDER BY n')) s(sql_file, status, sql)""",
    "step_new_session": "select o_orderstatus, count(*) as n from orders group by 1",
    "step_semi_anti": f"""select c_mktsegment, count(*) as customers,
        sum(case when c_custkey in {_HAS} then 1 else 0 end) as with_orders from customer group by 1""",
    "step_rollup": """select c_mktsegment, o_orderstatus, count(*) as order_count
        from orders join customer on o_custkey = c_custkey
        group by rollup (c_mktsegment, o_orderstatus)""",
    "step_window": """select user_id, day, day_value,
        cast(sum(day_value) over (partition by user_id order by day) as double) as running_value from
        (select user_id, cast(ts as date) as day, sum(cast(value as decimal(18, 2))) as day_value
          from events group by 1, 2)""",
    "step_set_ops": f"""select case when c_custkey in {_HAS} then 'both' else 'customer only' end as side,
        c_custkey as k from customer""",
    "folder_run": """select strftime(o_orderdate, '%Y%m') as m, n_name, count(*) as order_count,
        cast(sum(cast(o_totalprice as decimal(18, 2))) as double) as order_value, 3 as files,
        (select 2 * (date_diff('month', min(o_orderdate), max(o_orderdate)) + 1) + 1 + 2 * 2 from orders) as attempts
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1, 2""",
    "folder_shared_table": """select strftime(o_orderdate, '%Y%m') as m, o_orderstatus, count(*) as n from orders
        where o_orderstatus in ('O', 'F') and o_orderdate < timestamp '1995-07-01' group by 1, 2""",
    "folder_changed_template": """select strftime(o_orderdate, '%Y%m') as m, o_orderstatus, count(*) as n from orders
        where o_orderdate < timestamp '1995-07-01' and (o_orderstatus = 'F'
          or (o_orderstatus = 'P' and extract(month from o_orderdate) <> 3)) group by 1, 2""",
    "folder_plain_templates": """with o as (select *, strftime(o_orderdate, '%Y%m') as m from orders)
        select m, o_orderkey, '10:MI:SS' as clock, strftime(o_orderdate, '%H:%M:%S') as hour,
          count(*) over (partition by m) as n, 2 as findings from o where m in ('199501', '199502')""",
    "extract_load_report": """select strftime(o_orderdate, '%Y%m') as cls_yymm, count(*) as order_count,
        cast(sum(cast(o_totalprice as decimal(18, 2))) as double) as order_value from orders group by 1""",
}
