"""Extracts: results of templates, and the plans they run as."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parampipe.functions import templates as T
from parampipe.operators import cases as C
from parampipe.operators import extract as X
from parampipe.operators import ledger as LG
from parampipe.operators import runs as R
from parampipe.operators import sinks as S
from parampipe.plans.extract_queries import LINES_OF_MONTH, ORDERS_OF_MONTH
from parampipe.plans.inputs import register, table
from parampipe.session import plan_text

NO_JOINS = ("NestedLoop", "CartesianProduct")


@pytest.fixture(autouse=True)
def views(spark, sf_dir):
    register(spark, sf_dir, "orders", "lineitem", "customer", "events")


def test_month_reaches_the_scan(spark):
    plan = plan_text(X.extract(spark, LINES_OF_MONTH, {"clsYymm_bf": "199503"}), "formatted")
    assert "GreaterThanOrEqual(l_shipdate,1995-03-01" in plan
    assert "LessThan(l_shipdate,1995-04-01" in plan
    assert "l_tax" not in plan.split("ReadSchema")[1].splitlines()[0]


def test_all_cases_in_one_scan(spark):
    rows = X.extract_cases(spark, ORDERS_OF_MONTH, {"clsYymm": "199501:199506,"[:-1]})
    plan = plan_text(rows, "formatted")
    assert plan.count("Scan parquet") == 2  # the operator and its details
    assert "BroadcastHashJoin" in plan and not any(j in plan for j in NO_JOINS)
    assert "GreaterThanOrEqual(o_orderdate,1995-01-01" in plan
    assert "LessThan(o_orderdate,1995-07-01" in plan


def test_bad_and_missing_params(spark):
    with pytest.raises(ValueError, match="missing params"):
        X.extract(spark, ORDERS_OF_MONTH, {})
    with pytest.raises(ValueError, match="not a yyyyMM month"):
        X.extract(spark, ORDERS_OF_MONTH, {"clsYymm": "199513"})
    with pytest.raises(Exception):
        X.extract_cases(spark, ORDERS_OF_MONTH, {"clsYymm": "199513"}).collect()


def test_values_are_no_sql(spark):
    text = "select count(*) as n from orders where o_orderstatus = ':s'"
    assert X.extract(spark, text, {"s": "F' or 'a' = 'a"}).first().n == 0


def test_two_names_with_a_common_start(spark):
    """No equi-join form: it raises, and runs per case when asked to."""
    text = """select o_orderkey from orders where TO_CHAR(o_orderdate, 'YYYYMM') = :m
              or TO_CHAR(o_orderdate, 'YYYYMM') = ':m_bf'"""
    with pytest.raises(ValueError, match="scan_per_case"):
        X.extract_cases(spark, text, {"m": "199503", "m_bf": "199502"})
    rows = X.extract_cases(spark, text, {"m": "199503,199504", "m_bf": "199502"}, scan_per_case=True)
    assert not any(j in plan_text(rows) for j in NO_JOINS)
    orders = spark.table("orders").withColumn("k", F.date_format("o_orderdate", "yyyyMM"))
    count = {r.k: r["count"] for r in orders.groupBy("k").count().collect()}
    got = {(r.m, r.m_bf): r["count"] for r in rows.groupBy("m", "m_bf").count().collect()}
    assert got == {
        (m, "199502"): count.get(m, 0) + count.get("199502", 0) for m in ("199503", "199504")
    }


def test_template_without_params_and_unused_params(spark):
    assert X.extract_cases(spark, "select * from customer;", {"x": "1,2"}).columns[0] == "c_custkey"


def test_other_month_texts(spark):
    text = "select TO_CHAR(o_orderdate, 'yyyymm') as m, count(*) as n from orders group by 1"
    assert {len(r.m) for r in X.extract(spark, text, {}).collect()} == {6}


def test_empty_case_keeps_the_schema(spark):
    none = C.case_table(spark, {"clsYymm": "190001"})
    rows = X.extract_by_month(spark.table("orders"), "o_orderdate", none, "clsYymm")
    assert rows.count() == 0 and set(rows.columns) == {*spark.table("orders").columns, "clsYymm"}
    nothing = X.extract_by_month(spark.table("orders"), "o_orderdate", none.limit(0), "clsYymm")
    assert nothing.count() == 0 and set(nothing.columns) == set(rows.columns)


def test_write_is_rebalanced_by_case(spark):
    plan = plan_text(S.by_case(spark.table("orders"), ["o_orderstatus"]))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_groups_are_cut_before_the_shuffle(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    plan = plan_text(S.keep_latest(events, ["user_id"], [F.col("ts").desc()]))
    assert plan.index("Partial") > plan.index("Exchange") > plan.index("Final")


def test_top_k_plan(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumnRenamed("value", "elapsed_sec")
    assert "TakeOrderedAndProject" in plan_text(LG.slowest(events, [F.col("event_id")]))


def test_attempts_use_hash_aggregates(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("status", F.lit("OK"))
    texts = events.withColumn("batch_ts", F.date_format("ts", LG.BATCH_FORMAT))
    for plan in (
        plan_text(LG.success_keys(events, ["user_id"], order="ts")),
        plan_text(LG.success_keys(texts, ["user_id"])),
    ):
        assert "HashAggregate" in plan and "Sort" not in plan


def test_latest_batch_prunes_partitions(spark, tmp_path):
    rows = spark.range(20).selectExpr(
        "concat('2024010', id % 3 + 1) as batch_ts", "'h' as host", "cast(id as string) as sql_file",
        "'-' as params", "'x' as sql_hash", "'OK' as status", "id as rows", "1.005 as elapsed_sec",
        "cast(null as string) as output_file", "repeat('e', 900) as error_message",
    )
    path = str(tmp_path / "ledger")
    LG.append_rows(rows.where("id < 7"), path)
    LG.append_rows(rows.where("id >= 7"), path)
    ledger = LG.read_ledger(spark, path)
    assert ledger.count() == 20 and len(ledger.first().error_message) == 900
    newest = LG.latest_batch(ledger)
    assert {r.batch_ts for r in newest.collect()} == {"20240103"}
    assert "PartitionFilters: [isnotnull(batch_ts" in plan_text(newest)
    assert LG.read_ledger(spark, str(tmp_path / "none")).count() == 0


def test_failed_runs_are_taken_up_again(spark, sf_dir, tmp_path):
    spark.table("orders").limit(0).createOrReplaceTempView("late_orders")
    text = "select * from late_orders where TO_CHAR(o_orderdate, 'YYYYMM') = :m and o_custkey / :z >= 0"
    paths = [str(tmp_path / "out"), str(tmp_path / "ledger")]

    def run(batch, **params):
        rows = R.run_extract(spark, "t.sql", text, params, *paths, batch, scan_per_case=True).collect()
        return {(r.params, r.status, r.rows) for r in rows}

    assert run("1", m="199503", z="1") == {("m=199503, z=1", "OK", 0)}
    register(spark, sf_dir, "orders")
    spark.table("orders").createOrReplaceTempView("late_orders")
    failed = R.run_extract(spark, "t.sql", text, {"m": "199503", "z": "0"}, *paths, "2", scan_per_case=True).collect()
    assert [r.status for r in failed] == ["FAIL"] and "ZERO" in failed[0].error_message
    again = R.run_extract(spark, "t.sql", text, {"m": "199503", "z": "0,1,2"}, *paths, "3", scan_per_case=True).collect()
    assert {(r.params, r.status) for r in again} == {("m=199503, z=0", "FAIL"), ("m=199503, z=2", "OK")}
    assert len({r.elapsed_sec for r in again}) == 2 and not [r for r in again if r.elapsed_sec < 0]
    month = spark.table("orders").where("date_format(o_orderdate, 'yyyyMM') = '199503'").count()
    assert run("4", m="199503", z="2,3") == {("m=199503, z=3", "OK", month)}
    assert run("5", m="199503", z="2,3") == set()


def test_repeated_values_make_one_case(spark):
    rows = X.extract_cases(spark, ORDERS_OF_MONTH, {"clsYymm": "199503,199503"})
    month = spark.table("orders").where("date_format(o_orderdate, 'yyyyMM') = '199503'").count()
    assert rows.count() == month


def test_month_ranges_reach_the_scan_once(spark):
    text = "select o_orderkey from orders where TO_CHAR(o_orderdate, 'YYYYMM') between :a and :b"
    for rows in (
        X.extract(spark, text, {"a": "199502", "b": "199504"}),
        X.extract_cases(spark, text, {"a": "199502", "b": "199502:199504"}),
    ):
        plan = plan_text(rows, "formatted")
        assert plan.count("Scan parquet") == 2
        assert "GreaterThanOrEqual(o_orderdate,1995-02-01" in plan
        assert "LessThan(o_orderdate,1995-05-01" in plan
        assert not any(j in plan for j in NO_JOINS)


@pytest.mark.parametrize("sign, months", [(">=", (2, 99)), (">", (3, 99)), ("<", (0, 1)), ("<=", (0, 2))])
def test_one_sided_month_tests(spark, sign, months):
    text = f"select o_orderdate from orders where TO_CHAR(o_orderdate, 'YYYYMM') {sign} :m"
    found = X.extract(spark, text, {"m": "199502"})
    key = F.expr("(year(o_orderdate) - 1995) * 12 + month(o_orderdate)")
    assert found.count() == spark.table("orders").where(key.between(*months)).count()
    assert "1995-0" in plan_text(found, "formatted").split("PushedFilters")[1].splitlines()[0]


def test_ranges_of_aggregates_need_a_scan_each(spark):
    text = "select count(*) as n from orders where TO_CHAR(o_orderdate, 'YYYYMM') between :a and :b"
    with pytest.raises(ValueError, match="scan_per_case"):
        X.extract_cases(spark, text, {"a": "199501", "b": "199502,199503"})
    rows = X.extract_cases(spark, text, {"a": "199501", "b": "199502,199503"}, scan_per_case=True)
    assert rows.count() == 2


def test_own_cross_join_of_a_template_stays(spark, sf_dir):
    register(spark, sf_dir, "nation")
    text = "select o_orderkey, n_name from orders cross join nation where TO_CHAR(o_orderdate, 'YYYYMM') = :m"
    plan = plan_text(X.extract_cases(spark, text, {"m": "199501:199512"}), "formatted")
    assert plan.count("Scan parquet") == 4


def test_literals_and_comments(spark):
    text = "select '${x}-a', ':y', ':z:w', \"${q}\" /* :c */ from t_${x} -- ${d}\n where a = :y ; /* e */"
    marked = T.to_markers(text)
    assert T.marker_names(marked) == ["x", "y"] and T.table_names(marked) == ["x"]
    assert "concat(:x, '-a')" in marked and "':z:w'" in marked and "IDENTIFIER(concat('t_', :x))" in marked
    with pytest.raises(ValueError, match="missing params"):
        X.extract(spark, "select * from orders where o_orderpriority like '${p}%'", {})


def test_too_many_cases_raise(spark, monkeypatch):
    monkeypatch.setattr(X, "BROADCAST_CASES", 3)
    monkeypatch.setattr(X, "MOST_CASES", 5)
    text = "select * from orders where o_orderstatus = :s and TO_CHAR(o_orderdate, 'YYYYMM') = :m"
    rows = X.extract_cases(spark, text, {"s": "F,O", "m": "199501,199502"})
    assert rows.select("s", "m").distinct().count() == 4
    with pytest.raises(ValueError, match="more than 5 cases"):
        X.extract_cases(spark, text, {"s": "F,O", "m": "199501:199512"})


NESTED_PARAMS = {"m": "199501:199506", "s": "BUILDING,MACHINERY", "f": "R,A"}
NESTED_TEMPLATES = {
    "several blocks": """select o_orderkey from orders o where TO_CHAR(o_orderdate, 'YYYYMM') = :m
        and o_custkey in (select c_custkey from customer where c_mktsegment = :s)
        and exists (select * from lineitem l where l.l_orderkey = o.o_orderkey and l.l_returnflag = ':f')""",
    "block in a block": """select * from orders where o_custkey in (select c_custkey from customer
        where c_mktsegment = :s and c_custkey in (select o_custkey from orders where TO_CHAR(o_orderdate, 'YYYYMM') = :m))""",
    "aggregate": """select count(*) as n, max(o_custkey) as k from orders
        where o_custkey in (select c_custkey from customer where c_mktsegment = :s) and o_orderstatus = 'F'""",
    "no row for a case": "select count(*) as n from orders where o_custkey in (select c_custkey from customer where c_name = :m)",
    "flag": """select o_orderkey from orders where TO_CHAR(o_orderdate, 'YYYYMM') = :m
        and not exists (select 1 from customer where c_mktsegment = :s and c_acctbal > 9990)""",
    "select list": """select o_orderkey, (select count(*) from lineitem l where l.l_orderkey = o.o_orderkey
        and l.l_returnflag = :f) as n from orders o where TO_CHAR(o_orderdate, 'YYYYMM') = :m""",
    "derived": """select c_nationkey, t.n from (select c_nationkey, count(*) as n from customer
        where c_mktsegment = :s and c_custkey in (select o_custkey from orders where TO_CHAR(o_orderdate, 'YYYYMM') = :m)
        group by c_nationkey) t where t.n > 0""",
    "tables": """with b as (select * from customer where c_mktsegment = :s), n as (select c_nationkey k, count(*) c from b group by 1)
        select x.k, x.c, '(select :s)' as text from n as x join n on n.k = x.k where x.c > 1 order by 1""",
}


def per_case(spark, template, params):
    names = T.marker_names(T.to_markers(template))
    return X._union_of_cases(spark, template, C.case_table(spark, params, names), names)


def same_rows(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("kind", sorted(NESTED_TEMPLATES))
def test_nested_params_equal_the_single_runs(spark, kind):
    rows = X.extract_cases(spark, NESTED_TEMPLATES[kind], NESTED_PARAMS)
    assert not any(j in plan_text(rows) for j in NO_JOINS)
    same_rows(rows, per_case(spark, NESTED_TEMPLATES[kind], NESTED_PARAMS))


def test_nested_params_read_each_table_once(spark):
    rows = X.extract_cases(spark, NESTED_TEMPLATES["several blocks"], NESTED_PARAMS)
    assert plan_text(rows).count("FileScan parquet") == 3


@pytest.mark.parametrize(
    "text",
    [
        "select o_orderkey from orders where o_custkey not in (select c_custkey from customer where c_mktsegment = :s)",
        "select o_orderkey from orders where o_custkey < 9 or o_custkey in (select c_custkey from customer where c_mktsegment = :s)",
        "select 1 as a union all select c_custkey from customer where c_custkey in (select 1 from customer where c_mktsegment = :s)",
        "select n from (select count(*) as n from customer) where n > (select count(*) from customer where c_mktsegment = :s)",
    ],
)
def test_what_has_no_key_runs_per_case_when_asked(spark, text):
    with pytest.raises(ValueError):
        X.extract_cases(spark, text, NESTED_PARAMS)
    same_rows(X.extract_cases(spark, text, NESTED_PARAMS, scan_per_case=True), per_case(spark, text, NESTED_PARAMS))


def test_scalar_block_with_several_rows_fails(spark):
    text = """select o_orderkey from orders where TO_CHAR(o_orderdate, 'YYYYMM') = :m
        and o_custkey = (select c_custkey from customer where c_mktsegment = :s)"""
    with pytest.raises(Exception, match="more than one row"):
        X.extract_cases(spark, text, NESTED_PARAMS).collect()


RANGE_PARAMS = {
    "a": "1995-03-01,1995-07-15,1996-01-01,1999-12-31", "b": "1995-03-02,1995-08-15,1997-01-01", "m": "199501:199506",
    "lo": "0,1000,50000,99999999", "hi": "1000,1001,70000", "st": "F,O", "y": "1995,1997", "h": "20240103 05,20240103 06",
}
RANGE_TEMPLATES = [
    "select o_orderkey, o_orderdate from orders where o_orderdate >= to_date(:a) and o_orderdate < to_date(:b)",
    "select * from orders where :a <= o_orderdate and cast(:b as date) > o_orderdate and o_orderstatus = 'F'",
    "select o_orderkey from orders where o_orderdate between to_date(:a) and to_date(:b)",
    "select o_orderkey from orders o where o.o_totalprice >= cast(:lo as double) and o.o_totalprice <= cast(:hi as double)",
    "select o_orderkey from orders where o_totalprice > :lo",
    "select o_orderkey from orders where o_custkey between :lo and :hi and o_custkey + 1 > :lo",
    "select o_orderkey from orders where TO_CHAR(o_orderdate, 'YYYYMM') > :m",
    "select o_orderkey from orders where TO_CHAR(o_orderdate, 'YYYY') <= :y",
    "select o_orderkey from orders where TO_CHAR(o_orderdate, 'YYYY-MM-DD') between :a and :b",
    "select o_orderkey from orders where TO_CHAR(o_orderdate, 'YYYYMM') >= :m and o_orderstatus = :st",
]


@pytest.mark.parametrize("text", RANGE_TEMPLATES)
def test_ranges_equal_the_single_runs(spark, text):
    rows = X.extract_cases(spark, text, RANGE_PARAMS)
    assert not any(j in plan_text(rows) for j in NO_JOINS)
    same_rows(rows, per_case(spark, text, RANGE_PARAMS))


def test_a_thousand_ranges_are_one_scan(spark):
    text = "select o_orderkey from orders where o_orderdate >= to_date(:a) and o_orderdate < to_date(:b)"
    days = spark.range(1000).selectExpr("date_add(date'1995-01-01', cast(id as int)) as d", "cast(id % 90 as int) as n")
    cases = days.selectExpr("cast(d as string) as a", "cast(date_add(d, n) as string) as b")
    rows = X.extract_cases(spark, text, {}, cases=cases)
    assert plan_text(rows).count("o_orderdate") and not any(j in plan_text(rows) for j in NO_JOINS)
    orders = spark.table("orders").select("o_orderkey", "o_orderdate")
    plain = orders.join(cases, F.expr("o_orderdate >= to_date(a) and o_orderdate < to_date(b)"))
    same_rows(rows, plain.select("a", "b", "o_orderkey"))


def test_ranges_that_meet_no_row(spark):
    text = "select o_orderkey from orders where o_orderdate >= to_date(:a) and o_orderdate < to_date(:b)"
    assert X.extract_cases(spark, text, {"a": "1997-01-01", "b": "1996-01-01"}).count() == 0
    none = C.case_table(spark, {"a": "1", "b": "2"}).where("false")
    assert X.extract_cases(spark, text, {}, cases=none).count() == 0


DATE_FORMS = [
    ("extract(year from o_orderdate) = :p", "1995", "1995-01-01", "1996-01-01"),
    ("TO_CHAR(o_orderdate, 'YYYY') = :p", "1996", "1996-01-01", "1997-01-01"),
    ("TO_CHAR(o_orderdate, 'YYYY-MM') = ':p'", "1995-12", "1995-12-01", "1996-01-01"),
    ("to_char(o_orderdate, 'YYYYMMDD') = :p", "19960229", "1996-02-29", "1996-03-01"),
    ("trunc(o_orderdate, 'MONTH') = to_date(:p, 'YYYYMM')", "199502", "1995-02-01", "1995-03-01"),
    ("TO_CHAR(o_orderdate, 'YYYYMMDD HH24:MI') = :p", "19950201 23:59", "1995-02-01T23:59", "1995-02-02T00:00"),
]


@pytest.mark.parametrize("form, value, first, stop", DATE_FORMS)
def test_date_texts_reach_the_scan(spark, form, value, first, stop):
    text = f"select o_orderkey from orders where {form}"
    single = X.extract(spark, text, {"p": value})
    many = X.extract_cases(spark, text, {"p": value})
    for rows in (single, many):
        plan = plan_text(rows, "formatted")
        assert f"GreaterThanOrEqual(o_orderdate,{first}" in plan and f"LessThan(o_orderdate,{stop}" in plan
    moments = (x.replace("T", " ") + ":00" * ("T" in x) for x in (first, stop))
    expected = spark.table("orders").where("o_orderdate >= '{}' and o_orderdate < '{}'".format(*moments)).count()
    assert single.count() == many.count() == expected
    with pytest.raises(ValueError, match="not a"):
        X.extract(spark, text, {"p": value + "x"})


def test_date_texts_that_are_no_test(spark):
    text = "select o_orderkey from orders where TO_CHAR(o_orderdate, 'DD') = :p"
    expected = spark.table("orders").where("day(o_orderdate) = 7").count()
    assert X.extract(spark, text, {"p": "07"}).count() == X.extract_cases(spark, text, {"p": "07"}).count() == expected > 0
    assert X.extract(spark, "select TO_CHAR(d, 'YYYY/MM/DD') as t from (select date'2024-03-05' as d)", {}).first().t == "2024/03/05"
