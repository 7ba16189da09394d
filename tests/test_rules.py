"""Rule tables: parameter expansion, names, placeholders, lint, typing."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from parampipe.functions import naming as N
from parampipe.functions import params as P
from parampipe.functions import templates as T
from parampipe.operators import audit as A
from parampipe.operators import cases as C
from parampipe.operators import profile as PR
from parampipe.operators import sinks as S


def values(spark, column, rows, schema):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize(
    ("spec", "expected"),
    [
        ("202403", ["202403"]),
        (" 202403, 202312", ["202403", "202312"]),
        ("202403,,202312", ["202403", "202312"]),
        ("202311:202402", ["202311", "202312", "202401", "202402"]),
        ("202401:202412~Q", ["202403", "202406", "202409", "202412"]),
        ("202401:202412~h", ["202406", "202412"]),
        ("202301:202412~ Y ", ["202312", "202412"]),
        ("202401:202403~Z", ["202401", "202402", "202403"]),
        ("202402:202311~Q", []),
        ("202401:202403,202405", ["202401:202403", "202405"]),
        ("abc", ["abc"]),
        ("", [""]),
    ],
)
def test_expand_spec(spark, spec, expected):
    assert values(spark, P.expand_spec("s"), [spec], "s string") == [expected]


@pytest.mark.parametrize("spec", ["202402:202311", "202413:202414", "202400:202401"])
def test_bad_ranges_raise(spark, spec):
    with pytest.raises(PySparkException):
        values(spark, P.expand_spec("s"), [spec], "s string")


@settings(max_examples=10, deadline=None)
@given(st.integers(1900 * 12, 2100 * 12), st.integers(0, 60))
def test_month_ranges_are_complete(spark, first, length):
    def text(n):
        return f"{n // 12:04d}{n % 12 + 1:02d}"

    [got] = values(spark, P.expand_spec("s"), [f"{text(first)}:{text(first + length)}"], "s string")
    assert got == [text(n) for n in range(first, first + length + 1)]


def test_cases(spark):
    params = {"b": "x,y", "a": "1,2,3"}
    product = C.case_table(spark, params)
    assert sorted(map(tuple, product.collect())) == [(a, b) for a in "123" for b in "xy"]
    assert "Join" not in product._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, C.case_table(spark, params, mode="zip").collect())) == [
        ("1", "x"),
        ("2", "y"),
    ]
    assert C.case_table(spark, {"a": "202402:202401~Q", "b": "1"}, mode="zip").count() == 0
    assert C.case_table(spark, params, names=["a"]).columns == ["a"]
    assert C.case_table(spark, params, names=[]).count() == 1
    with pytest.raises(ValueError, match="missing params"):
        C.case_table(spark, params, names=["c"])


def test_overrides(spark):
    got = values(spark, P.parse_overrides("p"), [(["a=1", " b = x=y ", "a=2"],)], "p array<string>")
    assert got == [{"a": "2", "b": "x=y"}]
    with pytest.raises(PySparkException):
        values(spark, P.parse_overrides("p"), [(["oops"],)], "p array<string>")


def test_split_suffix(spark):
    names = ["a1_202312", "rate", "01_a1", "x_1_2", "rate.v1", "a.b_7"]
    got = values(spark, N.split_suffix(F.col("s")), names, "s string")
    assert [tuple(r) for r in got] == [
        ("A1", "_202312"),
        ("RATE", ""),
        ("01_A1", ""),
        ("X_1", "_2"),
        ("RATE", ""),
        ("A.B", "_7"),
    ]


def test_case_names(spark):
    maps = [
        ({"baseYymm": "202301", "clsYymm": "202302"},),
        ({"b": "2", "a": "2024/03 v1"},),
        ({"a": "é x"},),
        ({},),
    ]
    got = values(spark, N.case_suffix(F.col("m")), maps, "m map<string,string>")
    assert got == ["_202302", "_202403v1", "_éx", ""]
    label = N.case_label(F.lit("01_a1"), F.lit("local"), F.col("m"))
    assert values(spark, label, [({"b": "x y", "a": "1"},)], "m map<string,string>") == [
        "01_a1__local__a_1__b_x_y"
    ]
    bare = N.case_label(F.lit("01_a1"), F.lit(""), F.col("m"))
    assert values(spark, bare, [({},)], "m map<string,string>") == ["01_a1"]
    text = values(spark, N.describe_case(F.col("m")), [({"b": "2", "a": "1"},), ({},)], "m map<string,string>")
    assert text == ["a=1, b=2", "-"]


def test_file_and_table_names(spark):
    files = ["01_a1__local__clsYymm_202003.csv.gz", "a.csv", "b__x.csv"]
    assert values(spark, N.template_of_file(F.col("s")), files, "s string") == ["01_a1", "a", "b"]
    texts = ["--[T1]\nselect", "\n  --[ T2 ] \nselect", "select 1\n--[T3]", "-- [T4]\nx", "--[T5]"]
    got = values(spark, N.table_of_template(F.col("s"), F.lit("stem")), texts, "s string")
    assert got == ["T1", "T2", "stem", "stem", "T5"]


def test_placeholders_and_lint(spark):
    texts = ["a=:k and b={#z} and c=${q} and d=:k", "x::int", "select 1;\n", "a\n/\nb", ":a:b ::c"]
    names = values(spark, T.placeholder_names(F.col("s")), texts, "s string")
    assert names == [["k", "q", "z"], [], [], [], ["a", "b"]]
    corpus = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    report = {r.i: r for r in A.lint_report(corpus, ["k", "a"]).collect()}
    assert report[0].issues == "missing params ['q', 'z']" and report[0].status == "FAIL"
    assert report[1].issues == "" and report[1].status == "OK"
    assert report[2].issues == "ends with ';'"
    assert report[3].issues == "contains '/'"
    assert report[4].params_used == "a,b" and report[4].params_missing == "b"
    assert A.gate(A.lint_report(corpus, ["k"]))
    assert not A.gate(A.lint_report(corpus.where("i = 1"), []))


def test_statement_ends(spark):
    texts = [" select 1 ; / \n;", "a;\n/", "b", "c;;"]
    assert values(spark, T.strip_end(F.col("s")), texts, "s string") == ["select 1", "a", "b", "c"]
    assert values(spark, T.normalize(F.col("s")), ["a;\n/\nb;", " c;; "], "s string") == ["a;\n\nb", "c;"]


def test_markers():
    text = "select * from t where a = ':x' and b = {#y} and c = '${z}' and d = :x_bf and e::int = 1 ;\n/"
    marked = T.to_markers(text)
    assert marked == "select * from t where a = :x and b = :y and c = :z and d = :x_bf and e::int = 1"
    assert T.marker_names(marked) == ["x", "x_bf", "y", "z"]
    assert T.replace_marker(marked, "x", "c.x").count("c.x") == 1


def test_render(spark):
    corpus = spark.createDataFrame(
        [("f.sql", "select :a, :a_b, {#a}, ${a}, a::int, :zz, ':aé'\nfrom t ;")], "name string, text string"
    )
    plan = A.render_plan(corpus, "name", {"a": F.lit("1,$2"), "a_b": F.lit("x\\1")}).collect()
    bodies = {r.params: r.rendered.split("\n\n", 1)[1] for r in plan}
    assert bodies == {
        "a=1, a_b=x\\1": "select 1, x\\1, 1, 1, a::int, :zz, ':aé'\nfrom t",
        "a=$2, a_b=x\\1": "select $2, x\\1, $2, $2, a::int, :zz, ':aé'\nfrom t",
    }
    assert plan[0].rendered.startswith("-- ======================================\n-- FILE: f.sql\n-- PARAMS:\n--   a = ")


def test_preview(spark):
    lines = [f"line {i}" for i in range(30)]
    rows = [("\n".join(lines),), ("\r\n".join(lines[:3]) + "\r\n",), ("\n".join(["x"] * 20),)]
    df = spark.createDataFrame(rows, "text string")
    hit = A.with_preview(df, "text", F.array(F.lit("line 8"), F.lit("line 11"))).collect()
    assert hit[0].preview == "\n".join(lines[3:17])
    assert hit[1].preview == "\n".join(lines[:3])
    assert hit[2].preview == "\n".join(["x"] * 10)


def test_column_rules():
    rules = S.types_by_name(["o_orderkey", "user_id", "l_discount", "PAID_AMT", "l_tax"])
    assert rules == {
        "o_orderkey": "string",
        "user_id": "string",
        "l_discount": "numeric",
        "PAID_AMT": "string",
    }


def test_column_widths(spark):
    df = spark.createDataFrame(
        [("x" * 10, "y" * 50, None, 5), (None, "y", None, 12345)], "a string, b string, longheader string, n int"
    )
    got = {r.column_name: (r.width, r.is_numeric) for r in PR.column_width_profile(df).collect()}
    assert got == {"a": (14, False), "b": (50, False), "longheader": (14, False), "n": (8, True)}


def test_next_sequence(spark):
    rows = [("g", "job_01"), ("g", "job_07"), ("g", "job_x"), ("h", "other_9")]
    df = spark.createDataFrame(rows, "g string, name string")
    got = PR.next_sequence(df, F.col("name"), F.lit("job_"), ["g"]).collect()
    assert {(r.g, r.next_label) for r in got} == {("g", "08"), ("h", "01")}
