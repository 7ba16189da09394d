"""Tables with keys, folder loads with broken parts, folders of templates."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parampipe.operators import load as L
from parampipe.operators import sinks as S
from parampipe.operators.keyed import KeyedTable
from parampipe.plans.folder import run_folder
from parampipe.plans.inputs import register, table
from parampipe.session import plan_text, write_text


@pytest.fixture
def keyed(spark, tmp_path):
    rows = spark.range(600).selectExpr("id as k", "concat('v', id) as v").repartitionByRange(6, "k")
    found = KeyedTable(spark, str(tmp_path / "t"), rows.schema, ("k",))
    found.upsert(rows)
    return found


def change(spark, *pairs):
    return spark.createDataFrame(pairs, "k long, v string")


def test_only_touched_files_change(spark, keyed):
    before = keyed.files()
    touched = keyed.touched(change(spark, (5, ""), (7, "")))
    assert len(touched) == 1
    keyed.upsert(change(spark, (5, "new"), (-3, "added")), gone=change(spark, (7, "")))
    assert len({*before} - {*keyed.files()}) == 1
    found = {r.k: r.v for r in keyed.read().collect()}
    assert found == {**{i: f"v{i}" for i in range(600) if i != 7}, 5: "new", -3: "added"}
    # the files without a changed key are in no plan that reads rows
    assert plan_text(keyed._rows(touched), "formatted").count("part-") <= 2


def test_an_unfinished_change_is_not_seen(spark, keyed, monkeypatch):
    def broken(self, number, files):
        raise RuntimeError("lost")

    monkeypatch.setattr(KeyedTable, "_switch", broken)
    with pytest.raises(RuntimeError):
        keyed.upsert(change(spark, (5, "new")))
    monkeypatch.undo()
    assert keyed.version() == 1 and keyed.read().where("k = 5").first().v == "v5"
    # a manifest without its mark does not count either, and is written over
    spark.createDataFrame([("nowhere",)], "file string").write.parquet(f"{keyed.path}/manifest/version=2")
    assert keyed.read().count() == 600
    assert keyed.upsert(change(spark, (5, "new"))) == 2
    assert keyed.read().where("k = 5").first().v == "new" and keyed.read(1).where("k = 5").first().v == "v5"
    assert keyed.remove_old(1) > 0 and keyed.remove_old(1) == 0 and keyed.read().count() == 600


def test_bad_changes_raise(spark, keyed):
    for rows in (change(spark, (1, "a"), (1, "b")), change(spark, (None, "a"))):
        with pytest.raises(ValueError):
            keyed.upsert(rows)
    assert keyed.version() == 1
    assert keyed.upsert(change(spark).limit(0), gone=change(spark, (1, ""), (1, ""), (9999, ""))) == 2
    assert keyed.read().count() == 599


def test_two_keys_and_an_empty_table(spark, tmp_path):
    found = KeyedTable(spark, str(tmp_path / "t"), spark.range(0).selectExpr("id as a", "'' as b", "1 as c").schema, ("a", "b"))
    assert found.read().count() == 0 and found.version() == 0
    rows = spark.createDataFrame([(1, "x", 1), (1, "y", 1)], "a long, b string, c int")
    found.upsert(rows)
    found.upsert(rows.where("b = 'y'").withColumn("c", F.lit(5)))
    assert sorted(tuple(r) for r in found.read().collect()) == [(1, "x", 1), (1, "y", 5)]


def parts(spark, path, names):
    rows = spark.createDataFrame([(i, n) for n in names for i in range(3)], "id int, part string")
    S.write_parquet(rows, path, ["part"])
    return rows.schema


def test_broken_parts_fail_alone(spark, tmp_path, monkeypatch):
    path, target = str(tmp_path / "in"), L.Target(spark, str(tmp_path / "out"), "s", "j")
    schema = parts(spark, path, [f"p{i}" for i in range(9)])
    write_text(spark, f"{path}/part=bad/part-0.parquet", "no parquet")
    tried = []
    load = L.load_parts
    monkeypatch.setattr(L, "load_parts", lambda *a, **k: tried.append(1) or load(*a, **k))
    found = {r.file_suffix: (r.status, r.row_count, bool(r.error_message)) for r in L.load_folder(target, "T", path, schema, "part").collect()}
    assert found == {**{f"p{i}": ("loaded", 3, False) for i in range(9)}, "bad": ("failed", None, True)}
    assert target.table("T", schema).count() == 27 and target.history().count() == 9
    # mended, it loads; nothing else is tried
    tried.clear()
    (tmp_path / "in/part=bad/part-0.parquet").unlink()
    parts(spark, str(tmp_path / "more"), ["bad"])
    spark.read.parquet(str(tmp_path / "more/part=bad")).write.mode("append").parquet(f"{path}/part=bad")
    again = {r.file_suffix: r.status for r in L.load_folder(target, "T", path, schema, "part").collect()}
    assert again == {**{f"p{i}": "skipped" for i in range(9)}, "bad": "loaded"} and len(tried) == 1


def test_known_parts_are_not_opened(spark, tmp_path):
    path, target = str(tmp_path / "in"), L.Target(spark, str(tmp_path / "out"), "s", "j")
    schema = parts(spark, path, ["a", "b"])
    L.load_folder(target, "T", path, schema, "part")
    for file in (tmp_path / "in").rglob("*.parquet"):
        file.write_bytes(b"broken since")
    assert {r.status for r in L.load_folder(target, "T", path, schema, "part").collect()} == {"skipped"}
    assert L.load_folder(target, "T", str(tmp_path / "none"), schema, "part").count() == 0


def test_folder_needs_its_params_and_takes_all_else(spark, sf_dir, tmp_path):
    register(spark, sf_dir, "orders")
    (tmp_path / "sql").mkdir()
    (tmp_path / "sql/1.sql").write_text("select * from orders where o_orderkey = :k")
    with pytest.raises(ValueError, match="missing params"):
        run_folder(spark, str(tmp_path / "sql"), {}, str(tmp_path / "out"), "1")
    assert not (tmp_path / "out").exists()
    (tmp_path / "sql/1.sql").write_text("select o_orderkey from orders where o_orderkey < cast(:k as bigint) or o_custkey = :k;")
    run = run_folder(spark, str(tmp_path / "sql"), {"k": "3,5"}, str(tmp_path / "out"), "1", scan_per_case=True)
    assert {(r.params, r.status) for r in run.ledger.collect()} == {("k=3", "OK"), ("k=5", "OK")}
    assert table(spark, sf_dir, "orders").count() > 0
