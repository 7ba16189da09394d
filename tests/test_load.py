"""Loads: once per part, safe to repeat, whole after a crash; files and streams."""

from __future__ import annotations

import os
import shutil

import pytest
from pyspark.sql import functions as F

from parampipe.functions.hashing import fingerprint
from parampipe.operators import filters as FL
from parampipe.operators import load as L
from parampipe.operators import profile as P
from parampipe.operators import sinks as S
from parampipe.operators import views as V
from parampipe.operators.numbering import with_ordinal
from parampipe.session import delete_path, plan_text
from parampipe.sources import files as SRC
from parampipe.sources import jdbc as J
from parampipe.streaming import csv_stream, ingest


@pytest.fixture
def extract(spark, tmp_path):
    rows = spark.range(100).selectExpr("id", "id * 1.5 as amount", "concat('_', id % 4) as file_suffix")
    S.write_parquet(rows, str(tmp_path / "extract"), ["file_suffix"])
    return SRC.read_parquet(spark, str(tmp_path / "extract"), rows.schema)


@pytest.fixture
def target(spark, tmp_path):
    return L.Target(spark, str(tmp_path / "db"), "local", "job")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_load_twice_is_load_once(target, extract):
    assert L.load_parts(target, "T", extract.where("file_suffix < '_2'"), "file_suffix").count() == 2
    assert L.load_parts(target, "T", extract, "file_suffix").count() == 2
    assert L.load_parts(target, "T", extract, "file_suffix").count() == 0
    assert ids(target.table("T", extract.schema)) == list(range(100))
    assert target.history().count() == 4
    # another table, another history
    assert L.load_parts(target, "U", extract, "file_suffix").count() == 4


def test_part_without_a_suffix(target, extract, monkeypatch):
    """A file without a suffix is a part like any other."""
    rows = extract.withColumn("file_suffix", F.nullif("file_suffix", F.lit("_3")))
    assert L.load_parts(target, "T", rows, "file_suffix").count() == 4
    assert L.load_parts(target, "T", rows, "file_suffix").count() == 0
    assert ids(target.table("T", extract.schema)) == list(range(100))
    monkeypatch.setattr(L, "PRUNED_PARTS", 0)
    assert L.load_parts(target, "U", rows, "file_suffix").count() == 4
    assert ids(target.table("U", extract.schema)) == list(range(100))


def test_crash_between_data_and_history(target, extract, spark):
    L.load_parts(target, "T", extract, "file_suffix")
    shutil.rmtree(target.history_path)
    L.load_parts(target, "T", extract, "file_suffix")
    assert ids(target.table("T", extract.schema)) == list(range(100))


def test_same_rows_under_two_names_load_once(target, extract):
    twins = extract.unionAll(
        extract.where("file_suffix = '_0'").withColumn("file_suffix", F.lit("_copy"))
    )
    L.load_parts(target, "T", twins, "file_suffix", identity=L.BY_HASH)
    assert ids(target.table("T", extract.schema)) == list(range(100))
    again = extract.withColumn("file_suffix", F.concat(F.lit("new"), "file_suffix"))
    assert L.load_parts(target, "T", again, "file_suffix", identity=L.BY_HASH).count() == 0
    changed = again.withColumn("amount", F.when(F.col("id") == 4, -1).otherwise(F.col("amount")))
    loaded = L.load_parts(target, "T", changed, "file_suffix", identity=L.BY_HASH)
    assert [r.file_suffix for r in loaded.collect()] == ["new_0"]


def test_retry_replaces(target, extract):
    L.load_parts(target, "T", extract, "file_suffix")
    L.load_parts(target, "T", extract.where("file_suffix = '_1'"), "file_suffix", retry=True)
    assert ids(target.table("T", extract.schema)) == list(range(100))


def test_pending_parts_prune_the_scan(target, extract, monkeypatch):
    wanted = target.spark.createDataFrame([("_1",)], "file_suffix string")
    pruned = L.rows_of_parts(extract, "file_suffix", wanted)
    assert len({os.path.dirname(f) for f in pruned.inputFiles()}) <= 4
    assert ids(pruned) == [i for i in range(100) if i % 4 == 1]
    monkeypatch.setattr(L, "PRUNED_PARTS", 0)
    assert "LeftSemi" in plan_text(L.rows_of_parts(extract, "file_suffix", wanted))
    assert ids(L.rows_of_parts(extract, "file_suffix", wanted)) == ids(pruned)


def test_fingerprints(spark):
    a = spark.createDataFrame([(1, None, "x"), (1, "x", None), (2, "y", "z")], "g int, a string, b string")

    def print_of(df):
        return {r.g: r.fingerprint for r in fingerprint(df, ["g"]).collect()}

    base = print_of(a)
    assert base == print_of(a.orderBy(F.desc("g"), "a").repartition(3))
    moved = a.withColumn("b", F.when(F.col("a").isNull(), None).otherwise(F.col("b"))).withColumn(
        "a", F.when(F.col("g") == 1, F.coalesce("a", F.lit("x"))).otherwise(F.col("a"))
    )
    assert print_of(moved)[1] != base[1] and print_of(moved)[2] == base[2]
    assert print_of(a.unionAll(a))[2] != base[2]


def test_csv_keeps_values(spark, tmp_path):
    rows = [
        (1, 'a "quoted", text\nsecond line\r\nthird', "  spaced  ", ""),
        (2, "back\\slash", None, "x"),
        (3, "'; --", "é", None),
    ]
    df = spark.createDataFrame(rows, "i int, a string, b string, c string").withColumn(
        "t", F.expr("timestamp_ntz'2024-01-02 03:04:05.678901'")
    )
    for compression in ("none", "gzip"):
        path = str(tmp_path / compression)
        S.write_csv(df, path, compression=compression)
        back = SRC.read_csv(spark, path, df.schema, multi_line=True)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_inferred_types(spark, tmp_path):
    df = spark.createDataFrame(
        [
            ("1", "001", "1.5", "2024-01-02", "2024-01-02 03:04:05", "true", "-3", "1e5", None, "9223372036854775808", "2024-01-02", "+-1"),
            ("20", "2", None, "2024-02-30", "2024-01-02T03:04:05.5", "False", "0", "-2E-3", None, "1", "2024-12-31", "3"),
        ],
        "i string, z string, d string, baddate string, t string, b string, n string, e string, none string, big string, day string, junk string",
    )
    kinds = {f.name: f.dataType.simpleString() for f in SRC.infer_types(df)}
    assert kinds == {
        "i": "bigint", "z": "string", "d": "double", "baddate": "string", "t": "timestamp_ntz",
        "b": "boolean", "n": "bigint", "e": "double", "none": "string", "big": "double",
        "day": "date", "junk": "string",
    }
    assert SRC.infer_types(df.select()).fields == []
    assert {f.dataType.simpleString() for f in SRC.infer_types(df.limit(0))} == {"string"}
    S.convert_typed(df.selectExpr("i as user_id", "junk as amt", "d as price", "day"), str(tmp_path / "p"))
    out = spark.read.parquet(str(tmp_path / "p"))
    assert out.schema.simpleString() == "struct<user_id:string,amt:double,price:double,day:string>"
    assert sorted((r.amt is None, r.price is None) for r in out.collect()) == [(False, True), (True, False)]


def test_empty_extract_has_a_header(spark, tmp_path):
    S.write_csv(spark.range(5).where("id < 0"), str(tmp_path / "empty"), compression="none")
    assert SRC.read_csv_raw(spark, str(tmp_path / "empty")).columns == ["id"]


def test_existing_cases(spark, tmp_path):
    rows = spark.createDataFrame([("0001", "a b/c+d%"), ("0002", None)], "m string, s string")
    for name, write in (("p", S.write_parquet), ("c", S.write_csv)):
        path = str(tmp_path / name)
        write(rows.withColumn("v", F.lit(1)), path, ["m", "s"])
        got = S.existing_cases(spark, path, ["m", "s"]).collect()
        assert {tuple(r) for r in got} == {("0001", "a b/c+d%"), ("0002", None)}
    assert S.existing_cases(spark, str(tmp_path / "no"), ["m"]).count() == 0


def test_versions(spark, tmp_path):
    for version in ("20240101", "20240102", "20240103"):
        S.write_version(spark.range(3), str(tmp_path / "v"), version)
    S.write_version(spark.range(7), str(tmp_path / "v"), "20240103")
    kept = S.read_versions(spark, str(tmp_path / "v"), spark.range(1).schema, keep=2)
    assert {r.version: r["count"] for r in kept.groupBy("version").count().collect()} == {
        "20240102": 3,
        "20240103": 7,
    }


def test_observed_rows(spark, tmp_path):
    rows, progress = S.observe_rows(spark.range(42))
    rows.write.parquet(str(tmp_path / "o"))
    assert progress.get == {"rows": 42}


def test_inventory_and_corpus(spark, tmp_path):
    for name, text in {"a/01_x.sql": "--[T]\nselect 1", "top.sql": "select 2", "_backup/y.sql": "z", "a/n.txt": "no"}.items():
        file = tmp_path / "sql" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(text)
    files = SRC.file_inventory(spark, str(tmp_path / "sql"), with_hash=True, pattern="*.sql").collect()
    assert {r.file_size for r in files} == {14, 8} and all(len(r.file_hash) == 64 for r in files)
    corpus = {r.sql_path: r for r in SRC.template_corpus(spark, str(tmp_path / "sql")).collect()}
    assert corpus["a/01_x.sql"].folder == "a" and corpus["a/01_x.sql"].stem == "01_x"
    assert corpus["top.sql"].folder == "" and corpus["top.sql"].text == "select 2"


def test_filters(spark):
    df = spark.createDataFrame([("A1", "_202312"), ("b2", ""), ("C3", "_202401")], "t string, s string")
    assert [r.t for r in df.where(FL.suffix_has_values(F.col("s"), ["2023", "12"])).collect()] == ["A1", "b2"]
    assert [r.t for r in df.where(FL.contains_any(F.col("t"), "a, B")).collect()] == ["A1", "b2"]
    targets = spark.createDataFrame([("a1",), ("B2",)], "n string")
    assert [r.t for r in FL.for_targets(df, F.col("t"), targets, F.col("n")).orderBy("t").collect()] == ["A1", "b2"]


def test_types_of_a_wide_table_in_one_pass(spark, tmp_path):
    kinds = ("cast(id as string)", "cast(id / 4 as string)", "concat('x', id)", "cast(id > 3 as string)", "string(null)")
    columns = [f"{kinds[i % 5]} as `c.{i}`" for i in range(200)]
    spark.range(0, 100, 1, 4).selectExpr(*columns).write.parquet(str(tmp_path / "wide"))
    wide = spark.read.parquet(str(tmp_path / "wide"))
    found = [f.dataType.simpleString() for f in SRC.infer_types(wide)]
    assert found == ["bigint", "double", "string", "boolean", "string"] * 40


def test_stream_of_csv_loads_a_content_once_and_counts(spark, tmp_path, monkeypatch):
    observed, write = [], csv_stream._write_counts

    def write_counts(spark, root, run, progress):
        observed.extend(progress.counts(run))
        write(spark, root, run, progress)

    monkeypatch.setattr(csv_stream, "_write_counts", write_counts)
    schema = spark.range(0).selectExpr("id", "string(id) as t").schema
    source, root = str(tmp_path / "in"), str(tmp_path / "out")

    def deliver(lo, hi, compression="gzip"):
        rows = spark.range(lo, hi, 1, 1).selectExpr("id", "concat('a,\"', id) as t")
        rows.write.mode("append").options(**SRC.CSV_FORMAT, compression=compression).csv(source)

    def run(name):
        csv_stream.ingest_csv(spark, source, schema, root, name, files_per_batch=2)
        rows = csv_stream.read_counts(spark, root).where(F.col("run") == name)
        found = rows.agg(*[F.sum(c) for c in ("files", "rows_read", "files_loaded", "rows_loaded")]).first()
        return tuple(found), SRC.read_parquet(spark, f"{root}/table").count()

    deliver(0, 10)
    deliver(10, 30)
    deliver(0, 10, "none")
    assert run("a") == ((3, 40, 2, 30), 30)
    deliver(10, 30)
    deliver(30, 35)
    assert run("b") == ((2, 25, 1, 5), 35)
    assert run("c") == ((None,) * 4, 35)
    deliver(0, 10)
    assert run("d") == ((1, 10, 0, 0), 35)
    table = SRC.read_parquet(spark, f"{root}/table")
    assert sorted(r.id for r in table.collect()) == list(range(35)) and table.where("t = 'a,\"7'").count() == 1
    # a run that ended before its counts were written: the next one counts what it staged
    assert sorted(observed) == sorted(map(tuple, csv_stream.read_counts(spark, root).collect()))
    counts = {r.batch_id: r.asDict() for r in csv_stream.read_counts(spark, root).collect()}
    delete_path(spark, f"{root}/counts/batch_id=1")
    run("e")
    again = {r.batch_id: r.asDict() for r in csv_stream.read_counts(spark, root).collect()}
    assert again == counts | {1: counts[1] | {"run": "e"}}


def test_union_types(spark):
    a = spark.sql("select 1 as k, date'2024-01-01' as d, cast(1.5 as float) as f")
    b = spark.sql("select 5000000000 as x, timestamp_ntz'2024-01-02 03:04:05' as y, 2.5D as z")
    c = spark.sql("select 'K7' as k, date'2024-01-03' as d, 1 as f")
    assert V.union_parts([a, b]).schema.simpleString() == "struct<k:bigint,d:timestamp_ntz,f:double>"
    assert {r.k for r in V.union_parts([a, b, c]).collect()} == {"1", "5000000000", "K7"}
    with pytest.raises(ValueError):
        V.union_parts([a, a.drop("f")])


def test_union_of_nested_types(spark):
    a = spark.sql("select struct(1 as n, array(struct(1 as x)) as l) as s, map('k', 1) as m, null as v")
    b = spark.sql("select struct(array(struct('t' as y, 2L as X)) as L, 2.5D as n) as s, map('j', 2.5D) as m, 7 as v")
    c = spark.sql("select cast(null as struct<n:int,`odd name`:date>) as s, cast(null as map<string,int>) as m, 8 as v")
    united = V.union_parts([a, b, c])
    assert united.schema.simpleString() == (
        "struct<s:struct<n:double,l:array<struct<x:bigint,y:string>>,odd name:date>,m:map<string,double>,v:int>"
    )
    one, two, three = united.orderBy(F.col("v").asc_nulls_first()).collect()
    assert one.s.n == 1.0 and [tuple(e) for e in one.s.l] == [(1, None)] and one.m == {"k": 1.0}
    assert two.s.n == 2.5 and [tuple(e) for e in two.s.l] == [(2, "t")] and two.s["odd name"] is None
    assert three.s is None and three.m is None


def test_union_of_many_folders_scans_once_a_schema(spark, tmp_path):
    for kind, number in (("int", 0), ("bigint", 1)):
        rows = spark.range(0, 200, 1, 1).selectExpr(f"cast(id + {number} * 200 as {kind}) as k", "id as part")
        rows.write.partitionBy("part").parquet(str(tmp_path / kind))
    folders = sorted(str(p) for p in tmp_path.glob("*/part=*"))
    united = V.union_folders(spark, folders)
    assert len(folders) == 400 and plan_text(united).count("FileScan parquet") == 2
    assert sorted(r.k for r in united.collect()) == list(range(400)) and united.schema.simpleString() == "struct<k:bigint>"


def test_ordinals_with_a_hot_group(spark):
    df = spark.range(5000).selectExpr(
        "id", "case when id % 3 = 0 then null when id % 3 = 1 then 'hot' else concat('g', id % 50) end as g",
        "(id * 7919) % 1000 as o",
    ).repartition(5)
    got = with_ordinal(df, [F.col("o"), F.col("id").desc()], "n", ["g"]).toPandas()
    expected = got.sort_values(["o", "id"], ascending=[True, False]).groupby("g", dropna=False).cumcount() + 1
    assert (got["n"] == expected.reindex(got.index)).all() and len(got) == 5000
    whole = with_ordinal(df, [F.col("id")], "n").collect()
    assert sorted((r.n, r.id) for r in whole) == [(i + 1, i) for i in range(5000)]


def test_stream_takes_files_and_contents_once(spark, tmp_path):
    source, args = tmp_path / "in", [str(tmp_path / n) for n in ("out", "history", "state")]
    df = spark.range(50).selectExpr("id", "cast(id as string) as s")
    df.repartition(3).write.parquet(str(source))

    def run():
        ingest.ingest_available(spark, str(source), df.schema, *args, files_per_batch=2)
        return ids(spark.read.parquet(args[0]))

    assert run() == list(range(50))
    assert run() == list(range(50))
    files = sorted(source.glob("*.parquet"))
    shutil.copy(files[0], source / "copy-of-a-file.parquet")
    assert run() == list(range(50))
    spark.range(50, 60).selectExpr("id", "cast(id as string) as s").write.mode("append").parquet(str(source))
    assert run() == list(range(60))
    # a batch repeated after a failure replaces itself
    batch = spark.read.parquet(str(source)).withColumn("source_file", F.col("_metadata.file_path"))
    other = [str(tmp_path / n) for n in ("out2", "history2")]
    ingest.load_batch(batch, 0, *other)
    ingest.load_batch(batch, 0, *other)
    assert ids(spark.read.parquet(other[0])) == list(range(60))


def test_jdbc_options():
    oracle = J.connection_options("oracle", {"dsn": "db:1521/x", "user": "u", "password": "p"})
    assert oracle["url"] == "jdbc:oracle:thin:@db:1521/x" and oracle["user"] == "u"
    vertica = J.connection_options("vertica", {"host": "h", "database": "d", "tlsmode": "disable"})
    assert vertica["url"] == "jdbc:vertica://h:5433/d?TLSmode=disable"
    plain = J.read_options(vertica, "select 1")
    assert plain["fetchsize"] == "10000" and plain["queryTimeout"] == "1800" and "numPartitions" not in plain
    split = J.read_options(vertica, "select 1", ("k", "1", "9", 4))
    assert split["partitionColumn"] == "k" and split["numPartitions"] == "4"
    assert J.write_options(vertica, "t")["batchsize"] == "1000"
    with pytest.raises(ValueError):
        J.connection_options("other", {})


def test_a_hot_case_is_split_over_files(spark, tmp_path):
    """A third of the rows in one case does not become one task's work."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    rows = spark.range(0, 200_000, 1, 8).selectExpr(
        "id", "md5(cast(id as string)) as t", "case when id % 3 = 0 then 'hot' else concat('c', id % 40) end as k"
    )
    before = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        S.replace_slices(rows, str(tmp_path / "hot"), ["k"])
    finally:
        spark.conf.set(key, before)
    assert len(list((tmp_path / "hot" / "k=hot").glob("*.parquet"))) > 3
    back = spark.read.parquet(str(tmp_path / "hot"))
    assert back.count() == 200_000 and back.select("id").distinct().count() == 200_000


def test_megabytes(spark):
    sizes = spark.createDataFrame([(1048576,), (5243,), (0,)], "n long")
    assert [r[0] for r in sizes.select(P.megabytes(F.col("n"))).collect()] == [1.0, 0.01, 0.0]


@pytest.mark.parametrize("identity", [L.BY_SUFFIX, L.BY_HASH])
def test_second_load_reads_only_new_parts(target, extract, monkeypatch, identity):
    seen, whole = [], L.manifest

    def spy(source, part, how=L.BY_SUFFIX):
        seen.append((plan_text(source), source.count()))
        return whole(source, part, how)

    monkeypatch.setattr(L, "manifest", spy)
    L.load_parts(target, "T", extract.where("file_suffix < '_3'"), "file_suffix", identity=identity)
    L.load_parts(target, "T", extract, "file_suffix", identity=identity)
    L.load_parts(target, "T", extract, "file_suffix", identity=identity)
    assert [rows for _plan, rows in seen] == [75, 25, 0]
    filters = seen[1][0].split("PartitionFilters: [")[1]
    assert filters.startswith(("(file_suffix", "file_suffix", "isnotnull(file_suffix"))
    assert ids(target.table("T", extract.schema)) == list(range(100))


def test_common_decimals():
    from pyspark.sql import types as T

    def common(*kinds):
        return V.common_schema([T.StructType([T.StructField("x", k)]) for k in kinds])[0].dataType

    assert common(T.DecimalType(10, 2), T.DecimalType(12, 2)) == T.DecimalType(12, 2)
    assert common(T.LongType(), T.DecimalType(12, 2)) == T.DecimalType(21, 2)
    assert common(T.DecimalType(38, 0), T.DecimalType(10, 5)) == T.StringType()
    assert common(T.IntegerType(), T.FloatType()) == T.DoubleType()


def test_sheet_names_differ(spark):
    long = "a sheet name that is longer than a sheet name can be "
    rows = [("f", long + str(i % 3)) for i in range(9)] + [("f", "short"), ("f", "odd~2"), ("g", "short")]
    found = P.group_summary(spark.createDataFrame(rows, "folder string, sheet string"), "folder", "sheet", 2).collect()
    names = [(r.folder, r.sheet_name) for r in found]
    assert len(set(names)) == len(found) == 6 and all(len(n) <= 31 for _f, n in names)
    assert {r.full_name: r.over_limit for r in found if r.folder == "f"}[(long + "1").upper()]
    assert ("f", "SHORT") in names and ("f", "ODD~2") not in names
