"""Registered queries: sources, sinks and incremental loads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parampipe.functions.hashing import FINGERPRINT, fingerprint
from parampipe.functions.params import month_key
from parampipe.operators import cases as C
from parampipe.operators import difference as D
from parampipe.operators import ledger as LG
from parampipe.operators import load as L
from parampipe.operators import sinks as S
from parampipe.operators import views as V
from parampipe.operators.keyed import KeyedTable
from parampipe.plans.inputs import table
from parampipe.session import new_scratch, write_text
from parampipe.sources import files as SRC
from parampipe.streaming import csv_stream, ingest

PART = "file_suffix"
# First load of the two-step loads: the months before this day.
SECOND_LOAD_FROM = "1998-01-01"


def _orders_with_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn(
        PART, F.concat(F.lit("_"), month_key("o_orderdate"))
    )


def _extract_of(df: DataFrame, label: str) -> DataFrame:
    """`df` as an extract would leave it: one folder per part."""
    spark, path = df.sparkSession, new_scratch(df.sparkSession, label)
    S.write_parquet(df, path, [PART])
    return SRC.read_parquet(spark, path, df.schema)


def _early(df: DataFrame) -> DataFrame:
    return df.where(F.col(PART) < "_" + SECOND_LOAD_FROM[:4])


def _target(spark: SparkSession, label: str) -> L.Target:
    return L.Target(spark, new_scratch(spark, label), "local", "orders_job")


# --- sources and sinks ---------------------------------------------------------


def csv_gz_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    path = new_scratch(spark, "csv")
    S.write_csv(lines, path, compression="gzip")
    return SRC.read_csv(spark, path, lines.schema)


def csv_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes, commas and line breaks survive the file."""
    documents = table(spark, sf_dir, "documents")
    path = new_scratch(spark, "csv")
    S.write_csv(documents, path, compression="none")
    return SRC.read_csv(spark, path, documents.schema, multi_line=True)


def csv_raw_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").drop("o_totalprice")
    path = new_scratch(spark, "csv")
    S.write_csv(orders, path)
    return SRC.read_csv_raw(spark, path)


def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types found in the data; a code with leading zeros stays text."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("cust_code"),
        "o_totalprice",
        "o_orderdate",
        F.to_date("o_orderdate").alias("o_day"),
        (F.col("o_orderstatus") == "F").alias("is_final"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("cust_or_null"),
    )
    path = new_scratch(spark, "csv")
    S.write_csv(orders, path)
    return SRC.read_csv_inferred(spark, path)


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    path = new_scratch(spark, "parquet")
    S.write_parquet(lines, path)
    return SRC.read_parquet(spark, path, lines.schema)


def typed_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text CSV to typed Parquet: `*key` text, `l_discount` double, the rest inferred."""
    lines = table(spark, sf_dir, "lineitem")
    source, target = new_scratch(spark, "csv"), new_scratch(spark, "typed")
    S.write_csv(lines, source)
    raw = SRC.read_csv_raw(spark, source)
    S.convert_typed(raw, target)
    return SRC.read_parquet(spark, target)


def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per written part, and whether the files found hold them."""
    extract = _extract_of(_orders_with_part(spark, sf_dir), "manifest")
    sizes = extract.groupBy(PART).agg(
        (F.min("_metadata.file_size") > 0).alias("has_bytes"),
        F.min("_metadata.file_modification_time").isNotNull().alias("has_time"),
    )
    return L.manifest(extract, PART).select(PART, "row_count").join(sizes, PART)


def part_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows have the same fingerprint in gzip CSV and in Parquet."""
    orders = _orders_with_part(spark, sf_dir)
    path = new_scratch(spark, "csv")
    S.write_csv(orders, path)
    from_csv = fingerprint(SRC.read_csv(spark, path, orders.schema), [PART])
    from_parquet = fingerprint(orders, [PART]).withColumnRenamed(FINGERPRINT, "other")
    return from_csv.join(from_parquet.drop("row_count"), PART).select(
        PART, "row_count", (F.col(FINGERPRINT) == F.col("other")).alias("same_content")
    )


def unwritten_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases of the range whose output does not exist yet."""
    extract = table(spark, sf_dir, "orders").withColumn("clsYymm", month_key("o_orderdate"))
    path = new_scratch(spark, "extract")
    S.write_parquet(extract, path, ["clsYymm"])
    written = S.existing_cases(spark, path, ["clsYymm"])
    cases = C.case_table(spark, {"clsYymm": "199001:200512"})
    return LG.pending(cases, written, ["clsYymm"])


def replace_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of 1997 are delivered again with another priority."""
    orders = _orders_with_part(spark, sf_dir)
    path = new_scratch(spark, "replace")
    S.replace_slices(orders, path, [PART])
    changed = orders.where(F.col(PART).startswith("_1997"))
    S.replace_slices(changed.withColumn("o_orderpriority", F.lit("redelivered")), path, [PART])
    return SRC.read_parquet(spark, path, orders.schema)


def version_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month is one version of the output; the newest ten are kept."""
    orders = table(spark, sf_dir, "orders")
    path = new_scratch(spark, "versions")
    S.write_parquet(orders.withColumn("version", month_key("o_orderdate")), path, ["version"])
    return S.read_versions(spark, path, orders.schema)


def keep_latest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value")
    return S.keep_latest(events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])


# --- loads -----------------------------------------------------------------------


def load_history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _target(spark, "history")
    L.load_parts(target, "ORDERS", _extract_of(_orders_with_part(spark, sf_dir), "extract"), PART)
    return target.history().select("schema_name", "table_name", PART, "row_count")


def incremental_by_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, the second over all parts, and a third that finds nothing new."""
    extract = _extract_of(_orders_with_part(spark, sf_dir), "extract")
    target = _target(spark, "by-suffix")
    for source in (_early(extract), extract, extract):
        L.load_parts(target, "ORDERS", source, PART)
    return target.table("ORDERS", extract.schema)


def incremental_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that come back under another name are not loaded again."""
    orders = _orders_with_part(spark, sf_dir)
    first = _extract_of(_early(orders), "extract")
    renamed = _extract_of(orders.withColumn(PART, F.concat(F.lit("again"), PART)), "renamed")
    target = _target(spark, "by-hash")
    for source in (first, renamed):
        L.load_parts(target, "ORDERS", source, PART, identity=L.BY_HASH)
    return target.table("ORDERS", orders.schema)


def _small_part(spark: SparkSession, sf_dir: str, suffix: str, status: str) -> DataFrame:
    """Orders of a status as the part `suffix`."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == status)
    return orders.withColumn(PART, F.lit(suffix))


def incremental_reused_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name comes back with other rows, and the old rows under another name: all
    rows are there, once."""
    target = _target(spark, "reused")
    day_1 = _extract_of(_small_part(spark, sf_dir, "_1", "F"), "day-1")
    day_2 = _extract_of(
        _small_part(spark, sf_dir, "_1", "O").unionAll(_small_part(spark, sf_dir, "_2", "F")), "day-2"
    )
    for source in (day_1, day_2, day_2):
        L.load_parts(target, "ORDERS", source, PART, identity=L.BY_HASH)
    return target.table("ORDERS", day_1.schema)


def incremental_two_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs load parts of the same name into one table: each keeps its rows."""
    first = _target(spark, "jobs")
    second = L.Target(spark, first.root, first.schema, "other_job")
    for target, status in ((first, "F"), (second, "O"), (first, "F")):
        source = _extract_of(_small_part(spark, sf_dir, "_1", status), "job")
        L.load_parts(target, "ORDERS", source, PART, identity=L.BY_HASH)
    rows = first.table("ORDERS", source.schema)
    jobs = first.history().agg(F.count_distinct("job_name"))
    return rows.withColumn("jobs", jobs.scalar())


def retry_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A retry of the months of 1996 replaces what they loaded before."""
    orders = _orders_with_part(spark, sf_dir)
    target = _target(spark, "retry")
    L.load_parts(target, "ORDERS", orders, PART, gather=True)
    again = orders.where(F.col(PART).startswith("_1996")).withColumn(
        "o_orderstatus", F.concat(F.lit("retried "), "o_orderstatus")
    )
    L.load_parts(target, "ORDERS", again, PART, retry=True, gather=True)
    return target.table("ORDERS", orders.schema)


def stream_incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files arrive in two deliveries; the last of three runs finds nothing new."""
    orders = table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit(SECOND_LOAD_FROM)
    root = new_scratch(spark, "stream")
    for rows in (orders.where(early), orders.where(~early), None):
        if rows is not None:
            S.write_parquet(rows, f"{root}/in", mode="append")
        ingest.ingest_available(
            spark, f"{root}/in", orders.schema, f"{root}/out", f"{root}/history", f"{root}/state"
        )
    return SRC.read_parquet(spark, f"{root}/out").drop(ingest.BATCH)


def stream_csv_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries as gzip CSV: early orders; the later ones with the early ones again
    in files of other names; the early ones once more. Counts of each run, of the stream's
    batches, and the rows of the table in the end."""
    orders = table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit(SECOND_LOAD_FROM)
    root = new_scratch(spark, "stream-csv")
    for run, deliveries in (("1", [early]), ("2", [~early, early]), ("3", [early])):
        for wanted in deliveries:
            # the key decides a row's file, so a delivery made again has the same contents
            rows = orders.where(wanted).repartition(8, "o_orderkey")
            rows.write.mode("append").options(**SRC.CSV_FORMAT, compression="gzip").csv(f"{root}/in")
        csv_stream.ingest_csv(spark, f"{root}/in", orders.schema, root, run, files_per_batch=5)
    loaded = SRC.read_parquet(spark, f"{root}/table").agg(F.count(F.lit(1)))
    names = ("files", "rows_read", "files_loaded", "rows_loaded")
    counts = csv_stream.read_counts(spark, root).groupBy("run").agg(*[F.sum(c).alias(c) for c in names])
    return counts.withColumn("table_rows", loaded.scalar())


def _fresh_schema(spark: SparkSession) -> tuple[str, str]:
    """A database of its own in the catalog, with its folder in the scratch area."""
    name = f"parampipe_{uuid.uuid4().hex}"
    path = new_scratch(spark, "catalog")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name, path


def create_or_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second delivery has other column names; columns go in by position."""
    orders = table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit(SECOND_LOAD_FROM)
    schema, path = _fresh_schema(spark)
    name = f"{schema}.orders_loaded"
    L.create_or_append(spark, orders.where(early), name, f"{path}/orders_loaded")
    later = orders.where(~early).toDF(*[f"c{i}" for i in range(len(orders.columns))])
    L.create_or_append(spark, later, name, f"{path}/orders_loaded")
    return spark.table(name)


def append_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second delivery has its columns in another order; names decide."""
    orders = table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit(SECOND_LOAD_FROM)
    schema, path = _fresh_schema(spark)
    name = f"{schema}.orders_loaded"
    L.append_by_name(orders.where(early), name, f"{path}/orders_loaded")
    L.append_by_name(
        orders.where(~early).select(*reversed(orders.columns)), name, f"{path}/orders_loaded"
    )
    return spark.table(name)


def union_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view over one table per order status, one of them with a text as customer
    key; a similar name is no part."""
    orders = table(spark, sf_dir, "orders")
    schema, path = _fresh_schema(spark)
    for status in ("F", "O", "P"):
        key = F.col("o_custkey")
        L.append_by_name(
            orders.where(F.col("o_orderstatus") == status).withColumn(
                "o_custkey", F.concat(F.lit("C"), key) if status == "O" else key
            ),
            f"{schema}.orders__{status}",
            f"{path}/orders__{status}",
        )
    L.append_by_name(orders, f"{schema}.ordersxx1", f"{path}/ordersxx1")
    V.create_union_view(spark, schema, "orders")
    return spark.table(f"{schema}.orders")


def union_many_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder for every status and month; the statuses' schemas differ inside a struct
    and an array, so all folders are read by three scans."""
    orders = table(spark, sf_dir, "orders").withColumn("month", month_key("o_orderdate"))
    customer, price = F.col("o_custkey").cast("bigint"), F.col("o_totalprice").alias("price")
    digit = F.col("o_orderkey") % 7
    shapes = {
        "F": (F.struct(customer.cast("int").alias("cust"), price), F.array(digit.cast("int"))),
        "O": (F.struct(customer.alias("cust")), F.array(digit.cast("bigint"), F.lit(None))),
        "P": (F.struct(price, F.concat(F.lit("C"), customer).alias("CUST")), F.array(digit.cast("double"))),
    }
    root = new_scratch(spark, "many-parts")
    for status, (info, tags) in shapes.items():
        rows = orders.where(F.col("o_orderstatus") == status)
        rows = rows.select("o_orderkey", info.alias("info"), tags.alias("tags"), "month")
        S.write_parquet(rows, f"{root}/status={status}", ["month"])
    found = S.case_files(spark, root, ["status"])
    folders = found.select("status", F.regexp_replace("_file", r"/[^/]*$", "").alias("folder")).distinct()
    united = V.union_folders(spark, [row["folder"] for row in folders.orderBy("status", "folder").collect()])
    return united.select(
        "o_orderkey", F.col("info.cust").alias("cust"), F.col("info.price").alias("price"),
        F.col("tags")[0].alias("tag"), F.size("tags").cast("bigint").alias("tags"),
    )


def union_parts_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with a number, a smaller number and a text as key make a text key;
    decimals of different digits and whole numbers make a decimal for all."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(10,2)").alias("price"),
        F.col("o_custkey").alias("amount"),
    )
    parts = [
        orders.where("o_orderstatus = 'F'"),
        orders.where("o_orderstatus = 'O'")
        .withColumn("o_orderkey", F.concat(F.lit("K"), F.col("o_orderkey")))
        .withColumn("price", F.col("price").cast("decimal(14,4)")),
        orders.where("o_orderstatus = 'P'")
        .withColumn("o_custkey", F.col("o_custkey").cast("int"))
        .withColumn("amount", F.col("price").cast("decimal(12,2)")),
    ]
    united = V.union_parts(parts)
    kinds = F.lit(", ".join(united.schema[c].dataType.simpleString() for c in ("price", "amount")))
    return united.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("price").cast("double").alias("price"),
        F.col("amount").cast("double").alias("amount"),
        kinds.alias("kinds"),
    )


def load_bad_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A broken file among the parts of every year: the others load, it alone fails, twice."""
    orders = table(spark, sf_dir, "orders").withColumn(PART, F.concat(F.lit("_"), F.year("o_orderdate")))
    path, target = new_scratch(spark, "parts"), _target(spark, "bad-part")
    S.write_parquet(orders, path, [PART])
    write_text(spark, f"{path}/{PART}=_broken/part-0.parquet", "no parquet")
    outcomes = None
    for run in (1, 2):
        found = L.load_folder(target, "ORDERS", path, orders.schema, PART).withColumn("run", F.lit(run))
        outcomes = found if outcomes is None else outcomes.unionByName(found)
    loaded = target.table("ORDERS", orders.schema).agg(F.count(F.lit(1))).scalar()
    counted = outcomes.groupBy("run").agg(F.sum("row_count").alias("row_count"), F.count_if(F.col("error_message") != "").alias("errors"))
    return L.load_summary(outcomes, ["run"]).join(counted, "run").withColumn("in_table", loaded)


def _keyed_orders(spark: SparkSession, sf_dir: str) -> tuple[KeyedTable, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    keyed = KeyedTable(spark, new_scratch(spark, "keyed"), orders.schema, ("o_orderkey",))
    keyed.upsert(orders.repartitionByRange(8, "o_orderkey"))
    return keyed, orders


def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending orders are delivered again with another status, some keys go, new ones come."""
    keyed, orders = _keyed_orders(spark, sf_dir)
    again = orders.where("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("again"))
    new = orders.where("o_orderkey % 100 = 0").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    keyed.upsert(again.unionByName(new), gone=orders.where("o_orderstatus <> 'P' and o_orderkey % 10 = 3"))
    return keyed.read()


def version_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve changes of a month each; three versions stay, and every older one is gone."""
    keyed, orders = _keyed_orders(spark, sf_dir)
    for month in range(1, 12):
        own = orders.where(F.month("o_orderdate") == month).withColumn("o_orderpriority", F.lit(f"month {month}"))
        keyed.upsert(own)
    keyed.remove_old(3)
    keyed.remove_old(3)
    left = [n for n in range(1, 13) if keyed.files(n)]
    rows = None
    for number in left:
        one = keyed.read(number).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).withColumn("version", F.lit(number))
        rows = one if rows is None else rows.unionByName(one)
    return rows


def part_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded months against a redelivery: orders gone, new, changed and twice; the
    digests of the loaded rows are kept from the load."""
    orders, target = _orders_with_part(spark, sf_dir), _target(spark, "difference")
    L.load_parts(target, "ORDERS", orders, PART, gather=True)
    loaded = target.table("ORDERS", orders.schema)
    kept = D.digests(loaded, ["o_orderkey"])
    key = F.col("o_orderkey")
    again = orders.where(key % 100 != 7).withColumn(
        "o_orderstatus", F.when(key % 100 == 8, "changed").otherwise(F.col("o_orderstatus"))
    )
    new = orders.where(key % 100 == 9).withColumn("o_orderkey", -key - 1)
    redelivered = again.unionByName(new).unionByName(orders.where(key % 100 == 10))
    return D.part_difference(loaded, redelivered, ["o_orderkey"], kept)


def version_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One output a month, twelve in a row; removal leaves ten folders, a second one nothing more."""
    orders = table(spark, sf_dir, "orders")
    path = new_scratch(spark, "versions")
    for month in range(1, 13):
        S.write_version(orders.where(F.month("o_orderdate") == month), path, f"2024{month:02d}01_000000")
    removed = len(S.remove_versions(spark, path)) * 10 + len(S.remove_versions(spark, path))
    rows = S.read_versions(spark, path, orders.schema, keep=100)
    return rows.groupBy("version").agg(F.count(F.lit(1)).alias("row_count")).withColumn("removed", F.lit(removed))


QUERIES = {
    f.__name__: f
    for f in (
        csv_gz_roundtrip,
        csv_text_roundtrip,
        csv_raw_strings,
        csv_inferred,
        parquet_roundtrip,
        typed_convert,
        file_manifest,
        part_fingerprint,
        unwritten_cases,
        replace_partitions,
        version_retention,
        keep_latest_n,
        load_history_rows,
        incremental_by_suffix,
        incremental_by_hash,
        incremental_reused_name,
        incremental_two_jobs,
        retry_replace,
        stream_incremental_load,
        stream_csv_counts,
        create_or_append,
        append_by_name,
        union_parts,
        union_many_parts,
        union_parts_widened,
        load_bad_part,
        upsert_by_key,
        version_removal,
        part_difference,
        version_folders,
    )
}

_SUFFIX = "'_' || strftime(o_orderdate, '%Y%m')"
_ORDERS_WITH_PART = f"select *, {_SUFFIX} as file_suffix from orders"
_PARTS = f"select {_SUFFIX} as file_suffix, count(*) as row_count from orders group by 1"

ORACLE = {
    "part_difference": f"""select case o_orderkey % 100 when 7 then 'removed' when 8 then 'changed' else 'added' end as change,
          case when o_orderkey % 100 < 9 then 'old' else 'new' end as side, 1 as times, *
          from ({_ORDERS_WITH_PART}) where o_orderkey % 100 in (7, 8, 10)
        union all select 'changed', 'new', 1, * replace ('changed' as o_orderstatus) from ({_ORDERS_WITH_PART})
          where o_orderkey % 100 = 8
        union all select 'added', 'new', 1, * replace (-o_orderkey - 1 as o_orderkey) from ({_ORDERS_WITH_PART})
          where o_orderkey % 100 = 9""",
    "version_folders": """select strftime(make_date(2024, month(o_orderdate)::int, 1), '%Y%m%d') || '_000000' as version,
        count(*) as row_count, 20 as removed from orders where month(o_orderdate) > 2 group by 1""",
    "load_bad_part": """with y as (select count(distinct extract(year from o_orderdate)) as years, count(*) as n from orders)
        select 1 as run, years as loaded, 0 as skipped, 1 as failed, n as row_count, 1 as errors, n as in_table from y
        union all select 2, 0, years, 1, null, 1, n from y""",
    "upsert_by_key": """select o_orderkey, o_custkey, case when o_orderstatus = 'P' then 'again' else o_orderstatus end as o_orderstatus,
          o_totalprice, o_orderdate, o_orderpriority from orders where o_orderstatus = 'P' or o_orderkey % 10 <> 3
        union all select -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
          from orders where o_orderkey % 100 = 0""",
    "version_removal": """with o as (select o_orderpriority as p, extract(month from o_orderdate) as m from orders),
        v as (select unnest([10, 11, 12]) as version)
        select version, case when m < version then 'month ' || m else p end as o_orderpriority, count(*) as n
        from o cross join v group by all""",
    "csv_gz_roundtrip": "select * from lineitem",
    "csv_text_roundtrip": "select * from documents",
    "csv_raw_strings": """select cast(o_orderkey as varchar) as o_orderkey,
        cast(o_custkey as varchar) as o_custkey, o_orderstatus,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') as o_orderdate, o_orderpriority from orders""",
    "csv_inferred": """select o_orderkey, lpad(cast(o_custkey as varchar), 9, '0') as cust_code,
        o_totalprice, o_orderdate, cast(o_orderdate as date) as o_day,
        o_orderstatus = 'F' as is_final,
        case when o_orderstatus <> 'P' then o_custkey end as cust_or_null from orders""",
    "parquet_roundtrip": "select * from lineitem",
    "typed_convert": """select cast(l_orderkey as varchar) as l_orderkey,
        cast(l_partkey as varchar) as l_partkey, cast(l_suppkey as varchar) as l_suppkey,
        cast(l_linenumber as bigint) as l_linenumber, l_quantity, l_extendedprice, l_discount,
        l_tax, l_returnflag, l_linestatus,
        strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') as l_shipdate from lineitem""",
    "file_manifest": f"select *, true as has_bytes, true as has_time from ({_PARTS})",
    "part_fingerprint": f"select *, true as same_content from ({_PARTS})",
    "unwritten_cases": """select strftime(m, '%Y%m') as clsYymm from (select unnest(generate_series(
        timestamp '1990-01-01', timestamp '2005-12-01', interval 1 month)) as m)
        where strftime(m, '%Y%m') not in (select strftime(o_orderdate, '%Y%m') from orders)""",
    "replace_partitions": f"""select * replace (case when extract(year from o_orderdate) = 1997
        then 'redelivered' else o_orderpriority end as o_orderpriority) from ({_ORDERS_WITH_PART})""",
    "version_retention": """select *, strftime(o_orderdate, '%Y%m') as version from orders
        where strftime(o_orderdate, '%Y%m') in (select distinct strftime(o_orderdate, '%Y%m')
          from orders order by 1 desc limit 10)""",
    "keep_latest_n": """select * from (select user_id, event_id, ts, value,
        row_number() over (partition by user_id order by ts desc, event_id desc) as position
        from events) where position <= 10""",
    "load_history_rows": f"""select 'local' as schema_name, 'ORDERS' as table_name, *
        from ({_PARTS})""",
    "incremental_by_suffix": _ORDERS_WITH_PART,
    "incremental_by_hash": f"""select *, case when o_orderdate >= timestamp '1998-01-01'
        then 'again' else '' end || {_SUFFIX} as file_suffix from orders""",
    "incremental_reused_name": """select *, '_1' as file_suffix
        from orders where o_orderstatus in ('F', 'O')""",
    "incremental_two_jobs": """select *, '_1' as file_suffix, 2 as jobs from orders
        where o_orderstatus in ('F', 'O')""",
    "retry_replace": f"""select * replace (case when extract(year from o_orderdate) = 1996
        then 'retried ' || o_orderstatus else o_orderstatus end as o_orderstatus)
        from ({_ORDERS_WITH_PART})""",
    "stream_incremental_load": "select * from orders",
    "stream_csv_counts": f"""with n as (
        select count(*) filter (where o_orderdate < timestamp '{SECOND_LOAD_FROM}') as early,
               count(*) filter (where o_orderdate >= timestamp '{SECOND_LOAD_FROM}') as later from orders)
        select '1' as run, 8 as files, early as rows_read, 8 as files_loaded, early as rows_loaded,
               early + later as table_rows from n
        union all select '2', 16, early + later, 8, later, early + later from n
        union all select '3', 8, early, 0, 0, early + later from n""",
    "create_or_append": "select * from orders",
    "append_by_name": "select * from orders",
    "union_parts": """select * replace (case when o_orderstatus = 'O' then 'C' else '' end
        || o_custkey as o_custkey) from orders""",
    "union_many_parts": """select o_orderkey, case when o_orderstatus = 'P' then 'C' else '' end
            || cast(o_custkey as varchar) as cust,
        case when o_orderstatus <> 'O' then o_totalprice end as price,
        cast(o_orderkey % 7 as double) as tag, case when o_orderstatus = 'O' then 2 else 1 end as tags
        from orders""",
    "union_parts_widened": """select case when o_orderstatus = 'O' then 'K' else '' end
        || o_orderkey as o_orderkey, o_custkey, o_orderstatus, o_totalprice as price,
        case when o_orderstatus = 'P' then o_totalprice else o_custkey end as amount,
        'decimal(14,4), decimal(21,2)' as kinds from orders""",
}
