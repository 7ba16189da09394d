"""Registered queries: run ledger, pending work, counts and profiles.

`events` plays the ledger: user = host, event type and ``k`` = template and
parameter, an error event = a failed attempt, value = seconds, day = batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parampipe.functions.hashing import text_digests
from parampipe.functions.params import month_key
from parampipe.operators import ledger as LG
from parampipe.operators import load as L
from parampipe.operators import profile as P
from parampipe.plans.inputs import table
from parampipe.session import new_scratch

KEYS = ["host", "sql_file", "params"]


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    failed = F.col("event_type") == "error"
    k = F.get_json_object("props", "$.k")
    return events.select(
        F.date_format("ts", "yyyyMMdd").alias("batch_ts"),
        F.concat(F.lit("host_"), F.substring(F.md5(F.col("user_id").cast("string")), 1, 1)).alias("host"),
        F.concat(F.lit("t"), F.col("user_id"), F.lit(".sql")).alias("sql_file"),
        F.concat(F.lit("k="), k).alias("params"),
        F.md5("event_type").alias("sql_hash"),
        F.when(failed, LG.FAIL).otherwise(LG.OK).alias("status"),
        k.cast("bigint").alias("rows"),
        F.col("value").alias("elapsed_sec"),
        F.when(~failed, F.concat(F.lit("out/"), k)).alias("output_file"),
        F.when(failed, F.repeat("props", 60)).alias("error_message"),
        "ts",
        "event_id",
    )


def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows written by batch and read back."""
    path = new_scratch(spark, "ledger")
    LG.append_rows(_ledger(spark, sf_dir), path)
    return LG.read_ledger(spark, path)


def latest_run_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_scratch(spark, "ledger")
    LG.append_rows(_ledger(spark, sf_dir), path)
    return LG.success_keys(LG.read_ledger(spark, path), scope="last_run")


def pending_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases whose last attempt, over all batches, did not succeed."""
    ledger = _ledger(spark, sf_dir)
    cases = ledger.select(*KEYS).distinct()
    return LG.pending(cases, LG.success_keys(ledger, KEYS, order="ts"), KEYS)


def retry_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templates of a host that failed last and may be tried again."""
    ledger = _ledger(spark, sf_dir)
    return LG.retryable(ledger, KEYS, order="ts")


def retry_after_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts of a user fail, but every fourth of five succeeds: what failed before
    a success does not use up the rounds."""
    events = table(spark, sf_dir, "events")
    attempts = events.select(
        F.concat(F.lit("t"), F.col("user_id"), F.lit(".sql")).alias("sql_file"),
        F.when(F.col("event_id") % 5 == 3, LG.OK).otherwise(LG.FAIL).alias("status"),
        F.col("event_id").alias("attempt"),
    )
    return LG.retryable(attempts, ["sql_file"], order="attempt")


def failed_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templates among the failed names of the newest batch."""
    ledger = _ledger(spark, sf_dir)
    templates = ledger.select("sql_file", F.col("host").alias("folder")).distinct()
    failed = LG.failed_templates(LG.latest_batch(ledger))
    return LG.retry_targets(templates, failed)


def slow_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = _ledger(spark, sf_dir)
    return LG.slowest(ledger, [F.col("event_id")]).select("host", "sql_file", "elapsed_sec")


def host_schema_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers are hosts; those of region 0 have a configured schema."""
    hosts = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("host"), "s_nationkey")
    nation = table(spark, sf_dir, "nation").where("n_regionkey = 0")
    mapping = hosts.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "host", F.col("n_name").alias("duckdb_schema")
    )
    return LG.schema_of_host(hosts.select("host"), mapping, "host", "duckdb_schema")


def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of a day's files: loaded, skipped (no template or seen before), failed."""
    events = table(spark, sf_dir, "events")
    files = events.select(
        F.date_format("ts", "yyyyMMdd").alias("day"),
        F.col("user_id").alias("table_name"),
        F.col("event_id").alias("file_suffix"),
        "event_type",
    )
    templates = table(spark, sf_dir, "customer").where("c_mktsegment <> 'MACHINERY'").select(
        F.col("c_custkey").alias("table_name")
    )
    history = files.where("event_type = 'view'")
    status = L.load_status(files, templates, history)
    outcomes = status.withColumn(
        "status",
        F.when(F.col("status") == "skipped", "skipped")
        .when(F.col("event_type") == "error", "failed")
        .otherwise("loaded"),
    )
    return L.load_summary(outcomes, ["day"])


def rows_per_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("cls_yymm", month_key("o_orderdate"))
    return P.rows_per_case(orders, ["cls_yymm"], "o_totalprice")


def group_row_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per language (folder) and source (sheet), with sheet names that differ
    only behind the short name; sheets above 30 rows are marked."""
    documents = table(spark, sf_dir, "documents").withColumn(
        "sheet", F.concat(F.lit("documents that came from the source "), F.col("source"))
    )
    return P.group_summary(documents, "lang", "sheet", 30)


def column_width_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer columns, with a column that is mostly NULL and one that is long."""
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        "c_mktsegment",
        F.when(F.col("c_nationkey") == 0, F.col("c_name")).alias("n"),
        F.repeat("c_name", 4).alias("long_name"),
    )
    return P.column_width_profile(customer)


def next_sequence_no(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    name = F.when(F.col("c_nationkey") == 3, F.concat("c_name", F.lit("x"))).otherwise(
        F.col("c_name")
    )
    return P.next_sequence(customer, name, F.lit("Customer#"), ["c_mktsegment", "c_nationkey"])


def content_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", *text_digests(F.col("text")))


def run_info_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run documents: fixed fields and a parameter map, from JSON text."""
    events = table(spark, sf_dir, "events")
    document = F.concat(
        F.lit('{"job_name": "'), F.col("event_type"),
        F.lit('", "run_id": "'), F.col("event_type"), F.lit("_"), F.col("user_id"),
        F.lit('", "params": '), F.col("props"), F.lit(', "host": "local"}'),
    )
    schema = "job_name string, run_id string, start_time string, params map<string,string>, host string"
    info = F.from_json(document, schema)
    return events.select("event_id", info.alias("info")).select(
        "event_id",
        "info.job_name",
        "info.run_id",
        "info.start_time",
        F.try_element_at("info.params", F.lit("k")).cast("int").alias("k"),
        "info.host",
    )


QUERIES = {
    f.__name__: f
    for f in (
        run_ledger,
        latest_run_success,
        pending_cases,
        retry_rounds,
        retry_after_success,
        failed_templates,
        slow_top10,
        host_schema_default,
        load_summary,
        rows_per_case,
        group_row_summary,
        column_width_profile,
        next_sequence_no,
        content_fingerprint,
        run_info_parse,
    )
}

_LEDGER = """(select strftime(ts, '%Y%m%d') as batch_ts, 'host_' || substr(md5(cast(user_id as varchar)), 1, 1) as host,
  't' || user_id || '.sql' as sql_file, 'k=' || json_extract_string(props, '$.k') as params,
  md5(event_type) as sql_hash, case when event_type = 'error' then 'FAIL' else 'OK' end as status,
  cast(json_extract_string(props, '$.k') as bigint) as rows, value as elapsed_sec,
  case when event_type = 'error' then '' else 'out/' || json_extract_string(props, '$.k') end as output_file,
  case when event_type = 'error' then repeat(props, 60) else '' end as error_message,
  ts, event_id from events)"""
_LAST = f"""(select host, sql_file, params, case when max(ts) = max(ts) filter (status = 'OK') then 'OK' else 'FAIL' end as status
  from {_LEDGER} group by all)"""

ORACLE = {
    "run_ledger": f"select * exclude (ts, event_id) replace (round(elapsed_sec, 2) as elapsed_sec) from {_LEDGER}",
    "latest_run_success": f"""select distinct host, sql_file, params, sql_hash from {_LEDGER}
        where status = 'OK' and batch_ts = (select max(strftime(ts, '%Y%m%d')) from events)""",
    "pending_cases": f"select host, sql_file, params from {_LAST} where status = 'FAIL'",
    "retry_rounds": f"""select host, sql_file, params, count(*) as failures from {_LEDGER} f
        where status = 'FAIL' and not exists (select 1 from {_LEDGER} s where s.status = 'OK'
          and s.host = f.host and s.sql_file = f.sql_file and s.params = f.params and s.ts >= f.ts)
        group by all having count(*) < 3""",
    "retry_after_success": """select 't' || user_id || '.sql' as sql_file, count(*) as failures
        from (select user_id, event_id, max(event_id) filter (event_id % 5 = 3)
          over (partition by user_id) as last_ok from events)
        where event_id % 5 <> 3 and event_id > coalesce(last_ok, -1)
        group by user_id having count(*) < 3""",
    "failed_templates": f"""select distinct sql_file, host as folder from {_LEDGER} where sql_file in
        (select sql_file from {_LEDGER} where status = 'FAIL'
          and batch_ts = (select max(strftime(ts, '%Y%m%d')) from events))""",
    "slow_top10": f"""select host, sql_file, elapsed_sec from {_LEDGER}
        order by elapsed_sec desc, event_id limit 10""",
    "host_schema_default": """select s_name as host, coalesce(n_name, s_name) as target_schema
        from supplier left join nation on s_nationkey = n_nationkey and n_regionkey = 0""",
    "load_summary": """with s as (select strftime(ts, '%Y%m%d') as day, case
          when event_type = 'view' or user_id not in (select c_custkey from customer where c_mktsegment <> 'MACHINERY')
            then 'skipped'
          when event_type = 'error' then 'failed' else 'loaded' end as status from events)
        select day, count(*) filter (status = 'loaded') as loaded,
          count(*) filter (status = 'skipped') as skipped,
          count(*) filter (status = 'failed') as failed from s group by day""",
    "rows_per_case": """select strftime(o_orderdate, '%Y%m') as cls_yymm, count(*) as row_count,
        cast(sum(cast(o_totalprice as decimal(18, 2))) as double) as sum_o_totalprice
        from orders group by 1""",
    "group_row_summary": """select lang, no,
          left(full_name, 31 - length('~' || no)) || '~' || no as sheet_name, full_name, rows,
          rows > 30 as over_limit
        from (select lang, row_number() over (partition by lang order by source) as no,
          'DOCUMENTS THAT CAME FROM THE SOURCE ' || upper(source) as full_name, count(*) as rows
          from documents group by lang, source)""",
    "column_width_profile": """with l as (select max(length(cast(c_custkey as varchar))) a,
          max(length(c_name)) b, max(length(cast(c_nationkey as varchar))) c,
          max(length(c_mktsegment)) d, max(length(case when c_nationkey = 0 then c_name end)) e,
          max(4 * length(c_name)) f from customer),
        r as (select 'c_custkey' as column_name, greatest(a, 9) as max_len, true as is_numeric from l
          union all select 'c_name', greatest(b, 6), false from l
          union all select 'c_nationkey', greatest(c, 11), true from l
          union all select 'c_mktsegment', greatest(d, 12), false from l
          union all select 'n', greatest(e, 1), false from l
          union all select 'long_name', greatest(f, 9), false from l)
        select *, least(cast(floor(max_len * 1.2) as int) + 2, 50) as width from r""",
    "next_sequence_no": """select c_mktsegment, c_nationkey, n as next_no,
        case when n < 10 then '0' else '' end || n as next_label from (
          select c_mktsegment, c_nationkey, coalesce(max(case when c_nationkey <> 3 then
            cast(substr(c_name, 10) as bigint) end), 0) + 1 as n from customer group by all)""",
    "content_fingerprint": "select doc_id, md5(text) as md5_text, sha256(text) as sha256_text from documents",
    "run_info_parse": """select event_id, event_type as job_name, event_type || '_' || user_id as run_id,
        cast(null as varchar) as start_time, cast(json_extract_string(props, '$.k') as int) as k,
        'local' as host from events""",
}
