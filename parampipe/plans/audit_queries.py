"""Registered queries: checks, plans and order of query templates.

Every document stands for a template file: a table hint, the whole text as a
comment, a statement with all three placeholder forms, and one of three endings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parampipe.functions import naming as N
from parampipe.functions import templates as T
from parampipe.operators import audit as A
from parampipe.plans.inputs import table

STATEMENT = (
    " */\nselect x::int from docs where lang = :lang and lang2 <> :lang_bf\n"
    "and source = {#src} and n_chars >= ${min_chars}"
)


def _corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    ending = (
        F.when(F.col("source").endswith("1"), ";\n")
        .when(F.col("source").endswith("2"), "\n/\n")
        .otherwise("")
    )
    return documents.select(
        "doc_id",
        F.concat(F.lit("t"), "doc_id", F.lit(".sql")).alias("sql_file"),
        F.concat(
            F.lit("--[T_"), "source", F.lit("]\n/* "), "text", F.lit(STATEMENT), ending
        ).alias("text"),
    )


def template_placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.placeholder_summary(_corpus(spark, sf_dir))


def template_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target table, hash and cleaned statement length of every template."""
    text = F.col("text")
    return _corpus(spark, sf_dir).select(
        "doc_id",
        N.table_of_template(text, F.col("sql_file")).alias("table_name"),
        T.text_hash(T.normalize(text)).alias("sql_hash"),
        T.text_hash(T.strip_end(text)).alias("clean_hash"),
    )


def lint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = ["lang", "src", "lang_bf", "other"]
    return A.lint_report(_corpus(spark, sf_dir).drop("sql_file"), given)


def plan_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every rendered statement; two languages times two months."""
    specs = {"lang": F.lit("en,fr"), "src": F.lit("202312:202401"), "min_chars": F.lit("$5\\")}
    plan = A.render_plan(_corpus(spark, sf_dir), "sql_file", specs)
    return plan.select(
        "doc_id",
        "params",
        F.md5("rendered").alias("rendered_md5"),
        F.length("rendered").alias("rendered_chars"),
    )


def text_hit_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines around mail and web addresses in the whole text."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    previewed = A.with_preview(documents, "text", F.array(F.lit("@"), F.lit("http")))
    return previewed.select(
        "doc_id",
        F.md5("preview").alias("preview_md5"),
        F.length("preview").alias("preview_chars"),
    )


def _part_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    stem = F.concat(
        F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"), F.col("p_partkey"), F.lit(".sql")
    )
    stem = F.when(F.col("p_size") > 25, F.upper(stem)).otherwise(stem)
    prefixed = (F.col("p_type") != "PROMO") & (F.col("p_brand") != "Brand#7")
    name = F.when(prefixed, F.concat("p_size", F.lit("_"), stem)).otherwise(stem)
    return table(spark, sf_dir, "part").select("p_partkey", "p_brand", name.alias("file_name"))


def natural_prefix_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run order of all parts as template files of one folder."""
    return A.file_order(_part_files(spark, sf_dir), "file_name", "run_no").drop("p_brand")


def natural_prefix_order_by_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per folder; one folder has no prefixed file."""
    return A.file_order(_part_files(spark, sf_dir), "file_name", "run_no", ["p_brand"])


QUERIES = {
    f.__name__: f
    for f in (
        template_placeholders,
        template_tables,
        lint_report,
        plan_render,
        text_hit_preview,
        natural_prefix_order,
        natural_prefix_order_by_folder,
    )
}

_SQL_STATEMENT = STATEMENT.replace("'", "''")
_CORPUS = f"""(select doc_id, source, 't' || doc_id || '.sql' as sql_file, '--[T_' || source || ']
/* ' || text || '{_SQL_STATEMENT}' || case when source like '%1' then ';
' when source like '%2' then '
/
' else '' end as text from documents)"""
# RE2 has no look-behind: set every ':' after a name character apart first
_APART = "regexp_replace(text, '([A-Za-z0-9_]):', '\\1 :', 'g')"
_NAMES = f"""list_sort(list_distinct(list_concat(list_concat(
  regexp_extract_all({_APART}, '(?:^|[^:]):([A-Za-z_][A-Za-z0-9_]*)', 1),
  regexp_extract_all(text, '\\{{#([A-Za-z_][A-Za-z0-9_]*)\\}}', 1)),
  regexp_extract_all(text, '\\$\\{{([A-Za-z_][A-Za-z0-9_]*)\\}}', 1))))"""
_SPACE = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
_FILES = """(select p_partkey, p_brand, case when p_type <> 'PROMO' and p_brand <> 'Brand#7'
    then p_size || '_' || stem else stem end as file_name,
    case when p_type <> 'PROMO' and p_brand <> 'Brand#7' then p_size end as prefix
  from (select *, case when p_size > 25 then upper(s) else s end as stem
    from (select *, replace(p_name, ' ', '_') || '_' || p_partkey || '.sql' as s from part))
  ) as files"""

ORACLE = {
    "template_placeholders": f"""select param, count(*) as templates from
        (select unnest({_NAMES}) as param from {_CORPUS}) group by param""",
    "template_tables": f"""select doc_id, 'T_' || source as table_name,
        md5(replace(case when source like '%1' then rtrim(rtrim(text, {_SPACE}), ';') else trim(text, {_SPACE}) end,
          chr(10) || '/', chr(10))) as sql_hash,
        md5(rtrim(text, {_SPACE} || ';/')) as clean_hash from {_CORPUS}""",
    "lint_report": f"""with c as (select doc_id, text, {_NAMES} as names from {_CORPUS}),
        m as (select *, list_filter(names, lambda x: x not in ('lang', 'src', 'lang_bf', 'other')) as missing from c),
        i as (select *, list_filter([
            case when rtrim(text, {_SPACE}) like '%;' then 'ends with '';''' end,
            case when contains(text, chr(10) || '/') then 'contains ''/''' end,
            case when len(missing) > 0 then 'missing params [''' || array_to_string(missing, ''', ''') || ''']' end],
            lambda x: x is not null) as found from m)
        select doc_id, case when len(found) = 0 then 'OK' else 'FAIL' end as status,
          array_to_string(found, '; ') as issues, array_to_string(names, ',') as params_used,
          array_to_string(missing, ',') as params_missing from i""",
    "plan_render": f"""with cases as (select * from (values ('en'), ('fr')) l(lang)
          cross join (values ('202312'), ('202401')) s(src)),
        r as (select doc_id, 'lang=' || lang || ', min_chars=$5\\, src=' || src as params,
          '-- ======================================' || chr(10) || '-- FILE: ' || sql_file || chr(10)
          || '-- PARAMS:' || chr(10) || '--   lang = ' || lang || chr(10) || '--   min_chars = $5\\'
          || chr(10) || '--   src = ' || src || chr(10) || chr(10)
          || rtrim(replace(replace(replace(text, 'lang = :lang and', 'lang = ' || lang || ' and'),
               '{{#src}}', src), '${{min_chars}}', '$5\\'), {_SPACE} || ';/') as rendered
          from {_CORPUS} cross join cases)
        select doc_id, params, md5(rendered) as rendered_md5, length(rendered) as rendered_chars from r""",
    "text_hit_preview": """with l as (select doc_id, string_split_regex(
            regexp_replace(text, '(\\r\\n|\\r|\\n)$', ''), '\\r\\n|\\r|\\n') as ls from documents),
        h as (select *, list_filter(range(1, len(ls) + 1),
            lambda i: contains(ls[i], '@') or contains(ls[i], 'http')) as hits from l),
        p as (select doc_id, array_to_string(case when len(hits) = 0 then ls[1:10]
            else ls[greatest(list_min(hits) - 5, 1):least(list_max(hits) + 5, len(ls))] end, chr(10)) as t from h)
        select doc_id, md5(t) as preview_md5, length(t) as preview_chars from p""",
    "natural_prefix_order": f"""select p_partkey, file_name,
        row_number() over (order by prefix nulls last, file_name) as run_no from {_FILES}""",
    "natural_prefix_order_by_folder": f"""select p_partkey, p_brand, file_name, row_number() over (
        partition by p_brand order by prefix nulls last,
        case when p_brand = 'Brand#7' then lower(file_name) else file_name end, file_name) as run_no
        from {_FILES}""",
}
