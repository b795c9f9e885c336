"""Queries over the supplied tables, one or more for each operator, with DuckDB SQL for the same rows.

The tables hold no parser output, so adapters derive elements, claims, tables and charts from them.
An adapter is plain SQL that both engines read; the operators on top of it are written twice.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import scratch
from ..functions import dates, jsonx, match, numbers, text
from ..operators import charts, chunks, elements, evaluate, history, layers, prose, quality, query, regions, tables, textindex
from ..sources import files, parsed, prompts
from ..streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# ---- adapters: {name} is a table ----
LINES = """select l_orderkey as o, l_linenumber as n, cast(max(l_quantity) as bigint) as q, cast(floor(max(l_extendedprice)) as bigint) as p,
 max(l_discount) as d, max(l_returnflag) as rf, max(l_linestatus) as ls from {lineitem} group by l_orderkey, l_linenumber"""
CLAIMS = f"""select 'Doc_' || o || '.pptx' as doc, 'Doc_' || o || '.pptx' as source_document, n as pos, n as page, 'Price' as field_name,
 'Line ' || chr(64 + n) || ' | ' || ls || ' | Price' as canonical_metric, case rf when 'N' then '£' || p || 'm' when 'A' then p || '%' else '~' || p end as value,
 case rf when 'N' then 'table' when 'A' then 'figure' else 'text' end as element_type, case when rf = 'A' or (rf = 'R' and n % 2 = 0) then 'llm_estimated' else 'parsed' end as citation_tier,
 d * 10 as confidence, case when n % 3 = 0 then 'ungrounded' else 'grounded' end as grounding, 'E' || (o % 50) as entity_ref, rf as team, ls as report_type,
 cast(null as string) as as_at_date, q, p from ({LINES}) as lines"""
ELEMENTS = """select 'user_' || user_id as doc, event_id as pos, case event_type when 'view' then 'text' when 'click' then 'table' when 'purchase' then 'figure' when 'signup' then 'title' else 'page_footer' end as el_type,
 case when event_id % 7 = 0 then '' when event_id % 11 = 0 then null else 'Reading ' || event_id || ' of the chart' end as content,
 case when event_id % 5 = 0 then 'Company logo' when event_id % 5 = 1 then 'No figures here' when event_id % 5 = 2 then 'Sales at 12' else null end as description,
 (event_id % 100) / 100.0 as share, cast(event_id % 13 as int) as page from {events}"""
TURNS = """select 'conv_' || conv_id as doc, turn as pos, case when turn % 5 = 0 then 'title' when turn % 3 = 1 then 'section_header' else 'text' end as el_type,
 role || ' turn ' || turn as content, case when turn % 4 = 3 then null else cast(floor(turn / 6) as int) end as page from {conversations}"""


#: Rows of ``lineitem`` in a task that groups them.
LINES_A_TASK = 250_000


def frame(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """An adapter's rows."""
    named = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in set(re.findall(r"\{([a-z]+)\}", sql))}
    if "lineitem" in named:
        # Maxima of strings are found by sorting. Lines dealt by order are sorted once, in tasks whose size doesn't grow.
        tasks = max(spark.sparkContext.defaultParallelism, math.ceil(named["lineitem"].count() / LINES_A_TASK))
        named["lineitem"] = named["lineitem"].repartition(tasks, "l_orderkey")
    return spark.sql(sql, **named)


def registered(sql: str | None) -> Callable[[Query], Query]:
    def put(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = re.sub(r"\{([a-z]+)\}", r"\1", sql)
        return function

    return put


def _join(c: Column) -> Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


# ---- sources and elements ----
@registered(r"""
with raw as (select page_id, html from {pages}),
found as (
 select page_id, 'title' as tag, 'title' as el_type, regexp_extract_all(html, '(?s)<title[^a-z>]*>(.*?)</title>', 1) as f from raw
 union all select page_id, 'h1', 'section_header', regexp_extract_all(html, '(?s)<h1[^a-z>]*>(.*?)</h1>', 1) from raw
 union all select page_id, 'p', 'text', regexp_extract_all(html, '(?s)<p[^a-z>]*>(.*?)</p>', 1) from raw
 union all select page_id, 'footer', 'page_footer', regexp_extract_all(html, '(?s)<footer[^a-z>]*>(.*?)</footer>', 1) from raw
 union all select page_id, 'nav', 'page_header', regexp_extract_all(html, '(?s)<nav[^a-z>]*>(.*?)</nav>', 1) from raw),
each as (select page_id, tag, el_type, unnest(f) as raw, generate_subscripts(f, 1) - 1 as n from found)
select page_id as doc, tag, n::int as n, el_type, trim(regexp_replace(regexp_replace(raw, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) as content,
 el_type not in ('page_header', 'page_footer', 'page_number') as extracted from each""")
def pages_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = parsed.page_elements(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.withColumn("extracted", ~elements.is_layout(F.col("el_type")))


@registered(f"""
with e as ({TURNS}), p as (select *, last_value(page ignore nulls) over (partition by doc order by pos rows unbounded preceding) as pe from e),
t as (select *, case when pe is not distinct from lag(pe) over (partition by doc order by pos) then 0 else 1 end as turned from p),
s as (select *, sum(turned) over (partition by doc order by pos rows unbounded preceding) as segment from t),
h as (select *, last_value(case when el_type = 'title' then content end ignore nulls) over w as title, last_value(case when el_type = 'section_header' then content end ignore nulls) over w as section
 from s window w as (partition by doc, segment order by pos rows unbounded preceding))
select doc, pos, el_type, segment::bigint as segment, title, section, nullif(concat_ws(' | ', title, section), '') as context from h""")
def carry_forward_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return elements.with_context(frame(spark, sf_dir, TURNS)).select("doc", "pos", "el_type", "segment", "title", "section", "context")


@registered("""
select page_id, 'h' || (page_id % 3) as kind, length(trim(html))::int as size, substr(sha256('site/' || page_id || '.html-' || case when page_id % 4 = 0 then 'None' else (page_id % 9)::varchar end || '-' || substr(trim(html), 1, 40)), 1, 16) as chunk_id,
 substr(sha256(trim(html)), 1, 16) as content_hash from {pages} where page_id % 3 <> 2 and length(trim(html)) >= 3""")
def chunk_admissible(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/pages.parquet").withColumns({
        "el_type": F.when(F.col("page_id") % 3 == 2, "page_footer").otherwise("text"), "content": F.trim("html"), "description": F.lit(None).cast("string"), "pos": F.lit(0),
        "doc": F.concat(F.lit("site/"), "page_id", F.lit(".html")), "page": F.when(F.col("page_id") % 4 != 0, (F.col("page_id") % 9).cast("int")),
    })
    df = df.where(chunks.admissible(F.col("el_type"), F.col("content")))
    return df.select("page_id", F.concat(F.lit("h"), F.col("page_id") % 3).alias("kind"), F.length("content").alias("size"), text.chunk_id(F.col("doc"), F.col("page"), F.col("content")).alias("chunk_id"), text.short_hash(F.col("content")).alias("content_hash"))


@registered("""
with n as (select doc_id, substr(sha256(trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))), 1, 16) as content_hash from {documents})
select doc_id, content_hash from (select *, row_number() over (partition by content_hash order by doc_id) as k from n) where k = 1
 and content_hash not in (select content_hash from n where doc_id % 10 = 0)""".replace("\\\\", "\\"))
def chunk_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", text.short_hash(text.squeezed(F.col("text"))).alias("content_hash"))
    return layers.new_rows(df, df.where("doc_id % 10 = 0"), order=("doc_id",))


VARIANTS = """select o_orderkey as o, case when o_orderkey % 97 = 0 then 'damaged ' else '' end || '{{"document":{{"elements":[{{"type":"Title","content":"Order ' || o_orderkey || '","bbox":[{{"page_id":' || (o_orderkey % 5) || ',"coord":[1,2,3,' || (o_orderkey % 90) || ']}}]}},'
 || '{{"type":"figure","description":"Total ' || cast(floor(o_totalprice) as bigint) || '","confidence":0.5,"bbox":[{{"page_id":' || (o_orderkey % 7) || ',"x0":' || (o_orderkey % 11) || ',"y0":2.5,"x1":30,"y1":40}}]}},'
 || '{{"type":"text","content":"' || o_orderpriority || '"}}]}}}}' as response from {orders}"""


@registered("""
with o as (select o_orderkey as o, * from {orders} where o_orderkey % 97 <> 0)
select o as doc, 0 as pos, 'title' as el_type, 'Order ' || o as content, null::varchar as description, null::double as confidence, (o % 5)::int as page, '1.0,2.0,3.0,' || (o % 90) || '.0' as coord from o
union all select o, 1, 'figure', null, 'Total ' || floor(o_totalprice)::bigint, 0.5, (o % 7)::int, (o % 11) || '.0,2.5,30.0,40.0' from o
union all select o, 2, 'text', o_orderpriority, null, null, null, null from o""")
def variant_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    responses = spark.sql(VARIANTS.replace("{{", "\0").replace("}}", "\1").replace("{orders}", "{o}").replace("\0", "{{").replace("\1", "}}"), o=orders)
    return parsed.elements(responses, "o").withColumn("coord", _join(F.col("coord")))


@registered(f"""
with e as (select *, lower(trim(concat_ws(' ', description, content))) as t, trim(coalesce(content, '')) = '' as blank from ({ELEMENTS}) as e),
c as (select *, case when regexp_matches(coalesce(description, '') || ' ' || coalesce(content, ''), '(?i)logo|emblem|icon|crest|letterhead') then 'logo' when regexp_matches(t, '-?[0-9][0-9,]*(\\.[0-9]+)?') then 'data' else 'no_content' end as figure_class from e)
select doc, pos, case when el_type in ('page_header', 'page_footer', 'page_number') then 'skip' when el_type = 'title' then 'context' else el_type end as route, figure_class,
 el_type = 'figure' and (blank or share < 0.75) as needs_image, case when el_type = 'table' and (blank or share < 0.6) then 'read_image' else 'as_parsed' end as table_route,
 case when el_type = 'figure' then case when figure_class = 'logo' then 'skip' when figure_class = 'no_content' or share < 0.75 then 'read_image' else 'read_text' end end as figure_route from c""")
def element_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, content, description, share = (F.col(c) for c in ("el_type", "content", "description", "share"))
    share = share.cast("double")
    return frame(spark, sf_dir, ELEMENTS).select(
        "doc", "pos", elements.route(kind).alias("route"), elements.figure_class(description, content).alias("figure_class"), elements.needs_image(kind, content, share).alias("needs_image"),
        elements.table_route(kind, content, share).alias("table_route"), F.when(kind == "figure", elements.figure_route(description, content, share)).alias("figure_route"),
    )


@registered("""
with p as (select c_custkey, '/vol/' || lower(c_mktsegment) || '/' || case when c_custkey % 9 = 0 then '.hidden' else 'LCR' end || '/Acme  ' || (c_custkey % 20) || ' /' || c_custkey || case when c_custkey % 7 = 0 then '' else '/main' end || '/f' || c_custkey || '.pptx' as path from {customer})
select c_custkey, path, split_part(path, '/', 3) as team, split_part(path, '/', 4) as report_type, split_part(path, '/', 5) as entity, split_part(path, '/', 6) as entity_id, split_part(path, '/', 7) as entity_name,
 regexp_replace(trim(split_part(path, '/', 5)), '\\s+', ' ', 'g') as entity_ref from p where c_custkey % 9 <> 0 and c_custkey % 7 <> 0""".replace("\\\\", "\\"))
def path_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = "'/vol/' || lower(c_mktsegment) || '/' || case when c_custkey % 9 = 0 then '.hidden' else 'LCR' end || '/Acme  ' || (c_custkey % 20) || ' /' || c_custkey || case when c_custkey % 7 = 0 then '' else '/main' end || '/f' || c_custkey || '.pptx'"
    return files.attributed(spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr("c_custkey", f"{path} as path"), "/vol")


@registered("""
select c_custkey, case when c_custkey % 4 = 0 then null else 'C' || c_custkey end as entity, 'Big Bank ' || c_custkey as spaced from {customer}""")
def entity_from_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("C"), "c_custkey", F.lit("_"), "c_mktsegment", F.lit("_Report_"), F.when(F.col("c_custkey") % 4 == 0, "2024").otherwise("2024-03-31"), F.lit(".pdf"))
    spaced = files.one_spaced(F.concat(F.lit("  Big   Bank\t"), "c_custkey", F.lit(" ")))
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", files.entity_of_file_name(name).alias("entity"), spaced.alias("spaced"))


@registered("""
select s_suppkey, case when s_suppkey % 3 = 0 then '/volumes/a/' || s_suppkey when s_suppkey % 3 = 1 then '/store/tmp/' || s_suppkey else '/mnt/' || s_suppkey end as path,
 case when s_suppkey % 2 = 0 then 'r' || s_suppkey || '.pptx' else 'r' || s_suppkey || '.pdf' end as document from {supplier}""")
def paths_and_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    path = F.concat(F.when(k % 3 == 0, "store:/volumes/a/").when(k % 3 == 1, "store:/tmp/").otherwise("/mnt/"), k)
    id = F.concat(F.lit("r"), k, F.when(k % 2 == 0, ".pptx-s2-img0").otherwise(".pdf-p3-aiparsetxt"))
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", text.storage_path(path).alias("path"), text.source_document(id).alias("document"))


# ---- scalars ----
VALUES = r"""select p_partkey as k, case p_partkey % 8 when 0 then '~' || p_size when 1 then p_size || ',' || (100 + p_partkey % 900) || '.5%' when 2 then '$' || p_size || '.4m' when 3 then 'n/a' when 4 then p_type when 5 then 'Q' || (1 + p_size % 4) || ' 2024'
 when 6 then cast(1900 + p_partkey % 150 as string) else p_name || ' of the report' end as v, case when p_partkey % 3 = 0 then 'period end' else 'headcount' end as f from {part}"""
_DATE_SQL = "(?i)^\\s*(?:" + "|".join(dates.DATE_FORMS) + ")\\s*$"
_IS_DATE = f"""(not (regexp_matches(v, '\\d\\.\\d') and try_cast(replace(v, ',', '') as double) is not null) and (regexp_matches(v, '{_DATE_SQL}') or (regexp_matches(v, '^\\s*(19|20)\\d\\d\\s*$') and regexp_matches(f, '(?i)date|period'))))"""
_MEASURE = f"case when not {_IS_DATE} then try_cast(nullif(replace(regexp_extract(v, '-?\\d+(,\\d\\d\\d)*(\\.\\d+)?'), ',', ''), '') as double) end"


@registered(f"""
with v as ({VALUES}) select k, v, {_MEASURE} as measure, try_cast(nullif(regexp_extract(replace(v, ',', ''), '-?\\d+(\\.\\d+)?'), '') as double) as first_number,
 regexp_matches(v, '-?\\d[\\d,]*(\\.\\d+)?') as has_number, regexp_matches(v, '\\d') as has_digit from v""")
def numeric_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, f = F.col("v"), F.col("f")
    return frame(spark, sf_dir, VALUES).select("k", "v", numbers.measure(v, f).alias("measure"), numbers.first_number(v).alias("first_number"), numbers.has_number(v).alias("has_number"), numbers.has_digit(v).alias("has_digit"))


@registered("""
with p as (select p_partkey as k, case when p_partkey % 5 <> 0 then p_size / 13 end as share from {part})
select k, round_even(share, 4) as rounded, case when share is null then 'n/a' else printf('%.1f%%', share * 100) end as percent from p""")
def shares_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = F.when(F.col("p_partkey") % 5 != 0, F.col("p_size") / 13)
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("k"), numbers.rounded(share).alias("rounded"), numbers.percent(share).alias("percent"))


@registered(f"""
with l as ({LINES}), t as (select o, n, 'from ' || (p - p % 50) || ' to -' || q || '.5 and 1,' || lpad((p % 1000)::varchar, 3, '0') as t, p from l)
select o, n, array_to_string(list_transform(regexp_extract_all(t, '-?\\d[\\d,]*(?:\\.\\d+)?'), lambda x: replace(x, ',', '')::double::varchar), ',') as numbers, (p - p % 50) % 100 = 0 as first_is_round from t""")
def round_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.expr("'from ' || (p - p % 50) || ' to -' || q || '.5 and 1,' || lpad(cast(p % 1000 as string), 3, '0')")
    found = numbers.numbers_in(words)
    return frame(spark, sf_dir, LINES).select("o", "n", _join(found).alias("numbers"), numbers.is_round(found[0]).alias("first_is_round"))


DATED = """select o_orderkey as k, case o_orderkey % 12 when 0 then 'Q1 ' || year(o_orderdate) when 1 then year(o_orderdate) || ' H2' when 2 then lpad(cast(day(o_orderdate) as string), 2, '0') || '/' || lpad(cast(month(o_orderdate) as string), 2, '0') || '/' || year(o_orderdate)
 when 3 then cast(day(o_orderdate) as string) || ' March ' || year(o_orderdate) when 4 then ' Apr-' || (10 + o_orderkey % 80) when 5 then cast(year(o_orderdate) as string) when 6 then (1000 + o_orderkey % 900) || '.0' when 7 then year(o_orderdate) || '.04'
 when 8 then 'As at 30 June ' || year(o_orderdate) when 9 then 'December ' || year(o_orderdate) || ' year end' when 10 then 'the Q1 2024 report' else '31-Mar-26' end as v, case when o_orderkey % 5 = 0 then 'Reporting Period' else 'transactions' end as f from {orders}"""


@registered(f"""
with v as ({DATED}) select k, v, {_IS_DATE} as is_date, case when regexp_matches(v, '{_DATE_SQL}') or regexp_matches(v, '^\\s*(19|20)\\d\\d\\s*$') then trim(v) end as report_date from v""")
def date_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("v")
    return frame(spark, sf_dir, DATED).select("k", "v", dates.is_date(v, F.col("f")).alias("is_date"), dates.report_date(v).alias("report_date"))


@registered("""
select o_orderkey, case o_orderkey % 4 when 0 then monthname(o_orderdate) || ' ' || year(o_orderdate) when 1 then year(o_orderdate) || ' Q1' when 2 then year(o_orderdate)::varchar end as report_date from {orders}""")
def report_date_from_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, k = F.col("o_orderdate"), F.col("o_orderkey")
    name = F.when(k % 4 == 0, F.concat(F.lit("LCR_BankABC_"), F.date_format(d, "MMMM_yyyy"))).when(k % 4 == 1, F.concat(F.lit("Micro-Report-"), F.year(d), F.lit("-Q1"))).when(k % 4 == 2, F.concat(F.lit("v1.2 plan "), F.year(d))).otherwise(F.lit("untitled"))
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", dates.date_of_file(F.concat(F.lit("/in/"), name, F.lit(".pptx"))).alias("report_date"))


@registered(f"""
with l as ({LINES}) select o, n, case n % 6 when 0 then '£m' when 1 then '%' when 2 then 'bps' when 3 then '$bn' when 4 then 'million' end as unit from l""")
def unit_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.expr("case n % 6 when 0 then '£' || p || 'm' when 1 then q || '%' when 2 then q || ' bps' when 3 then '$' || p || ' Bn' when 4 then p || ' Million' else cast(p as string) end")
    return frame(spark, sf_dir, LINES).select("o", "n", text.unit_of(value).alias("unit"))


# ---- extractors ----
@registered(f"""
with l as ({LINES}), v as (
 select o, n, 1 as k, 'In the order ' || o || ' line ' || n as name, '£' || p || 'm' as value, '£m' as unit from l
 union all select o, n, 2, n || ' £' || p || 'm with a discount of', q || '%', '%' from l)
select o, n, k, name as field_name, value, unit from v""")
def prose_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frame(spark, sf_dir, LINES).select("o", "n", F.expr("'In the order ' || o || ' line ' || n || '  £' || p || 'm with a discount of ' || q || '% and a bare ' || n").alias("content"))
    return prose.prose_values(df.withColumnRenamed("n", "line"), words=6).select("o", F.col("line").alias("n"), F.col("n").alias("k"), "field_name", "value", "unit")


@registered(f"""
with l as ({LINES}) select o, n, 1 as k, 'Revenue ' || o || ' | Q1' as canonical_metric, '$' || q || 'M' as value, '$m' as unit from l
union all select o, n, 2, 'Revenue ' || o || ' | Q2', '$' || p || 'M', '$m' from l union all select o, n, 3, 'Revenue ' || o || ' | Q3', n || '%', '%' from l""")
def figure_text_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frame(spark, sf_dir, LINES).select("o", F.col("n").alias("line"), F.expr("\"A bar chart titled 'Revenue \" || o || \"' where the data shows Q1 at approximately $\" || q || 'M, Q2 peaking at $' || p || 'M, and Q3 is about ' || n || '%.'").alias("description"))
    return prose.figure_values(df).select("o", F.col("line").alias("n"), F.col("n").alias("k"), "canonical_metric", "value", "unit")


def _html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table for each order: two header rows with spans, a section row, a row for each line with a blank label on every third."""
    lines = frame(spark, sf_dir, LINES)
    row = F.concat(F.lit("<tr><td>"), F.when(F.col("n") % 3 == 0, "").otherwise(F.concat(F.lit("Row  "), F.expr("chr(64 + n)"))), F.lit("</td><td>"), "q", F.lit("</td><td>£"), "p", F.lit("m</td></tr>"))
    body = lines.groupBy("o").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", row.alias("r")))), lambda x: x["r"]), "").alias("body"))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("o"), F.expr("substr(o_orderpriority, 3)").alias("section"))
    head = "<table><tr><th rowspan=2>Line</th><th colspan='2'>Amount</th></tr><tr><th>Quantity</th><th>Price</th></tr><tr><td colspan=3>"
    return body.join(orders, "o").select("o", F.concat(F.lit(head), "section", F.lit("</td></tr>"), "body", F.lit("</table>")).alias("html"))


_TABLE_LINES = f"""l as ({LINES}), r as (select o, n, q, p, substr(o_orderpriority, 3) as section,
 last_value(case when n % 3 <> 0 then 'Row ' || chr(64 + n) end ignore nulls) over (partition by o order by n rows unbounded preceding) as label from l join {{orders}} on o = o_orderkey)"""


@registered(f"""
with {_TABLE_LINES} select o, 'Amount Quantity' as field_name, concat_ws(' | ', section, label, 'Amount Quantity') as canonical_metric, q::varchar as value, null::varchar as unit from r
union all select o, 'Amount Price', concat_ws(' | ', section, label, 'Amount Price'), '£' || p || 'm', '£m' from r""")
def html_table_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.table_claims(_html(spark, sf_dir), "o").select("o", "field_name", "canonical_metric", "value", "unit")


@registered(f"""
with {_TABLE_LINES}, s as (select o, section, string_agg('| ' || case when n % 3 = 0 then '' else 'Row ' || chr(64 + n) end || ' | ' || q || ' | £' || p || 'm |', chr(10) order by n) as body from r group by o, section)
select o, '| Line ' || section || ' | Amount Quantity ' || section || ' | Amount Price ' || section || ' |' || chr(10) || '| --- | --- | --- |' || chr(10) || body as markdown from s""")
def html_table_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.markdown(_html(spark, sf_dir), "o")


@registered("""
with e as (select event_id, event_type, value, event_id % 6 as m from {events}),
p as (select event_id, 0 as k, 'Reading ' || event_type as field_name, event_id::varchar as value, 0.7::double as confidence, null::varchar as unit from e where m in (0, 1, 2)
 union all select event_id, 1, 'Second', '5', 0.25, '%' from e where m in (0, 1, 2) union all select event_id, 0, 'Lone', '7', 0.7, null from e where m = 5)
select * from p""")
def tolerant_json_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("event_id") % 6
    points = F.concat(F.lit('[{"label":"Reading '), "event_type", F.lit('","value":'), "event_id", F.lit('},{"field_name":"Second","value":"5","confidence":0.25,"unit":"%","source_type":"Graph"},7,{"label":"T","value":1,"source_type":"table"},{"label":"N"}]'))
    raw = F.when(m == 0, points).when(m == 1, F.concat(F.lit("Here it is: "), points, F.lit(" as asked."))).when(m == 3, F.lit("no points [at all")).when(m == 4, F.lit('{"metrics":[]}'))
    call = F.when(m == 2, F.concat(F.lit('{"metrics":'), points, F.lit("}"))).when(m == 5, F.lit('{"label":"Lone","value":7}')).when(m == 4, F.lit('{"metrics":[]}'))
    df = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("points", F.when(m.isin(2, 4, 5), jsonx.points_of_call(call)).otherwise(jsonx.points_in(raw)))
    each = charts.points_to_claims(df.select("event_id", F.posexplode("points").alias("k", "point")))
    return each.select("event_id", "k", "field_name", "value", "confidence", "unit")


# ---- quality and layers ----
@registered(f"""
with l as ({LINES}) select o, n, case when n % 4 = 0 then 'not_applicable' when n % 4 in (1, 2) then 'grounded' else 'ungrounded' end as grounding from l""")
def grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.expr("case n % 4 when 1 then '£' || p || 'm' when 2 then 'Total' when 3 then '77777777' else 'x' end")
    source = F.expr("'The TOTAL was ' || p || ' in all'")
    return frame(spark, sf_dir, LINES).select("o", "n", quality.grounding(value, source, F.col("n") % 4 == 0).alias("grounding"))


@registered(f"""
with c as ({CLAIMS}), x as (select *, page = 5 and report_type = 'F' as conflict, confidence < 0.6 and citation_tier <> 'llm_estimated' as weak from c)
select doc, pos, case when conflict or weak then 'review' else 'clean' end as side, case when conflict then 'conflict' when weak then 'low_confidence' end as review_reason from x""")
def review_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = frame(spark, sf_dir, CLAIMS)
    names = spark.createDataFrame([("Line E | F | Price",)], "canonical_metric string")
    clean, review = quality.gated(claims, names)
    return clean.select("doc", "pos", F.lit("clean").alias("side"), F.lit(None).cast("string").alias("review_reason")).unionByName(review.select("doc", "pos", F.lit("review").alias("side"), "review_reason"))


_SENTENCE = "list_has_any(string_split(lower(v), ' '), ['the', 'of', 'report', 'is', 'and', 'for', 'with'])"


@registered(f"""
with v as ({VALUES} union all select n_nationkey, 'Risk Management Overview', 'x' from {{nation}} union all select n_nationkey + 1000000, 'a much longer text that is no value at all', 'x' from {{nation}} union all select n_nationkey + 2000000, 'small blue', 'x' from {{nation}}),
m as (select *, {_MEASURE} as numeric_value, {_IS_DATE} as dated from v)
select k, v as value, numeric_value, case when dated then trim(v) end as as_at_date from m
 where numeric_value is not null or {_IS_DATE.replace("regexp_matches(f, '(?i)date|period')", "false")} or lower(v) = 'n/a'
 or (len(string_split(v, ' ')) <= 4 and length(v) <= 40 and not (len(string_split(v, ' ')) >= 2 and len(list_filter(string_split(v, ' '), lambda w: regexp_matches(w, '^[A-Z]'))) >= 2) and not (len(string_split(v, ' ')) >= 3 and {_SENTENCE}))""")
def metric_like_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = "select cast(n_nationkey as bigint) as k, 'Risk Management Overview' as v, 'x' as f from {nation} union all select n_nationkey + 1000000, 'a much longer text that is no value at all', 'x' from {nation} union all select n_nationkey + 2000000, 'small blue', 'x' from {nation}"
    claims = frame(spark, sf_dir, VALUES).unionByName(frame(spark, sf_dir, more)).select("k", F.col("v").alias("value"), F.col("f").alias("field_name"))
    return layers.gold(claims).select("k", "value", "numeric_value", "as_at_date")


_HASH = "substr(sha256(concat_ws('|', entity_ref, source_document, page::varchar, canonical_metric, value, coalesce(as_at_date, 'None'))), 1, 16)"


@registered(f"""with c as ({CLAIMS}) select doc, pos, '2026-01-01T00:00:00+00:00' as extraction_date, 'December 2025' as report_date, {_HASH} as content_hash from c""")
def stamp_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = layers.stamped(frame(spark, sf_dir, CLAIMS), {"report_date": F.lit("December 2025")}, at=F.lit("2026-01-01T00:00:00+00:00"))
    return out.select("doc", "pos", "extraction_date", "report_date", "content_hash")


@registered(f"""with c as ({CLAIMS}) select doc, pos, {_HASH} as content_hash from c""")
def idempotent_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some rows are stored, then all of them come, each twice."""
    rows, path = layers.stamped(frame(spark, sf_dir, CLAIMS), {}), f"{scratch.fresh_path(spark, 'append')}/claims"
    twice = rows.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    for some in (rows.where("page = 2"), twice):
        layers.append(some, path)
    return layers.stored_rows(spark, path).select("doc", F.col("pos").cast("int").alias("pos"), "content_hash")


@registered(f"""with c as ({CLAIMS}) select doc, pos, element_type, citation_tier from c where not (citation_tier = 'llm_estimated' and element_type = 'text')""")
def text_echo_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.without_echoes(frame(spark, sf_dir, CLAIMS)).select("doc", "pos", "element_type", "citation_tier")


_TWO = f"""select doc, pos, case when pos % 5 = 0 then null else pos // 2 end as page, case when pos % 2 = 0 then ' £' || (q // 8) || ',0' else (q // 8) || '0%' end as value, pos % 2 = 0 as vision from ({CLAIMS}) as c"""


@registered(f"""
with c as ({_TWO}), n as (select *, regexp_replace(lower(value), '[,£$€%\\s]', '', 'g') as v from c)
select doc, pos from n a where vision and not exists (select 1 from n b where not b.vision and a.doc = b.doc and a.page is not distinct from b.page and a.v = b.v)""")
def vision_vs_rule_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = frame(spark, sf_dir, _TWO.replace(" // ", " div "))
    return quality.without_repeats(both.where("vision"), both.where("not vision")).select("doc", "pos")


@registered(f"""
with c as ({CLAIMS}) select doc, pos, split_part(canonical_metric, ' | ', 1) as statement, split_part(canonical_metric, ' | ', 2) as classification, split_part(canonical_metric, ' | ', 3) as category, null::varchar as sub_category,
 try_cast(regexp_replace(value, '[^0-9.]', '', 'g') as double) as numeric_value, case when confidence > 0.9 then 'confidence' when not regexp_matches(value, '[%m]') then 'unit' end as error from c""")
def validate_and_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = layers.typed(layers.analytical(frame(spark, sf_dir, CLAIMS).withColumn("numeric_value", F.regexp_replace("value", "[^0-9.]", ""))))
    good, bad = layers.checked(rows, {"confidence": F.col("confidence") <= 0.9, "unit": F.col("value").rlike("[%m]")})
    return good.withColumn("error", F.lit(None).cast("string")).unionByName(bad).select("doc", "pos", "statement", "classification", "category", "sub_category", "numeric_value", "error")


# ---- evaluation ----
_TRUTH = f"""select row_number() over (order by doc, pos) as truth_no, upper(doc) as document, page, element_type, 'price line ' || chr(64 + pos) as field_name,
 case when pos % 4 = 1 then '0.5' when element_type = 'figure' then cast(p * 1.02 as string) else value end as value, case when pos % 3 = 2 then 'no' else 'Yes' end as should_extract from ({CLAIMS}) as c where q % 2 = 0"""


@registered(f"""
with c as ({CLAIMS}), t as (select *, q % 2 as odd, case when pos % 4 = 1 then false when element_type = 'figure' then abs(p - p * 1.02) / abs(p * 1.02) <= 0.03 else true end as hit, pos % 3 <> 2 as wanted from c where q % 2 = 0),
o as (select element_type, case when wanted then case when hit then 'TP' else 'FN' end else case when hit then 'FP' else 'TN' end end as x from t),
s as (select element_type, count(*) filter (x = 'TP') as tp, count(*) filter (x = 'FP') as fp, count(*) filter (x = 'FN') as fn, count(*) filter (x = 'TN') as tn from o group by rollup (element_type)),
m as (select *, tp / nullif(tp + fp, 0) as precision, tp / nullif(tp + fn, 0) as recall, (tp + tn) / nullif(tp + fp + fn + tn, 0) as accuracy from s)
select *, case when precision > 0 and recall > 0 then 2 * precision * recall / (precision + recall) end as f1 from m""")
def accuracy_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = frame(spark, sf_dir, CLAIMS)
    truth = claims.where("q % 2 = 0").select(
        (F.expr("cast(substr(doc, 5, length(doc) - 9) as bigint)") * 10 + F.col("pos")).alias("truth_no"), F.upper("doc").alias("document"), "page", "element_type", F.expr("'price line ' || chr(64 + pos)").alias("field_name"),
        F.expr("case when pos % 4 = 1 then '0.5' when element_type = 'figure' then cast(cast(p as double) * 1.02D as string) else value end").alias("value"), F.expr("case when pos % 3 = 2 then 'no' else ' Yes' end").alias("should_extract"),
    )
    return evaluate.confusion(evaluate.matched(truth, claims.withColumn("claim_no", F.col("pos"))))


@registered(f"""
with l as ({LINES}), g as (select o, count(distinct n) as got from l where n <> 4 group by o), t as (select 'doc_' || o_orderkey || '.pdf' as document, o_orderkey as o, 7 as total from {{orders}}),
s as (select document, sum(total)::bigint as total_pages, sum(coalesce(got, 0))::bigint as pages_processed from t left join g using (o) group by rollup (document))
select *, pages_processed / total_pages as coverage, total_pages - pages_processed as missing_pages from s""")
def coverage_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = frame(spark, sf_dir, LINES).select(F.expr("'DOC_' || o || '.PDF'").alias("source_document"), F.expr("case when n <> 4 then n end").alias("page"))
    totals = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.expr("'doc_' || o_orderkey || '.pdf'").alias("document"), F.lit(7).cast("long").alias("total_pages"))
    return evaluate.page_coverage(got, totals)


_MADE = f"select doc, pos, page, el_type as element_type from ({ELEMENTS}) as e where el_type in ('text', 'table') and page <> 3 and pos % 4 <> 0"


@registered(f"""
with e as (select *, regexp_matches(coalesce(description, '') || ' ' || coalesce(content, ''), '(?i)logo') as ornament from ({ELEMENTS}) as e), c as ({_MADE}), k as (select doc, page, count(*) as k from c group by doc, page),
m as (select e.*, coalesce(k.k, 0) as k, case when el_type = 'page_footer' or (el_type = 'figure' and ornament) then 'skipped' when k.k is not null then 'accounted' else 'unaccounted' end as state from e left join k on e.doc = k.doc and e.page = k.page),
s as (select doc, count(*) as elements_total, count(*) filter (state = 'accounted') as elements_accounted, count(*) filter (state = 'skipped') as elements_skipped, count(*) filter (state = 'unaccounted') as elements_unaccounted, count(distinct page) as pages_total,
 count(distinct case when k = 0 then page end) as empty_pages, coalesce((list(pos order by pos) filter (state = 'unaccounted'))[1:50], []) as gaps from m group by doc),
y as (select doc, string_agg(el_type || '=' || n, ',' order by el_type) as by_type from (select doc, el_type, count(*) as n from e group by doc, el_type) group by doc),
g as (select doc, string_agg(page || '=' || k, ',' order by page) as by_page from k where page is not null group by doc)
select doc, elements_total, elements_accounted, elements_skipped, elements_unaccounted, pages_total, empty_pages, coalesce(t.n, 0) as claims_total, 100 * elements_accounted / greatest(1, elements_total - elements_skipped) as accounted_pct,
 array_to_string(gaps, ',') as gaps, by_type, coalesce(by_page, '') as by_page, elements_unaccounted <= 5 and empty_pages <= 1 as coverage_ok from s join y using (doc) left join g using (doc) left join (select doc, count(*) as n from c group by doc) t using (doc)""")
def coverage_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frame(spark, sf_dir, ELEMENTS).withColumn("ornament", text.is_ornament(F.col("description"), F.col("content")))
    out = evaluate.coverage_ok(evaluate.coverage_audit(df, frame(spark, sf_dir, _MADE)), 5, 1)
    gaps = _join(F.transform("gap_sample", lambda g: g["pos"])).alias("gaps")
    pairs = lambda c: _join(F.transform(F.array_sort(F.map_entries(c)), lambda x: F.concat_ws("=", x["key"].cast("string"), x["value"].cast("string"))))
    return out.select("doc", "elements_total", "elements_accounted", "elements_skipped", "elements_unaccounted", "pages_total", "empty_pages", "claims_total", "accounted_pct", gaps, pairs("elements_by_type").alias("by_type"), pairs("claims_by_page").alias("by_page"), "coverage_ok")


_MODALITY_SQL = f"""
e as ({ELEMENTS}), c as ({_MADE}), es as (select doc, count(*) as n_elements, list_distinct(list(page)) as ep, list_distinct(list(el_type)) as et from e group by doc), cs as (select doc, count(*) as n_claims, list_distinct(list(page)) as cp, list_distinct(list(element_type)) as ct from c group by doc),
b as (select es.*, coalesce(n_claims, 0) as n_claims, coalesce(cp, []) as cp, coalesce(ct, []) as ct, 15 as total from es left join cs using (doc)),
cov as (select doc, total as total_pages, len(ep)::int as pages_with_elements, len(cp)::int as pages_with_claims, list_sort(list_filter(ep, lambda x: not list_contains(cp, x))) as missing, list_sort(list_filter(range(0, total), lambda x: not list_contains(ep, x))) as unseen,
 len(cp) / total as page_coverage, list_sort(list_filter(et, lambda x: not list_contains(ct, x) and x <> 'page_footer')) as types, n_elements, n_claims from b)"""


def _modality(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frame(spark, sf_dir, ELEMENTS)
    return evaluate.modality_coverage(df, frame(spark, sf_dir, _MADE), df.select("doc").distinct().withColumn("pages_in_doc", F.lit(15)))


@registered(f"""with {_MODALITY_SQL} select doc, total_pages, pages_with_elements, pages_with_claims, array_to_string(missing, ',') as pages_missing_claims, array_to_string(unseen, ',') as pages_no_elements, page_coverage, array_to_string(types, ',') as types_missing, n_elements, n_claims from cov""")
def coverage_modality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _modality(spark, sf_dir)
    return out.withColumns({c: _join(F.col(c)) for c in ("pages_missing_claims", "pages_no_elements", "types_missing")})


@registered(f"""with {_MODALITY_SQL} select count(*) as documents, sum(total_pages)::bigint as total_pages, sum(pages_with_claims)::bigint as pages_with_claims, sum(pages_with_claims) / sum(total_pages) as page_coverage, sum(len(missing))::bigint as pages_missing_claims_total,
 sum(len(unseen))::bigint as pages_no_elements_total, sum(n_claims)::bigint as claims_total from cov""")
def run_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.run_summary(_modality(spark, sf_dir))


@registered(f"""with c as ({CLAIMS}) select team, count(*) as n_claims, avg((citation_tier = 'parsed')::int) as grounded_parsed_frac, avg((citation_tier = 'llm_estimated')::int) as llm_estimated_frac, avg((grounding = 'grounded')::int) as grounded_verified_frac from c group by team""")
def faithfulness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.faithfulness(frame(spark, sf_dir, CLAIMS), "team")


@registered(f"""
with c as ({CLAIMS}), d as (select team, doc, count(distinct page) as k, count(*) as n from c group by all), s as (select team as run, count(*) as documents, count(*) * 7 as total_pages, sum(k) as pages_with_claims, sum(7 - k) as pages_missing_claims_total, sum(n) as claims_total from d group by team),
f as (select team as run, avg((citation_tier = 'parsed')::int) as parsed, avg((grounding = 'grounded')::int) as verified from c group by team), r as (select unnest(['A', 'N', 'none', 'R']) as run),
m as (select run, coalesce(documents, 0) as documents, coalesce(total_pages, 0) as total_pages, coalesce(pages_with_claims, 0) as pages_with_claims, coalesce(pages_missing_claims_total, 0) as missing, coalesce(claims_total, 0) as claims_total, coalesce(parsed, 0) as parsed, coalesce(verified, 0) as verified from r left join s using (run) left join f using (run))
select run, documents::bigint as documents, total_pages::bigint as total_pages, pages_with_claims::bigint as pages_with_claims, missing::bigint as pages_missing_claims_total, claims_total::bigint as claims_total, coalesce(pages_with_claims / nullif(total_pages, 0), 0) as page_coverage, parsed as grounded_parsed_frac, verified as grounded_verified_frac,
 documents / 30::double * 60 as docs_per_min, 30::double / nullif(total_pages, 0) as seconds_per_page, 2e6 / 1e6 * 3 + 1e5 / 1e6 * 15 + total_pages * 0.005::double as total_cost_usd, (2e6 / 1e6 * 3 + 1e5 / 1e6 * 15 + total_pages * 0.005::double) / nullif(documents, 0) as cost_per_doc_usd from m""")
def run_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = frame(spark, sf_dir, CLAIMS).withColumn("run", F.col("team"))
    pages = claims.groupBy("run", "doc").agg(F.countDistinct("page").cast("int").alias("pages_with_claims"), F.count("*").alias("n_claims"))
    coverage = pages.withColumns({"total_pages": F.lit(7), "pages_missing_claims": F.array_repeat(F.lit(0), 7 - F.col("pages_with_claims")), "pages_no_elements": F.array().cast("array<int>")})
    runs = spark.createDataFrame([(r, 30.0, 2_000_000, 100_000) for r in ("A", "N", "none", "R")], "run string, elapsed_seconds double, input_tokens long, output_tokens long")
    out = evaluate.run_evaluation(runs, coverage, claims, parse_rate=0.005)
    return out.select(
        "run", "documents", "total_pages", "pages_with_claims", "pages_missing_claims_total", "claims_total", "page_coverage", "grounded_parsed_frac", "grounded_verified_frac", "docs_per_min", "seconds_per_page", "total_cost_usd", "cost_per_doc_usd"
    )


_BATCH = f"select team, count(distinct doc) as documents, count(*) as claims, count(distinct doc) * 7 as pages, count(case when confidence >= 0.6 then 1 end) as gold, count(case when confidence < 0.6 then 1 end) as review, count(case when page = 7 then 1 end) as quarantined, sum(q) * 1000 as input_tokens, sum(q) * 100 as output_tokens, cast(count(*) as double) / 10 as elapsed_seconds, cast(count(distinct doc) as double) / 100 as llm_cost_usd from ({CLAIMS}) as c group by team"


@registered(f"""
with b as ({_BATCH}), t as (select *, llm_cost_usd + pages * 0.005 as total from b)
select team, claims / documents as metrics_per_document, 100 * gold / claims as gold_rate_pct, 100 * review / claims as review_rate_pct, 100 * quarantined / (documents + quarantined) as quarantine_rate_pct, 100 * documents / (documents + quarantined) as success_rate_pct,
 total as total_cost_usd, total / documents as cost_per_document_usd, total / claims as cost_per_metric_usd from t""")
def scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = evaluate.scorecard(frame(spark, sf_dir, _BATCH))
    return out.select("team", "metrics_per_document", "gold_rate_pct", "review_rate_pct", "quarantine_rate_pct", "success_rate_pct", "total_cost_usd", "cost_per_document_usd", "cost_per_metric_usd")


@registered(f"""
with b as ({_BATCH}) select team, documents / elapsed_seconds * 60 as docs_per_min, pages / elapsed_seconds * 60 as pages_per_min, claims / elapsed_seconds * 60 as claims_per_min, elapsed_seconds / documents as seconds_per_doc, elapsed_seconds / pages as seconds_per_page,
 input_tokens / 1e6 * 3 + output_tokens / 1e6 * 15 as llm_cost_usd, pages * 0.005::double as parse_cost_usd, (input_tokens / 1e6 * 3 + output_tokens / 1e6 * 15 + pages * 0.005) / documents as cost_per_doc_usd from b""")
def speed_and_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = evaluate.cost(evaluate.speed(frame(spark, sf_dir, _BATCH)), parse_rate=0.005)
    return out.select("team", "docs_per_min", "pages_per_min", "claims_per_min", "seconds_per_doc", "seconds_per_page", "llm_cost_usd", "parse_cost_usd", "cost_per_doc_usd")


@registered(f"""
with c as ({CLAIMS}), q as (select team, 100 * avg((grounding = 'grounded')::int) as g, avg(confidence) as a, 100 * avg((citation_tier = 'parsed')::int) as p from c where team in ('R', 'N') group by team)
select 'grounded_pct' as metric, max(g) filter (team = 'R') as a, max(g) filter (team = 'N') as b from q union all select 'avg_confidence', max(a) filter (team = 'R'), max(a) filter (team = 'N') from q union all select 'parsed_tier_pct', max(p) filter (team = 'R'), max(p) filter (team = 'N') from q""")
def scorecards_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = frame(spark, sf_dir, CLAIMS)
    a, b = (evaluate.stored_quality(claims.where(F.col("team") == t)) for t in "RN")
    return evaluate.side_by_side(a, b, ["grounded_pct", "avg_confidence", "parsed_tier_pct"])


_RUN_B = f"""select doc, source_document, pos, page, field_name, canonical_metric, element_type, case when page = 3 then case when element_type = 'figure' then cast(p + floor(p / 50) as bigint) || '%' else value || '1' end else value end as value from ({CLAIMS}) as c where page <> 6"""


@registered(f"""
with a as (select element_type, doc, page, canonical_metric, value from ({CLAIMS}) as c), b as (select element_type, doc, page, canonical_metric, value from ({_RUN_B}) as r),
s as (select element_type, count(*) as n from (select * from a intersect all select * from b) group by 1), x as (select element_type, count(*) as n from (select * from a except all select * from b) group by 1), y as (select element_type, count(*) as n from (select * from b except all select * from a) group by 1),
t as (select element_type, coalesce(s.n, 0) as s, coalesce(x.n, 0) as x, coalesce(y.n, 0) as y from s full join x using (element_type) full join y using (element_type)),
r as (select element_type, sum(s)::bigint as stable, sum(x)::bigint as only_a, sum(y)::bigint as only_b from t group by rollup (element_type)) select *, stable / (stable + only_a + only_b) as reproducibility from r""")
def robustness_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.reproducibility(frame(spark, sf_dir, CLAIMS), frame(spark, sf_dir, _RUN_B))


@registered(f"""with c as ({CLAIMS}) select replace(lower(doc), '.pptx', '') as doc, page, lower(canonical_metric) as field, 1 as recovered from c where page = 3 and element_type = 'figure' and p > 0 and floor(p / 50) > 0 and floor(p / 50) / (p + floor(p / 50)) <= 0.03""")
def robustness_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.recovered(frame(spark, sf_dir, CLAIMS), frame(spark, sf_dir, _RUN_B))


# ---- charts ----
def _figures(spark: SparkSession, sf_dir: str, labels: Column) -> DataFrame:
    """A chart for each supplier: 12 slots 50 apart, each of one or two bars with a little jitter; ``labels`` by slot."""
    k = F.col("s_suppkey")
    bars = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: F.transform(F.sequence(F.lit(0), (k % 2).cast("int")), lambda j: F.struct((i * 2 + j).cast("int").alias("id"), F.concat(F.lit("s"), j).alias("series"), (i * 10 + j).cast("string").alias("value"), (i * 50.0 + j * 3 + k % 3).alias("x_center")))))
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", bars.alias("bars"), labels.alias("labels"))


def _label(k: int, label: Column) -> Column:
    return F.struct(label.alias("text"), F.lit(k * 50.0 + 1).alias("x_center"))


def _periods(df: DataFrame) -> DataFrame:
    return charts.resolved(df).select("s_suppkey", "status", F.explode("periods").alias("p")).select("s_suppkey", "status", F.col("p.id").alias("bar"), F.col("p.period").alias("period"))


_BARS = "b as (select s_suppkey, unnest(range(0, 12)) as i from {supplier}), z as (select s_suppkey, i, unnest(range(0, 1 + s_suppkey % 2)) as j from b)"


@registered(f"""with {_BARS} select s_suppkey, (i * 2 + j)::int as bar, i::int as slot, (i * 50.0 + s_suppkey % 3 + case when s_suppkey % 2 = 1 then 1.5 else 0 end)::double as centre from z""")
def axis_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = charts.slots(F.col("bars"), F.lit(8.0))
    each = _figures(spark, sf_dir, F.array()).select("s_suppkey", F.posexplode(found).alias("slot", "s"))
    return each.select("s_suppkey", F.explode("s.ids").alias("bar"), "slot", (F.col("s.sum") / F.col("s.n")).alias("centre"))


@registered(f"""with {_BARS} select s_suppkey, case when s_suppkey % 10 = 7 then 'flag' else 'geometry' end as status, (i * 2 + j)::int as bar, strftime(make_date(2023 + (s_suppkey % 3)::int, 11, 1) + to_months((i - 2)::int), '%B %Y') as period from z""")
def axis_periods_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    labels = F.array(_label(2, F.concat(F.lit("Nov '"), F.lit(23) + k % 3)), _label(5, F.concat(F.lit("February 202"), 4 + k % 3)), _label(8, F.when(k % 10 == 7, "June").otherwise("May")))
    return _periods(_figures(spark, sf_dir, labels))


@registered(f"""with {_BARS} select s_suppkey, 'geometry_month' as status, (i * 2 + j)::int as bar, monthname(make_date(2000, 1 + ((9 + i - 1 + 12) % 12)::int, 1)) as period from z""")
def axis_periods_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _periods(_figures(spark, sf_dir, F.array(_label(1, F.lit("Oct.")), _label(4, F.lit("january")), _label(9, F.lit("x")))))


@registered(f"""with {_BARS} select s_suppkey, case when s_suppkey % 10 = 7 then 'flag' else 'geometry' end as status, (i * 2 + j)::int as bar, case when (i % 2) = 0 then (i / 2 + 3)::int::varchar else (i * 0.5 + 3)::double::varchar end as period from z""")
def axis_periods_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = F.array(_label(2, F.lit("4")), _label(4, F.when(F.col("s_suppkey") % 10 == 7, "77").otherwise("5")), _label(10, F.lit("8.")))
    return _periods(_figures(spark, sf_dir, labels))


@registered(f"""
with {_BARS}, m as (select *, 1 + s_suppkey % 2 as per, case when j = 0 and i = 2 then 'Nov 2023' when j = 0 and i = 5 then case when s_suppkey % 10 = 7 then 'June?' else 'May-24' end when j = 0 and i = 8 then 'x' end as printed from z)
select s_suppkey, case when s_suppkey % 10 = 7 then 'flag' else 'geometry' end as status, (i * 2 + j)::int as bar,
 coalesce(printed, case when s_suppkey % 10 = 7 then 'FLAG_REVIEW' else strftime(make_date(2023, 11, 1) + to_months(((i * per + j - 2 * per) * (2 / per))::int), '%B %Y') end) as period from m""")
def axis_two_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = F.array(_label(2, F.lit("Nov 2023")), _label(5, F.when(F.col("s_suppkey") % 10 == 7, "June?").otherwise("May-24")), _label(8, F.lit("overruled")), _label(8, F.lit("x")))
    out = charts.anchored(_figures(spark, sf_dir, labels)).select("s_suppkey", "status", F.explode("periods").alias("p"))
    return out.select("s_suppkey", "status", F.col("p.id").alias("bar"), F.col("p.period").alias("period"))


@registered(f"""with {_BARS} select s_suppkey, (i * 2 + j)::int as bar, strftime(make_date(2024, 1, 1) + to_months(i::int), '%B %Y') as period from z where j = 0""")
def period_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = charts.resolved(_figures(spark, sf_dir, F.array(_label(0, F.lit("2024-01")))))
    claims = df.select("s_suppkey", F.explode("bars").alias("b")).where("b.series = 's0'").select("s_suppkey", F.col("b.id").alias("bar"), F.col("b.series").alias("field_name"), F.col("b.value").alias("value"))
    return charts.with_periods(claims, df, "s_suppkey").select("s_suppkey", "bar", "period")


BOXES = """select s_suppkey as doc, 0 as pos, 'title' as el_type, 1 as page, 10 as l, 0 as t, 500 as r, 20 as b from {supplier} union all select s_suppkey, 1, 'figure', 1, 100, 40, 300, 200 + s_suppkey % 50 from {supplier} union all select s_suppkey, 2, 'footnote', 1, 90, 210, 310, 290 from {supplier}
 union all select s_suppkey, 3, 'figure', 1, 100, 280, 300, 400 from {supplier} union all select s_suppkey, 4, 'figure', 1, 320, 40, 420, 150 from {supplier}"""


@registered("""
select s_suppkey as doc, 1 as pos, 1 as page, 10 as x0, 0 as y0, 315 as x1, 275 as y1 from {supplier}
union all select s_suppkey, 3, 1, 100, 280, 300, 400 from {supplier}
union all select s_suppkey, 4, 1, 320, 40, 420, 150 from {supplier}""")
def figure_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frame(spark, sf_dir, BOXES).withColumn("coord", F.array(*[F.col(c).cast("double") for c in "ltrb"]))
    return regions.figure_regions(df)


# ---- consumption ----
@registered(f"""with c as ({CLAIMS}) select doc, pos, value from c where team = 'R' and report_type = 'F' and entity_ref = 'E7'""")
def gold_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.filtered(frame(spark, sf_dir, CLAIMS), "R", "F", entity="E7").select("doc", "pos", "value")


@registered(f"""with c as ({CLAIMS}) select team, report_type, page, count(*) as claims from c group by all""")
def gold_by_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = frame(spark, sf_dir, CLAIMS)
    parts = [claims.where(F.col("team") == t) for t in "ANR"]
    parts[0] = parts[0].drop("grounding")
    return query.united(parts).groupBy("team", "report_type", "page").agg(F.count("*").alias("claims"))


@registered(r"""select conv_id, turn, case when regexp_matches(coalesce(t, ''), '(?i)\b(?:total|trend|how much)\b|over \d+ years') then 'structured' else 'narrative' end as route from
 (select *, case turn % 5 when 0 then 'What is the total of ' || role when 1 then 'Growth over 5 years' when 2 then 'How Much was it?' when 3 then 'Totally unclear' else text end as t from {conversations})""")
def route_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.expr("case turn % 5 when 0 then 'What is the total of ' || role when 1 then 'Growth over 5 years' when 2 then 'How Much was it?' when 3 then 'Totally unclear' else text end")
    return spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", query.question_route(q).alias("route"))


_FIRMS = [("Nation _1", 1, 3), ("NATION_12 plc", 2, 6), ("nation_2", 3, 12), ("Other", 4, 1)]


@registered("""
with f as (select * from (values ('nation_1', 1, 3), ('nation_12plc', 2, 6), ('nation_2', 3, 12), ('other', 4, 1)) as f(k, position, step)), n as (select n_nationkey, n_name, lower(n_name) as e from {nation}),
m as (select n_nationkey, n_name, position, step, row_number() over (partition by n_nationkey order by position) as i from n join f on contains(e, k) or contains(k, e))
select n.n_nationkey, n.n_name, m.position, m.step from n left join m on n.n_nationkey = m.n_nationkey and m.i = 1""")
def firm_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    firms = spark.createDataFrame(_FIRMS, "firm string, position int, step int")
    return match.with_firm(spark.read.parquet(f"{sf_dir}/nation.parquet"), "n_name", firms).select("n_nationkey", "n_name", "position", "step")


@registered("""
with n as (select n_nationkey, starts_with(lower(n_name), 'nation_2') as known from {nation})
select n_nationkey, case when known then 'system,user,assistant,user' else 'system,user' end as roles, case when known then 'i1,' else '' end || 'img' || n_nationkey as images, known as noted, case when known then '{"claims":[]}' end as answer from n""")
def example_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = [("i1", "Mind the offset scale.", '{"claims":[]}'), ("i2", None, None), (None, " ", "[]")]
    firms = spark.createDataFrame([("Nation _2", 1, shown), ("other", 2, None)], f"firm string, position int, examples {prompts.EXAMPLES}")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").withColumn("image_uri", F.concat(F.lit("img"), "n_nationkey"))
    said = F.col("messages")
    part = lambda name: F.array_join(F.transform(said, lambda m: m[name]), ",")
    answer = F.filter(said, lambda m: m["role"] == "assistant")
    return prompts.with_messages(nation, "n_name", firms).select(
        "n_nationkey", part("role").alias("roles"), part("image").alias("images"), F.endswith(said[0]["text"], F.lit("\nMind the offset scale.")).alias("noted"), F.try_element_at(answer, F.lit(1))["text"].alias("answer")
    )


@registered("""
select vec_id from (select vec_id, list_cosine_similarity(embedding::double[], (select embedding::double[] from {embeddings} where vec_id = 0)) as s from {embeddings}) order by round(s, 12) desc, vec_id limit 10""")
def topk_narrative(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    wanted = df.where("vec_id = 0").first()["embedding"]  # one vector: the question
    return chunks.top_matches(df, wanted, 10).select("vec_id")


@registered("""
with e as (select user_id, event_id, event_type, row_number() over w - 1 as place, lag(event_type) over w as before, lead(event_type, 2) over w as after, row_number() over (partition by user_id, event_type order by event_id) as i, row_number() over (partition by user_id, event_type order by event_id desc) as j
 from {events} window w as (partition by user_id order by event_id)) select user_id, event_id, event_type, place::int as place, before, after, i = 1 as first_of_kind, j = 1 as last_of_kind from e""")
def page_runs_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_id", "event_type")
    rows = history.neighbours(history.placed(rows, "user_id", "event_id"), "user_id", "event_id", "event_type", before=-1, after=2)
    return history.ends_of_kind(rows, ["user_id", "event_type"], "event_id")


@registered("""select user_id, arg_min(event_type, event_id) as first_type, arg_max(event_type, event_id) as last_type from {events} group by user_id""")
def first_and_last_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_id", "event_type")
    first, last = (history.picked(rows, ["user_id"], F.col("event_id"), x).select("user_id", F.col("event_type").alias(f"{name}_type")) for name, x in (("first", False), ("last", True)))
    return first.join(last, "user_id")


@registered("""select case when s_suppkey % 3 = 0 then 'UNKNOWN_ENTITY_REF' else s_name end as entity_ref, s_suppkey from {supplier}""")
def entity_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.expr("case when s_suppkey % 3 = 0 then '' else s_name end")
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(text.entity_or_unknown(name).alias("entity_ref"), "s_suppkey")


@registered("""
with d as (select s_suppkey as doc, s_suppkey % 7 as gap from {supplier}),
i as (select doc, k as pos, case when k % 4 = 3 then null else k + gap end as page, 'img' || doc || '-' || k as image_uri from d, unnest(generate_series(0, 5)) as t(k) where doc % 3 <> 0 or k <> 2),
n as (select doc, coalesce(page, pos) as number, arg_min(image_uri, (page is null, pos)) as image_uri from i group by doc, coalesce(page, pos)),
w as (select doc, k::int as page from d, unnest(generate_series(0, 13)) as t(k)), f as (select doc, k as place, 'file' || k as path from d, unnest(generate_series(0, doc % 12)) as t(k))
select w.doc, w.page, coalesce(a.image_uri, b.image_uri, f.path) as image_uri from w left join n a on a.doc = w.doc and a.number = w.page
left join n b on b.doc = w.doc and b.number = greatest(w.page - 1, 0) left join f on f.doc = w.doc and f.place = greatest(w.page - 1, 0)""")
def images_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose numbers have gaps, repeat or are missing, and files in order of time for what no listed page serves."""
    docs = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("doc"), (F.col("s_suppkey") % 7).alias("gap"))
    upto = lambda n: docs.select("*", F.explode(F.sequence(F.lit(0), n)).alias("k"))
    listed = upto(F.lit(5)).where("doc % 3 <> 0 or k <> 2").select("doc", F.col("k").alias("pos"), F.when(F.col("k") % 4 != 3, F.col("k") + F.col("gap")).cast("int").alias("page"), F.concat_ws("-", F.concat(F.lit("img"), "doc"), "k").alias("image_uri"))
    by_time = upto((F.col("doc") % 12).cast("int")).select("doc", F.col("k").alias("place"), F.concat(F.lit("file"), "k").alias("path"))
    return parsed.page_images(upto(F.lit(13)).select("doc", F.col("k").alias("page")), listed, by_time).select("doc", "page", "image_uri")


@registered(f"""
with e as ({ELEMENTS}), c as (select doc, page, string_agg('Sales = ' || pos || ' %', chr(10) order by pos) as lines from e where el_type = 'figure' and pos % 3 = 0 group by doc, page)
select e.doc, pos, trim(coalesce(case when el_type = 'figure' and lines is not null then trim(coalesce(description, 'Chart')) || chr(10) || lines when el_type = 'figure' then coalesce(description, content) when el_type = 'table' then content else coalesce(nullif(content, ''), description) end, '')) as text
 from e left join c on e.doc = c.doc and e.page = c.page""")
def chunk_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frame(spark, sf_dir, ELEMENTS)
    claims = df.where("el_type = 'figure' and pos % 3 = 0").select("doc", "page", "pos", F.lit("Sales").alias("field_name"), F.lit(None).cast("string").alias("canonical_metric"), F.col("pos").cast("string").alias("value"), F.lit("%").alias("unit"))
    return chunks.readable(df, None, claims).select("doc", "pos", "text")


@registered("""select date_trunc('hour', ts) as window_start, event_type, count(*) as events, avg(value) as mean_value from {events} group by all""")
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.tumbling_counts(spark.read.parquet(f"{sf_dir}/events.parquet"))


@registered("""select path from (select 'f/' || s_suppkey || '.pptx' as path from {supplier}) order by path limit 7""")
def first_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.expr("'f/' || s_suppkey || '.pptx'").alias("path")).transform(files.first_paths, 7)




# ---- fallbacks ----
@registered("""select p_partkey as k, 'table' as field_name, 'text ' || p_name as value, case when p_partkey % 2 = 0 then 0.5::double else 1.0::double end as confidence from {part} where p_partkey % 3 = 1""")
def whole_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(
        "p_partkey as k", "case p_partkey % 3 when 0 then '<table><tr><td>a</td><td>' || p_size || '</td></tr></table>' when 1 then ' text ' || p_name || ' ' else ' ' end as html", "case when p_partkey % 2 = 0 then 0.5D end as confidence"
    )
    return tables.whole_table_claims(df, tables.table_claims(df, "k"), "k")


@registered(f"""
with e as ({ELEMENTS}) select doc, pos, 'vision' as value from e where el_type = 'figure' and pos % 2 = 0 union all select doc, pos, 'described' from e where el_type = 'figure' and pos % 2 <> 0""")
def vision_or_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    figures = frame(spark, sf_dir, ELEMENTS).where("el_type = 'figure'").select("doc", "pos")
    return charts.or_described(figures.where("pos % 2 = 0").withColumn("value", F.lit("vision")), figures.withColumn("value", F.lit("described")))


@registered("""select event_id, case when event_id % 3 in (0, 1) then 2 else 0 end as points from {events}""")
def embedded_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    call = F.concat(F.lit('{"claims":[{"label":"a","value":'), "event_id", F.lit('},{"label":"b"}]}'))
    raw = F.when(F.col("event_id") % 3 == 0, call).when(F.col("event_id") % 3 == 1, F.concat(F.lit("I call "), call, F.lit(" now"))).otherwise("no call {at all")
    arguments = jsonx.embedded_arguments(raw)
    points = F.when(arguments.isNull(), 0).otherwise(F.size(jsonx.points_of_call(arguments)))
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", points.alias("points"))


@registered("""select s_suppkey as doc, case s_suppkey % 3 when 0 then 'May 2025' when 1 then '2024 Q1' else 'Q2 2023' end as report_date from {supplier}""")
def document_report_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    documents = rows.selectExpr("s_suppkey as doc", "case when s_suppkey % 3 = 0 then '/x/LCR_May_2025.pptx' else '/x/plain.pptx' end as path")
    headings = rows.selectExpr("s_suppkey as doc", "1 as pos", "'title' as el_type", "case when s_suppkey % 3 < 2 then 'Micro Report 2024 Q1' else 'plain' end as content")
    claims = rows.selectExpr("s_suppkey as doc", "1 as pos", "'31-Mar-26' as value", "'x' as field_name", "cast(null as string) as canonical_metric")
    claims = claims.unionByName(rows.selectExpr("s_suppkey as doc", "2 as pos", "'Q2 2023' as value", "'x' as field_name", "'Reporting Period' as canonical_metric"))
    return layers.document_dates(documents, headings, claims)


_BM25_WORDS = "regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+')"


@registered(f"""
with d as (select doc_id, {_BM25_WORDS} as w from {{documents}}), s as (select count(*) as n, avg(len(w)) as mean from d),
t as (select doc_id, len(w) as size, unnest(w) as term from d), c as (select doc_id, size, term, count(*) as tf from t group by doc_id, size, term),
f as (select term, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) as idf from c cross join s group by term, n),
q as (select item_id, unnest(list_distinct({_BM25_WORDS})) as term from {{benchmark}}),
x as (select item_id, doc_id, round(sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / mean))), 6) as score from q join f using (term) join c using (term) cross join s group by item_id, doc_id),
r as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from x)
select item_id, doc_id, rank::int as rank, round(score, 4) as score from r where rank <= 5""")
def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, asked = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    index = textindex.build(docs, "doc_id", "text", f"{scratch.fresh_path(spark, 'index')}/documents")
    return textindex.search(index, asked, "item_id", "text", 5).select("item_id", F.col("id").alias("doc_id"), "rank", F.round("score", 4).alias("score"))
