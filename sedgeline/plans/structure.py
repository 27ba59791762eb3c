"""Queries for attribution, sections, repairs and names over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedgeline.functions import dates, documents, text, urls
from sedgeline.operators import pages, records, texts
from sedgeline.operators.references import current_rows
from sedgeline.runtime import table


def attributed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and the one body that lists their file, among their own and its parent; with the error otherwise."""
    cur = current_rows(table(spark, sf_dir, "public_bodies"), "public_body_id", "loaded_at", ["parent_id"]).select("public_body_id", "parent_id")
    rows = table(spark, sf_dir, "foi_disclosures").filter("public_body_id is not null").select("id", "file_url", "public_body_id").join(cur, "public_body_id", "left")
    rows = rows.select("id", "file_url", F.array_compact(F.array("public_body_id", "parent_id")).alias("owners"))
    declared = table(spark, sf_dir, "disclosure_files").filter("public_body_id is not null and document_url is not null").select(F.col("public_body_id").alias("owner"), F.col("document_url").alias("file_url"))
    return records.attributed(rows, declared, "id", "file_url", "owner").groupBy("owner", "error").agg(F.count(F.lit(1)).alias("n_rows"))


def event_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's events as a document: signups open sections, purchases close blocks, two in a row close the section."""
    kind = F.when(F.col("event_type") == "signup", "heading").when(F.col("event_type") == "purchase", "anchor").when(F.col("event_type") == "error", "blank").otherwise("item")
    t = table(spark, sf_dir, "events").select("event_id", "user_id", F.struct("ts", "event_id").alias("at"), kind.alias("kind"), F.date_format("ts", "yyyy-MM-dd").alias("label"))
    return records.segments(t, "user_id", "at", "kind").select("event_id", "section_no", "block_no")


def body_website_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    cur = current_rows(table(spark, sf_dir, "public_bodies"), "public_body_id", "loaded_at", ["public_body_name", "website_url"])
    return cur.filter("website_url is not null and public_body_name is not null").select("public_body_id", urls.host(F.col("website_url")).alias("host"), documents.name_confidence(F.col("public_body_name"), urls.host(F.col("website_url"))).alias("confidence"))


def first_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "disclosure_files").filter("document_url is not null").select("id", "document_url", "loaded_at")
    return records.first_report(t, "document_url", "loaded_at", "id").select("document_url", "id")


def reference_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File numbers with the heading under which they stand."""
    d = table(spark, sf_dir, "documents")
    heads = texts.outline(d, "doc_id", "text").select(F.col("doc_id").alias("document"), F.col("title").alias("section"), "level", F.col("line_no").alias("first_page"), (F.col("end_line") - 1).alias("last_page"))
    lines = d.filter("text is not null").select(F.col("doc_id").alias("document"), F.posexplode(F.split("text", r"\r?\n")).alias("page", "line"))
    refs = lines.select("document", "page", F.explode(F.regexp_extract_all("line", F.lit(r"\b([A-Z]{2}/[0-9]{2,6})\b"), F.lit(1))).alias("reference"))
    return records.sections_of(refs, heads).groupBy("section").agg(F.count(F.lit(1)).alias("n_references"), F.countDistinct("document").alias("n_documents"))


def document_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of each document as headings, lists and paragraphs, with the length of their running text."""
    d = table(spark, sf_dir, "documents").filter("text is not null").select(F.col("doc_id").alias("document"), F.lit(1).alias("page"), F.posexplode(F.split("text", r"(\r?\n[ \t]*)+\r?\n")).alias("block", "b"))
    lines = d.select("document", "page", "block", F.posexplode(F.split("b", r"\r?\n")).alias("k", "text"))
    size = F.when(F.col("text").rlike("^#"), 14.0).otherwise(10.0)
    lines = lines.select("document", "page", "block", (F.col("block") * 100_000 + F.col("k")).cast("long").alias("seq"), size.alias("size"), F.lit(10.0).alias("body_size"), "text")
    return pages.paragraphs(lines).groupBy(F.col("document").alias("doc_id"), "kind").agg(F.count(F.lit(1)).alias("n_blocks"), F.sum(F.length("text")).alias("n_chars"))


def repaired_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders after repairs: urgent pending ones set to finished, negative totals dropped."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    r = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select("o_orderkey", F.when(F.col("o_orderpriority").startswith("1"), "set").otherwise("drop").alias("action"), F.lit("F").alias("value"))
    return records.row_repairs(o, r, ["o_orderkey"], "o_orderstatus")


def latest_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source and month of publication the latest quarter that its documents name (a year alone counts as its fourth), and how many name one."""
    t = table(spark, sf_dir, "documents").select("source", F.date_format("published_on", "yyyy-MM").alias("month"), dates.latest_deadline(F.col("text")).alias("d")).filter("d is not null")
    return t.groupBy("source", "month").agg(F.max("d").alias("d"), F.count(F.lit(1)).alias("n_documents")).select("source", "month", F.col("d.year").alias("latest_year"), F.col("d.quarter").alias("latest_quarter"), "n_documents")


QUERIES = {f.__name__: f for f in (attributed_rows, event_sections, body_website_confidence, first_reports, reference_sections, document_paragraphs, repaired_orders, latest_quarters)}

_CUR = "cur as (select * from public_bodies where public_body_id is not null qualify row_number() over (partition by public_body_id order by loaded_at desc nulls last, {} ) = 1)"
_HOST = r"regexp_replace(regexp_replace(lower(regexp_extract(website_url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^[.]+|[.]+$', '', 'g'), '^www[.]', '')"

SQL = {
    "attributed_rows": f"""with {_CUR.format('parent_id desc nulls last')}, o as (select f.id, f.file_url, unnest(list_filter([f.public_body_id, c.parent_id], lambda x: x is not null)) owner from foi_disclosures f left join cur c using (public_body_id) where f.public_body_id is not null),
d as (select distinct public_body_id owner, document_url file_url from disclosure_files where public_body_id is not null), h as (select id, count(distinct owner) n, min(owner) one from o join d using (owner, file_url) group by id)
select case when n = 1 then one end "owner", case when n is null then 'undeclared' when n > 1 then 'ambiguous' end error, count(*) n_rows from foi_disclosures left join h using (id) where public_body_id is not null group by 1, 2""",
    "event_sections": """with k as (select event_id, user_id, ts, case event_type when 'signup' then 'heading' when 'purchase' then 'anchor' when 'error' then 'blank' else 'item' end kind, strftime(ts, '%Y-%m-%d') label from events),
a as (select *, case when kind <> 'blank' then kind end k, last_value(case when kind <> 'blank' then kind end ignore nulls) over b prev, last_value(case when kind = 'heading' then label end ignore nulls) over b head from k window b as (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding)),
c as (select *, last_value(case when k is not null then coalesce(k = 'anchor' and prev = 'anchor', false) end ignore nulls) over b closed from a window b as (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding)),
s as (select *, sum(case when k = 'heading' and (head is null or label <> head or closed is null or closed) then 1 when k = 'item' and coalesce(closed, prev is null) then 1 else 0 end) over (partition by user_id order by ts, event_id rows unbounded preceding) section_no from c)
select event_id, cast(section_no as bigint) section_no, cast(coalesce(sum(case when k = 'anchor' then 1 else 0 end) over (partition by user_id, section_no order by ts, event_id rows between unbounded preceding and 1 preceding), 0) as bigint) block_no from s""",
    "body_website_confidence": f"""with {_CUR.format('public_body_name desc nulls last, website_url desc nulls last')}, w as (select public_body_id, {_HOST} host, list_filter(regexp_split_to_array(lower(public_body_name), '[^a-z0-9]+'), lambda x: length(x) >= 5 and x not in ('board', 'council', 'department', 'national', 'ireland', 'authority', 'office')) w from cur where website_url is not null and public_body_name is not null)
select public_body_id, host, case when len(list_filter(w, lambda x: contains(host, x))) > 0 then 'high' else 'low' end confidence from w""",
    "first_reports": "select document_url, id from disclosure_files where document_url is not null qualify row_number() over (partition by document_url order by loaded_at, id) = 1",
    "reference_sections": r"""with l as (select doc_id, regexp_split_to_array(text, '\r?\n') a from documents where text is not null), x as (select doc_id, len(a) n, unnest(a) line, unnest(range(len(a))) p from l),
h as (select doc_id, n, p, length(regexp_extract(line, '^(#+)', 1)) lv, trim(regexp_replace(line, '^#+[ \t]+', ''), ' ') title from x where regexp_matches(line, '^#{1,6}[ \t]+\S')),
e as (select a.doc_id, a.p, a.lv, a.title, coalesce(min(b.p) filter (b.p > a.p and b.lv <= a.lv), a.n) q from h a join h b on a.doc_id = b.doc_id group by a.doc_id, a.p, a.lv, a.title, a.n),
r as (select row_number() over () i, doc_id, p, ref from (select doc_id, p, unnest(regexp_extract_all(line, '\b([A-Z]{2}/[0-9]{2,6})\b', 1)) ref from x)),
j as (select r.i, r.doc_id, e.title from r left join e on e.doc_id = r.doc_id and r.p >= e.p and r.p < e.q qualify row_number() over (partition by r.i order by e.lv desc nulls last, e.title desc) = 1)
select title "section", count(*) n_references, count(distinct doc_id) n_documents from j group by 1""",
    "latest_quarters": r"""with d as (select source, strftime(published_on, '%Y-%m') m, list_filter(regexp_extract_all(lower(text), '(?:q[1-4] )?[0-9–—-]+'), lambda x: regexp_full_match(x, '(?:q[1-4] )?[0-9]{4}')) d from documents),
q as (select source, m, list_max(list_transform(d, lambda x: cast(right(x, 4) as int) * 10 + coalesce(try_cast(regexp_extract(x, 'q([1-4])', 1) as int), 4))) q from d where len(d) > 0)
select source, m "month", cast(max(q) // 10 as int) latest_year, cast(max(q) % 10 as int) latest_quarter, count(*) n_documents from q group by 1, 2""",
    "document_paragraphs": r"""with b as (select doc_id, unnest(regexp_split_to_array(text, '(?:\r?\n[ \t]*)+\r?\n')) b from documents where text is not null),
l as (select doc_id, list_filter(list_transform(regexp_split_to_array(b, '\r?\n'), lambda x: regexp_replace(x, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')), lambda x: x <> '') a, len(list_filter(regexp_split_to_array(b, '\r?\n'), lambda x: starts_with(x, '#'))) > 0 large from b),
j as (select doc_id, large, len(list_filter(a, lambda x: regexp_matches(x, '^(?:[•‣*–-]|\(?[0-9]{1,3}[.)]|\(?[a-z][.)])\s+'))) = len(a) listed, array_to_string(a, chr(10)) t,
 list_reduce(a, lambda a, x: case when regexp_matches(a, '[\p{L}\p{N}_]-$') and regexp_matches(x, '^\p{Ll}') then a[:-2] || x else a || ' ' || x end) j from l where len(a) > 0)
select doc_id, case when listed then 'list' when large and length(j) <= 120 then 'heading' else 'paragraph' end kind, count(*) n_blocks, cast(sum(length(case when listed then t else j end)) as bigint) n_chars from j group by 1, 2""",
    "repaired_orders": "select o_orderkey, case when o_orderstatus = 'P' then 'F' else o_orderstatus end o_orderstatus from orders where not (coalesce(o_orderstatus, '') = 'P' and not starts_with(o_orderpriority, '1'))",
}


def document_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date that the top lines of each document name: a day and month, with a year that stands there."""
    d = table(spark, sf_dir, "documents").filter("text is not null")
    none = F.lit(None).cast("date")
    return d.select("doc_id", dates.resolved_date(none, none, F.col("text")).alias("top_date")).filter("top_date is not null")


def status_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON object of each body's contact states."""
    cur = current_rows(table(spark, sf_dir, "public_bodies"), "public_body_id", "loaded_at", ["website_url_status", "foi_email_status"])
    return cur.select("public_body_id", documents.status_object({"website": F.col("website_url_status"), "email": F.col("foi_email_status")}).alias("status"))


def joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length and digest of each document as running text, words cut at line ends healed."""
    t = table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", text.joined_lines(F.split("text", r"\r?\n")).alias("joined"))
    return t.select("doc_id", F.length("joined").alias("n_joined"), F.md5("joined").alias("digest"))


QUERIES |= {f.__name__: f for f in (document_dates, status_objects, joined_lines)}

_MONTHS = "|".join(dates.MONTHS)
_TOP = rf"array_to_string(regexp_split_to_array(text, '\r?\n')[1:15], ' ')"
_DAY = rf"(?i)(?:^|[^0-9])([0-9]{{1,2}})(?:st|nd|rd|th)?\s+(?:of\s+)?({_MONTHS})\b"
SQL |= {
    "document_dates": rf"""with t as (select doc_id, {_TOP} t from documents where text is not null), p as (select doc_id, try_cast(regexp_extract(t, '{_DAY}', 1) as int) d, lower(regexp_extract(t, '{_DAY}', 2)) m, try_cast(regexp_extract(t, '\b((?:19|20)[0-9]{{2}})\b', 1) as int) y from t),
q as (select doc_id, try_cast(printf('%04d-%02d-%02d', y, list_position(['{"', '".join(dates.MONTHS)}'], m), d) as date) top_date from p where m <> '' and y is not null and d is not null) select * from q where top_date is not null""",
    "status_objects": f"""with {_CUR.format('website_url_status desc nulls last, foi_email_status desc nulls last')}
select public_body_id, '{{' || concat_ws(',', '"website":"' || website_url_status || '"', '"email":"' || foi_email_status || '"') || '}}' status from cur""",
    "joined_lines": r"""with l as (select doc_id, list_filter(list_transform(regexp_split_to_array(text, '\r?\n'), lambda x: regexp_replace(x, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')), lambda x: x <> '') a from documents where text is not null),
j as (select doc_id, case when len(a) = 0 then '' else list_reduce(a, lambda a, x: case when regexp_matches(a, '\p{L}-$') and regexp_matches(x, '^\p{Ll}') then a[:-2] || x else a || ' ' || x end) end j from l)
select doc_id, cast(length(j) as int) n_joined, md5(j) digest from j""",
}
