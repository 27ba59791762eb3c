"""Queries for grids, long texts and event windows over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedgeline.operators import grids, texts
from sedgeline.runtime import table
from sedgeline.streaming import windows as streams

CELLS = ["foi_reference_id", "date_received", "decision_date", "requester_type", "decision_status", "review_status"]


def grid_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each body's disclosures as a grid: its scores and the checks it fails."""
    t = table(spark, sf_dir, "foi_disclosures").filter("public_body_id is not null").select("public_body_id", F.array(*CELLS).alias("cells"))
    s = grids.structure_scores(t, "public_body_id", "cells")
    s = grids.failed_checks(s, {"uniformity": 0.5, "purity": 0.8}, {"fragments": 0.1})
    return s.withColumn("failed_checks", F.array_join("failed_checks", ","))


def grid_realigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without their nulls brought back to a width of five: how many can be, by their width."""
    t = table(spark, sf_dir, "foi_disclosures").select(F.array_compact(F.array(*CELLS)).alias("cells"))
    r = t.withColumn("r", grids.realigned(F.col("cells"), F.lit(5), F.lit(2)))
    return r.groupBy(F.size("cells").alias("width"), F.coalesce(F.size("r"), F.lit(-1)).alias("realigned_width")).agg(F.count(F.lit(1)).alias("n_rows"))


def document_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts.outline(table(spark, sf_dir, "documents"), "doc_id", "text")


def document_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts.file_references(table(spark, sf_dir, "documents"), "doc_id", "text")


def document_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts.chunks(table(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id", "chunk_no", F.length("chunk").alias("n_chars"))


def tumbling_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.tumbling(streams.timed(table(spark, sf_dir, "events")), "1 hour")


def sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.tumbling(streams.timed(table(spark, sf_dir, "events")), "2 hours", "1 hour")


def session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.sessions(streams.timed(table(spark, sf_dir, "events")), "30 minutes")


QUERIES = {f.__name__: f for f in (grid_structure, grid_realigned, document_outline, document_references, document_chunks, tumbling_windows, sliding_windows, session_windows)}

_TYPE = r"case when coalesce(v, '') <> '' then case when regexp_full_match(v, '[0-9]{1,4}[-/.][0-9]{1,2}[-/.][0-9]{1,4}') then 'date' when regexp_full_match(v, '€?[0-9][0-9,.]*') then 'number' when regexp_full_match(v, '[A-Za-z]*[/ -]?[0-9][0-9A-Za-z/ -]*') then 'code' else 'text' end end"
_WINDOWED = "select {0} window_start, {0} + interval {1} hour window_end, event_type, count(*) n_events, round(sum(value), 4) total from e group by all"

SQL = {
    "grid_structure": rf"""with g as (select id, public_body_id b, [{', '.join(CELLS)}] c from foi_disclosures where public_body_id is not null),
x as (select id, b, unnest(c) c, unnest(range(6)) i from g), v as (select id, b, i, regexp_replace(c, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g') v from x),
r as (select id, b, count(*) filter (v <> '') k, coalesce(max(i + 1) filter (v <> ''), 0) w from v group by id, b having k > 0),
p as (select b, w, count(*) n, count(*) filter (k >= 3) f, count(*) filter (k <= 2) thin from r group by b, w),
m as (select b, coalesce(arg_max(w, f * 100 + w) filter (f > 0), 0) mode, sum(n) n_rows, sum(thin) thin from p group by b),
s as (select p.b, sum(n) filter (w = mode) same from p join m using (b) group by p.b),
t as (select b, i, {_TYPE} t from v where id in (select id from r)), tn as (select b, i, t, count(*) n from t where t is not null group by all),
pu as (select b, avg(p) purity from (select b, i, max(n) / sum(n) p, sum(n) n from tn group by b, i) where n >= 5 group by b),
o as (select m.b public_body_id, cast(n_rows as bigint) n_rows, mode modal_width, coalesce(same, 0) / n_rows uniformity, case when mode >= 4 then thin / n_rows else 0.0 end fragments, coalesce(purity, 0.0) purity from m join s using (b) left join pu using (b))
select *, uniformity * purity * (1 - fragments) score, concat_ws(',', case when uniformity < 0.5 then 'uniformity' end, case when purity < 0.8 then 'purity' end, case when fragments > 0.1 then 'fragments' end) failed_checks from o""",
    "grid_realigned": f"""with t as (select list_filter([{', '.join(CELLS)}], lambda x: x is not null) c from foi_disclosures),
k as (select len(c) width, len(list_filter(c, lambda x: regexp_replace(x, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g') <> '')) f from t)
select width, case when width <= 5 then 5 when width = 6 and f < 6 then 5 when width > 6 and f = 5 then 5 else -1 end realigned_width, count(*) n_rows from k group by 1, 2""",
    "document_outline": r"""with l as (select doc_id, regexp_split_to_array(text, '\r?\n') a from documents where text is not null), x as (select doc_id, len(a) n, unnest(a) line, unnest(range(len(a))) line_no from l),
h as (select doc_id, n, cast(line_no as int) line_no, length(regexp_extract(line, '^(#+)', 1)) lv, trim(regexp_replace(line, '^#+[ \t]+', ''), ' ') title from x where regexp_matches(line, '^#{1,6}[ \t]+\S'))
select a.doc_id, a.line_no, cast(a.lv as int) "level", a.title, max(b.line_no) filter (b.line_no < a.line_no and b.lv < a.lv) parent_line, cast(coalesce(min(b.line_no) filter (b.line_no > a.line_no and b.lv <= a.lv), a.n) as int) end_line
from h a left join h b on b.doc_id = a.doc_id group by a.doc_id, a.line_no, a.lv, a.title, a.n""",
    "document_chunks": r"""with recursive s as (select doc_id, text, 0 a, 0 no, length(text) n, 0 e from documents where text <> ''
 union all select doc_id, text, e, no + 1, n, case when e + 2000 >= n then n when regexp_matches(substr(text, e + 1001, 1000), '\n\n') then e + 1002 + length(regexp_extract(substr(text, e + 1001, 1000), '(?s)^(.*)\n\n', 1))
  when contains(substr(text, e + 1001, 1000), chr(10)) then e + 1001 + length(regexp_extract(substr(text, e + 1001, 1000), '(?s)^(.*)\n', 1)) else e + 2000 end from s where e < n)
select doc_id, cast(no as int) chunk_no, cast(e - a as int) n_chars from s where no > 0""",
    "document_references": r"with r as (select doc_id, unnest(regexp_extract_all(text, '\b([A-Z]{2}/[0-9]{2,6})\b', 1)) reference from documents) select doc_id, reference, count(*) n_uses from r group by 1, 2",
    "tumbling_windows": "with e as (select * from events) " + _WINDOWED.format("time_bucket(interval 1 hour, ts)", 1),
    "sliding_windows": "with e as (select events.*, unnest([0, 1]) k from events) " + _WINDOWED.format("time_bucket(interval 1 hour, ts) - k * interval 1 hour", 2),
    "session_windows": """with g as (select *, case when ts - lag(ts) over w < interval 30 minute then 0 else 1 end f from events window w as (partition by user_id order by ts)), c as (select *, sum(f) over (partition by user_id order by ts rows unbounded preceding) c from g)
select user_id, min(ts) session_start, max(ts) + interval 30 minute session_end, count(*) n_events from c group by user_id, c""",
}
