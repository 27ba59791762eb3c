"""Queries for scalar functions over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedgeline.functions import dates, hashes, numbers, text, urls
from sedgeline.runtime import table

KEYWORDS = {
    "housing": ["housing", "homeless", "vacant property"], "planning": ["planning", "derelict sites"], "roads": ["road", "cycle lane", "bus shelter"],
    "water": ["water", "septic tank", "flood relief"], "health": ["hospital", "mental health", "vaccine"], "it": ["IT", "software", "broadband"],
}


def header_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "foi_disclosures").filter("requester_type is not null")
    return t.groupBy("requester_type").agg(F.count(F.lit(1)).alias("n")).groupBy(text.header_key(F.col("requester_type")).alias("header_key")).agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_spellings"))


def body_name_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "public_bodies").filter("public_body_name is not null").select("public_body_name").distinct()
    n = F.col("public_body_name")
    return t.select("public_body_name", text.body_name_key(n).alias("name_key"), text.match_key(n).alias("match_key"), text.name_slug(n).alias("slug"), text.alnum_key(n).alias("alnum_key"))


def date_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "foi_disclosures").select(F.explode(F.array("date_received", "decision_date")).alias("cell")).filter("cell is not null")
    d = t.groupBy("cell").agg(F.count(F.lit(1)).alias("n_rows"))
    return d.select("cell", dates.date_cell(F.col("cell")).alias("iso_date"), dates.date_issue(F.col("cell")).alias("issue"), "n_rows")


def date_cells_guessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "foi_disclosures").select(F.explode(F.array("date_received", "decision_date")).alias("cell")).filter("cell is not null").distinct()
    return t.select("cell", dates.date_cell_or_guess(F.col("cell")).alias("iso_date"))


def deadlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "foi_disclosures").select(F.explode(F.array("date_received", "decision_date")).alias("cell")).filter("cell is not null").distinct()
    made = t.withColumn("d", dates.deadline(F.col("cell"))).filter("d is not null")
    return made.select("cell", "d.precision", "d.year", "d.quarter", "d.month", "d.day", F.col("d.start").alias("start_date"), F.col("d.end").alias("end_date"))


def printed_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "foi_disclosures").select("id", F.explode(F.regexp_extract_all("request_description", F.lit(r"(€[0-9][0-9,.]*)"), F.lit(1))).alias("raw"))
    got = t.groupBy("raw").agg(F.count(F.lit(1)).alias("n")).withColumn("a", numbers.amount(F.regexp_replace("raw", r"[.,]+$", "")))
    return got.groupBy("a.value", "a.error").agg(F.sum("n").alias("n_printed"))


def reference_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "foi_disclosures").withColumn("r", text.reference_parts(F.col("foi_reference_id")))
    return t.groupBy(F.col("r.style").alias("style"), F.col("r.year").alias("year")).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("r.number").alias("n_numbers"))


def site_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "disclosure_files").filter("document_url is not null")
    u = F.col("document_url")
    return t.groupBy(urls.registrable_domain(u).alias("domain"), urls.site_key(u).alias("site"), urls.extension(u).alias("extension")).agg(F.count(F.lit(1)).alias("n_files"), F.sum(urls.is_safe_url(u).cast("int")).alias("n_safe"))


def guessed_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "public_bodies").filter("public_body_name is not null").select("public_body_name").distinct()
    return t.select("public_body_name", F.array_join(urls.guessed_domains(F.col("public_body_name")), " ").alias("guesses"))


def body_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each body's addresses over register and snapshots, and the one to use."""
    t = table(spark, sf_dir, "public_bodies").select("public_body_id", "foi_email").unionByName(table(spark, sf_dir, "public_body_snapshots").select("public_body_id", "foi_email"))
    t = t.filter("public_body_id is not null").withColumn("address", F.explode_outer(text.emails(F.col("foi_email")))).select("public_body_id", "address").distinct()
    pick = t.groupBy("public_body_id").agg(
        F.count("address").alias("n_addresses"), F.min("address").alias("first_address"),
        F.min(F.when(F.col("address").contains("foi") | F.col("address").contains("freedom"), F.col("address"))).alias("foi_address"),
    )
    address = F.when(F.col("n_addresses") == 1, F.col("first_address")).otherwise(F.col("foi_address"))
    return pick.select("public_body_id", "n_addresses", address.alias("address"), F.when(F.col("n_addresses") == 0, "not_found").when(address.isNotNull(), "found").otherwise("multiple_found").alias("email_status"))


def row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "foi_disclosures").select("id", hashes.row_id(F.col("file_url"), F.col("id")).alias("row_id"))


def page_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "disclosure_files").filter("source_page_url is not null and document_url is not null").select("source_page_url", "document_url").distinct()
    return t.groupBy("source_page_url").agg(F.count(F.lit(1)).alias("n_files"), hashes.set_fingerprint(F.col("document_url")).alias("fingerprint"))


def list_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, list items and headings of each document."""
    t = table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", F.explode(F.split("text", r"\r?\n")).alias("line"))
    is_ = lambda p: F.count(F.when(F.col("line").rlike(p), 1))
    return t.groupBy("doc_id").agg(F.count(F.when(F.trim("line") != "", 1)).alias("n_lines"), is_("^[ \t]*[•*–-][ \t]+").alias("n_bullets"), is_(r"^[ \t]*[0-9]{1,3}[.)][ \t]+").alias("n_ordered"), is_("^#{1,6}[ \t]+").alias("n_headings"))


def plain_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length and digest of each document's text without markdown."""
    t = table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", text.without_markdown(F.col("text")).alias("plain"))
    return t.select("doc_id", F.length("plain").alias("n_plain"), F.md5("plain").alias("digest"))


def topic_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per topic and month; a row has every topic one of whose keywords stands in it."""
    d = F.col("request_description")
    topics = F.array_compact(F.array(*[F.when(_any([text.has_keyword(d, k) for k in words]), F.lit(t)) for t, words in KEYWORDS.items()]))
    t = table(spark, sf_dir, "foi_disclosures").filter("request_description is not null").select(F.explode(topics).alias("topic"), F.date_format("loaded_at", "yyyy-MM").alias("month"))
    return t.groupBy("topic", "month").agg(F.count(F.lit(1)).alias("n_rows"))


def verification_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = text.verification_tier(F.col("text"), ["internal review", "grant access", "decided to refuse"], ["request", "records", "schedule"])
    t = table(spark, sf_dir, "documents").withColumn("v", v)
    return t.groupBy(F.col("v.tier").alias("tier"), F.col("v.phrase").alias("phrase"), "source").agg(F.count(F.lit(1)).alias("n_documents"))


def _any(conditions):
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


QUERIES = {f.__name__: f for f in (header_keys, body_name_keys, date_cells, date_cells_guessed, deadlines, printed_amounts, reference_styles, site_domains, guessed_domains, body_emails, row_ids, page_fingerprints, list_lines, plain_texts, topic_matches, verification_tiers)}

_W = r"[\s\p{Z}]"
_STRIP = lambda c: f"regexp_replace({c}, '^{_W}+|{_W}+$', '', 'g')"
_SQUEEZE = lambda c: f"trim(regexp_replace({c}, '{_W}+', ' ', 'g'), ' ')"
_FOLD = lambda c: f"translate(lower({c}), '{text.ACCENTED}', '{text.PLAIN}')"
_MONTH = lambda c: "case " + " ".join(f"when lower({c}) in ('{m}', '{m[:3]}'{', ' + chr(39) + 'sept' + chr(39) if k == 9 else ''}) then {k}" for k, m in enumerate(dates.MONTHS, 1)) + " end"
_TRY_DAY = lambda y, m, d: f"try_cast(printf('%04d-%02d-%02d', {y}, {m}, {d}) as date)"


def _date_cell_sql() -> str:
    month = r"([A-Za-z]{3,9})[.]?"
    forms = [
        (r"([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})", 1, 2, 3, ""), (rf"([0-9]{{1,2}})-{month}-([0-9]{{4}}|[0-9]{{2}})", 3, 2, 1, "n"), (r"([0-9]{1,2})[.]([0-9]{1,2})[.]''?([0-9]{4}|[0-9]{2})", 3, 2, 1, ""),
        (r"([0-9]{1,2})-([0-9]{1,2})-([0-9]{4}|[0-9]{2})", 3, 2, 1, ""), (r"([0-9]{1,2})/([0-9]{1,2})/([0-9]{4}|[0-9]{2})", 3, 2, 1, "s"), (rf"{month} ([0-9]{{1,2}}),? ([0-9]{{4}})", 3, 1, 2, "n"), (rf"([0-9]{{1,2}})(?:st|nd|rd|th)? {month},? ([0-9]{{4}})", 3, 2, 1, "n"),
    ]
    cases = []
    for before in ("^", "(?:^|[^0-9A-Za-z])"):
        for pattern, y, m, d, kind in forms:
            full = f"(?i){before}{pattern}(?:[^0-9A-Za-z]|$)"
            g = lambda k, full=full: f"regexp_extract(t, '{full}', {k})"
            year = f"(case when length({g(y)}) = 2 then try_cast({g(y)} as int) + case when try_cast({g(y)} as int) <= 29 then 2000 else 1900 end else try_cast({g(y)} as int) end)"
            mm, dd = (f"({_MONTH(f'left({g(m)}, 3)')})" if kind == "n" else f"try_cast({g(m)} as int)"), f"try_cast({g(d)} as int)"
            a, b = (f"case when {mm} > 12 and {dd} <= 12 then {dd} else {mm} end", f"case when {mm} > 12 and {dd} <= 12 then {mm} else {dd} end") if kind == "s" else (mm, dd)
            cases.append(f"when regexp_matches(t, '{full}') then case when {year} between 1900 and 2100 and {mm} is not null then strftime({_TRY_DAY(year, a, b)}, '%Y-%m-%d') end")
    skip = ", ".join(f"'{x}'" for x in dates.NO_DATES)
    return f"case when length(t) <= 60 and regexp_matches(t, '[0-9]') and lower(t) not in ({skip}) then case {' '.join(cases)} end end"


_CELLS = "cells as (select unnest([date_received, decision_date]) cell from foi_disclosures)"
_URL_HOST = r"regexp_replace(regexp_replace(lower(regexp_extract(document_url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^[.]+|[.]+$', '', 'g'), '^www[.]', '')"

SQL = {
    "header_keys": rf"select regexp_replace(lower(regexp_replace({_STRIP('requester_type')}, '[\s\p{{Z}}_]+', ' ', 'g')), '[\s\p{{Z}}.:/]+$', '') header_key, count(*) n_rows, count(distinct requester_type) n_spellings from foi_disclosures where requester_type is not null group by 1",
    "body_name_keys": rf"""select distinct public_body_name,
 lower({_SQUEEZE(rf"regexp_replace(regexp_replace(public_body_name, '{_W}*[(][^)]*[)]{_W}*', ' ', 'g'), '(?i){_W}*\b({'|'.join(text.LEGAL_FORMS)})\b[.]?{_W}*$', '')")}) name_key,
 trim(regexp_replace(regexp_replace(regexp_replace(replace(regexp_replace({_FOLD('public_body_name')}, '[(][^)]*[)]', ' ', 'g'), '&', ' and '), '[^a-z0-9]+', ' ', 'g'), '\bthe\b', ' ', 'g'), ' +', ' ', 'g')) match_key,
 regexp_replace(regexp_replace(replace({_FOLD('public_body_name')}, '&', ' and '), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') slug,
 regexp_replace(lower(public_body_name), '[^a-z0-9]', '', 'g') alnum_key from public_bodies where public_body_name is not null""",
    "date_cells": rf"""with {_CELLS}, s as (select cell, count(*) n_rows, {_SQUEEZE(f"regexp_replace({_STRIP('cell')}, '^[*]+', '')")} t from cells where cell is not null group by cell),
d as (select cell, n_rows, {_date_cell_sql()} iso_date from s)
select cell, iso_date, case when trim(cell, ' ') <> '' and iso_date is null then case when regexp_matches(cell, '[0-9]') then 'UnparseableDate' else 'TextInDateColumn' end end issue, n_rows from d""",
    "deadlines": rf"""with {_CELLS}, s as (select distinct cell, {_SQUEEZE('cell')} t from cells where cell is not null),
p as (select cell, t, case when regexp_full_match(t, '(?i)q[1-4] [0-9]{{4}}') then 'quarter' when regexp_full_match(t, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') or regexp_full_match(t, '[0-9]{{1,2}} [A-Za-z]+ [0-9]{{4}}') then 'day'
  when regexp_full_match(t, '[A-Za-z]+ [0-9]{{4}}') then 'month' when regexp_full_match(t, '[0-9]{{4}}') then 'year' when regexp_full_match(t, '[0-9]{{4}} ?[–—-] ?[0-9]{{4}}') then 'range' end k from s),
d as (select cell, t, k, case k when 'day' then coalesce(try_cast(case when t like '____-__-__' then t end as date), {_TRY_DAY("try_cast(regexp_extract(t, '([0-9]{4})$', 1) as int)", _MONTH("regexp_extract(t, '^[0-9]{1,2} ([A-Za-z]+)', 1)"), "try_cast(regexp_extract(t, '^([0-9]{1,2}) ', 1) as int)")})
  when 'month' then {_TRY_DAY("try_cast(right(t, 4) as int)", _MONTH("regexp_extract(t, '^([A-Za-z]+)', 1)"), "1")}
  when 'year' then make_date(cast(t as int), 1, 1) when 'range' then make_date(cast(left(t, 4) as int), 1, 1)
  when 'quarter' then make_date(cast(right(t, 4) as int), cast(substr(t, 2, 1) as int) * 3 - 2, 1) end a from p where k is not null)
select cell, k "precision", case when k <> 'range' then cast(year(a) as int) end "year", case when k = 'quarter' then cast(quarter(a) as int) end "quarter", case when k in ('day', 'month') then cast(month(a) as int) end "month", case when k = 'day' then cast(day(a) as int) end "day",
 a start_date, case k when 'day' then a when 'month' then last_day(a) when 'year' then make_date(cast(year(a) as int), 12, 31) when 'range' then make_date(cast(right(t, 4) as int), 12, 31) else last_day(cast(a + interval 2 month as date)) end end_date from d where a is not null
union all select cell, lower(regexp_extract(t, '^[A-Za-z]+')), null, null, null, null, null, null from s where regexp_matches(t, '(?i)^(annual|ongoing)\b[^0-9]*$')""",
    "printed_amounts": r"""with raw as (select regexp_replace(unnest(regexp_extract_all(request_description, '(€[0-9][0-9,.]*)', 1)), '[.,]+$', '') r from foi_disclosures),
a as (select replace(r, '€', '') t from raw), s as (select t, split_part(t, '.', 1) whole, case when contains(t, '.') then substr(t, strpos(t, '.') + 1) end cents from a),
e as (select *, case when cents is not null and not regexp_full_match(cents, '[0-9]{2}') then 'not_numeric' when cents <> '00' then 'sub_euro_amount' when starts_with(whole, ',') then 'ambiguous_grouping'
 when not regexp_full_match(whole, '[0-9]+(,[0-9]+)*') then 'not_numeric' when contains(whole, ',') and not regexp_full_match(whole, '[0-9]{1,3}(,[0-9]{3})+') then 'ambiguous_grouping' end err from s)
select case when err is null then try_cast(replace(whole, ',', '') as bigint) end "value", err "error", count(*) n_printed from e group by 1, 2""",
    "reference_styles": rf"""with s as (select upper({_SQUEEZE('foi_reference_id')}) r from foi_disclosures),
p as (select case when regexp_full_match(r, 'FOI[/ -][0-9]{{4}}[/ -][0-9]+') then 'prefixed' when regexp_full_match(r, 'FOI [0-9]+ OF [0-9]{{4}}') then 'of_year' when regexp_full_match(r, 'F[0-9]{{2}}/[0-9]+') then 'short_year' when regexp_full_match(r, '[0-9]+/[0-9]{{4}}') then 'number_year' when regexp_full_match(r, '[0-9]{{4}}-[0-9]+') then 'year_number' when regexp_full_match(r, 'REQ [0-9]+') then 'serial' end style, r from s),
q as (select style, case style when 'prefixed' then cast(substr(r, 5, 4) as int) when 'of_year' then cast(right(r, 4) as int) when 'short_year' then 2000 + cast(substr(r, 2, 2) as int) when 'number_year' then cast(right(r, 4) as int) when 'year_number' then cast(left(r, 4) as int) end "year",
 case style when 'prefixed' then cast(substr(r, 10) as bigint) when 'of_year' then cast(regexp_extract(r, '^FOI ([0-9]+)', 1) as bigint) when 'short_year' then cast(substr(r, 5) as bigint) when 'number_year' then cast(split_part(r, '/', 1) as bigint) when 'year_number' then cast(substr(r, 6) as bigint) when 'serial' then cast(substr(r, 5) as bigint) end num from p)
select style, "year", count(*) n_rows, count(distinct num) n_numbers from q group by 1, 2""",
    "site_domains": rf"""with h as (select document_url, {_URL_HOST} h from disclosure_files where document_url is not null), l as (select *, list_filter(string_split(h, '.'), lambda x: x <> '') l from h),
d as (select *, case when len(l) < 2 then '' when len(l) >= 3 and length(l[-1]) = 2 and l[-2] in ('co', 'ac', 'org', 'net', 'com') then array_to_string(l[-3:], '.') else array_to_string(l[-2:], '.') end d from l),
k as (select *, list_filter(string_split(lower(regexp_extract(document_url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1)), '/'), lambda x: x <> '') seg from d)
select d "domain", case when d = 'gov.ie' then d || '/' || array_to_string(seg[1:3], '/') else d end site, lower(regexp_extract(document_url, '[.]([A-Za-z0-9]{{1,5}})(?:[?#].*)?$', 1)) extension, count(*) n_files,
 count(*) filter (regexp_matches(document_url, '(?i)^https?://[^/?#@]+([/?#]|$)') and contains(h, '.') and not regexp_matches(h, '^(127[.]|10[.]|192[.]168[.]|169[.]254[.]|172[.](1[6-9]|2[0-9]|3[01])[.]|0[.])') and not regexp_matches(h, '[.](local|internal|localhost)$')) n_safe from k group by 1, 2, 3""",
    "guessed_domains": rf"""with w as (select distinct public_body_name, list_filter(regexp_split_to_array({_FOLD('public_body_name')}, '[^a-z0-9]+'), lambda x: x <> '' and x not in ('the', 'of', 'and', 'for', 'an', 'na')) w from public_bodies where public_body_name is not null),
s as (select public_body_name, list_filter([array_to_string(list_transform(w, lambda x: left(x, 1)), ''), array_to_string(w, ''), array_to_string(w, '-')], lambda x: length(x) >= 3) s from w),
g as (select public_body_name, flatten(list_transform(s, lambda x: [x || '.ie', x || '.com'])) g from s)
select public_body_name, array_to_string(list_filter(g, lambda x, i: list_position(g, x) = i)[1:6], ' ') guesses from g""",
    "body_emails": rf"""with t as (select public_body_id, foi_email from public_bodies union all select public_body_id, foi_email from public_body_snapshots),
a as (select distinct public_body_id, unnest(regexp_extract_all(lower(foi_email), '({text.EMAIL})', 1)) address from t), k as (select distinct public_body_id from t where public_body_id is not null),
g as (select k.public_body_id, count(address) n, min(address) first, min(address) filter (contains(address, 'foi') or contains(address, 'freedom')) foi from k left join a using (public_body_id) group by 1),
p as (select *, case when n = 1 then first else foi end address from g)
select public_body_id, n n_addresses, address, case when n = 0 then 'not_found' when address is not null then 'found' else 'multiple_found' end email_status from p""",
    "row_ids": "select id, left(sha1(concat_ws(':', file_url, cast(id as varchar))), 12) row_id from foi_disclosures",
    "page_fingerprints": f"with t as (select distinct source_page_url, document_url from disclosure_files where source_page_url is not null and document_url is not null) select source_page_url, count(*) n_files, {hashes.grouped_digest_sql('document_url')} fingerprint from t group by 1",
    "list_lines": r"""with l as (select doc_id, unnest(regexp_split_to_array(text, '\r?\n')) line from documents where text is not null)
select doc_id, count(*) filter (trim(line, ' ') <> '') n_lines, count(*) filter (regexp_matches(line, '^[ \t]*[•*–-][ \t]+')) n_bullets, count(*) filter (regexp_matches(line, '^[ \t]*[0-9]{1,3}[.)][ \t]+')) n_ordered, count(*) filter (regexp_matches(line, '^#{1,6}[ \t]+')) n_headings from l group by 1""",
    "plain_texts": r"""with p as (select doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '(?m)^#{1,6}[ \t]+', '', 'g'), '[*][*]([^*]+)[*][*]', '\1', 'g'), '`([^`]+)`', '\1', 'g'), '\[([^\]]+)\]\([^)]*\)', '\1', 'g'), '(?m)^[ \t]*[-*_]{3,}[ \t]*$', '', 'g') plain from documents where text is not null)
select doc_id, cast(length(plain) as int) n_plain, md5(plain) digest from p""",
    "topic_matches": " union all ".join(
        f"select '{t}' topic, strftime(loaded_at, '%Y-%m') \"month\", count(*) n_rows from foi_disclosures where " + " or ".join(rf"regexp_matches(request_description, '{'' if k == 'IT' else '(?i)'}(^|[^\p{{L}}\p{{N}}_]){k}($|[^\p{{L}}\p{{N}}_])')" for k in words) + " group by 2"
        for t, words in KEYWORDS.items()
    ),
    "verification_tiers": """with v as (select source, lower(coalesce(text, '')) t from documents),
p as (select source, t, case when contains(t, 'decided to refuse') then 'decided to refuse' when contains(t, 'internal review') then 'internal review' when contains(t, 'grant access') then 'grant access' end phrase, cast(contains(t, 'request') as int) + cast(contains(t, 'records') as int) + cast(contains(t, 'schedule') as int) weak from v)
select case when trim(t, ' ') = '' then 'unverified' when phrase is not null or weak >= 2 then 'verified' else 'rejected' end tier, phrase, source, count(*) n_documents from p group by 1, 2, 3""",
}
