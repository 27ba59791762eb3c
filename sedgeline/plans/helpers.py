"""Queries that put the remaining operators to work over the given tables, and their SQL, written without them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedgeline.functions import dates, documents, hashes, numbers, text, urls
from sedgeline.operators import dedup, grid_repairs, grids, incremental, matching, pages, records, rollups, texts
from sedgeline.operators.references import current_rows
from sedgeline.plans.cells import _FOLD, _MONTH, _SQUEEZE, _STRIP
from sedgeline.runtime import table

FIELDS = ["foi_reference_id", "date_received", "decision_date", "requester_type", "decision_status", "review_status"]


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "foi_disclosures")


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "public_bodies").filter("public_body_name is not null").select(F.col("public_body_name").alias("name")).distinct()


# texts and cells


def clean_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _requests(spark, sf_dir).filter("request_description is not null").select("id", text.clean_cell(F.concat(F.lit(" (cid:12)"), "request_description"), "pdf").alias("clean"))
    return t.select("id", F.length("clean").alias("n_chars"), F.md5("clean").alias("digest"))


def status_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _requests(spark, sf_dir).filter("decision_status is not null")
    return t.groupBy("decision_status").agg(F.count(F.lit(1)).alias("n_rows")).select("decision_status", text.status_key(F.col("decision_status")).alias("status_key"), text.bare_value(F.col("decision_status")).alias("bare_value"), "n_rows")


def authority_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as directories print them, turned back; others stay without."""
    forms = F.array(F.concat(F.lit("County Council - "), "name"), F.concat(F.lit("city & county council -"), "name"), F.col("name"))
    return _names(spark, sf_dir).select(F.explode(forms).alias("printed")).select("printed", text.local_authority_name(F.col("printed")).alias("authority"))


def body_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    cur = current_rows(table(spark, sf_dir, "public_bodies"), "public_body_id", "loaded_at", ["public_body_name"])
    n, seed = F.col("public_body_name"), F.when(F.col("public_body_id") % 2 == 0, F.lit(""))
    return cur.select("public_body_id", text.text_slug(n).alias("text_slug"), text.resolved_slug(seed, n, F.col("public_body_id")).alias("slug"), text.alias_key(F.concat(F.lit("Table A: "), n)).alias("alias_key"))


def suspicious_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spaced-out letters and glyph codes, as readers leave them behind."""
    spaced = F.concat(F.regexp_replace("public_body_category", "(.)", "$1 "), F.lit(" (cid:7) and the rest"))
    t = table(spark, sf_dir, "public_bodies").filter("public_body_category is not null").select("public_body_id", texts.suspicious_spans(spaced).alias("s")).distinct()
    return t.select("public_body_id", F.size("s").alias("n_spans"), F.array_join("s", "|").alias("spans"))


def block_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of each document by kind of list."""
    b = table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", F.explode(F.split("text", r"(?:\r?\n[ \t]*)+\r?\n")).alias("b"))
    return b.groupBy("doc_id", F.coalesce(text.list_kind(F.split("b", r"\r?\n")), F.lit("none")).alias("kind")).agg(F.count(F.lit(1)).alias("n_blocks"))


def picked_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The address to use of a body's current row, its site's own and one for FOI beside it."""
    cur = current_rows(table(spark, sf_dir, "public_bodies"), "public_body_id", "loaded_at", ["foi_email"])
    both = F.concat_ws(" ", "foi_email", F.concat(F.lit("info@body"), "public_body_id", F.lit(".example")))
    return cur.select("public_body_id", text.picked_email(text.emails(both)).alias("p")).select("public_body_id", "p.address", "p.status")


def name_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).select(F.explode(text.tokens(F.col("name"))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n_names"))


def action_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References of disclosures as an action plan would print them, flagged by file type, and the printed ones."""
    made = F.concat(F.upper(F.substring("name", 1, 2)), F.lit("/ "), F.date_format("loaded_at", "yy"), F.lit("/"), F.col("id"), F.when(F.col("file_type") == "xlsx", "A **").when(F.col("file_type") == "pdf", "*").otherwise("/B (TF)*"))
    t = _requests(spark, sf_dir).filter("name is not null and id is not null and loaded_at is not null").select(F.explode(F.array(made, F.concat(F.lit("0"), F.substring(F.col("id").cast("string"), 1, 2)), F.coalesce("foi_reference_id", F.lit("")))).alias("cell")).distinct()
    r = t.withColumn("r", text.action_reference(F.col("cell")))
    return r.select("cell", "r.number", "r.printed", F.array_join("r.flags", ",").alias("flags"), "r.year", "r.error", text.parent_reference(F.col("r.number")).alias("parent"))


def leading_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _requests(spark, sf_dir).filter("decision_status is not null").select("id", F.when(F.col("file_type") == "pdf", F.concat(F.substring(F.col("id").cast("string"), 1, 4), F.lit(". \x07 "), "decision_status")).otherwise(F.col("decision_status")).alias("c"))
    return t.select("id", text.leading_ordinal(F.col("c")).alias("o")).select("id", "o.ordinal", "o.text")


def footnoted_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _names(spark, sf_dir).select(F.explode(F.array(F.concat("name", F.lit("12")), F.concat("name", F.lit(" [3]")), F.concat("name", F.lit(" *")), F.col("name"))).alias("printed"))
    return t.select("printed", text.without_footnote(F.col("printed")).alias("title"))


def plan_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed references between actions, one row per number, from texts made of orders."""
    made = F.concat(F.lit("Deliver (in part) "), F.when(F.col("o_orderstatus") == "F", "(Complements Plan ").otherwise("(see Plan "), F.substring("o_orderpriority", 1, 1), F.lit(" Actions "), F.col("o_custkey"), F.lit(", 7 and "), F.col("o_orderkey"), F.lit(") by Q4."))
    t = table(spark, sf_dir, "orders").filter("o_orderpriority is not null and o_custkey is not null and o_orderkey is not null").select("o_orderkey", F.explode(text.cross_references(made)).alias("r"))
    return t.select("o_orderkey", "r.relationship", "r.plan", "r.number")


def schedule_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision letters by their set wording."""
    phrases = {"grant": r"(?i)decided\s+to\s+grant", "schedule": r"(?i)schedule\s+attached", "review": r"(?i)internal\s+review"}
    return texts.phrase_guard(table(spark, sf_dir, "documents"), "doc_id", "text", phrases, {"schedule": 1, "review": 1})


def dumped_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies with ten or more requests of which a quarter were granted and a fifth came from one kind of requester."""
    return texts.dump_guard(_requests(spark, sf_dir), "public_body_id", {"granted": F.lower("decision_status").contains("grant")}, ["requester_type"], 10, 0.2)


def quarantined_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts.thin_texts(table(spark, sf_dir, "documents"), "doc_id", "text", 400)[1]


def serialised_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    cells = [documents.serialised_cell(F.col(c)) for c in ("o_orderkey", "o_orderstatus", "o_orderdate")] + [documents.serialised_cell(F.array("o_custkey", "o_orderkey"))]
    return o.select("o_orderkey", F.posexplode(F.array(*cells)).alias("cell_no", "c")).select("o_orderkey", "cell_no", "c.text", "c.as_json")


def json_in_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects found again in a text around them, and in a code fence."""
    n = table(spark, sf_dir, "customer").withColumn("j", F.to_json(F.struct(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("s"))))
    read = n.select("c_custkey", documents.last_json(F.concat(F.lit("Answer: "), "j", F.lit(" - done")), "k long, s string").alias("a"), documents.fenced_json(F.concat(F.lit("Here:\n```json\n"), "j", F.lit("\n```\nBye")), "k long, s string").alias("b"), documents.fenced_json(F.col("j"), "k long, s string").alias("c"))
    return read.select("c_custkey", F.col("a.s").alias("within"), F.col("b.k").alias("fenced"), F.col("c.s").alias("whole"))


# dates, numbers, addresses, keys


def link_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates in names of files made of the printed dates."""
    t = table(spark, sf_dir, "disclosure_files").filter("date_added is not null").select(F.concat(F.lit("minutes "), "date_added", F.lit(" final.pdf")).alias("link")).distinct()
    return t.select("link", dates.link_date(F.col("link")).alias("link_day")).filter("link_day is not null")


def strict_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarters of orders as printed; other forms give none."""
    q = F.concat(F.when(F.col("o_orderstatus") == "O", "q").otherwise("Q"), F.quarter("o_orderdate"), F.lit(" "), F.year("o_orderdate"))
    t = table(spark, sf_dir, "orders").groupBy(q.alias("printed")).agg(F.count(F.lit(1)).alias("n_orders"))
    return t.select("printed", dates.year_quarter(F.col("printed")).alias("q"), "n_orders").select("printed", "q.year", "q.quarter", "n_orders")


def latest_quarter_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the latest quarter that any of them names, by day."""
    o = table(spark, sf_dir, "orders").filter("o_orderdate is not null").withColumn("period", F.concat(F.lit("Q"), F.quarter("o_orderdate"), F.lit(" "), F.year("o_orderdate")))
    return o.filter(F.col("period") == records.latest_period(o, "period")).groupBy("period", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n_orders"))


def printed_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _requests(spark, sf_dir).select(F.explode(F.regexp_extract_all("request_description", F.lit(r"([0-9][0-9,.]*)"), F.lit(1))).alias("printed")).groupBy("printed").agg(F.count(F.lit(1)).alias("n_rows"))
    return t.select("printed", numbers.quantity(F.col("printed")).alias("quantity"), "n_rows")


def activity_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes made of a letter and four figures, among others that are none."""
    t = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.substring("p_type", 1, 1), F.lpad(F.col("p_partkey").cast("string"), 4, "0")).alias("code"))
    return t.select("p_partkey", numbers.activity_code(F.col("code")).alias("a")).filter("a is not null").select("p_partkey", "a.section", "a.division", F.col("a.group").alias("activity_group"), F.col("a.class").alias("activity_class"))


def logged_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "disclosure_files").filter("document_url is not null")
    return t.groupBy(urls.loggable_url(F.col("document_url")).alias("logged"), urls.root_url(F.col("document_url")).alias("root")).agg(F.count(F.lit(1)).alias("n_files"))


def content_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _requests(spark, sf_dir).select("id", hashes.content_key(F.col("public_body_id"), F.col("foi_reference_id"), F.col("requester_type")).alias("content_key"))


def contact_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct contact addresses of a row in their order of preference."""
    cur = current_rows(table(spark, sf_dir, "public_bodies"), "public_body_id", "loaded_at", ["website_url", "public_body_url"])
    return cur.select("public_body_id", F.array_join(documents.first_of(F.col("website_url"), F.col("public_body_url"), F.col("website_url")), " ").alias("addresses"))


# grids


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each body's disclosures as a grid, its header in front; rows without a date of receipt hold a decision alone, as torn rows do."""
    r = _requests(spark, sf_dir).filter("public_body_id is not null and id is not null")
    torn = F.col("date_received").isNull()
    body = r.select(F.col("public_body_id").alias("file"), F.col("id").alias("row_no"), F.array(F.when(~torn, F.col("foi_reference_id")), F.when(~torn, F.col("date_received")), F.col("decision_status"), F.lit(None).cast("string")).alias("cells"))
    head = r.select(F.col("public_body_id").alias("file")).distinct().select("file", F.lit(0).cast("long").alias("row_no"), F.array(F.lit("Ref"), F.lit("Received"), F.lit("Decision"), F.lit(" ")).alias("cells"))
    return head.unionByName(body)


def _shown(grid: DataFrame) -> DataFrame:
    return grid.select("file", "row_no", F.size("cells").alias("width"), F.md5(F.array_join("cells", "|", "~")).alias("digest"))


def grid_continuations(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = grid_repairs.merged_continuations(_grid(spark, sf_dir))
    return _shown(got).join(got.select("file", "row_no", "n_merged"), ["file", "row_no"])


def grid_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(grid_repairs.pruned_columns(_grid(spark, sf_dir)))


def grid_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads as pages of a body's table, each under the same header."""
    r = _requests(spark, sf_dir).filter("public_body_id is not null and id is not null and load_no is not null")
    body = r.select(F.col("public_body_id").alias("file"), F.col("load_no").alias("page"), F.col("id").alias("row_no"), F.array("foi_reference_id", "decision_status").alias("cells"))
    head = r.select(F.col("public_body_id").alias("file"), F.col("load_no").alias("page")).distinct().select("file", "page", F.lit(0).cast("long").alias("row_no"), F.array(F.lit("Ref "), F.lit("DECISION")).alias("cells"))
    return _shown(grid_repairs.merged_pages(head.unionByName(body))).select("file", "row_no", "digest")


def grid_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns that hold two values each: a date and a text, and a date with a number in one of four ways."""
    r = _requests(spark, sf_dir).filter("public_body_id is not null and id is not null")
    day, no = F.date_format("loaded_at", "dd/MM/yyyy"), F.substring(F.lpad(F.col("id").cast("string"), 5, "1"), -5, 5)
    mixed = F.when(F.col("file_type") == "pdf", F.concat_ws(" ", day, no)).when(F.col("file_type") == "xlsx", F.concat_ws(" ", no, day)).when(F.col("file_type") == "csv", F.concat(F.lit("*"), no)).otherwise(day)
    body = r.select(F.col("public_body_id").alias("file"), F.col("id").alias("row_no"), F.array(F.concat_ws(" ", day, "decision_status"), mixed, F.col("name")).alias("cells"))
    head = r.select(F.col("public_body_id").alias("file")).distinct().select("file", F.lit(0).cast("long").alias("row_no"), F.array(F.lit("Date and status"), F.lit("Date of Request:"), F.lit("Body")).alias("cells"))
    return _shown(grid_repairs.split_combined_columns(head.unionByName(body), ["date and status"], ["date of request"]))


def grid_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each body's grid under a title and a header in two lines."""
    g = _requests(spark, sf_dir).filter("public_body_id is not null and id is not null").select(F.col("public_body_id").alias("file"), F.col("id").alias("row_no"), F.array("name", "file_type", "file_url", F.col("id").cast("string")).alias("cells"))
    line = lambda n, *c: g.select("file").distinct().select("file", F.lit(n).cast("long").alias("row_no"), F.array(*[F.lit(x).cast("string") for x in c]).alias("cells"))
    g = line(-3, "Log", None, None, None).unionByName(line(-2, "Ref", "Date", "Decision", None)).unionByName(line(-1, None, "received", None, None)).unionByName(g)
    return _shown(grid_repairs.repaired_headers(g, {"ref": "reference", "date received": "received", "decision": "decision"})).filter("row_no <= 0")


def header_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.header_profile(_requests(spark, sf_dir).filter("requester_type is not null and id is not null"), "requester_type", "file_url", "id")


def grid_text_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken and run-together words of grids whose statuses are cut after two thirds by a border."""
    n = F.ceil(F.length("decision_status") * 2 / 3).cast("int")
    g = _requests(spark, sf_dir).filter("public_body_id is not null").select("public_body_id", F.array(F.substring("decision_status", F.lit(1), n), F.substring("decision_status", n + 1, F.lit(99)), F.concat("file_type", F.lit("Type"), "review_status")).alias("cells"))
    return grids.text_scores(g, "public_body_id", "cells")


def grid_role_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _requests(spark, sf_dir).filter("public_body_id is not null").select("public_body_id", F.array(*FIELDS).alias("cells"))
    return grids.role_scores(g, "public_body_id", "cells", {0: "code", 1: "date", 2: "date"})


# pages


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as boxes on the pages of their orders."""
    line = table(spark, sf_dir, "lineitem")
    x, y = F.col("l_quantity") * 12, F.col("l_discount") * 4000
    return line.select(F.col("l_orderkey").alias("document"), F.lit(1).alias("page"), (F.col("l_linenumber") * 10**12 + F.col("l_partkey") * 10**6 + F.col("l_suppkey")).alias("seq"), F.lit(0).alias("block"), x.alias("x0"), y.alias("y0"), (x + 80).alias("x1"), (y + 12).alias("y1"), F.concat_ws("-", "l_linenumber", "l_returnflag", "l_partkey", "l_suppkey").alias("text"))


def reading_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.reading_order(_boxes(spark, sf_dir)).select("document", "seq", "line_no")


def page_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.text_columns(_boxes(spark, sf_dir)).select("document", "column", F.round("left", 4).alias("left_edge"), F.round("right", 4).alias("right_edge"), "n_lines")


def page_inversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.inversions(_boxes(spark, sf_dir)).select("document", "seq")


def uncovered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each order that stand before or behind its returned ones, as runs."""
    p = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("document"), F.col("l_linenumber").alias("page"), "l_returnflag").distinct()
    return pages.page_coverage(p, p.filter("l_returnflag = 'R'").select("document", F.col("page").alias("first_page"), F.col("page").alias("last_page")))


# joins and merges


def dual_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recipients by two signals: a customer's nation, where it has a balance, and the letter of its code."""
    n = table(spark, sf_dir, "nation")
    c = table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("n_name")).alias("heading"), F.concat(F.substring("n_name", 1, 1), "c_custkey").alias("code"))
    got = records.dual_resolved(c, n.select(F.col("n_name").alias("alias"), F.col("n_regionkey").alias("recipient")), n.select(F.substring("n_name", 1, 1).alias("prefix"), F.col("n_regionkey").alias("recipient")), F.col("heading"), F.col("code"))
    return got.select("c_custkey", "recipient", "error")


def order_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first order of each customer under the customer's number, by name."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("owner"))
    return matching.crosswalk(o, F.col("owner"), table(spark, sf_dir, "customer"), F.col("c_name"), "c_custkey", [F.col("o_orderkey")]).select("o_orderkey", "new_id")


def included_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register rows that a directory (bodies with requests) or hand-made additions (bodies with files) name."""
    register = current_rows(table(spark, sf_dir, "public_bodies"), "public_body_id", "loaded_at", ["public_body_name"])
    extra = table(spark, sf_dir, "disclosure_files").select("public_body_id").join(register, "public_body_id", "left_semi")
    got = matching.included(register, _requests(spark, sf_dir).filter("public_body_id is not null").select("public_body_id"), extra, "public_body_id")
    return matching.resolved(got, "public_body_name", "drop").select("public_body_id", "public_body_name")


def sorted_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of requests by falling date of decision, those without one last, then by id."""
    t = dedup.guarded(_requests(spark, sf_dir).select("id", "decision_date"), "id", 1)
    return dedup.ranked(t, [], [F.desc_nulls_last("decision_date"), F.col("id")], "place").select("id", "place")


def sorted_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.ranked(_names(spark, sf_dir).withColumn("low", F.lower("name")), [], [F.col("low"), F.col("name")], "place").select("name", "place")


def cache_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions (segment and nation of a customer) without a recorded answer; those of the first regions are recorded."""
    asked = table(spark, sf_dir, "customer").select(hashes.content_key(F.col("c_mktsegment"), F.col("c_nationkey")).alias("key"), "c_mktsegment", "c_nationkey")
    known = table(spark, sf_dir, "nation").filter("n_regionkey < 2").join(asked.select("key", "c_nationkey").distinct(), F.col("n_nationkey") == F.col("c_nationkey")).select("key", F.col("n_name").alias("answer"))
    hits, misses = incremental.answered(asked, known, "key")
    return hits.groupBy("key").agg(F.count(F.lit(1)).alias("n_hits")).select("key", "n_hits").unionByName(misses.select("key", F.lit(0).cast("long").alias("n_hits")))


def dirty_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies whose contacts differ between the last snapshots, and whether the register has what is needed to recompute them."""
    s = table(spark, sf_dir, "public_body_snapshots").filter("public_body_id is not null")
    at = lambda n: current_rows(s.filter(F.col("snapshot_no") == n), "public_body_id", "exported_at", ["website_url", "foi_email"])
    dirty = incremental.dirty_if_different(at(4), at(5), "public_body_id", ["website_url", "foi_email"])
    now, later = incremental.split_dirty(dirty, table(spark, sf_dir, "public_bodies").filter("foi_email is not null"), "public_body_id")
    return now.withColumn("state", F.lit("dirty")).unionByName(later.withColumn("state", F.lit("deferred")))


def best_name_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Printed names that no key matches: the register's name if one is near enough, else the best score and a suggestion."""
    cur = table(spark, sf_dir, "public_bodies").filter("public_body_name is not null")
    left = matching.keyed_match(_requests(spark, sf_dir).filter("name is not null").select("name").distinct(), text.body_name_key(F.col("name")), cur, text.body_name_key(F.col("public_body_name")), "public_body_id")
    left = left.filter("match_status = 'unmatched'").select(text.body_name_key(F.col("name")).alias("query")).filter("query <> ''")
    return matching.best_match(left, cur.select(text.body_name_key(F.col("public_body_name")).alias("candidate")).filter("candidate <> ''"))


def mapped_grid_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the busiest grids by a hand-made mapping that lets two change places and names one twice: the mapping's errors and the rows moved."""
    g = _grid(spark, sf_dir)
    files = table(spark, sf_dir, "public_bodies").filter("parent_id is null and public_body_id is not null").select(F.col("public_body_id").alias("file")).distinct()
    m = files.select("file", F.inline(F.array(*[F.struct(F.lit(i).alias("column"), F.lit(c).alias("canonical")) for i, c in ((2, "decision"), (0, "reference"), (1, "reference"), (9, "gone"))])))
    moved, errors = grid_repairs.mapped_columns(g, m)
    a = moved.filter("size(cells) = 2").groupBy("file").agg(F.count(F.lit(1)).alias("n")).select("file", F.lit("moved").alias("what"), "n")
    return a.unionByName(errors.groupBy("file", F.col("error").alias("what")).agg(F.count(F.lit(1)).alias("n")))


QUERIES = {f.__name__: f for f in (
    clean_cells, status_keys, authority_names, body_slugs, suspicious_texts, block_kinds, picked_emails, name_tokens, action_references, leading_ordinals, footnoted_titles, plan_references, schedule_documents,
    dumped_decisions, quarantined_texts, serialised_values, json_in_texts, link_dates, strict_quarters, latest_quarter_days, printed_quantities, activity_codes, logged_addresses, content_keys, contact_order, grid_continuations, grid_pruned,
    grid_pages, grid_combined, grid_headers, header_profiles, grid_text_scores, grid_role_scores, reading_orders, page_columns, page_inversions, uncovered_pages, dual_signals, order_crosswalk, included_bodies, sorted_decisions,
    sorted_names, cache_misses, dirty_bodies, best_name_matches, mapped_grid_columns,
)}

_KEY = lambda c: rf"regexp_replace(lower(regexp_replace({_STRIP(c)}, '[\s\p{{Z}}_]+', ' ', 'g')), '[\s\p{{Z}}.:/]+$', '')"
_CUR = "cur as (select * from public_bodies where public_body_id is not null qualify row_number() over (partition by public_body_id order by loaded_at desc nulls last, {} desc nulls last) = 1)"
_NAMES = "n as (select distinct public_body_name as name from public_bodies where public_body_name is not null)"
_FULL = lambda c: f"coalesce({_STRIP(c)}, '') <> ''"
_GRID = """r as (select public_body_id f, id, date_received is null torn, foi_reference_id, date_received, decision_status from foi_disclosures where public_body_id is not null and id is not null),
g as (select f, 0 as row_no, 'Ref' a, 'Received' b, 'Decision' c, ' ' d from r group by f union all select f, id, case when not torn then foi_reference_id end, case when not torn then date_received end, decision_status, null from r)"""
_TYPE = r"case when coalesce(v, '') <> '' then case when regexp_full_match(v, '[0-9]{1,4}[-/.][0-9]{1,2}[-/.][0-9]{1,4}') then 'date' when regexp_full_match(v, '€?[0-9][0-9,.]*') then 'number' when regexp_full_match(v, '[A-Za-z]*[/ -]?[0-9][0-9A-Za-z/ -]*') then 'code' else 'text' end end"
_SLUG = lambda c: f"regexp_replace(regexp_replace(replace({_FOLD(c)}, '&', ' and '), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
_DIGEST = "md5(array_to_string(list_transform({}, lambda x: coalesce(x, '~')), '|')) digest"
_BOX = "x as (select l_orderkey document, cast(l_linenumber as bigint) * 1000000000000 + l_partkey * 1000000 + l_suppkey seq, l_quantity * 12 x0, l_discount * 4000 y0, l_quantity * 12 + 80 x1, concat_ws('-', l_linenumber, l_returnflag, l_partkey, l_suppkey) t from lineitem)"
_SHORT = ", ".join(f"'{w}'" for w in grids.SHORT_WORDS)

SQL = {
    "clean_cells": rf"with c as (select id, {_STRIP("regexp_replace(regexp_replace(replace(' (cid:12)' || request_description, '(cid:12)', ''), '[\r\n]', ' ', 'g'), ' {2,}', ' ', 'g')")} v from foi_disclosures where request_description is not null) select id, cast(length(v) as int) n_chars, md5(v) digest from c",
    "status_keys": rf"select decision_status, {_KEY("replace(decision_status, '-', ' ')")} status_key, regexp_replace(replace(lower({_SQUEEZE('decision_status')}), 'ß', 'ss'), '^[.,;: ]+|[.,;: ]+$', '', 'g') bare_value, count(*) n_rows from foi_disclosures where decision_status is not null group by 1",
    "authority_names": f"with {_NAMES} select 'County Council - ' || name printed, trim(name) || ' County Council' authority from n union all select 'city & county council -' || name, trim(name) || ' City and County Council' from n union all select name, null from n",
    "body_slugs": rf"""with {_CUR.format('public_body_name')} select public_body_id, case when coalesce(public_body_name, '') = '' then 'unknown' else regexp_replace(regexp_replace(regexp_replace(lower(public_body_name), '[^\p{{L}}\p{{N}}_\s-]', '', 'g'), '\s+', '-', 'g'), '^-+|-+$', '', 'g') end text_slug,
 coalesce(nullif({_SLUG('public_body_name')}, ''), 'body-' || public_body_id) slug, regexp_replace(regexp_replace(lower({_SQUEEZE('public_body_name')}), '["“”]', '', 'g'), '^[ .:]+|[ .:]+$', '', 'g') alias_key from cur""",
    "suspicious_texts": r"with s as (select distinct public_body_id, regexp_extract_all(regexp_replace(public_body_category, '(.)', '\1 ', 'g') || ' (cid:7) and the rest', '(\(cid:[0-9]+\)|\b(?:\p{L} ){3,}\p{L}\b)', 1) s from public_bodies where public_body_category is not null) select public_body_id, cast(len(s) as int) n_spans, array_to_string(s, '|') spans from s",
    "block_kinds": r"""with b as (select doc_id, unnest(regexp_split_to_array(text, '(?:\r?\n[ \t]*)+\r?\n')) b from documents where text is not null),
l as (select doc_id, list_filter(regexp_split_to_array(b, '\r?\n'), lambda x: regexp_replace(x, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') <> '') l from b)
select doc_id, case when len(l) > 0 and len(list_filter(l, lambda x: regexp_matches(x, '^\s*[•‣*–-]\s+'))) = len(l) then 'bullet' when len(l) > 0 and len(list_filter(l, lambda x: regexp_matches(x, '^\s*(\(?[0-9]{1,3}[.)]|\(?[a-z][.)])\s+'))) = len(l) then 'ordered' else 'none' end kind, count(*) n_blocks from l group by 1, 2""",
    "picked_emails": rf"""with {_CUR.format('foi_email')}, e as (select public_body_id, list_sort(list_distinct(regexp_extract_all(lower(concat_ws(' ', foi_email, 'info@body' || public_body_id || '.example')), '{text.EMAIL}'))) e from cur),
p as (select public_body_id, e, list_filter(e, lambda x: contains(x, 'foi') or contains(x, 'freedom')) f from e)
select public_body_id, case when len(e) = 1 then e[1] when len(f) > 0 then f[1] end address, case when len(e) = 1 or len(f) > 0 then 'found' else 'multiple_found' end status from p""",
    "name_tokens": f"with {_NAMES}, t as (select distinct name, unnest(regexp_extract_all(lower(name), '[a-z0-9]+')) token from n) select token, count(*) n_names from t group by 1",
    "action_references": r"""with r as (select upper(left(name, 2)) || '/ ' || strftime(loaded_at, '%y') || '/' || id || case when file_type = 'xlsx' then 'A **' when file_type = 'pdf' then '*' else '/B (TF)*' end a, '0' || left(cast(id as varchar), 2) b, coalesce(foi_reference_id, '') c from foi_disclosures where name is not null and id is not null and loaded_at is not null),
t as (select distinct unnest([a, b, c]) cell from r), p as (select cell, regexp_replace(trim(regexp_replace(cell, '\s+', ' ', 'g')), '\s*/\s*', '/', 'g') printed from t),
q as (select cell, printed, regexp_extract(printed, '(.*[^*)\s]|)((?:\s*(?:[*]|\(\s*TF\s*\)))*)\s*$', 1) core, regexp_extract(printed, '(.*[^*)\s]|)((?:\s*(?:[*]|\(\s*TF\s*\)))*)\s*$', 2) tail from p),
n as (select *, case when regexp_full_match(core, '[0-9]{1,3}') then cast(cast(core as int) as varchar) when regexp_full_match(core, '[A-Z]{2}/[0-9]{2}/[0-9]+(/[A-Z]|[A-Z])?') then core end number,
 concat_ws(',', case when contains(replace(tail, '**', ''), '*') then 'non_reportable' end, case when contains(tail, '**') then 'duplicate' end, case when contains(tail, 'TF') then 'taskforce' end) flags from q)
select cell, number, case when number is null then null when regexp_full_match(core, '[0-9]+') and flags = '' then number else printed end printed, case when number is not null then flags end flags, case when contains(number, '/') then cast(split_part(number, '/', 2) as int) + 2000 end "year",
 case when number is not null then null when regexp_matches(core, '[A-Za-z0-9]') and not regexp_full_match(core, '[A-Za-z0-9]+(/[A-Za-z0-9]+)*') then 'InvalidActionReference' else 'UnresolvedActionNumber' end error,
 nullif(regexp_extract(number, '^([A-Z]{2}/[0-9]{2}/[0-9]+)/?[A-Z]$', 1), '') parent from n""",
    "leading_ordinals": "select id, case when file_type = 'pdf' then cast(left(cast(id as varchar), 4) as int) when regexp_matches(decision_status, '^\\s*[0-9]{1,4}\\s*[.)]') then cast(regexp_extract(decision_status, '^\\s*([0-9]{1,4})', 1) as int) end ordinal, case when file_type = 'pdf' then ltrim(decision_status) when regexp_matches(decision_status, '^\\s*[0-9]{1,4}\\s*[.)]') then regexp_replace(decision_status, '^\\s*[0-9]{1,4}\\s*[.)]\\s*', '') else decision_status end \"text\" from foi_disclosures where decision_status is not null",
    "footnoted_titles": f"with {_NAMES} select name || '12' printed, trim(name) title from n union all select name || ' [3]', trim(name) from n union all select name || ' *', trim(name) from n union all select name, trim(name) from n",
    "plan_references": "select o_orderkey, case when o_orderstatus = 'F' then 'complements' else 'references' end relationship, 'Plan ' || left(o_orderpriority, 1) \"plan\", unnest([cast(o_custkey as varchar), '7', cast(o_orderkey as varchar)]) number from orders where o_orderpriority is not null",
    "schedule_documents": r"select * from (select doc_id, cast(len(regexp_extract_all(text, '(?i)decided\s+to\s+grant')) as int) n_grant, cast(len(regexp_extract_all(text, '(?i)schedule\s+attached')) as int) n_schedule, cast(len(regexp_extract_all(text, '(?i)internal\s+review')) as int) n_review, cast(length(text) as int) n_chars from documents where text is not null) where n_schedule > 0 and n_review > 0",
    "dumped_decisions": """with b as (select public_body_id, count(*) n_items, count(*) filter (contains(lower(decision_status), 'grant')) n_granted from foi_disclosures where public_body_id is not null group by 1),
t as (select public_body_id, trim(requester_type) a, count(*) k from foi_disclosures where trim(requester_type) <> '' group by 1, 2 qualify row_number() over (partition by public_body_id order by k desc, a desc) = 1)
select public_body_id, n_items, n_granted, a top_requester_type, k n_top_requester_type from b join t using (public_body_id) where n_items >= 10 and n_granted >= 0.2 * n_items and k >= 0.2 * n_items""",
    "quarantined_texts": f"select doc_id, cast(length({_STRIP("coalesce(text, '')")}) as int) n_chars from documents where length({_STRIP("coalesce(text, '')")}) < 400",
    "serialised_values": "select o_orderkey, unnest([0, 1, 2, 3]) cell_no, unnest([cast(o_orderkey as varchar), o_orderstatus, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'), '[' || o_custkey || ',' || o_orderkey || ']']) \"text\", unnest([false, false, false, true]) as_json from orders",
    "json_in_texts": "select c_custkey, c_mktsegment \"within\", c_custkey fenced, c_mktsegment whole from customer",
    "link_dates": rf"""with l as (select distinct 'minutes ' || date_added || ' final.pdf' link from disclosure_files where date_added is not null),
p as (select link, case when regexp_matches(link, '(^|[^0-9])[0-9]{{4}}[-_/][0-9]{{2}}[-_/][0-9]{{2}}([^0-9]|$)') then regexp_extract(link, '(?:^|[^0-9])([0-9]{{4}})[-_/]([0-9]{{2}})[-_/]([0-9]{{2}})(?:[^0-9]|$)', ['y', 'm', 'd'])
 when regexp_matches(link, '(?i)(^|[^0-9])[0-9]{{1,2}}(st|nd|rd|th)?[ _%20.-]+[A-Za-z]{{3,9}}[.]?[ _%20,.-]+[0-9]{{4}}([^0-9]|$)') then regexp_extract(link, '(?i)(?:^|[^0-9])([0-9]{{1,2}})(?:st|nd|rd|th)?[ _%20.-]+([A-Za-z]{{3,9}})[.]?[ _%20,.-]+([0-9]{{4}})(?:[^0-9]|$)', ['d', 'm', 'y'])
 when regexp_matches(link, '(^|[^0-9])[0-3][0-9][01][0-9](19|20)[0-9]{{2}}([^0-9]|$)') then regexp_extract(link, '(?:^|[^0-9])([0-3][0-9])([01][0-9])((?:19|20)[0-9]{{2}})(?:[^0-9]|$)', ['d', 'm', 'y']) end s from l)
select link, link_day from (select link, try_cast(printf('%04d-%02d-%02d', cast(s.y as int), coalesce({_MONTH('s.m')}, try_cast(s.m as int)), cast(s.d as int)) as date) link_day from p where s is not null) where link_day is not null""",
    "strict_quarters": "select case when o_orderstatus = 'O' then 'q' else 'Q' end || quarter(o_orderdate) || ' ' || year(o_orderdate) printed, case when o_orderstatus <> 'O' or o_orderstatus is null then cast(year(o_orderdate) as int) end \"year\", case when o_orderstatus <> 'O' or o_orderstatus is null then cast(quarter(o_orderdate) as int) end \"quarter\", count(*) n_orders from orders group by all",
    "latest_quarter_days": "with o as (select *, date_trunc('quarter', o_orderdate) q from orders where o_orderdate is not null) select 'Q' || quarter(q) || ' ' || year(q) period, strftime(o_orderdate, '%Y-%m-%d') \"day\", count(*) n_orders from o where q = (select max(q) from o) group by all",
    "printed_quantities": r"select printed, try_cast(replace(printed, ',', '') as decimal(18, 2)) quantity, count(*) n_rows from (select unnest(regexp_extract_all(request_description, '[0-9][0-9,.]*')) printed from foi_disclosures) group by 1",
    "activity_codes": "select p_partkey, upper(left(p_type, 1)) \"section\", left(printf('%04d', p_partkey), 2) division, left(printf('%04d', p_partkey), 3) activity_group, printf('%04d', p_partkey) activity_class from part where p_partkey < 10000 and upper(left(p_type, 1)) between 'A' and 'U'",
    "logged_addresses": r"select left(regexp_replace(lower(regexp_extract(document_url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)), '^www[.]', ''), 50) logged, regexp_extract(document_url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || '/' root, count(*) n_files from disclosure_files where document_url is not null group by 1, 2",
    "content_keys": "select id, sha256(concat(trim(coalesce(cast(public_body_id as varchar), ''), ' '), chr(31), trim(coalesce(foi_reference_id, ''), ' '), chr(31), trim(coalesce(requester_type, ''), ' '))) content_key from foi_disclosures",
    "contact_order": f"with {_CUR.format('website_url desc nulls last, public_body_url')} select public_body_id, concat_ws(' ', website_url, case when public_body_url is distinct from website_url then public_body_url end) addresses from cur",
    "grid_continuations": f"""with {_GRID}, k as (select *, row_number() over w i, ({_FULL('a')})::int + ({_FULL('b')})::int + ({_FULL('c')})::int filled, (a is not null)::int + (b is not null)::int + (c is not null)::int + (d is not null)::int held from g window w as (partition by f order by row_no)),
s as (select f, count(*) filter (row_no > 0 and held = 1) thin, count(*) filter (row_no > 0 and held > 1) full_rows, count(*) - 1 n from k group by f),
x as (select k.*, filled = 1 and i > 2 and not (thin > 0.5 * n and full_rows < 0.1 * n) flows from k join s using (f)),
l as (select *, max(case when not flows then row_no end) over (partition by f order by row_no) lead from x),
m as (select f, lead row_no, count(*) n, string_agg(a, ' ' order by l.row_no) filter ({_FULL('a')}) a, string_agg(b, ' ' order by l.row_no) filter ({_FULL('b')}) b, string_agg(c, ' ' order by l.row_no) filter ({_FULL('c')}) c from l where flows group by 1, 2),
j as (select l.f, l.row_no, coalesce(m.n, 0) n_merged, case when m.a is null then l.a else concat_ws(' ', case when {_FULL('l.a')} then l.a end, m.a) end a, case when m.b is null then l.b else concat_ws(' ', case when {_FULL('l.b')} then l.b end, m.b) end b, case when m.c is null then l.c else concat_ws(' ', case when {_FULL('l.c')} then l.c end, m.c) end c, l.d from l left join m on m.f = l.f and m.row_no = l.row_no where not flows)
select f "file", row_no, 4 width, {_DIGEST.format('[a, b, c, d]')}, cast(n_merged as int) n_merged from j""",
    "grid_pruned": f"with {_GRID}, e as (select f, max(({_FULL('c')})::int) has_c from g group by f) select f \"file\", row_no, 3 width, {_DIGEST.format('[a, b, c]')} from g join e using (f)",
    "grid_pages": f"""with b as (select public_body_id f, load_no p, id row_no, foi_reference_id a, decision_status c from foi_disclosures where public_body_id is not null and id is not null and load_no is not null),
h as (select f, min(p) p, -1 row_no, 'Ref ' a, 'DECISION' c from b group by f), u as (select * from h union all select * from b)
select f "file", row_number() over (partition by f order by p, row_no) - 1 row_no, {_DIGEST.format('[a, c]')} from u""",
    "grid_combined": f"""with r as (select public_body_id f, id, file_type t, strftime(loaded_at, '%d/%m/%Y') d, right(lpad(cast(id as varchar), 5, '1'), 5) n, decision_status s, name from foi_disclosures where public_body_id is not null and id is not null),
k as (select f, count(*) filter (t = 'csv') > 0 two from r group by f),
x as (select f, id, two, [case when {_FULL('s')} then d else concat_ws(' ', d, s) end, nullif({_STRIP("coalesce(s, '')")}, '')] ab, [case when t = 'csv' and two then null when two then d when t = 'pdf' then d || ' ' || n when t = 'xlsx' then n || ' ' || d else d end] e, case when two then [case when t in ('csv', 'pdf', 'xlsx') then n end] else [] end g, [name] h from r join k using (f))
select f "file", id row_no, cast(4 + two::int as int) width, {_DIGEST.format('list_concat(list_concat(ab, e), list_concat(g, h))')} from x
union all select f, 0, cast(4 + two::int as int), {_DIGEST.format("list_concat(['Date', 'Description', 'Date of Request:'], list_concat(case when two then ['Reference'] else [] end, ['Body']))")} from k""",
    "grid_headers": f"select distinct public_body_id \"file\", cast(-1 as bigint) row_no, 4 width, {_DIGEST.format("['Ref', 'Date received', 'Decision', 'Decision']")} from foi_disclosures where public_body_id is not null and id is not null",
    "header_profiles": f"select {_KEY('requester_type')} header_key, count(*) n_headers, arg_min(requester_type, id) first_written, arg_min(file_url, id) first_source from foi_disclosures where requester_type is not null and id is not null group by 1 having header_key <> ''",
    "grid_text_scores": rf"""with g as (select public_body_id b, left(decision_status, cast(ceil(length(decision_status) * 2 / 3) as int)) x, substr(decision_status, cast(ceil(length(decision_status) * 2 / 3) as int) + 1, 99) y, file_type || 'Type' || review_status z from foi_disclosures where public_body_id is not null),
w as (select *, lower(regexp_extract(x, '[A-Za-z]+$')) xa, regexp_extract(y, '^[a-z]+') ya, lower(regexp_extract(y, '[A-Za-z]+$')) yb, regexp_extract(z, '^[a-z]+') zb from g),
s as (select *, (coalesce(xa, '') <> '' and coalesce(ya, '') <> '' and (length(xa) <= 3 and xa not in ({_SHORT}) or length(ya) <= 3 and ya not in ({_SHORT})))::int + (coalesce(yb, '') <> '' and coalesce(zb, '') <> '' and (length(yb) <= 3 and yb not in ({_SHORT}) or length(zb) <= 3 and zb not in ({_SHORT})))::int k,
 coalesce(len(regexp_extract_all(x, '[a-z]{{2}}[A-Z][a-z]')), 0) + coalesce(len(regexp_extract_all(y, '[a-z]{{2}}[A-Z][a-z]')), 0) + coalesce(len(regexp_extract_all(z, '[a-z]{{2}}[A-Z][a-z]')), 0) t, ({_FULL('x')})::int + ({_FULL('y')})::int + ({_FULL('z')})::int n from w)
select b public_body_id, cast(sum(n) as bigint) n_cells, coalesce(sum(k) / nullif(sum(n), 0), 1.0) split_word_rate, coalesce(sum(t) / nullif(sum(n), 0), 1.0) run_together_rate from s group by 1""",
    "grid_role_scores": rf"""with x as (select public_body_id b, unnest([foi_reference_id, date_received, decision_date]) c, unnest([0, 1, 2]) i, unnest(['code', 'date', 'date']) own from foi_disclosures where public_body_id is not null),
v as (select b, i, own, {_STRIP('c')} v from x), k as (select b, i, own, {_TYPE} t from v where coalesce(v, '') <> '' and lower(v) not in ('n/a', 'na', 'nil', 'none', 'tbc', '-', '–', '—')),
p as (select b, i, count(*) n, count(*) filter (t <> own and t <> 'text') k from k group by all having n >= 5), w as (select b, sum(k) / sum(n) c, max(k / n) s, arg_max(i, (k / n, -i)) i from p group by b),
y as (select public_body_id b, unnest([date_received, decision_date, foi_reference_id]) c, unnest(['date', 'date', 'code']) own, id from foi_disclosures where public_body_id is not null), z as (select b, id, own, {_STRIP('c')} v from y), a as (select b, id, max(coalesce(({_TYPE}) = own, false)::int) ok from z group by all), r as (select b, avg(ok) share from a group by b)
select b public_body_id, c role_contamination, s worst_role_contamination, cast(i as int) worst_column, share anchored_row_share from r left join w using (b)""",
    "reading_orders": f"with {_BOX} select document, seq, cast(row_number() over (partition by document order by floor(y0 / 3.0), x0, t) as int) line_no from x",
    "page_columns": f"""with {_BOX}, f as (select *, case when x0 - lag(x0) over w <= 60 then 0 else 1 end f from x window w as (partition by document order by x0, y0)), c as (select *, sum(f) over (partition by document order by x0, y0 rows unbounded preceding) c from f)
select document, cast(c as bigint) "column", round(median(x0), 4) left_edge, round(median(x1), 4) right_edge, count(*) n_lines from c group by all having n_lines >= 2""",
    "page_inversions": f"with {_BOX} select document, seq from x qualify y0 < lag(y0) over (partition by document order by seq)",
    "uncovered_pages": """with p as (select l_orderkey d, l_linenumber p, max((l_returnflag = 'R')::int) r from lineitem group by all), g as (select d, p, p - row_number() over (partition by d order by p) i from p where r = 0)
select d document, min(p) first_page, max(p) last_page from g group by d, i""",
    "dual_signals": """with p as (select left(n_name, 1) p, list(distinct n_regionkey) r from nation group by 1), c as (select c_custkey, case when c_acctbal > 0 then n_regionkey end h, r from customer join nation on c_nationkey = n_nationkey join p on p.p = left(n_name, 1))
select c_custkey, case when h is not null then h when len(r) = 1 then r[1] end recipient, case when h is null and len(r) > 1 then 'shared_prefix' end error from c""",
    "order_crosswalk": "select min(o_orderkey) o_orderkey, o_custkey new_id from orders join customer on c_custkey = o_custkey group by o_custkey",
    "included_bodies": f"with {_CUR.format('public_body_name')} select public_body_id, public_body_name from cur where public_body_name is not null and (public_body_id in (select public_body_id from foi_disclosures) or public_body_id in (select public_body_id from disclosure_files))",
    "sorted_decisions": "select id, row_number() over (order by decision_date desc nulls last, id) place from foi_disclosures",
    "sorted_names": f"with {_NAMES} select name, row_number() over (order by lower(name), name) place from n",
    "cache_misses": """with a as (select sha256(concat(trim(c_mktsegment), chr(31), c_nationkey)) k, n_regionkey r from customer join nation on n_nationkey = c_nationkey) select k "key", case when max(r) < 2 then count(*) else 0 end n_hits from a group by 1""",
    "dirty_bodies": """with s as (select * from public_body_snapshots where public_body_id is not null qualify row_number() over (partition by snapshot_no, public_body_id order by exported_at desc nulls last, website_url desc nulls last, foi_email desc nulls last) = 1),
d as (select n.public_body_id from s n left join s o on o.public_body_id = n.public_body_id and o.snapshot_no = 4 where n.snapshot_no = 5 and (o.public_body_id is null or n.website_url is distinct from o.website_url or n.foi_email is distinct from o.foi_email))
select public_body_id, case when public_body_id in (select public_body_id from public_bodies where foi_email is not null) then 'dirty' else 'deferred' end state from d""",
    "mapped_grid_columns": f"""with {_GRID}, p as (select distinct public_body_id f from public_bodies where parent_id is null and public_body_id is not null), n as (select f, count(*) n from g group by f)
select f "file", 'moved' what, n from p join n using (f) union all select p.f, unnest(case when n.f is null then ['no_such_file'] else ['named_twice', 'no_such_column'] end), unnest(case when n.f is null then [4] else [1, 1] end) from p left join n on n.f = p.f""",
}
