"""Queries for joins, deduplication, rollups and windows over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedgeline.functions import hashes, text, urls
from sedgeline.operators import dedup, incremental, matching, pages, rollups, windows
from sedgeline.operators.profile import blank
from sedgeline.operators.references import current_rows
from sedgeline.runtime import bounded_rows, table

CLEAN = ["foi_reference_id", "decision_date", "date_received", "requester_type", "decision_status", "request_description"]


def dedup_by_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept: the first per body and reference, without a reference the first per content."""
    t = table(spark, sf_dir, "foi_disclosures").select("id", "public_body_id", "file_url", *CLEAN)
    ref = F.when(F.coalesce("foi_reference_id", F.lit("")) != "", text.stripped(F.col("foi_reference_id")))
    content = F.when(ref.isNull(), hashes.content_key(F.col("file_url"), *[F.col(c) for c in CLEAN[1:]]))
    return dedup.keep_first(t.select("id", "public_body_id", ref.alias("ref"), content.alias("content")), [F.col("public_body_id"), F.col("ref"), F.col("content")], ["id"]).select("id", "public_body_id")


def dedup_documents_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("digest"))
    return dedup.keep_first(t, [F.col("digest")], ["doc_id"]).select("doc_id")


def dedup_lineitem_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row per order and line, by all other columns."""
    t = table(spark, sf_dir, "lineitem")
    return dedup.keep_first(t, [F.col("l_orderkey"), F.col("l_linenumber")], [c for c in t.columns if c not in ("l_orderkey", "l_linenumber")])


def ordinal_suffix_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws("/", text.name_slug(F.col("p_brand")), text.name_slug(F.col("p_name"))).alias("identity"))
    return dedup.ordinal_suffix(t, F.col("identity"), ["p_partkey"], "part_id").select("p_partkey", "part_id")


def request_sequence_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct requests per body and month of loading, numbered r001 ... in order of their first row."""
    t = table(spark, sf_dir, "foi_disclosures").filter("public_body_id is not null and request_description is not null")
    t = t.select("id", "public_body_id", F.date_format("loaded_at", "yyyy-MM").alias("month"), F.md5(text.squeezed(F.lower("request_description"))).alias("digest"))
    return dedup.sequence_ids(t, ["public_body_id", "month"], "digest", ["id"], "r", "request_no").select("id", "public_body_id", "month", "request_no")


def assigned_name_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids for names in the disclosures that the register does not have, after its greatest id."""
    known = table(spark, sf_dir, "public_bodies").select(text.match_key(F.col("public_body_name")).alias("name_key"), F.col("public_body_id").cast("bigint").alias("body_id"))
    new = table(spark, sf_dir, "foi_disclosures").select(text.match_key(F.col("name")).alias("name_key"))
    return dedup.assigned_ids(known, new, "name_key", "body_id")


def forward_filled_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's requester type, blanks and dashes taking the last one above in their file."""
    t = table(spark, sf_dir, "foi_disclosures").filter("file_url is not null")
    value = F.when(~blank(F.col("requester_type")) & ~F.trim("requester_type").isin("-", "--"), F.col("requester_type"))
    return t.select("id", windows.filled_forward(value, ["file_url"], ["id"]).alias("filled_type"))


def event_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of a user's events with gaps of at most six hours."""
    t = table(spark, sf_dir, "events").withColumn("_at", F.unix_micros(F.col("ts").cast("timestamp")))
    t = windows.clusters(t, ["user_id"], F.col("_at"), F.lit(6 * 3600 * 1_000_000), ["_at", "event_id"], "cluster_no")
    return t.groupBy("user_id", "cluster_no").agg(F.count(F.lit(1)).alias("n_events"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def event_day_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "events").select("user_id", F.date_diff(F.to_date("ts"), F.lit("2024-01-01")).alias("day_no"))
    return windows.islands(t, ["user_id"], "day_no").select("user_id", F.col("first").alias("first_day"), F.col("last").alias("last_day"), F.col("length").alias("n_days"))


def _levelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("level"))


def order_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders as headings, priority being the level: where each one's range ends."""
    return windows.interval_ends(_levelled(spark, sf_dir), ["o_custkey"], "o_orderkey", "level", ["o_orderkey"], [1, 2, 3, 4, 5]).select("o_orderkey", "interval_end")


def order_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.level_parents(_levelled(spark, sf_dir), ["o_custkey"], "o_orderkey", "level", ["o_orderkey"], [1, 2, 3, 4, 5]).select("o_orderkey", F.col("parent").alias("parent_orderkey"))


def event_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the user's last purchase at or before it."""
    t = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return windows.owned(t, t.filter("event_type = 'purchase'").withColumn("purchase_id", F.col("event_id")), ["user_id"], "ts", "purchase_id").select("event_id", "purchase_id")


def league_table_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "events")
    points = F.when(F.col("event_type") == "purchase", 1.0).when(F.col("event_type") == "click", 0.5).otherwise(0.0)
    return rollups.league_table(t, "user_id", points, F.date_format("ts", "yyyy-MM-dd"))


def register_name_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct printed names against the register's names, by key."""
    q = table(spark, sf_dir, "foi_disclosures").filter("name is not null").groupBy("name").agg(F.count(F.lit(1)).alias("n_rows"))
    return matching.keyed_match(q, text.match_key(F.col("name")), table(spark, sf_dir, "public_bodies"), text.match_key(F.col("public_body_name")), "public_body_id")


def fuzzy_name_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The up to three nearest register names of each printed name that no key matches."""
    left = register_name_match(spark, sf_dir).filter("match_status = 'unmatched'").select(text.body_name_key(F.col("name")).alias("query")).filter("query <> ''")
    register = table(spark, sf_dir, "public_bodies").select(text.body_name_key(F.col("public_body_name")).alias("candidate")).filter("candidate <> ''")
    return matching.best_and_next(matching.fuzzy_scores(matching.fuzzy_candidates(left, register, 0.9), 0.9))


def parent_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parents of the register under the newest snapshot as overrides, by two policies."""
    cur = current_rows(table(spark, sf_dir, "public_bodies"), "public_body_id", "loaded_at", ["parent_id"])
    snaps = table(spark, sf_dir, "public_body_snapshots")
    top = snaps.agg(F.max("snapshot_no").alias("snapshot_no"))
    over = current_rows(snaps.join(F.broadcast(top), "snapshot_no"), "public_body_id", "exported_at", ["parent_id"]).select("public_body_id", F.col("parent_id").alias("value"))
    two = cur.select("public_body_id", F.col("parent_id").alias("wins"), F.col("parent_id").alias("fills"))
    return matching.overridden(matching.overridden(two, over, "public_body_id", "wins", "wins"), over, "public_body_id", "fills", "fills")


def body_status_fan_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: every body of the register with what each source has of it."""
    bodies = current_rows(table(spark, sf_dir, "public_bodies"), "public_body_id", "loaded_at", ["public_body_category"])
    return rollups.status_fan_in(bodies.select("public_body_id", "public_body_category"), "public_body_id", _inputs(spark, sf_dir))


def _inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    good = lambda name, c: table(spark, sf_dir, name).select("public_body_id", c.alias("good"))
    return {"files": good("disclosure_files", F.col("date_added").isNotNull()), "requests": good("foi_disclosures", ~blank(F.col("request_description"))), "contacts": good("public_body_snapshots", F.col("foi_email").contains("@"))}


def body_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.coverage(table(spark, sf_dir, "public_bodies").filter("public_body_id is not null"), "public_body_id", _inputs(spark, sf_dir))


def hierarchy_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies whose parent is themselves, is absent, or has another name than the one printed."""
    cur = current_rows(table(spark, sf_dir, "public_bodies"), "public_body_id", "loaded_at", ["parent_id", "parent_name", "public_body_name"])
    up = cur.select(F.col("public_body_id").alias("parent_id"), F.col("public_body_name").alias("_name"), F.lit(True).alias("_has"))
    j = cur.filter("parent_id is not null").join(up, "parent_id", "left")
    issue = F.when(F.col("parent_id") == F.col("public_body_id"), "self").when(F.col("_has").isNull(), "dangling").when(text.match_key(F.col("parent_name")) != text.match_key(F.col("_name")), "name_mismatch")
    return j.select("public_body_id", "parent_id", issue.alias("issue")).filter("issue is not null")


def file_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per link state: rows whose file is listed by one body, by several, by none; and whether it is theirs."""
    files = table(spark, sf_dir, "disclosure_files").filter("document_url is not null").select(F.col("document_url").alias("file_url"), F.col("public_body_id").alias("owner")).distinct()
    per = files.groupBy("file_url").agg(F.count("owner").alias("n_owners"), F.min("owner").alias("owner"))
    j = table(spark, sf_dir, "foi_disclosures").select("public_body_id", "file_url").join(per, "file_url", "left")
    state = F.when(F.col("n_owners").isNull(), "unlisted").when(F.col("n_owners") > 1, "several").when(F.col("owner") == F.col("public_body_id"), "agrees").otherwise("other_body")
    return j.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("file_url").alias("n_files"))


def snapshot_edition_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive editions of each body's entry."""
    t = table(spark, sf_dir, "public_body_snapshots").filter("public_body_id is not null").select("public_body_id", "snapshot_no").distinct()
    w = Window.partitionBy("public_body_id").orderBy("snapshot_no")
    return t.withColumn("previous_no", F.lag("snapshot_no").over(w)).filter("previous_no is not null")


def register_vs_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The register against the newest snapshot: missing, extra, different name, equal."""
    cur = current_rows(table(spark, sf_dir, "public_bodies"), "public_body_id", "loaded_at", ["public_body_name"]).select("public_body_id", F.col("public_body_name").alias("a"), F.lit(1).alias("ha"))
    snaps = table(spark, sf_dir, "public_body_snapshots")
    last = current_rows(snaps.join(F.broadcast(snaps.agg(F.max("snapshot_no").alias("snapshot_no"))), "snapshot_no"), "public_body_id", "exported_at", ["public_body_name"]).select("public_body_id", F.col("public_body_name").alias("b"), F.lit(1).alias("hb"))
    state = F.when(F.col("hb").isNull(), "extra").when(F.col("ha").isNull(), "missing").when(text.squeezed(F.col("a")).eqNullSafe(text.squeezed(F.col("b"))), "equal").otherwise("different")
    return cur.join(last, "public_body_id", "full").groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n_bodies"))


def status_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "foi_disclosures").groupBy("decision_status", "review_status").agg(F.count(F.lit(1)).alias("n_rows"))


def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed checks per body, all counted in one pass; bodies with at least ten."""
    checks = {"no_description": blank(F.col("request_description")), "no_date": blank(F.col("decision_date")), "long_status": F.length("decision_status") > 40, "no_reference": blank(F.col("foi_reference_id")), "short_description": F.length("request_description") < 20, "decided_before_received": F.col("decision_date") < F.col("date_received"), "no_requester": blank(F.col("requester_type"))}
    n = {k: F.sum(F.when(c, 1).otherwise(0)).alias(k) for k, c in checks.items()}
    t = table(spark, sf_dir, "foi_disclosures").filter("public_body_id is not null").groupBy("public_body_id").agg(*n.values())
    return t.withColumn("n_failed", sum((F.col(k) for k in checks), F.lit(0))).filter("n_failed >= 10")


def orders_year_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n_orders"), F.sum(price).cast("double").alias("total"), F.countDistinct("o_custkey").alias("n_customers"), F.sum(F.when(F.col("o_orderstatus") == "F", price).otherwise(0)).cast("double").alias("total_finished"))


def split_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per segment and per year in one pass: count, total, span of years."""
    t = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment")), "o_custkey").withColumn("year", F.year("o_orderdate")).withColumn("y", F.year("o_orderdate"))
    sets = t.groupingSets([["segment"], ["year"]], "segment", "year")
    return sets.agg(F.count(F.lit(1)).alias("n_orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"), F.concat_ws("-", F.min("y").cast("string"), F.max("y").cast("string")).alias("years"))


def order_totals_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rollups.reconciled(table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), table(spark, sf_dir, "orders"), "o_orderkey", "l_extendedprice", "o_totalprice")
    return out.select("o_orderkey", *[F.col(c).cast("double").alias(c) for c in ("declared", "extracted", "delta")], "withheld")


def order_block_remainder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return flags as blocks of an order: flag N lacks its declared amount and takes what is left."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    b = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.sum(price).alias("extracted"))
    b = b.withColumn("declared", F.when(F.col("l_returnflag") != "N", F.col("extracted")))
    b = b.join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").cast("decimal(18,2)").alias("total")), "l_orderkey")
    return rollups.block_remainder(b, "l_orderkey", "l_returnflag", "declared", "total", "extracted").select("l_orderkey", "l_returnflag", F.col("amount").cast("double").alias("amount"), "problem", "withheld")


def issue_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues by kind, body and file type, with the transposed share of the type."""
    d = F.col("decision_date")
    kind = F.when(blank(d), "blank_date").when(~d.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), "other_form")
    n = table(spark, sf_dir, "foi_disclosures").withColumn("issue", kind).filter("issue is not null").groupBy("issue", "public_body_id", "file_type").agg(F.count(F.lit(1)).alias("n_rows"))
    return n.withColumn("n_of_type", F.sum("n_rows").over(Window.partitionBy("file_type", "issue")))


def body_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies per category that reach each step: listed, with files, with requests; and the drop at it."""
    s = body_status_fan_in(spark, sf_dir)
    has = {"1_listed": F.lit(True), "2_files": F.col("files_status") == "success", "3_requests": (F.col("files_status") == "success") & (F.col("requests_status") == "success")}
    steps = s.select("public_body_category", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in has.items()]))).alias("step"))
    n = steps.groupBy("public_body_category", "step").agg(F.count(F.lit(1)).alias("n_bodies"))
    w = Window.partitionBy("public_body_category").orderBy("step")
    return n.withColumn("dropped", F.coalesce(F.lag("n_bodies").over(w) - F.col("n_bodies"), F.lit(0)))


def issue_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality_checks(spark, sf_dir).select("public_body_id", (F.col("n_failed") + F.col("decided_before_received")).alias("score"))
    return rollups.priority_tiers(q, "score", ["public_body_id"]).select("public_body_id", "score", "tier")


def candidate_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best supplier of each part: most orders, then least price, then key."""
    t = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.min("l_extendedprice").alias("least"))
    best = F.max(F.struct(F.col("n"), (-F.col("least")).alias("cheap"), (-F.col("l_suppkey")).alias("k"))).alias("b")
    return t.groupBy("l_partkey").agg(best).select("l_partkey", (-F.col("b.k")).alias("l_suppkey"), F.col("b.n").alias("n_lines"))


def column_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per file type the column with the most distinct values (ties: first by name)."""
    cols = ["decision_status", "requester_type", "review_status"]
    t = table(spark, sf_dir, "foi_disclosures").select("file_type", F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lower(F.trim(c)).alias("v")) for c in cols])))
    n = t.filter("v <> ''").groupBy("file_type", "column_name").agg(F.countDistinct("v").alias("n_distinct"))
    w = Window.partitionBy("file_type").orderBy(F.desc("n_distinct"), "column_name")
    return n.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that stand in at least a tenth of a source's documents, and in two or more; digits masked."""
    t = table(spark, sf_dir, "documents").filter("text is not null")
    lines = t.select("source", "doc_id", F.explode(F.split("text", r"\r?\n")).alias("l")).select("source", "doc_id", F.regexp_replace(F.trim("l"), "[0-9]+", "9").alias("line")).filter("line <> ''").distinct()
    n = lines.groupBy("source", "line").agg(F.count(F.lit(1)).alias("n_documents"))
    return n.join(t.groupBy("source").agg(F.count(F.lit(1)).alias("_all")), "source").filter("n_documents >= 2 and n_documents * 10 >= _all").drop("_all")


def weighted_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source the label that covers most characters (ties: first)."""
    n = table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.sum("n_chars").alias("chars"))
    w = Window.partitionBy("source").orderBy(F.desc("chars"), F.asc_nulls_last("lang"))
    return n.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def extension_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision, recall and F1 of the file name's extension as a guess of file_type."""
    t = table(spark, sf_dir, "foi_disclosures").select(F.col("file_type").alias("gold"), urls.extension(F.col("file_url")).alias("said")).groupBy("gold", "said").agg(F.count(F.lit(1)).alias("n"))
    k = t.select(F.inline(F.array(F.struct(F.col("gold").alias("label"), F.col("n").alias("n_gold"), F.lit(0).cast("long").alias("n_said"), F.when(F.col("gold") == F.col("said"), F.col("n")).otherwise(0).alias("n_both")), F.struct(F.col("said").alias("label"), F.lit(0).cast("long").alias("n_gold"), F.col("n").alias("n_said"), F.lit(0).cast("long").alias("n_both")))))
    s = k.filter("label is not null").groupBy("label").agg(*[F.sum(c).alias(c) for c in ("n_gold", "n_said", "n_both")])
    p, r = F.col("n_both") / F.nullif("n_said", F.lit(0)), F.col("n_both") / F.nullif("n_gold", F.lit(0))
    return s.withColumn("precision", p).withColumn("recall", r).withColumn("f1", 2 * F.col("n_both") / (F.col("n_said") + F.col("n_gold")))


def publication_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per broken rule of the star schema, with how often it is broken."""
    li, o, c = (table(spark, sf_dir, n) for n in ("lineitem", "orders", "customer"))
    rules = {
        "lineitem_without_order": li.join(o, li.l_orderkey == o.o_orderkey, "left_anti"),
        "order_without_customer": o.join(c, o.o_custkey == c.c_custkey, "left_anti"),
        "duplicate_order_key": o.groupBy("o_orderkey").count().filter("count > 1"),
        "duplicate_line": li.groupBy("l_orderkey", "l_linenumber").count().filter("count > 1"),
        "unknown_status": o.filter(~F.col("o_orderstatus").isin("F", "O", "P")),
        "discount_out_of_range": li.filter("l_discount < 0 or l_discount > 1"),
    }
    out = None
    for name, df in rules.items():
        part = df.agg(F.count(F.lit(1)).alias("n_broken")).select(F.lit(name).alias("rule"), "n_broken")
        out = part if out is None else out.unionByName(part)
    return out.filter("n_broken > 0")


def missing_order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps in the keys of customers who ordered something dear, as ranges: found from neighbours, never by listing all numbers."""
    t = table(spark, sf_dir, "orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("k")).distinct()
    return pages.number_gaps(t, "k")


def body_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per body: rows, span of loading, and a digest of its rows that order does not change."""
    t = table(spark, sf_dir, "foi_disclosures").filter("public_body_id is not null")
    return t.groupBy("public_body_id").agg(F.count(F.lit(1)).alias("n_rows"), F.date_format(F.min("loaded_at"), "yyyy-MM-dd").alias("first_day"), F.date_format(F.max("loaded_at"), "yyyy-MM-dd").alias("last_day"), hashes.set_fingerprint(F.concat_ws("|", F.col("id").cast("string"), F.col("file_url"))).alias("digest"))


def scoped_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders replaced by a new version of them; every third customer number with a finished order is the scope."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    new = o.withColumn("o_orderstatus", F.lower("o_orderstatus"))
    return incremental.merged_by_key(o, new, o.filter("o_orderstatus = 'F' and o_custkey % 3 = 0"), "o_custkey")


def scoped_merge_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As scoped_merge, with every customer with a finished order in the scope."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    new = o.withColumn("o_orderstatus", F.lower("o_orderstatus"))
    return incremental.merged_by_key(o, new, o.filter("o_orderstatus = 'F'"), "o_custkey")


def page_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose set of files changed from the first half-year of loading to all of it."""
    t = table(spark, sf_dir, "disclosure_files").filter("source_page_url is not null and document_url is not null")
    digest = lambda df: df.select("source_page_url", "document_url").distinct().groupBy("source_page_url").agg(hashes.set_fingerprint(F.col("document_url")).alias("digest"))
    changes = incremental.fingerprint_changes(digest(t.filter("loaded_at < timestamp_ntz'2024-07-01 00:00:00'")), digest(t), "source_page_url", "digest")
    return changes.groupBy("state").agg(F.count(F.lit(1)).alias("n_pages"))


def recheck_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    cur = current_rows(table(spark, sf_dir, "public_bodies"), "public_body_id", "loaded_at", [])
    return cur.filter(incremental.due(F.to_date("loaded_at"), F.lit("2025-06-30").cast("date"), 180)).select("public_body_id")


def fetch_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per site, files found within thirty days of the one before."""
    t = table(spark, sf_dir, "disclosure_files").select("id", urls.site_key(F.col("document_url")).alias("site"), F.unix_micros(F.col("loaded_at").cast("timestamp")).alias("at"))
    gap = F.col("at") - F.lag("at").over(Window.partitionBy("site").orderBy("at", "id"))
    return t.withColumn("gap", gap).filter("gap < 2592000000000").groupBy("site").agg(F.count(F.lit(1)).alias("n_close"))


def status_longest_contained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct statuses by the longest name of a label that stands in them."""
    vocab = bounded_rows(table(spark, sf_dir, "vocab_entries").filter("field_name = 'decision_status'").select("label", F.explode(F.array_append("also_known_as", F.col("label"))).alias("s")).select(F.regexp_replace(text.status_key(F.col("s")), r"[^\p{L}\p{N}]+", " ").alias("s"), "label"), 10_000, "closed list")
    t = table(spark, sf_dir, "foi_disclosures").filter("decision_status is not null").groupBy("decision_status").agg(F.count(F.lit(1)).alias("n_rows"))
    return matching.longest_contained(t, text.status_key(F.col("decision_status")), [(r[0], r[1]) for r in vocab])


def vocabulary_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per field and label that one of the label's names gives exactly, case aside."""
    v = table(spark, sf_dir, "vocab_entries").select("field_name", "label", F.explode(F.array_append("also_known_as", F.col("label"))).alias("s")).select("field_name", "label", text.bare_value(F.col("s")).alias("key")).distinct()
    t = table(spark, sf_dir, "foi_disclosures").select(F.inline(F.array(*[F.struct(F.lit(c).alias("field_name"), text.bare_value(F.col(c)).alias("key")) for c in ("requester_type", "decision_status")]))).filter("key <> ''").groupBy("field_name", "key").agg(F.count(F.lit(1)).alias("n"))
    return t.join(v, ["field_name", "key"]).groupBy("field_name", "label").agg(F.sum("n").alias("n_rows"))


QUERIES = {f.__name__: f for f in (dedup_by_reference, dedup_documents_by_text, dedup_lineitem_keys, ordinal_suffix_ids, request_sequence_ids, assigned_name_ids, forward_filled_types, event_clusters, event_day_islands, order_intervals, order_parents, event_owners, league_table_top5, register_name_match, fuzzy_name_match, parent_overrides, body_status_fan_in, body_coverage, hierarchy_audit, file_attribution, snapshot_edition_pairs, register_vs_snapshot, status_distribution, quality_checks, orders_year_rollup, split_index, order_totals_reconciled, order_block_remainder, issue_triage, body_funnel, issue_tiers, candidate_ranking, column_cardinality, repeated_lines, weighted_language, extension_evaluation, publication_invariants, missing_order_keys, body_manifest, scoped_merge, scoped_merge_all, page_changes, recheck_due, fetch_gaps, status_longest_contained, vocabulary_exact)}

_W = r"[\s\p{Z}]"
_STRIP = lambda c: f"regexp_replace({c}, '^{_W}+|{_W}+$', '', 'g')"
_SQUEEZE = lambda c: f"trim(regexp_replace({c}, '{_W}+', ' ', 'g'), ' ')"
_FOLD = lambda c: f"translate(lower({c}), '{text.ACCENTED}', '{text.PLAIN}')"
_KEY = lambda c: rf"trim(regexp_replace(regexp_replace(regexp_replace(replace(regexp_replace({_FOLD(c)}, '[(][^)]*[)]', ' ', 'g'), '&', ' and '), '[^a-z0-9]+', ' ', 'g'), '\bthe\b', ' ', 'g'), ' +', ' ', 'g'))"
_SLUG = lambda c: f"regexp_replace(regexp_replace(replace({_FOLD(c)}, '&', ' and '), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
_BLANK = lambda c: f"({c} is null or trim({c}, ' ') = '')"
_STATUS = lambda c: rf"regexp_replace(lower(regexp_replace({_STRIP(f"replace({c}, '-', ' ')")}, '[\s\p{{Z}}_]+', ' ', 'g')), '[\s\p{{Z}}.:/]+$', '')"
_BARE = lambda c: f"regexp_replace(replace(lower({_SQUEEZE(c)}), 'ß', 'ss'), '^[.,;: ]+|[.,;: ]+$', '', 'g')"


def _current(name: str, key: str, version: str, keep: list[str], rows: str) -> str:
    order = ", ".join(f"{c} desc nulls last" for c in [version, *keep])
    return f"{name} as (select * from {rows} where {key} is not null qualify row_number() over (partition by {key} order by {order}) = 1)"


_LAST = "(select * from public_body_snapshots where snapshot_no = (select max(snapshot_no) from public_body_snapshots))"
_FAN_IN = f"""with {_current('cur', 'public_body_id', 'loaded_at', ['public_body_category'], 'public_bodies')},
f as (select public_body_id, count(*) n, count(*) filter (date_added is not null) g from disclosure_files group by 1),
r as (select public_body_id, count(*) n, count(*) filter (not {_BLANK('request_description')}) g from foi_disclosures group by 1),
c as (select public_body_id, count(*) n, count(*) filter (contains(foi_email, '@')) g from public_body_snapshots group by 1),
fan as (select cur.public_body_id, public_body_category, coalesce(f.g, 0) n_files, case when f.g > 0 then 'success' when f.n > 0 then 'failed' else 'not_attempted' end files_status,
 coalesce(r.g, 0) n_requests, case when r.g > 0 then 'success' when r.n > 0 then 'failed' else 'not_attempted' end requests_status,
 coalesce(c.g, 0) n_contacts, case when c.g > 0 then 'success' when c.n > 0 then 'failed' else 'not_attempted' end contacts_status
 from cur left join f using (public_body_id) left join r using (public_body_id) left join c using (public_body_id))"""
_CHECKS = {"no_description": _BLANK("request_description"), "no_date": _BLANK("decision_date"), "long_status": "length(decision_status) > 40", "no_reference": _BLANK("foi_reference_id"), "short_description": "length(request_description) < 20", "decided_before_received": "decision_date < date_received", "no_requester": _BLANK("requester_type")}
_QUALITY = f"q as (select public_body_id, {', '.join(f'count(*) filter ({c}) {k}' for k, c in _CHECKS.items())}, {' + '.join(f'count(*) filter ({c})' for c in _CHECKS.values())} n_failed from foi_disclosures where public_body_id is not null group by 1 having n_failed >= 10)"
_EXT = r"lower(regexp_extract(coalesce(file_url, ''), '[.]([A-Za-z0-9]{1,5})(?:[?#].*)?$', 1))"
_SITE = r"regexp_replace(lower(regexp_extract(document_url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www[.]', '')"
_SUMS = "concat_ws('-', cast(sum(cast('0x' || substr(md5({0}), 1, 15) as hugeint)) as varchar), cast(sum(cast('0x' || substr(md5({0}), 16, 15) as hugeint)) as varchar))"

SQL = {
    "dedup_by_reference": f"""with t as (select id, public_body_id, case when coalesce(foi_reference_id, '') <> '' then {_STRIP('foi_reference_id')} end r, concat_ws(chr(31), {', '.join(f"trim(coalesce({c}, ''), ' ')" for c in ['file_url', *CLEAN[1:]])}) c from foi_disclosures)
select min(id) id, public_body_id from t group by public_body_id, r, case when r is null then c end""",
    "dedup_documents_by_text": "select min(doc_id) doc_id from documents group by text",
    "dedup_lineitem_keys": "select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1",
    "ordinal_suffix_ids": f"""with t as (select p_partkey, {_SLUG('p_brand')} || '/' || {_SLUG('p_name')} i from part), n as (select *, row_number() over (partition by i order by p_partkey) n from t)
select p_partkey, case when n = 1 then i else i || '-' || n end part_id from n""",
    "request_sequence_ids": f"""with t as (select min(id) id, public_body_id, strftime(loaded_at, '%Y-%m') "month", md5({_SQUEEZE('lower(request_description)')}) d from foi_disclosures where public_body_id is not null and request_description is not null group by 2, 3, 4),
n as (select *, row_number() over (partition by public_body_id, "month" order by id) n from t) select id, public_body_id, "month", 'r' || case when n < 1000 then lpad(cast(n as varchar), 3, '0') else cast(n as varchar) end request_no from n""",
    "assigned_name_ids": f"""with k as (select distinct {_KEY('public_body_name')} k from public_bodies), n as (select distinct {_KEY('name')} k from foi_disclosures where name is not null)
select k name_key, cast((select max(public_body_id) from public_bodies) + row_number() over (order by k) as bigint) body_id from n where k not in (select k from k where k is not null)""",
    "forward_filled_types": f"select id, last_value(case when not {_BLANK('requester_type')} and trim(requester_type, ' ') not in ('-', '--') then requester_type end ignore nulls) over (partition by file_url order by id rows between unbounded preceding and current row) filled_type from foi_disclosures where file_url is not null",
    "event_clusters": """with g as (select *, case when ts - lag(ts) over w <= interval 6 hour then 0 else 1 end f from events window w as (partition by user_id order by ts, event_id)), c as (select *, sum(f) over (partition by user_id order by ts, event_id rows unbounded preceding) c from g)
select user_id, cast(c as bigint) cluster_no, count(*) n_events, min(ts) first_ts, max(ts) last_ts from c group by 1, 2""",
    "event_day_islands": """with d as (select distinct user_id, date_diff('day', date '2024-01-01', cast(ts as date)) d from events), i as (select *, d - row_number() over (partition by user_id order by d) i from d)
select user_id, cast(min(d) as int) first_day, cast(max(d) as int) last_day, count(*) n_days from i group by user_id, i""",
    "order_intervals": "with t as (select o_custkey, o_orderkey, cast(left(o_orderpriority, 1) as int) l from orders) select a.o_orderkey, min(b.o_orderkey) interval_end from t a left join t b on b.o_custkey = a.o_custkey and b.o_orderkey > a.o_orderkey and b.l <= a.l group by 1",
    "order_parents": "with t as (select o_custkey, o_orderkey, cast(left(o_orderpriority, 1) as int) l from orders) select a.o_orderkey, max(b.o_orderkey) parent_orderkey from t a left join t b on b.o_custkey = a.o_custkey and b.o_orderkey < a.o_orderkey and b.l < a.l group by 1",
    "event_owners": "with p as (select user_id, ts, max(event_id) purchase_id from events where event_type = 'purchase' group by 1, 2) select e.event_id, p.purchase_id from events e asof left join p on e.user_id = p.user_id and e.ts >= p.ts",
    "league_table_top5": """with s as (select user_id, strftime(ts, '%Y-%m-%d') period, case event_type when 'purchase' then 1.0 when 'click' then 0.5 else 0.0 end p from events),
t as (select user_id, period, cast(sum(p) as double) points from s group by grouping sets ((user_id, period), (user_id)))
select *, cast(row_number() over (partition by period order by points desc, user_id) as int) "rank" from t qualify "rank" <= 5""",
    "register_name_match": f"""with k as (select {_KEY('public_body_name')} k, count(distinct public_body_id) n, min(public_body_id) i from public_bodies where public_body_name is not null group by 1 having k <> ''), q as (select name, count(*) n_rows, {_KEY('name')} k from foi_disclosures where name is not null group by name)
select name, n_rows, case when n = 1 then 'exact' when n > 1 then 'ambiguous' else 'unmatched' end match_status, case when n = 1 then i end matched_id, coalesce(n, 0) n_candidates from q left join k using (k)""",
    "parent_overrides": f"""with {_current('cur', 'public_body_id', 'loaded_at', ['parent_id'], 'public_bodies')}, {_current('o', 'public_body_id', 'exported_at', ['parent_id'], _LAST)}
select cur.public_body_id, case when o.public_body_id is not null then o.parent_id else cur.parent_id end wins, coalesce(cur.parent_id, o.parent_id) fills from cur left join o on o.public_body_id = cur.public_body_id""",
    "body_status_fan_in": f"{_FAN_IN} select * from fan",
    "body_coverage": " union all ".join(
        f"select '{n}' input, (select count(*) from b where k in (select k from {n})) n_covered, (select count(*) from b where k not in (select k from {n})) n_missing, (select count(*) from {n} where k not in (select k from b)) n_orphans"
        for n in ("files", "requests", "contacts")
    ).join(["with b as (select distinct public_body_id k from public_bodies where public_body_id is not null), files as (select distinct public_body_id k from disclosure_files where public_body_id is not null), requests as (select distinct public_body_id k from foi_disclosures where public_body_id is not null), contacts as (select distinct public_body_id k from public_body_snapshots where public_body_id is not null) ", ""]),
    "hierarchy_audit": f"""with {_current('cur', 'public_body_id', 'loaded_at', ['parent_id', 'parent_name', 'public_body_name'], 'public_bodies')},
j as (select c.public_body_id, c.parent_id, case when c.parent_id = c.public_body_id then 'self' when p.public_body_id is null then 'dangling' when {_KEY('c.parent_name')} <> {_KEY('p.public_body_name')} then 'name_mismatch' end issue from cur c left join cur p on p.public_body_id = c.parent_id where c.parent_id is not null)
select * from j where issue is not null""",
    "file_attribution": """with f as (select document_url file_url, count(distinct public_body_id) n, min(public_body_id) o from disclosure_files where document_url is not null group by 1)
select case when n is null then 'unlisted' when n > 1 then 'several' when o = public_body_id then 'agrees' else 'other_body' end state, count(*) n_rows, count(distinct d.file_url) n_files from foi_disclosures d left join f on f.file_url = d.file_url group by 1""",
    "snapshot_edition_pairs": "with t as (select distinct public_body_id, snapshot_no from public_body_snapshots where public_body_id is not null) select *, lag(snapshot_no) over (partition by public_body_id order by snapshot_no) previous_no from t qualify previous_no is not null",
    "register_vs_snapshot": f"""with {_current('a', 'public_body_id', 'loaded_at', ['public_body_name'], 'public_bodies')}, {_current('b', 'public_body_id', 'exported_at', ['public_body_name'], _LAST)}
select case when b.public_body_id is null then 'extra' when a.public_body_id is null then 'missing' when {_SQUEEZE('a.public_body_name')} is not distinct from {_SQUEEZE('b.public_body_name')} then 'equal' else 'different' end state, count(*) n_bodies from a full join b on a.public_body_id = b.public_body_id group by 1""",
    "status_distribution": "select decision_status, review_status, count(*) n_rows from foi_disclosures group by 1, 2",
    "quality_checks": f"with {_QUALITY} select * from q",
    "orders_year_rollup": "select cast(year(o_orderdate) as int) \"year\", count(*) n_orders, cast(sum(cast(o_totalprice as decimal(18,2))) as double) total, count(distinct o_custkey) n_customers, cast(sum(case when o_orderstatus = 'F' then cast(o_totalprice as decimal(18,2)) else 0 end) as double) total_finished from orders group by 1",
    "split_index": "select c_mktsegment segment, cast(year(o_orderdate) as int) \"year\", count(*) n_orders, cast(sum(cast(o_totalprice as decimal(18,2))) as double) total, min(year(o_orderdate)) || '-' || max(year(o_orderdate)) \"years\" from orders join customer on c_custkey = o_custkey group by grouping sets ((c_mktsegment), (cast(year(o_orderdate) as int)))",
    "order_totals_reconciled": """with s as (select l_orderkey, sum(cast(l_extendedprice as decimal(18,2))) e from lineitem group by 1)
select o_orderkey, cast(cast(o_totalprice as decimal(18,2)) as double) declared, cast(e as double) extracted, cast(e - cast(o_totalprice as decimal(18,2)) as double) delta, coalesce(abs(e - cast(o_totalprice as decimal(18,2))) > 0.005, true) withheld from orders left join s on l_orderkey = o_orderkey""",
    "order_block_remainder": """with b as (select l_orderkey, l_returnflag, sum(cast(l_extendedprice as decimal(18,2))) e from lineitem group by 1, 2), d as (select b.*, case when l_returnflag <> 'N' then e end d, cast(o_totalprice as decimal(18,2)) t from b join orders on o_orderkey = l_orderkey),
s as (select l_orderkey, sum(coalesce(d, 0)) s, count(*) - count(d) k from d group by 1),
r as (select d.l_orderkey, l_returnflag, e, coalesce(d, case when k = 1 then t - s end) a, case when t is null then 'no_total' when k > 1 then 'several_undeclared' when t - s < 0 then 'over_declared' end p from d join s on s.l_orderkey = d.l_orderkey)
select l_orderkey, l_returnflag, cast(a as double) amount, p problem, p is not null or not coalesce(a = e, false) withheld from r""",
    "issue_triage": f"""with t as (select case when {_BLANK('decision_date')} then 'blank_date' when not regexp_full_match(decision_date, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') then 'other_form' end issue, public_body_id, file_type from foi_disclosures)
select issue, public_body_id, file_type, count(*) n_rows, cast(sum(count(*)) over (partition by file_type, issue) as bigint) n_of_type from t where issue is not null group by 1, 2, 3""",
    "body_funnel": f"""{_FAN_IN}, s as (select public_body_category, '1_listed' step from fan union all select public_body_category, '2_files' from fan where files_status = 'success' union all select public_body_category, '3_requests' from fan where files_status = 'success' and requests_status = 'success'),
n as (select public_body_category, step, count(*) n_bodies from s group by 1, 2) select *, coalesce(lag(n_bodies) over (partition by public_body_category order by step) - n_bodies, 0) dropped from n""",
    "issue_tiers": f"""with {_QUALITY}, s as (select public_body_id, n_failed + decided_before_received score from q), r as (select *, row_number() over (order by score desc, public_body_id) r, count(*) over () n from s)
select public_body_id, score, case when r <= n // 3 then 'high' when r <= 2 * (n // 3) then 'medium' else 'low' end tier from r""",
    "candidate_ranking": "with t as (select l_partkey, l_suppkey, count(*) n, min(l_extendedprice) p from lineitem group by 1, 2) select l_partkey, l_suppkey, n n_lines from t qualify row_number() over (partition by l_partkey order by n desc, p, l_suppkey) = 1",
    "column_cardinality": """with t as (select file_type, 'decision_status' column_name, lower(trim(decision_status, ' ')) v from foi_disclosures union all select file_type, 'requester_type', lower(trim(requester_type, ' ')) from foi_disclosures union all select file_type, 'review_status', lower(trim(review_status, ' ')) from foi_disclosures),
n as (select file_type, column_name, count(distinct v) n_distinct from t where v <> '' group by 1, 2) select * from n qualify row_number() over (partition by file_type order by n_distinct desc, column_name) = 1""",
    "repeated_lines": r"""with l as (select source, doc_id, unnest(regexp_split_to_array(text, '\r?\n')) l from documents where text is not null), d as (select distinct source, doc_id, regexp_replace(trim(l, ' '), '[0-9]+', '9', 'g') line from l), a as (select source, count(*) n from documents where text is not null group by 1)
select source, line, count(*) n_documents from d join a using (source) where line <> '' group by source, line, n having count(*) >= 2 and count(*) * 10 >= n""",
    "weighted_language": "with n as (select source, lang, cast(sum(n_chars) as bigint) chars from documents group by 1, 2) select * from n qualify row_number() over (partition by source order by chars desc, lang asc nulls last) = 1",
    "extension_evaluation": f"""with t as (select file_type g, {_EXT} s from foi_disclosures), k as (select g label, 1 a, 0 b, case when g = s then 1 else 0 end c from t union all select s, 0, 1, 0 from t),
n as (select label, sum(a) n_gold, sum(b) n_said, sum(c) n_both from k where label is not null group by 1)
select label, cast(n_gold as bigint) n_gold, cast(n_said as bigint) n_said, cast(n_both as bigint) n_both, n_both / nullif(n_said, 0) "precision", n_both / nullif(n_gold, 0) recall, 2 * n_both / (n_said + n_gold) f1 from n""",
    "publication_invariants": """with r as (select 'lineitem_without_order' "rule", count(*) n_broken from lineitem where l_orderkey not in (select o_orderkey from orders)
union all select 'order_without_customer', count(*) from orders where o_custkey not in (select c_custkey from customer)
union all select 'duplicate_order_key', count(*) from (select 1 from orders group by o_orderkey having count(*) > 1)
union all select 'duplicate_line', count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
union all select 'unknown_status', count(*) from orders where o_orderstatus not in ('F', 'O', 'P')
union all select 'discount_out_of_range', count(*) from lineitem where l_discount < 0 or l_discount > 1) select * from r where n_broken > 0""",
    "missing_order_keys": "with k as (select distinct o_custkey k from orders where o_totalprice > 300000), n as (select k, lead(k) over (order by k) n from k) select k + 1 first_missing, n - 1 last_missing from n where n > k + 1",
    "body_manifest": f"select public_body_id, count(*) n_rows, strftime(min(loaded_at), '%Y-%m-%d') first_day, strftime(max(loaded_at), '%Y-%m-%d') last_day, {_SUMS.format("concat_ws('|', cast(id as varchar), file_url)")} digest from foi_disclosures where public_body_id is not null group by 1",
    "scoped_merge": "with s as (select distinct o_custkey from orders where o_orderstatus = 'F' and o_custkey % 3 = 0) select o_custkey, o_orderkey, case when o_custkey in (select o_custkey from s) then lower(o_orderstatus) else o_orderstatus end o_orderstatus from orders",
    "scoped_merge_all": "with s as (select distinct o_custkey from orders where o_orderstatus = 'F') select o_custkey, o_orderkey, case when o_custkey in (select o_custkey from s) then lower(o_orderstatus) else o_orderstatus end o_orderstatus from orders",
    "page_changes": f"""with t as (select distinct source_page_url p, document_url d, loaded_at < timestamp '2024-07-01 00:00:00' old from disclosure_files where source_page_url is not null and document_url is not null),
b as (select p, {_SUMS.format('d')} x from (select distinct p, d from t where old) group by 1), n as (select p, {_SUMS.format('d')} x from (select distinct p, d from t) group by 1)
select case when b.p is null then 'new' when n.p is null then 'gone' when b.x = n.x then 'unchanged' else 'changed' end state, count(*) n_pages from b full join n on b.p = n.p group by 1""",
    "recheck_due": f"with {_current('cur', 'public_body_id', 'loaded_at', [], 'public_bodies')} select public_body_id from cur where coalesce(date_diff('day', cast(loaded_at as date), date '2025-06-30') > 180, true)",
    "fetch_gaps": f"""with h as (select id, string_split({_SITE}, '.') l, loaded_at from disclosure_files), t as (select id, case when len(l) < 2 then '' when len(l) >= 3 and length(l[-1]) = 2 and l[-2] in ('co', 'ac', 'org', 'net', 'com') then array_to_string(l[-3:], '.') else array_to_string(l[-2:], '.') end site, loaded_at from h),
g as (select site, loaded_at - lag(loaded_at) over (partition by site order by loaded_at, id) g from t) select site, count(*) n_close from g where g < interval 30 day group by 1""",
    "status_longest_contained": rf"""with v as (select distinct regexp_replace({_STATUS('s')}, '[^\p{{L}}\p{{N}}]+', ' ', 'g') s, label from (select label, unnest(list_append(also_known_as, label)) s from vocab_entries where field_name = 'decision_status')),
t as (select decision_status, count(*) n_rows, ' ' || regexp_replace({_STATUS('decision_status')}, '[^\p{{L}}\p{{N}}]+', ' ', 'g') || ' ' p from foi_disclosures where decision_status is not null group by decision_status)
select decision_status, n_rows, label canonical from t left join v on contains(p, ' ' || s || ' ') qualify row_number() over (partition by decision_status order by length(s) desc, label, s) = 1""",
    "vocabulary_exact": f"""with v as (select distinct field_name, label, {_BARE('s')} k from (select field_name, label, unnest(list_append(also_known_as, label)) s from vocab_entries)),
t as (select 'requester_type' field_name, {_BARE('requester_type')} k from foi_disclosures union all select 'decision_status', {_BARE('decision_status')} from foi_disclosures)
select field_name, label, count(*) n_rows from t join v using (field_name, k) where k <> '' group by 1, 2""",
}
