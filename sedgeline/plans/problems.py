"""Queries p2, p5, p6 and p7 over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedgeline.operators.hierarchy import tree_descendants, tree_paths
from sedgeline.operators.profile import column_profile, load_findings, mask_drift, rare_masks, value_counts
from sedgeline.operators.references import current_rows, fault_counts, faulty_references, reference_rows
from sedgeline.operators.snapshots import plain_url, plain_value, snapshot_changes
from sedgeline.runtime import stored, table

#: The columns that p2_found looks at, with their kinds; the other p2 queries take all columns of the table.
PROFILED = {"decision_date": "date", "requester_type": "code", "request_description": "text"}
COLUMNS = {c: "code" for c in ("id", "public_body_id", "name", "file_url", "file_type", "foi_reference_id", "decision_status", "review_status", "related_request", "feed_id", "load_no", "loaded_at")} | {"date_received": "date"} | PROFILED


def _counts(spark: SparkSession, sf_dir: str, columns: dict[str, str], texts: str) -> DataFrame:
    return value_counts(table(spark, sf_dir, "foi_disclosures"), ["feed_id", "load_no"], columns, "loaded_at", texts)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_findings(column_profile(_counts(spark, sf_dir, PROFILED, "length"), ["feed_id", "load_no"]), "feed_id", "load_no")


def p2_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_profile(_counts(spark, sf_dir, COLUMNS, "value"), ["feed_id", "load_no"])


def p2_mask_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    masks = _counts(spark, sf_dir, COLUMNS, "form").groupBy("feed_id", "load_no", "column_name", "is_blank", "mask").agg(F.sum("n").alias("n"))
    return mask_drift(stored(masks), "feed_id", "load_no")  # stored: the plan reads them three times


def p2_rare_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rare masks that p2_mask_drift counts, each with an example."""
    return rare_masks(_counts(spark, sf_dir, COLUMNS, "form"), "feed_id", "load_no")


def _current_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = table(spark, sf_dir, "public_bodies")
    return current_rows(bodies, "public_body_id", "loaded_at", ["parent_id", "first_listed_at", "removed_at"])


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_paths(_current_parents(spark, sf_dir), "public_body_id", "parent_id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paths(spark, sf_dir).select("public_body_id", F.col("root").alias("root_body_id"), "depth", F.col("path").alias("body_path"))


def p5_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_descendants(_paths(spark, sf_dir), "public_body_id")


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = {"website_url": plain_url(F.col("website_url")), "foi_email": plain_value(F.col("foi_email"))}
    return snapshot_changes(table(spark, sf_dir, "public_body_snapshots"), "snapshot_no", "public_body_id", "exported_at", compared)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(spark, sf_dir).select("snapshot_no", "public_body_id", "change_kind")


def p6_changed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(spark, sf_dir).filter("change_kind not in ('added', 'removed')")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = _current_parents(spark, sf_dir)
    return faulty_references(
        [
            reference_rows(table(spark, sf_dir, "foi_disclosures"), "foi_disclosures", "id", "public_body_id", "loaded_at"),
            reference_rows(table(spark, sf_dir, "disclosure_files"), "disclosure_files", "id", "public_body_id", "loaded_at"),
            reference_rows(bodies, "public_bodies", "public_body_id", "parent_id", "loaded_at"),
        ],
        bodies, "public_body_id", "first_listed_at", "removed_at",
    )


def p7_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fault_counts(p7_found(spark, sf_dir))


QUERIES = {f.__name__: f for f in (p2_found, p2_profile, p2_mask_drift, p2_rare_masks, p5_found, p5_descendants, p6_found, p6_changed_values, p7_found, p7_counts)}

_CURRENT = "cur as (select public_body_id, loaded_at, parent_id, first_listed_at, removed_at from public_bodies where public_body_id is not null qualify row_number() over (partition by public_body_id order by loaded_at desc nulls last, parent_id desc nulls last, first_listed_at desc nulls last, removed_at desc nulls last) = 1)"
_TREE = """, edge as (select c.public_body_id v, p.public_body_id p from cur c left join cur p on p.public_body_id = c.parent_id),
tree as (select v, v root, 0 depth, cast(v as varchar) path from edge where p is null
 union all select e.v, t.root, t.depth + 1, t.path || '/' || e.v from edge e join tree t on e.p = t.v),
stuck as (select e.v, e.p from edge e left join tree t on t.v = e.v where t.v is null),
up as (select v, p anc, 1 d from stuck union all select u.v, s.p, u.d + 1 from up u join stuck s on s.v = u.anc where u.d < (select count(*) from stuck) + 1 and u.anc <> u.v),
ring as (select distinct v from up where anc = v),
least as (select v, min(anc) least from up where v in (select v from ring) and anc in (select v from ring) group by v),
entry as (select s.v, case when s.v in (select v from ring) then s.v else (select u.anc from up u where u.v = s.v and u.anc in (select v from ring) order by u.d limit 1) end r from stuck s)"""
_LOST = f"with recursive {_CURRENT}{_TREE}"
_FAULTS = f"""with {_CURRENT}, refs as (
 select 'foi_disclosures' source_table, id row_key, public_body_id fk, loaded_at from foi_disclosures
 union all select 'disclosure_files', id, public_body_id, loaded_at from disclosure_files
 union all select 'public_bodies', public_body_id, parent_id, loaded_at from cur),
found as (select distinct source_table, row_key, strftime(r.loaded_at, '%Y-%m') period,
 case when c.public_body_id is null then 'missing' when c.removed_at <= r.loaded_at then 'deleted' when c.first_listed_at > r.loaded_at then 'late' end reason
 from refs r left join cur c on c.public_body_id = r.fk where r.fk is not null)"""
_NORM = r"lower(regexp_replace(coalesce({}, ''), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g'))"
_CHANGES = f"""with s as (select snapshot_no, public_body_id, regexp_replace({_NORM.format('website_url')}, '/$', '') w, {_NORM.format('foi_email')} e
 from public_body_snapshots where public_body_id is not null and snapshot_no is not null
 qualify row_number() over (partition by snapshot_no, public_body_id order by exported_at desc nulls last, w desc, e desc) = 1),
nos as (select distinct snapshot_no from s),
a as (select n.* from s n join nos b on b.snapshot_no = n.snapshot_no - 1),
b as (select o.snapshot_no + 1 snapshot_no, o.public_body_id, o.w, o.e from s o join nos n on n.snapshot_no = o.snapshot_no + 1),
j as (select coalesce(a.snapshot_no, b.snapshot_no) snapshot_no, coalesce(a.public_body_id, b.public_body_id) public_body_id, a.public_body_id is null gone, b.public_body_id is null fresh, a.w aw, a.e ae, b.w bw, b.e be from a full join b on a.snapshot_no = b.snapshot_no and a.public_body_id = b.public_body_id)"""

_MASK = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(v, '\p{Nd}', '9', 'g'), '[\p{Ll}\p{Lm}\p{Lo}]+', 'a', 'g'), '[\p{Lu}\p{Lt}]+', 'A', 'g'), '\s+', ' ', 'g')"
_FORM_MASK = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(v, '\p{Nd}+', '9', 'g'), '[\p{Ll}\p{Lm}\p{Lo}]+', 'a', 'g'), '[\p{Lu}\p{Lt}]+', 'A', 'g'), '\s*[\r\n]\s*', '¶', 'g'), '\s+', ' ', 'g')"
for _form in ("a", "A", "9", "Aa"):
    _FORM_MASK = rf"regexp_replace({_FORM_MASK}, '\b{_form}( {_form})+\b', '{_form}', 'g')"
_CELLS = f"""with cells as ({' union all '.join(f"select feed_id, load_no, loaded_at, '{c}' column_name, '{kind}' kind, cast({c} as varchar) v from foi_disclosures" for c, kind in COLUMNS.items())}),
c as (select *, v is null or trim(v, ' ') = '' blank, case when kind = 'text' then {_FORM_MASK} else {_MASK} end mask,
 case when regexp_full_match(v, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') then try_cast(v as date) end d from cells)"""

SQL = {
    "p2_profile": f"""{_CELLS}, t as (select feed_id, load_no, column_name, v, count(*) n from c where not blank group by all), m as (select feed_id, load_no, column_name, max(n) top from t group by all),
pat as (select column_name, arg_max(mask, (n, mask)) pattern from (select column_name, mask, count(*) n from c where not blank group by all) group by all)
select c.feed_id, c.load_no, c.column_name, c.kind, count(*) n_rows, count(*) filter (blank) n_blank, count(*) filter (not blank) n_values, count(distinct v) filter (not blank) n_distinct, min(v) filter (not blank) least_value, max(v) filter (not blank) greatest_value,
 count(*) filter (not blank and d is not null) n_real_dates, count(*) filter (not blank and contains(mask, '9')) n_with_digit,
 count(*) filter (not blank and (c.kind = 'date' and (d is null or mask <> pattern) or c.kind = 'code' and not contains(pattern, '9') and regexp_matches(v, '[0-9]'))) n_off_pattern,
 count(*) filter (c.kind = 'date' and (d < date '1998-01-01' or d > cast(loaded_at as date))) n_outside, coalesce(any_value(top), 0) n_top,
 cast(coalesce(sum(length(v)) filter (not blank), 0) as bigint) sum_len, min(length(v)) filter (not blank) least_len, max(length(v)) filter (not blank) most_len
from c left join pat on pat.column_name = c.column_name left join m on m.feed_id = c.feed_id and m.load_no = c.load_no and m.column_name = c.column_name group by 1, 2, 3, 4""",
    "p2_mask_drift": f"""{_CELLS}, n as (select feed_id f, load_no l, column_name k, mask, count(*) n from c where not blank and feed_id is not null and load_no is not null group by all),
s as (select *, n / sum(n) over (partition by f, l, k) p, sum(n) over (partition by f, l, k) total from n),
j as (select coalesce(a.f, b.f) f, coalesce(a.l, b.l + 1) l, coalesce(a.k, b.k) k, coalesce(a.p, 0) p, coalesce(b.p, 0) q from s a full join s b on b.f = a.f and b.l = a.l - 1 and b.k = a.k and b.mask = a.mask),
e as (select f, l, k, sum((case when p > 0 then p * log2(p / ((p + q) / 2)) else 0 end + case when q > 0 then q * log2(q / ((p + q) / 2)) else 0 end) / 2) js from j group by all)
select s.f feed_id, s.l load_no, s.k column_name, arg_max(mask, (n, mask)) dominant_mask, max(p) dominant_share, count(*) n_masks, cast(coalesce(sum(n) filter (p < 0.01), 0) as bigint) n_rare_mask,
 case when exists (select 1 from s b where b.f = s.f and b.l = s.l - 1 and b.k = s.k) then any_value(js) else 0.0 end divergence from s join e on e.f = s.f and e.l = s.l and e.k = s.k group by s.f, s.l, s.k""",
    "p2_found": r"""with cells as (
 select feed_id, load_no, loaded_at, 'decision_date' column_name, 'date' kind, decision_date v from foi_disclosures
 union all select feed_id, load_no, loaded_at, 'requester_type', 'code', requester_type from foi_disclosures
 union all select feed_id, load_no, loaded_at, 'request_description', 'text', request_description from foi_disclosures),
c as (select *, v is null or trim(v, ' ') = '' blank, case when regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}') then try_cast(v as date) end d from cells where feed_id is not null and load_no is not null),
vals as (select feed_id, load_no, column_name, v, count(*) n from c where not blank group by all),
tops as (select feed_id, load_no, column_name, max(n) top from vals group by all),
g as (select feed_id, load_no, column_name, kind, count(*) n_rows, count(*) filter (blank) n_blank, count(*) filter (not blank) n, count(d) filter (not blank) n_date,
 count(*) filter (not blank and (d < date '1998-01-01' or d > cast(loaded_at as date))) n_out, count(*) filter (not blank and regexp_matches(v, '[0-9]')) n_digit, sum(length(v)) filter (not blank) len from c group by all),
p as (select g.*, coalesce(top, 0) top from g left join tops using (feed_id, load_no, column_name)),
j as (select p.*, b.n_rows bn_rows, b.n_blank bn_blank, b.n bn, b.top btop, b.len blen from p left join p b on b.feed_id = p.feed_id and b.column_name = p.column_name and b.load_no = p.load_no - 1)
select feed_id, load_no, column_name, 'blank_shift' finding from j where abs(n_blank / n_rows - bn_blank / bn_rows) >= 0.2 - 1e-9
union all select feed_id, load_no, column_name, 'pattern_break' from j where n > 0 and (kind = 'date' and 1 - n_date / n >= 0.3 - 1e-9 or kind = 'code' and n_digit / n >= 0.15 - 1e-9)
union all select feed_id, load_no, column_name, 'range_break' from j where kind = 'date' and n_date > 0 and n_out / n_date >= 0.05 - 1e-9
union all select feed_id, load_no, column_name, 'top_share_shift' from j where kind <> 'text' and n > 0 and bn > 0 and abs(top / n - btop / bn) >= 0.25 - 1e-9
union all select feed_id, load_no, column_name, 'length_shift' from j where kind = 'text' and n > 0 and bn > 0 and ((len / n) / (blen / bn) >= 1.5 - 1e-9 or (len / n) / (blen / bn) <= 2 / 3 + 1e-9)""",
    "p5_found": f"""{_LOST} select v public_body_id, root root_body_id, depth, path body_path from tree
union all select e.v, l.least, -1, 'cycle' from entry e join least l on l.v = e.r""",
    "p5_descendants": f"""{_LOST}, anc as (select v descendant, p ancestor, 1 distance from edge where p is not null and v in (select v from tree)
 union all select a.descendant, e.p, a.distance + 1 from anc a join edge e on e.v = a.ancestor where e.p is not null)
select cast(ancestor as bigint) ancestor, cast(descendant as bigint) descendant, distance from anc""",
    "p6_found": f"""{_CHANGES} select snapshot_no, public_body_id, 'added' change_kind from j where fresh
union all select snapshot_no, public_body_id, 'removed' from j where gone
union all select snapshot_no, public_body_id, 'website_url' from j where aw <> bw
union all select snapshot_no, public_body_id, 'foi_email' from j where ae <> be""",
    "p6_changed_values": f"""{_CHANGES} select snapshot_no, public_body_id, 'website_url' change_kind, bw old_value, aw new_value from j where aw <> bw
union all select snapshot_no, public_body_id, 'foi_email', be, ae from j where ae <> be""",
    "p7_found": f"{_FAULTS} select source_table, row_key, period, reason from found where reason is not null and row_key is not null",
    "p7_counts": f"{_FAULTS} select source_table, period, reason, count(*) n_references from found where reason is not null and row_key is not null group by all",
}
SQL["p2_rare_masks"] = f"""{_CELLS}, n as (select feed_id, load_no, column_name, mask, count(*) n, coalesce(min(v) filter (kind <> 'text'), any_value(mask)) example from c where not blank and feed_id is not null and load_no is not null group by all)
select feed_id, load_no, column_name, mask, n, n / sum(n) over (partition by feed_id, load_no, column_name) share, example from n qualify share < 0.01"""
