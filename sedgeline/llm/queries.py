"""Queries over the given tables for the operators of this package, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedgeline.llm.canonical import UNMATCHED, mapped_values
from sedgeline.llm.languages import document_languages, mislabelled_paragraphs, segment_languages
from sedgeline.llm.leaks import leaked_items
from sedgeline.llm.near_duplicates import NearDuplicates, near_duplicate_classes, near_duplicate_pairs
from sedgeline.llm.packing import Packing, pack_fill, packed_texts
from sedgeline.llm.scans import repaired_texts
from sedgeline.runtime import table

REQUESTS = NearDuplicates(shingle=3, threshold=0.5, least_words=20)


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "foi_disclosures").filter("request_description is not null and id is not null")
    return t.select("id", F.concat_ws(" ", F.coalesce("foi_reference_id", F.lit("")), "request_description").alias("text"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_pairs(_requests(spark, sf_dir), REQUESTS)


def p4_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(_requests(spark, sf_dir), REQUESTS)


def p8_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_texts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pack_sizes"))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_fill(p8_packs(spark, sf_dir))


#: Instruction data: at most four fifths of a pack may bear loss.
INSTRUCTIONS = Packing(loss_share=0.8)


def p8_loss_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As p8_packs, under a limit of loss-bearing tokens that binds; texts that exceed it alone are cut by it."""
    return packed_texts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pack_sizes"), INSTRUCTIONS)


def p8_loss_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_fill(p8_loss_packs(spark, sf_dir), INSTRUCTIONS.loss_share)


def p9_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of which a document holds ten words in a row, or half of the words in runs of five or more, in whatever order."""
    return leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_leaks(spark, sf_dir).filter("longest >= 10").select("doc_id", "item_id")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mislabelled_paragraphs(table(spark, sf_dir, "documents")).select("doc_id", "para_no", "language")


def p10_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_languages(table(spark, sf_dir, "documents"))


def p10_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_languages(table(spark, sf_dir, "documents")).filter("language is not null")


def p1_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired_texts(table(spark, sf_dir, "foi_disclosures"), "id", "name", "request_description")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_repaired(spark, sf_dir).select("id", F.explode("kinds").alias("noise_kind")).distinct()


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapped_values(table(spark, sf_dir, "foi_disclosures"), "id", ["requester_type", "decision_status"], table(spark, sf_dir, "vocab_entries"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapped(spark, sf_dir).select("id", "field_name", "label")


def p3_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What could not be mapped, with how often it occurs."""
    return _mapped(spark, sf_dir).filter(F.col("label") == UNMATCHED).groupBy("field_name", "value").agg(F.count(F.lit(1)).alias("n_rows"))


QUERIES = {f.__name__: f for f in (p1_found, p1_repaired, p3_found, p3_unmatched, p4_found, p4_classes, p8_packs, p8_fill, p8_loss_packs, p8_loss_fill, p9_found, p9_leaks, p10_found, p10_documents, p10_segments)}

_NEAR = r"""with t as (select id, regexp_extract_all(lower(coalesce(foi_reference_id, '') || ' ' || request_description), '[\p{L}\p{N}]+') w from foi_disclosures where request_description is not null and id is not null),
c as (select array_to_string(w, ' ') name, any_value(w) w, min(id) class_id, count(distinct id) n_copies from t where len(w) >= 20 group by 1),
s as (select distinct class_id, hash(w[k], w[k + 1], w[k + 2]) h from (select class_id, w, unnest(range(1, len(w) - 1)) k from c)),
m as (select class_id, count(*) m from s group by 1),
near as (select a, b from (select a.class_id a, b.class_id b, count(*) n from s a join s b on a.h = b.h and a.class_id < b.class_id group by all) join m x on x.class_id = a join m y on y.class_id = b where n >= 0.5 * (x.m + y.m - n)),
member as (select distinct t.id, c.class_id, c.n_copies from t join c on array_to_string(t.w, ' ') = c.name)"""

SQL = {
    "p4_found": f"""{_NEAR} select least(x.id, y.id) id_a, greatest(x.id, y.id) id_b from near join member x on x.class_id = a join member y on y.class_id = b
union select x.id, y.id from member x join member y on x.class_id = y.class_id and x.id < y.id""",
    "p4_classes": f"""{_NEAR}, l as (select class_id, count(*) n from (select a class_id from near union all select b from near) group by 1)
select id, member.class_id, n_copies, coalesce(l.n, 0) n_links from member left join l on l.class_id = member.class_id""",
    "p9_found": r"""with d as (select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') w from documents where text is not null), i as (select item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') w from eval_items),
dg as (select doc_id, w, unnest(range(1, len(w) - 8)) k from d), ig as (select item_id, w, unnest(range(1, len(w) - 8)) k from i)
select distinct doc_id, item_id from (select doc_id, array_to_string(w[k:k + 9], ' ') g from dg) a join (select item_id, array_to_string(w[k:k + 9], ' ') g from ig) b using (g)""",
}
