"""Queries of the training-data problems, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm import capping, charsets, encoding, leakage, neardup, pairs, replies, terms, truncation
from siltworks.session import spread, table


def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(spread(table(spark, sf_dir, "smoke_test")))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.group_pairs(p1_groups(spark, sf_dir))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_tags(spark, sf_dir).where("mark is not null").select("field", "tag", "mark")


def p2_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.tag_frequency(table(spark, sf_dir, "smoke_test_value"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.surprising(table(spark, sf_dir, "smoke_test_value")).select("item_a", "item_b")


def p3_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.co_occurrence(table(spark, sf_dir, "smoke_test_value"))


def p3_surprising(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.significant(table(spark, sf_dir, "smoke_test_value")).select("item_a", "item_b", "n_ab", "expected", "lift", "p_value", "q_value")


def p3_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_pairs(spark, sf_dir).select("item_a", "item_b", "n", "n_a", "n_b", "n_ab")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replies.defects(spread(table(spark, sf_dir, "smoke_test")))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.cut_turns(spread(table(spark, sf_dir, "smoke_test")))


def p5_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.truncation_by_source(spread(table(spark, sf_dir, "smoke_test")))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capping.capped(table(spark, sf_dir, "conversation_duplicate_source_id")).where("not stays").select("row_id")


def p6_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversation_duplicate_source_id")
    return rows.join(capping.capped(rows).where("not stays").select("row_id"), "row_id", "left_anti").select("row_id")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.encode_corpus(spread(table(spark, sf_dir, "documents")))


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaks(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "eval_items"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_leaks(spark, sf_dir).select("doc_id", "item_id")


def p9_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charsets.wrong_encoding(spread(table(spark, sf_dir, "documents")))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_restored(spark, sf_dir).select("doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_groups, p2_found, p2_tags, p3_found, p3_pairs, p3_surprising, p3_counts, p4_found, p5_found, p5_sources, p6_found, p6_kept, p7_ids, p8_found, p8_leaks, p9_found, p9_restored)
}

_LATEST = """one as (select row_id, labels from (select *, row_number() over (partition by coalesce('i' || id, 'r' || row_id)
    order by ingested_at desc nulls last, row_id desc) as rn from smoke_test_value) where rn = 1)"""


def _tags(fields: tuple[str, ...]) -> str:
    norm = r"regexp_replace(lower(regexp_replace(u.t, '^[ \t]+|[ \t]+$', '', 'g')), '[\s\p{Z}_]+', '-', 'g')"
    return " union all ".join(f"select row_id, '{f}' as field, {norm} as tag from one, unnest(one.labels.\"{f}\") as u(t)" for f in fields)


_P2 = f"""with {_LATEST}, t as ({_tags(terms.FIELDS)}),
    g as (select field, tag, count(*) as occurrences, count(distinct row_id) as records from t where tag <> '' group by all)
    select field, tag, occurrences, records, case when records <= 2 then 'rare' when records * 100 > 12 * (select count(*) from one) then 'common' end as mark from g"""
_P3 = f"""with {_LATEST}, t as (select distinct row_id, field || ':' || tag as item from ({_tags(pairs.FIELDS)}) where tag <> ''),
    k as (select item, count(*) as m from t group by all), n as (select count(*) as n from one),
    p as (select a.item as item_a, b.item as item_b, count(*) as n_ab from t a join t b on a.row_id = b.row_id and a.item < b.item group by all)
    select item_a, item_b, n.n as n, ka.m as n_a, kb.m as n_b, n_ab from p join k ka on ka.item = item_a join k kb on kb.item = item_b, n"""
_P6 = r"""with r as (select row_id, regexp_replace(regexp_replace(lower(trim(metadata.source_file, e' \t\n\r')), '[\\/]+', '/', 'g'), '^\./', '') as c,
      case when value.value_score is null or isnan(value.value_score) then null else value.value_score end as s from conversation_duplicate_source_id),
    k as (select *, row_number() over (partition by c order by s desc nulls last, row_id) as rn from r)
    select row_id from k where {} """
ORACLE_SQL = {
    "p2_found": f"select field, tag, mark from ({_P2}) where mark is not null",
    "p2_tags": _P2,
    "p3_found": f"select item_a, item_b from ({_P3}) where n_ab >= 5 and n_ab * 1000 >= n and n_ab * n >= 3 * n_a * n_b",
    "p3_counts": _P3,
    "p6_found": _P6.format("c is not null and rn > (select count(*) * 2 // 100 from r)"),
    "p6_kept": _P6.format("c is null or rn <= (select count(*) * 2 // 100 from r)"),
}
