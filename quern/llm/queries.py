"""Queries of the eight problems over the test tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.answers import find_defects
from quern.llm.common import table
from quern.llm.leakage import find_leaks
from quern.llm.mixing import candidates, mix_report, mixture
from quern.llm.neardup import group_pairs, named_groups, near_duplicates
from quern.llm.packing import containers, pack_documents
from quern.llm.spam import find_spam
from quern.llm.tokens import record_tokens, token_budget
from quern.llm.truncation import cut_rates, find_cuts


def p1_token_budget(spark: SparkSession, d: str) -> DataFrame:
    return token_budget(table(spark, d, "teacher_records"), table(spark, d, "source_specs"))


def p1_record_tokens(spark: SparkSession, d: str) -> DataFrame:
    return record_tokens(table(spark, d, "teacher_records"))


def p2_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixture(table(spark, d, "teacher_records"), table(spark, d, "source_specs"), table(spark, d, "mix_targets"))


def p2_mix_report(spark: SparkSession, d: str) -> DataFrame:
    return mix_report(table(spark, d, "teacher_records"), table(spark, d, "source_specs"), table(spark, d, "mix_targets"))


def p2_candidates(spark: SparkSession, d: str) -> DataFrame:
    """(id, bucket, tokens): what can be mixed."""
    return candidates(table(spark, d, "teacher_records"), table(spark, d, "source_specs"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return find_defects(table(spark, d, "teacher_records"))


def p3_defect_counts(spark: SparkSession, d: str) -> DataFrame:
    return find_defects(table(spark, d, "teacher_records")).groupBy("defect").agg(F.count("*").alias("records"))


def p4_text(prompt: str = "prompt_text", context: str = "context_text"):
    return F.concat_ws(" ", F.coalesce(F.col(prompt), F.lit("")), F.coalesce(F.col(context), F.lit("")))


def _p4(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates(table(spark, d, "prompt_records"), "id", p4_text(), shingle=3, threshold=0.5)


def p4_groups(spark: SparkSession, d: str) -> DataFrame:
    """(id, first_id, size): each record with the least id and the number of records of its group."""
    return named_groups(_p4(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return group_pairs(_p4(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return find_cuts(table(spark, d, "teacher_records"), table(spark, d, "source_specs")).select("id", "field")


def p5_source_rates(spark: SparkSession, d: str) -> DataFrame:
    return cut_rates(table(spark, d, "teacher_records"), table(spark, d, "source_specs"))


def p6_packing(spark: SparkSession, d: str) -> DataFrame:
    return pack_documents(table(spark, d, "documents"), table(spark, d, "pack_capacities"))


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    return containers(p6_packing(spark, d), table(spark, d, "pack_capacities"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id").distinct()


def p7_unaltered(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, item_id) of the leaks that hold twelve unaltered words in a row."""
    return find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).where("unaltered").select("doc_id", "item_id").distinct()


def p7_item_report(spark: SparkSession, d: str) -> DataFrame:
    leaks = find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))
    n = F.countDistinct("doc_id")
    return leaks.groupBy("item_id").agg(n.alias("documents"), F.countDistinct(F.when(F.col("has_answer"), F.col("doc_id"))).alias("with_answer"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return find_spam(table(spark, d, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        p1_token_budget, p1_record_tokens, p2_mixture, p2_mix_report, p2_candidates, p3_found, p3_defect_counts, p4_found, p4_groups,
        p5_found, p5_source_rates, p6_packing, p6_containers, p7_found, p7_unaltered, p7_item_report, p8_found,
    )
}


def _folded(x: str) -> str:
    """The words of a text as problem 7 compares them; of markup entities those that occur in the test tables."""
    white = r"\s\x0B\x1C-\x1F\x{85}\p{Z}"
    x = rf"regexp_replace(regexp_replace({x}, '([^\W\d_])[-\x{{AD}}\x{{2010}}]\n([^\W\d_])', '\1\2', 'g'), '</?[a-zA-Z][^<>]{{0,300}}>|<!--.*?-->', ' ', 'g')"
    for a, b in (("&nbsp;", " "), ("&quot;", '"'), ("&#39;", "''"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        x = f"replace({x}, '{a}', '{b}')"
    x = rf"regexp_replace(strip_accents(replace(lower({x}), 'ß', 'ss')), '[^\p{{L}}\p{{N}}{white}]', '', 'g')"
    return f"list_filter(string_split(regexp_replace({x}, '[{white}]+', ' ', 'g'), ' '), lambda x: x <> '')"


def _source_key(x: str) -> str:
    """A source's id or name, however it is spelled."""
    x = rf"lower(trim(regexp_replace({x}, '[\s\x{{200B}}\x{{FEFF}}]+', ' ', 'g')))"
    return rf"regexp_replace(regexp_replace({x}, '^[a-z]+://(?:datasets/)?|^mirror/|@v?[\w.]+$|/+$', '', 'g'), '[\s-]+', '_', 'g')"


_RUNS = "unnest([array_to_string(w[i : i + 11], ' ') for i in range(1, len(w) - 10)]) as run"
_LINKED = r"""with recursive w as (select id, min(regexp_extract_all(lower(coalesce(prompt_text, '') || ' ' || coalesce(context_text, '')), '[\p{L}\p{N}]+')) as a from prompt_records where id is not null group by id),
    s as (select distinct id, unnest(case when len(a) < 3 then [array_to_string(a, ' ')] else [a[i] || ' ' || a[i + 1] || ' ' || a[i + 2] for i in range(1, len(a) - 1)] end) as g from w where len(a) > 0),
    n as (select id, count(*) as n from s group by id),
    c as (select x.id as a, y.id as b, count(*) as c from s x join s y on x.g = y.g and x.id < y.id group by all),
    l as (select a, b from c join n na on na.id = c.a join n nb on nb.id = c.b where 2 * c >= na.n + nb.n - c),
    e as (select a, b from l union all select b, a from l),
    r(a, b) as (select a, b from e union select r.a, e.b from r join e on r.b = e.a)
    """
#: What SQL can say: the groups of problem 4 by brute force over shared word triples, and unaltered runs of problem 7 by joins of runs of twelve words; the
#: others are tested against brute force in Python.
SQL: dict[str, str] = {
    "p4_found": _LINKED + "select a as id_a, b as id_b from r where a < b",
    "p2_candidates": f"""with k as (select {_source_key("id")} as key, id, 0 as rank from source_specs union all select {_source_key("name")}, id, 1 from source_specs where name is not null),
    n as (select key, arg_min(id, (rank, id)) as source_id from k group by key),
    r as (select id, arg_min((prompt_source, greatest(1, coalesce(strlen(text), 0) // 4)), coalesce(ingested_at, '9999-12-31'::timestamp)) as v from teacher_records where id is not null group by id)
    select r.id, s.bucket, v[2]::bigint as tokens from r join n on n.key = {_source_key("r.v[1]")} join source_specs s on s.id = n.source_id where s.bucket is not null and coalesce(s.enabled, true)""",
    "p7_unaltered": rf"""with s as (select item_id, passage, string_split(regexp_replace(trim(question), '([.!?:])\s+', '\1' || chr(1), 'g'), chr(1)) as s from eval_items),
    l as (select item_id, passage, s, array_to_string({_folded("s[1]")}, ' ') as lead, array_to_string({_folded("array_to_string(s[2:], ' ')")}, ' ') as rest from s),
    shared as (select lead from l where len(s) > 1 group by lead having count(distinct rest) >= 3),
    i as (select item_id, {_folded("passage")} as w from l union all select item_id, {_folded("array_to_string(case when len(s) > 1 and lead in (select lead from shared) then s[2:] else s end, ' ')")} from l),
    d as (select doc_id, {_folded("text")} as w from documents where text is not null)
    select distinct doc_id, item_id from (select doc_id, {_RUNS} from d) x join (select item_id, {_RUNS} from i) y using (run)""",
    "p4_groups": _LINKED + "select id, coalesce(min(b), id) as first_id, greatest(count(b), 1) as size from w left join r on r.a = w.id where len(w.a) > 0 group by id",
}
