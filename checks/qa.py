"""Q&A queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import kw, lit, np_round, py_round, query, sql_view  # noqa: F401
from checks.views import view
from opsgrain import rules
from opsgrain.functions import text as tx
from opsgrain.functions.core import normalize_whitespace
from opsgrain.operators import ordering, profile, qa, quality, sampling, slices
from opsgrain.plans import jobs
from opsgrain.session import stage_table

# --- SQL snippets -------------------------------------------------------------

SP, NSP = rules.SPACE, rules.NON_SPACE


def squeeze(x):
    return f"trim(regexp_replace(coalesce({x}, ''), '{SP}+', ' ', 'g'))"


def clean(x):
    return squeeze(f"regexp_replace(coalesce({x}, ''), 'http[s]?://{NSP}+', '[URL]', 'g')")


def words(x):
    return f"len(regexp_extract_all({x}, '{NSP}+'))"


def blocks(x):
    return f"len(regexp_extract_all({x}, '{rules.CODE_BLOCK}'))"


def marks(x):
    return f"len(regexp_extract_all({x}, '[.!?]+'))"


def names(low, table):
    items = ", ".join(f"case when {kw(low, ws)} then {lit(n)} end" for n, ws in table)
    return f"list_filter([{items}], lambda v: v is not null)"


def html(x):
    out = f"regexp_replace(coalesce({x}, ''), '<[^>]+>', ' ', 'g')"
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&middot;", "·"),
                 ("&copy;", "©"), ("&amp;", "&")):
        out = f"replace({out}, '{a}', '{b}')"
    return squeeze(out)


_QTYPE = "case " + " ".join(f"when regexp_matches(lower(q), '{p}') then '{n}'" for n, p in rules.QUESTION_TYPE_RULES) + " else 'general' end"


def complexity(x):
    return (f"case when {words(x)} < 50 and {blocks(x)} = 0 then 'simple' "
            f"when {words(x)} < 200 or {blocks(x)} <= 1 then 'moderate' else 'complex' end")


_POINTS = (f"score * 2.0::double + answer_score * 3.0::double + view_count * 0.001::double + least({words('question_body')} / 50.0::double, 2.0::double) "
           f"+ least({words('answer_body')} / 100.0::double, 3.0::double) + {blocks('answer_body')} * 0.5::double")
sql_view("qa_clean", f"""select * from (select *, {clean('question_body')} as q, {clean('answer_body')} as a, {clean('title')} as t from qa_pairs
    where coalesce(question_id, 0) <> 0 and coalesce(question_body, '') <> '' and coalesce(answer_body, '') <> '')
    where length(q) >= 20 and length(a) >= 50""")
sql_view("qa_all", f"""select *, {_POINTS} as points, coalesce(title, '') || ' ' || q || ' ' || a as everything from qa_clean""")
sql_view("qa", f"""select question_id, t as title, q as question_body, a as answer_body, tags, score, answer_score, view_count,
    {names('lower(everything)', rules.ERROR_SIGNATURES)} as error_signatures, {names('lower(everything)', rules.INFRA_COMPONENTS)} as infra_components,
    {_QTYPE} as question_type, {complexity('everything')} as complexity, length(q) as q_chars, {words('q')} as q_words, {marks('q')} as q_marks,
    {blocks('q')} as q_blocks, length(a) as a_chars, {words('a')} as a_words, {marks('a')} as a_marks, {blocks('a')} as a_blocks,
    {py_round('points', 2)} as quality_score from qa_all""")


def features(spark, sf):
    return qa.qa_features(view(spark, sf, "qa_pairs"))


def staged(spark, sf):
    """Several operators read the features more than once; they are written once."""
    return stage_table(features(spark, sf))


# --- text functions -------------------------------------------------------------


@query("F1_normalize_whitespace", f"select doc_id, md5({squeeze('text')}) as h from documents")
def _(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return d.select("doc_id", F.md5(normalize_whitespace("text")).alias("h"))


@query("F2_extract_code_blocks", f"""select question_id, array_to_string(regexp_extract_all(answer_body, '{rules.CODE_BLOCK}'), '|') as blocks,
    {squeeze(f"regexp_replace(answer_body, '{rules.CODE_BLOCK}', ' [CODE] ', 'g')")} as rest from qa_pairs""")
def _(spark, sf):
    return view(spark, sf, "qa_pairs").select(
        "question_id", F.array_join(tx.code_blocks("answer_body"), "|").alias("blocks"),
        tx.text_without_code("answer_body").alias("rest"))


@query("F3_clean_text", f"""select question_id, {clean('question_body')} as kept, {squeeze(
    f"regexp_replace(regexp_replace(regexp_replace(answer_body, 'http[s]?://{NSP}+', '[URL]', 'g'), '```[^`]*```', '', 'g'), '`[^`]+`', '', 'g')")} as no_code from qa_pairs""")
def _(spark, sf):
    return view(spark, sf, "qa_pairs").select("question_id", tx.clean_text("question_body").alias("kept"),
                                              tx.clean_text("answer_body", remove_code=True).alias("no_code"))


@query("F4_clean_html", f"select page_id, {html('html')} as text from html_posts")
def _(spark, sf):
    return view(spark, sf, "html_posts").select("page_id", tx.clean_html("html", "basic").alias("text"))


@query("F4_clean_html_all_entities", f"select page_id, {html('html')} as text from html_posts")
def _(spark, sf):
    return view(spark, sf, "html_posts").select("page_id", tx.clean_html("html").alias("text"))


@query("F5_text_metrics", f"""select doc_id, length(text) as char_count, {words('text')} as word_count, {marks('text')} as sentence_count,
    {blocks('text')} as code_block_count from documents""")
def _(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return d.select("doc_id", tx.text_metrics("text").alias("m")).select("doc_id", "m.*")


@query("F6_error_signatures", f"select doc_id, array_to_string({names('lower(text)', rules.ERROR_SIGNATURES)}, ',') as found from documents")
def _(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.lower("text").alias("low"))
    return d.select("doc_id", F.array_join(tx.error_signatures("low"), ",").alias("found"))


@query("F7_infra_components", f"select doc_id, array_to_string({names('lower(text)', rules.INFRA_COMPONENTS)}, ',') as found from documents")
def _(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.lower("text").alias("low"))
    return d.select("doc_id", F.array_join(tx.infra_components("low"), ",").alias("found"))


@query("F8_quality_score", f"select question_id, {py_round('points', 2)} as quality_score from qa_all")
def _(spark, sf):
    return features(spark, sf).select("question_id", "quality_score")


@query("F9_text_complexity", f"select doc_id, {complexity('text')} as complexity from documents")
def _(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return d.select("doc_id", tx.text_complexity("text").alias("complexity"))


@query("F10_question_type", f"select question_id, {_QTYPE} as question_type from qa_clean")
def _(spark, sf):
    return features(spark, sf).select("question_id", "question_type")


_FEATURE_SQL = """question_id, title, question_body, answer_body, array_to_string(tags, ',') as tags, score, answer_score, view_count,
    array_to_string(error_signatures, ',') as error_signatures, array_to_string(infra_components, ',') as infra_components,
    question_type, complexity, q_chars, q_words, q_marks, q_blocks, a_chars, a_words, a_marks, a_blocks, quality_score"""


@query("F31_qa_features", f"select {_FEATURE_SQL} from qa")
def _(spark, sf):
    f = features(spark, sf)
    short = {"char_count": "chars", "word_count": "words", "sentence_count": "marks", "code_block_count": "blocks"}
    metrics = [F.col(f"{s}_metrics.{m}").alias(f"{s[0]}_{n}") for s in ("question", "answer") for m, n in short.items()]
    lists = [F.array_join(c, ",").alias(c) for c in ("tags", "error_signatures", "infra_components")]
    return f.select("question_id", "title", "question_body", "answer_body", "score", "answer_score", "view_count",
                    *lists, "question_type", "complexity", *metrics, "quality_score")


@query("C2_valid_qa", "select question_id, title, question_body, answer_body from qa_clean")
def _(spark, sf):
    return qa.valid_qa(view(spark, sf, "qa_pairs")).select("question_id", "title", "question_body", "answer_body")


# --- posts and pairs ------------------------------------------------------------

_INT = "try_cast(case when regexp_matches(trim({c}), '^[+-]?[0-9]+$') then trim({c}) end as bigint)"


def _zero(c):
    return f"case when trim(coalesce({c}, '')) = '' then 0 else {_INT.format(c=c)} end"


sql_view("questions", f"""select {_INT.format(c='Id')} as question_id, {html('Title')} as title, {html('Body')} as body,
    {_zero('Score')} as score, {_INT.format(c='AcceptedAnswerId')} as accepted_answer_id,
    regexp_extract_all(Tags, '<([^>]+)>', 1) as tags, {_zero('ViewCount')} as view_count, CreationDate as creation_date
    from question_posts where {_zero('Score')} >= 5 and {_INT.format(c='AcceptedAnswerId')} is not null""")
sql_view("answers", f"""select answer_id, question_id, body, score from (select {_zero('AnswerId')} as answer_id, {_zero('QuestionId')} as question_id,
    {html('AnswerBody')} as body, {_zero('AnswerScore')} as score from answer_posts)
    where answer_id <> 0 and question_id <> 0 qualify row_number() over (partition by question_id order by answer_id desc) = 1""")
_PAIR = "q.question_id, title, q.body as question_body, array_to_string(tags, ',') as tags, q.score, view_count, a.body as answer_body, a.score as answer_score"


def _flat(df):
    return df.withColumn("tags", F.array_join("tags", ","))


@query("S3_read_questions", "select * replace (array_to_string(tags, ',') as tags) from questions")
def _(spark, sf):
    return _flat(qa.read_questions(view(spark, sf, "question_posts")))


@query("S4_read_answers", "select * from answers")
def _(spark, sf):
    return qa.read_answers(view(spark, sf, "answer_posts"))


@query("J1_pair_questions_answers", f"select {_PAIR} from questions q join answers a on a.question_id = q.question_id")
def _(spark, sf):
    return _flat(qa.pair_questions_answers(
        qa.read_questions(view(spark, sf, "question_posts"), entities="basic"),
        qa.read_answers(view(spark, sf, "answer_posts"), entities="basic")))


@query("J2_pair_by_accepted", f"select {_PAIR} from questions q join answers a on a.answer_id = q.accepted_answer_id")
def _(spark, sf):
    # every question is listed twice, as under two tags; the answers are the first ones
    q = qa.read_questions(view(spark, sf, "question_posts"), entities="basic")
    posts = view(spark, sf, "answer_posts")
    return _flat(qa.pair_by_accepted(q.unionByName(q), qa.read_answers(posts, entities="basic")))


# --- records --------------------------------------------------------------------


def _messages(df, *extra):
    return df.select(F.array_join(F.transform("messages", lambda m: F.concat_ws(": ", m["role"], m["content"])), "\n").alias("chat"), *extra)


@query("F26_qa_to_chat", f"""select 'system: ' || {lit(rules.QA_SYSTEM_PROMPT)} || chr(10) || 'user: ' || question_body || chr(10) || 'assistant: ' || answer_body as chat,
    question_id, quality_score, array_to_string(tags, ',') as tags from qa""")
def _(spark, sf):
    c = qa.qa_to_chat(features(spark, sf), rules.QA_SYSTEM_PROMPT)
    return _messages(c, "metadata.question_id", "metadata.quality_score", F.array_join("metadata.tags", ",").alias("tags"))


@query("F26_qa_to_completion", """select '### Question' || chr(10) || title || chr(10) || chr(10) || question_body || chr(10) || chr(10) || 'Tags: ' ||
    array_to_string(tags, ', ') || chr(10) || chr(10) || '### Answer' || chr(10) as prompt, answer_body as completion, question_id, quality_score from qa""")
def _(spark, sf):
    return qa.qa_to_completion(features(spark, sf)).select("prompt", "completion", "metadata.question_id", "metadata.quality_score")


@query("O1_rank_by_quality", "select question_id, quality_score, row_number() over (order by quality_score desc, question_id) - 1 as row_index from qa")
def _(spark, sf):
    # the position makes the order part of the result
    ranked = ordering.with_global_index(features(spark, sf).select("question_id", "quality_score"),
                                        [F.desc("quality_score"), F.asc("question_id")])
    return ordering.rank_by_quality(ranked).select("question_id", "quality_score", "row_index")


@query("B3_weighted_sample", """with b as (select min(quality_score) as lo, max(quality_score) as hi from qa),
    w as (select question_id, quality_score, 0.5 + (quality_score - lo) / (hi - lo) as weight from qa, b),
    t as (select *, -ln((('0x' || substr(md5('42:' || question_id), 1, 15))::bigint + 1) / 1152921504606846977::double) / weight as race from w)
    select question_id, round(quality_score, 6) as quality_score from t qualify row_number() over (order by race) <= floor(0.3 * count(*) over ())""")
def _(spark, sf):
    weighted = ordering.minmax_weight(staged(spark, sf).select("question_id", "quality_score"), "quality_score")
    return sampling.weighted_sample(weighted, "sample_weight", 0.3, ["question_id"]).select("question_id", F.round("quality_score", 6).alias("quality_score"))


@query("W5_minmax_weight", """with b as (select min(quality_score) as lo, max(quality_score) as hi from qa)
    select question_id, round(0.5 + (quality_score - lo) / (hi - lo), 9) as sample_weight from qa, b""")
def _(spark, sf):
    return ordering.minmax_weight(staged(spark, sf), "quality_score").select(
        "question_id", F.round("sample_weight", 9).alias("sample_weight"))


_K5 = "concat_ws(':', '42', question_id)"


@query("B5_train_test_split", f"""with k as (select question_id, row_number() over (order by md5({_K5}) || ':' || {_K5}) as r, count(*) over () as n from qa)
    select question_id, case when r <= floor(n * 0.8::double) then 'train' else 'test' end as split from k""")
def _(spark, sf):
    return sampling.train_test_split(staged(spark, sf), ["question_id"]).select("question_id", "split")


@query("B5_split_documents", """with s as (select doc_id, concat_ws(':', '7', doc_id) as i from documents),
    k as (select doc_id, row_number() over (order by md5(i) || ':' || i) as r, count(*) over () as n from s)
    select doc_id, case when r <= floor(n * 0.9::double) then 'train' else 'test' end as split from k""")
def _(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id")
    return sampling.train_test_split(d, ["doc_id"], test_ratio=0.1, seed=7)


# --- statistics -----------------------------------------------------------------

_NUM = ("score", "answer_score", "view_count", "quality_score")


def _r(x, n=6):
    return f"round({x}, {n})"


@query("G14_describe_numeric", "\nunion all ".join(
    f"""select '{c}' as "column", count({c}) as count, {_r(f'avg({c})')} as mean, {_r(f'stddev_samp({c})')} as std, min({c})::double as min, max({c})::double as max,
    {_r(f'quantile_cont({c}::double, 0.25)')} as q25, {_r(f'quantile_cont({c}::double, 0.5)')} as median, {_r(f'quantile_cont({c}::double, 0.75)')} as q75 from qa""" for c in _NUM))
def _(spark, sf):
    d = profile.describe_numeric(staged(spark, sf), _NUM)
    return d.select("column", "count", "min", "max", *[F.round(c, 6).alias(c) for c in ("mean", "std", "q25", "median", "q75")])


@query("G14_describe_lineitem", "\nunion all ".join(
    f"""select '{c}' as "column", {_r(f'quantile_cont({c}::double, 0.25)')} as q25, {_r(f'quantile_cont({c}::double, 0.5)')} as median,
    {_r(f'quantile_cont({c}::double, 0.75)')} as q75 from lineitem""" for c in ("l_extendedprice", "l_quantity", "l_discount")))
def _(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    d = profile.describe_numeric(li, ("l_extendedprice", "l_quantity", "l_discount"))
    return d.select("column", *[F.round(c, 6).alias(c) for c in ("q25", "median", "q75")])


_TXT = {"title": 0, "question_body": 50, "answer_body": 100}


@query("G15_describe_text", "\nunion all ".join(
    f"""select '{c}' as "column", {_r(f'avg(length({c}))')} as avg_length, min(length({c})) as min_length, max(length({c})) as max_length,
    sum(length({c}))::bigint as total_chars, quantile_cont(length({c})::double, 0.5) as median_length, count(*) filter (where length({c}) < {n}) as short_texts,
    count(*) filter (where length({c}) < {n}) > count(*) * 0.1 as too_many_short from qa""" for c, n in _TXT.items()))
def _(spark, sf):
    limits = {k: v for k, v in _TXT.items() if v}
    d = profile.describe_text(staged(spark, sf), list(_TXT), limits)
    return d.withColumn("avg_length", F.round("avg_length", 6)).withColumn(
        "too_many_short", F.coalesce("too_many_short", F.lit(False)))


def _stat(col, stat, expr):
    return f"""select '{col}' as "column", '{stat}' as statistic, {expr} as value from qa"""


_COLSTAT = [_stat(c, s, e) for c in ("question_id", "title", "complexity", "score") for s, e in (
    ("count", f"count({c})::double"), ("null_count", f"count(*) filter (where {c} is null)::double"),
    ("null_percentage", f"count(*) filter (where {c} is null) / count(*) * 100"))]
_COLSTAT += [_stat(c, s, e) for c in ("title", "complexity") for s, e in (
    ("min_length", f"min(length({c}))"), ("max_length", f"max(length({c}))"), ("mean_length", f"round(avg(length({c})), 6)"),
    ("unique_count", f"count(distinct {c})"))]
_COLSTAT += [_stat(c, s, e) for c in ("question_id", "score") for s, e in (
    ("mean", f"round(avg({c}), 6)"), ("std", f"round(stddev_samp({c}), 6)"), ("min", f"min({c})"), ("max", f"max({c})"),
    ("q25", f"round(quantile_cont({c}::double, 0.25), 6)"), ("median", f"round(quantile_cont({c}::double, 0.5), 6)"),
    ("q75", f"round(quantile_cont({c}::double, 0.75), 6)"))]
_TOP = """(select 'complexity' as "column", 'top:' || complexity as statistic, count(*)::double as value from qa group by complexity
    order by count(*) desc, complexity limit 5)"""


@query("G16_column_statistics", "\nunion all ".join(_COLSTAT) + f"\nunion all select * from {_TOP}")
def _(spark, sf):
    d = profile.column_statistics(staged(spark, sf), ["question_id", "title", "complexity", "score"], ["complexity"])
    return d.withColumn("value", F.round("value", 6))


@query("G17_dataset_info", """with d as (select lang, source, text from documents)
    select (select count(*) from d) as row_count, 3 as column_count, (select count(*) from d) - (select count(*) from (select distinct * from d)) as duplicate_rows""")
def _(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").select("lang", "source", "text")
    return profile.dataset_info(d)


@query("G18_array_value_counts", """select value, count(*) as count from (select unnest(infra_components) as value from qa) group by 1
    order by 2 desc, 1 limit 5""")
def _(spark, sf):
    return profile.array_value_counts(features(spark, sf), "infra_components", 5)


@query("G18_tag_counts", "select value, count(*) as count from (select unnest(tags) as value from qa) group by 1")
def _(spark, sf):
    return profile.array_value_counts(features(spark, sf), "tags")


@query("G19_iqr_outliers", """with l as (select event_id, 'value' as c, value as v from events union all select event_id, 'user_id', user_id::double from events),
    b as (select c, quantile_cont(v, 0.25) as q1, quantile_cont(v, 0.75) as q3 from l group by 1)
    select event_id, l.c as "column", v as value, round(q1 - 1.5 * (q3 - q1), 6) as lower_bound, round(q3 + 1.5 * (q3 - q1), 6) as upper_bound
    from l join b on b.c = l.c where v < q1 - 1.5 * (q3 - q1) or v > q3 + 1.5 * (q3 - q1)""")
def _(spark, sf):
    o = profile.iqr_outliers(spark.read.parquet(f"{sf}/events.parquet"), ["value", "user_id"], "event_id")
    return o.withColumn("lower_bound", F.round("lower_bound", 6)).withColumn("upper_bound", F.round("upper_bound", 6))


@query("G19_price_outliers", """with b as (select quantile_cont(l_tax::double * l_tax, 0.25) as q1, quantile_cont(l_tax::double * l_tax, 0.75) as q3 from lineitem),
    p as (select quantile_cont(l_extendedprice::double, 0.25) as q1, quantile_cont(l_extendedprice::double, 0.75) as q3 from lineitem)
    select 'squared_tax' as "column", count(*) filter (where l_tax * l_tax > q3 + 1.5 * (q3 - q1) or l_tax * l_tax < q1 - 1.5 * (q3 - q1)) as outliers,
    count(*) filter (where l_tax * l_tax > q3 + 1.5 * (q3 - q1) or l_tax * l_tax < q1 - 1.5 * (q3 - q1)) > count(*) * 0.05 as flagged from lineitem, b
    union all select 'l_extendedprice', count(*) filter (where l_extendedprice > q3 + 1.5 * (q3 - q1) or l_extendedprice < q1 - 1.5 * (q3 - q1)),
    count(*) filter (where l_extendedprice > q3 + 1.5 * (q3 - q1) or l_extendedprice < q1 - 1.5 * (q3 - q1)) > count(*) * 0.05 from lineitem, p""")
def _(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").withColumn("squared_tax", F.col("l_tax") * F.col("l_tax"))
    return profile.outlier_summary(li, ["squared_tax", "l_extendedprice"])


@query("G20_duplicate_ratio", """with h as (select md5(text) as h from documents)
    select count(*) - count(distinct h) as duplicates, round((count(*) - count(distinct h)) / count(*), 9) as duplicate_ratio,
    case when (count(*) - count(distinct h)) / count(*) > 0.05 then 'failed' when count(*) > count(distinct h) then 'warning' else 'passed' end as status from h""")
def _(spark, sf):
    return profile.duplicate_ratio(spark.read.parquet(f"{sf}/documents.parquet"), "text").withColumn("duplicate_ratio", F.round("duplicate_ratio", 9))


@query("G21_missing_ratio", "\nunion all ".join(
    f"""select '{c}' as "column", round(count(*) filter (where {c} is null) / count(*), 9) as missing_ratio, case when count(*) filter (where {c} is null) / count(*) > 0.1
    then 'failed' when count(*) filter (where {c} is null) > 0 then 'warning' else 'passed' end as status from batch_task""" for c in ("status", "plan_cpu", "job_id")))
def _(spark, sf):
    m = profile.missing_ratio(view(spark, sf, "batch_task"), ["status", "plan_cpu", "job_id"])
    return m.withColumn("missing_ratio", F.round("missing_ratio", 9))


@query("G37_quality_feature_stats", """select 'avg_quality_score' as feature, '' as value, round(avg(quality_score), 6) as number from qa
    union all select 'question_type', question_type, count(*) from qa group by 2 union all select 'complexity', complexity, count(*) from qa group by 2""")
def _(spark, sf):
    return profile.quality_feature_stats(features(spark, sf)).withColumn("number", F.round("number", 6))


# --- slices ---------------------------------------------------------------------

sql_view("qa_slice_rows", """select question_id, 'question_type' as dimension, question_type as value from qa
    union all select question_id, 'complexity', complexity from qa
    union all select distinct question_id, 'tags', unnest(tags) from qa
    union all select question_id, 'error_signatures', unnest(error_signatures) from qa
    union all select question_id, 'infra_components', unnest(infra_components) from qa""")
_AGGS = """count(*) as count, avg(quality_score) as quality_mean, stddev_samp(quality_score) as quality_std,
    avg(answer_score) as answer_score_mean, stddev_samp(answer_score) as answer_score_std, avg(length(question_body)) as question_length_mean,
    stddev_samp(length(question_body)) as question_length_std, avg(length(answer_body)) as answer_length_mean,
    stddev_samp(length(answer_body)) as answer_length_std, count(*) filter (where complexity = 'simple') / count(*) as simple_share,
    count(*) filter (where complexity = 'moderate') / count(*) as moderate_share, count(*) filter (where complexity = 'complex') / count(*) as complex_share"""
MIN_ROWS = 1
sql_view("qa_slices", f"""select dimension, value, {_AGGS}, quantile_cont(quality_score, 0.5) as quality_median,
    count(*) / (select count(*) from qa) as proportion from qa_slice_rows s join qa using (question_id) group by 1, 2 having count(*) >= {MIN_ROWS}""")
sql_view("qa_overall", f"select {_AGGS} from qa")
_FLOATS = ["quality_mean", "quality_std", "answer_score_mean", "answer_score_std", "question_length_mean", "question_length_std",
           "answer_length_mean", "answer_length_std", "simple_share", "moderate_share", "complex_share", "quality_median", "proportion"]


def _slices(spark, sf):
    return slices.slice_metrics(staged(spark, sf), min_rows=MIN_ROWS)


@query("G22_slice_metrics", "select dimension, value, count, " + ", ".join(f"round({c}, 6) as {c}" for c in _FLOATS) + " from qa_slices")
def _(spark, sf):
    return _slices(spark, sf).select("dimension", "value", "count", *[F.round(c, 6).alias(c) for c in _FLOATS])


@query("J7_slice_vs_overall", """select dimension, value, round(s.quality_mean - o.quality_mean, 6) as quality_gap, o.count as total
    from qa_slices s, qa_overall o""")
def _(spark, sf):
    q = staged(spark, sf)
    both = slices.slice_vs_overall(slices.slice_metrics(q, min_rows=MIN_ROWS), slices.overall_metrics(q))
    return both.select("dimension", "value", F.round(F.col("quality_mean") - F.col("overall.quality_mean"), 6).alias("quality_gap"),
                       F.col("overall.count").alias("total"))


sql_view("qa_judged", """with d as (select s.dimension, s.value, s.count, s.proportion,
    case when o.quality_mean > 0 then abs(s.quality_mean - o.quality_mean) / o.quality_mean end as qd, s.quality_mean > o.quality_mean as qup,
    case when o.answer_length_mean > 0 then abs(s.answer_length_mean - o.answer_length_mean) / o.answer_length_mean end as ld,
    s.answer_length_mean > o.answer_length_mean as lup from qa_slices s, qa_overall o),
    e as (select *, coalesce(qd > 0.25, false) as qf, coalesce(ld > 0.5, false) as lf, proportion < 0.005 and count < 20 as rf from d),
    f as (select *, qf::int + lf::int + rf::int as n, greatest(case when qf then qd else 0 end, case when lf then ld else 0 end) as worst from e)
    select *, case when n = 0 then 'none' when worst > 0.75 or n >= 3 then 'high' when worst > 0.5 or n >= 2 then 'medium' else 'low' end as severity from f""")


def _judged(spark, sf):
    q = staged(spark, sf)
    return slices.slice_bias(slices.slice_vs_overall(slices.slice_metrics(q, min_rows=MIN_ROWS), slices.overall_metrics(q)))


@query("G23_slice_bias", f"""select dimension, value, n > 0 as is_biased, severity, concat_ws(';',
    case when qf then 'quality_score ' || case when qup then 'higher' else 'lower' end end,
    case when lf then 'answer_length ' || case when lup then 'longer' else 'shorter' end end,
    case when rf then 'underrepresentation' end) as factors, {py_round('case when qf then qd end', 3)} as quality_diff from qa_judged""")
def _(spark, sf):
    j = _judged(spark, sf)
    text = F.transform("factors", lambda f: F.concat_ws(" ", f["factor"], f["direction"]))
    quality_factor = F.get(F.filter("factors", lambda f: f["factor"] == "quality_score"), F.lit(0))["difference_ratio"]
    return j.select("dimension", "value", "is_biased", "severity", F.array_join(text, ";").alias("factors"),
                    quality_factor.alias("quality_diff"))


@query("G24_bias_summary", """select count(*) as total_slices, count(*) filter (where n > 0) as biased_slices,
    round(count(*) filter (where n > 0) / count(*), 9) as bias_rate, count(*) filter (where severity = 'high') as high_severity_count,
    count(*) filter (where severity = 'medium') as medium_severity_count, count(*) filter (where severity = 'low') as low_severity_count from qa_judged""")
def _(spark, sf):
    return slices.bias_summary(_judged(spark, sf)).withColumn("bias_rate", F.round("bias_rate", 9))


_SUGGEST = """select dimension, value, 'few_rows' as issue, 'data_augmentation' as strategy, case when count < 50 then 'high' else 'medium' end as priority from qa_judged where rf
    union all select dimension, value, 'low_quality', 'quality_filtering', 'medium' from qa_judged where qf and not qup
    union all select dimension, value, 'answer_length:' || case when lup then 'longer' else 'shorter' end, 'length_normalization', 'low' from qa_judged where lf"""


@query("G25_mitigation_suggestions", _SUGGEST)
def _(spark, sf):
    return slices.mitigation_suggestions(_judged(spark, sf)).drop("position")


_RARE = 40


def _advice(spark, sf, rows):
    """Tags with few rows, as if the report had asked for their augmentation."""
    counted = profile.array_value_counts(rows, "infra_components").where(F.col("count") < _RARE)
    return counted.select(F.lit("infra_components").alias("dimension"), "value", F.lit("data_augmentation").alias("strategy"),
                          F.lit("high").alias("priority"), F.struct(F.negative("count"), "value").alias("position"))


sql_view("b4_advice", f"""select value, count(*) as n from (select unnest(infra_components) as value from qa) group by 1 having count(*) < {_RARE}
    order by count(*) desc, value limit 3""")
_K4 = "concat_ws(':', '42', question_id)"


@query("B4_oversample_slices", f"""with m as (select 'infra_components=' || c.value as drawn_for, n as size, least(n * 2, 100) as draws, question_id,
      row_number() over (partition by c.value order by md5({_K4}) || ':' || {_K4}) - 1 as idx
      from b4_advice c join (select question_id, unnest(infra_components) as value from qa) q on q.value = c.value where n < {_RARE}),
    d as (select drawn_for, size, unnest(range(0, draws)) as dr from (select distinct drawn_for, size, draws from m)),
    x as (select drawn_for, ('0x' || substr(md5('42:' || drawn_for || ':' || dr), 1, 15))::bigint % size as idx, count(*) as times from d group by all)
    select question_id, null as drawn_for, 0 as copy from qa
    union all select question_id, m.drawn_for, unnest(range(0, times)) from m join x on x.drawn_for = m.drawn_for and x.idx = m.idx""")
def _(spark, sf):
    rows = staged(spark, sf)
    return sampling.oversample_slices(rows, _advice(spark, sf, rows), ["question_id"], max_slices=3, small=_RARE, most_draws=100).select(
        "question_id", "drawn_for", "copy")


@query("B5_qa_training_job", """with d as (select coalesce(sum(2 * count), 0) as extra from (select distinct dimension, value, count from qa_judged
      where rf and dimension in ('tags', 'error_signatures', 'infra_components'))),
    n as (select count(*) + (select extra from d) as n from qa)
    select split, records::bigint as records from (select 'train' as split, floor(n * 0.8) as records from n union all select 'test', n - floor(n * 0.8) from n) where records > 0""")
def _(spark, sf):
    # the whole job: features, bias report, oversampling of rare slices, weights, split, chat records
    records = jobs.qa_training_table(view(spark, sf, "qa_pairs"), mitigate=True)
    return records.where(F.size("messages") >= 2).groupBy("split").agg(F.count("*").alias("records"))


# --- checks ---------------------------------------------------------------------


@query("D6_expect_unique", """select 'unique' as "check", 'system,EventId' as "column", case when count(*) = count(distinct (system, EventId)) then 'passed' else 'failed' end as status, count(*) - count(distinct (system, EventId))::double as value from templates
    union all select 'unique', 'EventId', case when count(*) = count(distinct EventId) then 'passed' else 'failed' end, count(*) - count(distinct EventId) from templates""")
def _(spark, sf):
    checks = [quality.expect_unique("system", "EventId"), quality.expect_unique("EventId")]
    return quality.check_suite(view(spark, sf, "templates"), checks).select("check", "column", "status", "value")


@query("D11_expect_no_markup", """select 'no_markup' as "check", 'question_body' as "column",
    case when count(*) filter (where regexp_matches(question_body, '<[a-z]+>')) = 0 then 'passed' else 'warning' end as status,
    count(*) filter (where regexp_matches(question_body, '<[a-z]+>'))::double as value from qa""")
def _(spark, sf):
    return quality.check_suite(features(spark, sf), [quality.expect_no_markup("question_body")]).select("check", "column", "status", "value")


@query("D12_expect_not_blank", "\nunion all ".join(
    f"""select 'not_blank' as "check", '{c}' as "column", case when count(*) filter (where trim({c}) = '') = 0 then 'passed' else 'warning' end as status,
    count(*) filter (where trim({c}) = '')::double as value from question_posts""" for c in ("AcceptedAnswerId", "Body", "Score")))
def _(spark, sf):
    checks = quality.expect_not_blank(["AcceptedAnswerId", "Body", "Score"])
    return quality.check_suite(view(spark, sf, "question_posts"), checks).select("check", "column", "status", "value")


@query("D22_expect_variation", """select 'score' as "column", case when stddev_samp(score) = 0 then 'warning' else 'passed' end as status,
    round(stddev_samp(score), 6) as value from qa
    union all select 'tags', case when count(distinct t) < 3 then 'warning' else 'passed' end, count(distinct t) from (select unnest(tags) as t from qa)""")
def _(spark, sf):
    return quality.expect_variation(features(spark, sf)).select("column", "status", F.round("value", 6).alias("value"))


@query("D9_expect_min_value", """select 'min_value' as "check", c as "column", case when m >= lo then 'passed' else 'failed' end as status, m::double as value from (
    select 'score' as c, min(score) as m, 0 as lo from qa union all select 'view_count', min(view_count), 100 from qa)""")
def _(spark, sf):
    checks = [quality.expect_min_value("score", 0), quality.expect_min_value("view_count", 100)]
    return quality.check_suite(features(spark, sf), checks).select("check", "column", "status", "value")


def _suite_row(check, column, value, status):
    return f"""select '{check}' as "check", '{column}' as "column", {status} as status, {value} as value from qa"""


_NN = [_suite_row("not_null", c, f"count(*) filter (where {c} is null)::double", f"case when count(*) filter (where {c} is null) = 0 then 'passed' else 'failed' end") for c in rules.QA_REQUIRED_COLUMNS]


@query("D5_qa_suite", "\nunion all ".join(
    [_suite_row("min_row_count", "table", "count(*)::double", "case when count(*) >= 100 then 'passed' else 'failed' end"),
     *_NN,
     _suite_row("unique", "question_id", "(count(*) - count(distinct question_id))::double", "case when count(*) = count(distinct question_id) then 'passed' else 'failed' end"),
     *[_suite_row("min_value", c, f"min({c})::double", f"case when min({c}) >= {lo} then 'passed' else 'failed' end")
       for c, lo in (("question_id", 1), ("score", 0), ("answer_score", 0), ("quality_score", 0))],
     _suite_row("no_markup", "question_body", "count(*) filter (where regexp_matches(question_body, '<[a-z]+>'))::double",
                "case when count(*) filter (where regexp_matches(question_body, '<[a-z]+>')) = 0 then 'passed' else 'warning' end"),
     *[_suite_row("not_blank", c, f"count(*) filter (where trim({c}) = '')::double",
                  f"case when count(*) filter (where trim({c}) = '') = 0 then 'passed' else 'warning' end")
       for c in ("question_body", "answer_body", "title")],
     _suite_row("variation", "score", "round(stddev_samp(score), 6)", "case when stddev_samp(score) <> 0 then 'passed' else 'warning' end")]))
def _(spark, sf):
    return quality.check_suite(features(spark, sf), quality.qa_suite()).select(
        "check", "column", "status", F.round("value", 6).alias("value"))


@query("D1_expect_columns")
def _(spark, sf):
    q = features(spark, sf)
    return quality.expect_columns(q, rules.QA_REQUIRED_COLUMNS, known=rules.QA_EXPECTED_COLUMNS).unionByName(
        quality.expect_columns(q, rules.QA_REQUIRED_COLUMNS, ordered=True))
