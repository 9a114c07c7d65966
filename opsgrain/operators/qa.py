"""Posts to question/answer pairs, features, chat and completion records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsgrain import rules
from opsgrain.functions import text as tx
from opsgrain.functions.core import as_col, py_round, strip
from opsgrain.operators.winners import first_rows


def _count_or_zero(col: str) -> Column:
    """Blank counts as 0, text that is no whole number as null (the row is malformed)."""
    t = strip(F.coalesce(F.col(col), F.lit("")))
    return F.when(t == "", F.lit(0).cast("bigint")).otherwise(_whole(t))


def _whole(col: Column | str) -> Column:
    t = strip(as_col(col))
    return F.when(t.rlike(r"^[+-]?\d+$"), t).try_cast("bigint")


def read_questions(posts: DataFrame, min_score: int = rules.MIN_POST_SCORE, entities: str = "all") -> DataFrame:
    """Well-scored questions with an accepted answer from string-typed posts.

    Rows whose whole numbers do not parse are skipped. The cheap filters come before the
    text cleaning, so only surviving bodies are cleaned.
    """
    kept = posts.withColumn("_score", _count_or_zero("Score")).withColumn("_views", _count_or_zero("ViewCount")) \
        .withColumn("_id", _whole("Id")).withColumn("_accepted", _whole("AcceptedAnswerId")) \
        .where((F.col("_score") >= min_score) & F.col("_id").isNotNull() & F.col("_accepted").isNotNull()
               & F.col("_views").isNotNull())
    tags = F.regexp_extract_all(F.coalesce(F.col("Tags"), F.lit("")), F.lit(rules.TAG_LIST), F.lit(1))
    return kept.select(
        F.col("_id").alias("question_id"), tx.clean_html("Title", entities).alias("title"),
        tx.clean_html("Body", entities).alias("body"), F.col("_score").alias("score"),
        F.col("_accepted").alias("accepted_answer_id"), tags.alias("tags"),
        F.col("_views").alias("view_count"), F.coalesce("CreationDate", F.lit("")).alias("creation_date"))


def read_answers(posts: DataFrame, order: str = "AnswerId", entities: str = "all") -> DataFrame:
    """One answer per question: the last by ``order`` (numeric). Winners are chosen without their
    bodies, which are read and cleaned for winners only."""
    numbered = posts.select(_count_or_zero("AnswerId").alias("answer_id"),
                            _count_or_zero("QuestionId").alias("question_id"),
                            _count_or_zero("AnswerScore").alias("score"),
                            _whole(F.col(order).cast("string")).alias("_order"), "AnswerBody") \
        .where((F.col("answer_id") != 0) & (F.col("question_id") != 0) & F.col("score").isNotNull())
    last = first_rows(numbered, ["question_id"], "_order", last=True)
    return last.select("question_id", "answer_id", tx.clean_html("AnswerBody", entities).alias("body"), "score")


def pair_questions_answers(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """Inner join on the question id; both sides have one row per question."""
    a = answers.select("question_id", F.col("body").alias("answer_body"), F.col("score").alias("answer_score"))
    return questions.join(a, "question_id").select(
        "question_id", "title", F.col("body").alias("question_body"), "tags", "score", "view_count",
        "answer_body", "answer_score")


def pair_by_accepted(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """Inner join on the accepted answer; a question listed under several tags counts once."""
    once = first_rows(questions, ["question_id"], "accepted_answer_id")
    a = answers.select(F.col("answer_id").alias("accepted_answer_id"), F.col("body").alias("answer_body"),
                       F.col("score").alias("answer_score"))
    return once.join(a, "accepted_answer_id").select(
        "question_id", "title", F.col("body").alias("question_body"), "tags", "score", "view_count",
        "answer_body", "answer_score")


def _cleaned(pairs: DataFrame) -> DataFrame:
    filled = [(c, F.coalesce(F.col(c), F.lit(""))) for c in ("question_body", "answer_body")]
    present = F.coalesce(F.col("question_id"), F.lit(0)) != 0
    for _, text in filled:
        present = present & (text != "")
    return pairs.where(present).withColumn("_q", tx.clean_text("question_body")) \
        .withColumn("_a", tx.clean_text("answer_body")) \
        .where((F.length("_q") >= rules.MIN_QUESTION_CHARS) & (F.length("_a") >= rules.MIN_ANSWER_CHARS))


def valid_qa(pairs: DataFrame) -> DataFrame:
    return _cleaned(pairs).drop("_q", "_a")


def qa_features(pairs: DataFrame) -> DataFrame:
    """Cleaned texts, names found, type, complexity, metrics and quality per pair."""
    # lower-case texts are columns of their own: every rule reads them, none lowers them again
    staged = _cleaned(pairs).withColumn(
        "_all", F.concat_ws(" ", F.coalesce("title", F.lit("")), F.col("_q"), F.col("_a"))) \
        .withColumn("_low", F.lower("_all")).withColumn("_qlow", F.lower("_q")) \
        .withColumn("_points", tx.quality_points("score", "answer_score", "view_count", "question_body", "answer_body"))
    return staged.select(
        "question_id", tx.clean_text("title").alias("title"), F.col("_q").alias("question_body"),
        F.col("_a").alias("answer_body"), "tags", "score", "answer_score", "view_count",
        tx.error_signatures("_low").alias("error_signatures"), tx.infra_components("_low").alias("infra_components"),
        tx.question_type("_qlow").alias("question_type"), tx.text_complexity("_all").alias("complexity"),
        tx.text_metrics("_q").alias("question_metrics"), tx.text_metrics("_a").alias("answer_metrics"),
        py_round("_points", 2).alias("quality_score"))


def _turn(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def qa_to_chat(qa: DataFrame, system_prompt: str | None = None, weight: str | None = None,
               keep: Sequence[str] = ()) -> DataFrame:
    turns = [_turn("user", F.coalesce("question_body", F.lit(""))),
             _turn("assistant", F.coalesce("answer_body", F.lit("")))]
    if system_prompt is not None:
        turns.insert(0, _turn("system", F.lit(system_prompt)))
    meta = ["question_id", "tags", "error_signatures", "infra_components", "quality_score"]
    if weight:
        meta.append(weight)
    return qa.select(F.array(*turns).alias("messages"), F.struct(*meta).alias("metadata"), *keep)


def qa_to_completion(qa: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    prompt = F.concat(F.lit("### Question\n"), F.coalesce("title", F.lit("")), F.lit("\n\n"),
                      F.coalesce("question_body", F.lit("")), F.lit("\n\nTags: "),
                      F.array_join(F.coalesce(F.col("tags"), F.array().cast("array<string>")), ", "),
                      F.lit("\n\n### Answer\n"))
    return qa.select(prompt.alias("prompt"), F.coalesce("answer_body", F.lit("")).alias("completion"),
                     F.struct("question_id", "quality_score").alias("metadata"), *keep)
