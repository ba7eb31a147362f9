"""Quizzes: assembly, answer slots, grading, diagnosis, checkpoints."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern import fixed_values as V
from lectern.operators.content import Instant, draw_order, live
from lectern.operators.numbering import in_first, positions

HEX = "0123456789abcdef"


def checkpoints(concepts: DataFrame, m: int = V.CONCEPTS_PER_CHECKPOINT, key: str = "deck",
                order_col: str = "slide_no") -> DataFrame:
    """Checkpoint number of each concept: every ``m`` concepts, a single left-over joins the one before."""
    numbered = positions(concepts, [key], [order_col], "_pos", total="_total")
    bucket = F.floor((F.col("_pos") - 1) / m)
    last_alone = (F.col("_total") % m == 1) & (F.col("_total") > 1) & (F.col("_pos") == F.col("_total")) & F.lit(m > 1)
    return numbered.withColumn(
        "checkpoint", (bucket + 1 - F.when(last_alone, 1).otherwise(0)).cast("int")).drop("_pos", "_total")


def assign_slots(questions: DataFrame, quiz: str = "quiz", order_col: str = "question") -> DataFrame:
    """Slot of the right answer: it starts at a place set by the quiz and moves on by one per question,
    so neighbours differ and the slots are used evenly."""
    numbered = positions(questions, [quiz], [order_col], "question_no")
    name = F.coalesce(F.col(quiz).cast("string"), F.lit(""))
    start = F.instr(F.lit(HEX), F.substring(F.md5(name), 1, 1)) - 1
    slot = ((start + F.col("question_no") - 1) % 4).cast("int")
    return numbered.withColumn("answer_slot", F.element_at(F.array(*map(F.lit, "ABCD")), slot + 1))


def _slot_table(slots: Sequence[tuple[str, str]]):
    seen: Counter = Counter()
    rows = []
    for i, (difficulty, label) in enumerate(slots, start=1):
        seen[difficulty] += 1
        rows.append(F.struct(
            F.lit(i).alias("slot"), F.lit(difficulty).alias("difficulty"), F.lit(label).alias("label"),
            F.lit(seen[difficulty]).alias("nth")))
    return F.array(*rows), max(seen.values())


def assemble_quiz(
    problems: DataFrame, as_of: Instant, seed: int = 0, slots: Sequence[tuple[str, str]] = V.QUIZ_SLOTS,
) -> DataFrame:
    """Five slots per live topic, filled with drawn problems of the slot's difficulty, each used once;
    ``short`` marks a slot no problem is left for."""
    table, most = _slot_table(slots)
    bank = live(problems, as_of).select("topic", "difficulty", "problem_id")
    drawn = in_first(bank, ["topic", "difficulty"], draw_order("problem_id", seed), most, "nth")
    wanted = bank.select("topic").distinct().select("topic", F.explode(table).alias("s")).select("topic", "s.*")
    return wanted.join(drawn, ["topic", "difficulty", "nth"], "left").select(
        "topic", "slot", "difficulty", "label", "problem_id", F.col("problem_id").isNull().alias("short"))


def grade(responses: DataFrame, key: DataFrame) -> DataFrame:
    """Verdict per question of the key; an unanswered question is incorrect.

    ``key`` holds quiz, question, answer; ``responses`` quiz, question, given and, if answers can be changed, the
    column ``given_at``. Of several answers to a question the last counts (NULL times first, then the largest text).
    """
    when = F.col("given_at") if "given_at" in responses.columns else F.lit(0)
    last = F.max_by("given", F.struct(when.alias("at"), F.col("given")))
    answered = responses.groupBy("quiz", "question").agg(last.alias("given"))
    return key.join(answered, ["quiz", "question"], "left").withColumn(
        "correct", F.coalesce(F.col("answer") == F.col("given"), F.lit(False)))


def quiz_scores(graded: DataFrame) -> DataFrame:
    return graded.groupBy("quiz").agg(
        F.count("*").alias("questions"),
        F.count("given").alias("answered"),
        F.count_if("correct").alias("correct"),
    )


def diagnostic_questions(problems: DataFrame, as_of: Instant, per_topic: int = V.DIAGNOSTIC_QUESTIONS,
                         seed: int = 0) -> DataFrame:
    """A few drawn questions per live topic."""
    bank = live(problems, as_of).select("topic", "problem_id")
    return in_first(bank, ["topic"], draw_order("problem_id", seed), per_topic, "question_no")


def diagnose(problems: DataFrame, results: DataFrame, as_of: Instant,
             per_topic: int = V.DIAGNOSTIC_QUESTIONS, seed: int = 0) -> DataFrame:
    """Topics by score on the drawn questions, weakest first. ``results`` holds problem_id and correct."""
    asked = diagnostic_questions(problems, as_of, per_topic, seed)
    marks = results.groupBy("problem_id").agg(F.count("*").alias("_tries"), F.count_if("correct").alias("_right"))
    scored = asked.join(marks, "problem_id", "left").groupBy("topic").agg(
        F.count("*").alias("asked"),
        F.coalesce(F.sum("_tries"), F.lit(0)).alias("answers"),
        F.coalesce(F.sum("_right"), F.lit(0)).alias("correct"),
    ).withColumn("score", F.when(F.col("answers") > 0, F.col("correct") / F.col("answers")).otherwise(F.lit(0.0)))
    return positions(scored, [], [F.col("score").asc(), F.col("topic").asc()], "study_place")
