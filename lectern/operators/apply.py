"""Running user-supplied Python callables over a table: isolated items, and chunks with fallback."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import lectern
from lectern.fixed_values import ERROR_CHARS, MAX_ATTEMPTS, MAX_SPLIT_DEPTH, RATE_LIMIT_MARKERS
from lectern.functions import extraction as X
from lectern.operators.numbering import assign_ids
from lectern.session import path_exists, remove_folder, scratch_path, shuffle_width, stage

# Executors need not have this package: what runs there travels with the task.
cloudpickle.register_pickle_by_value(lectern)


@dataclass(frozen=True)
class Extractor:
    """``call(pages, refs, prompt, budget_seconds)`` returns text, raises ``TimeoutError`` to ask for smaller
    chunks, or fails.

    The prompt names the files ``inline`` or ``listed`` one a line; prompt and budget are those of the piece that
    is tried, so halves get their own. ``retry`` is ``"rate_limit"`` (only such errors are tried again) or
    ``"any"``. Waiting between attempts is up to the callable.
    """

    name: str
    call: Callable[[list[int], list[str], str, int], str]
    retry: str = "rate_limit"
    prompt: str = "inline"


def _worth_retrying(extractor: Extractor, message: str) -> bool:
    if extractor.retry == "any":
        return True
    lowered = message.lower()
    return any(marker in lowered for marker in RATE_LIMIT_MARKERS)


def _first_success(extractors: Sequence[Extractor], pages: list[int], refs: list[str], prompts: dict[str, str],
                   budget: int, attempts: int):
    """(status, text, extractor, error) after trying the extractors in order."""
    error = "no extractor given"
    for extractor in extractors:
        for attempt in range(attempts):
            try:
                text = (extractor.call(pages, refs, prompts[extractor.prompt], budget) or "").strip()
                if not text:
                    raise RuntimeError(f"Empty response from {extractor.name}")
                return "ok", text, extractor.name, None
            except TimeoutError:
                return "timeout", None, extractor.name, f"timeout in {extractor.name}"
            except Exception as exc:  # a failing callable must not end the job
                error = (str(exc) or type(exc).__name__)[: ERROR_CHARS]
                if attempt + 1 == attempts or not _worth_retrying(extractor, error):
                    break
    return "error", None, None, error


def _halves(pieces: DataFrame) -> DataFrame:
    """Both halves of each piece, the left one taking the smaller part of an odd length; a single page
    stays as it is."""
    n = F.size("pages")
    mid = F.floor(n / 2).cast("int")

    def part(side: str, at, length):
        return F.struct(F.lit(side).alias("side"), at.cast("int").alias("at"), length.cast("int").alias("len"))

    two = F.array(part("L", F.lit(1), mid), part("R", mid + 1, n - mid))
    one = F.array(part("", F.lit(1), n))
    cut = pieces.withColumn("_s", F.explode(F.when(n > 1, two).otherwise(one)))
    arrays = [c for c in ("pages", "refs") if c in pieces.columns]
    return cut.withColumns({
        "path": F.concat("path", F.col("_s.side")),
        **{c: F.slice(c, F.col("_s.at"), F.col("_s.len")) for c in arrays},
    }).drop("_s")


def split_plan(chunks: DataFrame, depth: int = MAX_SPLIT_DEPTH) -> DataFrame:
    """Pieces of each chunk if every try timed out: halved ``depth`` times, single pages left whole."""
    pieces = chunks.withColumn("path", F.lit(""))
    for _ in range(depth):
        pieces = _halves(pieces)
    return pieces


#: Each task publishes its file when it ends, not when the job ends, so a broken job keeps what its tasks finished.
_PUBLISH_BY_TASK = ("mapreduce.fileoutputcommitter.algorithm.version", "2")
_TASKS_PER_JOB = 20_000


class ResultLog:
    """What the extractors said, as files below ``path``: one folder per round, and in it one per job.

    Every row is published when the task that made it ends, by the rename of one file, and a task that is tried again
    writes the same file. A piece is known by deck and pages, so a later run finds it whatever number its chunk has.
    Only texts and timeouts count as said; a failure is tried again. The file system's committer must publish a task's
    files at its end, as those of local and HDFS paths do.
    """

    def __init__(self, spark: SparkSession, path: str, shape: str):
        self.spark, self.path, self.shape = spark, path.rstrip("/"), shape

    def round(self, depth: int) -> DataFrame | None:
        """(deck, pages, status, text, extractor, error) of one round, a row per piece; None if nothing is written."""
        folder = f"{self.path}/round={depth}"
        if not path_exists(self.spark, folder):
            return None
        rows = self.spark.read.schema(self.shape).option("recursiveFileLookup", "true").parquet(folder)
        answer = [F.col(c) for c in ("status", "text", "extractor", "error")]
        # A failure of a broken run may stand beside the answer that a later one got.
        best = rows.groupBy("deck", "pages").agg(F.min_by(F.struct(*answer), F.col("status") == "error").alias("_best"))
        return best.select("deck", "pages", "_best.*")

    def said(self, depth: int) -> DataFrame | None:
        rows = self.round(depth)
        return None if rows is None else rows.filter(F.col("status") != "error")

    def add(self, rows: DataFrame, depth: int) -> None:
        rows.write.option(*_PUBLISH_BY_TASK).parquet(f"{self.path}/round={depth}/{uuid.uuid4().hex}")

    def clear(self) -> None:
        remove_folder(self.spark, self.path)


def result_log(chunks: DataFrame, path: str) -> ResultLog:
    """The log at ``path`` for chunks of this kind."""
    names = {f.name: f.dataType.simpleString() for f in chunks.schema}
    return ResultLog(chunks.sparkSession, path, f"deck {names['deck']}, pages {names['pages']}, status string, text string, "
                                                "extractor string, error string")


def apply_with_fallback(
    chunks: DataFrame, extractors: Sequence[Extractor], max_rounds: int = MAX_SPLIT_DEPTH,
    attempts: int = MAX_ATTEMPTS, log: str | None = None, pieces_per_task: int = 1,
    finished: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Run the extractors over (deck, chunk, pages, refs); one result row per chunk.

    A timeout ends the try and the piece is halved for the next round, up to ``max_rounds`` times. What an extractor
    says is published in the ``log`` (a folder; a fresh one if not given) as soon as its task ends, and a task takes
    ``pieces_per_task`` pieces. A run with the log of a broken one asks only for what is not there. After each round
    ``finished`` gets the result rows of the chunks that have no piece left to try. Pieces of the same deck and pages
    are tried once.
    """
    spark = chunks.sparkSession
    shape = stage(chunks.select("deck", "chunk", "pages", "refs", F.lit("").alias("path")), "chunks")
    kept = result_log(chunks, log or scratch_path(spark, "extraction-log"))
    tried = list(extractors)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pages = [[int(p) for p in row] for row in batch["pages"]]
            refs = [list(row) for row in batch["refs"]]
            prompts = [{"inline": a, "listed": b} for a, b in zip(batch["_inline"], batch["_listed"])]
            results = [_first_success(tried, *row, attempts) for row in zip(pages, refs, prompts, batch["_budget"].map(int))]
            batch = batch[["deck"]].assign(pages=pages)
            for i, name in enumerate(("status", "text", "extractor", "error")):
                batch[name] = pd.Series([r[i] for r in results], index=batch.index, dtype=object)
            yield batch

    def say(pieces: DataFrame, depth: int) -> None:
        numbered = assign_ids(pieces.dropDuplicates(["deck", "pages"]), "_at", 0)
        count = numbered.count()
        tasks = -(-count // pieces_per_task)
        for first in range(0, tasks, _TASKS_PER_JOB):
            last = min(first + _TASKS_PER_JOB, tasks)
            task = F.expr(f"cast(_at div {pieces_per_task} as int)")
            some = numbered.withColumn("_task", task).filter(F.col("_task").between(first, last - 1))
            asked = some.repartitionById(last - first, F.col("_task") - first).select(
                "deck", "pages", "refs", X.inline_prompt(F.col("pages"), F.col("refs")).alias("_inline"),
                X.listed_prompt(F.col("pages"), F.col("refs")).alias("_listed"), X.time_budget(F.size("pages")).alias("_budget"))
            kept.add(asked.mapInPandas(run, kept.shape), depth)

    pending, settled = shape, None
    for depth in range(max_rounds + 1):
        before = kept.said(depth)
        say(pending if before is None else pending.join(before, ["deck", "pages"], "left_anti"), depth)
        answers = kept.round(depth)
        if answers is None:
            outcome = pending.select(*[pending[c] for c in shape.columns], *[F.lit(None).cast("string").alias(c) for c in (
                "status", "text", "extractor", "error")])
        else:
            outcome = pending.join(answers, ["deck", "pages"]).select(*shape.columns, "status", "text", "extractor", "error")
        splittable = (F.col("status") == "timeout") & (F.size("pages") > 1) & F.lit(depth < max_rounds)
        final = outcome.filter(~splittable).drop("pages", "refs")
        settled = final if settled is None else settled.unionByName(final)
        timed_out = stage(outcome.filter(splittable).select(*shape.columns), "timed-out")
        pending = _halves(timed_out)
        if finished:
            # A chunk that ends in this round had a piece in it.
            ended = outcome.select("deck", "chunk").distinct().join(timed_out.select("deck", "chunk"), ["deck", "chunk"], "left_anti")
            finished(_assembled(settled.join(ended, ["deck", "chunk"], "left_semi")))
        if timed_out.isEmpty():
            break
    return _assembled(settled)


def _assembled(settled: DataFrame) -> DataFrame:
    """One row per chunk out of its pieces."""
    by_path = F.sort_array(F.collect_list(F.struct("path", "text", "extractor")))
    failed = F.count_if(F.col("status") != "ok") > 0
    return settled.groupBy("deck", "chunk").agg(
        by_path.alias("_pieces"),
        failed.alias("_failed"),
        F.min_by("error", F.when(F.col("status") != "ok", F.col("path"))).alias("_error"),
    ).select(
        "deck", "chunk",
        F.when(F.col("_failed"), "error").otherwise("ok").alias("status"),
        F.when(~F.col("_failed"), F.array_join(F.col("_pieces.text"), "\n\n")).alias("raw_text"),
        F.when(~F.col("_failed"), F.array_join(F.array_distinct(F.col("_pieces.extractor")), ",")).alias("extractor"),
        F.when(F.col("_failed"), F.col("_error")).alias("error"),
        F.size("_pieces").alias("pieces"),
    )


def apply_isolated(items: DataFrame, fn: Callable[[dict], str], item_col: str = "item",
                   parallelism: int | None = None) -> DataFrame:
    """Run ``fn`` on each row; an exception becomes a failed row and the others go on.

    The items are spread over the cluster first, as ``fn`` is taken to be slow. Write the result out
    before using it twice, or Spark may run ``fn`` again.
    """
    item_type = items.schema[item_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.to_dict("records"):
                try:
                    rows.append((row[item_col], "converted", fn(row), None))
                except Exception as exc:  # the failure is the result of this item
                    rows.append((row[item_col], "failed", None, str(exc)[: ERROR_CHARS]))
            yield pd.DataFrame(rows, columns=["item", "status", "output", "error"])

    spread = items.repartition(parallelism or shuffle_width(items.sparkSession), item_col)
    return spread.mapInPandas(run, f"item {item_type}, status string, output string, error string")
