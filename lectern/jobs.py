"""The two whole jobs: extracting decks page by page, and converting files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import fixed_values as V
from lectern.operators import apply as A
from lectern.operators import decks as D
from lectern.session import small_batches, stage
from lectern.sources import files as S


def extract_decks(
    decks: DataFrame, extractors: Sequence[A.Extractor], out: str, start: int = 1, end: int | None = None,
    mode: str = "compat", log: str | None = None, chunks_per_task: int = 1,
) -> DataFrame:
    """Extract the pages of (deck, total_pages) that ``out`` does not hold yet, and append them to it.

    Returns one row per chunk tried: deck, chunk, pages, status, extractor, error, pieces. A failed chunk
    writes nothing and does not stop the others; the next call tries it again. Each answer is published in ``log`` (by
    default beside ``out``) when its task of ``chunks_per_task`` chunks ends, and the log goes when the run is
    through. A run that finds the log of a broken one writes its finished chunks first and repeats no answer. One run
    at a time. To extract a deck anew, clear it from ``out`` first.
    """
    spark = decks.sparkSession
    wanted = D.select_pages(decks, start, end)
    log = log or out.rstrip("/") + "-log"
    shape = wanted.groupBy("deck").agg(F.collect_list("page").alias("pages"))
    answers = A.result_log(shape, log)
    _recover(spark, answers, out, mode)
    todo = D.remaining_pages(wanted, S.written_pages(spark, out)) if S.has_slides(spark, out) else wanted
    chunks = stage(D.plan_chunks(todo), "plan").withColumn(
        "refs", F.transform("pages", lambda p: F.concat(F.col("deck").cast("string"), F.lit("#"), p.cast("string"))))

    def keep(results: DataFrame) -> None:
        done = chunks.select("deck", "chunk", "pages").join(results.filter(F.col("status") == "ok"), ["deck", "chunk"])
        S.write_slides(D.fill_gaps(done, mode), out)

    tried = A.apply_with_fallback(chunks, extractors, log=log, pieces_per_task=chunks_per_task, finished=keep)
    outcome = stage(chunks.select("deck", "chunk", "pages").join(tried, ["deck", "chunk"]), "responses")
    answers.clear()
    return outcome.drop("raw_text")


def _recover(spark: SparkSession, answers: A.ResultLog, out: str, mode: str) -> None:
    """Write the chunks that a broken run finished in its first round and did not hand over."""
    said = answers.said(0)
    if said is None:
        return
    whole = said.filter("status = 'ok'").select("deck", F.col("pages")[0].alias("chunk"), "pages", F.col("text").alias("raw_text"))
    slides = D.fill_gaps(whole, mode)
    if S.has_slides(spark, out):
        written = S.written_pages(spark, out).withColumnRenamed("page", "slide_no")
        slides = slides.join(written, ["deck", "slide_no"], "left_anti")
    S.write_slides(stage(slides, "recovered"), out)


def index_decks(decks: DataFrame, out: str, start: int = 1, end: int | None = None, dpi: int = V.RENDER_DPI) -> DataFrame:
    """Index rows of all decks from what is written, whichever run wrote it."""
    meta = decks.select(
        "deck", "total_pages", F.lit(start).alias("start_page"), F.lit(end).cast("long").alias("end_page"),
        F.lit(dpi).alias("dpi"))
    return D.build_index(S.read_slides(decks.sparkSession, out), meta)


def convert_files(
    files: DataFrame, convert: Callable[[dict], str], out_dir: str | None = None,
    extensions: Sequence[str] = V.DECK_EXTENSIONS, outputs: DataFrame | None = None,
) -> DataFrame:
    """Convert the files (path) of a known suffix whose output is not in ``outputs`` (path).

    ``convert`` gets the row with path and output and returns the path it wrote. The result
    (item, status, output, error) also holds the skipped files with the reason as error.
    """
    checked = D.classify_inputs(files.select("path"), extensions)
    accepted = checked.filter(F.col("status") == "accepted").select("path")
    done = outputs if outputs is not None else files.sparkSession.createDataFrame([], "path string")
    pending = D.pending_conversions(accepted, done, out_dir)
    with small_batches(files.sparkSession, 1):
        converted = stage(A.apply_isolated(pending.withColumnRenamed("path", "item"), convert), "converted")
    skipped = checked.filter(F.col("status") == "skipped").select(
        F.col("path").alias("item"), "status", F.lit(None).cast("string").alias("output"), F.col("reason").alias("error"))
    return converted.unionByName(skipped)


def convert_tree(spark: SparkSession, root: str, convert: Callable[[dict], str], out_dir: str | None = None,
                 extensions: Sequence[str] = V.DECK_EXTENSIONS) -> DataFrame:
    """Convert every deck file below ``root`` that has no converted file yet."""
    found = S.discover_files(spark, root, extensions)
    outputs = S.discover_files(spark, out_dir or root, [".pdf"])
    return convert_files(found, convert, out_dir and _as_listed(spark, out_dir), extensions, outputs)


def _as_listed(spark: SparkSession, folder: str) -> str:
    """The folder as file listings spell it, with its scheme."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.makeQualified(path).toString()


def unfinished(index: DataFrame) -> DataFrame:
    """Decks whose extraction is not complete."""
    return index.filter(~F.col("complete"))

