"""Page relevance, course maps and first uses of abbreviations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern import fixed_values as V
from lectern.functions.text import LETTER_BREAK, has_word, scannable, strip, words_found
from lectern.operators.numbering import in_first, positions


def tag_relevance(
    slides: DataFrame, include_terms: Sequence[str] = V.INCLUDE_TERMS, skip_terms: Sequence[str] = V.SKIP_TERMS,
) -> DataFrame:
    """Add ``verdict`` and ``reason``. An include term wins over a skip term; a page that only repeats
    the title of its module (column ``module_title``, if there) is skipped; the rest is included."""
    if "module_title" in slides.columns:
        title_only = F.coalesce(strip(F.col("text")) == strip(F.col("module_title")), F.lit(False))
    else:
        title_only = F.lit(False)
    reason = (
        F.when(title_only, "title only").when(has_word(F.col("_scanned"), include_terms), "include term")
        .when(has_word(F.col("_scanned"), skip_terms), "skip term").otherwise("default")
    )
    # A generated column cannot be merged into a later filter, so the texts are searched once.
    scanned = slides.withColumn("_scanned", scannable(F.col("text"))).select(
        *slides.columns, F.explode(F.array(reason)).alias("reason"))
    return scanned.withColumn(
        "verdict", F.when(F.col("reason").isin("title only", "skip term"), "skip").otherwise("include"))


def course_map(tagged: DataFrame) -> DataFrame:
    """Per module: files, included and skipped pages, place in the study order (most included pages
    first) and depth (terciles of included pages). Needs deck, module, verdict."""
    # Two-step distinct: one row per (module, deck) leaves the first step, whatever the deck's size.
    per_deck = tagged.groupBy("module", "deck").agg(
        F.count_if(F.col("verdict") == "include").alias("_in"), F.count_if(F.col("verdict") == "skip").alias("_out"))
    modules = per_deck.groupBy("module").agg(
        F.count("*").alias("files"), F.sum("_in").alias("included"), F.sum("_out").alias("skipped"))
    ranked = positions(modules, [], [F.col("included").desc(), F.col("module").asc()], "place", total="_modules")
    third = F.element_at(F.array(F.lit("deep"), F.lit("medium"), F.lit("light")), _tercile(F.col("place"), F.col("_modules")))
    return ranked.withColumn("depth", third).drop("_modules")


def _tercile(rank: Column, total: Column) -> Column:
    """Third of the ranks a rank falls in; as with ntile, the first thirds take the remainder."""
    base, extra = F.floor(total / 3), total % 3
    first = base + (extra > 0).cast("int")
    second = first + base + (extra > 1).cast("int")
    return F.when(rank <= first, 1).when(rank <= second, 2).otherwise(3)


def module_files(slides: DataFrame) -> DataFrame:
    """Files of each module, one row per file. The pages need not be judged for this, so give them as they are: the two
    names are all that is read."""
    return slides.select("module", "deck").distinct()


def module_key_topics(tagged: DataFrame, terms: Sequence[str] = V.INCLUDE_TERMS) -> DataFrame:
    """Terms found on the included pages of each module, with the pages they are on."""
    return (
        tagged.filter(F.col("verdict") == "include")
        .select("module", F.explode(words_found(scannable(F.col("text")), terms)).alias("key_topic"))
        .groupBy("module", "key_topic").agg(F.count("*").alias("pages"))
    )


def skipped_pages(tagged: DataFrame) -> DataFrame:
    """What was left out, and why."""
    return tagged.filter(F.col("verdict") == "skip").select("module", "deck", "slide_no", "reason")


def head_per_deck(slides: DataFrame, k: int = V.SAMPLE_PAGES) -> DataFrame:
    """First ``k`` pages of each deck. Only deck and number are sorted; the texts are fetched for the chosen pages."""
    chosen = in_first(slides.select("deck", "slide_no"), ["deck"], [F.col("slide_no").asc()], k, "place").drop("place").distinct()
    return slides.join(chosen, ["deck", "slide_no"], "left_semi").select(*slides.columns)


def first_uses(slides: DataFrame, known: Sequence[str] = V.COMMON_ABBREVIATIONS) -> DataFrame:
    """Where each all-capitals word of a course comes first: (course, token, deck, slide_no, position)."""
    # Words are told apart inside the row, so only capitals leave it.
    words = F.filter(
        F.transform(F.split("text", LETTER_BREAK), lambda w, i: F.struct(w.alias("token"), i.alias("position"))),
        lambda w: (F.length(w["token"]) >= 2) & (w["token"] == F.upper(w["token"])) & ~w["token"].isin(list(known)))
    tokens = slides.filter(F.col("text").rlike("[A-Z]{2}")).select("course", "deck", "slide_no", F.explode(words).alias("w")).select(
        "course", "deck", "slide_no", "w.token", "w.position")
    first = F.min(F.struct("deck", "slide_no", "position")).alias("first")
    return tokens.groupBy("course", "token").agg(first).select("course", "token", "first.*")
