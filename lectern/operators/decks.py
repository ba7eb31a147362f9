"""Deck extraction as tables: page selection, resume, chunk plans, gap filling, indexes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lectern import fixed_values as V
from lectern.functions import extraction as X
from lectern.functions.curriculum import filled
from lectern.functions import paths as P
from lectern.functions.text import strip
from lectern.operators.numbering import positions
from lectern.session import shuffle_width

PAGES_PER_BLOCK = 4096
ENTRIES_PER_BLOCK = 1000


def select_pages(decks: DataFrame, start: int = 1, end: int | None = None) -> DataFrame:
    """(deck, page) for the requested range; ``end`` is clamped, and none or 0 means the last page.

    Long decks are first cut into page blocks that are spread over the cluster, so neither an array
    nor a task grows with the deck.
    """
    if start < 1:
        raise ValueError("pages are numbered from 1")
    last = F.least(F.lit(end), F.col("total_pages")) if end else F.col("total_pages")
    ranged = decks.select("deck", last.cast("long").alias("_last")).filter(F.col("_last") >= start)
    first_block, step = start // PAGES_PER_BLOCK, F.lit(PAGES_PER_BLOCK)
    blocks = ranged.select(
        "deck", "_last",
        F.explode(F.sequence(F.lit(first_block).cast("long"), F.floor(F.col("_last") / step))).alias("_block"),
    ).repartition(shuffle_width(decks.sparkSession), "deck", "_block")
    low = F.greatest(F.lit(start).cast("long"), F.col("_block") * step)
    high = F.least(F.col("_last"), (F.col("_block") + 1) * step - 1)
    return blocks.select("deck", low.alias("_low"), high.alias("_high")).filter("_low <= _high").select(
        "deck", F.explode(F.sequence(F.col("_low").cast("int"), F.col("_high").cast("int"))).alias("page"),
    )


def remaining_pages(requested: DataFrame, existing: DataFrame) -> DataFrame:
    """Requested pages that are not written yet."""
    return requested.join(existing.select("deck", "page").distinct(), ["deck", "page"], "left_anti")


def plan_chunks(
    pages: DataFrame, min_chunks: int = V.MIN_CHUNKS, max_pages: int = V.MAX_PAGES_PER_CHUNK,
) -> DataFrame:
    """Cut each deck's pages into consecutive chunks of at most ``max_pages``.

    Pages are gathered per (deck, page block), so a row never holds more than one block; the blocks of
    a deck are linked by their sizes alone. Only chunks that cross a block border are put together in
    another shuffle. A deck without a name is a deck; a page without a number is an error.
    """
    blocks = (
        pages.select("deck", F.coalesce(F.col("page").cast("int"), F.raise_error(F.lit("a page has no number")).cast("int")).alias("page"))
        .withColumn("_block", F.expr(f"page div {PAGES_PER_BLOCK}"))
        .groupBy("deck", "_block").agg(F.sort_array(F.collect_set("page")).alias("_held"))
    )
    earlier = Window.partitionBy("deck").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    all_pages = F.sum("_n").over(Window.partitionBy("deck"))
    links = (
        blocks.select("deck", "_block", F.size("_held").alias("_n"))
        .withColumns({"_from": F.coalesce(F.sum("_n").over(earlier), F.lit(0)), "_all": all_pages})
        .select(F.col("deck").alias("_deck"), F.col("_block").alias("_of"), "_from", (F.col("_from") + F.col("_n")).alias("_to"), "_all",
                X.chunk_size(F.col("_all"), min_chunks, max_pages).alias("_size"))
    )
    linked = blocks.join(links, F.col("deck").eqNullSafe(F.col("_deck")) & (F.col("_block") == F.col("_of"))).drop("_deck", "_of")
    whole = _chunk_pieces(linked).filter("size(pages) = expected")
    border = linked.filter("_from % _size <> 0 OR (_to % _size <> 0 AND _to < _all)")
    joined = (
        _chunk_pieces(border).filter("size(pages) < expected")
        .groupBy("deck", "chunk").agg(F.flatten(F.sort_array(F.collect_list("pages"))).alias("pages"))
    )
    return (
        whole.select("deck", "chunk", "pages").unionByName(joined)
        .withColumn("n_pages", F.size("pages"))
        .withColumn("budget_seconds", X.time_budget(F.col("n_pages")))
    )


def _chunk_pieces(linked: DataFrame) -> DataFrame:
    """The part of each chunk that lies in a block. Chunk c holds the pages from c * size on, counted
    over the deck from 0; a block holds those from ``_from`` up to ``_to``."""
    pieces = F.expr("""
        transform(sequence(_from div _size, (_to - 1) div _size), c -> struct(
            CAST(c + 1 AS INT) AS chunk,
            slice(_held, CAST(greatest(c * _size - _from, 0) + 1 AS INT),
                  CAST(least((c + 1) * _size, _to) - greatest(c * _size, _from) AS INT)) AS pages,
            CAST(least((c + 1) * _size, _all) - c * _size AS INT) AS expected))
    """)
    return linked.select("deck", F.inline(pieces))


def with_prompts(chunks: DataFrame, ref_prefix: str = "slide_", ref_suffix: str = ".png") -> DataFrame:
    """Add both prompt texts; page images are named by zero-padded page number."""
    refs = F.transform(
        F.col("pages"),
        lambda p: F.concat(F.lit(ref_prefix), F.lpad(p.cast("string"), F.greatest(F.lit(4), F.length(p.cast("string"))),
                                                     F.lit("0")), F.lit(ref_suffix)),
    )
    return chunks.withColumn("inline_prompt", X.inline_prompt(F.col("pages"), refs)).withColumn(
        "listed_prompt", X.listed_prompt(F.col("pages"), refs))


def parse_sections(responses: DataFrame, mode: str = "compat") -> DataFrame:
    """(deck, chunk, page, text) found in each response; of a repeated page the last text counts.

    A response with text but without any usable section goes to the first page of its chunk. A row
    holds its own response and page list, so nothing is shuffled.
    """
    raw, pages = F.col("raw_text"), F.col("pages")
    found = responses.select("deck", "chunk", "pages", "raw_text", X.sections(raw, pages, mode).alias("_found"))
    whole = F.array(F.struct(F.element_at(pages, 1).alias("page"), strip(raw).alias("text")))
    last_wins = F.filter(
        F.transform(pages, lambda p: F.try_element_at(
            F.filter(F.col("_found"), lambda s: s["page"] == p), F.lit(-1))),
        lambda s: s.isNotNull(),
    )
    chosen = F.when(F.size("_found") > 0, last_wins).when(strip(raw) != "", whole)
    return found.select("deck", "chunk", F.explode(chosen).alias("s")).select("deck", "chunk", "s.page", "s.text")


def fill_gaps(responses: DataFrame, mode: str = "compat") -> DataFrame:
    """One row per requested page: its own section, else the whole response for the first page of the
    chunk, else a note that names the chunk. ``origin`` tells which."""
    raw, pages = F.col("raw_text"), F.col("pages")
    parsed = responses.select(
        "deck", "chunk", "pages", strip(raw).alias("_whole"), X.sections(raw, pages, mode).alias("_found"),
    )
    paged = parsed.select(
        "deck", "chunk", "_whole", X.placeholder(pages).alias("_note"), F.element_at(pages, 1).alias("_first"),
        F.explode(F.transform(pages, lambda p: F.struct(
            p.alias("page"),
            F.try_element_at(F.filter(F.col("_found"), lambda s: s["page"] == p), F.lit(-1))["text"].alias("text"),
        ))).alias("s"),
    )
    is_first = F.col("s.page") == F.col("_first")
    return paged.select(
        "deck", F.col("s.page").alias("slide_no"),
        F.coalesce(F.col("s.text"), F.when(is_first, F.col("_whole")).otherwise(F.col("_note"))).alias("text"),
        F.when(F.col("s.text").isNotNull(), "section").when(is_first, "whole").otherwise("placeholder").alias("origin"),
        "chunk",
    )


def merge_pages(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Unique (deck, page) of two sets."""
    return existing.select("deck", "page").unionByName(new.select("deck", "page")).distinct()


def build_index(slides: DataFrame, meta: DataFrame) -> DataFrame:
    """One row per deck: what was asked for, what is there, and whether that is all of it.

    ``meta`` holds deck, total_pages, start_page, end_page (NULL or 0 for all) and dpi. The page list
    itself is ``index_blocks`` / ``index_lines``, so a deck of any length stays a set of small rows.
    """
    written = slides.select("deck", "slide_no").distinct().groupBy("deck").agg(
        F.count("*").alias("n_extracted"),
        F.min("slide_no").alias("first_slide"),
        F.max("slide_no").alias("last_slide"),
    )
    asked_end = F.coalesce(F.nullif(F.col("end_page"), F.lit(0)), F.col("total_pages"))
    n = F.coalesce(F.col("n_extracted"), F.lit(0))
    return meta.join(written, "deck", "left").select(
        "deck", "total_pages", "start_page", asked_end.alias("end_page"),
        F.least(asked_end, F.col("total_pages")).alias("actual_end"), "dpi",
        n.alias("n_extracted"), "first_slide", "last_slide", (n == F.col("total_pages")).alias("complete"),
    )


def index_blocks(slides: DataFrame, entries: int = ENTRIES_PER_BLOCK) -> DataFrame:
    """Sorted page lists, at most ``entries`` page numbers per row."""
    return (
        slides.select("deck", F.floor(F.col("slide_no") / entries).cast("int").alias("block"), "slide_no").distinct()
        .groupBy("deck", "block").agg(F.sort_array(F.collect_list("slide_no")).alias("slide_nos"))
    )


def index_lines(slides: DataFrame, index: DataFrame) -> DataFrame:
    """The index as text lines (deck, line_no, line): heading, figures, then one line per page."""
    values = {"deck": "deck", "total": "total_pages", "start": "start_page", "end": "end_page", "dpi": "dpi", "extracted": "n_extracted"}
    head = F.array(*[filled(line, **{k: F.col(c).cast("string") for k, c in values.items() if f"{{{k}}}" in line}) for line in V.INDEX_HEAD])
    top = index.select("deck", F.posexplode(head).alias("i", "line")).select(
        "deck", (F.col("i") + 1).cast("long").alias("line_no"), "line")
    pages = slides.select("deck", "slide_no").distinct()
    numbered = positions(pages, ["deck"], ["slide_no"])
    listed = numbered.select(
        "deck", (F.col("pos") + 7).cast("long").alias("line_no"),
        F.concat(F.lit("- "), P.slide_file(F.col("slide_no")), F.lit(" — Slide "),
                 F.col("slide_no").cast("string")).alias("line"),
    )
    return top.unionByName(listed)


def drop_decks(slides: DataFrame, decks: Sequence | DataFrame | None = None) -> DataFrame:
    """Slides left after clearing the named decks, or all of them."""
    if decks is None:
        return slides.filter(F.lit(False))
    if isinstance(decks, DataFrame):
        return slides.join(decks.select("deck").distinct(), "deck", "left_anti")
    return slides.filter(~F.col("deck").isin(list(decks)))


# --- file lists -------------------------------------------------------------------------------

def classify_inputs(files: DataFrame, extensions: Sequence[str] = V.DECK_EXTENSIONS) -> DataFrame:
    """Accept files by lower-cased suffix; the others keep their row and get a reason."""
    known = P.lower_suffix(F.col("path")).isin(list(extensions))
    return files.withColumn("status", F.when(known, "accepted").otherwise("skipped")).withColumn(
        "reason",
        F.when(~known, F.concat(F.lit("Unsupported format '"), P.suffix(F.col("path")), F.lit("'"))),
    )


def pending_conversions(inputs: DataFrame, outputs: DataFrame, out_dir: str | None = None) -> DataFrame:
    """Inputs whose output is missing, with their output path; ``collides`` marks outputs that
    several inputs share."""
    planned = inputs.withColumn("output", P.converted_path(F.col("path"), out_dir))
    shared = (
        planned.groupBy("output").agg(F.count("*").alias("_inputs")).filter(F.col("_inputs") > 1)
        .select("output", F.lit(True).alias("_shared"))
    )
    open_ones = planned.join(outputs.select(F.col("path").alias("output")).distinct(), "output", "left_anti")
    return (
        open_ones.join(shared, "output", "left")
        .withColumn("collides", F.coalesce(F.col("_shared"), F.lit(False))).drop("_shared")
    )


def run_counts(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count_if(F.col("status") == "converted").alias("converted"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )


def run_listing(results: DataFrame) -> DataFrame:
    """Outputs of what was converted, then ``name: error`` for what failed, as sorted rows."""
    good = F.col("status") == "converted"
    return results.select(
        F.when(good, "converted").otherwise("failed").alias("section"),
        F.when(good, F.col("output"))
        .otherwise(F.concat_ws(": ", F.col("item").cast("string"), F.col("error"))).alias("line"),
    ).orderBy("section", "line")
