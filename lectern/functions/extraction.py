"""Extraction columns: time budgets, chunk sizes, prompts, section parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern import fixed_values as V
from lectern.functions.curriculum import filled
from lectern.functions.text import forward_slashes, strip


def time_budget(pages: Column) -> Column:
    """Seconds allowed for a chunk: 30 per page, between 180 and 900."""
    return F.greatest(F.lit(V.MIN_SECONDS), F.least(F.lit(V.MAX_SECONDS), pages * V.SECONDS_PER_PAGE))


def chunk_size(pages: Column, min_chunks: int = V.MIN_CHUNKS, max_pages: int = V.MAX_PAGES_PER_CHUNK) -> Column:
    """Pages per chunk for a deck with that many pages to do."""
    by_cap = F.ceil(pages / max_pages)
    chunks = F.least(F.greatest(F.lit(min_chunks), by_cap), pages)
    return F.ceil(pages / chunks)


def numbers_text(pages: Column) -> Column:
    return F.array_join(pages.cast("array<string>"), ", ")


def _instructions(pages: Column) -> Column:
    return filled(V.EXTRACTION_RULES, numbers=numbers_text(pages))


def inline_prompt(pages: Column, refs: Column) -> Column:
    """Prompt with the files named inline as ``@path``."""
    files = F.array_join(F.transform(refs, lambda r: F.concat(F.lit("@"), forward_slashes(r))), " ")
    opening = filled(V.INLINE_PROMPT, count=F.size(pages).cast("string"), numbers=numbers_text(pages), files=files)
    return F.concat(opening, _instructions(pages))


def listed_prompt(pages: Column, refs: Column) -> Column:
    """Prompt with one line per file."""
    lines = F.zip_with(
        pages, refs,
        lambda p, r: F.concat(F.lit("- "), forward_slashes(r), F.lit("  (this is Slide "), p.cast("string"), F.lit(")")),
    )
    return F.concat(filled(V.LISTED_PROMPT, files=F.array_join(lines, "\n")), _instructions(pages))


def sections(raw: Column, pages: Column, mode: str = "compat") -> Column:
    """Array of (page, text) for the sections whose number is among ``pages``, in order of appearance."""
    pattern = F.lit(V.SECTION[mode])
    found = F.arrays_zip(
        F.regexp_extract_all(raw, pattern, F.lit(1)).alias("number"),
        F.regexp_extract_all(raw, pattern, F.lit(2)).alias("body"),
    )
    typed = F.transform(
        found,
        lambda s: F.struct(s["number"].try_cast("int").alias("page"), strip(s["body"]).alias("text")),
    )
    return F.filter(typed, lambda s: F.array_contains(pages, s["page"]))


def placeholder(pages: Column) -> Column:
    return filled(
        V.PLACEHOLDER,
        first=F.element_at(pages, 1).cast("string"),
        last=F.element_at(pages, -1).cast("string"),
    )
