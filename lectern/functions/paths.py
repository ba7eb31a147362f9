"""File names: stem, suffix, output paths, slide numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def parent(path: Column) -> Column:
    """Everything before the last slash; empty without one."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def suffix(path: Column) -> Column:
    """Last dotted part of the name with its dot, or empty. A leading dot does not start a suffix."""
    return F.regexp_extract(path, r"[^/](\.[^./]+)$", 1)


def lower_suffix(path: Column) -> Column:
    return F.lower(suffix(path))


def stem(path: Column) -> Column:
    name = base_name(path)
    return F.substring(name, F.lit(1), F.length(name) - F.length(suffix(path)))


def converted_path(path: Column, out_dir: str | None = None) -> Column:
    """Where the converted file goes: ``<dir>/<stem>.pdf``."""
    name = F.concat(stem(path), F.lit(".pdf"))
    if out_dir:
        return F.concat(F.lit(out_dir.rstrip("/") + "/"), name)
    folder = parent(path)
    return F.when(path.contains("/"), F.concat(folder, F.lit("/"), name)).otherwise(name)


def extraction_dir(path: Column) -> Column:
    """Where the pages of a deck go: ``<dir>/<stem>_extracted``."""
    name = F.concat(stem(path), F.lit("_extracted"))
    return F.when(path.contains("/"), F.concat(parent(path), F.lit("/"), name)).otherwise(name)


def slide_file(number: Column) -> Column:
    """``slide_0007.md``; numbers past 9999 widen."""
    digits = number.cast("string")
    return F.concat(F.lit("slide_"), F.repeat(F.lit("0"), F.greatest(F.lit(0), F.lit(4) - F.length(digits))),
                    digits, F.lit(".md"))


def slide_number(name: Column) -> Column:
    """Number in a slide file name, NULL for any other name."""
    return F.regexp_extract(name, r"^slide_(\d+)\.md$", 1).try_cast("int")


def slide_markdown(number: Column, text: Column) -> Column:
    return F.concat(F.lit("## Slide "), number.cast("string"), F.lit("\n\n"), text)
