import os
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from helpers import tuples
from lectern import jobs
from lectern.operators import apply as A
from lectern.operators import decks as D
from lectern.sources import files as S

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def reader(bad=()):
    def call(pages, refs, *_):
        if set(pages) & set(bad):
            raise ValueError("bad page")
        return "\n\n".join(f"## Slide {p}\n\ntext of {r}" for p, r in zip(pages, refs))
    return A.Extractor("reader", call)


def test_extraction_resumes(spark, tmp_path):
    out = str(tmp_path / "slides")
    decks = spark.createDataFrame([("a", 9), ("b", 50)], "deck string, total_pages long")
    first = jobs.extract_decks(decks, [reader(bad=[9, 20])], out)
    assert dict(tuples(first.groupBy("status").count())) == {"ok": 4, "error": 3}
    index = jobs.index_decks(decks, out)
    assert tuples(jobs.unfinished(index).select("deck", "n_extracted")) == [("a", 6), ("b", 24)]
    second = jobs.extract_decks(decks, [reader()], out)
    assert sorted(p for r in second.collect() for p in r.pages) == sorted([7, 8, 9, *range(1, 27)])
    assert jobs.unfinished(jobs.index_decks(decks, out)).isEmpty()
    assert jobs.extract_decks(decks, [reader()], out).isEmpty()
    slides = S.read_slides(spark, out)
    assert slides.count() == 59
    assert slides.filter(F.col("text") != F.concat(F.lit("text of "), "deck", F.lit("#"), "slide_no")).isEmpty()


def test_a_broken_run_keeps_what_its_rounds_finished(spark, tmp_path):
    out, log = str(tmp_path / "slides"), str(tmp_path / "calls")

    def breaking(pages, refs, *_):
        if len(pages) > 10:
            raise TimeoutError
        if len(pages) > 5:
            raise SystemExit("the machine is gone")
        return "\n\n".join(f"## Slide {p}\n\nx" for p in pages)

    def logged(pages, refs, *_):
        with open(log, "a") as f:
            f.write(" ".join(refs) + " ")
        return "\n\n".join(f"## Slide {p}\n\nx" for p in pages)

    decks = spark.createDataFrame([("a", 4), ("b", 80)], "deck string, total_pages long")
    with pytest.raises(Exception):
        jobs.extract_decks(decks, [A.Extractor("breaking", breaking)], out)
    assert {r["deck"] for r in S.written_pages(spark, out).collect()} == {"a"}
    jobs.extract_decks(decks, [A.Extractor("logged", logged)], out)
    with open(log) as f:
        assert {ref.split("#")[0] for ref in f.read().split()} == {"b"}
    assert jobs.unfinished(jobs.index_decks(decks, out)).isEmpty()


def test_a_run_killed_in_its_first_round_repeats_no_finished_chunk(spark, tmp_path):
    out, log = str(tmp_path / "slides"), tmp_path / "calls"
    log.mkdir()

    def call(pages, refs, *_):
        if len(pages) > 7:
            raise TimeoutError
        with open(log / refs[0].replace("#", "-"), "a") as f:
            f.write("x")
        return "\n\n".join(f"## Slide {p}\n\n{r}" for p, r in zip(pages, refs))

    def dying(pages, refs, *_):
        if refs[0].startswith("bad"):
            time.sleep(6)
            raise SystemExit("the machine is gone")
        return call(pages, refs)

    decks = spark.createDataFrame([("bad", 2), ("split", 60)] + [(f"d{i}", 5) for i in range(12)], "deck string, total_pages long")
    with pytest.raises(Exception):
        jobs.extract_decks(decks, [A.Extractor("a", dying)], out)
    first = set(os.listdir(log))
    assert len(first) > 12 and not os.path.exists(out)
    jobs.extract_decks(decks, [A.Extractor("a", call)], out)
    assert all((log / name).read_text() == "x" for name in os.listdir(log)) and set(os.listdir(log)) > first
    assert jobs.unfinished(jobs.index_decks(decks, out)).isEmpty() and not os.path.exists(f"{out}-log")
    slides = S.read_slides(spark, out)
    assert slides.count() == 122 and slides.filter(F.col("text") != F.concat("deck", F.lit("#"), "slide_no")).isEmpty()
    assert slides.select("deck", "slide_no").distinct().count() == 122


def test_tree_conversion(spark, tmp_path):
    for name in ("a.ppt", "sub/b.PPTX", "sub/c.odp", "sub/c.pdf", "bad.pps", "notes.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x")

    def convert(row):
        if "bad" in row["item"]:
            raise RuntimeError("cannot open")
        with open(row["output"].removeprefix("file:"), "w") as f:
            f.write("pdf")
        return row["output"]

    results = jobs.convert_tree(spark, str(tmp_path), convert)
    assert tuples(results.select(F.element_at(F.split("item", "/"), -1), "status", "error")) == [
        ("a.ppt", "converted", None), ("b.PPTX", "converted", None), ("bad.pps", "failed", "cannot open")]
    assert os.path.exists(tmp_path / "sub" / "b.pdf")
    assert tuples(D.run_counts(results)) == [(2, 1)]
    assert [r.status for r in jobs.convert_tree(spark, str(tmp_path), convert).collect()] == ["failed"]
    (tmp_path / "out").mkdir()
    elsewhere = jobs.convert_tree(spark, str(tmp_path), convert, str(tmp_path / "out"))
    assert sorted(os.listdir(tmp_path / "out")) == ["a.pdf", "b.pdf", "c.pdf"] and elsewhere.count() == 4
    listed = spark.createDataFrame([("x.txt",), ("y.ppt",)], "path string")
    assert tuples(jobs.convert_files(listed, lambda row: row["output"]).select("item", "status", "output")) == [
        ("x.txt", "skipped", None), ("y.ppt", "converted", "y.pdf")]
