import random

from pyspark.sql import functions as F
import pytest

from helpers import tuples
from lectern.operators import decks as D
from lectern.sources import files as S


def decks(spark, **totals):
    return spark.createDataFrame(list(totals.items()), "deck string, total_pages long")


@pytest.mark.parametrize("n, sizes", [
    (1, [1]), (4, [1] * 4), (5, [2, 2, 1]), (9, [3, 3, 3]), (81, [17, 17, 17, 17, 13]), (100, [20] * 5)])
def test_chunk_sizes(spark, n, sizes):
    plan = D.plan_chunks(D.select_pages(decks(spark, d=n))).orderBy("chunk").collect()
    assert [r.n_pages for r in plan] == sizes
    assert [p for r in plan for p in r.pages] == list(range(1, n + 1))
    assert [r.chunk for r in plan] == list(range(1, len(sizes) + 1))


def test_long_deck_spans_blocks(spark):
    pages = D.select_pages(decks(spark, hot=20_000, small=3, none=0))
    written = spark.createDataFrame([("hot", p) for p in range(5, 20_001, 3)] + [("small", 2)], "deck string, page int")
    todo = D.remaining_pages(pages, written)
    left = [p for p in range(1, 20_001) if p < 5 or (p - 5) % 3]
    plan = {(r.deck, r.chunk): r.pages for r in D.plan_chunks(todo).collect()}
    hot = [plan[k] for k in sorted(plan) if k[0] == "hot"]
    assert [p for c in hot for p in c] == left
    assert {len(c) for c in hot[:-1]} == {20}
    assert [plan[k] for k in sorted(plan) if k[0] == "small"] == [[1], [3]]


@pytest.mark.parametrize("start, end, pages", [
    (1, None, [1, 2, 3, 4, 5]), (2, 4, [2, 3, 4]), (4, 99, [4, 5]), (1, 0, [1, 2, 3, 4, 5]), (9, None, []), (4, 2, [])])
def test_page_range(spark, start, end, pages):
    got = D.select_pages(decks(spark, d=5), start, end)
    assert sorted(r.page for r in got.collect()) == pages
    with pytest.raises(ValueError):
        D.select_pages(decks(spark, d=5), 0)


def test_range_across_a_block_border(spark):
    got = D.select_pages(decks(spark, d=9000), 4095, 8192)
    assert sorted(r.page for r in got.collect()) == list(range(4095, 8193))


def test_resume_twice_is_empty(spark):
    pages = D.select_pages(decks(spark, a=7, b=30))
    assert D.remaining_pages(pages, pages.unionByName(pages)).isEmpty()


def respond(spark, raw, pages):
    return spark.createDataFrame([("d", 1, pages, raw)], "deck string, chunk int, pages array<int>, raw_text string")


@pytest.mark.parametrize("raw, texts", [
    ("## Slide 3\nC\n## Slide 4\nD", ["C", "D"]),
    ("## Slide 4\nD", ["## Slide 4\nD", "D"]),
    ("## Slide 3\nC", ["C", "NOTE"]),
    (" plain ", ["plain", "NOTE"]),
    ("  ", ["", "NOTE"]),
    ("## Slide 3\nold\n## Slide 3\nnew\n## Slide 7\nx", ["new", "NOTE"]),
])
def test_fill_gaps(spark, raw, texts):
    note = ("[Extracted as part of batch with slides 3-4. See slide 3 for full batch text if parsing failed.]")
    got = D.fill_gaps(respond(spark, raw, [3, 4])).orderBy("slide_no")
    assert [r.text for r in got.collect()] == [note if t == "NOTE" else t for t in texts]


def test_parse_sections(spark):
    assert tuples(D.parse_sections(respond(spark, "## Slide 1\na\n## Slide 1\nb\n## Slide 9\nc", [1, 2]))) == [
        ("d", 1, 1, "b")]
    assert tuples(D.parse_sections(respond(spark, " text ", [1, 2]))) == [("d", 1, 1, "text")]
    assert D.parse_sections(respond(spark, " \n ", [1, 2])).isEmpty()
    assert D.parse_sections(respond(spark, "## Slide 1: t\na", [1]), "strict").count() == 1


def test_filling_needs_no_shuffle(spark):
    plan = D.fill_gaps(respond(spark, "x", [1]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_index(spark):
    slides = spark.createDataFrame([("d", 2), ("d", 1), ("d", 2), ("e", 5)], "deck string, slide_no int")
    meta = spark.createDataFrame(
        [("d", 2, 1, None, 150), ("e", 9, 1, 50, 100), ("f", 4, 1, 0, 150)],
        "deck string, total_pages int, start_page int, end_page int, dpi int")
    index = D.build_index(slides, meta)
    assert tuples(index.select("deck", "end_page", "actual_end", "n_extracted", "complete")) == [
        ("d", 2, 2, 2, True), ("e", 50, 9, 1, False), ("f", 4, 4, 0, False)]
    lines = [r.line for r in D.index_lines(slides, index).filter("deck = 'd'").orderBy("line_no").collect()]
    assert lines == ["# Extracted: d", "- Total pages: 2", "- Extracted range: 1 to 2", "- DPI: 150",
                     "- Slides extracted: 2", "", "## Slide Index", "- slide_0001.md — Slide 1", "- slide_0002.md — Slide 2"]
    assert tuples(D.index_blocks(slides, 2)) == [("d", 0, [1]), ("d", 1, [2]), ("e", 2, [5])]


def test_drop_decks(spark):
    slides = spark.createDataFrame([("a", 1), ("b", 1)], "deck string, slide_no int")
    assert tuples(D.drop_decks(slides, ["a"])) == [("b", 1)]
    assert D.drop_decks(slides).isEmpty()


def test_conversions(spark):
    inputs = spark.createDataFrame([("/a/x.ppt",), ("/a/x.odp",), ("/b/y.pptx",), ("z.pps",)], "path string")
    outputs = spark.createDataFrame([("/b/y.pdf",)], "path string")
    assert tuples(D.pending_conversions(inputs, outputs).select("path", "output", "collides")) == [
        ("/a/x.odp", "/a/x.pdf", True), ("/a/x.ppt", "/a/x.pdf", True), ("z.pps", "z.pdf", False)]
    skipped = D.classify_inputs(spark.createDataFrame([("a.PPT",), ("b.txt",), ("c",)], "path string"))
    assert tuples(skipped.select("path", "status", "reason")) == [
        ("a.PPT", "accepted", None), ("b.txt", "skipped", "Unsupported format '.txt'"),
        ("c", "skipped", "Unsupported format ''")]


def test_discover_files(spark, tmp_path):
    for name in ("b.PPTX", "sub/a.odp", "sub/deeper/c.ppt", "d.pdf", "e.pptx.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"12345")
    found = S.discover_files(spark, str(tmp_path))
    assert [r.path.rsplit("/", 1)[1] for r in found.collect()] == ["b.PPTX", "a.odp", "c.ppt"]
    assert found.agg(F.sum("length")).first()[0] == 15
    assert [r.path.rsplit("/", 1)[1] for r in S.discover_files(spark, str(tmp_path), [".pdf"]).collect()] == ["d.pdf"]
    assert "content" not in found._jdf.queryExecution().executedPlan().toString()


def test_written_slides(spark, tmp_path):
    rng = random.Random(0)
    rows = [("hot" if i % 3 else f"d{i}", i, "t" * rng.randrange(9)) for i in range(300)]
    S.write_slides(spark.createDataFrame(rows, "deck string, slide_no int, text string"), str(tmp_path / "s"))
    back = S.read_slides(spark, str(tmp_path / "s"))
    assert tuples(back.select("deck", "slide_no", "markdown")) == sorted(
        ((d, n, f"## Slide {n}\n\n{t}") for d, n, t in rows), key=repr)
    assert S.written_pages(spark, str(tmp_path / "s")).count() == 300
