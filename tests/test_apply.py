import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from helpers import tuples
from lectern.operators import apply as A
from lectern.operators import decks as D

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def chunk(spark, *page_lists):
    rows = [("d", i, pages, [f"r{p}" for p in pages]) for i, pages in enumerate(page_lists, start=1)]
    return spark.createDataFrame(rows, "deck string, chunk int, pages array<int>, refs array<string>")


def echo(pages, refs, *_):
    return "\n\n".join(f"## Slide {p}\n\n{r}" for p, r in zip(pages, refs))


def times_out_above(n):
    def call(pages, refs, *_):
        if len(pages) > n:
            raise TimeoutError
        return echo(pages, refs)
    return call


def fails(message):
    def call(pages, refs, *_):
        raise RuntimeError(message)
    return call


def result(spark, pages, *extractors):
    return A.apply_with_fallback(chunk(spark, pages), extractors).first()


def test_order_and_retry(spark, tmp_path):
    log = str(tmp_path / "calls")

    def flaky(name, message, good_on):
        def call(pages, refs, *_):
            with open(f"{log}-{name}", "a") as f:
                f.write("x")
            with open(f"{log}-{name}") as f:
                if len(f.read()) == good_on:
                    return echo(pages, refs)
            raise RuntimeError(message)
        return call

    def calls(name):
        with open(f"{log}-{name}") as f:
            return len(f.read())

    # An ordinary error goes on to the next extractor at once; a rate limit is tried three times.
    got = result(spark, [1], A.Extractor("a", flaky("a", "boom", 9)), A.Extractor("b", flaky("b", "429", 9)),
                 A.Extractor("c", flaky("c", "boom", 3), retry="any"))
    assert (got.status, got.extractor, calls("a"), calls("b"), calls("c")) == ("ok", "c", 1, 3, 3)
    got = result(spark, [1], A.Extractor("d", flaky("d", "Quota", 3)))
    assert (got.status, got.raw_text, calls("d")) == ("ok", "## Slide 1\n\nr1", 3)


def test_all_fail(spark):
    got = result(spark, [1, 2], A.Extractor("a", fails("first")), A.Extractor("b", fails("x" * 999)))
    assert (got.status, got.raw_text, got.error) == ("error", None, "x" * 400)
    assert result(spark, [1], A.Extractor("a", lambda p, r, *_: "  ")).error == "Empty response from a"


@pytest.mark.parametrize("n", [1, 2, 7, 20])
def test_halving_keeps_the_text(spark, n):
    pages = list(range(3, 3 + n))
    got = result(spark, pages, A.Extractor("a", times_out_above(max(1, n // 4))))
    assert (got.status, got.raw_text) == ("ok", echo(pages, [f"r{p}" for p in pages]))


def test_halving_stops_after_three_rounds(spark):
    # 20 pages: halves of 10, 5, then 2 and 3. A piece of 3 still times out.
    got = result(spark, list(range(20)), A.Extractor("a", times_out_above(2)), A.Extractor("b", echo))
    assert (got.status, got.pieces, got.error) == ("error", 8, "timeout in a")
    assert result(spark, [1], A.Extractor("a", times_out_above(0))).status == "error"


def test_split_plan(spark):
    pieces = A.split_plan(chunk(spark, list(range(1, 12)), [5])).orderBy("chunk", "path").collect()
    assert [(r.path, r.pages) for r in pieces] == [
        ("LLL", [1]), ("LLR", [2]), ("LRL", [3]), ("LRR", [4, 5]), ("RLL", [6]), ("RLR", [7, 8]), ("RRL", [9]),
        ("RRR", [10, 11]), ("", [5])]


def test_extraction_end_to_end(spark):
    rng = random.Random(3)
    decks = spark.createDataFrame([("hot", 400)] + [(f"d{i}", rng.randrange(1, 30)) for i in range(20)],
                                  "deck string, total_pages long")
    pages = D.select_pages(decks)
    plan = D.plan_chunks(pages).withColumn("refs", F.transform("pages", lambda p: F.concat(F.lit("t"), p.cast("string"))))
    out = A.apply_with_fallback(plan, [A.Extractor("a", times_out_above(6))])
    responses = plan.select("deck", "chunk", "pages").join(out.select("deck", "chunk", "raw_text"), ["deck", "chunk"])
    slides = D.fill_gaps(responses)
    assert tuples(slides.select("deck", "slide_no", "text")) == tuples(
        pages.select("deck", "page", F.concat(F.lit("t"), F.col("page").cast("string"))))


def test_isolated(spark):
    def fn(row):
        if row["n"] == 2:
            raise ValueError("bad two")
        return f"out{row['n']}"

    items = spark.createDataFrame([(f"i{n}", n) for n in range(4)], "item string, n int")
    results = A.apply_isolated(items, fn)
    assert tuples(results) == [("i0", "converted", "out0", None), ("i1", "converted", "out1", None),
                               ("i2", "failed", None, "bad two"), ("i3", "converted", "out3", None)]
    assert tuples(D.run_counts(results)) == [(3, 1)]
    assert [tuple(r) for r in D.run_listing(results).collect()] == [
        ("converted", "out0"), ("converted", "out1"), ("converted", "out3"), ("failed", "i2: bad two")]


def test_pieces_get_their_own_prompt_and_budget(spark):
    def call(pages, refs, prompt, budget):
        if len(pages) > 10:
            raise TimeoutError
        return f"{budget} {prompt.count('- ')} {prompt.count('@')}"

    got = result(spark, list(range(1, 21)), A.Extractor("a", call, prompt="listed"))
    assert got.raw_text == "300 10 0\n\n300 10 0"
    assert result(spark, [1, 2], A.Extractor("a", call)).raw_text == "180 0 2"


def test_finished_chunks_are_handed_over_each_round(spark):
    seen = []
    out = A.apply_with_fallback(chunk(spark, list(range(8)), [9]), [A.Extractor("a", times_out_above(4))],
                                finished=lambda df: seen.append(sorted(r["chunk"] for r in df.collect())))
    assert seen == [[2], [1]] and out.count() == 2
