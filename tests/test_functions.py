from pyspark.sql import functions as F
import pytest

from lectern import fixed_values as V
from lectern.functions import curriculum as G
from lectern.functions import extraction as X
from lectern.functions import paths as P
from lectern.functions import text as T


def values(spark, rows, build):
    df = spark.createDataFrame([(r,) for r in rows], "x string")
    return [r[0] for r in df.select(build(F.col("x"))).collect()]


def test_whitespace_is_what_python_strips():
    assert sorted(V.WHITESPACE) == sorted(chr(c) for c in range(0x110000) if chr(c).isspace())


def test_strip(spark):
    texts = ["\n a b\t", "\xa0x　", "\x1cy\x1f", "  ", "", "é "]
    assert values(spark, texts, T.strip) == [t.strip() for t in texts]


STORED = ["Optics", "optics", "ÉCOLE", "a_b", "axb", "a\\b"]


@pytest.mark.parametrize("text, hits", [
    ("OPTICS", ["Optics", "optics"]), ("école", []), ("a_b", ["a_b", "axb", "a\\b"]), ("a\\b", ["a\\b"]),
    ("", STORED), ("%", STORED), ("COLE", ["ÉCOLE"]), ("É", ["ÉCOLE"]), ("o%s", ["Optics", "optics"]),
])
def test_topic_matches(spark, text, hits):
    df = spark.createDataFrame([(s,) for s in STORED], "topic string")
    assert [r[0] for r in df.filter(T.topic_matches(F.col("topic"), text)).collect()] == hits


def test_topic_matches_like_sqlite(spark):
    import sqlite3

    con = sqlite3.connect(":memory:")
    con.execute("CREATE TABLE t (topic TEXT)")
    stored = STORED + ["100%", "line\nbreak", "Z", "zz%z", "\\", "ß", "ẞ", "K"]
    con.executemany("INSERT INTO t VALUES (?)", [(s,) for s in stored])
    df = spark.createDataFrame([(s,) for s in stored], "topic string")
    for text in ["e\nb", "z", "_", "__", "\\", "%\\%", "k", "ss", "ß", "0%", "É_"]:
        expected = [r[0] for r in con.execute("SELECT topic FROM t WHERE topic LIKE ?", (f"%{text}%",))]
        assert [r[0] for r in df.filter(T.topic_matches(F.col("topic"), text)).collect()] == expected, text


def test_defaults(spark):
    assert values(spark, [None, "", "x"], lambda c: T.or_default(c, V.MISSING)) == ["N/A", "N/A", "x"]


def test_rate_limits(spark):
    texts = ["HTTP 429", "Rate Limit hit", "QUOTA", "RESOURCE_EXHAUSTED", "resource exhausted", "Too many requests",
             "rate-limit", "boom"]
    assert values(spark, texts, T.is_rate_limited) == [True] * 6 + [False] * 2


def test_truncation_and_slashes(spark):
    assert values(spark, ["x" * 500], T.truncated) == ["x" * 400]
    assert values(spark, ["a\\b/c"], T.forward_slashes) == ["a/b/c"]


PATHS = ["/a/b/Deck.PPTX", "deck.v2.ppt", "/a/.hidden", "/a/none", "/x.y/z", "/a/b.c.d"]


def test_paths(spark):
    from pathlib import PurePosixPath

    pure = [PurePosixPath(p) for p in PATHS]
    assert values(spark, PATHS, P.suffix) == [p.suffix for p in pure]
    assert values(spark, PATHS, P.stem) == [p.stem for p in pure]
    assert values(spark, PATHS, P.converted_path) == [str(p.parent / (p.stem + ".pdf")) for p in pure]
    assert values(spark, PATHS, lambda c: P.converted_path(c, "/o")) == [f"/o/{p.stem}.pdf" for p in pure]
    assert values(spark, PATHS, P.extraction_dir) == [str(p.parent / (p.stem + "_extracted")) for p in pure]


def test_slide_files(spark):
    df = spark.createDataFrame([(1,), (9999,), (12345,)], "n int")
    assert [r[0] for r in df.select(P.slide_file(F.col("n"))).collect()] == [
        "slide_0001.md", "slide_9999.md", "slide_12345.md"]
    names = ["slide_0007.md", "slide_12345.md", "slide_x.md", "slide_1.md.bak", "index.md", "aslide_1.md",
             "slide_99999999999.md"]
    assert values(spark, names, P.slide_number) == [7, 12345, None, None, None, None, None]


def test_weights(spark):
    assert values(spark, ["~5%", "5", "none"], G.weight) == [5, 5, None]
    heads = ["Mechanics (Total: ~28–32% of Mains, ~25% of Advanced)", "X (Total: ~25%)", "Y (Total: ~8-10%)",
             "Z (Total: ~25% of Mains, ~30–40% of Advanced)", "none"]
    assert [tuple(r) if r else r for r in values(spark, heads, G.weight_range)] == [
        (28, 32), (25, 25), (8, 10), (25, 25), (None, None)]


def test_tiers(spark):
    assert values(spark, ["🔴", " 🟠 ", "🟡", "🟢", "?"], G.tier) == ["CRITICAL", "HIGH", "MEDIUM", "LOW", None]
    assert values(spark, ["CRITICAL", "LOW", None, "?"], G.tier_rank) == [1, 4, 5, 5]


def test_arrow_items(spark):
    texts = ["A → B", "A (x → y) → C", "A (p, q → r) → B (s) → D (t → u)", "one"]
    assert values(spark, texts, G.arrow_items) == [
        ["A", "B"], ["A (x → y)", "C"], ["A (p, q → r)", "B (s)", "D (t → u)"], ["one"]]


def test_budgets_and_chunk_sizes(spark):
    df = spark.createDataFrame([(n,) for n in (1, 6, 7, 30, 31)], "n int")
    assert [r[0] for r in df.select(X.time_budget(F.col("n"))).collect()] == [180, 180, 210, 900, 900]


def sections(spark, raw, pages, mode="compat"):
    df = spark.createDataFrame([(raw, pages)], "raw string, pages array<int>")
    return [tuple(s) for s in df.select(X.sections(F.col("raw"), F.col("pages"), mode)).first()[0]]


@pytest.mark.parametrize("raw, expected", [
    ("## Slide 1\n\nA\n\n## Slide 2\n\nB\n", [(1, "A"), (2, "B")]),
    ("## slide  1 \nA", [(1, "A")]),
    # A heading with a title ends the section before it and opens none.
    ("## Slide 1\nA\n## Slide 2: Intro\nlost\n## Slide 3\nC", [(1, "A"), (3, "C")]),
    # A deeper heading opens a section but does not end one.
    ("### Slide 1\nA\n### Slide 2\nB", [(1, "A\n### Slide 2\nB")]),
    # An empty section takes in the one that follows.
    ("## Slide 1\n\n## Slide 2\nB\n## Slide 3\nC", [(1, "## Slide 2\nB"), (3, "C")]),
    ("## Slide 9\nX\n## Slide 2\nB", [(2, "B")]),
    ("## Slide 1\nfirst\n## Slide 1\nsecond", [(1, "first"), (1, "second")]),
    ("no headings", []),
    ("intro ## Slide 1\nA", [(1, "A")]),
])
def test_sections(spark, raw, expected):
    assert sections(spark, raw, [1, 2, 3]) == expected


@pytest.mark.parametrize("raw, expected", [
    ("## Slide 1\n\nA\n\n## Slide 2\n\nB\n", [(1, "A"), (2, "B")]),
    ("## Slide 1\nA\n## Slide 2: Intro\nkept", [(1, "A\n## Slide 2: Intro\nkept")]),
    ("### Slide 1\nA\n## Slide 2\nB", [(2, "B")]),
    ("## Slide 1\n\n## Slide 2\nB", [(1, ""), (2, "B")]),
    ("## Slide 1\n## Slide 2\nB", [(1, ""), (2, "B")]),
    ("## Slide 1", [(1, "")]),
])
def test_strict_sections(spark, raw, expected):
    assert sections(spark, raw, [1, 2, 3], "strict") == expected


def test_prompts(spark):
    df = spark.createDataFrame([([3, 4], ["a b\\s3.png", "s4.png"])], "pages array<int>, refs array<string>")
    inline, listed = df.select(
        X.inline_prompt(F.col("pages"), F.col("refs")), X.listed_prompt(F.col("pages"), F.col("refs"))).first()
    assert inline.startswith("These are 2 lecture slides (slides 3, 4): @a b/s3.png @s4.png For each slide output")
    assert inline.endswith("Output sections for slides: 3, 4. Do not skip or merge any slide.")
    assert "\n- a b/s3.png  (this is Slide 3)\n- s4.png  (this is Slide 4)\n\nFor each slide" in listed
