import random

import pytest
from pyspark.sql import functions as F

from helpers import tuples
from lectern import schemas
from lectern.operators import curriculum as U
from lectern.operators import quiz as Q
from lectern.operators import relevance as R
from lectern.operators.prerequisites import prerequisite_levels
from lectern.sources import guide

GUIDE = """# A guide

## How to read this

| Topic | Mains Weightage | Advanced | Priority | Notes |
|---|---|---|---|---|
| Stray | ~9% | High | 🔴 | no section |

## GEOLOGY

### Rocks (Total: ~8–10% of one exam, ~25% of another)

| Topic | Mains Weightage | Advanced | Priority | Notes |
|---|---|---|---|---|
| Basalt (dark) | ~5% | Very High | 🔴 | a; b |
| Chalk | ~3% | Low | 🟢 | soft |

### Rivers (Total: ~4%)

| Topic | Mains Weightage | Advanced | Priority | Notes |
|---|:-:|---|---|---|
| Deltas | ~4% | Medium | 🟠 | |

## Order

### Phase 1 — first
**Geology:** Rocks (Basalt → Chalk) → Deltas

### Phase 2
**Geology:** Rivers

## Differences

| Aspect | One | Other |
|---|---|---|
| Format | a | b |
"""


@pytest.fixture(scope="module")
def guide_path(tmp_path_factory):
    path = tmp_path_factory.mktemp("guide")
    (path / "one.md").write_text(GUIDE, encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("block", [3, 4096])
def test_guide(spark, guide_path, monkeypatch, block):
    monkeypatch.setattr(guide, "LINES_PER_BLOCK", block)
    assert tuples(guide.load_syllabus(spark, guide_path)) == [
        ("Geology", "Rivers", "Deltas", 4, "Medium", "HIGH", ""),
        ("Geology", "Rocks", "Basalt (dark)", 5, "Very High", "CRITICAL", "a; b"),
        ("Geology", "Rocks", "Chalk", 3, "Low", "LOW", "soft")]
    assert tuples(guide.load_section_totals(spark, guide_path)) == [
        ("Geology", "Rivers", 4, 4), ("Geology", "Rocks", 8, 10)]
    assert tuples(guide.load_study_order(spark, guide_path)) == [
        (1, "Geology", 1, "Rocks (Basalt → Chalk)"), (1, "Geology", 2, "Deltas"), (2, "Geology", 1, "Rivers")]


def test_a_large_guide_is_read_by_many_tasks(spark, tmp_path):
    """Sections go on over the borders of splits; empty lines and lone carriage returns change nothing."""
    lines, expected = ["# Guide"], []
    for s in range(40):
        lines += [f"## SUBJECT {s // 8}", "", f"### Section {s} (Total: ~5%)", "", *[""] * (s % 3)]
        for n in range(60):
            lines += [f"| Topic {s}-{n} | ~{n % 9 + 1}% | Low | 🟢 | note \r {n} |\r", *[""] * (n % 5 == 0)]
            expected.append((f"Subject {s // 8}", f"Section {s}", f"Topic {s}-{n}", n % 9 + 1))
    (tmp_path / "large.md").write_bytes("\n".join(lines).encode())
    (tmp_path / "small.md").write_text(GUIDE, encoding="utf-8")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        splits = spark.read.text(str(tmp_path)).select("_metadata.file_block_start", "_metadata.file_path").distinct().count()
        found = tuples(guide.load_syllabus(spark, str(tmp_path)).select("subject", "section", "topic", "weight_pct"))
        positions = guide.guide_lines(spark, str(tmp_path)).filter("line LIKE '| Topic %-%'").orderBy("file", "pos").collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert splits > 20
    assert found == sorted(expected + [("Geology", "Rivers", "Deltas", 4), ("Geology", "Rocks", "Basalt (dark)", 5), ("Geology", "Rocks", "Chalk", 3)], key=repr)
    assert [r["line"].split()[2] for r in positions] == [e[2].split()[1] for e in expected]


def test_sections_add_up(spark, guide_path):
    checked = U.check_sections(guide.load_syllabus(spark, guide_path), guide.load_section_totals(spark, guide_path))
    assert tuples(checked.select("section", "total_pct", "within")) == [("Rivers", 4, True), ("Rocks", 8, True)]


def syllabus(spark, rows):
    return spark.createDataFrame([("S", "sec", t, w, a, tier, None) for t, w, a, tier in rows], schemas.SYLLABUS)


def test_roadmap_and_orders(spark):
    topics = syllabus(spark, [("a", 3, "Low", "CRITICAL"), ("b", 5, "Low", "CRITICAL"), ("c", 1, "Very High", "CRITICAL"),
                              ("d", 9, "High", "LOW"), ("e", 2, "High", "MEDIUM")])
    mains = U.roadmap(topics, "mains", 3.5)
    assert tuples(mains.select("block_no", "block", "pos", "topic")) == [
        (1, "Week 1-4", 1, "b"), (1, "Week 1-4", 2, "a"), (1, "Week 1-4", 3, "c"), (3, "Week 9-12", 1, "e"),
        (4, "If time allows", 1, "d")]
    both = U.roadmap(topics, "both", 0.25).filter("block_no = 1")
    assert [(r.block, r.topic) for r in both.orderBy("pos").collect()] == [
        ("Week 1-1", "c"), ("Week 1-1", "b"), ("Week 1-1", "a")]
    assert [r.topic for r in U.study_order(topics).orderBy("pos").collect()] == ["b", "a", "c", "e", "d"]
    assert [r.topic for r in U.top_topics(topics, 2).orderBy("pos").collect()] == ["d", "b"]
    with pytest.raises(ValueError):
        U.roadmap(topics, "other")


def test_explicit_order(spark):
    topics = syllabus(spark, [("alpha", 3, "Low", "CRITICAL"), ("beta", 5, "Low", "LOW"), ("gamma", 1, "Low", "LOW")])
    lists = spark.createDataFrame([(2, "S", 1, "A"), (1, "S", 2, "G"), (1, "S", 1, "?")], schemas.STUDY_ORDER)
    aliases = spark.createDataFrame([("S", "A", "alpha"), ("S", "G", "gamma")], "subject string, label string, topic string")
    ordered = U.study_order(topics, U.named_order(lists, aliases))
    assert tuples(ordered.select("pos", "topic", "phase")) == [(1, "gamma", 1), (2, "alpha", 2), (3, "beta", None)]


def test_importance(spark):
    topics = syllabus(spark, [("a", 3, "Low", "LOW")])
    asked = spark.createDataFrame([("a",), ("z",)], "topic string")
    assert tuples(U.with_importance(asked, topics)) == [("a", "S", 3, "Low", "LOW", True), ("z", None, None, None, None, False)]


def test_fixed_source_order(spark):
    rows = [("t", 1, "https://brilliant.org/x"), ("t", 2, "https://www.KhanAcademy.org/y"), ("t", 3, "http://a.b"),
            ("u", 4, "nothing"), ("u", 5, None), ("v", 6, "https://notkhanacademy.org/"), ("v", 7, "https://ncert.nic.in:80/a")]
    entries = spark.createDataFrame(rows, "topic string, entry_id long, url string").withColumn("fetched_at", F.lit(1))
    assert tuples(U.best_source(entries).select("topic", "entry_id", "source_rank")) == [("t", 2, 2), ("u", 5, 5), ("v", 7, 1)]


def test_shortfall_counts_missing_topics(spark):
    topics = spark.createDataFrame([("a",), ("b",)], "topic string")
    rows = [(i, "a", None, None, None, "p", None, None, None, None) for i in range(4)]
    bank = spark.createDataFrame(rows, schemas.PROBLEMS)
    assert tuples(U.problem_shortfall(topics, bank, "2024-01-01")) == [("a", 4, 1), ("b", 0, 5)]


@pytest.mark.parametrize("n, sizes", [(1, [1]), (2, [2]), (3, [3]), (4, [4]), (5, [3, 2]), (6, [3, 3]), (7, [3, 4]), (10, [3, 3, 4])])
def test_checkpoints(spark, n, sizes):
    df = spark.createDataFrame([("d", i * 10) for i in range(n)], "deck string, slide_no int")
    marks = [r.checkpoint for r in Q.checkpoints(df).orderBy("slide_no").collect()]
    assert [marks.count(c) for c in sorted(set(marks))] == sizes and marks == sorted(marks)


def test_slots_rotate(spark):
    rows = [("hot", i * 7) for i in range(5000)] + [(f"q{i % 9}", i) for i in range(100)]
    slots = Q.assign_slots(spark.createDataFrame(rows, "quiz string, question int")).orderBy("quiz", "question").collect()
    for a, b in zip(slots, slots[1:]):
        assert a.quiz != b.quiz or a.answer_slot != b.answer_slot
    counts = [sum(s.answer_slot == c for s in slots if s.quiz == "hot") for c in "ABCD"]
    assert max(counts) - min(counts) <= 1


def test_quiz(spark):
    rows = [(i, "t", None, d, None, "p", None, None, None, None) for i, d in enumerate(["Easy", "Medium", "Medium", "Hard"])]
    quiz = Q.assemble_quiz(spark.createDataFrame(rows, schemas.PROBLEMS), "2024-01-01").orderBy("slot").collect()
    assert [r.difficulty for r in quiz] == ["Easy", "Medium", "Hard", "Medium", "Hard"]
    assert [r.short for r in quiz] == [False, False, False, False, True]
    drawn = [r.problem_id for r in quiz if not r.short]
    assert sorted(drawn) == [0, 1, 2, 3]


def test_grading(spark):
    key = spark.createDataFrame([("q", 1, "A"), ("q", 2, "B"), ("q", 3, "C")], "quiz string, question int, answer string")
    given = spark.createDataFrame([("q", 1, "A"), ("q", 2, "C")], "quiz string, question int, given string")
    assert tuples(Q.quiz_scores(Q.grade(given, key))) == [("q", 3, 2, 1)]


def test_relevance(spark):
    rows = [("This is a Proof.", "M"), ("Office hours and proofs", "M"), ("Grading rules", "M"), (" M \n", "M"), ("other", None)]
    tagged = R.tag_relevance(spark.createDataFrame(rows, "text string, module_title string"))
    assert [(r.verdict, r.reason) for r in tagged.collect()] == [
        ("include", "include term"), ("include", "include term"), ("skip", "skip term"), ("skip", "title only"),
        ("include", "default")]


def test_course_map_depths(spark):
    rows = [(f"m{i}", f"f{j % 2}", "include", "text") for i in range(1, 6) for j in range(i)]
    mapped = R.course_map(spark.createDataFrame(rows, "module string, deck string, verdict string, text string"))
    assert tuples(mapped.select("place", "module", "depth", "files")) == [
        (1, "m5", "deep", 2), (2, "m4", "deep", 2), (3, "m3", "medium", 2), (4, "m2", "medium", 2), (5, "m1", "light", 1)]


def test_first_uses(spark):
    rows = [("c", "d", 2, "NFA and DFA"), ("c", "d", 1, "URL x NFA1 A, éNFA"), ("b", "d", 9, "NFA")]
    uses = R.first_uses(spark.createDataFrame(rows, "course string, deck string, slide_no int, text string"))
    assert tuples(uses) == [("b", "NFA", "d", 9, 0), ("c", "DFA", "d", 2, 2), ("c", "NFA", "d", 1, 2)]


def brute_levels(edges):
    nodes = {n for e in edges for n in e}
    before = {n: {a for a, b in edges if b == n} for n in nodes}
    level = {}
    while True:
        free = {n for n in nodes - level.keys() if before[n] <= level.keys()}
        if not free:
            break
        for n in free:
            level[n] = 1 + max((level[p] for p in before[n]), default=-1)
    held = nodes - level.keys()
    reach = {n: set() for n in held}
    for n in held:
        todo = [n]
        while todo:
            for a, b in edges:
                if a == todo[0] and b in held and b not in reach[n]:
                    reach[n].add(b)
                    todo.append(b)
            todo.pop(0)
    on_cycle = {n for n in held if n in reach[n]}
    # Nodes that still lead to a cycle lie between two cycles.
    cycle = {n for n in held if n in on_cycle or reach[n] & on_cycle}
    return sorted([(n, level[n], "ordered") for n in level] + [
        (n, None, "cycle" if n in cycle else "blocked") for n in held], key=repr)


@pytest.mark.parametrize("seed, back, local_links", [(0, 0, 200_000), (1, 0, 0), (2, 3, 0), (3, 6, 30), (3, 6, 200_000)])
def test_prerequisites(spark, seed, back, local_links):
    rng = random.Random(seed)
    # A hot node is the prerequisite of a third of all pairs.
    edges = {(0, n) for n in range(1, 40)}
    while len(edges) < 110:
        a, b = sorted(rng.sample(range(40), 2))
        if b - a < 6:
            edges.add((a, b))
    for _ in range(back):
        b, a = sorted(rng.sample(range(1, 40), 2))
        edges.add((a, b))
    df = spark.createDataFrame(sorted(edges) * 2, "prerequisite long, topic long")
    assert tuples(prerequisite_levels(df, local_links=local_links)) == brute_levels(edges)


def jobs_of(spark, work):
    """What ``work`` gives, and the jobs that Spark ran for it (each exchange counts as one)."""
    context, group = spark.sparkContext, f"counted-{random.random()}"
    context.setJobGroup(group, group)
    try:
        return work(), len(context.statusTracker().getJobIdsForGroup(group))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_a_deep_ladder_is_no_long_job(spark):
    """Each of 1,000 rungs needs both topics of the rung before."""
    ladder = spark.range(1998).selectExpr("id AS prerequisite", "explode(array(id + 2, id + 3 - 2 * (id % 2))) AS topic")
    rows, jobs = jobs_of(spark, lambda: prerequisite_levels(ladder).collect())
    assert jobs < 100
    assert {(r["topic"], r["level"], r["status"]) for r in rows} == {(n, n // 2, "ordered") for n in range(2000)}


def test_steps_follow_the_logarithm_of_the_depth(spark, monkeypatch):
    from lectern.operators import prerequisites as P
    steps = []
    run = P._Elimination.run
    monkeypatch.setattr(P._Elimination, "run", lambda self: (run(self), steps.append(self.step))[0])
    for depth in (40, 160):
        ladder = spark.range(2 * depth - 2).selectExpr("id AS prerequisite", "explode(array(id + 2, id + 3 - 2 * (id % 2))) AS topic")
        rows = prerequisite_levels(ladder, local_links=50).collect()
        assert {(r["topic"], r["level"]) for r in rows} == {(n, n // 2) for n in range(2 * depth)}
    assert steps[1] < 2.5 * steps[0] + 4


def test_prerequisites_without_pairs_and_long_runs(spark):
    topics = spark.createDataFrame([(i,) for i in range(100, 105)], "topic long")
    edges = [(i, i + 1) for i in range(60)] + [(10, 61), (61, 60), (None, 100), (None, 30), (5, None)]
    edges += [(200, 201), (201, 202), (202, 200), (202, 203), (203, 204)]
    edges += [(300, 301), (301, 302), (302, 303), (303, 300), (301, 310), (310, 311), (311, 303)]
    check_long_runs(prerequisite_levels(spark.createDataFrame(edges, "prerequisite long, topic long"), topics))
    check_long_runs(prerequisite_levels(spark.createDataFrame(edges, "prerequisite long, topic long"), topics, local_links=0))


def check_long_runs(levels):
    got = {r["topic"]: (r["level"], r["status"]) for r in levels.collect()}
    assert all(got[i] == (i, "ordered") for i in range(61)) and got[61] == (11, "ordered")
    assert all(got[i] == (0, "ordered") for i in range(100, 105)) and None not in got
    assert {got[i] for i in (200, 201, 202, 300, 301, 302, 303, 310, 311)} == {(None, "cycle")}
    assert got[203] == got[204] == (None, "blocked")


def test_prerequisite_steps_send_nothing_to_the_driver(spark, monkeypatch):
    """A broadcast in every join of every step would add up on the driver."""
    from lectern.operators import prerequisites as P

    plans, written = [], P._Elimination._written

    def seen(self, df, *rest):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(self, df, *rest)

    monkeypatch.setattr(P._Elimination, "_written", seen)
    monkeypatch.setattr(P, "stage", lambda df, label, stage=P.stage: (plans.append(df._jdf.queryExecution().executedPlan().toString()), stage(df, label))[1])
    chain = spark.range(1, 60).selectExpr("id - 1 AS prerequisite", "id AS topic")
    out = prerequisite_levels(chain, local_links=0)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert [(i, i, "ordered") for i in range(60)] == sorted(tuples(out))
    assert sum("Join" in p for p in plans) > 10 and not any("Broadcast" in p for p in plans)


def test_last_answer_counts_once(spark):
    key = spark.createDataFrame([("q", 1, "A"), ("q", 2, "B")], "quiz string, question int, answer string")
    given = spark.createDataFrame([("q", 1, "C", 1), ("q", 1, "A", 2), ("q", 2, "B", 3), ("q", 2, "D", 4)],
                                  "quiz string, question int, given string, given_at int")
    assert tuples(Q.quiz_scores(Q.grade(given, key))) == [("q", 2, 2, 1)]


def test_a_topic_of_two_subjects_gives_one_row(spark):
    syllabus = spark.createDataFrame([("S", "a", 3, "Low", "LOW"), ("T", "a", 5, "High", "HIGH")],
                                     "subject string, topic string, weight_pct int, advanced string, tier string")
    assert tuples(U.with_importance(spark.createDataFrame([("a",)], "topic string"), syllabus)) == [("a", "T", 5, "High", "HIGH", False)]
    both = spark.createDataFrame([("S", "a"), ("X", "a")], "subject string, topic string")
    assert tuples(U.with_importance(both, syllabus)) == [("S", "a", 3, "Low", "LOW", True), ("X", "a", None, None, None, False)]
