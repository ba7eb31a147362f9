import datetime as dt
import sqlite3

from pyspark.sql import functions as F
import pytest

from helpers import tuples
from lectern import schemas
from lectern.operators import content as C
from lectern.sources.store import StudyStore

AS_OF = "2024-02-15 00:00:00"
NOW = dt.datetime(2024, 2, 15)


def entry(i, topic, subject=None, fetched=0, expires=None, body="b", url=None):
    return (i, topic, subject, url, body, "web", NOW + dt.timedelta(days=fetched), expires, None)


@pytest.fixture(scope="module")
def content(spark):
    second = dt.timedelta(seconds=1)
    rows = [
        entry(1, "Optics", "Physics", -3), entry(2, "Optics", None, -1),
        entry(3, "optics", "Physics", -2, NOW), entry(4, "Atoms", "Chemistry", -5, NOW + second),
        entry(5, "Old", "Physics", -9, NOW - second), entry(6, "Atoms", "", -5, url=""),
    ]
    return spark.createDataFrame(rows, schemas.CONTENT)


def test_expiry_boundary(content):
    assert [r.entry_id for r in C.live(content, AS_OF).collect()] == [1, 2, 4, 6]
    assert [r.entry_id for r in C.expired(content, AS_OF).collect()] == [3, 5]
    assert [r.entry_id for r in C.live(content, NOW).collect()] == [1, 2, 4, 6]


def test_latest(content):
    assert [r.entry_id for r in C.latest(content, "OPT", AS_OF).collect()] == [2, 1]
    assert [r.entry_id for r in C.latest(content, "", AS_OF).collect()] == [2, 1, 6]
    assert C.latest(content, "none", AS_OF).isEmpty()
    plan = C.latest(content, "a", AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_list_topics_like_sqlite(content):
    con = sqlite3.connect(":memory:")
    con.execute("CREATE TABLE c (id, topic, subject, fetched, expires)")
    con.executemany("INSERT INTO c VALUES (?, ?, ?, ?, ?)", [
        (r.entry_id, r.topic, r.subject, r.fetched_at.isoformat(), r.expires_at and r.expires_at.isoformat())
        for r in content.filter("entry_id <> 6").collect()])
    expected = con.execute(
        "SELECT topic, subject, count(*), max(fetched) FROM c WHERE expires IS NULL OR expires > ? GROUP BY topic "
        "ORDER BY subject, topic", (NOW.isoformat(),)).fetchall()
    got = [(r.topic, r.subject, r.entries, r.last_updated.isoformat())
           for r in C.list_topics(content.filter("entry_id <> 6"), AS_OF).collect()]
    assert got == expected
    assert got[0] == ("Optics", None, 2, "2024-02-14T00:00:00")


def test_list_topics_leaves_bodies_unread(spark, content, tmp_path):
    content.write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    plan = C.list_topics(stored, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "body" not in plan and "PushedFilters: [Or(IsNull(expires_at),GreaterThan(expires_at" in plan


def test_display(content):
    row = C.present_content(content.filter("entry_id = 6")).first()
    assert (row.subject, row.url, row.expires) == ("N/A", "N/A", "never")


def test_new_content(spark, content):
    incoming = spark.createDataFrame([("T", "\n x 　"), ("T", " \t\n"), ("T", "")], "topic string, body string")
    rows = C.new_content(content, incoming, AS_OF).collect()
    assert [(r.body, r.source_type, r.subject, r.expires_at) for r in rows] == [
        ("x", "web", None, NOW + dt.timedelta(days=30))]


def test_stats(spark, content):
    problems = spark.createDataFrame([], schemas.PROBLEMS)
    assert tuple(C.store_stats(content, problems, AS_OF).first()) == (6, 4, 0)
    assert C.size_kb(spark.createDataFrame([(1024,), (512,)], "length long")).first()[0] == 1.5


def test_sampling(spark):
    rows = [(i, "T", None, "Hard" if i % 2 else "hard", None, f"p{i}", None, None, NOW, None) for i in range(20)]
    bank = spark.createDataFrame(rows, schemas.PROBLEMS)
    first = [r.problem_id for r in C.sample_problems(bank, "t", AS_OF, seed=1).collect()]
    assert len(set(first)) == 5
    assert first == [r.problem_id for r in C.sample_problems(bank, "t", AS_OF, seed=1).collect()]
    assert first != [r.problem_id for r in C.sample_problems(bank, "t", AS_OF, seed=2).collect()]
    assert C.sample_problems(bank, "t", AS_OF, "Hard", n=-1).count() == 10
    assert C.sample_problems(bank, "t", AS_OF, "", n=-1).count() == 20
    assert C.sample_problems(bank, "t", AS_OF, n=0).count() == 0


def test_store_life(spark, tmp_path):
    store = StudyStore(spark, str(tmp_path / "store"))
    texts = spark.createDataFrame([("Optics", "a"), ("optics 2", "b"), ("Atoms", " ")], "topic string, body string")
    assert store.read("content").count() == 0
    assert store.store_content(texts, AS_OF, 1) == 2
    assert store.purge("OPTICS") == {"content": 2, "problems": 0}
    assert store.read("content").count() == 0
    assert store.store_content(texts, AS_OF, 3) == 2
    assert sorted(r.entry_id for r in store.read("content").collect()) == [3, 4]
    problems = spark.createDataFrame([("Optics", "  p ")], "topic string, problem string")
    assert store.store_problems(problems, AS_OF, 1) == 1
    assert store.read("problems").first().problem == "  p "
    assert store.log_sessions(spark.createDataFrame([("Optics",)], "topic string"), 1) == 1
    assert store.read("sessions").first().checkpoint == 0
    assert tuple(store.stats(AS_OF).first()) == (2, 2, 1)
    assert store.purge("Optics 2") == {"content": 1, "problems": 0}
    assert [r.topic for r in store.list_topics(AS_OF).collect()] == ["Optics"]
    later = NOW + dt.timedelta(days=30)
    assert store.get("opt", later - dt.timedelta(seconds=1)).count() == 1
    assert store.get("opt", later).count() == 0
    assert store.get_problems("opt", AS_OF).count() == 1
    assert store.list_problem_topics(AS_OF).count() == 1
    assert store.clear_expired(later) == {"content": 1, "problems": 1}
    store.store_content(texts, AS_OF, 5)
    store.clear_all()
    assert [store.read(t).count() for t in ("content", "problems", "sessions")] == [0, 0, 0]
    store.store_content(texts, AS_OF, 7)
    assert sorted(r.entry_id for r in store.read("content").collect()) == [7, 8]


def test_removals_leave_other_files_alone(spark, tmp_path):
    store = StudyStore(spark, str(tmp_path / "s"))
    texts = spark.createDataFrame([("Optics", "a"), ("Atoms", "b")], "topic string, body string").coalesce(1)
    atoms = texts.filter("topic = 'Atoms'")
    store.store_content(texts, AS_OF, 1, ttl_days=5)
    store.store_content(atoms, AS_OF, 10, ttl_days=9)
    store.store_content(atoms, AS_OF, 20, ttl_days=1)

    def files():
        return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "s" / "content").rglob("*.parquet")}

    def day(n):
        return (NOW + dt.timedelta(days=n)).strftime("%Y-%m-%d")

    before = files()
    assert store.purge("optics")["content"] == 1
    after = files()
    assert {p for p in before if f"={day(9)}" in p or f"={day(1)}" in p} == {p for p in after if p in before and after[p] == before[p]}
    assert store.clear_expired(NOW + dt.timedelta(days=3))["content"] == 1
    assert {p: t for p, t in after.items() if f"={day(1)}" not in p} == files()
    assert sorted(r.entry_id for r in store.read("content").collect()) == [2, 10]


def test_purge_and_clear_split_the_rows(content):
    kept = C.without_topic(content, "opt")
    assert tuples(kept.select("entry_id")) == [(4,), (5,), (6,)]
    counts = dict(tuples(C.expiry_counts(content, content.filter("entry_id = 5"), AS_OF)))
    assert counts == {"content": 2, "problems": 1}


def test_ids_go_on_by_themselves(spark, tmp_path):
    store = StudyStore(spark, str(tmp_path / "store"))
    pages = spark.createDataFrame([("T", "second", 2), ("T", "first", 1), ("T", "third", 3)], "topic string, body string, place int")
    ids = lambda: {r.body: r.entry_id for r in store.read("content").collect()}
    assert store.store_content(pages, AS_OF, order_cols=["place"]) == 3
    assert ids() == {"first": 1, "second": 2, "third": 3} and "place" not in store.read("content").columns
    store.clear_all()
    store.store_content(pages, AS_OF, order_cols=["place"])
    store.purge("t")
    assert store.store_content(pages.limit(0), AS_OF) == 0
    StudyStore(spark, str(tmp_path / "store")).store_content(pages, AS_OF, order_cols=["place"])
    assert ids() == {"first": 7, "second": 8, "third": 9}
    # Another writer that took the next claim first.
    (tmp_path / "store" / "ids" / "content" / "claim-000000000003").write_text("500")
    assert store.claim_ids("content", 2) == 501 and store.claim_ids("problems", 2) == 1
    (tmp_path / "store" / "ids" / "content" / "claim-000000000005").write_text("")
    with pytest.raises(RuntimeError):
        store.claim_ids("content", 1)


def test_purge_reads_and_rewrites_only_files_that_may_match(spark, tmp_path):
    root = tmp_path / "store"
    store = StudyStore(spark, str(root))
    for topic in ("Optics", "Atoms", "Rocks and waves"):
        store.store_content(spark.createDataFrame([(topic, f"{topic} {i}") for i in range(5)] + [("Shared_1", topic)], "topic string, body string").coalesce(1), AS_OF)
    files = sorted(store.may_hold("content", ""))
    assert len(files) == 3 and len(store.may_hold("content", "OPT")) == 1 and store.may_hold("content", "quantum") == []
    assert len(store.may_hold("content", "shared")) == 3 and len(store.may_hold("content", "%wav%_s")) == 1 and len(store.may_hold("content", "%")) == 3
    other = [f for f in files if f not in store.may_hold("content", "optics")]
    for f in other:
        spoiled = f.replace("file://", "").replace("file:", "")
        with open(spoiled, "rb") as whole:
            held = whole.read()
        with open(spoiled, "wb") as out:
            out.write(b"not to be read")
    assert store.purge("optics") == {"content": 5, "problems": 0}
    with pytest.raises(Exception):
        store.read("content").select("body").collect()
    assert sorted(f for f in store.may_hold("content", "") if f in other) == sorted(other) and len(store.may_hold("content", "")) == 3
    assert store.may_hold("content", "optics") == [] and held
    # A file without a summary is always looked at.
    store.clear_all()
    store.store_content(spark.createDataFrame([("Waves", "x")], "topic string, body string"), AS_OF)
    spark.createDataFrame([(99, "Optics", "y")], "entry_id long, topic string, body string").coalesce(1).write.mode("append").parquet(f"{root}/content/expires_on=never")
    assert len(store.may_hold("content", "optics")) == 1 and store.purge("optics")["content"] == 1
    assert [r.topic for r in store.read("content").collect()] == ["Waves"]
