"""Bulk lookup against trying every text on every entry."""

import datetime as dt
import random
import re
import string

from lectern import schemas
from lectern.operators.lookup import lookup_many

AS_OF = "2024-02-15 00:00:00"
DAY = dt.datetime(2024, 1, 1)


def like(text, topic):
    fold = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    pattern = "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in text.translate(fold))
    return re.search(f"(?s){pattern}", topic.translate(fold)) is not None


def test_lookup_many(spark):
    rng = random.Random(4)
    letters = "abcAB é\\_%"
    topics = ["".join(rng.choices(letters, k=rng.randrange(1, 9))) for _ in range(60)]
    # A third of the entries share one topic.
    rows = [(i, topics[0] if i % 3 == 0 else rng.choice(topics), None, None, "b", "web",
             DAY + dt.timedelta(days=rng.randrange(20)), DAY if rng.random() < 0.2 else None, None) for i in range(400)]
    queries = ["", "%", "_", "___", "____%a", "\\", "é", "É", "zzz", "z"] + [
        "".join(rng.choices(letters, k=rng.randrange(1, 5))) for _ in range(120)]
    queries = list(dict.fromkeys(queries))
    found = lookup_many(spark.createDataFrame(rows, schemas.CONTENT),
                        spark.createDataFrame([(q,) for q in queries], "query string"), AS_OF)
    got = {}
    for r in found.collect():
        got.setdefault(r.query, []).append((r.place, r.entry_id, r.hit))
    assert sorted(got) == sorted(queries)
    alive = [r for r in rows if r[7] is None]
    for q in queries:
        best = sorted((r for r in alive if like(q, r[1])), key=lambda r: (r[6], r[0]), reverse=True)[:3]
        expected = [(i, r[0], True) for i, r in enumerate(best, start=1)] or [(None, None, False)]
        assert sorted(got[q], key=repr) == sorted(expected, key=repr), q


def test_no_cross_join(spark):
    found = lookup_many(spark.createDataFrame([], schemas.CONTENT),
                        spark.createDataFrame([("a",)], "query string"), AS_OF)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan and "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in found.select("query", "hit").collect()] == [("a", False)]
