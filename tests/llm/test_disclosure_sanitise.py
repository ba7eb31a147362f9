import re

import pytest
from lectern.llm import disclosure_sanitise as P

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    "a@b.c@d.e _x@d.e.f a@b.c_x@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.1.1.1.", "4111 1111 1111 1111, 4111-1111-1111-1111  4111111111111111",
    "+1 (212) 555-1234 +1+44 20 7946 0958.", "ééé" + "x@y.zz 5  6 7", "9" * 5000 + " " + "1 " * 3000, "a." * 3000 + "@b.c", "@", "a@b",
    "..@a.b.c.", "12345678901234 +12345678901", "a" * 50_000, "+" * 5000 + "1" * 12, "mail.example@host.example.org at 10.0.0.1 or +1 (415) 555-0000",
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base(text):
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), rank, kind, m.end()))
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found))


@pytest.fixture(scope="module")
def found(spark, odd_documents):
    docs = spark.createDataFrame([(100 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    docs = docs.unionByName(odd_documents.select("doc_id", "text"))
    return {r["doc_id"]: r["text"] for r in docs.collect()}, P.find_personal_data(docs).collect()


def test_base_spans_equal_the_plain_patterns(found):
    texts, rows = found
    assert len(rows) == len(TEXTS) + 12
    for r in rows:
        if r["doc_id"] is not None:
            assert r["base_list"] == base(texts[r["doc_id"]]), r["doc_id"]
            assert sum(r[f"n_{k}"] for k in PATTERNS) == len(r["base"])


def test_sanitised_text_holds_no_entity(found):
    texts, rows = found
    for r in rows:
        if r["doc_id"] is not None and r["base"]:
            assert base(r["sanitised"]) == "" or r["doc_id"] == 112
        elif not r["terms"] and r["doc_id"] is not None:
            assert r["sanitised"] == texts[r["doc_id"]]


def test_terms_that_stand_only_beside_an_entity_disclose_it(spark):
    rows = [(i, f"filler number {i} mister zebulon writes from ann@host.org about topic {i % 5}") for i in range(4)]
    rows += [(10 + i, f"filler number {i} someone writes about topic {i % 5} and mister nobody") for i in range(60)]
    out = {r["doc_id"]: r for r in P.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    words = {rows[0][1][t["start"]:t["end"]] for t in out[0]["terms"]}
    assert "zebulon" in words and not words & {"topic", "about", "writes", "filler"}
    assert "zebulon" not in out[0]["sanitised"] and "<email>" in out[0]["sanitised"]
    assert not any(r["terms"] for i, r in out.items() if i >= 10)
    assert "term:" in out[0]["span_list"]


def test_a_single_entity_is_disclosed_through_its_group_anywhere_in_the_text(spark):
    """Every address stands in one text; the name of their firm, far away from them, stands in all of its domain."""
    far = "some words that fill the space between " * 8
    rows = [(i, f"Zebulon Works opens. {far} write to p{i}@zeb.example, says page {i} of zebulon") for i in range(4)]
    rows += [(10 + i, f"page {i} says: some words fill the space between, write to nobody") for i in range(60)]
    out = {r["doc_id"]: r for r in P.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(4):
        words = [rows[i][1][t["start"]:t["end"]] for t in out[i]["terms"]]
        assert words.count("Zebulon") == words.count("zebulon") == 1 and "Works" in words and "write" not in words
        assert "ebulon" not in out[i]["sanitised"]
    assert not any(r["terms"] for i, r in out.items() if i >= 10)


def test_terms_of_the_table(spark):
    """The rule adds terms on the given tables, to documents with an entity only."""
    rows = P.find_personal_data(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).select("base", "terms").collect()
    assert sum(bool(r["terms"]) for r in rows) > 0 and not any(r["terms"] and not r["base"] for r in rows)


def test_copies_alone_disclose_nothing(spark):
    rows = [(i, "mister zebulon writes from ann@host.org") for i in range(5)] + [(9 + i, f"other {i}") for i in range(20)]
    out = P.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert not any(r["terms"] for r in out)


def test_only_what_may_disclose_is_written(spark, monkeypatch):
    """Texts without an entity are not written, and words that stand everywhere do not meet the entities."""
    written = {}
    monkeypatch.setattr(P, "stored", lambda df, label, stored=P.stored: written.setdefault(label, stored(df, label)))
    rows = [(i, f"common words and zebulon writes from ann@host.org, says page {i}") for i in range(4)]
    rows += [(10 + i, f"common words and more of them on page {i}") for i in range(100)]
    out = {r["doc_id"]: r for r in P.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(out) == 104 and all(out[10 + i]["sanitised"] == rows[4 + i][1] for i in range(100))
    assert written["personal-data"].count() == 4
    assert {r["term"] for r in written["words-beside"].collect()} == {"zebulon", "writes", "from", "says"}
    assert all({rows[i][1][t["start"]:t["end"]] for t in out[i]["terms"]} == {"zebulon", "writes", "from", "says"} for i in range(4))


def test_no_documents_and_no_python(no_documents, odd_documents):
    assert P.find_personal_data(no_documents).count() == 0
    plan = P.find_personal_data(odd_documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
