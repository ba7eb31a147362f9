import math

import numpy as np

from lectern.llm import itq_neardup as Q


def brute(rows, threshold=0.95):
    good = [(i, np.array(v, float)) for i, v in rows if v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)]
    good = [(i, v / np.abs(v).max()) for i, v in good]
    links, parent = [0] * len(good), list(range(len(good)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(good)):
        for b in range(a + 1, len(good)):
            u, v = good[a][1], good[b][1]
            if len(u) == len(v) and u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= threshold:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    names = {}
    for n, (i, _) in enumerate(good):
        names[find(n)] = min(names.get(find(n), i), i)
    return {i: (links[n], names[find(n)]) for n, (i, _) in enumerate(good)}


def clustered(count, d, seed):
    random = np.random.default_rng(seed)
    rows = []
    for i in range(count):
        if rows and random.random() < 0.5:
            base = np.array(rows[random.integers(len(rows))][1])
            v = base + random.normal(scale=random.choice([0.0, 0.01, 0.03]), size=d) * np.linalg.norm(base)
        else:
            v = random.normal(size=d)
        rows.append((i, (v * random.choice([1.0, 3.0])).tolist()))
    return rows


def test_links_equal_brute_force_and_no_false_link(spark):
    rows = clustered(500, 16, 1)
    expected = brute(rows)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS node", "0 AS label", "'k' AS keys")
    for block in (1024, 8):
        got = {r["vec_id"]: r for r in Q.link_vectors(frame, recall=0.999, block=block).collect()}
        found, wanted = sum(r["n_links"] for r in got.values()), sum(n for n, _ in expected.values())
        assert len(got) == len(rows) and 0.98 * wanted <= found <= wanted
        assert all(got[i]["n_links"] <= n for i, (n, _) in expected.items())
        assert sum(got[i]["component_id"] == c for i, (_, c) in expected.items()) >= 0.97 * len(rows)
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_recall_on_the_table(spark):
    """The table's vectors, each with a copy that is turned by an angle around the threshold."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").toPandas()
    x = np.stack(rows["embedding"].to_numpy()).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    random = np.random.default_rng(8)
    noise = random.normal(size=x.shape)
    noise -= (noise * x).sum(axis=1, keepdims=True) * x
    noise *= np.tan(np.arccos(random.uniform(0.93, 0.99, (len(x), 1)))) / np.linalg.norm(noise, axis=1, keepdims=True)
    x = np.concatenate((x, x + noise))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    wanted = dict(enumerate(((x @ x.T >= 0.95).sum(axis=1) - 1).tolist()))
    frame = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in Q.link_vectors(frame).collect()}
    assert all(n <= wanted[i] for i, n in got.items())
    assert sum(wanted.values()) and sum(got.values()) >= 0.9 * sum(wanted.values())


def test_huge_and_tiny_vectors(spark):
    rows = clustered(60, 6, 5) + [(1000, [1e200, 1e200]), (1001, [1e-200, 1e-200]), (1002, [3e307, 2.9e307]), (1003, [5e-324, 5e-324]),
                                  (1004, [1e300, -1e300]), (1005, [-0.0, 2.0]), (1006, [0.0, 7.0]), (1007, [1e200, 1e-200])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in Q.link_vectors(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>"), recall=0.999).collect()}
    expected = brute(rows)
    assert {i: got[i] for i in got if i >= 1000} == {i: expected[i] for i in expected if i >= 1000}
    assert got[1000] == (3, 1000) and got[1005] == (1, 1005) and got[1004] == (0, 1004)


def test_code_limit():
    assert 14 < Q.code_limit(64, 0.95) < 24 and Q.code_limit(2, 0.95) == 2 and Q.code_limit(64, 1.0) == 0


def test_odd_rows(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [math.nan, 1.0]), (7, [math.inf, 1.0]),
            (8, []), (9, [2.0, 0.0]), (None, [1.0, 0.0]), (10, [0.0, 1.0]), (11, [1.0]), (12, [5.0, 0.0, 0.0])]
    got = Q.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    by_id = {r["vec_id"]: r for r in got}
    assert len(got) == len(rows)
    assert {by_id[i]["n_links"] for i in (1, 2, 9, None)} == {4} and {by_id[i]["component_id"] for i in (1, 2, 9, None)} == {1}
    assert all(by_id[i]["n_links"] == 0 and by_id[i]["component_id"] == i and by_id[i]["kept"] for i in (3, 4, 5, 6, 7, 8, 10, 11, 12))
    assert not by_id[None]["kept"] and not by_id[2]["kept"] and by_id[1]["kept"]
    assert Q.link_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0
    only_bad = Q.link_vectors(spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<double>")).collect()
    assert sorted(tuple(r) for r in only_bad) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_rotations_balance_and_quantise():
    sample = np.random.default_rng(2).normal(size=(3000, 24)) * np.linspace(1, 4, 24)
    learned = Q.learn_rotations(sample, 24, 2)
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)

    def error(r):
        p = unit @ r
        return ((np.sign(p) * np.abs(p).mean() - p) ** 2).mean()

    plain = Q.learn_rotations(sample, 24, 2, rounds=0)
    assert error(learned[0]) < error(plain[0])
    for r in learned:
        assert np.allclose(r.T @ r, np.eye(24), atol=1e-8)
        assert np.abs(((unit @ r) >= 0).mean(axis=0) - 0.5).max() < 0.1
