import math
from collections import Counter

import numpy as np
import pytest

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN = float("nan")


def frame(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("class", "vector", "n", "home", "asks", "rank", "tag", "score"):
        df = df.withColumn(c, F.lit("x"))
    return df


def rows_of(n=400, dim=12, seed=4):
    """Clusters, copies, near copies, unusable vectors, null ids and labels, another length."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    out = []
    for k in range(n):
        v = centres[k % 6] + rng.normal(size=dim) * rng.choice([0.02, 0.1, 1.0])
        out.append((k, [float(np.float32(x)) for x in v], int(k % 3)))
    for k in range(n, n + 60):  # a hot vector, and scaled near copies of it
        out.append((k, out[7][1] if k % 2 else [float(np.float32(x * 3 + 0.001 * k)) for x in out[7][1]], out[7][2]))
    out += [(1000, None, 1), (1001, [0.0] * dim, 1), (1002, [NAN] * dim, 1), (1003, [None] * dim, 1), (1004, [math.inf] * dim, 1), (1005, [], 1), (1006, out[7][1], None), (None, out[7][1], out[7][2])]
    out += [(1007, [1.0, 2.0], 1), (1008, [1.0, 2.0], 1), (1100, out[7][1], out[7][2]), (1100, out[7][1], out[7][2]), (1200, [1.0, 2.0], 0)]
    return out


def fit(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_near_duplicates_match_brute_force(spark, monkeypatch):
    from bazaarlens.llm import embedding_dedup as E

    monkeypatch.setattr(E, "TILE", 16)
    monkeypatch.setattr(E, "PER_CELL", 40)
    rows = rows_of()
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    ok = [r[0] is not None and r[2] is not None and fit(r[1]) for r in rows]
    for a in range(len(rows)):
        for b in range(a):
            if ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], dtype=float), np.array(rows[b][1], dtype=float)
                if rows[a][1] == rows[b][1] or (len(x) == 12 and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98):
                    links[a] += 1
                    links[b] += 1
                    root[find(a)] = find(b)
    least = {}
    for k, r in enumerate(rows):
        g = find(k)
        least[g] = r[0] if g not in least or (r[0] is not None and r[0] < least[g]) else least[g]
    want = Counter((r[0], links[k], least[find(k)], r[0] is None or r[0] == least[find(k)]) for k, r in enumerate(rows))
    got = E.near_duplicates(frame(spark, rows)).collect()
    assert Counter(tuple(r) for r in got) == want


def test_search_is_exact_with_enough_effort_and_good_without(spark):
    from bazaarlens.llm.ann_forest import search

    rows = rows_of()
    points = {r[:1] + (tuple(r[1]),) for r in rows if r[0] is not None and fit(r[1])}
    want = {}
    for q, v in points:
        if q % 100 == 0:
            far = sorted((float(np.sqrt(((np.array(w) - np.array(v)) ** 2).sum())), k) for k, w in points if k != q and len(w) == len(v))
            want[q] = far[:10]
    got = {}
    for r in search(frame(spark, rows), effort=1e9).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert got.keys() == want.keys()
    for q, found in got.items():
        found.sort()
        assert [x[0] for x in found] == list(range(1, len(want[q]) + 1)) and [x[1] for x in found] == [x[1] for x in want[q]]
        assert np.allclose([x[2] for x in found], [x[0] for x in want[q]], rtol=1e-12)
    hits = sum((r["query_id"], r["vec_id"]) in {(q, k) for q, f in want.items() for _, k in f} for r in search(frame(spark, rows), effort=4.0).collect())
    assert hits >= 0.9 * sum(len(f) for f in want.values())


def test_the_stop_follows_recall(spark, monkeypatch):
    """Vectors without structure, of which the floor of points alone would stop at prefixes that miss most neighbours."""
    from bazaarlens.llm import ann_forest as A

    x = np.random.default_rng(1).normal(size=(4000, 64)).astype(np.float32)
    keyed, lengths = A._keyed, set()
    monkeypatch.setattr(A, "_keyed", lambda points, forest, of, vectors: (lengths.update(of if vectors else ()), keyed(points, forest, of, vectors))[1])
    found = {(r["query_id"], r["vec_id"]) for r in A.search(frame(spark, [(k, v.tolist(), 0) for k, v in enumerate(x)]), k=2, letters=3, effort=0.5).collect()}
    assert lengths and 0 not in lengths  # not by comparing all
    hits = 0
    for q in range(0, 4000, 100):
        far = ((x - x[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        hits += sum((q, int(n)) in found for n in np.argsort(far)[:2])
    assert hits >= 0.9 * 2 * 40


def test_points_needed():
    from bazaarlens.llm.ann_forest import _points_needed

    found = np.array([[99.0, 50, 10], [99.0, 40, 12]])
    assert _points_needed(found, np.ones((2, 3)), 5) == 5  # the floor reaches it
    assert _points_needed(found, np.array([[1.0, 1, 0.5]] * 2), 5) == 13  # one letter for both
    assert _points_needed(found, np.array([[1.0, 0.5, 0.5]] * 2), 5) == 51  # all points
    assert _points_needed(np.zeros((0, 3)), np.zeros((0, 3)), 5) == 5


def test_few_candidates_and_none(spark):
    from bazaarlens.llm.ann_forest import search
    from bazaarlens.llm.embedding_dedup import near_duplicates

    few = [(0, [1.0, 0.0], 1), (5, [0.0, 1.0], 1), (6, [1.0, 0.0], 2)]
    assert [(r["rank"], r["vec_id"]) for r in sorted(search(frame(spark, few)).collect(), key=lambda r: r["rank"])] == [(1, 6), (2, 5)]
    assert search(frame(spark, [])).count() == near_duplicates(frame(spark, [])).count() == search(frame(spark, [(0, None, 1)])).count() == 0
    assert [tuple(r) for r in near_duplicates(frame(spark, [(0, None, 1)])).collect()] == [(0, 0, 0, True)]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_recall_on_the_test_table(spark, folder):
    import os

    from bazaarlens.llm.queries import QUERIES, table

    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    rows = table(spark, folder, "embeddings").toPandas()
    x = np.stack(rows["embedding"]).astype(float)
    found = QUERIES["op2_ann_forest"](spark, folder).toPandas()
    hits = total = 0
    for k in np.flatnonzero(rows["vec_id"] % 100 == 0):
        far = np.sqrt(((x - x[k]) ** 2).sum(axis=1))
        far[k] = np.inf
        best = set(rows["vec_id"].to_numpy()[np.lexsort((rows["vec_id"], far))[:10]])
        hits += len(best & set(found[found["query_id"] == rows["vec_id"][k]]["vec_id"]))
        total += len(best)
    assert hits >= 0.9 * total


def test_near_duplicates_match_the_sql(spark, tmp_path):
    import duckdb

    from bazaarlens.llm.queries import QUERIES, SQL

    seen = set()
    rows = [r for r in rows_of() if r[0] is not None and not (r[0] in seen or seen.add(r[0]))]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = sorted(con.execute(SQL["op3_embedding_dedup"]).fetchall())
    got = QUERIES["op3_embedding_dedup"](spark, str(tmp_path)).select("vec_id", "n_links", "component_id", "kept").collect()
    assert sorted(tuple(r) for r in got) == want and max(r[1] for r in want) > 0


def test_vectors_of_every_length_are_searched(spark):
    """A table of two models: each length is searched within itself, whichever is the commoner."""
    from bazaarlens.llm.ann_forest import search

    rng = np.random.default_rng(9)
    rows = [(k, rng.normal(size=8 if k < 300 else 4).astype(np.float32).tolist(), 0) for k in [*range(300), *range(1000, 1200)]]
    got = {}
    for r in search(frame(spark, rows), effort=1e9).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert got.keys() == {0, 100, 200, 1000, 1100}
    for q, found in got.items():
        v = dict((k, w) for k, w, _ in rows)[q]
        far = sorted((float(((np.array(w, dtype=float) - np.array(v, dtype=float)) ** 2).sum()), k) for k, w, _ in rows if k != q and len(w) == len(v))
        assert [k for _, k in sorted(found)] == [k for _, k in far[:10]]
