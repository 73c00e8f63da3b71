"""Vector codes against the rule written out row by row with Python's integers."""

import hashlib
import math

import numpy as np
import pytest

SCHEMA = "vec_id long, embedding array<double>, label int"


def by_rule(rows, parts, entries, rounds):
    """(vec_id, code, error, label_error, sha) of rows of one length, in the order of their ids."""
    kept = sorted((r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(x * 256) if abs(x) < 2**40 else int(x) * 256 for x in r[1]] for r in kept]
    d = len(whole[0]) // parts
    cut = [[tuple(w[p * d : (p + 1) * d]) for p in range(parts)] for w in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        new = [list(b) for b in books]
        for p in range(parts):
            to = [assign(c[p], books[p])[1] for c in cut]
            for k in set(to):
                mine = [c[p] for c, t in zip(cut, to, strict=True) if t == k]
                new[p][k] = tuple(sum(col) // len(mine) for col in zip(*mine, strict=True))
        books = new
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    out = []
    for r, c in zip(kept, cut, strict=True):
        best = [assign(c[p], books[p]) for p in range(parts)]
        out.append([r[0], "".join(f"{k:02x}" for _, k in best), sum(e for e, _ in best), r[2], sha])
    sums = {}
    for row in out:
        sums[row[3]] = sums.get(row[3], 0) + row[2]
    return sorted((tuple([r[0], r[1], r[2], sums[r[3]], r[4]]) for r in out), key=repr)


def result(spark, rows, **kw):
    from pyspark.sql import functions as F

    from bazaarlens.llm.vector_codes import compress

    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("vector", "length", "code", "error", "of", "r", "position", "a.b"):
        df = df.withColumn(c, F.lit("x"))
    return sorted((tuple(r) for r in compress(df, **kw).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def rows_of(n=300, dim=12, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim))
    rows = [(int(k), [float(x) for x in np.round(centres[k % 5] + rng.normal(size=dim) * 0.2, 2)], int(k % 3) if k % 11 else None) for k in range(n)]
    rows += [(n + k, rows[7][1], 1) for k in range(150)]  # a third of all: one vector
    rows += [(9000, None, 1), (9001, [math.nan] * dim, 1), (9002, [None] * dim, 1), (9003, [math.inf] * dim, 1), (9004, [0.0] * dim, 2), (None, rows[3][1], 2), (5, rows[9][1], 0), (5, rows[9][1], 0)]
    return rows


@pytest.mark.parametrize(("parts", "entries", "rounds"), [(4, 8, 2), (12, 64, 2), (3, 256, 1), (1, 5, 0)])
def test_codes_follow_the_rule(spark, parts, entries, rounds):
    rows = rows_of()
    assert result(spark, rows, parts=parts, entries=entries, rounds=rounds) == by_rule(rows, parts, entries, rounds)


def test_codes_of_small_blocks_and_subtrees(spark, monkeypatch):
    from bazaarlens.llm import vector_codes as V

    monkeypatch.setattr(V, "BLOCK", 64)
    monkeypatch.setattr(V, "SUBTREE", 2)
    rows = rows_of(200)
    assert result(spark, rows, parts=4, entries=16) == by_rule(rows, 4, 16, 2)


def test_codes_of_very_large_components(spark):
    rows = [(k, [float(k), 2.0**45 + k * 2.0**20, -1e25, 1e200 * (k % 2)], 0) for k in range(12)] + [(20 + k, [0.5, 1.0, -2.5, 3.0], None) for k in range(3)]
    most = 2**63 - 1
    want = [(a, b, min(e, most), min(s, most), h) for a, b, e, s, h in by_rule(rows, 2, 4, 2)]
    got = result(spark, rows, parts=2, entries=4)
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in sorted(want, key=repr)]


def test_codes_of_lengths_apart_and_of_nothing(spark):
    from bazaarlens.llm.vector_codes import compress

    rows = [(k, [float(k % 7), 1.0, 0.25 * k, -1.0], 1) for k in range(30)] + [(100 + k, [0.5 * k, 2.0], 2) for k in range(30)]
    odd = [(200, [1.0, 2.0, 3.0], 3), (201, [], 4)]
    got = {r[0]: r for r in result(spark, rows + odd, parts=2, entries=4)}
    for part in (rows[:30], rows[30:]):
        for r in by_rule(part, 2, 4, 2):
            assert got[r[0]] == r
    assert got[200] == (200, None, None, None, None)
    assert got[201][:4] == (201, "0000", 0, 0)
    assert result(spark, [(1, None, 1)]) == []
    assert compress(spark.createDataFrame([], SCHEMA)).collect() == []


def test_trie_gives_the_nearest_entry():
    from bazaarlens.llm import vector_codes as V

    rng = np.random.default_rng(0)
    parts = rng.integers(-9, 9, size=(5000, 4))
    entries = rng.integers(-9, 9, size=(64, 4))
    distinct, place = V.distinct_parts(parts)
    assert (distinct[place] == parts).all() and [tuple(r) for r in distinct] == sorted({tuple(r) for r in parts})
    near, far = V.nearest_entries(distinct, entries)
    gap = ((distinct[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (near == gap.argmin(axis=1)).all() and (far == gap.min(axis=1)).all()
