"""Spelling variants against all pairs compared by the rule."""

import random
import re
import zlib
from collections import Counter

import pytest

from llm.frames import documents


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def counted(rows, least=7, occurrences=2, slip=31):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n = Counter()
    for r in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", r[1] or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{run}".encode())
            if slip and h % slip == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= least:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= occurrences}


def by_rule(n, ratio=10):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def corpus(seed=1, stems=60, n=260):
    """Words with letters beyond ASCII, their typos at several removes, a hot word with many variants."""
    rng = random.Random(seed)
    letters = "abcdefghiklmnoprstuÀÉßàéö÷"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 12))) for _ in range(stems)] + ["aaaaaaaa", "abababababab", "aaaaaaab"]
    hot = "government"

    def edited(w):
        k = rng.randrange(len(w))
        return rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]])

    pool = words * 12 + [hot] * 400
    for w in words:
        pool += [x := edited(w)] * 3 + [y := edited(x)] * 2 + [edited(y), edited(w)] * 2
    pool += [edited(hot) for _ in range(500)] + ["programming"] * 500 + ["programing"] * 40 + ["programng"] * 3
    rng.shuffle(pool)
    rows = [(k, rng.choice([" ", ", ", "-\n", "1"]).join(x.capitalize() if rng.random() < 0.2 and x[0] < "{" else x for x in pool[k::n]), "en", "s", 1) for k in range(n)]
    return [*rows, (n, None, "en", "s", 0), (n + 1, "", None, None, None), (None, "government governmant 漢字government😀", "en", "s", 9), (5, rows[5][1], "en", "s", 1), (5, rows[5][1], "en", "s", 1)]


@pytest.mark.parametrize("block", [1024, 3])
def test_variants_follow_the_rule(spark, monkeypatch, block):
    from bazaarlens.llm import spelling as S

    monkeypatch.setattr(S, "BLOCK", block)
    rows = corpus()
    n = counted(rows)
    want = by_rule(n)
    assert len(want) > 300 and sum(r[1] is not None for r in want) > 20 and any(r[2] not in (r[0], r[1]) for r in want)
    got = S.variants(documents(spark, rows)).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_variants_with_other_parameters(spark):
    from bazaarlens.llm.spelling import variants

    rows = corpus(2, 30, 40)
    want = by_rule(counted(rows, 5, 1, None), 2)
    assert {tuple(r) for r in variants(documents(spark, rows), least=5, occurrences=1, ratio=2, slip=None).select("word", "form", "root", "n", "n_near", "form_n").collect()} == want


def test_variants_of_awkward_rows(spark):
    from bazaarlens.llm.spelling import variants
    from llm.frames import awkward

    rows = [*awkward(), (70, "a" * 20_000 + "b", "en", "s", 1), (71, "a" * 20_000 + "c", "en", "s", 1), (72, "a" * 20_000 + "b", "en", "s", 1), (73, "a" * 20_000 + "c", "en", "s", 1)]
    n = counted(rows)
    got = {tuple(r) for r in variants(documents(spark, rows)).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == by_rule(n)
    assert variants(documents(spark, [])).collect() == [] and variants(documents(spark, [(1, None, None, None, None)])).collect() == []


def test_long_chains_reach_their_last_form(spark):
    from bazaarlens.llm.spelling import followed

    chain = [(f"w{k:02}", f"w{k + 1:02}") for k in range(19)]
    assert {tuple(r) for r in followed(spark.createDataFrame(chain, "word string, form string")).collect()} == {(f"w{k:02}", "w19") for k in range(19)}


def test_pivots_do_not_overlap_and_cost_least():
    import numpy as np

    from bazaarlens.llm.spelling import pivots

    cost = np.random.default_rng(0).integers(0, 50, size=(200, 9)).astype(float)
    for row, (a, b) in zip(cost, pivots(cost), strict=True):
        assert b - a >= 2 and row[a] + row[b] == min(row[i] + row[j] for i in range(9) for j in range(i + 2, 9))
