"""License scan: base places against a word loop, notices and their edited copies."""

import random
import re

from llm.frames import WORDS, awkward, documents, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def base(text):
    from bazaarlens.llm.license_scan import PHRASES

    w = words(text)
    found = sorted((at, label) for label, phrase in PHRASES for at in range(len(w)) if w[at : at + len(phrase.split())] == phrase.split())
    return len(w), len(found), found[0][0] if found else None, found[-1][0] if found else None, ",".join(sorted({x for _, x in found}))


def scanned(spark, rows):
    from bazaarlens.llm.license_scan import scan

    return scan(documents(spark, rows)).collect()


def test_base_places_match_a_word_loop(spark):
    rng = random.Random(8)
    pieces = ["under the MIT License", "Under_the.MIT (license)", "Apache License, Version 2.0", "cc by-nc", "cc by nc cc by nc", "under the mit licence", "UNDER THE MİT LICENSE", "cc byK nc", "the mit license",
              "under the mit license apache license version 2", "CC BY NC", "Αpache license version 2", "é à ü", ""]
    rows = [*awkward(), (80, "cc by nc " * 4000, "en", "s", 1), (81, "cc by nc", "en", "s", 1), (82, "by nc", "en", "s", 1)]
    for k in range(100, 200):
        rows.append((k, " ".join(rng.choice([prose(rng, WORDS["en"], rng.randint(0, 9)), rng.choice(pieces)]) for _ in range(rng.randint(1, 14))), "en", "s", 1))
    got = scanned(spark, rows)
    assert len(got) == len(rows)
    want = sorted(((r[0], *base(r[1])) for r in rows), key=repr)
    assert sorted((tuple(r[:6]) for r in got), key=repr) == want
    for r in got:
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1
        assert (r["score"] == 1) if r["n_base"] else (r["score"] == 0 or r["labels"])


def test_notices_and_their_edited_copies(spark):
    from bazaarlens.llm.license_scan import NOTICES, templates

    rng = random.Random(3)
    rows, want = [], {}
    for k, (label, text) in enumerate(NOTICES):
        w = text.split()
        edited = list(w)
        if len(w) > 25:  # a word lost, one added, one changed
            del edited[len(w) // 4]
            edited.insert(len(w) // 2, "really")
            edited[len(w) // 3] = "other"
        around = [prose(rng, WORDS["en"], 30) for _ in range(4)]
        rows += [(2 * k, f"{around[0]}\n * {text.upper()}\n{around[1]}", "en", "s", 1), (2 * k + 1, f"{around[2]} {' '.join(edited)} {around[3]}", "en", "s", 1)]
        want |= {2 * k: label, 2 * k + 1: label}
    rows.append((900, " ".join(prose(rng, WORDS["en"], 400) for _ in range(5)), "en", "s", 1))  # prose: nothing
    rows.append((901, "This program is free software: " + prose(rng, WORDS["en"], 60) + " later version.", "en", "s", 1))  # a small part: nothing
    rows.append((902, NOTICES[3][1] + " " + prose(rng, WORDS["en"], 5) + " " + NOTICES[11][1], "en", "s", 1))  # two notices
    got = {r["doc_id"]: r for r in scanned(spark, rows)}
    for k, label in want.items():
        assert got[k]["labels"] == label, (k, got[k])
        assert got[k]["score"] == 1 if k % 2 == 0 else got[k]["score"] >= 0.8
        notices = [x for x in got[k]["spans"] if not x["base"]]
        size = next(len(t.words) for t in templates() if not t.base and t.words == tuple(words(NOTICES[k // 2][1])))
        if k % 2 == 0:
            assert (30, 30 + size) in {(x["start"], x["end"]) for x in notices}
    assert (got[900]["labels"], got[900]["score"], got[901]["labels"]) == ("", 0, "")
    assert got[902]["labels"] == ",".join(sorted({NOTICES[3][0], NOTICES[11][0]}))


def test_scan_of_empty_tables_and_of_bad_templates(spark):
    import pytest

    from bazaarlens.llm.license_scan import scan, templates

    assert scan(documents(spark, [])).collect() == []
    for bad in ((("x", "two words"),), (("x", "é à ü ö"),)):
        with pytest.raises(ValueError):
            templates(notices=bad)


def test_plan_has_no_python(spark, folder):
    from bazaarlens.llm.queries import op12_license_scan

    plan = op12_license_scan(spark, folder)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
