"""The Markov half of the secret scan: random strings and ordinary names of many kinds, none of them from the samples."""

import random
import string
import uuid

import pytest

from llm.frames import documents

ENGLISH = ("window border layout corner shadow animal forest mountain coffee kitchen bottle planet rocket engine garden market station airport hospital teacher student lawyer doctor weather summer winter thunder "
           "picture mirror curtain blanket pillow finger shoulder kidney protein vitamin calcium battery voltage current magnet circuit copper silver golden diamond").split()


def secrets(rng):
    b62 = string.ascii_letters + string.digits
    draw = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    return {
        "base62": draw(b62, rng.randint(24, 40)), "prefixed": "ghp_" + draw(b62, 36), "letters": draw(string.ascii_letters, 40), "base64": draw(b62 + "+/", 43) + "=", "capitals": draw(string.ascii_uppercase + "234567", 32),
        "uuid": str(uuid.UUID(int=rng.getrandbits(128))), "urlsafe": draw(b62 + "-_", 32),
    }


def ordinary(rng):
    w = [rng.choice(ENGLISH) for _ in range(4)]
    return {
        "camel": "".join(x.capitalize() for x in w[:3]) + str(rng.randint(0, 99)), "lower camel": w[0] + "".join(x.capitalize() for x in w[1:]), "snake": "_".join(w), "screaming": "_".join(w[:3]).upper() + "_" + str(rng.randint(1, 9)),
        "kebab date": "-".join(w[:2]) + f"-20{rng.randint(10, 29)}-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}", "path": "/" + "/".join(w[:3]) + "/" + w[3], "file": "/".join(w[:2]) + "/" + w[2].capitalize() + w[3].capitalize(),
        "compound": "".join(w), "rule": "=" * 30 + w[0],
    }


@pytest.fixture(scope="module")
def models(spark):
    from bazaarlens.llm.secret_scan import trained

    return trained(documents(spark))


def rates(spark, models, kinds):
    from bazaarlens.llm.secret_scan import scan

    rng = random.Random(11)
    rows, kind = [], {}
    for k in range(300):
        for j, (name, s) in enumerate(sorted(kinds(rng).items())):
            if len(s) >= 20:
                rows.append((k * 100 + j, f"the value {s} is here", "en", "s", 1))
                kind[k * 100 + j] = name
    hit, total = {}, {}
    for r in scan(documents(spark, rows, extra=False), models).select("doc_id", "found").collect():
        name = kind[r["doc_id"]]
        total[name] = total.get(name, 0) + 1
        hit[name] = hit.get(name, 0) + bool(r["found"])
    return {name: hit[name] / total[name] for name in total}


def test_random_strings_of_all_kinds_are_found(spark, models):
    found = rates(spark, models, secrets)
    print("recall", {k: round(v, 3) for k, v in found.items()}, "threshold", models.threshold)
    assert min(found.values()) >= 0.95, found


def test_ordinary_names_are_left_alone(spark, models):
    found = rates(spark, models, ordinary)
    print("false alarms", {k: round(v, 3) for k, v in found.items()})
    assert max(found.values()) <= 0.02, found
