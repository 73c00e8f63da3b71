"""Main text: wrappers with speaking names, states, hidden boxes, formulas, very many blocks, and known articles in varied templates."""

import random
import time
from collections import Counter

import pytest

from llm.frames import WORDS

TEXT = "The river had been rising for three days, and the people of the town were on the bridge to see it, as they had been when it last came over the wall."


def main(page):
    from bazaarlens.llm.html_text import STOP_WORDS, main_text

    return main_text(page, {k: frozenset(v.split()) for k, v in STOP_WORDS.items()})


@pytest.mark.parametrize("page", [
    '<div class="content has-sidebar"><p>{0}</p></div>', '<div class="layout-no-sidebar"><p>{0}</p></div>', '<div id="page" class="nav-fixed"><p>{0}</p></div>', '<div class="post share-enabled"><p>{0}</p></div>',
    '<div class="cookie-recipes"><p>{0}</p></div>', '<div class="menu-open"><article><p>{0}</p></article></div>', '<div class="header-sticky"><main><p>{0}</p></main></div>', '<article><div class="social-science"><p>{0}</p></div></article>',
    '<form id="aspnetForm"><div class="sidebar"><p>Read more of this in our letter, which is sent to you.</p></div><div><p>{0}</p><p>{0}</p></div></form>',
])
def test_wrappers_keep_their_text(page):
    assert set(main(f"<body>{page.format(TEXT)}</body>").split("\n")) == {TEXT}


def test_parts_with_such_names_still_go():
    side = "This is the letter that we send to those who have asked us for it, and it is sent every week of the year."
    for part in ('<div class="sidebar"><p>{0}</p></div>', '<div class="comments"><p>{0}</p><p>{0}</p><p>{0}</p><p>{0}</p><p>{0}</p></div>', '<section id="disqus_thread"><p>{0}</p></section>',
                 '<div style="display: none"><p>{0}</p></div>', "<div hidden><p>{0}</p></div>", "<nav><p>{0}</p></nav>", '<div class="newsletter-signup"><p>{0}</p></div>', "<p>© 2024 Example, all rights reserved</p>"):
        for box in ("div", "article", "div class='content has-sidebar'"):
            page = f"<body><{box}><p>{TEXT}</p><p>{TEXT}</p></{box.split()[0]}>{part.format(side)}</body>"
            assert main(page) == f"{TEXT}\n{TEXT}", (part, box)


def test_formulas_and_marks_of_rights_inside_text():
    value = "The value of <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding='t'>x=2</annotation></math> is what we had in mind when it was said that this is to be so."
    assert main(f"<article><p>{value}</p></article>").startswith("The value of x=2 is what")
    law = "The mark © is what the owner of a work may put on it, and it is for the courts to say whether that has been of any use to him or to those who came after him."
    assert main(f"<div><p>{law}</p><p>{TEXT}</p></div>") == f"{law}\n{TEXT}"


def test_very_many_short_blocks_in_seconds():
    page = "<div><p>" + TEXT + "</p><ul>" + "<li>item</li>" * 100_000 + "</ul></div>"
    start = time.perf_counter()
    assert main(page).count("item") == 100_000
    assert time.perf_counter() - start < 20


def generated(seed, lang):
    """A page in one of many templates, and its article."""
    rng = random.Random(seed)
    words = WORDS[lang]

    def sentence(n):
        return " ".join(rng.choice(words) if rng.random() < 0.45 else "".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randint(3, 9))) for _ in range(n)).capitalize() + "."

    article = []
    for _ in range(rng.randint(3, 12)):
        article.append(sentence(rng.randint(2, 7)) if rng.random() < 0.2 else " ".join(sentence(rng.randint(8, 20)) for _ in range(rng.randint(1, 4))))
    body = "".join(f"<p>{p}</p>" for p in article)
    box = rng.choice(["<article>{}</article>", "<main><div>{}</div></main>", "<div class='content has-sidebar'>{}</div>", "<div id='post-body'><section>{}</section></div>", "<div class='layout no-sidebar nav-fixed'><div>{}</div></div>"])
    links = "".join(f"<li><a href='x{k}'>{sentence(rng.randint(1, 3))}</a></li>" for k in range(rng.randint(4, 15)))
    extra = [f"<nav><ul>{links}</ul></nav>", f"<div class='menu main-menu'><ul>{links}</ul></div>", f"<div class='sidebar'><h3>{sentence(3)}</h3><p>{sentence(14)}</p></div>", f"<div class='cookie-notice'><p>{sentence(18)}</p></div>",
             f"<footer><p>© 2024 {sentence(5)}</p></footer>", f"<div class='comments'>{''.join(f'<p>{sentence(12)}</p>' for _ in range(rng.randint(1, 9)))}</div>", f"<form><label>{sentence(2)}</label><input></form>",
             f"<div class='ad'><p>{sentence(9)}</p></div>", f"<aside><p>{sentence(15)}</p></aside>", f"<div style='display:none'><p>{sentence(20)}</p></div>", f"<script>{sentence(9)}</script>"]
    rng.shuffle(extra)
    cut = rng.randint(0, 4)
    return f"<html><body class='has-sidebar menu-open'>{''.join(extra[:cut])}{box.format(body)}{''.join(extra[cut : rng.randint(cut, 11)])}</body></html>", "\n".join(article)


def test_known_articles_in_varied_templates():
    hit = found = wanted = 0
    for seed in range(400):
        page, article = generated(seed, "en" if seed % 2 else "de")
        got, want = Counter(main(page).split()), Counter(article.split())
        hit, found, wanted = hit + (got & want).total(), found + got.total(), wanted + want.total()
    print(f"precision {hit / found:.4f}, recall {hit / wanted:.4f}")
    assert hit / found >= 0.98 and hit / wanted >= 0.98
