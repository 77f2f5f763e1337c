from __future__ import annotations

import itertools
import random
import re
from collections import Counter
from html import unescape

import pytest

from tallyweir.llm.html import Weights, extract, fit, labels_of, learned, main_text, pieces
from tallyweir.llm.queries import op7_html

PRIOR = learned({})
WORDS = "Words of the article go on, and on. "


def paragraphs(n):
    return [f"{WORDS * 3}Paragraph {i}." for i in range(n)]


def page(body, head="<title>Some title of it</title>"):
    return f"<!DOCTYPE html><html><head>{head}<style>p{{a:b}}</style><script>if (a<b) x='</p>'</script></head><body>{body}</body></html>"


MENU = "<nav><ul>" + "".join(f"<li><a href='/{i}'>Menu item {i}</a></li>" for i in range(12)) + "</ul></nav>"
PS = "".join(f"<p>{p}</p>" for p in paragraphs(4))
WANT = "\n\n".join(["The head line", *paragraphs(4)])
TEMPLATES = {
    "article": f"{MENU}<article><h1>The head line</h1>{PS}</article><footer>&copy; A site and its long footer text</footer>",
    "main with header and sidebar": f"<header><h2>Site name</h2>{MENU}</header><main><h1>The head line</h1>{PS}</main><aside><p>{WORDS * 4}</p></aside>",
    "article with own header": f"{MENU}<article><header class='entry-header'><h1>The head line</h1></header>{PS}</article>",
    "plain blocks": f"<div id='topmenu'>{MENU}</div><div id='content'><h1>The head line</h1>{PS}</div><div class='sidebar'><p>{WORDS * 9}</p></div>",
    "advert inside": f"<article><h1>The head line</h1>{PS.replace('</p>', '</p><div class=ad>' + WORDS * 9 + '</div>', 1)}</article>",
    "comments": f"<article><h1>The head line</h1>{PS}<section id=comments><article class=comment><p>{WORDS * 30}</p></article></section></article>",
    "forms and notices": f"<div class='cookie-notice'><p>{WORDS * 9}</p></div><article><h1>The head line</h1>{PS}<form><p>{WORDS}</p><button>Go</button></form></article>",
    "menu left open": f"<nav><ul><li><a href=x>One<li><a href=y>Two<article><h1>The head line</h1>{PS}</article>",
    "nothing closed": "<div class=ad>Buy this</div><article><h1>The head line" + "".join(f"<p>{p}" for p in paragraphs(4)),
    "inline markup": f"<article><h1>The <em>head</em> line</h1>{PS.replace('Words', '<b>Wor</b>ds').replace('on, and', 'on,<br>and')}</article>",
    "comments and scripts": f"<article><!-- <p>no</p> --><h1>The head line</h1><script>document.write('<p>no</p>')</script>{PS}<style>p {{}}</style></article>",
}


@pytest.mark.parametrize("name", TEMPLATES)
def test_templates(name):
    assert main_text(page(TEMPLATES[name]), PRIOR) == WANT


BODY_CLASSES = ["has-sidebar", "no-sidebar", "nav-closed", "modal-open", "fixed-header", "comments-open", "home sidebar-right", "search", "noSidebar related"]
ENTRY = f"<div class='entry-content'><h1>The head line</h1>{PS}</div>"
OTHERS = f"<div class='sidebar-right'><p>{WORDS * 9}</p></div><div class='comments-area'><div class='text'><p>{WORDS * 5}</p></div></div>"


@pytest.mark.parametrize("classes", BODY_CLASSES)
def test_names_of_body_and_wrappers_do_not_lose_the_article(classes):
    for inner in (ENTRY, f"<article class='post related-topic'>{ENTRY}</article>", f"<article><h1>The head line</h1>{PS}</article>"):
        for html in (
            page(f"{MENU}{inner}{OTHERS}").replace("<body>", f"<body class='{classes}'>").replace("<html>", f"<html class='{classes}'>"),
            page(f"{MENU}<main class='{classes} content-with-sidebar'>{inner}</main>{OTHERS}"),
            page(f"<div class='page {classes}'>{MENU}{inner}{OTHERS}</div>") if "-" in classes else "",
        ):
            assert not html or main_text(html, PRIOR) == WANT, html
            # learned weights that speak against a word of the names do not matter either
            weights = PRIOR._replace(words=PRIOR.words | dict.fromkeys((".sidebar", ".nav", ".modal", ".header", ".comments", ".related"), -2.0))
            assert not html or main_text(html, weights) == WANT, html


def test_wrappers_of_unlabelled_and_of_several_articles():
    assert main_text(page(f"<div class='layout sidebar-left'><div class=t><h1>The head line</h1>{PS}</div></div>"), PRIOR) == WANT
    posts = "".join(f"<div class='row comments-open'>{ENTRY}</div>" for _ in range(3))
    assert main_text(page(posts), PRIOR).count("The head line") == 3
    teasers = "".join(f"<article class=teaser><p>{WORDS * 2}</p></article>" for _ in range(3))
    assert main_text(page(f"<article><h1>The head line</h1>{PS}</article><div class='related-posts'>{teasers}</div>"), PRIOR) == WANT
    assert main_text(page(f"<article><h1>The head line</h1>{PS}</article><article class=comment><p>{WORDS * 4}</p></article>"), PRIOR) == WANT


HEAD = "<h1>The head line</h1>"
BLOCKS = [HEAD, *(f"<p>{p}</p>" for p in paragraphs(4))]
MIXED = {
    "page within a form": f"<form id=aspnetForm>{MENU}<div id=x>{HEAD}{PS}</div></form>",
    "article within a form": f"<form id=aspnetForm>{MENU}<article>{HEAD}{PS}</article></form>",
    "widgets of a page builder in main": f"{MENU}<main>{''.join(f'<div class=elementor-widget-text>{b}</div>' for b in BLOCKS)}</main>",
    "widget of a page builder": f"{MENU}<div class='elementor-widget elementor-widget-theme-post-content'>{HEAD}{PS}</div>",
    "blog in a widget": f"{MENU}<div class='widget Blog'><div class='post-body entry-content'>{HEAD}{PS}</div></div><div class=sidebar><div class=widget><p>{WORDS}</p></div></div>",
    "search result": f"{MENU}<div class='search results'><div class='article'>{HEAD}{PS}</div></div>",
    "section on social matters": f"<article>{HEAD}<section class=social>{PS}</section></article>",
    "lead marked as alert": f"<article>{HEAD}{PS.replace('<p>', '<p class=alert>', 1)}</article>",
    "head line in a banner": f"<article><div class=banner>{HEAD}</div>{PS}</article>",
    "links to share": f"<article>{HEAD}{PS}<div class=social><a href=x>Tweet this</a> <a href=y>Share it on</a></div></article>",
    "content of a sidebar": f"{MENU}<div id=content>{HEAD}{PS}</div><div class=sidebar><div class=content><p>{WORDS * 5}</p></div></div>",
}


@pytest.mark.parametrize("name", MIXED)
def test_names_and_forms_are_evidence_and_no_cut(name):
    assert main_text(page(MIXED[name]), PRIOR) == WANT


def test_only_learned_weights_find_the_region():
    def own(label):
        return page(f"<div class=zork><p>{WORDS * 12}</p></div><{label}><div class=flim>{HEAD}{PS}</div></{label}><div class=zork><p>{WORDS * 12}</p></div>")

    counts = sum((labels_of(own("article")) for _ in range(30)), labels_of(""))
    assert main_text(own("div"), PRIOR) != WANT
    assert main_text(own("div"), learned(counts)) == WANT
    # a guess gives way to what was seen
    swapped = Counter({(k, key.replace("flim", "banner"), i): n for (k, key, i), n in counts.items()})
    assert learned(swapped).purpose[".banner"] > 0 > PRIOR.purpose[".banner"]


def test_text_is_decoded_and_spaced():
    html = "<article><p> caf&eacute;&nbsp;&amp;\n tea &lt;b&gt; &#x41;&#66; 1 < 2 </p><p></p><ul><li>one two three four<li>five six</ul></article>"
    assert main_text(html, PRIOR) == "café & tea <b> AB 1 < 2\n\none two three four\n\nfive six"
    assert main_text("", PRIOR) == main_text("<p></p><script>x", PRIOR) == ""
    assert main_text("only words of text, no tags", PRIOR) == "only words of text, no tags"


def test_broken_tags_are_read_in_linear_time():
    for html in ("<a href='x" * 20_000, "<div " * 50_000, "<p>" * 20_000 + "x", "<!--" * 50_000, '<b a="' * 30_000, "</p>" * 50_000):
        main_text(html, PRIOR)
    assert main_text("<p>" + "word " * 200_000, PRIOR).count("word") == 200_000


def test_best_region_equals_brute_force():
    rng = random.Random(2)
    weights = Weights({"p": 0.5, "a": -3.0, "i": -1.5}, {"p": -1.0, "a": -0.3})
    for _ in range(200):
        html = "".join(rng.choice(["<p>", "</p>", "<a>", "</a>", "<i>", "</i>", "w x ", "y "]) for _ in range(12))
        parts = pieces(html)
        score = [weights.tag(p.keys) if p.text is None else weights.word(p.keys) * len(p.text.split()) for p in parts]
        regions = [(0.0, 0, 0)] + [(sum(score[i:j]), i, j) for i, j in itertools.combinations(range(len(parts) + 1), 2)]
        most = max(r[0] for r in regions)
        texts = {"".join(p.text or "" for p in parts[i:j]).split().__str__() for s, i, j in regions if s > most - 1e-9}
        assert str(main_text(html, weights).split()) in texts


def test_weights_come_from_labelled_pages():
    pages = [page(f"<div class=zzz><p>{WORDS}</p></div><article><h1>Line</h1>{PS}</article>") for _ in range(30)]
    counts = sum((labels_of(p) for p in pages), labels_of(""))
    weights = learned(counts)
    assert weights.words[".zzz"] < 0 < weights.words["p"] and weights.tags["article"] > weights.tags[".zzz"]
    assert not labels_of("<p>no label</p>") and not labels_of("<article></article><article></article>")


def test_rows(spark):
    rows = [(1, "u", page(TEMPLATES["article"]), 1), (1, "u", page(TEMPLATES["article"]), 1), (None, None, None, 2), (2, "v", "", 3), (3, "w", "<p>" * 9, 4)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars int")
    got = sorted(map(str, extract(frame, fit(frame)).collect()))
    want = sorted(map(str, extract(frame, PRIOR).collect()))
    assert got == want and sum(WANT.split("\n")[0] in r for r in got) == 2
    assert {r.n_chars for r in extract(frame, PRIOR).collect()} == {0, len(WANT)}
    assert extract(frame.limit(0), fit(frame.limit(0))).count() == 0


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    want = {}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1]
        blocks = (" ".join(unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        want[r.page_id] = (r.url, "\n\n".join(b for b in blocks if b))
    got = {r.page_id: r for r in op7_html(spark, sf_dir).collect()}
    assert {i: (r.url, r.text) for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())
