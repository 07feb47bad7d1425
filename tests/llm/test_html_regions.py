"""Main text of pages built from known pieces: wrappers, boilerplate of every sort, broken and deep markup."""

import random
import time

import pytest

from veloflow.llm.html_text import Lines, left_out, main_text, smoothed

LONG = "This paragraph goes on for quite a while, as the running text of an article does, and then it ends."
OTHER = "Here is another one of about the same length, which tells the reader something else about the matter."
MANY = "".join(f"<p>{LONG}</p><p>{OTHER}</p>" for _ in range(3))
TEXT = "\n\n".join([LONG, OTHER] * 3)


@pytest.mark.parametrize(
    "wrapper",
    ['<div class="content-sidebar-wrap"><div>{}</div></div>', "<form action='x'><div>{}</div><input><button>go</button></form>",
     '<div class="elementor-widget-text-editor">{}</div>', "<div class='header-overlay'><form><article>{}</article></form></div>",
     "<div id='widget'><div id='search'><div>{}</div></div></div>"],
)
@pytest.mark.parametrize("beside", ["", "<nav><a>one</a> <a>two</a></nav>", "<div class='ad no-print'><p>Buy this now.</p></div>", "<footer>All rights kept, and this line is long enough to count as running text for anyone who reads it.</footer>"])
def test_wrappers_do_not_hide_the_page(wrapper, beside):
    assert main_text(f"<body>{beside}{wrapper.format(MANY)}</body>") == TEXT


@pytest.mark.parametrize("name", ["comments", "ad no-print", "cookie-consent", "related", "newsletter-box", "sponsored"])
def test_believed_names_stay_out_however_long(name):
    assert main_text(f"<div class='{name}'>{MANY * 5}</div><div><p>{LONG}</p></div>") == LONG
    assert main_text(f"<article><p>{LONG}</p><div class='{name}'>{MANY * 5}</div></article>") == LONG


@pytest.mark.parametrize("tag", ["nav", "footer", "aside", "dialog", "menu"])
def test_page_of_besides_only(tag):
    assert main_text(f"<{tag}>{MANY}</{tag}>") == ""


def test_short_form_is_no_wrapper():
    assert main_text("<form><p>Name and word, please.</p><input></form>") == ""
    assert main_text(f"<form>{MANY}</form><article><p>{LONG}</p>{MANY}</article>") == f"{LONG}\n\n{TEXT}"


def test_teaser_article_beside_the_text():
    got = main_text(f"<article class='card'><p>Soon.</p></article><div>{MANY}</div>")
    assert got.endswith(TEXT)


def test_text_to_tag_ratio_decides_between_regions():
    links = "".join(f"<p><b>{i}</b> <i>k</i></p>" for i in range(12))
    gap = "".join(f"<p><b>{i}</b><i>z</i></p>" for i in range(12))
    assert main_text(f"<div>{MANY}</div><section>{gap}</section><div>{links}</div>") == TEXT


@pytest.mark.parametrize("unit", ["<b>x", "<div>x", "<p>x", "<div class='sidebar'>x", "<header>x", "<article><header><h1>x", "</div>x", "<head>x"])
def test_deep_and_broken_markup_takes_linear_time(unit):
    def seconds(n):
        start = time.perf_counter()
        main_text(unit * n)
        return time.perf_counter() - start

    seconds(2_000)
    assert seconds(40_000) < 20 * max(seconds(4_000), 0.05)


def slow_left_out(parser, weights):
    """Each element's lines are gathered anew by walking up from every line."""

    def around(d):
        chain = [d]
        while chain[-1]:
            chain.append(parser.outer[chain[-1]])
        return chain

    rows = [(set(around(x.doubt)), x, w) for x, w in zip(parser.lines, weights)]
    rows = [r for r in rows if not any(parser.believed[d] for d in r[0]) and not r[1].links()]
    total, article = sum(w for *_, w in rows), sum(w for _, x, w in rows if x.in_article)
    out = []
    for d in range(len(parser.outer)):
        own = [r for r in rows if d in r[0]]
        held, art = sum(w for *_, w in own), sum(w for _, x, w in own if x.in_article)
        wrapper = held * 2 > total + 1e-9 and art * 2 >= article - 1e-9 and (art > 0 or sum(len(x.text) >= 80 for _, x, _ in own) >= 2)
        out.append(d > 0 and (parser.believed[d] or out[parser.outer[d]] or not wrapper))
    return out


@pytest.mark.parametrize("seed", range(40))
def test_lifted_doubts_equal_brute_force(seed):
    import numpy as np

    r = random.Random(seed)

    def block(depth):
        kind = r.choice(["p", "p", "div", "form", "sidebar", "comments", "article", "nav", "header"])
        if kind == "p" or depth > 5:
            return f"<p>{r.choice([LONG, OTHER, 'Short.', '<a>A link</a>'])}</p>"
        inner = "".join(block(depth + 1) for _ in range(r.randint(0, 4)))
        return f"<div class='{kind}'>{inner}</div>" if kind in ("sidebar", "comments") else f"<{kind}>{inner}</{kind}>"

    parser = Lines()
    parser.feed("".join(block(0) for _ in range(6)))
    parser.close()
    parser.line()
    if parser.lines:
        weights = smoothed(np.array([len(x.text) / x.tags for x in parser.lines]))
        assert left_out(parser, weights) == slow_left_out(parser, weights)


@pytest.mark.parametrize("seed", range(30))
def test_pages_built_from_known_pieces(seed):
    """What was put into the article comes back, whole and in order, and nothing else."""
    r = random.Random(seed)
    words = "of the and road bicycle traffic count station edge river city long short & < é 日本".split()

    def text(n):
        return " ".join(r.choice(words) for _ in range(n))

    def escaped(t):
        return t.replace("&", "&amp;").replace("<", "&lt;")

    boiler = (
        lambda: f"<nav><ul><li><a href='/'>{escaped(text(3))}</a></li></ul></nav>",
        lambda: f"<div class='ad'>{escaped(text(12))}</div>",
        lambda: f"<aside><p>{escaped(text(25))}</p></aside>",
        lambda: f"<div id='comments'><p>{escaped(text(40))}</p><p>{escaped(text(30))}</p></div>",
        lambda: f"<form><label>{escaped(text(2))}</label><input></form>",
        lambda: f"<footer><p>{escaped(text(15))}</p></footer>",
        lambda: f"<div class='sidebar'><p>{escaped(text(20))}</p></div>",
        lambda: "<script>var x = '</p>' + \"<article>\";</script><style>p{margin:0}</style><!-- <p>no</p> -->",
    )
    pieces = [text(r.randint(5, 60)) for _ in range(r.randint(4, 15))]
    body = []
    for t in pieces:
        body.append(f"<{r.choice(('p', 'h2', 'blockquote', 'div'))}>{escaped(t)}")
        body[-1] += "</" + body[-1][1 : body[-1].index(">")] + ">"
        if r.random() < 0.2:
            body.append(boiler[1]())
    around = ["".join(b() for b in r.sample(boiler, r.randint(0, 6))) for _ in range(2)]
    tag = r.choice(("article", "main"))
    assert main_text(f"<html><head><title>t</title></head><body>{around[0]}<{tag}>{''.join(body)}</{tag}>{around[1]}</body></html>") == "\n\n".join(pieces)
