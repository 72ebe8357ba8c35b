import pytest

from docket.llm.html_text import extract, main_text

PARA = "The cat sat on the mat and it was by the door of the house, with a view to the sea."
CASES = [
    (None, ""),
    ("", ""),
    ("no markup here", ""),
    (f"<p>{PARA}", PARA),
    (
        f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href='/x'>x</a></li></ul></nav>"
        f"<!-- x --><div class=\"ad\">{PARA}</div><article><h1>Head &amp; tail</h1><p><b>Short one.<br>  {PARA}<p>Tw.</p></article><footer>&copy; {PARA}</footer></body></html>",
        f"Head & tail\n\nShort one. {PARA}\n\nTw.",
    ),
    (f"<article><p>{PARA}</p></article><section id='comments'><p>{PARA}</p></section><aside>{PARA}</aside><form>{PARA}</form>", PARA),
    (f"<nav><div>never closed<article><p>{PARA}</p><div class='cookie-notice'><div>{PARA}</div>{PARA}</div><p>{PARA} 2</p></article>", f"{PARA}\n\n{PARA} 2"),
    (f"<div><p>{PARA}</p><p><a href=/a>one link and another link and more of it</a></p><p class='lead'>{PARA}&nbsp;x &lt;b&gt;</p></div><p cla", f"{PARA}\n\n{PARA} x <b>"),
    (f"<article><p>{PARA} a < b and 3 > 2</p></article><script>never closed {PARA}", f"{PARA} a < b and 3 > 2"),
    # End tags that may be missing.
    (f"<article><p class=\"ad\">Buy this and that of it<p>{PARA}<p>{PARA} 2</article>", f"{PARA}\n\n{PARA} 2"),
    (f"<article><ul><li class=\"share\">{PARA}<li>{PARA} 2<li>{PARA} 3</ul><p>{PARA}</article>", f"{PARA} 2\n\n{PARA} 3\n\n{PARA}"),
    (f"<table><tr><td class=menu>{PARA}<td><p>{PARA} 2<tr><td>{PARA} 3</table>", f"{PARA} 2\n\n{PARA} 3"),
    (f"<dl><dt class=ad>{PARA}<dd>{PARA} 2</dl>", f"{PARA} 2"),
    (f"<ul><li><ul><li class=ad>{PARA}</ul><p>{PARA} 2<li>{PARA} 3</ul>", f"{PARA} 2\n\n{PARA} 3"),
    # Names that hold a hint but tell a state, and layout elements.
    (f"<div class=\"content has-sidebar\"><p>{PARA}</p></div>", PARA),
    (f"<div id=\"post\" class=\"no-comments\"><p>{PARA}</p></div>", PARA),
    (f"<div class=\"layout sidebar-right\"><h1>Head</h1><p>{PARA}</p><p>{PARA} 2</p><div class=sidebar>{PARA}</div></div><div>{PARA} 3</div>", f"Head\n\n{PARA}\n\n{PARA} 2\n\n{PARA} 3"),
    (f"<body><form><nav><a href=/>x</a></nav><article><p>{PARA}</p></article><aside>{PARA}</aside></form></body>", PARA),
    (f"<body><form action=x><div><p>{PARA}</p><p>{PARA} 2</p></div></form><div>The foot of it and of the page, by us all.</div></body>", f"{PARA}\n\n{PARA} 2\n\nThe foot of it and of the page, by us all."),
    (f"<article><p>{PARA}</p><form><p>The name and the mail of you, for us to know.</p></form></article>", PARA),
    # Comments that are articles.
    (f"<article><p>{PARA}</p></article><div class=comments><article><p>{PARA} 2</p></article><article>{PARA} 3</article></div>", PARA),
    (f"<article><p>{PARA}</p><div id=\"comments\"><article><p>{PARA} 2</p></article>{PARA}</div></article>", PARA),
    (f"<article><p>{PARA}</p></article><section class=comment-list>" + f"<article><p>{PARA}</p></article>" * 9 + "</section>", PARA),
    # A sentence that is one link, and a headline that is one.
    (f"<article><p>{PARA}</p><p><a href=/x>It is the end of the road, and of the house by the sea.</a></p><p><a href=/y>All of the news of the day and more of it</a></p><p>{PARA}</p></article>", f"{PARA}\n\nIt is the end of the road, and of the house by the sea.\n\n{PARA}"),
]


@pytest.mark.parametrize("page, text", CASES)
def test_main_text(page, text):
    assert main_text(page) == text


def test_extract_keeps_rows_and_columns(spark):
    rows = [(i, p, "old", None) for i, (p, _) in enumerate(CASES)] + [(None, "<article><p>" + f"{PARA} " * 20_000, "x", None)] * 2
    pages = spark.createDataFrame(rows, "page_id long, html string, text string, url string")
    got = extract(pages)
    assert got.columns == ["page_id", "url", "text"]
    out = {r["page_id"]: r["text"] for r in got.collect()}
    assert all(out[i] == t for i, (_, t) in enumerate(CASES)) and out[None] == " ".join([PARA] * 20_000)
    assert got.count() == len(rows) and extract(pages.limit(0)).collect() == []


def generated(rng):
    """A page built around known paragraphs: random wrappers, missing end tags, boilerplate of every kind; and its text."""
    serial = iter(range(10_000))
    say = lambda: f"{PARA} No {next(serial)}."
    end = lambda tag: rng.choice([f"</{tag}>", ""])
    links = "".join(f"<li><a href=/{i}>link {i}</a>{end('li')}" for i in range(rng.randint(1, 6)))

    def junk():
        name = rng.choice(["ad", "top-ad x", "cookie-notice", "sidebar", "share", "related posts", "comments", "newsletter-box"])
        tag = rng.choice(["div", "section", "ul"])
        inner = f"<li>{say()}{end('li')}" if tag == "ul" else f"<p>{say()}{end('p')}"
        if name == "comments":
            inner = f"<article><p>{say()}{end('p')}</article>" * rng.randint(1, 5)
        return f'<{tag} class="{name}">{inner}</{tag}>'

    want, body = [], []
    for _ in range(rng.randint(3, 8)):
        kind = rng.choice("pppltjo")
        if kind == "p":
            want.append(say())
            body.append(f"<p>{want[-1]}{end('p')}")
        elif kind == "l":
            items = [say() for _ in range(rng.randint(1, 3))]
            body.append("<ul>" + "".join(f"<li>{x}{end('li')}" for x in items) + f"<li class=share>{say()}</ul>")
            want += items
        elif kind == "t":
            rows = [[say() for _ in range(2)] for _ in range(2)]
            body.append("<table>" + "".join("<tr>" + "".join(f"<td>{x}{end('td')}" for x in r) + end("tr") for r in rows) + "</table>")
            want += [x for r in rows for x in r]
        elif kind == "j":
            body.append(junk())
        else:
            body.append(f'<p class="ad">{say()}{end("p")}')
    if not want:
        want.append(say())
        body.append(f"<div>{want[-1]}</div>")
    wrap = rng.choice(["article", "main", 'div class="post no-comments"', 'div id="content" class="has-sidebar"', "div"])
    page = f"<{wrap}>{''.join(body)}</{wrap.split()[0]}>"
    if rng.random() < 0.3 and wrap in ("article", "main"):
        page = f"<form action=/all>{page}</form>"
    head = f"<header><ul>{links}</ul>{end('header')}" if wrap in ("article", "main") else f"<nav><ul>{links}</ul></nav>"
    return f"<html><body>{head}{junk()}{page}{junk()}<footer>{say()}</footer></body></html>", "\n\n".join(want)


def test_generated_pages():
    import random

    rng = random.Random(11)
    for _ in range(600):
        page, text = generated(rng)
        assert main_text(page) == text, page
