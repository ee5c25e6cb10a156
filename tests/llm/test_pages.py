"""Main texts of pages that were written with their expected text, and style trees against a plain
reader of the same pages."""

import math
import random
from collections import Counter, defaultdict
from html.parser import HTMLParser

import pytest

from clientlens.llm import pages

PAGE = """<!DOCTYPE html><html lang="en"><head><title>Title</title><style>p{{}}</style></head>
<body class="blog single-post"><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><aside id="left">Side</aside>
<{main}><h2>Head &amp; more</h2><p>One  <b>two<br>three<p>four<span class="ad">buy</span> five &lt;i&gt; &#8212; &nbsp;x
<ul><li>a<li>b</ul><table><tr><td>c<td>d</table><form><p>name</p></form><div class="comments"><p>reader</p></div>
<script>if (a < b) "</p>"</script><!-- <p>hidden</p> --><p style="display: none">unseen<p>end</{close}>
<footer>&copy; site</footer></body></html>"""
TEXT = "Head & more\nOne two three\nfour five <i> — x\na\nb\nc\nd\nend"


@pytest.mark.parametrize("main", ["article", "main", 'div class="post-content"', "div id=content", 'section role="main"'])
def test_main_text(main):
    page = PAGE.format(main=main, close=main.split()[0])
    assert pages.extract(pages.parse(page), {}) == TEXT


@pytest.mark.parametrize("opening", ["div class='social-history'", "section class='search-algorithms'", "p class='alert'", "div id='comment-policy'"])
def test_names_that_only_hold_a_word_of_noise(opening):
    inside = f"<{opening}>kept</{opening.split()[0]}>"
    assert pages.extract(pages.parse(f"<article><p>a</p>{inside}</article>"), {}) == "a\nkept"


@pytest.mark.parametrize("name", ["comments-area", "ad-slot-1", "commentList", "Sponsored box"])
def test_adverts_and_comments_within_an_article(name):
    assert pages.extract(pages.parse(f"<article><p>a</p><div class='{name}'>b</div></article>"), {}) == "a"


@pytest.mark.parametrize("name", ["cookie-notice", "left-sidebar", "related_links", "siteNav", "social"])
def test_names_of_noise_in_a_body(name):
    assert pages.extract(pages.parse(f"<body><p>a</p><div id='{name}'>b</div><div class='social-history'>c</div>"), {}) == "a\nc"


def test_header_of_an_article():
    page = "<article><header><h1>Title</h1><p>by me</p></header><p>text</p></article>"
    assert pages.extract(pages.parse(page), {}) == "Title\ntext"


def test_odd_markup():
    cases = {
        "": "", "  \n ": "", "plain": "plain", "<": "<", "a < b": "a < b", "<p": "<p", "</div></p>a<p>b": "a\nb",
        "<div>" * 3000 + "x": "x", "<p>a</p>tail": "a\ntail", "<!-- open": "", "<script>x": "", "a<br>b": "a b",
        "<p title='a > b'>c</p>": "c", "<P>A<P>B": "A\nB", "<b>a<p>b</b>c": "a\nbc", "x&ampy &#x41;&bogus;": "x&y A&bogus;",
    }
    for page, text in cases.items():
        assert pages.extract(pages.parse(page), {}) == text, page


def test_hosts():
    assert [pages.host_of(u) for u in ("HTTP://A.b:80/x", "https://u@c?d", "x", None, "//e")] == ["a.b", "c", "", "", ""]


@pytest.fixture
def site(spark):
    rows = []
    for i in range(8):
        body = f"<div class='wrap'><div class='t'>story {i}</div><p>plain</p></div><div class='box'>Follow us</div>"
        rows.append((i, f"http://one.example/{i}", f"<body>{body}</body>"))
        rows.append((100 + i, f"http://two.example/{i}", f"<article><p>same</p><div class='box{i}'>Follow</div><div class='k'>own {i}</div></article>"))
    rows += [(50, None, None), (51, "", ""), (52, "bad url", "<p>x</p>"), (52, "bad url", "<p>x</p>"), (None, "http://one.example/z", "z")]
    return spark.createDataFrame([(*r, "x", "x") for r in rows], "page_id long, url string, html string, host string, removed string")


def test_branches_that_all_pages_of_a_site_share(site):
    found = [(r.page_id, r.text, r.n_chars) for r in pages.main_texts(site).collect()]
    texts = {i: t for i, t, _ in found}
    # The box is the same on all pages; in an article plain paragraphs stay even so.
    assert texts[3] == "story 3"
    assert texts[103] == "same\nown 3"
    assert (texts[50], texts[51], texts[52], texts[None]) == ("", "", "x", "z")
    assert len(found) == site.count() and all(n == len(t) for _, t, n in found)


def test_importance(site):
    nodes = {(r.host, r.path): r for r in pages.style_trees(site).collect()}
    box = nodes["one.example", pages.parse("<body><div class='box'>x").blocks[0].path]
    story = nodes["one.example", pages.parse("<body><div class='wrap'><div class='t'>x").blocks[0].path]
    assert box.pages == 8 and box.importance == pytest.approx(0) and story.content == pytest.approx(1)


class Plain(HTMLParser):
    """Texts and child sequences by path, of well-formed pages without inline elements."""

    def __init__(self, text):
        super().__init__()
        self.stack, self.texts, self.sequences = [((), [])], [], defaultdict(list)
        self.feed(text)

    def handle_starttag(self, tag, attrs):
        path = (*self.stack[-1][0], (tag, dict(attrs).get("class")))
        self.stack[-1][1].append(path)
        self.stack.append((path, []))

    def handle_endtag(self, tag):
        path, children = self.stack.pop()
        self.sequences[path].append(tuple(c for i, c in enumerate(children) if not i or c != children[i - 1]))

    def handle_data(self, data):
        self.texts.append((self.stack[-1][0], data))


def entropy(counts):
    whole = sum(counts)
    return -sum(c / whole * math.log(c / whole) for c in counts)


def plain_trees(site):
    """For each path its pages, presentation and content importance."""
    read = [Plain(text) for text in site]
    nodes = {}
    for path in {p for page in read for p in page.sequences}:
        layouts = Counter(tuple(page.sequences[path]) for page in read if path in page.sequences)
        m = sum(layouts.values())
        texts = [{t for p, t in page.texts if p == path} for page in read]
        each = [sum(t in found for found in texts) for t in set().union(*texts)]
        spread = [entropy([1] * n) for n in each] or [math.log(m)]
        shares = (1.0, 1.0) if m == 1 else (entropy(layouts.values()) / math.log(m), 1 - sum(spread) / len(spread) / math.log(m))
        nodes[path] = (m, *shares)
    return read, nodes


def random_site(rng, size):
    """Pages without a main element: boxes of fixed, pooled and own texts, in changing orders."""
    for i in range(size):
        parts = [f"<div class='box'><p>{rng.choice(['Follow us', 'Join us'])}</p></div>"] * rng.randrange(3)
        parts += [f"<div class='own'><p>story {i} {k}</p><p>same</p></div>" for k in range(rng.randrange(3))]
        parts += ["<section class='foot'>all rights</section>"] * rng.randrange(2)
        rng.shuffle(parts)
        yield f"<body><div class='wrap'>{''.join(parts)}</div><div class='id'>page {i}</div></body>"


@pytest.mark.parametrize("seed", [1, 2])
def test_trees_against_a_plain_reader(spark, seed):
    rng = random.Random(seed)
    sites = {f"h{size}.example": list(random_site(rng, size)) for size in (1, 2, 3, 12, 40)}
    rows = [(i, f"http://{host}/", text) for host, site in sites.items() for i, text in enumerate(site)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    trees = defaultdict(list)
    for r in pages.style_trees(df).collect():
        trees[r.host].append((r.pages, round(r.presentation, 9), round(r.content, 9)))
    got = {(r.url.split("/")[2], r.page_id): r.text for r in pages.main_texts(df).collect()}
    changed = 0
    for host, site in sites.items():
        read, nodes = plain_trees(site)
        assert Counter(trees[host]) == Counter((m, round(x, 9) + 0.0, round(y, 9) + 0.0) for m, x, y in nodes.values())
        for i, page in enumerate(read):
            say = lambda p: (nodes[p][0] * max(nodes[p][1:]) + pages.DOUBT) / (nodes[p][0] + pages.DOUBT)
            kept = [t for p, t in page.texts if say(p) > pages.LEAST_IN_BODY] or [t for _, t in page.texts]
            assert got[host, i] == "\n".join(kept)
            changed += len(kept) < len(page.texts)
    assert changed > 20


def test_a_site_of_copies_and_a_host_with_many_nodes(spark):
    rows = [(i, "http://copies.example/", "<p>one text</p>") for i in range(30)]
    many = "".join(f"<div class='c{chr(97 + k // 26 % 26)}{chr(97 + k % 26)}{chr(97 + k // 676)}'>fixed {k}</div>" for k in range(1500))
    rows += [(100 + i, "http://many.example/", f"<body><p>own {i}</p>{many}</body>") for i in range(6)]
    found = {r.page_id: r.text for r in pages.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(found[i] == "one text" for i in range(30)) and all(found[100 + i] == f"own {i}" for i in range(6))


def test_nothing(site):
    assert pages.main_texts(site.limit(0)).count() == 0
