from __future__ import annotations

import re
from html import unescape

from tillroll.llm.html_extract import expression, extract, infer, main_text, matched, tokens, wrapper_rules

PAGE = """<!DOCTYPE html><html><head><title>T {n}</title><style>p{{}}</style><script>var a="</p><article>";</script></head><body>
<nav><ul><li><a href="/a">one</a></li><li>two {n}</li></ul></nav><div class="ad">buy {n}</div><div id="cookie-notice">We use cookies</div>
<article><h1>Head {n} &amp; more</h1><p>First <b>bold</b> part {n}<br>next&nbsp;line &lt;p&gt;</p>{more}<div class="comments"><p>I disagree {n}</p></div></article>
<aside>side</aside><form><label>Name</label><input></form><footer>&copy; host</footer></body></html>"""


def pages(k):
    return [PAGE.format(n=f"n{i}", more="".join(f"<p>par {i}.{j}" for j in range(i % 4))) for i in range(k)]


def want(i):
    return "\n".join([f"Head n{i} & more", f"First bold part n{i} next line <p>", *(f"par {i}.{j}" for j in range(i % 4))])


def test_article_alone_is_left(spark):
    rows = [(i, f"https://h{i % 2}.example/{i}", p, "x") for i, p in enumerate(pages(20))]
    rows += [(50, None, None, "x"), (51, "https://h0.example", "", "x"), (None, "nonsense", "plain &amp; text", "x"), (3, "https://h1.example/3", pages(4)[3], "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = main_text(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert all(by[i] == want(i) for i in range(20))
    assert by[50] == by[51] == "" and by[None] == "plain & text"
    assert main_text(df.limit(0)).count() == 0


def test_wrapper_has_slots_options_and_repeats():
    text = expression(infer(pages(8)))
    assert "#text" in text and ")?" in text and ")+" in text and "'© host'" in text


def test_constant_text_outside_an_article_goes():
    page = "<body><div><p>Same on all</p></div><section><p>own {n}</p><p>more {n}</p></section></body>"
    import json

    rules = json.loads(wrapper_rules([page.format(n=i) for i in range(4)]))
    assert extract(page.format(n=9), rules) == "own 9\nmore 9"


def test_broken_markup():
    assert extract("<p><b>a<br><p>b < c <i", {}) == "a\nb < c <i"
    assert extract("<article><p title='x>y'>a</p><!-- <p>no</p> --><p>b", {}) == "a\nb"
    assert extract("<" * 20_000 + '<a href="' * 2_000, {}) != ""


def test_long_unclosed_markup_takes_linear_time():
    import time

    for piece in ("<a ", "<!", "<a href=\"", "<a 'x<b \"y", "</p ", "<div>", "<div id=x>", "<i></b>", "<p class=a><b>", "<!-- ", "<script ", "</"):
        for unit in (piece, f"{piece}x "):
            page = unit * (1_000_000 // len(unit))
            began = time.perf_counter()
            for _ in tokens(page):
                pass
            assert time.perf_counter() - began < 5, unit
    # Deep nesting and closes of what isn't open.
    deep = "".join(f"<div class=c{k}>" for k in range(20_000)) + "text" + "</span></div>" * 20_000
    began = time.perf_counter()
    assert extract(deep, {}) == "text" and time.perf_counter() - began < 10


def test_wrapper_decides_in_articles():
    """A constant of the wrapper goes from articles too: without the wrapper the same
    page keeps it."""
    import json

    page = "<body><article><h1>Title {n}</h1><p>Own first text {n}</p><h5>Read by our editors</h5><p>Own other text {m}</p></article></body>"
    some = [page.format(n=i, m=i * i + 100) for i in range(6)]
    rules = json.loads(wrapper_rules(some))
    assert rules["article"] == {"/body/article/h5": ["Read by our editors"]}
    assert extract(some[3], rules) == "Title 3\nOwn first text 3\nOwn other text 109"
    assert extract(some[3], {}) == "Title 3\nOwn first text 3\nRead by our editors\nOwn other text 109"
    # Copies of one article, and what few of the pages say, are no constants.
    copies = [page.format(n=1, m=2) + f"<p>{i}</p>" for i in range(8)]
    assert json.loads(wrapper_rules(copies))["article"] == {}
    assert json.loads(wrapper_rules([*some[:2], *(x.replace("<h5>Read by our editors</h5>", "") for x in some[2:])]))["article"] == {}


def brute_blocks(html):
    """The blocks of a well-formed page's articles, by Python's own parser."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out, self.own, self.open = [], [], []

        def cut(self):
            if text := " ".join("".join(self.own).split()):
                self.out.append(text)
            self.own = []

        def handle_starttag(self, tag, attrs):
            if tag == "br":
                self.own.append(" ")
            elif tag != "b":
                self.cut()
                self.open.append(tag)

        def handle_endtag(self, tag):
            if tag != "b" and tag in self.open:
                self.cut()
                while self.open.pop() != tag:
                    pass

        def handle_data(self, data):
            if "article" in self.open and not {"nav", "aside", "footer", "script", "style", "form", "header"} & set(self.open[: self.open.index("article")]):
                self.own.append(data)

    reader = Reader()
    reader.feed(html)
    reader.close()
    return "\n".join(reader.out)


def test_query_against_another_parser(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in main_text(df).collect()}
    want = {r.page_id: brute_blocks(r.html) for r in df.collect()}
    assert len(want) > 200 and got == want


def test_recall_of_planted_furniture(spark):
    """Notices without a telling tag or name, of half of a host's pages in articles and of a
    tenth outside, and how many of them go; nothing else does."""
    import random

    rnd = random.Random(4)
    own = lambda: " ".join(rnd.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rnd.randrange(9999)) for _ in range(12))
    rows, planted, kept = [], {}, {}
    for i in range(240):
        host = i % 3
        inside = [f"Offer of host {host} in articles"] if rnd.random() < 0.6 else []
        outside = [f"Maintenance at host {host}"] if rnd.random() < 0.1 else []
        first, second = own(), own()
        article = f"<article><h2>{own()}</h2><p>{first}</p>{''.join(f'<p>{x}</p>' for x in inside)}<p>{second}</p></article>" if host else f"<div><p>{first}</p><p>{second}</p></div>"
        rows.append((i, f"https://h{host}.example/{i}", f"<body><section>{''.join(f'<p>{x}</p>' for x in outside)}</section>{article}</body>"))
        planted[i] = (inside if host else []) + outside
        kept[i] = [first, second]
    got = {r.page_id: r.text.split("\n") for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(set(kept[i]) <= set(got[i]) for i in got)
    total = sum(map(len, planted.values()))
    gone = sum(x not in got[i] for i in got for x in planted[i])
    assert total > 100 and gone >= 0.9 * total


def test_whole_table(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/pages.parquet")
    for r in main_text(df).join(df, "page_id").collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"</?b>|<br>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(b for b in blocks if b)


def test_text_that_one_page_has_alone_stays():
    import json

    page = "<body><div><p>Same on all</p></div><section><p>own {n}</p></section>{more}</body>"
    some = [page.format(n=i, more="<blockquote>just here</blockquote>" if i == 1 else "") for i in range(4)]
    rules = json.loads(wrapper_rules(some))
    assert extract(some[1], rules) == "own 1\njust here"
    # An optional text that differs is a slot.
    some = [page.format(n=i, more=f"<blockquote>note {i}</blockquote>" if i else "") for i in range(4)]
    assert extract(some[2], json.loads(wrapper_rules(some))) == "own 2\nnote 2"


def test_long_pages_are_aligned_whole():
    import json

    body = "".join(f"<{t}>x{k % 7}</{t}>" for k in range(30_000) for t in (["p", "h2", "div", "pre"][k * k % 11 % 4],))
    some = [f"<body>{body}<section><p>own {i}</p></section><address>Same</address></body>" for i in range(3)]
    rules = json.loads(wrapper_rules(some))
    assert rules["constant"]["/body/address"] == ["Same"] and extract(some[0], rules).endswith("own 0")


def test_matches_rise_in_both():
    pairs = matched(list("xaybz"), list("abx"))
    assert pairs == [(1, 0), (3, 1)] and matched([], ["a"]) == []


def test_names_of_a_layout_are_not_furniture():
    inner = '<div class="entry-header"><h1>Title</h1></div><p>text</p><div class="share">share it</div>'
    around = "<body><div class='menu'>menu</div>{}<div class='sidebar'>side</div></body>"
    for open_, close in (
        ("<main class='content no-sidebar'>", "</main>"), ("<article class='post has-sidebar'>", "</article>"), ("<article class='social'>", "</article>"),
        ("<main><article id='alert'>", "</article></main>"), ("<div class='search'><article>", "</article></div>"), ("<div class='with-sidebar'><article>", "</article></div>"),
    ):
        assert extract(around.format(open_ + inner + close), {}) == "Title\ntext", open_
    assert extract(around.format("<div class='no-sidebar'><p>text</p></div>"), {}) == "text"
    # Where there is another article, those within furniture stay out, as do replies within it.
    page = "<article><p>text</p><article class='comment'>I disagree</article></article><div class='related'><article>other</article></div>"
    assert extract(around.format(page), {}) == "text"


def test_furniture_without_hints(spark):
    def page(i, article):
        open_, close = ("<article>", "</article>") if article else ("<div>", "</div>")
        return f"<body>{open_}<p>Own first text {i}</p><p>Our spring offer</p><p>Second line of it</p><p>Own other text {i * i} here</p><h3>More</h3>{close}<p>Below</p><p>And last</p></body>"

    rows = [(i, f"https://{'ab'[i % 2]}.example/{i}", page(i, i % 2)) for i in range(40)]
    # Copies of one page are no reason to drop its text.
    rows += [(100 + i, "https://c.example/", f"<body><article><p>One text</p><p>of copies</p></article>{i}</body>") for i in range(20)]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Own first text {i}\nOwn other text {i * i} here" for i in range(40))
    assert all(got[100 + i] == "One text\nof copies" for i in range(20))


def test_layouts_beyond_the_wrapper_pages(spark):
    def page(i):
        k = chr(97 + i % 30)
        notice = "<p>Maintenance tonight</p>" if i // 30 == 2 else ""
        return f"<body><div class='lay{k}' id='page-{i}'><h4>Head of {k}</h4><p>Own first text {i}</p>{notice}<p>Own other text {i}</p><h5>Foot of {k}</h5></div></body>"

    rows = [(i, f"https://a.example/{i}", page(i)) for i in range(300)]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert got == {i: f"Own first text {i}\nOwn other text {i}" for i in range(300)}


def test_wrapper_of_all_pages(spark):
    """The wrapper holds what any page of a host has, and a text that most pages share
    is a slot if one has another in its place."""
    import json

    from pyspark.sql import functions as F

    from tillroll.llm.html_extract import ALIGNED, host_wrappers, places

    def page(i):
        rare = f"<blockquote>Printed by order {i}</blockquote>" if i == 173 else ""
        return f"<body><div><p>Posted <b>by staff</b></p></div><section><h4>{'Other' if i == 60 else 'Same'}</h4><p>own {i}</p></section>{rare}<address>Printed here</address></body>"

    rows = spark.createDataFrame([("h", page(i)) for i in range(300)], "host string, html string")
    (found,) = host_wrappers(rows.repartition(5)).collect()
    at = places(json.loads(found.wrapper))
    assert at["/body/blockquote"] == {"Printed by order 173"}
    assert at["/body/section/h4"] == {None} and at["/body/address"] == {"Printed here"}
    assert 300 > ALIGNED**2

    df = rows.select(F.monotonically_increasing_id().alias("page_id"), F.lit("https://h/").alias("url"), "html")
    got = {r.text.split("\n")[-1 if "order" not in r.text else -2]: r.text for r in main_text(df).collect()}
    assert got.keys() == {f"own {i}" for i in range(300)}
    assert not any("staff" in x or "here" in x for x in got.values()) and got["own 173"].endswith("Printed by order 173")
