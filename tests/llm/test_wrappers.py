"""Page trees, wrapper inference, and the main text of whole pages."""

import json
import random
import re
from html import unescape

from pyspark.sql import functions as F

from vintagemart.llm import wrappers
from vintagemart.llm.markup import Slot, parse
from vintagemart.llm.queries import QUERIES
from vintagemart.llm.wrappers import Part, Wrapper, extract_main_text, main_text

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{margin:0}</style><script>var t="</p>";</script></head>
<body class="no-sidebar"><header class="site"><h1>Site</h1></header><nav><ul><li><a href=/x>Menu</a></li></ul></nav>
<!-- ad <p>x</p> --><div class="ad">Buy</div><div class="cookie-notice">Cookies</div>
<article><header><h1>The   Title</h1></header><p><b>One &amp; two<br>three<p>Four <a href="a>b">link</a>.
<ul><li>Item one<li>Item two</ul><form><p>Search</p></form><aside>Beside</aside>
<p>Five <span class="ad">ad</span>six</p><section id="comments"><h2>Comments</h2><p>First!</p></section></article>
<div class="sidebar"><article>Related</article></div><footer>&copy; me</footer></body></html>"""
TEXT = "The Title\nOne & two three\nFour link.\nItem one\nItem two\nFive six"


def text_of(html, *others):
    wrapper = Wrapper()
    for page in (html, *others):
        wrapper.add(parse(page))
    again = Wrapper(Part.unpacked(json.loads(wrapper.packed())))
    return main_text(parse(html), again)


def test_article_without_the_rest():
    assert text_of(PAGE) == TEXT
    assert text_of(PAGE, PAGE.replace("<ul><li>Item one<li>Item two</ul>", "")) == TEXT


def test_broken_markup():
    assert text_of("") == "" and text_of(None) == ""
    assert text_of("plain &lt;text&gt;") == "plain <text>"
    assert text_of("<article><p>cut off &am") == "cut off &am"
    assert text_of("<article><p>a</b></i></p></p><p>b<!-- open") == "a\nb"
    assert text_of("<article><p>a<script>if (a < b) x()") == "a"
    assert text_of("<article>a < b and c > d<p title='x>y'>e") == "a < b and c > d\ne"
    assert text_of("<p>a<b") == "a"
    assert text_of("<ARTICLE><P>A&nbsp;&#65;&#x42;</P></ARTICLE>") == "A AB"


def test_other_containers():
    assert text_of("<body><div id=nav>m</div><main><p>a</p><aside>b</aside></main><p>c") == "a"
    assert text_of('<div class="post-content"><p>a</p></div><div class="comments">b</div>') == "a"
    assert text_of('<div class="content-with-sidebar"><article>a</article></div>') == "a"


def test_words_in_names_do_not_drop_article_text():
    assert text_of("<article class='post hentry category-social tag-search'><h1>a</h1><p>b</p></article>") == "a\nb"
    page = (
        "<article><h2 id='related-work'>a</h2><h2 id='search'>b</h2><p id=comments>c</p>"
        "<section id='discussion'><h2>Discussion</h2><p>d</p></section><div class='tag-social'><p>e</p></div>"
        "<h3><span id='related'>f</span></h3>{}</article>"
    )
    text = "a\nb\nc\nDiscussion\nd\ne\nf"
    assert text_of(page.format("")) == text
    links = "<div class='related-posts'><ul><li><a href=/x>More</a><li><a href=/y>Yet more</a></ul></div>"
    assert text_of(page.format(links)) == text
    assert text_of("<body><div class='page tag-search'><p>a</p></div>") == "a"


def test_template_texts_outside_containers():
    page = "<div><a href=/>Home</a></div><p>{}</p><p>{} is long</p><div>All rights reserved</div>"
    pages = [page.format(f"Title {i}", f"Text {i}") for i in range(4)]
    assert text_of(*pages) == "Title 0\nText 0 is long"


def test_copies_of_a_page_are_one_page():
    page = "<div><h1>Title</h1><blockquote>Quote</blockquote><p>Text</p></div>"
    others = ["<div><h1>Unlike</h1><ul><li>x</ul></div>", "<div><h1>Other</h1><ol><li>y</ol></div>"]
    assert text_of(page, *[page] * 5, *others) == "Title\nQuote\nText"
    lines = "<table><tr><td>same<tr><td>same<tr><td>same<tr><td>same</table>"
    assert text_of(lines) == "same\nsame\nsame\nsame"


def test_plain_text_stays_where_other_pages_have_links():
    pages = ["<p>Plain words</p>", *(f"<p><a href=/{i}>A rather long link text {i}</a></p>" for i in range(3))]
    assert text_of(*pages) == "Plain words" and text_of(pages[1], *pages) == ""


def test_texts_that_repeat_over_the_host_are_not_the_article():
    words = ["winter", "river", "engine", "letter", "garden"]
    page = (
        "<article><h2>What this is all about</h2><p>A {0} is a {0} that is a {0} and nothing else.</p>"
        "<div class='x1'>This offer ends on Sunday night.</div><ul><li>Salt<li>Some {0}</ul>"
        "<p>Read it in the app and save.</p><ul class='x2'><li><a href=/h>Home</a><li><a href=/n>News</a></ul></article>"
    )
    pages = [page.format(w) for w in words]
    text = "What this is all about\nA winter is a winter that is a winter and nothing else.\nSalt\nSome winter"
    assert text_of(*pages) == text
    # Copies with small changes stay whole, and so do pages of a host with few pages.
    near = ["<article><p>This offer ends on Sunday night.</p><p>{}</p></article>".format(w) for w in words]
    assert text_of(*near) == "This offer ends on Sunday night.\nwinter"
    assert "Sunday" in text_of(*pages[:2], pages[0], pages[0])


def test_repeated_texts_are_counted_on_all_pages(spark):
    """A text on 74 of 100 unlike pages is the article's, one on 75 isn't, whatever pages
    have the lowest hashes and however often a page is there."""
    offer, app = "This offer ends on Sunday night.", "Read it in the app and save."
    rows = []
    for host in range(6):
        for i in range(100):
            more = f"<p>{offer}</p>" * (i < 74) + f"<p>{app}</p>" * (i < 75)
            html = f"<article><p>Page {i} of host {host} has a long text of its own to read here.</p>{more}</article>"
            rows += [(f"http://h{host}.example/{i}", html)] * (1 + 3 * (i == 0 or i == 99))
    df = spark.createDataFrame(rows, "url string, html string").repartition(5)
    found = extract_main_text(df, ["url"]).collect()
    assert len(found) == len(rows)
    for row in found:
        i = int(row["url"].rsplit("/", 1)[1])
        assert (offer in row["text"]) == (i < 74) and app not in row["text"]


def test_wrapper_has_optional_and_repeated_parts():
    wrapper = Wrapper()
    wrapper.add(parse("<article><h1>a</h1><p>b</p><p>c</p></article>"))
    wrapper.add(parse("<article><h1>a</h1><div>x</div><p>b</p></article>"))
    article = wrapper.root.children[0]
    assert [(p.mark, p.optional, p.repeated) for p in article.children] == [
        ("h1", False, False),
        ("div", True, False),
        ("p", False, True),
    ]
    low, high = article.children[0].children[0].seen[3:]
    assert low == high
    wrapper.add(parse("<article><h1>a</h1>" + "<h2>k</h2><p>v</p>" * 3 + "</article>"))
    groups = [p for p in wrapper.root.children[0].children if p.unit]
    assert [(g.unit, g.repeated) for g in groups] == [(("h2", "p"), True)]


def test_order_of_pages_does_not_matter_for_the_text():
    shapes = [PAGE, PAGE.replace("<p>Four", "<h2>s</h2><p>x</p><h2>s</h2><p>y</p><p>Four"), PAGE.replace("<aside>", "<div>")]
    for first in shapes:
        assert text_of(first, *shapes) == text_of(first, *reversed(shapes)) == text_of(first)


def odd_hosts(seed, hosts=12, pages=20):
    """Pages without containers, of blocks in any order, so alignments are ambiguous."""
    dice = random.Random(seed)
    for host in range(hosts):
        kinds = [f"<{t}>{{}}</{t}>" for t in dice.sample(["p", "h2", "div", "pre", "blockquote", "h3"], 4)]
        kinds.append("<div><a href=/>Home</a></div>")
        for page in range(pages):
            blocks = [dice.choice(kinds).format(dice.choice(["same", f"text {page}"])) for _ in range(dice.randint(1, 12))]
            yield f"http://h{host}.example/{page}", "".join(blocks)


def test_text_depends_on_the_finished_wrapper_alone(spark):
    for seed in range(3):
        by_host = {}
        for url, html in odd_hosts(seed):
            by_host.setdefault(url.split("/")[2], []).append(html)
        for pages in by_host.values():
            first = Wrapper()
            for html in pages:
                first.add(parse(html))
            packed = first.packed()
            used = Wrapper(Part.unpacked(json.loads(packed)))
            texts = [main_text(parse(html), used) for html in pages]
            alone = [main_text(parse(h), Wrapper(Part.unpacked(json.loads(packed)))) for h in pages]
            back = [main_text(parse(html), used) for html in reversed(pages)]
            assert texts == alone == back[::-1] and used.packed() == packed


def test_same_texts_when_pages_are_extracted_in_other_partitions(spark):
    """The wrappers are of one partitioning, the extraction is in two others."""
    df = spark.createDataFrame(list(odd_hosts(7)), "url string, html string")
    hosts = df.select(F.regexp_extract("url", wrappers.HOST, 1).alias("host"), "url", "html")
    made = wrappers.host_wrappers(hosts.select("host", "html").repartition(5, "html"))
    rows = hosts.join(made, "host").select(F.col("url").alias("c0"), "host", "html", "wrapper")
    cut = [
        sorted(map(tuple, part.mapInArrow(wrappers._extract(["c0"]), "c0 string, text string").collect()))
        for part in (rows.repartition(1).sort("html"), rows.repartition(6, "html"))
    ]
    assert cut[0] == cut[1] and len(cut[0]) == df.count()


def plain(html):
    """The article by plain patterns, for pages of the given tables."""
    body = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", body)
    texts = (" ".join(unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


def test_given_pages_and_edge_rows(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(wrappers, "FAN_IN", 2)
    monkeypatch.setattr(wrappers, "OPEN_HOSTS", 3)
    given = spark.read.parquet(f"{sf_dir}/pages.parquet").repartition(7)
    rows = QUERIES["op10_html_extraction"](spark, sf_dir).collect()
    expected = {r["page_id"]: plain(r["html"]) for r in given.collect()}
    assert {r["page_id"]: r["text"] for r in rows} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    odd = spark.createDataFrame(
        [(1, None, PAGE), (2, "no url", None), (3, "http://h/x", ""), (3, "http://h/x", PAGE), (3, "http://h/x", PAGE)],
        "page_id long, url string, html string",
    )
    found = extract_main_text(given.select("page_id", "url", "html").unionAll(odd), ["page_id", "url"])
    got = sorted((r["page_id"], r["text"]) for r in found.collect())
    more = [(1, TEXT), (2, ""), (3, ""), (3, TEXT), (3, TEXT)]
    assert got == sorted([*expected.items(), *more])


def test_empty_table_and_columns(spark):
    df = spark.createDataFrame([("http://a.example/", PAGE, 1, 2)], "url string, html string, host int, wrapper int")
    assert [tuple(r) for r in extract_main_text(df, ["host", "wrapper"]).collect()] == [(1, 2, TEXT)]
    assert extract_main_text(df.limit(0), ["host"]).count() == 0


def test_very_long_page():
    body = "".join(f"<p>Block {i}</p>" for i in range(20_000))
    text = text_of(f"<article>{body}</article>")
    assert text.count("\n") == 19_999
    assert isinstance(parse(body).children[0].children[0], Slot)


def test_deep_markup(spark):
    """Deep nesting costs no stack; texts and what stands beside the article are the same."""
    for depth in (50, 99, 600, 20_000):
        deep = "<div>" * depth
        page = f"{deep}<article><p>One<div class=ad>Buy</div>{deep}Two<p>Three</article>{'</div>' * depth}<nav>Menu</nav>"
        assert text_of(page, page.replace("Two", "Other")) == "One\nTwo\nThree", depth
    pages = [(f"http://a.example/{i}", "<div>" * 100_000 + f"text {i}") for i in range(3)]
    df = spark.createDataFrame(pages, "url string, html string")
    found = {r["url"]: r["text"] for r in extract_main_text(df, ["url"]).collect()}
    assert found == {url: html.rsplit(">", 1)[1] for url, html in pages}
