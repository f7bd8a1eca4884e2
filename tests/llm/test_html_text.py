"""Main text: what stays, what goes, and which subtrees count as a host's template."""
from eventide.llm import op3_html_text as op3
from eventide.llm.op3_html_text import Page

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><header class="site-header"><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></li></ul></nav>
<div id="wrapper" class="content-with-sidebar"><div class="cookie-banner"><p>We use</div><div class="ad">Buy</div><main>
<article class="post"><header><h1>T &amp; x</h1></header><p>One<br>two  <b>three</b>
<p>Four&nbsp;&lt;5&gt; &eacute;&#33;<ul><li>a<li>b <i>c</i></ul><div class="share">Share!</div><!-- no <p>comment -->
<section id="comments"><article class="comment"><p>nice</p></article></section><aside>side</aside>
<table><tr><td>1<td>2<tr><td>3</table><form><p>email</p></form><p hidden>gone</p></article></main><div class="sidebar-left">x</div></div>
<footer>f</footer></body></html>"""


def test_article_without_what_surrounds_it():
    assert Page(PAGE).text() == "T & x\n\nOne two three\n\nFour <5> é!\n\na\n\nb c\n\n1\n\n2\n\n3"


def test_cut_off_and_odd_markup():
    assert Page("").text() == ""
    assert Page("<div><p>hello</div> tail <!-- x").text() == "hello\n\ntail"
    assert Page("a < b <script>if(a<b)</scr").text() == "a < b"
    assert Page("<p title='x>y'>q</p><p>r <a href=\"/cut").text() == "q\n\nr"
    assert Page("<article><h1>h</h1><p><b>bold<br><p>next &am").text() == "h\n\nbold\n\nnext &am"
    assert Page("</p></div><p>x</span></p>").text() == "x"
    assert Page("<p>" * 3000 + "deep" + "<div>" * 3000 + "er").text() == "deep\n\ner"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "t", 1, "c") for i, u, h in rows], "page_id long, url string, html string, text string, rid long, cut string")


def test_templates_of_a_host_are_deleted(spark):
    box = "<div class='x1'><p>All rights of this box</p><ul><li>one</li></ul></div>"
    page = lambda k: f"<body>{box}<div><p>Story {k} begins.</p><p>Story {k} ends.</p></div></body>"
    rows = [(k, f"http://a.com/{k}", page(k)) for k in range(6)]
    rows += [(10 + k, f"http://b.com/{k}", page(k)) for k in range(2)]            # too few pages to tell
    rows += [(20 + k, f"http://c.com/{k}", page(7)) for k in range(9)]            # copies of one page are one
    rows += [(40, "http://a.com/x", None), (41, None, page(9)), (42, "http://A.COM/9", page(9)), (42, "http://A.COM/9", page(9))]
    got = op3.main_text(frame(spark, rows))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    by = {}
    for r in got.collect():
        assert r.n_chars == len(r.text)
        by.setdefault(r.page_id, []).append(r.text)
    story = lambda k: f"Story {k} begins.\n\nStory {k} ends."
    boxed = lambda k: "All rights of this box\n\none\n\n" + story(k)
    assert all(by[k] == [story(k)] for k in range(6)) and by[42] == [story(9)] * 2
    assert all(by[10 + k] == [boxed(k)] for k in range(2)) and all(by[20 + k] == [boxed(7)] for k in range(9))
    assert by[40] == [""] and by[41] == [boxed(9)]


def test_paragraphs_of_an_article_are_no_template(spark):
    rows = [(k, f"http://a.com/{k}", f"<article><p>Said on every page.</p><p>Only {k}.</p><div><p>Follow us</p></div></article>") for k in range(7)]
    got = {r.page_id: r.text for r in op3.main_text(frame(spark, rows)).collect()}
    assert got == {k: f"Said on every page.\n\nOnly {k}." for k in range(7)}


def test_near_copies_keep_their_text(spark):
    """Six near-copies differ in their headline alone; the host has many other pages with its box."""
    body = "<p>Said of the matter at some length.</p><p>And more of it.</p><ul><li>shared one</li><li>shared two</li></ul>"
    said = "Said of the matter at some length.\n\nAnd more of it.\n\nshared one\n\nshared two"
    box = "<div class='x1'><p>Follow us</p></div>"
    kinds = {"a.com": lambda k, text: f"<article><h1>Head {k}</h1><div>{text}</div>{box}</article>",
             "b.com": lambda k, text: f"<main><h1>Head {k}</h1><section>{text}</section>{box}</main>",
             "c.com": lambda k, text: f"<body>{box}<h1>Head {k}</h1><div>{text}</div></body>",
             "d.com": lambda k, text: f"<body>{box}<h1>Head {k}</h1>{text}</body>"}
    for n, hosts in ((14, ["a.com", "b.com"]), (80, list(kinds))):  # with 14 others the copies are more than a tenth of the pages
        rows = [(100 * i + k, f"http://{host}/{k}", kinds[host](k, body if k < 6 else f"<p>Story {k} goes on.</p>"))
                for i, host in enumerate(hosts) for k in range(6 + n)]
        got = {r.page_id: r.text for r in op3.main_text(frame(spark, rows)).collect()}
        for i, host in enumerate(hosts):
            for k in range(6 + n):
                assert got[100 * i + k] == f"Head {k}\n\n" + (said if k < 6 else f"Story {k} goes on."), (host, n, k)


def test_all_pages_of_a_host_are_near_copies(spark):
    rows = [(k, f"http://a.com/{k}", f"<article><h1>Head {k}</h1><div><p>Said of the matter at some length.</p></div></article>") for k in range(6)]
    got = {r.page_id: r.text for r in op3.main_text(frame(spark, rows)).collect()}
    assert got == {k: f"Head {k}\n\nSaid of the matter at some length." for k in range(6)}


def test_empty_table(spark):
    assert op3.main_text(frame(spark, [])).collect() == []


def test_given_pages(spark):
    """Pages of the test tables: the text is the article's, between its tags."""
    import html
    import re
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in op3.main_text(pages).collect()}
    for p in pages.collect():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", p.html, re.S)[1]
        article = re.sub(r"<br>", " ", article)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*(?:>|\Z)", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[p.page_id] == "\n\n".join(b for b in blocks if b)


def test_article_in_a_form_or_an_unclosed_menu():
    assert Page("<form id=aspnetForm><div class=menu>m</div><article><p>A b</p></article></form>").text() == "A b"
    assert Page("<nav><ul><li>x<article><p>A b</p></article>").text() == "A b"
    assert Page("<form><div><p>a page in a form</p></div><input></form><footer>f</footer>").text() == "a page in a form"
    assert Page("<div id=comments><article><p>nice</p></article></div><main><p>t</p></main>").text() == "t"


def test_nothing_else_goes_from_an_article():
    html = "<article><p class=notice>n</p><div class=related>r</div><math><mi>x</mi></math><div class=ad>a</div><aside>s</aside></article>"
    assert Page(html).text() == "n\n\nr\n\nx"


def test_deep_and_unclosed_markup_takes_linear_time():
    import time
    for html in ("<div>" * 100_000 + "x", "<b>" * 50_000 + "</i>" * 50_000 + "x", "<ul>" + "<div>" * 50_000 + "<li></li>" * 50_000 + "x",
                 "<p><table><tr><td>" + "<div>" * 50_000 + "x", "<main>" * 50_000 + "x", "<nav>" * 50_000 + "<article>x"):
        start = time.time()
        page = Page(html)
        assert page.text() == "x" and len(page.subtrees()) <= len(page.hashes)
        assert time.time() - start < 15


def test_counts_of_subtrees(spark):
    """Template subtrees by their definition, counted plainly over random pages, against the query's."""
    import random
    from collections import defaultdict
    rng = random.Random(8)
    pieces = [f"<div class='k{i}'><p>box {i}</p></div>" for i in range(6)] + [f"<div class='ad{i}'>advert {i}</div>" for i in range(4)]
    rows = []
    for i in range(60):
        own = [rng.choice(pieces) for _ in range(rng.randint(0, 4))] + [f"<div><p>Own story {rng.randint(0, 40)}.</p><p>Goes on.</p></div>"]
        rng.shuffle(own)
        rows.append((i, f"http://{rng.choice('ab')}.com/{i}", "<body>" + "".join(own) + "</body>"))
    seen, kinds, texts = defaultdict(set), defaultdict(list), defaultdict(set)
    for _, url, html in rows:
        page, host = Page(html), url[7]
        text = "\n".join(b[0] for b in page.said())
        texts[host].add(text)
        for h, kind in page.subtrees().items():
            kinds[host, h].append((text, kind))
    want = defaultdict(set)
    for (host, h), all_ in kinds.items():
        by_text = defaultdict(int)
        for text, kind in all_:
            by_text[text] |= kind
        n = sum(not k & op3._MOST for k in by_text.values())
        strict, named = any(k & op3._STRICT for k in by_text.values()), all(k & op3._NAMED_SO for k in by_text.values())
        if n >= op3.FEW_PAGES and (n >= op3.MANY_PAGES and op3.PART * n >= len(texts[host]) and not strict
                                   or 2 * n >= len(texts[host]) or named):
            want[host].add(h)
    got = {r.page_id: r.text for r in op3.main_text(frame(spark, rows)).collect()}
    assert got == {i: Page(html).text(want[url[7]]) for i, url, html in rows}
    assert any(want.values())
