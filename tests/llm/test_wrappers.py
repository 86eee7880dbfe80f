import pytest
from pyspark.sql import functions as F

from fleetmart.llm import QUERIES, wrappers


def one(page):
    return wrappers.extract(page, None)


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("plain  words", "plain words"), ("<p>a<p>b", "a\nb"), ("<p>a &amp; b&nbsp;&lt;c&gt;<br>d</p>", "a & b <c> d"),
    ("<body><nav><a>m</a></nav><article><h1>T</h1><p><b>x<br><p>y</p></article><footer>f</footer>", "T\nx\ny"),
    ("<article><p>a</p><div class='comments'><p>no</p></div><aside>no</aside><form>no</form><p>b</p></article>", "a\nb"),
    ("<div id=content><p>long text here<script>var a='<p>no</p>';</script></p></div><div class='ad'>no</div>", "long text here"),
    ("<main><ul><li>1<li>2</ul><table><tr><td>3<td>4</table></main>", "1\n2\n3\n4"), ("<p>un<!-- no -->der <i>line</i>d", "under lined"),
    ("<article><p>2 < 3 and <a title='>'>c</a> <span class=\"share\">no</span> end", "2 < 3 and c end"), ("<article <p", ""),
])
def test_one_page(page, text):
    assert one(page) == text


def test_matching():
    tree = lambda page: wrappers.Group("html", [wrappers.parse(page)])
    a, b = tree("<div><h1>x</h1><p>a</p><ul></ul></div>"), tree("<div><p>b</p><ul></ul><pre></pre></div>")
    assert wrappers.matching(a, a) == 5 and wrappers.matching(a, b) == wrappers.matching(b, a) == 4
    merged = wrappers.merge(a.template(), b.template())
    assert [(k["key"], k["pages"]) for k in merged["kids"][0]["kids"]] == [("h1", 1), ("p", 2), ("ul", 2), ("pre", 1)]


def test_frame_and_slots():
    """Text that is the same on all pages is frame, though nothing names it so."""
    make = lambda i: (
        f"<div class=x1><span>Site</span></div><div class=body{i}><div class=by>All rights</div><p>text {i} " + f"w{i} " * 30
        + "</p><section class=tail><p>Read on</p></section></div><div class=y>same bottom</div>")
    pages = [make(i) for i in range(8)]
    whole = None
    for page in pages:
        t = wrappers.Group("html", [wrappers.parse(page)]).template()
        whole = wrappers.merge(whole, t) if whole else t
    wrapper = wrappers.induce(whole)
    assert wrappers.extract(pages[3], wrapper) == ("text 3 " + "w3 " * 30).strip() + "\nRead on"
    assert wrappers.extract("<p>other page</p>", wrapper) == "other page"


def wrapper_of(pages):
    whole = None
    for page in pages:
        t = wrappers.Group("html", [wrappers.parse(page)]).template()
        whole = wrappers.merge(whole, t) if whole else t
    return wrappers.induce(whole)


@pytest.mark.parametrize("page", [
    "<ul><li>Home<li>About</ul><div id=content>{same}<h1>Title {i}</h1><div class=body><p>{long}</p></div></div><div><p>Imprint</p></div>",
    "<h1>Title {i}</h1><div>{same}<article><p>{long}</p></article></div>",
    "<div class=first><h1>Title {i}</h1><p>{long}</p></div><ol>{same}<li>one<li>two</ol><div class=second><p>{more}</p></div>",
    "<section>Title {i}<div class=by>{same}<p>{more}</p></div><div><p>{long}</p></div></section>",
])
def test_what_varies_beside_the_content_stays(page):
    """A headline beside the body, an article over two blocks, own text around them; the frame goes."""
    fill = lambda i: {"i": i, "same": "Our site", "long": f"text w{i} " * 65, "more": f"rest v{i} " * 35}
    pages = [page.format(**fill(i)) for i in range(8)]
    wrapper = wrapper_of(pages)
    for i in range(8):
        parts = sorted((page.find("{" + name + "}"), name) for name in ("i", "long", "more") if "{" + name + "}" in page)
        text = [f"Title {i}" if name == "i" else fill(i)[name].strip() for _, name in parts]
        assert wrappers.extract(pages[i], wrapper) == "\n".join(text)


@pytest.mark.parametrize(("page", "text"), [
    ("<article class='post has-sidebar'><p>long text</p></article><div class=ad>no</div>", "long text"),
    ("<article class=ad><p>a</p></article><div class=comments><p>a longer comment</p></div>", "a"),
    ("<div id='content' class='no-comments'><p>a</p></div><p>other words</p>", "a\nother words"),
    ("<main class='with-banner' role=main><p>long text</p></main>", "long text"),
    ("<div id='search-results'><p>long text</p></div><div id=search><p>no</p></div>", "long text"),
    ("<div class=search><p>long text here</p><div class='share-2'>no</div></div><p>b</p>", "long text here\nb"),
    ("<div class=modal><main><p>long text</p></main></div><div class=promo><article>no</article></div>", "long text"),
    ("<p>long text <span class=share>no</span>here</p><div role=alert>no</div>", "long text here"),
    ("<div class=notice>Gone</div>", "Gone"), ("<div class=ad>" * 30000 + "deep", "deep"), ("<i class=ad>" * 30000 + "deep", "deep"),
])
def test_names_rule_small_blocks(page, text):
    assert one(page) == text


def test_named_block_among_other_pages():
    """One page of a host is a list of results, the others have a search box of the same name."""
    pages = [f"<p>Our site</p><div class=body><p>{f'text w{i} ' * 20}</p></div><div class=search><p>box {i}</p></div>" for i in range(8)]
    pages.append("<p>Our site</p><div class=body></div><div class=search><p>results</p></div>")
    wrapper = wrapper_of(pages)
    assert [wrappers.extract(p, wrapper) for p in pages] == [f"text w{i} " * 19 + f"text w{i}" for i in range(8)] + ["results"]


def test_copies_are_no_support():
    """Copies of one page, among others and alone, and a few changed copies on a large host lose nothing."""
    other = lambda i: f"<div class=top>Our site</div><div class=body><p>{f'text w{i} ' * 20}</p></div>"
    copy = lambda d: f"<div class=top>Our site</div><div class=body><div class=lead>In short</div><p>{'copy ' * 20}</p>{d}</div>"
    text = "In short\n" + "copy " * 19 + "copy"
    wrapper = wrapper_of([other(i) for i in range(20)] + [copy("")] * 40)
    assert wrappers.extract(copy(""), wrapper) == text
    assert wrappers.extract(other(3), wrapper) == "text w3 " * 19 + "text w3"
    assert wrappers.extract(copy(""), wrapper_of([copy("")] * 9)) == "Our site\n" + text
    changed = [copy(f"<p>{i}</p>") for i in range(6)]
    wrapper = wrapper_of([other(i) for i in range(300)] + changed * 3)
    assert wrappers.extract(changed[2], wrapper) == text + "\n2"


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "not a url", "<p>a</p>"), (2, "not a url", "<p>a</p>"), (None, "http://h/x", ""),
            (3, "http://h/y", "<div>" * 30000 + "deep" + "</div>" * 30000), (4, "http://h/z", "<p>w</p>" * 20000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit(1), "text": F.lit("k")})
    out = sorted(((r.page_id or 0, r.text) for r in wrappers.main_texts(pages).collect()))
    assert out == [(0, ""), (1, ""), (2, "a"), (2, "a"), (3, "deep"), (4, "\n".join("w" * 20000))]
    assert wrappers.main_texts(pages.limit(0)).count() == 0


def test_query(spark, given):
    """Against the article elements, cut out by hand."""
    import html
    import re

    pages = {r.page_id: r.html for r in given.pages.collect()}
    out = QUERIES["op4_main_text"](spark, given.folder).collect()
    assert len(out) == len(pages)
    for r in out:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = (re.sub(r"<(?!/?(p|h1)\b)[^>]*>", " ", b) for b in re.split(r"</?(?:p|h1)>", article))
        assert r.text == "\n".join(t for t in (" ".join(html.unescape(b).split()) for b in blocks) if t)
        assert r.n_chars == len(r.text)


@pytest.mark.parametrize(("name", "ruled"), [
    ("comment-list", True), ("user-comments", True), ("cookie-banner", True), ("site_footer", True), ("relatedPosts", True), ("share-2", True),
    ("no-comments", False), ("has-sidebar", False), ("withBanner", False), ("article-header", False), ("post-comments", True), ("content", False),
    ("adventure", False), ("", False), ("42", False),
])
def test_names(name, ruled):
    assert wrappers.rules_out(name) is ruled


def test_comments_and_adverts_beside_an_article():
    make = lambda i: (
        f"<div class=top>Our site</div><h1>Head {i}</h1><article><p>{f'text w{i} ' * 20}</p></article><div id='comment-list'><p>reader {i} says hi</p></div>"
        f"<div class='related-posts'>Read also {i}</div><div class=x><p>unnamed {i}</p></div>")  # fmt: skip
    pages = [make(i) for i in range(20)]
    wrapper = wrapper_of(pages)
    for i in (0, 7):
        assert wrappers.extract(pages[i], wrapper) == f"Head {i}\n" + f"text w{i} " * 19 + f"text w{i}"


@pytest.mark.parametrize(("page", "text"), [
    ("<body><form id=aspnetForm><article>long text here</article></form></body>", "long text here"),
    ("<form id=f><div class=menu>Home</div><div><p>long text here</p><p>and more</p></div><input name=q></form>", "long text here\nand more"),
    ("<p>long text here</p><form>Your mail: <input></form>", "long text here"),
])
def test_page_wide_forms(page, text):
    assert one(page) == text


@pytest.mark.parametrize("count", range(1, 11))
def test_hosts_of_few_pages(count):
    """From two different pages on, what is the same on all of them is frame."""
    make = lambda i: f"<div class=top>Our site menu</div><div class=body><p>{f'text w{i} ' * 20}</p></div><div class=end>Imprint</div>"
    wrapper = wrapper_of([make(i) for i in range(count)])
    text = "text w0 " * 19 + "text w0"
    assert wrappers.extract(make(0), wrapper) == (text if count > 1 else f"Our site menu\n{text}\nImprint")


def test_made_up_ids_do_not_grow_the_template():
    import random
    import time

    rng = random.Random(4)
    make = lambda i: "".join(f"<div id=x{rng.randrange(10**6)}a{rng.randrange(10**6)}><p>block {i} {j}</p></div>" for j in range(10))
    begun, whole = time.monotonic(), None
    for i in range(3000):
        t = wrappers.Group("html", [wrappers.parse(make(i))]).template()
        whole = wrappers.merge(whole, t) if whole else t
    assert len(whole["kids"]) == 1 and time.monotonic() - begun < 10


def test_matching_against_all_pairings():
    """Simple tree matching against every order-keeping pairing of children."""
    import random
    from itertools import combinations

    rng = random.Random(9)

    def tree(depth):
        return {"key": rng.choice("ab"), "kids": [tree(depth - 1) for _ in range(rng.randrange(0, 4))] if depth else []}

    def best(a, b):
        if a["key"] != b["key"]:
            return 0
        most = 0
        for n in range(1, min(len(a["kids"]), len(b["kids"])) + 1):
            for x in combinations(a["kids"], n):
                for y in combinations(b["kids"], n):
                    most = max(most, sum(best(p, q) for p, q in zip(x, y)))
        return 1 + most

    for _ in range(150):
        a, b = tree(3), tree(3)
        assert wrappers.matching(a, b) == best(a, b)


def test_large_host_in_pieces(spark, monkeypatch):
    """One host with most pages is spread by its bytes; tasks, pieces and emptied memory change no text."""
    make = lambda i: f"<div class=top>Our menu</div><div class=body><p>{f'text w{i} ' * 9}</p></div><div class=end>Imprint</div>"
    rows = [(i, f"http://{'big' if i % 5 else f'h{i % 15}'}.org/{i}", make(i)) for i in range(150)] + [(900, "http://big.org/n", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    plain = sorted(map(tuple, wrappers.main_texts(pages).collect()))
    monkeypatch.setattr(wrappers, "PIECE_BYTES", 1000)
    monkeypatch.setattr(wrappers, "TASK_BYTES", 4000)
    monkeypatch.setattr(wrappers, "LARGE", 10)
    held = wrappers.templates(pages)
    total = sum(len(h or "") for _, _, h in rows)
    assert held.agg({"bytes": "sum"}).first()[0] == total
    large = wrappers.large_hosts(held, total).collect()
    assert max(r.pieces for r in large) == -(-sum(len(h or "") for _, u, h in rows if "big" in u) // 1000) and len(large) <= 10
    out = wrappers.main_texts(pages)
    assert out.rdd.getNumPartitions() == total // 4000 + 1
    assert sorted(map(tuple, out.collect())) == plain and len(plain) == 151
    assert plain[0][2] == ("text w0 " * 9).strip()
