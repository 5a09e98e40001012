from __future__ import annotations

import hashlib
from collections import defaultdict

from ionloom.llm import html_extract, warc


def test_archives_round_trip(spark):
    big = "<p>" + "é" * 200_000
    rows = [(1, "http://a/1", "x" * 150), (2, "http://a/2\r\nX: y", "x" * 150), (3, None, None), (4, "http://a/4", ""), (5, "u", "small"), (6, "u", "small"), (7, "http://b", big), (8, "http://c", big), (None, "http://d", "x" * 150), (0, "http://z", "x" * 150), (0, "http://z2", "x" * 150)]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "page_id long, url string, html string, key string, length int").repartition(3)
    folder, index = warc.write_archives(df)
    records = warc.read_records(folder, index).collect()
    first = defaultdict(list)
    for i, _, h in rows:
        first[h or ""].append(i)
    assert len(records) == len(rows) and index.count() == len(rows)
    for r in records:
        texts = {h or "" for i, _, h in rows if i == r.page_id}
        text = next(t for t in texts if hashlib.sha256(t.encode()).hexdigest() == r.payload_digest)
        least = min(x for x in first[text] if x is not None)
        revisit = len(text.encode()) >= 100 and r.page_id != least
        assert (r.payload_bytes, r.record_type, r.refers_to) == (len(text.encode()), "revisit" if revisit else "response", least if revisit else None)
        assert r.payload is None if revisit else bytes(r.payload) == text.encode()
    some = warc.read_records(folder, index.where("page_id IN (1, 7)")).collect()
    assert sorted(r.page_id for r in some) == [1, 7]
    folder, index = warc.write_archives(df.limit(0))
    assert warc.read_records(folder, index).collect() == []


def test_ranges_join_into_few_reads(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}</p>" * 50) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    folder, index = warc.write_archives(df)
    offsets = sorted((r.offset, r.length) for r in index.collect())
    assert all(a + n == b for (a, n), (b, _) in zip(offsets, offsets[1:], strict=False))
    monkeypatch.setattr(warc, "READ_BYTES", 500)
    assert warc.read_records(folder, index).count() == 40


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header class="site">Site</header><nav><ul><li>Menu</ul></nav><div class="ad box">Buy</div><!-- <p>hidden --><article><header><h1>Head&nbsp;&amp; line</h1></header>
<p><b>First   part<br>of it<p>Second &lt;b&gt; <i>in</i>line</p><div class="share-bar">Share</div><ul><li>one<li>two</ul><form>Send</form><aside>Rel</aside>
<section id="comments"><p>Nice!</p></section><table><tr><td>a<td>b</table></article><footer>&copy;</footer>"""


def test_article_text():
    assert [t for t, _ in html_extract.blocks(PAGE)[0]] == ["Head & line", "First part of it", "Second <b> inline", "one", "two", "a", "b"]


def test_names_drop_by_whole_words_only():
    get = lambda p: [t for t, _ in html_extract.blocks(p)[0]]
    for name in ("site has-sidebar", "no-sidebar", "sidebar", "page with-comments", "sidebar-wrapper"):
        assert get(f'<div class="{name}"><article><p>Text of it</p></article><aside>no</aside></div><p>out</p>') == ["Text of it"], name
    assert get('<div id="sidebar"><main><p>In</p></main></div><p>Text outside that is longer</p>') == ["In"]
    assert get('<div class="related"><article>Card</article></div><div><p>The text of the page</p></div>') == ["The text of the page"]
    body = '<h2 id="market-share">Market</h2><section id="related-work"><p>Work</p></section><h2 id="social-impact">Impact</h2><h2 id="comments">On comments</h2>'
    assert get(f"<article>{body}</article>") == ["Market", "Work", "Impact", "On comments"]
    gone = '<div class="share-bar">a</div><div class="x cookie_banner">b</div><div id="comments">c</div><div class="site-footer">d</div><ul class="social-links"><li>e</ul>'
    assert get(f"<article>{gone}<p>Kept</article>") == ["Kept"] and get(f"{gone}<div class=site-header>f</div><p>Kept") == ["Kept"]
    assert get('<nav class="sidebar"><main>no</main></nav><p>yes</p>') == ["yes"]


def test_odd_markup():
    get = lambda p: [t for t, _ in html_extract.blocks(p)[0]]
    assert get("") == [] and get("plain &amp; text") == ["plain & text"] and get("a < b <p>c</p> </div>d") == ["a < b", "c", "d"]
    assert get("<p>open <b>x<p>y<script>z") == ["open x", "y"] and get("<p title='a>b'>t</p><p title=\"unclosed>u") == ["t", "u"]
    assert get('<p class="x>Hello</p>') == ["Hello"] and get("<p>a <a href") == ["a <a href"]
    assert get('<p class="notice-period">A</p><p class="share-price">B</p>') == ["A", "B"]
    assert get("<main><p>in</p></main><p>out</p>") == ["in"] and get("<div role=main>in</div><div>out</div>") == ["in"]
    assert len(get("<div>" * 900 + "deep" + "<p>x" * 20_000)) == 20_001


def test_site_templates_go_and_copies_stay(spark):
    page = lambda i: f"<html><body><div><span>Home of things</span></div><div><p>Own text {i}</p><p>More {i}</p></div><div>Contact us here</div></body></html>"
    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(12)]
    rows += [(100 + i, "http://h.example/copy", page(3)) for i in range(4)] + [(200, "http://other.example/", page(200)), (201, None, None), (202, "http://h.example/e", ""), (203, "http://h.example/t", "<div>Contact us here</div>")]
    rows += [(300 + i, f"http://same.example/{i}", "<div><p>The one page</p></div>") for i in range(9)]
    rows += [(400, "http://h.example/a", PAGE)] + [(401 + i, f"http://four.example/{i}", f"<p>Cookies on this site</p><p>Real text{' ' + str(i) if i else ''}</p>") for i in range(4)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract(df).collect()}
    assert len(got) == len(rows)
    assert all(got[i][0] == f"Own text {i}\nMore {i}" for i in range(12)) and got[101][0] == "Own text 3\nMore 3"
    assert got[200][0] == "Home of things\nOwn text 200\nMore 200\nContact us here"  # one page makes no template
    assert got[201] == ("", 0) and got[202] == ("", 0) and got[203] == ("", 0) and got[300][0] == "The one page"
    assert got[401][0] == "Cookies on this site\nReal text"  # four pages are too few
    assert got[400][0].startswith("Head & line") and got[400][1] == len(got[400][0])
    assert html_extract.extract(df.limit(0)).collect() == []


def test_templates_in_marked_articles(spark):
    box = "<div><b>Read this too</b><ul><li>Our offer</ul></div>"
    menu = lambda i: f"<div>Home</div><div>Link {i}</div>"
    own = lambda i: f"{menu(i)}<article><h2>Conclusion</h2><p>Text number {i} of it</p>{box}<p>The rest of {i}</p></article>"
    quote = "<div><p>A long quotation that this article has</p></div>"
    copy = lambda i: f"<div>Advert {i}</div><main><h1>Copied</h1><p>The longest paragraph of the copied article comes first</p>{quote}<p>Last{' edited' * (i % 4 == 0)}</p></main>"
    rows = [(i, f"http://a.example/{i}", own(i)) for i in range(20)] + [(100 + i, f"http://b.example/{i}", copy(i)) for i in range(20)]
    rows += [(200, "http://a.example/menu", "<div>Home</div>"), (201, "http://a.example/bare", f"<div>Home</div>{box}<p>Bare text</p>")]
    rows += [(300 + i, f"http://c.example/{i}", f"<div>Notice that is longer than any text</div><p>{i} is this page's</p>") for i in range(9)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Conclusion\nText number {i} of it\nThe rest of {i}" for i in range(20))
    assert all(got[100 + i] == f"Copied\nThe longest paragraph of the copied article comes first\nA long quotation that this article has\nLast{' edited' * (i % 4 == 0)}" for i in range(20))
    assert got[200] == "" and got[201] == "Bare text" and all(got[300 + i] == f"{i} is this page's" for i in range(9))


def test_hostile_pages_take_linear_time():
    import time

    n = 60_000
    pages = ["<a " * 4 * n, "<a '>'" * n, "<a \">" * n + "\"", "<div>" * n + "x", "<b>" * n + "<p>" * n, "<b>" * n + "</i>" * n, "<h2>" * n, "<!" * n, "<script></script " * n, "<td><b>" * n, "<p class='" * n + ">", '<div class="related">' * 2000 + "<article>a" * 2000, "<div>x" * n]
    for page in pages:
        began = time.process_time()
        found = html_extract.blocks(page)[0]
        assert time.process_time() - began < 8, (page[:20], time.process_time() - began)
    assert len(found) == n


def brute_texts(rows, least=5):
    """Templates by counting one page after the other."""
    from collections import Counter

    host = lambda url: (url or "").partition("://")[2].partition("/")[0].lower()
    pages = {}
    for _, url, page in rows:
        found, _, elements = html_extract.blocks(page or "")
        longest = sorted({t for t, _ in found}, key=lambda t: (-len(t), t))[:4] or [""]
        pages[host(url), page or ""] = {html_extract.digest(e) for e in elements if e.judged}, [longest[k % len(longest)] for k in range(4)]
    gone = defaultdict(set)
    for h in {h for h, _ in pages}:
        own = [v for (x, _), v in pages.items() if x == h]
        for subtree in set().union(*(s for s, _ in own)):
            texts = [t for s, t in own if subtree in s]
            if len(texts) >= least and sum(2 * max(Counter(t[k] for t in texts).values()) <= len(texts) for k in range(4)) >= 2:
                gone[h].add(subtree)
    return sorted((i, "\n".join(t for t, _ in html_extract.blocks(page or "", frozenset(gone[host(url)]))[0])) for i, url, page in rows)


def test_template_removal_against_brute_force(spark):
    import random

    rng = random.Random(12)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 6)
    text = lambda n: " ".join(word() for _ in range(n))
    rows = []
    for h in range(6):
        parts = [f"<div><p>{text(rng.randint(1, 9))}</p></div>" for _ in range(5)]
        articles = [f"<h1>{text(2)}</h1><p>{text(20)}</p><p>{text(8)}</p>" for _ in range(6)]
        for _ in range(rng.choice([3, 12, 30])):
            body = rng.choice(articles).replace("</p><p>", rng.choice(["</p><p>", f" {word()}</p><p>"]))
            box = "".join(p for p in parts[2:4] if rng.random() < 0.8)
            inside = f"<article>{body}{box}</article>" if h % 2 else f"<section>{body}</section>{box}"
            rows.append((len(rows), f"https://h{h}.example/{len(rows)}", "".join(p for p in parts[:2] if rng.random() < 0.9) + inside + f"<div>{text(3)}</div>" + parts[4]))
    rows += [(1000, None, None), (1001, "https://h0.example/x", ""), (1002, "https://h1.example/copy", rows[-1][2])]
    got = sorted((r.page_id, r.text) for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect())
    assert got == brute_texts(rows)
    kept = sum(len(t) for _, t in got)
    assert kept < sum(len("\n".join(t for t, _ in html_extract.blocks(p or "")[0])) for _, _, p in rows)


def read_by_parts(page):
    found, _, _ = html_extract.blocks(page)
    return "\n".join(t for t, _ in found)


def test_depth_and_hostile_quotes():
    for depth in (3, 100, 300, 5000):
        page = "<table><tr><td hidden>x" + "<b>" * depth + "<td>visible</table>"
        assert read_by_parts(page) == "visible"
    hidden = "<p>one <a title=\"it's > here\">two</a> three</p>"
    assert read_by_parts(hidden) == "one two three"
    for n in (10, 5000):  # quotes that hide every end, however many: the same reading at any length
        assert read_by_parts("<p>a</p>" + "<i \"'>b" * n).count("b") == -(-n // 3)
    assert read_by_parts("<p>" + "<a '" * 20_000 + ">end").endswith("end")


def test_names_by_parts():
    gone = "comments-area comments-section comment-respond cookie-notice cookie-consent gdpr-popup widget-area left-sidebar sidebar-primary related-articles breadcrumbs-nav post-navigation adsbygoogle google-ads site-info share_bar".split()
    for name in gone:
        assert read_by_parts(f"<article><p>text</p><div class='x {name}'>other</div></article>") == "text", name
        assert read_by_parts(f"<p>text</p><div class='{name}'>other</div>") == "text", name
    for name in "has-sidebar no-sidebar notice-period market-share related-work social-impact content-sidebar elementor-widget-container post-content".split():
        assert read_by_parts(f"<div class='{name}'><article><p>text</p></article></div>") == "text", name
        assert read_by_parts(f"<article><div class='{name}'>text</div></article>") == "text", name
