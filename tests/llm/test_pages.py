import html
import re

from keelson.llm import html_extract, url_rules
from keelson.llm.common import read
from keelson.llm.queries import URL_RULES
from tests.conftest import SF_ORACLE

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header class="site"><a>Home</a></header>
<nav><ul><li>menu</ul></nav><div id="sidebar-left">side</div><div class="cookie-notice">We use cookies</div>
<main><article class="post"><header><h1>Head &amp; line</h1></header><p class=lead>One  two<br>three <em>fo</em>ur &lt;x&gt; &#x41;</p>
<aside>related</aside><p>d&eacute;j&agrave; <script>var a="<p>no</p>";</script> end<ul><li>i1<li>i2</ul><div class="share-buttons">tweet</div>
<form>name <input></form><div class="post-comments"><p>first!</p></div><p>last</p></article></main><!-- c --><footer>&copy; x</footer></body></html>"""


def test_page_without_template():
    assert html_extract.main_text(PAGE, frozenset()) == "Head & line One two three four <x> A déjà end i1 i2 last"


def test_odd_markup():
    cases = {"": "", "plain text only": "plain text only", "<p>a<p>b": "a b", "<article>1 < 2 and <b>bo</b>ld &amp &am": "1 < 2 and bold & &am",
             "<article>cut off <a href='x": "cut off", "<div class='content with-sidebar'>x<div class='ad'>y</div>z</div>": "x z",
             "<p hidden>also</p><p>yes</p>": "also yes", "<body>a&nbsp;b <!-- <p>no</p> --></body>": "a b",
             "<div>a<svg>x</svg>b<span class=ad>y</span>c</div>": "a bc"}
    for page, want in cases.items():
        assert html_extract.main_text(page, frozenset()) == want


def test_tokenizer_loses_no_article():
    long = "word " * 50_000
    cases = {
        "<head><script>if(a<b){c()}</script></head><body><article><p>all text</p>": "all text",
        "<article>a<script>for(i=0;i<n;i++){x='</p>'}</script>b</article>": "ab",
        "<article>a <SCRIPT type=x>'<script>' \"</scripts>\" <b</SCRIPT >b</article>": "a b",
        "<style>a<b{}</style><article>x</article>": "x", "<title>1<2</title><main>x</main>": "x",
        "<article><p title=it's>one</p><p>two</p> it's <b>three</b></article>": "one two it's three",
        "<article><p it's>one</p><p a='>' b=\">\" c = d>two</p></article>": "one two",
        "<article><a href=/x/>y</a> z <br/>w</article>": "y z w", "<article>1 <2 </ 3> <> < 4 <é</article>": "1 <2 <> < 4 <é",
        "<main><p>intro outside</p><article>in</article></main>": "in", "<article>a<article>b</article>c</article>": "a b c",
        "<main>a<p>b</p></main>": "a b", "<article><code>x <span class=comment># y</span></code></article>": "x # y",
        "<article><ul class=side-effects><li>rash</ul><table class=alert><td>t</table><table class=related><td>u</table></article>": "rash t u",
        "<article>a<ul class='share-links'><li>tweet</ul><div id=post-comments>first!</div>b</article>": "a b",
        f"<article>{long}<script>{'<' * 9999}</script>end</article>": long + "end", "<article>x</article><script>never closed <p>y": "x",
        "<article>a<!-- <article> -- > -->b<![CDATA[c<d]]></article>": "abc<d", "<article>&lt;p&gt; &amp;amp; &#8364;&#x20AC;</article>": "<p> &amp; €€",
    }
    for page, want in cases.items():
        assert html_extract.main_text(page, frozenset()) == want, page[:80]


def test_articles_of_all_pages(spark):
    rows = html_extract.extract(read(spark, SF_ORACLE, "pages")).collect()
    pages = {r.page_id: r for r in read(spark, SF_ORACLE, "pages").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        article = pages[r.page_id].html.split("<article>", 1)[1].split("</article>")[0]
        article = re.sub(r"</?(p|h1|br)[^>]*>", " ", article)
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]*>", "", article)).split())
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_template_words_go_and_copies_stay(spark):
    def page(i, words):
        return f"<html><body><div class=top>Daily News of Town</div><div><p>{words}</p></div><p>Read our terms</p></body></html>"
    rows = [(i, f"http://h/{i}", page(i, f"story {i} about thing{i} and more{i * 7}")) for i in range(12)]
    rows += [(100 + i, f"http://h/c{i}", page(0, "the same long story again")) for i in range(20)]
    rows += [(200, "http://one/1", page(0, "a page alone")), (201, None, "<p>no url</p>"), (202, "x", None)]
    out = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    # "story" is on every page of the host, but its block holds other words too.
    assert out[3] == "story 3 about thing3 and more21"
    assert out[105] == "the same long story again"
    assert out[200] == "Daily News of Town a page alone Read our terms"
    assert out[201] == "no url" and out[202] == ""


def shop(i, parts, items):
    """A page without a main element: menu and notes alike on all pages, items of any number, boxes with values."""
    body = "".join(f"<p>{p}</p>" for p in parts)
    rows = "".join(f"<li><b>Item</b><i>{x}</i></li>" for x in items)
    return (f"<html><head><title>t{i}</title></head><body><div class=top><a>Start</a> | <a>Contact</a></div><div><h1>Title {i}</h1>{body}</div>"
            f"<div><ul>{rows}</ul></div><div><p>All rights</p><p>Made in town</p></div></body></html>")


def shops(n=9):
    return [shop(i, [f"first part {i}", "a part of two pages"][: 1 + (i < 2)], [f"x{i}_{k}" for k in range(1 + i % 4)]) for i in range(n)]


def brute_classes(pages):
    """Explicit occurrence vectors of the distinct pages, and places by plain scans."""
    pages = sorted(set(pages))
    counts = [html_extract.page_tokens(p) for p in pages]
    vectors = {t: tuple(c.get(t, [0])[0] for c in counts) for c in counts for t in c}
    kinds = {t: c[t][1] for c in counts for t in c}
    groups = {}
    for t, v in vectors.items():
        if sum(x > 0 for x in v) >= max(2, len(pages) / 2):
            groups.setdefault(v, set()).add(t)
    groups = {v: g for v, g in groups.items() if any(kinds[t] for t in g)}
    own = {t: v for v, g in groups.items() for t in g}
    places = {t: set() for t in own}
    for page in pages:
        line = []
        for kind, value, element in html_extract.tokens(page):
            if kind in "<|" and element.name == value:
                line.append((element.token, element, True))
            elif kind == "t" and value.strip() and element.name not in html_extract.RAW:
                line.append((html_extract._text_token(element, value), element, False))
        for at, (t, element, is_tag) in enumerate(line):
            if t not in own:
                continue
            # The instance reaches back to the last tag of the class that starts a new round.
            start, seen = None, set()
            for k in range(at + 1):
                u, _, tag = line[k]
                if own.get(u) == own[t] and (tag or start is not None):
                    if tag and (start is None or u in seen):
                        start, seen = k, set()
                    if k < at:
                        seen.add(u)
            if start is None or not is_tag and t in seen:
                places[t] |= {"none", "never"}
                continue
            before = [line[k][0] for k in range(start, at) if line[k][2] and own.get(line[k][0]) == own[t]]
            around, up = None, line[start][1].parent
            while up is not None and around is None:
                if up.token in own and own[up.token] != own[t]:
                    around = [u for u, _, tag in line[:start] if tag and own.get(u) == own[up.token]][-1]
                up = up.parent
            places[t].add((before[-1] if before else 0, around or 0))
    fits = {t for t, p in places.items() if len(p) == 1}
    return groups, {t for t in own if kinds[t] or t in fits}, fits


def test_classes_against_brute_force(spark):
    odd = ["<body><p>x<i>1</i><p>y<i>2</i>", "<body><p>x<i>1</i><p>x<b>2</b><i>3</i>", "<body><p>y<i>1</i><hr><p>x<i>2</i>"]
    swapped = [f"<div><a>u{i}</a><b>same</b></div>" if i % 2 else f"<div><b>same</b><a>u{i}</a></div>" for i in range(6)]
    hosts = {"shop": shops(), "two": shops(2), "odd": odd, "swapped": swapped, "one": shops(1), "copies": shops(2)[:1] * 9 + shops(3),
             "given": [r.html for r in read(spark, SF_ORACLE, "pages").limit(12).collect()]}
    rows = [(h, p) for h, pages in hosts.items() for p in pages]
    pages = spark.createDataFrame(rows, "host string, html string").selectExpr("host", "xxhash64(html) AS page", "html")
    groups, template = {}, {}
    for r in html_extract.classes_of(pages).collect():
        groups.setdefault(r.host, {}).setdefault(r.cls, set()).add(r.token)
    for r in html_extract.templates(pages).collect():
        template.setdefault(r.host, {})[r.token] = r.place
    for host, every in hosts.items():
        want, kept, fits = brute_classes(every)
        assert {frozenset(g) for g in want.values()} == {frozenset(g) for g in groups.get(host, {}).values()}, host
        assert set(template.get(host, {})) == kept, host
        assert {t for t, place in template.get(host, {}).items() if place is not None} == fits, host
    assert "one" not in template and any(place is None for place in template["swapped"].values())


def test_slots_without_main_element(spark):
    rows = [(i, f"http://s/{i}", p) for i, p in enumerate(shops())] + [(50, "http://alone/", shop(1, ["only"], ["z"]))]
    # A host of two pages that carry one text: all of it is template, so the labels alone decide.
    rows += [(60 + i, f"http://twins/{i}", f"<title>{i}</title><body><div>one text</div><nav>n{i}</nav>") for i in range(2)]
    # Parts alike on all pages stay inside a main element.
    rows += [(70 + i, f"http://m/{i}", f"<div>top</div><main><p>shared part</p><p>own {i}</p></main>") for i in range(4)]
    out = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()}
    for i in range(9):
        parts = [f"first part {i}"] + ["a part of two pages"] * (i < 2)
        assert out[i] == " ".join([f"Title {i}", *parts, *[f"Itemx{i}_{k}" for k in range(1 + i % 4)]])
    assert out[50] == "Start | Contact Title 1 only Itemz All rights Made in town"
    assert out[60] == out[61] == "one text"
    assert out[72] == "shared part own 2"


def test_slots_of_a_page(spark):
    pages = spark.createDataFrame([("s", p) for p in shops()], "host string, html string").selectExpr("host", "xxhash64(html) AS page", "html")
    template = {r.token: (r.cls, r.place) for r in html_extract.templates(pages).collect()}
    blocks = html_extract.page_blocks(shops()[3], template)
    fixed = [b.text for b in blocks if b.fixed]
    assert fixed == ["Start | Contact", "All rights", "Made in town"]
    items = [b for b in blocks if b.text.startswith("Item")]
    assert len(items) == 4 and len({b.slot for b in items}) == 1 and items[0].slot != blocks[1].slot


def test_deep_and_long_pages(spark):
    deep = "<div>" * 3000 + "core" + "</div>" * 3000
    rows = [(i, "http://d/x", f"{deep}<p>{i} " + "word " * 40_000 + "</p><p>end</p>") for i in range(3)]
    out = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(out[i] == f"{i} " + " ".join(["word"] * 40_000) for i in range(3))


def test_empty_pages(spark):
    empty = read(spark, SF_ORACLE, "pages").limit(0)
    assert html_extract.extract(empty).collect() == []
    assert url_rules.judge_urls(empty, spark.createDataFrame(URL_RULES, "host string, path string, verdict string")).collect() == []


def judge(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group(0)
    path = re.match(r"[^?#]*", rest[len(host):]).group(0)
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_urls_against_brute_force(spark):
    rules = [*URL_RULES, ("a.b.com", "/x/y", "block"), ("É.com", "/", "block")]
    urls = [None, "", "com/", "http://", "http://com", "http://com/", "HTTP://WWW.Example.COM/en/1?x#y", "http://example.com/en",
            "http://notexample.com/en/", "ftp://u@net/es/?q", "http://x.net#/fr/", "http://x.net?/fr/", "http://x.net/fr/", "a://b://com/",
            "http://q.a.b.com/x/yz", "http://.com/", "http://a..com//", "http://É.com/", "http://com/" + "z" * 5000] * 2
    pages = spark.createDataFrame([(i, u, "u", "v") for i, u in enumerate(urls)], "page_id long, url string, verdict string, host string")
    rows = url_rules.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert len(rows) == len(urls)
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == judge(urls[r.page_id], rules)


def test_repeated_tags_are_read_once_and_alike(monkeypatch):
    calls = []
    judge = html_extract._attribute_words
    monkeypatch.setattr(html_extract, "_attribute_words", lambda *a: calls.append(a) or judge(*a))
    html_extract._said.clear()
    html_extract._short_tag.clear()
    page = "<body>" + "<div class='once-only-a' data-x=1>t</div><p id=once-only-b>u</p>" * 50 + "</body>"
    assert html_extract.page_tokens(page) == html_extract.page_tokens(page)
    assert len(calls) == 2
    # A tag kept is one whose first sign > ends it, whatever follows.
    tails = ["", "x", "'", '"', " b='c'>", "<p>"]
    for rest in ["a=1>", "a='>'>", 'a=">', "a>b", "/>", " a = \"b\" c>", "a='b>", "=>", "a=b'c'>", ">"]:
        for tail in tails * 2:
            page = rest + tail
            found, at, closed = html_extract._attributes(page, 0)
            assert html_extract._tag(page, 0) == (found, at if closed else len(page))
