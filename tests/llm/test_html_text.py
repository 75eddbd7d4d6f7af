"""Main text: hand-made pages, the alignment against plain dynamic programming, pairing by address."""

from __future__ import annotations

import random

from lakegate.llm import html_text
from lakegate.llm.html_text import ARTICLE, NAMED_BOILERPLATE, OPEN, lines, shared


def lcs_length(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment_is_longest(monkeypatch):
    rng = random.Random(2)
    for held in (1 << 27, 4):
        monkeypatch.setattr(html_text, "_BITS_HELD", held)
        for _ in range(800):
            a = [rng.randrange(5) for _ in range(rng.randrange(14))]
            b = [rng.randrange(5) for _ in range(rng.randrange(14))]
            found = shared(a, b)
            assert len(found) == lcs_length(a, b) and found == sorted(set(found))
            rest = iter(b)
            assert all(a[i] in rest for i in found)


def test_blocks_of_markup():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
    <body><nav><ul><li><a href="/x>y">Menu</a></ul></nav><!-- <p>no</p> --><div class="top ad">Buy</div>
    <article><h1>A &amp; B</h1><p>one&nbsp; two<b>three</b>
    four<br><p>five &lt;x&gt; &#233;</p><aside>side</aside><form><p>mail</p></form>
    <div id="comments"><p>first!</p></div></article><footer>&copy; me</footer><p>tail"""
    texts, kinds = lines(page)
    assert [t for t, k in zip(texts, kinds) if k == ARTICLE] == ["A & B", "one twothree four", "five <x> é"]
    assert [t for t, k in zip(texts, kinds) if k == OPEN] == ["tail"]
    assert {"Menu", "Buy", "side", "mail", "first!", "© me"} == {
        t for t, k in zip(texts, kinds) if k == NAMED_BOILERPLATE
    }
    assert lines(None) == lines("") == lines("<p><div") == ([], [])
    assert lines("a < b &am")[0] == ["a < b &am"]
    assert lines("<nav>never closed<article>text")[0] == ["never closed", "text"]
    beside = '<body class="header-fixed"><div class="with-sidebar"><p>text</p></div><div class="sidebar-left">x</div>'
    assert lines(beside) == (["text", "x"], [OPEN, NAMED_BOILERPLATE])
    assert lines("<p>1</p>" * 20_000)[0] == ["1"] * 20_000


def page(*texts, article=False):
    body = "".join(f"<p>{t}</p>" for t in texts)
    return f"<html><body>{'<article>' + body + '</article>' if article else body}</body></html>"


def test_shared_lines_go_where_no_article_is_named(spark, tmp_path):
    rows = [
        (1, "http://h.example/a/1", page("menu", "first text", "imprint")),
        (2, "http://h.example/a/2", page("menu", "second text", "imprint")),
        (3, "http://h.example/a/3", page("menu", "third text", "more", "imprint")),
        (4, "http://other.example/a/1", page("menu", "alone", "imprint")),
        (5, "http://h.example/b/1", page("copied", "twice", article=True)),
        (6, "http://h.example/b/2", page("copied", "twice", article=True)),
        (7, None, None),
        (8, "", ""),
        (9, "http://h.example/a/2", page("menu", "second text", "imprint")),
        (9, "http://h.example/a/2", page("menu", "second text", "imprint")),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    frame.write.parquet(str(tmp_path / "pages.parquet"))
    found = html_text.op2_html_text(spark, str(tmp_path)).collect()
    assert len(found) == len(rows)
    text = {r.page_id: r.text for r in found}
    assert text[1] == "first text" and text[3] == "third text\nmore"
    assert text[4] == "menu\nalone\nimprint"
    assert text[5] == text[6] == "copied\ntwice"
    assert text[7] == text[8] == ""
    assert all(r.n_chars == len(r.text) for r in found)
    assert {r.page_id: r.shared_lines for r in found}[5] == 2


def test_pairing_crosses_ranges_and_keeps_extra_columns(spark):
    rows = [(i, f"https://one.example/p/{i:04d}", page("menu", f"text {i}", "end"), "x", 1) for i in range(300)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string, lines int")
    found = html_text.extract(frame.repartition(5)).collect()
    assert {r.page_id: r.text for r in found} == {i: f"text {i}" for i in range(300)}
    assert {r.lines for r in found} == {1}
    assert html_text.extract(frame.limit(0)).collect() == []


def test_copies_keep_their_text(spark):
    rows = [
        (1, "http://h.example/a/1", page("menu", "first text", "imprint")),
        (2, "http://h.example/a/2", page("menu", "second text", "imprint")),
        (9, "http://h.example/a/2", page("menu", "second text", "imprint")),
        (9, "http://h.example/a/2", page("menu", "second text", "imprint")),
        (10, "http://h.example/other/address", page("menu", "second text", "imprint")),
        (11, "http://h.example/a/1/empty", "<html></html>"),
        (12, "http://copies.example/1", page("menu", "only text")),
        (13, "http://copies.example/2", page("menu", "only text")),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = html_text.extract(frame).collect()
    assert len(found) == len(rows)
    text = {(r.page_id, r.text) for r in found}
    second = {(i, "second text") for i in (2, 9, 10)}
    assert text == {(1, "first text"), *second, (11, ""), (12, "menu\nonly text"), (13, "menu\nonly text")}
    assert {r.page_id: r.shared_lines for r in found} == {1: 2, 2: 3, 9: 3, 10: 3, 11: 0, 12: 2, 13: 2}


def of_kind(kind, page):
    return [t for t, k in zip(*lines(page)) if k == kind]


def test_articles_inside_boilerplate_and_slugs():
    teaser = "<div><p>body</p></div><aside><article class='card'>teaser</article></aside>"
    assert lines(teaser) == (["body", "teaser"], [OPEN, NAMED_BOILERPLATE])
    assert of_kind(ARTICLE, "<div><nav>never closed<article>text</article></div>") == ["text"]
    assert of_kind(ARTICLE, "<form><nav>menu</nav><main>text</main></form>") == ["text"]
    assert of_kind(ARTICLE, "<div class='search-page'><main>text</main></div>") == ["text"]
    assert of_kind(ARTICLE, "<div id='comments'><article class='comment-body'>first!</article></div>") == []
    slugs = """<article id='social-housing-report' class='post tag-search'><p>a</p><section id='search'><p>b</p>
    </section><div id='login-and-alert'>c</div><div id='comments'>d</div><div class='share-bar'>e</div></article>"""
    assert of_kind(ARTICLE, slugs) == ["a", "b", "c"]
    assert of_kind(NAMED_BOILERPLATE, slugs) == ["d", "e"]


def test_body_outside_a_short_article_stays(spark):
    def rows(number):
        card = f"<div><article class='card'>teaser {number}</article></div>"
        body = f"<p>the body of page {number} runs on for much longer than its teaser</p>"
        return (number, f"http://h.example/{number}", f"<p>the menu of the host</p>{body}{card}")

    long = "<p>note</p><article>" + "a long article " * 9 + "</article>"
    frame = [rows(1), rows(2), (3, "http://other.example/", long)]
    found = html_text.extract(spark.createDataFrame(frame, "page_id long, url string, html string")).collect()
    text = {r.page_id: r.text for r in found}
    for number in (1, 2):
        assert text[number] == f"the body of page {number} runs on for much longer than its teaser\nteaser {number}"
    assert text[3] == ("a long article " * 9).strip()


def test_elements_that_only_begin_like_raw_ones():
    assert of_kind(ARTICLE, '<article><p>a</p><svg class="i"/><p>b</p><p>c</p></article>') == ["a", "b", "c"]
    custom = "<article><p>a</p><video-player src=x></video-player><select-box>x</select-box><p>b</p></article>"
    assert of_kind(ARTICLE, custom) == ["a", "x", "b"]
    assert of_kind(ARTICLE, "<article><p>a <math><mi>x</mi><mo>=</mo></math> b</p></article>") == ["a x= b"]
    assert lines("<script-like>x</script-like><title>t</title><p>y</p>")[0] == ["x", "y"]


def test_hidden_elements_neither_show_nor_split_a_block():
    drawing = "<svg><title>t</title><svg><text>no</text></svg><path d='M0'/>no</svg>"
    assert lines(f"<p>one {drawing} two</p><p>three</p>")[0] == ["one two", "three"]
    others = "<object data=x>alt<p>alt</p></object><template><div><p>t</p></div></template><select><option>o</select>"
    assert lines(f"<article><p>a</p>{others}<p>b</p></article>") == (["a", "b"], [ARTICLE, ARTICLE])
    # What never ends hides nothing, nor does what ends with its parent.
    assert lines("<article><video><p>a</p></article><p>b") == (["a", "b"], [ARTICLE, OPEN])
    assert lines("<p>a<canvas>b")[0] == ["ab"]


def test_malformed_pages_take_linear_time():
    import time

    start = time.process_time()
    assert lines("<div>" * 50_000 + "text" + "</span>" * 50_000)[0] == ["text"]
    assert lines("<div>" * 50_000 + "<span>text" + "</span>" * 50_000 + "</p>" * 50_000)[0] == ["text"]
    assert time.process_time() - start < 10


def test_query_against_a_plain_version(spark):
    """All pages of a table: neighbours by sorting, shared lines by the recurrence, no Spark."""
    import re
    from collections import defaultdict

    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    hosts = defaultdict(dict)
    for r in rows:
        host, path = re.match(r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*))?(.*)$", r.url or "", re.S).groups()
        body = tuple(lines(r.html)[0])
        if body:
            known = hosts[(host or "").lower()]
            known[body] = min(path, known.get(body, path))

    def alike(a, b):
        same = 0
        for x, y in zip(a.split("/"), b.split("/")):
            if x != y:
                break
            same += 1
        return len("/".join(a.split("/")[:same]))

    template = {}
    for host, known in hosts.items():
        order = sorted(known, key=lambda body: known[body])
        for i, body in enumerate(order):
            near = [(alike(known[body], known[order[j]]), j < i, j) for j in (i - 1, i + 1) if 0 <= j < len(order)]
            partner = order[max(near)[2]] if near else ()
            template[host, body] = lcs_length(body, partner)
    found = {r.page_id: r for r in html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect()}
    checked = 0
    for r in rows:
        texts, kinds = lines(r.html)
        host = re.match(r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*))?", r.url or "")[1]
        copies = sum(tuple(lines(o.html)[0]) == tuple(texts) and host == re.match(
            r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*))?", o.url or "")[1] for o in rows)
        assert found[r.page_id].text == "\n".join(t for t, k in zip(texts, kinds) if k == ARTICLE)
        if texts and copies == 1:
            assert found[r.page_id].shared_lines == template[(host or "").lower(), tuple(texts)]
            checked += 1
    assert checked > 0.9 * len(rows) or checked > 20
