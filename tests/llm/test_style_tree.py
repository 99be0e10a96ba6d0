"""Main text of pages: blocks by elements and names, host trees against counts made anew, and whole pages against what they were made of."""

import math
import random
from collections import Counter, defaultdict

import pytest

from tablesmith.llm import style_tree
from tablesmith.llm.common import Stash
from tablesmith.llm.page_blocks import path_key, read


def text(html, nodes=None):
    return style_tree.main_text(html, nodes or {})[0]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("", ""),
        ("plain words", "plain words"),
        ("<p>one <b>two</b>\n\t three<p>four<br>five", "one two three\nfour five"),
        ("<p><b>left open<br><p>next</p></article>", "left open\nnext"),
        ("<p>a &amp; b&nbsp;c &#233; &lt;p&gt; &copy 1 &am</p>", "a & b c é <p> © 1 &am"),
        ("<script>var t='</p>';</script><p>x<!-- <p>no</p> --> y</p><style>p{}</style><SCRIPT>z</SCRIPT >", "x y"),
        ("<p>x<!-- never closed <p>y</p>", "x"),
        ("<p>a < b and 3 > 2</p>", "a < b and 3 > 2"),
        ('<p title="a > b">kept</p><p class="x>broken">y</p>', "kept\ny"),
        ("<nav><ul><li>Home</ul></nav><article><h1>T</h1><p>body</article><footer>f</footer>", "T\nbody"),
        ("<header><h1>Site</h1></header><main><header><h1>T</h1></header><p>body</p><aside>see also</aside><form>f<input></form></main>", "T\nbody"),
        ('<body class="has-sidebar"><div id="sidebar"><p>s</p></div><div class="post no-comments"><p>body</p><div class="comments"><p>c</p></div></div></body>', "body"),
        ('<div class="cookie-notice">We use</div><div role="navigation">n</div><div hidden>h</div><p style="display: none">d</p><p>body</p>', "body"),
        ('<article><p>body <span class="ad">buy</span> goes on</p></article><section class="comments"><article class="comment">c</article></section>', "body goes on"),
        ("<form><nav>n</nav><article><p>body</p></article><select><option>o</select></form>", "body"),
        ('<div class="wrap sidebar-right"><article><p>body</p></article><div class="sidebarBox">s</div><div id="cookiebar">c</div><ins class="adsbygoogle">a</ins></div>', "body"),
        ('<div class="header"><main><pre><span class="hljs-comment"># code</span> x</pre><a class="share" href="#">tell</a><p>body <a class="related" href="/">link</a></p></main></div>', "# code x\nbody link"),
        ("<table><tr><td>a<td>b<tr><th>c</table><dl><dt>d<dd>e</dl><pre>f\n  g</pre>", "a\nb\nc\nd\ne\nf g"),
        ("<ul><li>a<ul><li>b</ul>c<li>d</ul>", "a\nb\nc\nd"),
        ("<div>x</span></section></div>y<title>t</title><textarea><p>q</textarea>", "x\ny"),
        ("<article>" + "<div>" * 20000 + "deep" + "</div>" * 20000 + "<p>on</article>", "deep\non"),
    ],
)
def test_blocks(html, want):
    assert text(html) == want


def host_pages(rng, n, host, copies=0):
    """(url, html, article) of pages with an unmarked slogan, unmarked links and no article element."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    out = []
    for k in range(n):
        paragraphs = [" ".join(word() for _ in range(20)) for _ in range(rng.randrange(1, 5))]
        article = [" ".join(word() for _ in range(4)), *paragraphs]
        if copies and k < copies:
            article = ["one title", "the same words in every copy of this article"]
        body = f"<h2>{article[0]}</h2>" + "".join(f"<p>{p}</p>" for p in article[1:])
        html = f"<html><body><div class='x1'><a href='/a'>Home</a> <a href='/b'>About us</a></div><div class='x2'>{body}</div><div class='x3'><div>Call us any time</div><div>All about {host}</div></div></body></html>"
        out.append((f"HTTP://{host.upper()}:80/{k}", html, "\n".join(article)))
    return out


def brute_tree(htmls):
    """Importance of each branch, from whole counts; branches beside articles are left out."""
    seen, shapes, contents = set(), defaultdict(Counter), defaultdict(Counter)
    for html in htmls:
        said, mine, what = style_tree.counted(html)
        if said not in seen:
            seen.add(said)
            for key, shape in mine.items():
                shapes[key][shape] += 1
            for key, value in what:
                contents[key][value] += 1
    out = {}
    for key, c in shapes.items():
        m = sum(c.values())
        if m >= style_tree.LEAST_PAGES and m >= style_tree.SHARE * len(seen):
            counts = contents[key] or None
            if counts:
                out[key] = 1 - sum(v * math.log(v, m) for v in counts.values()) / sum(counts.values())
            else:
                out[key] = -sum(v / m * math.log(v / m, m) for v in c.values())
    return out


def test_trees_equal_whole_counts(spark):
    rng = random.Random(1)
    pages = host_pages(rng, 40, "one.example.com", copies=25) + host_pages(rng, 30, "two.example.com") + host_pages(rng, 5, "few.example.com")
    frame = spark.createDataFrame([(u, h) for u, h, _ in pages] + [(None, pages[0][1]), (pages[0][0], None), ("not a url", "<p>x")], "url string, html string").repartition(7)
    got = {r["host"]: r["nodes"] for r in style_tree.trees(frame, Stash(spark, "test")).collect()}
    assert set(got) == {"one.example.com", "two.example.com"}
    for host, nodes in got.items():
        want = brute_tree([h for u, h, _ in pages if host in u.lower()] + [""] * (host == "one.example.com"))
        assert set(nodes) == set(want) and all(abs(nodes[k] - want[k]) < 1e-5 for k in want)
        slogan = path_key(path_key(path_key(path_key(path_key(0, "html"), "body"), "div.x"), "div"), "#text")
        assert nodes[slogan] < 0.01


def test_unmarked_noise_goes_and_articles_stay(spark):
    rng = random.Random(2)
    pages = host_pages(rng, 60, "one.example.com", copies=45) + host_pages(rng, 50, "two.example.com") + host_pages(rng, 4, "few.example.com")
    rows = [(k, u, h, "kept") for k, (u, h, _) in enumerate(pages)] + [(900, None, "<p>no url", None), (901, "http://one.example.com/", None, None), (902, "http://one.example.com/", "", None), (0, pages[0][0], pages[0][1], "kept")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string").withColumnRenamed("text", "row")
    made = style_tree.extract(frame)
    assert made.columns == ["page_id", "url", "row", "text", "n_chars", "n_blocks", "n_beside", "n_noise"]
    got = made.collect()
    assert len(got) == len(rows) and sum(r["page_id"] == 0 for r in got) == 2
    by_id = {r["page_id"]: r for r in got}
    for k, (u, _, article) in enumerate(pages):
        r = by_id[k]
        assert r["n_chars"] == len(r["text"]) and r["url"] == u
        if "FEW" in u:
            assert r["text"] == f"Home About us\n{article}\nCall us any time\nAll about few.example.com"
        else:
            assert r["text"] == article and r["n_noise"] >= 2
    assert [by_id[k]["text"] for k in (900, 901, 902)] == ["no url", "", ""]
    assert style_tree.extract(frame.limit(0)).count() == 0


def test_composite_importance():
    page = read("<div><p>a</p><p>b</p></div>")
    div, p = path_key(0, "div"), path_key(path_key(0, "div"), "p")
    leaf = path_key(p, "#text")
    got = style_tree.branch_importance(page, {0: 0.0, div: 0.0, p: 0.0, leaf: 0.5})
    below = 0.9 * 0.5
    assert got == pytest.approx([0.9 * 0.81 * below, 0.81 * below, below, below])
