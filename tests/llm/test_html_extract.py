import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wardflow.llm import html_extract as X

NAV = "<nav><ul><li><a href='/'>Home</a></li></ul></nav><header><h1>Site</h1></header>"


def texts(page):
    return "\n".join(b.text for b in X.blocks_of(page) if b.place == X.ARTICLE)


@pytest.mark.parametrize(
    "page, want",
    [
        ("", ""),
        ("<article><h1>A &amp; B</h1><p>x <b>y</b>\n z<br>q</p></article>", "A & B\nx y z q"),
        (NAV + "<main><article><header><h2>T</h2></header><p>p</main><footer>f</footer>", "T\np"),
        ("<article><p>one<p>two<ul><li>a<li>b</ul>end</article>", "one\ntwo\na\nb\nend"),
        ("<article>a<script>var x='<p>no</p>'</script><style>p{}</style><!-- c > -->b<form>f</form></article>", "ab"),
        ("<article><p>t</p><section id='comments'><p>nice</p></section><div class='ad-box'>buy</div><aside>s</aside></article>", "t"),
        ("<article><p>1 &lt; 2 &#233; &am &copy</p><p title='a>b'>x</p><p title=it's>y</p>", "1 < 2 é &am ©\nx\ny"),
        ("<article><p hidden>h</p><div role=navigation>m</div><p style='display: none'>n</p><p>k</p></article>after", "k"),
        ("<article><p>cut <b>here</arti", "cut here"),
        ("<ARTICLE><P>up</P></ARTICLE>", "up"),
    ],
)
def test_article_text(page, want):
    assert texts(page) == want


@settings(max_examples=200, deadline=None)
@given(st.text("<>/!-p article='\"&; x", max_size=80))
def test_any_markup_is_read(page):
    for block in X.blocks_of(page):
        assert block.text == " ".join(block.text.split()) != ""


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.integers(1, 9))
def test_suffix_array_sorts_by_prefix(tokens, depth):
    order, rank = X.suffix_array(np.array(tokens), depth)
    prefix = [tuple(tokens[i : i + depth]) for i in range(len(tokens))]
    assert [prefix[i] for i in order] == sorted(prefix)
    assert all((rank[i] == rank[j]) == (prefix[i] == prefix[j]) for i in range(len(tokens)) for j in range(len(tokens)))


def test_no_page_takes_long_to_parse():
    n = 100_000
    for page in (
        "<div>" * n, "<div>x</p>" * n, "<div>" * n + "</div>" * n, "<div class=ad>x" * n, "<head>x" * n, "</div>" * n,
        "<article><b>x" * n, "<section><span>x</section>" * n, "<p " + "a" * n + ">x", "<p title=it's>y" * n, "<!-- x" * n, "&" * n,
    ):
        began = time.monotonic()
        X.main_text(page)
        assert time.monotonic() - began < 5


def test_closing_an_outer_element_ends_the_menu_within():
    assert X.main_text("<main>a<span><nav>menu</span>b</main>")[0] == "a\nb"


def stream(html):
    """The page's tokens outside the article."""
    return [w for b in X.blocks_of(html) if b.place != X.ARTICLE for w in b.text.split(" ")]


def main_of(html):
    return tuple(b.text for b in X.blocks_of(html) if b.place != X.BOILER)


def brute_force(rows, depth):
    """Main text by (host, html): every passage of a host compared with every other page's."""
    seen, shorts, pages = {}, {}, {}
    for host, _, html in rows:
        main = main_of(html)
        pages.setdefault(host, set()).add(main)
        words = stream(html)
        for i in range(len(words) - depth + 1):
            seen.setdefault((host, *words[i : i + depth]), set()).add(main)
        for b in X.blocks_of(html):
            if b.place == X.OTHER and len(b.text.split(" ")) < depth:
                shorts.setdefault((host, b.text), set()).add(main)
    out = {}
    for host, _, html in rows:
        covered, words = set(), stream(html)
        for i in range(len(words) - depth + 1):
            if len(seen[(host, *words[i : i + depth])]) > 1:
                covered.update(range(i, i + depth))
        kept, at = [], 0
        for b in X.blocks_of(html):
            words = b.text.split(" ")
            if b.place == X.ARTICLE:
                kept.append(b.text)
                continue
            n = len(shorts.get((host, b.text), ()))
            if b.place == X.OTHER and not (n >= X.BLOCK_PAGES and n >= X.BLOCK_SHARE * len(pages[host])):
                gone = set()
                for i in range(len(words) - depth + 1):
                    if all(at + i + k in covered for k in range(depth)):
                        gone.update(range(i, i + depth))
                left = " ".join(w for i, w in enumerate(words) if i not in gone)
                kept += [left] if left else []
            at += len(words)
        out[host, html] = ("\n".join(kept), len(covered))
    return out


def extracted(spark, rows, depth=X.REPEAT_TOKENS):
    pages = spark.createDataFrame([(i, f"http://{h}/x", t) for h, i, t in rows], "page_id long, url string, html string")
    return [(r.page_id, r.url.split("/")[2], r.text, r.n_repeated_tokens) for r in X.extract(pages, depth).collect()]


def site():
    rows = []
    for i in range(40):
        host = "big.example" if i % 3 else f"h{i % 5}.example"
        body = f"<div>terms of use apply to all {'pages here' if i % 2 else 'readers now'} {i}</div><div>unique run number {i} only</div>"
        body += f"<p>Contact</p><article>text {i} of the article</article>" if i % 4 == 1 else "<p>Seldom</p>" * (i < 3)
        rows.append((host, i, f"<html>{NAV}{body}<footer>about this site {i % 4} and more words</footer></html>"))
    # A copy under another id, rows without an id, a repeated row, and an id given to two pages.
    return [*rows, ("big.example", 50, rows[1][2]), ("big.example", None, rows[2][2]), ("big.example", None, rows[4][2]), rows[5], ("big.example", 7, rows[8][2])]


@pytest.mark.parametrize("chunk", [10, 25_000])
@pytest.mark.parametrize("depth", [4, 7, 20])
def test_text_equals_brute_force_whatever_the_chunks(spark, monkeypatch, chunk, depth):
    monkeypatch.setattr(X, "CHUNK_TOKENS", chunk)
    rows = site()
    want = brute_force(rows, depth)
    assert sorted(extracted(spark, rows, depth), key=str) == sorted(((i, h, *want[h, t]) for h, i, t in rows), key=str)


def test_shared_phrases_copies_and_headings_keep_their_words(spark):
    prose = [
        "The river rose again at the end of the winter and two bridges were closed.",
        "We met at the end of the winter to talk about bees.",
        "Prices fell at the end of the winter and stayed low.",
        "Snow lay until the end of the winter in the hills.",
    ]
    copy = "<p>" + " ".join(f"word{i}" for i in range(60)) + "</p>"
    rows = [("a.example", i, f"<p>{p}</p>") for i, p in enumerate(prose)] + [("a.example", i, copy) for i in (10, 11)]
    rows += [("a.example", 12, "<h1>Short title</h1><article><p>text</p></article>")]
    got = {i: text for i, _, text, _ in extracted(spark, rows)}
    assert [got[i] for i in range(4)] == prose
    assert got[10] == got[11] and got[10].count(" ") == 59 and got[12] == "Short title\ntext"


def test_boilerplate_of_a_large_host_goes(spark):
    notice = "This site is run by a society of friends of old maps and all of its pages may be read by anyone who likes to do so."
    words = ["map", "road", "hill", "town", "lake", "field", "stone"]
    rows = []
    for i in range(300):
        prose = " ".join(words[(i * 7 + k * k + i // 7 * k) % 7] + str(i * k % 11) for k in range(30)) + f" page{i}"
        rows.append(("maps.example", i, f"<div>Home</div><div>All maps</div><p>{prose}</p><div>{notice}</div><div>Visits: {i}</div>"))
    for i, _, text, repeated in extracted(spark, rows):
        assert text.split("\n")[0].endswith(f"page{i}") and text.split("\n")[1:] == [f"Visits: {i}"] and repeated >= 26


def test_nulls_empty_and_extra_columns(spark):
    rows = [(1, None, None, 5), (2, "", "", 5), (None, "http://a/", "<article>x</article>", 5), (3, "u", "plain é text", 5), (3, "u", "plain é text", 5)]
    out = X.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert sorted(((r.page_id or 0, r.text, r.n_chars) for r in out)) == [
        (0, "x", 1), (1, "", 0), (2, "", 0), (3, "plain é text", 12), (3, "plain é text", 12)
    ]
    assert X.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_long_page(spark):
    page = "<article>" + "<p>word word</p>" * 20_000 + "</article>"
    (row,) = X.extract(spark.createDataFrame([(1, "http://a/", page)], "page_id long, url string, html string")).collect()
    assert row.text == "\n".join(["word word"] * 20_000)


@pytest.mark.parametrize(
    "page",
    [
        "<body class='single no-sidebar'><article><p>t</p></article></body>",
        "<body class='sidebar'><article><p>t</p></article></body>",
        "<main class='has-sidebar'><p>t</p></main>",
        "<article class='post comment-open'><p>t</p></article>",
        "<article class='comment'><p>t</p></article>",
        "<div id='page' class='menu-closed'><p>t</p></div>",
        "<div id='page' class='widget'><article><p>t</p></article></div>",
        # Articles within comments stay comments, also within a marked element around the whole page.
        "<div class='widget'><main><p>t</p><div id='comments'><article><p>nice</p></article></div></main></div>",
        "<div class='related'><article>r</article></div><main><p>t</p><article class='comment'>c</article></main>",
        "<main><p>t</p></main><div class='cookie-notice'>c</div><div class='left-sidebar'>s</div><div id='footer'>f</div>",
    ],
)
def test_marks_of_the_page_and_of_states_are_no_boilerplate(page):
    assert X.main_text(page)[0] == "t"
