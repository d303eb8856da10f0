import html
import re

import numpy as np

from retail_analytics.llm import html_text

SF = "/root/testdata/sf0.001"
TREE = html_text.train(html_text.LABELLED)


def text(page):
    return html_text.main_text(page, TREE)


def test_tree_fits_its_table():
    rows = np.array(html_text.LABELLED, float)
    assert (html_text.classify(TREE, rows[:, :-1]) == rows[:, -1]).all()


def test_whole_article_and_nothing_else():
    page = ('<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>'
            '<div class="cookie-notice">We use cookies to follow you through many a page, as long as you agree to all of it here.</div>'
            '<header><h1>Site name</h1></header><nav><ul><li><a href="/a">A</a></li><li><a>B</a></li></ul></nav><!-- ad <p>x</p> -->'
            '<article><header><h1>Ti&amp;tle</h1></header><p>One\n two&nbsp;three.</p><p>4 &lt; 5</p><div class="ad">Buy now</div>'
            '<aside>Aside</aside><form>Name <input></form><p><b>Be.<br><p>It is <i>so</i>me<br>thing &am</p>'
            '<section id="comments"><p>A reader writes a long comment of many words about all that was said in the article above here.</p></section>'
            '</article><footer>&copy; me &middot; A long footer sentence of more than a dozen words that is not of the article.</footer></body></html>')
    assert text(page) == "Ti&tle One two three. 4 < 5 Be. It is some thing &am"


def test_broken_pages():
    assert text("") == text("<p>") == text("<!-- open <p>x") == text("<article><script>x") == ""
    assert text("<article><p>a<p>b<div>c<br>d</article></div><footer>e") == "a b c d"
    assert text("<ARTICLE><P>Up</P><NAV><A>n</A></NAV>") == "Up"
    long = "word " * 200_000
    assert text(f"<article><p>{long}</p></article>") == long.strip()
    assert text("<article>" + "<div>" * 5000 + "x") == "x"


def test_without_an_article_element():
    body = "This is a paragraph of a page that has no article element but many words without any link in them at all. " * 2
    page = f'<div><a href="/">Home</a> <a>News</a> <a>More</a></div><h1>The heading</h1><p>{body}</p><p>{body}</p><div><a>next</a> <a>back</a></div>'
    assert text(page) == ("The heading " + body + body).strip()


def test_query_against_the_template(spark):
    want = {}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        m = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html or "", re.S)
        t = re.sub(r"<[^>]*(>|$)", "", re.sub(r"</?(?:p|br|h1)\b[^>]*>", " ", m[1] if m else ""))
        want[r.page_id] = " ".join(html.unescape(t).split())
    got = html_text.query(spark, SF)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert {r.page_id: r.text for r in got.collect()} == want


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(1, None, None, "x"), (1, "u", "<article>a</article>", "x"), (1, "u", "<article>a</article>", "x"), (None, "u", "", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((str(r.page_id), r.text, r.n_chars) for r in html_text.extract(df).collect())
    assert got == [("1", "", 0), ("1", "a", 1), ("1", "a", 1), ("None", "", 0)]
    assert html_text.extract(df.limit(0)).count() == 0


def test_nothing_is_lost_behind_broken_elements():
    assert text("<main><p>Hello world text one</p><svg/><p>more text after</p></main>") == "Hello world text one more text after"
    assert text('<main><p>One <object data="x"/> two</p><p>three</p></main>') == "One two three"
    assert text("<article><p>One <button>Click<p>two</p><p>three <button>x</button> four</p></article>") == "One two three four"
    assert text("<article><p>a<svg><text>icon</text></svg>b</p><noscript><p>no</p></noscript><p>c</p></article>") == "ab c"
    assert text("<article><div><template><div>t</div><p>u</p></div><p>v</p></article><template></template>") == "v"
    assert text("<article><p>x</p><textarea>never closed<p>y</p></article>") == "x never closed y"
    assert text("<article><p>x</p><title>T</title><iframe>f</iframe><p>y</p></article>") == "x y"


def test_attributes():
    assert text("<article><p title=it's>one</p><p title='a>b' data-x=\"c>d\">two</p><p class=>three</p><p title=\"open>four</p></article>") == "one two three four"
    assert text("<article><p>x</p><p class='promo-code'>y</p><h2 id=related>z</h2><p>w</p></article>") == "x w"
    words = "plain words of a long paragraph that goes on and on " * 6
    assert text(f"<article><p>{words}</p><p class='section-header'>{words}</p><p>{words}</p></article>") == " ".join((words * 3).split())
    links = "<li><a href='/x'>one link</a></li>" * 5
    assert text(f"<article><p>{words}</p><ul>{links}</ul><p>{words}</p></article>").count("one link") <= 2
    assert text(f"<article><p>{words}</p><p><a href='/x'>one link</a></p><p>{words}</p></article>").count("one link") == 1


def test_the_tree_uses_every_kind_of_feature():
    used = set()

    def walk(t):
        if isinstance(t, dict):
            used.add(html_text.FEATURES[t["by"]])
            walk(t["low"]), walk(t["high"])
    walk(TREE)
    assert {"words", "link_density", "in_article", "in_other", "hinted"} <= used
    assert used & {"words_before", "density_before"} and used & {"words_after", "density_after"}
