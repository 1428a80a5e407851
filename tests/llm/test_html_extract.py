import html.parser
import random
import time

import pytest

from tableprep.llm.html_extract import extract_main_text, main_text

LONG = "This sentence is long enough to count as the running text of an article on any page. " * 2

PAGES = [
    ("<html><body><nav><a href='/x'>Menu</a></nav><article><h1>Title</h1><p>One  two\n three</p>"
     "<p>A &amp; B &lt;c&gt; &#233;&eacute;</p></article><footer>&copy; foot</footer></body></html>",
     "Title\nOne two three\nA & B <c> éé"),
    ("<article><h1>T</h1><p><b>bold<br><p>next</article><footer>x &am", "T\nbold\nnext"),
    ("<body><aside>side</aside><div class='cookie-notice'>cookies</div><main><p>keep</p><div id='ad-1'>buy</div>"
     "<form><label>Mail</label><input></form><p>more</p><section class='comments'><p>I disagree</p></section></main>",
     "keep\nmore"),
    ("<script>var t='</p>';</script><style>p{}</style><article>in <!-- out --><i>l</i>ine</article>", "in line"),
    ("<div class='content with-sidebar'><article><p>wrapped</p></article></div><div class='sidebar'>links</div>", "wrapped"),
    (f"<div class='menu'>a | b</div><div><p>{LONG}</p><p>short</p><p>{LONG}</p></div><p>Imprint</p>",
     f"{LONG.strip()}\nshort\n{LONG.strip()}\nImprint"),
    (f"<ul><li><a href='/a'>Home</a><li><a href='/b'>About us</a></ul><p>{LONG} <a href='/c'>more</a></p>", f"{LONG.strip()} more"),
    ("<ul><li>first<li>second</ul>", "first\nsecond"),
    ("<article><p title='a > b'>attr</p><p hidden>no</p><p style='display: none'>no</p></article>", "attr"),
    ("plain text only", "plain text only"), ("", ""), (None, ""), ("<p", ""), ("<article></article>", ""),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_main_text(page, text):
    assert main_text(page) == text


SLUGS = [
    ("<article><section id='search-algorithms'><h2 id='related-work'>Related</h2><p id='form-factor'>small</p></section>"
     "<h3 id='search'>Search</h3><div id='binary-search'>halves</div><section class='comments'>no</section></article>",
     "Related\nsmall\nSearch\nhalves"),
    (f"<div class='post category-social-media tag-search'><p>{LONG}</p></div><div class='site-footer'>{LONG}</div>", LONG.strip()),
    (f"<div class='content has-sidebar'><p>{LONG}</p></div><div class='ad-container'>{LONG}</div>", LONG.strip()),
    (f"<div class='notice'><h2>Head</h2><p>{LONG * 2}</p></div>", f"Head\n{(LONG * 2).strip()}"),
    (f"<article><p>keep</p><div class='comment-list'><p>{LONG * 2}</p></div><div class='notice'>short</div>"
     "<div id='ad-1'>buy</div><div class='social-share-buttons'>tell</div></article>", "keep"),
    ("<article id='how-to-reply'><p>keep</p></article>", "keep"),
]


@pytest.mark.parametrize("html,text", SLUGS)
def test_furniture_words_count_as_heads_only(html, text):
    assert main_text(html) == text


LEAD = "A lead of one sentence that is long enough to surge by itself, as the threshold asks for it."
CARD = "<article><h3>Teaser</h3><p>Read this too</p></article>"
GAP = "<div class='ad'>buy</div>" * 4
FRAMES = [
    (f"<div><p>{LEAD}</p></div>{GAP}<div><p>{LONG * 4}</p><p>{LONG * 4}</p></div>{GAP}<div><p>{LEAD}</p></div>",
     "\n".join([LEAD, (LONG * 4).strip(), (LONG * 4).strip(), LEAD])),
    (f"<div><p>{LONG}</p></div>{GAP}{CARD}", LONG.strip()),
    (f"<div><p>{LONG}</p></div><div class='related'>{CARD * 9}</div>", LONG.strip()),
    (f"<article><p>{LONG}</p><div class='related'>{CARD}</div></article><p>outside</p>", LONG.strip()),
    (f"<div class='sidebar'><article><p>{LONG}</p></article></div><p>outside</p>", LONG.strip()),
]


@pytest.mark.parametrize("html,text", FRAMES)
def test_regions_and_frames(html, text):
    assert main_text(html) == text


def test_table_keeps_rows_and_counts_code_points(spark):
    rows = [(i, f"u{i}", h, "clash") for i, (h, _) in enumerate(PAGES)] + [(None, None, "<p>𝄞é</p>", "c"), (1, "u1", PAGES[1][0], "c")]
    out = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted((r.page_id is None, r.page_id or 0, r.text) for r in out) == sorted(
        (r[0] is None, r[0] or 0, main_text(r[2])) for r in rows)
    assert all(r.n_chars == len(r.text) for r in out)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract_main_text(empty).count() == 0


def test_given_pages_give_their_article(spark):
    import re
    from .helpers import tables
    pages = {r.page_id: r.html for r in tables(spark, "pages").collect()}
    for r in extract_main_text(tables(spark, "pages")).collect():
        body = re.search("<article>(.*)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(x.replace("&amp;", "&").replace("&quot;", '"').split())
                  for x in re.split(r"</?(?:p|h1)>", re.sub(r"<br>|</?b>", " ", body))]
        assert r.text == "\n".join(x for x in blocks if x)


AD = '<div class="ad">Buy now and save</div>'


@pytest.mark.parametrize("page, want", [
    # quotes in unquoted values and names are letters
    ("<p>Zeroth.</p><a title=don't>x</a><p>First.</p><p>Second, it's here.</p><p>Third.</p>",
     "Zeroth.\nFirst.\nSecond, it's here.\nThird."),
    ("<article><p class=a'b>One.</p><p title=\"x>y\">Two, isn't it.</p><p title = 'a>b' id=c\">Three.</p></article>",
     "One.\nTwo, isn't it.\nThree."),
    ("<article><p title=\"class='ad'\">Kept.</p><p data-class=ad>Kept too.</p></article>", "Kept.\nKept too."),
    ("<article><p>Formula <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding=\"application/x-tex\">x=2</annotation></math>"
     " holds.</p></article>", "Formula x=2 holds."),
    # a short end in the same element as the text, behind weightless blocks; other short blocks stay out
    (f'<div class="post"><p>{"Long text here. " * 20}</p>{AD * 3}<p>Short end.</p></div>{AD * 3}<div><p>Imprint</p></div>',
     ("Long text here. " * 20).strip() + "\nShort end."),
    # an article's own lead and heading, not its byline and date
    ("<article><header><h1>Head</h1><p>By Jane Doe</p><p>3 May 2020</p><p>The town council has met again to talk about the bridge.</p>"
     "</header><p>Text.</p></article>", "Head\nThe town council has met again to talk about the bridge.\nText."),
])
def test_text_that_was_lost(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("page", [
    "<div>" * 100_000 + "<p>text</p>", "<nav>" * 50_000 + "x", "<b>" * 50_000 + "<p>x" * 20_000, "</section>" * 50_000 + "x",
    "<div>" * 50_000 + "</section>" * 50_000, '<div class="widget"><article>x' * 20_000, "<div class=related>" * 20_000 + "y" * 400,
    '<a href="' * 20_000, "<a b='" * 20_000, "<" * 100_000, "<!--" * 50_000, "<p a=b c='d" * 20_000])
def test_time_grows_with_the_page(page):
    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 3


class _Plain(html.parser.HTMLParser):
    """Independent reading of well-formed pages: blocks inside the article and outside of furniture."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.blocks, self.now = [], [], ""

    def end_block(self):
        text, self.now = " ".join(self.now.split()), ""
        kinds = [t for t, _ in self.open]
        if text and "article" in kinds and not any(t in ("nav", "aside", "footer", "form", "script", "style") or c in (
                "ad", "comments", "cookie-notice") for t, c in self.open):
            self.blocks.append(text)

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.now += " "
            return
        if tag not in ("b", "em", "a", "span"):
            self.end_block()
        self.open.append((tag, dict(attrs).get("class")))

    def handle_endtag(self, tag):
        if tag not in ("b", "em", "a", "span"):
            self.end_block()
        self.open.pop()

    def handle_data(self, data):
        if not any(t in ("script", "style") for t, _ in self.open):
            self.now += data


def _page(rng):
    def words(n):
        return " ".join(rng.choice(["tree", "it's", "a &lt; b", "caf&eacute;", "x", "long\n  road", "1&nbsp;000", "don&#39;t"]) for _ in range(n))

    def run():
        return "".join(rng.choice(["{}", "<b>{}</b>", "<em>{}</em> ", "<a href='/x?a=1&b=2'>{}</a>", "<span class=q>{}</span>", "{}<br>"])
                       .format(words(rng.randrange(1, 6))) + " " for _ in range(rng.randrange(1, 4)))

    def block(deep):
        kind = rng.randrange(9)
        if kind < 4 or deep > 3:
            return f"<p>{words(2)} {run()}</p>"
        if kind == 4:
            return "<ul>" + "".join(f"<li>{words(2)} {run()}</li>" for _ in range(3)) + "</ul>"
        if kind == 5:
            return f"<h2>{words(3)}</h2>"
        if kind == 6:
            return rng.choice(["<nav>{}</nav>", "<aside>{}</aside>", '<div class="ad">{}</div>', "<form>{}</form>",
                               "<script>if (a < b) x = '{}';</script>", '<div class="comments">{}</div>',
                               '<div class="cookie-notice">{}</div>', "<!-- {} -->", "<style>p {{ x: '{}' }}</style>"]).format(f"<p>{words(4)}</p>")
        return f'<div class="{rng.choice(["part", "x1", "lead-text"])}">' + "".join(block(deep + 1) for _ in range(rng.randrange(1, 4))) + "</div>"
    body = "".join(block(0) for _ in range(rng.randrange(3, 9)))
    return (f"<!doctype html><html><head><title>t</title></head><body><nav><p>{words(3)}</p></nav><main><article><h1>{words(2)}</h1>"
            f"<p>{words(80)}</p>{body}</article></main><footer><p>{words(5)}</p></footer></body></html>")


def test_same_as_an_independent_parser():
    rng = random.Random(6)
    for _ in range(400):
        page = _page(rng)
        plain = _Plain()
        plain.feed(page)
        assert main_text(page) == "\n".join(plain.blocks), page
