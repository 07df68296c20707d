from __future__ import annotations

import html
import random
import time

import pytest

from strataflow.llm import host_paths

SCHEMA = "page_id long, url string, html string, text string, host string, paths int"


def page(blocks, wrap, extra=""):
    body = "".join(f"<p>{html.escape(b)}</p>" for b in blocks)
    return (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
        f"<nav><ul><li><a href='/'>Home</a></li></ul></nav>{wrap[0]}{body}{wrap[1]}{extra}<footer>&copy; us</footer></body></html>"
    )


BLOCKS = ["First block, with some words in it & more.", "Second <block> of the text.", "Third one é."]
TEXT = "\n".join(BLOCKS)


@pytest.mark.parametrize(
    "wrap",
    [
        ("<article>", "</article>"),
        ("<main><div class='x1'>", "</div></main>"),
        ("<div id=wrap><div class='post-body c12'>", "</div></div>"),
        ("<table><tr><td class=nav>menu</td><td>", "</td></tr></table>"),
    ],
)
def test_containers(wrap):
    assert host_paths.main_text(page(BLOCKS, wrap), []) == TEXT


@pytest.mark.parametrize(
    "extra",
    [
        "<div class='ad'>Buy now, buy this great thing today, really!</div>",
        "<aside>Side text that is here, beside the rest</aside>",
        "<div class='cookie-notice'>We use cookies for all sorts of things</div>",
        "<section id='comments'><p>Reader: what a great text, thank you very much</p></section>",
        "<form><label>Mail</label><input><button>Send</button></form>",
        "<div class='sidebarWidget'>Popular posts of the week</div>",
        "<div hidden>never shown</div><div style='display: none'>nor this</div>",
        "<!-- a comment <p>not text</p> --><noscript>Turn on scripts</noscript>",
    ],
)
def test_what_stands_around(extra):
    for wrap in (("<article>", extra + "</article>"), ("<div class='content'>", extra + "</div>")):
        assert host_paths.main_text(page(BLOCKS, wrap), []) == TEXT
    assert host_paths.main_text(page(BLOCKS, ("<article>", "</article>"), extra), []) == TEXT


def test_markup():
    def text(inner):
        return host_paths.main_text(f"<body><article>{inner}</article></body>", [])

    assert text("<h1> A  &amp;\n B&nbsp;C </h1><p>one<br>two <b>bo</b>ld") == "A & B C\none two bold"
    assert text("<p><b>open<p>next</b> on<div>x</div>y") == "open\nnext on\nx\ny"
    assert text("<ul><li>a<li>b</ul><p title='a > b'>c</p>1 < 2") == "a\nb\nc\n1 < 2"
    assert text("&#233;&eacute;&amp &am &unknown; &lt;p&gt;") == "éé& &am &unknown; <p>"
    assert text("<script>if (a < b) { '<p>' }</script>z<STYLE>x</STYLE>") == "z"
    assert text("<p>cut off <a href='") == "cut off"
    assert text("<b>" * 3000 + "deep" + "</b>" * 3000) == "deep"
    assert text("word " * 100_000) == ("word " * 100_000).strip()


def test_deep_nests_lose_and_add_nothing():
    nest = "<div>" * 600 + "x" + "</div>" * 600
    inner = "".join(f"<p>{html.escape(b)}</p>" for b in BLOCKS)
    got = host_paths.main_text(f"<body><div id=o><main><p>before</p>{nest}{inner}</main></div><div>off</div></body>", [])
    assert got == "before\nx\n" + TEXT
    for junk in ("<font>" * 700, "<span>" * 3000, "<p><font>" * 700):
        for extra in ("<section id='comments'><p>Reader: great</p></section>", "<aside>Side</aside>", "<div hidden>never</div>"):
            got = host_paths.main_text(f"<body><article>{junk}{inner}{extra}</article></body>", [])
            assert got == TEXT
    assert host_paths.main_text("<div>" * 50_000 + "deep" + "</i></div>" * 50_000, []) == "deep"
    assert host_paths.main_text("<font><p>a</b>" * 30_000, []) == "\n".join("a" * 30_000)


def test_hosts_agree(spark):
    wrap = ("<div class='teaser'><p>Other stories you may read, many of them, on this site.</p></div><div class='txt'>", "</div>")
    long = [(k, f"http://A.example/{k}", page([f"Block {k} {n}, with a number of words." for n in range(8)], wrap)) for k in range(6)]
    short = (50, "https://a.EXAMPLE:80/x", page(["Only these few words stand here, on a short page of it."], wrap))
    rows = [(i, u, h, "t", "h", 1) for i, u, h in [*long, short]]
    paths = {r.host: r.paths for r in host_paths.host_paths(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert list(paths) == ["a.example"] and paths["a.example"][0] == "body>div.txt"
    got = {r.page_id: r.text for r in host_paths.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[50] == "Only these few words stand here, on a short page of it."
    assert got[3] == "\n".join(f"Block 3 {n}, with a number of words." for n in range(8))


def test_odd_pages(spark):
    rows = [
        (1, "http://x/", None), (2, None, ""), (None, "no url", "<p>plain</p>"), (3, "http://x/", "just text &amp; more"),
        (3, "http://x/", "just text &amp; more"), (4, "http://x/", "<div class='sidebar'><p>all of it</p></div>"), (5, "http://x/", "<<<>>"),
    ]
    df = spark.createDataFrame([(*r, "t", "h", 1) for r in rows], SCHEMA)
    got = sorted((r.page_id or -1, r.text, r.n_chars) for r in host_paths.extract(df).collect())
    assert got == [
        (-1, "plain", 5), (1, "", 0), (2, "", 0), (3, "just text & more", 16), (3, "just text & more", 16),
        (4, "all of it", 9), (5, "<<<>>", 5),
    ]
    assert host_paths.extract(df.limit(0)).count() == 0


def test_broken_markup_takes_time_by_its_length():
    for unit, end in (
        ("<a ", ""), ("a <b c ", ""), ('<a "', ""), ("<a<a", ""), ('<a "\' ', ">"), ("<a '>\"", "'"), ("<a \"x'>", ""),
        ('<p><a b="', ""), ("</a ", "<!--"), ("<", ">"),
    ):
        size = 1_000_000 // len(unit)
        begun = time.monotonic()
        host_paths.main_text("<body>" + unit * size + end, [])
        assert time.monotonic() - begun < 5


def test_tags_end_outside_quotes():
    def plain_end(text, at):
        quote = ""
        for k in range(at, len(text)):
            c = text[k]
            if quote:
                quote = "" if c == quote else quote
            elif c in "\"'":
                quote = c
            elif c == ">":
                return k
        return text.find(">", at)

    def plain(text):
        out, at = [], 0
        while 0 <= (start := text.find("<", at)) < len(text) - 1:
            at = start + 1
            if text[at] not in "abx":
                continue
            name = at
            while name < len(text) and text[name] not in " />":
                name += 1
            end = plain_end(text, name)
            if end >= 0:
                out.append((start, end + 1))
                at = end + 1
        return out

    draw = random.Random(5)
    for _ in range(3000):
        text = "".join(draw.choice("<ab\"'> x") for _ in range(draw.randint(1, 40)))
        tags, at, got = host_paths.Tags(text), 0, []
        while found := tags.next(at):
            got.append(found[:2])
            at = found[1]
        assert got == plain(text), text


@pytest.mark.parametrize(
    "names", ["class='story-text social-issues'", "id='related-work'", "class='tags-and-search'", "class='content share'"]
)
def test_names_an_article_may_have(names):
    for tag in ("div", "section"):
        got = host_paths.main_text(page(BLOCKS, ("<article>", f"<{tag} {names}><p>Kept.</p></{tag}></article>")), [])
        assert got == TEXT + "\nKept."


@pytest.mark.parametrize("names", ["class='related-posts'", "class='social-share'", "id=search", "class='post_comment-body'"])
def test_names_that_stand_around(names):
    assert host_paths.main_text(page(BLOCKS, ("<article>", f"<div {names}><p>Off.</p></div></article>")), []) == TEXT


def test_pages_vote_on_doubts(spark):
    same = "<div class='related-reading-tips'><p>Ever the same advice.</p></div>"
    rows, want = [], {}
    for k in range(8):
        own = f"<section class='related-work'><p>Work {k} that came before.</p></section>"
        links = "<div class='social-media-channels'><a href='/x'>Follow us over there</a></div>"
        blocks = [f"Page {k} block {n}, with words in it." for n in range(4)]
        rows.append((k, "http://h.example/p", page(blocks, ("<article>", own + same + links + "</article>")), "", "", 0))
        want[k] = "\n".join([*blocks, f"Work {k} that came before."])
    df = spark.createDataFrame(rows, SCHEMA)
    assert host_paths.host_paths(df).first().around == ["div.related-reading-tips", "div.social-media-channels"]
    assert {r.page_id: r.text for r in host_paths.extract(df).collect()} == want
    # Two pages are too few to vote anything out.
    few = {r.page_id: r.text for r in host_paths.extract(df.where("page_id < 2")).collect()}
    assert few == {k: f"{want[k]}\nEver the same advice." for k in range(2)}
