"""Main text of web pages: hosts agree on the path of the container that holds it."""

from __future__ import annotations

import hashlib
import html as references
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import map_pandas
from strataflow.session import stage

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
CONTAINER = frozenset("article body div main section td center table ul ol dl blockquote".split())
WHOLE = frozenset(("article", "main"))
#: Elements that are never part of a main text.
OUTSIDE = frozenset(
    "head script style noscript template nav footer aside form button select option textarea input label svg math "
    "canvas iframe object audio video menu dialog fieldset frameset noframes title".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes template".split())
#: Words of class and id that mark what stands around a main text, whatever stands beside them.
AROUND = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo nav navbar navigation "
    "menu menubar sidebar footer masthead topbar toolbar breadcrumb breadcrumbs comment comments replies disqus cookie "
    "cookies consent gdpr notice notices notification alert popup modal overlay subscribe newsletter signup widget widgets "
    "pagination pager disclaimer outbrain taboola paywall".split()
)
#: Words that do so too, but are also what an article may be about.
UNSURE = frozenset(
    "promotion side header reply respond discussion share sharing social related recommended recommendations subscription "
    "login search form skip tags copyright".split()
)
#: Words that say nothing of what an element holds.
PLAIN = frozenset(
    "area bar block body bottom box button buttons col column container content field group icons inner input item items "
    "left link links list main media more outer page panel post posts article articles story stories right row section "
    "site text top topics user wrap wrapper".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
GOOD = frozenset("article content post entry story text body main".split())
#: An open element of the first kind ends at the start of one of the second, short of the third.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "body": (("head",), ()),
}
#: A longer path goes on under a digest of its own, so that deep pages do not take space by the square.
LONGEST = 4000
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/<>]*+)((?:[^'"<>]|"[^"<>]*"|'[^'<>]*')*+)>|(?=<(/?)[A-Za-z])""",
    re.S,
)
NAME = re.compile(r"[A-Za-z][^\s/>]*")
MARK = re.compile(r"""["'>]""")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORDS = re.compile(r"[A-Za-z]+?(?=[A-Z][a-z]|[^A-Za-z]|$)")


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(raw):
        out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out


def _is_around(tag: str, found: dict[str, str], in_whole: bool, hints: bool) -> bool:
    if tag in OUTSIDE or tag == "header" and not in_whole:
        return True
    if not found or tag in ("html", "body"):
        return False
    if "hidden" in found or found.get("aria-hidden") == "true" or found.get("role", "").lower() in ROLES:
        return True
    if "display:none" in found.get("style", "").replace(" ", "").lower():
        return True
    if not hints or tag in WHOLE and not in_whole:
        return False
    return any(not AROUND.isdisjoint(words) for words in _named(found))


def _named(found: dict[str, str]) -> list[list[str]]:
    """The words of each class and of the id."""
    names = [*found.get("class", "").split(), found.get("id", "")]
    return [[w.lower() for w in WORDS.findall(n)] for n in names if n]


def _unsure(tag: str, found: dict[str, str]) -> tuple[bool, str]:
    """Whether the names mark what stands around, and if they leave it open, what to vote on.

    A name of unsure and plain words alone is a mark, unless another name tells
    of a main text; next to other words it is left to the pages of the host.
    """
    named = _named(found)
    unsure = [words for words in named if not UNSURE.isdisjoint(words)]
    if not unsure:
        return False, ""
    told = any(words and GOOD.issuperset(words) for words in named)
    if not told and any(all(w in UNSURE or w in PLAIN for w in words) for words in unsure):
        return True, ""
    return False, f"{tag}." + ".".join("-".join(words) for words in sorted(named) if words)


class Tags:
    """The tags of a page, one after the other, in time that follows its length.

    Where quotes are open, the end of a tag is the first ``>`` outside quotes,
    or if there is none, the first at all; a tag without either is text.  Places
    from which the end of the page is reached are kept, so that no stretch is
    read again for each tag before it.
    """

    def __init__(self, html: str):
        self.html = html
        self.last = html.rfind(">")
        self.lost: set[int] = set()

    def _end(self, at: int) -> int:
        """The first ``>`` outside quotes from ``at``, or -1."""
        seen = []
        while (m := MARK.search(self.html, at)) and m.start() not in self.lost:
            if m[0] == ">":
                return m.start()
            seen.append(m.start())
            close = self.html.find(m[0], m.end())
            if close < 0:
                break
            at = close + 1
        self.lost.update(seen)
        return -1

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """Start, end, whether it closes, name and attributes of the next tag; no name for a comment."""
        while m := TOKEN.search(self.html, at):
            start = m.start()
            if m[2]:
                return start, m.end(), bool(m[1]), m[2].lower(), m[3]
            if m[4] is None:
                return start, m.end(), False, "", ""
            if start > self.last:  # no tag ends any more, but a comment may begin
                begun = min((n for n in (self.html.find(c, start) for c in ("<!", "<?")) if n >= 0), default=-1)
                return None if begun < 0 else (begun, len(self.html), False, "", "")
            name = NAME.match(self.html, start + 1 + len(m[4]))
            end = self._end(name.end())
            if end < 0:
                end = self.html.find(">", name.end())
            return start, end + 1, bool(m[4]), name[0].lower(), self.html[name.end() : end]
        return None


def parse(html: str, hints: bool = True) -> tuple[list, list[tuple[str, int, str]], list[tuple[str, int]]]:
    """Blocks (text, container, text in links, doubt), containers (path, parent, tag) and doubts (name, outer doubt).

    All are in page order.  A doubt is an element whose class or id leaves open
    whether it belongs to a main text; -1 is none.

    Container 0 is the page itself.  A path is the tags and classes from the top,
    digits made equal.  What stands around a main text gives no blocks; with
    ``hints`` off, only tags and not the words of class and id tell it.  Elements
    may be nested to any depth, at a cost that follows the length of the page.
    """
    blocks: list[tuple[str, int, int, int]] = []
    boxes: list[tuple[str, int, str]] = [("", -1, "")]
    doubts: list[tuple[str, int]] = []
    stack: list[tuple[str, int, bool, bool, bool, int]] = []  # tag, and what held before it
    places: dict[str, list[int]] = {}  # of the open elements of a tag in the stack
    containers: list[int] = []
    box, around, in_link, in_whole, doubt = 0, False, False, False, -1
    held: list[str] = []
    linked = at = 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                blocks.append((text, box, linked, doubt))
            held.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw and not around:
            text = references.unescape(raw) if "&" in raw else raw
            held.append(text)
            if in_link:
                linked += len(text)

    def close_to(n: int) -> None:
        nonlocal box, around, in_link, in_whole, doubt
        while len(stack) > n:
            tag, *before = stack.pop()
            places[tag].pop()
            if tag in CONTAINER:
                containers.pop()
            if tag in BLOCK:
                flush()
            box, around, in_link, in_whole, doubt = before

    def last(tags: tuple[str, ...]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    tags = Tags(html)
    while found_tag := tags.next(at):
        start, end_, closes, tag, raw = found_tag
        say(html[at:start])
        at = end_
        if not tag:
            continue
        if closes:
            if places.get(tag):
                close_to(places[tag][-1])
            continue
        if tag in BLOCK:
            flush()
            n = last(("p",))
            if n > (containers[-1] if containers else -1):
                close_to(n)
        if tag in ENDS:
            first, stop = ENDS[tag]
            while (n := last(first)) > last(stop):
                close_to(n)
                if tag != "tr":
                    break
        if tag in VOID:
            held.append(" ")
            continue
        found = _attributes(raw) if raw and not raw.isspace() else {}
        if tag in RAW:  # its text is not markup
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(html, at)
            at = end.start() if end else len(html)
        places.setdefault(tag, []).append(len(stack))
        if tag in CONTAINER:
            containers.append(len(stack))
        stack.append((tag, box, around, in_link, in_whole, doubt))
        around = around or _is_around(tag, found, in_whole, hints)
        if not around and found and hints and tag not in ("html", "body") and (in_whole or tag not in WHOLE):
            around, name = _unsure(tag, found)
            if name and tag in BLOCK:
                doubts.append((name, doubt))
                doubt = len(doubts) - 1
        if tag == "a":
            in_link = True
        if tag in CONTAINER and not around and tag not in ("td", "table", "ul", "ol", "dl", "blockquote"):
            classes = sorted({re.sub(r"\d+", "#", c.lower()) for c in found.get("class", "").split()})
            step = ".".join([tag, *classes])
            above = boxes[box][0]
            if len(above) > LONGEST:
                above = hashlib.md5(above.encode("utf-8", "surrogatepass")).hexdigest()
            boxes.append((f"{above}>{step}" if box else step, box, tag))
            box = len(boxes) - 1
        in_whole = in_whole or tag in WHOLE
    say(html[at:])
    flush()
    if not blocks and hints:
        return parse(html, hints=False)
    return blocks, boxes, doubts


def doubted(blocks: list, doubts: list) -> list[tuple[str, list[str], int, int]]:
    """Name, texts, length and length in links of each doubt, with all it holds."""
    held: list[list[str]] = [[] for _ in doubts]
    sizes, linked = [0] * len(doubts), [0] * len(doubts)
    for text, _, n, doubt in blocks:
        if doubt >= 0:
            held[doubt].append(text)
            sizes[doubt] += len(text)
            linked[doubt] += n
    for k in range(len(doubts) - 1, -1, -1):
        up = doubts[k][1]
        if up >= 0:
            sizes[up] += sizes[k]
            linked[up] += linked[k]
    return [(name, held[k], sizes[k], linked[k]) for k, (name, _) in enumerate(doubts)]


def settled(blocks: list, doubts: list, around: frozenset[str] = frozenset()) -> list:
    """The blocks without those of doubts that hold mostly links or that the host's pages vote out.

    If nothing else is on the page they stay.
    """
    if not doubts:
        return blocks
    out: list[bool] = []
    for (name, up), (_, _, size, linked) in zip(doubts, doubted(blocks, doubts)):
        out.append(name in around or 2 * linked > size or up >= 0 and out[up])
    kept = [b for b in blocks if b[3] < 0 or not out[b[3]]]
    return kept or blocks


def path_scores(blocks: list, boxes: list) -> dict[str, float]:
    """The score of each path of a page: text outside links, most for the nearest containers.

    A block counts whole for the container it stands in and half as much for
    each further one; an article or main element counts one and a half times all
    it holds, and nothing above it gets more than its share.
    """
    held, shared = [0.0] * len(boxes), [0.0] * len(boxes)  # all that a box holds, and its share of that
    for text, box, linked, _ in blocks:
        worth = max(0.0, len(text) - 2.0 * linked) + 1.0
        held[box] += worth
        shared[box] += worth
    scores: dict[str, float] = {}
    for box in range(len(boxes) - 1, -1, -1):  # those inside a box come after it
        if not held[box]:
            continue
        path, up, tag = boxes[box]
        factor = 1.0
        if tag in WHOLE:
            shared[box], factor = held[box], 1.5
        elif any(w in GOOD for w in re.split(r"[^a-z]+", path.rpartition(">")[2].partition(".")[2])):
            factor = 1.2
        scores[path] = scores.get(path, 0.0) + shared[box] * factor
        if up >= 0:
            held[up] += held[box]
            shared[up] += shared[box] / 2
    return scores


def text_at(path: str, blocks: list, boxes: list) -> str:
    """The blocks inside the containers at ``path``, in page order."""
    inside: list[bool] = []
    for own, up, _ in boxes:
        inside.append(own == path or up >= 0 and inside[up])
    return "\n".join(b[0] for b in blocks if inside[b[1]])


def main_text(html: str | None, winners: list[str], around: frozenset[str] = frozenset()) -> str:
    """The text at the first of the host's paths that holds enough of the page, or at the page's own best.

    ``around`` names the doubts that the host's pages vote out.
    """
    if not html:
        return ""
    blocks, boxes, doubts = parse(html)
    blocks = settled(blocks, doubts, around)
    if not blocks:
        return ""
    scores = path_scores(blocks, boxes)
    best = max(scores, key=lambda p: (scores[p], len(p), p))
    for path in winners:
        if scores.get(path, 0.0) * 2 >= scores[best]:
            return text_at(path, blocks, boxes)
    return text_at(best, blocks, boxes)


def host(url: str = "url") -> Column:
    """The host of a URL in lower case, empty if it names none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    return F.coalesce(F.lower(found), F.lit(""))


def host_paths(pages: DataFrame, *, most: int = 5, least: int = 3) -> DataFrame:
    """host, its ``most`` best paths by votes as ``paths``, and the names of doubts voted out as ``around``.

    Each page gives one vote, dealt over its paths by their scores.  A doubt is
    voted out if it stands on ``least`` pages or more of the host and has at
    most one text for every two of them.  Votes are summed in each batch of
    pages, then by Spark, so a host with a third of all pages costs a row a path
    and batch.  Pages without host do not vote.
    """

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            votes: dict[tuple[str, str, str | None], float] = {}

            def vote(key: tuple[str, str, str | None], worth: float) -> None:
                votes[key] = votes.get(key, 0.0) + worth

            for name, page in zip(b["host"], b["html"]):
                if not page:
                    continue
                blocks, boxes, doubts = parse(page)
                scores = path_scores(settled(blocks, doubts), boxes)
                total = sum(scores.values())
                for path, score in scores.items():
                    vote((name, path, None), score / total)
                texts: dict[str, list[str]] = {}
                for doubt, held, _, _ in doubted(blocks, doubts):
                    texts.setdefault(doubt, []).extend(held)
                for doubt, held in texts.items():
                    digest = hashlib.md5("\n".join(held).encode("utf-8", "surrogatepass")).hexdigest()
                    vote((name, doubt, digest), 1.0)
            rows = [(h, p, d, round(v * 1e6)) for (h, p, d), v in votes.items()]
            yield pd.DataFrame(rows, columns=["host", "path", "digest", "votes"]).astype({"digest": "object"})

    hosted = pages.select(host().alias("host"), "html").where("host <> ''")
    cast = stage(map_pandas(hosted, step, "host string, path string, digest string, votes long"), "host_votes")
    votes = cast.where("digest IS NULL").groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), "path"))
    ranked = votes.withColumn("rank", rank).where(F.col("rank") <= most)
    in_order = F.sort_array(F.collect_list(F.struct("rank", "path")))
    paths = ranked.groupBy("host").agg(F.transform(in_order, lambda x: x["path"]).alias("paths"))
    texts = cast.where("digest IS NOT NULL").groupBy("host", "path", "digest").agg(F.sum("votes").alias("votes"))
    told = texts.groupBy("host", "path").agg(F.sum("votes").alias("pages"), F.count(F.lit(1)).alias("texts"))
    out = told.where((F.col("pages") >= least * 10**6) & (F.col("texts") * 2 * 10**6 <= F.col("pages")))
    around = out.groupBy("host").agg(F.sort_array(F.collect_set("path")).alias("around"))
    return paths.join(around, "host", "left")


def extract(pages: DataFrame, *, most: int = 5) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Blocks are joined by one line feed, white space inside a block is one space,
    character references are decoded; nothing else of the main text is dropped.
    NULL and empty pages, and pages without main text, give an empty text.
    Repeated rows are extracted like others; pages without host use their own
    best container.  An empty table gives no rows; other columns are ignored.
    The table of paths has a row a host; Spark broadcasts it if it is small, and
    else splits the join's hot hosts.
    """
    winners = stage(host_paths(pages, most=most), "host_paths")
    with_paths = pages.select("page_id", "url", "html", host().alias("host")).join(winners, "host", "left")
    id_type = pages.schema["page_id"].dataType.simpleString()

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [
                main_text(h, [] if p is None else list(p), frozenset(() if a is None else a))
                for h, p, a in zip(b["html"], b["paths"], b["around"])
            ]
            yield b[["page_id", "url"]].assign(text=texts)

    found = map_pandas(with_paths.select("page_id", "url", "html", "paths", "around"), step, f"page_id {id_type}, url string, text string")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
