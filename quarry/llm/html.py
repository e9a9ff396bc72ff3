"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass decides each block on its own: by the element that holds
it (menus, forms, adverts, comments and the like are out), by the share of its characters inside links, by its length and
by the density of stop words. A word that names boilerplate (related, search) decides where it is all that a class or an id
says, beside words of layout; among other words it only raises the bar. Short blocks without enough signs stay ambiguous. The second pass gives these the label of
the nearest decided block (of the two neighbours, the nearer one; text wins a tie). If the blocks that a page marks as
its article hold the larger part of its text by these rules, only they count, by milder rules, and neighbours are looked
for within them. Otherwise the rest is judged too, and marked blocks that aren't links are text besides.

Each page is read once, whole, from sign to sign, in time that grows with its length whatever its tags are; nothing is
shuffled.

Defined results: null, empty and text-less pages give an empty text; very long pages are read whole; repeated rows are
extracted each; unclosed and stray tags are tolerated (only a script or style left open after the head takes the rest of the page,
as in browsers; of other elements whose content is skipped, one left open loses its start tag alone); an empty table gives an empty result; columns that aren't named
are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG = re.compile(r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"<]*\"|'[^'<]*'|[^<>\"'])*+|[^>]*)>", re.S)
OPEN = re.compile(r"<!--|<!\[CDATA\[")
WORD = re.compile(r"[^\W\d_]+")
ANCHOR = re.compile(r"<(/?)a(?=[\s/>])", re.I)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")

# Elements of HTML, and words in class, id and role that name what isn't an article.
RAW = frozenset("script style title textarea noscript template iframe svg math object select button canvas audio video".split())
CODE = frozenset("script style title textarea".split())  # their text is no markup
NESTED = frozenset("svg math object template".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
OUTSIDE = frozenset("nav footer aside form menu dialog fieldset".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
OUTSIDE_WORDS = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar aside footer masthead topbar cookie cookies consent gdpr notice notices notification alert newsletter subscribe subscription signup login share sharing social comment comments commentlist respond disqus reply replies related recommended popup modal overlay pagination pager widget toolbar skip copyright disclaimer form search".split())
# Words that, beside such a word in one name, leave it what it names: cookie-notice-bar, reader-comments, but not related-work.
PLAIN_WORDS = frozenset("site page main top bottom left right upper lower inner outer header head title body content text box block blocks container wrapper wrap section area region list lists item items row column col grid panel pane bar button buttons btn link links icon icons media network networks post posts article articles story stories news reader readers user users thread count form field input primary secondary global local mobile desktop fixed sticky inline slot unit zone space wide narrow small large first last the us on email mail box-inner js".split())
ADVERT_WORDS = frozenset("ad ads adv advert adverts advertisement advertising adsense adsbygoogle sponsor sponsored sponsors promo promotion".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CANCEL = frozenset("no has with without hide not".split())
INSIDE_NAMES = frozenset("article articlebody article-body article-content article__body post post-body post-content entry entry-content story story-body".split())
STOP = frozenset(
    "a about after all also an and any are as at be been but by can could did do for from had has have he her his how i if in into is it its just like more most my no not of on one only or other our out over said she so some such than that the their them then there these they this to up was we were what when which who will with would you your "
    "au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui mais ne nous ou par pas plus pour qu que qui sa se ses son sont sur un une vous "
    "aber als am auch auf aus bei das dass dem den der des die durch ein eine einem einen einer er es für hat ich ihr im in ist man mit nach nicht noch nur oder sein sich sie sind so über um und von vor war was wie wird zu zum zur "
    "al como con del el ella en era es esta este fue ha han hay la las lo los más me mi muy no nos o para pero por que se ser si sin sobre su sus también te un una y ya".split()
)
SHORT, LONG = 70, 200
MILD, LOW = 0.10, 0.20
FEW_LINKS, LINKS = 0.2, 0.5
#: A list item that is a link of fewer words may be a menu's entry; a longer one is open.
ENTRY = 4
COPYRIGHT = re.compile(r"(?:©|\(c\)|copyright\b)", re.I)


@dataclass
class Block:
    text: str
    links: int  # characters inside links
    outside: bool
    doubtful: bool  # a name around it holds such a word among others
    article: int  # number of the article that holds it, or 0
    item: bool
    label: str = ""
    heading: bool = False


def words_of(attributes: dict[str, str]) -> list[str]:
    said = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    return re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", said).lower()) if said.strip() else []


def attributes_of(raw: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(raw)} if raw.strip(" /") else {}


def is_hidden(attributes: dict[str, str]) -> bool:
    return "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower()


def is_muted(raw: str) -> bool:
    """Whether an inline element isn't shown, or is an advert. Other words name too much that is text, as in code."""
    attributes = attributes_of(raw)
    words = words_of(attributes)
    return is_hidden(attributes) or (not ADVERT_WORDS.isdisjoint(words) and CANCEL.isdisjoint(words))


def names_outside(attributes: dict[str, str]) -> tuple[bool, bool]:
    """Whether a name in class or id says that an element is boilerplate, and whether one only holds such a word."""
    out = doubt = False
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = [w for w in words_of({"class": name}) if w and not w.isdigit()]
        if not OUTSIDE_WORDS.isdisjoint(words) and CANCEL.isdisjoint(words):
            whole = all(w in OUTSIDE_WORDS or w in PLAIN_WORDS for w in words)
            out, doubt = out or whole, doubt or not whole
    return out, doubt


def is_outside(tag: str, raw: str, in_article: bool) -> tuple[bool, bool, bool]:
    """Whether an element is boilerplate, whether it may be one, and whether it marks an article."""
    marks = tag in ("article", "main")
    if tag in ("html", "body"):
        return False, False, False
    attributes = attributes_of(raw)
    words = words_of(attributes)
    role = attributes.get("role", "").lower()
    out = tag in OUTSIDE or (tag == "header" and not in_article) or role in OUTSIDE_ROLES
    out |= is_hidden(attributes)
    doubt = False
    if words and tag != "main":
        named, doubt = names_outside(attributes)
        out |= named
    marks |= role in ("main", "article") or attributes.get("itemprop") == "articleBody" or (tag in ("div", "section") and bool(words) and not INSIDE_NAMES.isdisjoint(f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split()) and not out)
    return out, doubt, marks


def ends_of(html: str, tag: str) -> dict[int, int]:
    """For each start tag of an element of RAW that isn't code: where its end tag begins, if it has one."""
    ends: dict[int, int] = {}
    starts: list[int] = []
    for m in re.compile(rf"<(/?){tag}(?=[\s/>])(?:[^<>]*(/)>)?", re.I).finditer(html):
        if m[1]:
            if starts:
                ends[starts.pop()] = m.start()
        elif not m[2]:
            if tag not in NESTED:
                starts.clear()  # one before it was left open
            starts.append(m.start())
    return ends


class Code:
    """Where code and titles of one page end. Of each pattern the next place is kept: it is looked for once on the way."""

    def __init__(self, html: str) -> None:
        self.html, self.next = html, {}

    def _after(self, pattern: str, at: int) -> int | None:
        """Where the pattern is next, or None."""
        known = self.next.get(pattern, -1)
        if known is not None and known < at:
            found = re.compile(pattern, re.I).search(self.html, at)
            known = self.next[pattern] = found.start() if found else None
        return known

    def end(self, tag: str, at: int) -> int:
        """Without its end tag code ends with the head, or else a title at the next tag, code with the page."""
        stop = self._after(rf"</{tag}[\s/>]", at)
        if stop is None:
            stop = self._after(r"</head[\s/>]|<body[\s/>]", at)
        if stop is None and tag in ("title", "textarea"):
            stop = self._after(r"</?[a-z]", at)
        return len(self.html) if stop is None else stop


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page in order; text is decoded and its white space single."""
    found: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []
    plain = ("", False, False, False, 0, False)
    stack: list[tuple[str, bool, bool, bool, int, bool]] = []  # tag, outside, doubtful, muted, article, list item
    held: dict[str, int] = {}  # how many of each tag the stack holds
    _, outside, doubtful, muted, article, item = plain
    articles, link, at, heading = 0, "", 0, False
    ends: dict[str, dict[int, int]] = {}
    code = Code(html)

    def close() -> None:
        nonlocal link
        if parts:
            raw = "".join(parts)
            text = " ".join((unescape(raw) if "&" in raw else raw).split())
            if text:
                found.append(Block(text, len(" ".join(unescape("".join(linked)).split())), outside, doubtful, article, item, heading=heading))
            parts.clear()
            linked.clear()
        if link == "open":
            link = ""

    def say(text: str) -> None:
        if not muted:
            parts.append(text)
            if link:
                linked.append(text)

    def pop() -> None:
        held[stack.pop()[0]] -= 1

    def push(*state) -> None:
        stack.append(state)
        held[state[0]] = held.get(state[0], 0) + 1

    size, last = len(html), html.rfind(">")
    while at < size:
        # Each tag is matched where its sign stands, and none is tried behind the last sign that could end it: no part of a
        # page is gone through again and again.
        start = html.find("<", at)
        if start < 0 or start > last:
            rest = OPEN.search(html, at)  # a comment that is left open takes the rest
            say(html[at : rest.start()] if rest else html[at:])
            break
        m = TAG.match(html, start)
        if not m:
            say(html[at : start + 1])
            at = start + 1
            continue
        if start > at:
            say(html[at:start])
        at = m.end()
        tag = m[2]
        if not tag:
            continue
        tag = tag.lower()
        if tag in RAW:
            if not m[1] and not m[3].endswith("/"):
                if tag in CODE:
                    at = code.end(tag, at)
                else:
                    if tag not in ends:
                        ends[tag] = ends_of(html, tag)
                    at = ends[tag].get(m.start(), at)
                say(" ")
            continue
        if tag == "br":
            say(" ")
        elif tag == "a":
            # A link may hold whole blocks; one without an end tag ends with its block.
            near = None if m[1] else ANCHOR.search(html, at)
            link = "" if m[1] or "href" not in m[3].lower() else "closed" if near and near[1] else "open"
        elif tag in BLOCKS:
            close()
            if tag in ("hr", "head"):
                continue
            while stack and (stack[-1][0] not in BLOCKS or (stack[-1][0] == "p" and (tag != "p" or not m[1]))):
                pop()  # a block ends the inline elements and the paragraph before it
            _, outside, doubtful, muted, article, item = stack[-1] if stack else plain
            heading = not m[1] and tag[0] == "h" and tag[1:].isdigit()
            if m[1]:
                if held.get(tag):
                    while stack[-1][0] != tag:
                        pop()
                    pop()
            else:
                out, doubt, marks = is_outside(tag, m[3], article > 0)
                inner = article
                if marks and not article and not out:
                    articles += 1
                    inner = articles
                push(tag, outside or out, doubtful or doubt, muted, inner, item or tag == "li")
            _, outside, doubtful, muted, article, item = stack[-1] if stack else plain
        elif m[1]:
            if muted and stack and stack[-1][0] == tag:
                pop()
                _, outside, doubtful, muted, article, item = stack[-1] if stack else plain
        elif muted or (tag not in VOID and m[3] and is_muted(m[3])):
            if tag not in VOID:
                push(tag, outside, doubtful, True, article, item)
                muted = True
    close()
    return found


def stop_words(b: Block) -> float:
    words = WORD.findall(b.text.lower())
    return sum(w in STOP for w in words) / max(1, len(words))


def first_pass(b: Block) -> str:
    """good, bad or, of short or unclear blocks, an empty string."""
    density = b.links / len(b.text)
    if b.outside:
        return "bad"
    if density > LINKS:
        return "bad"
    if len(b.text) < SHORT:
        return ""
    stops = stop_words(b)
    if stops >= (MILD if len(b.text) >= LONG else LOW):
        return "good" if not b.doubtful or density < FEW_LINKS else "bad"
    if len(b.text) >= LONG and density < FEW_LINKS:
        return "good"  # another language, or a table
    return "" if stops >= MILD or (density < FEW_LINKS and not b.doubtful) else "bad"


def second_pass(blocks: list[Block]) -> None:
    """Ambiguous blocks inherit from the nearest decided one; where none is decided, they are text."""
    ahead: list[tuple[int, str]] = []
    near = (len(blocks) + 1, "good")
    for b in reversed(blocks):
        near = (0, b.label) if b.label else (near[0] + 1, near[1])
        ahead.append(near)
    near = (len(blocks) + 1, "good")
    for b, after in zip(blocks, reversed(ahead), strict=True):
        if b.label:
            near = (0, b.label)
            continue
        near = (near[0] + 1, near[1])
        b.label = min(near, after, key=lambda x: (x[0], x[1] != "good"))[1] if near[0] <= len(blocks) or after[0] <= len(blocks) else "good"


def marked_pass(b: Block, alone: bool, known: bool) -> str:
    """The milder rules for a marked block, where marked blocks count alone and where others count too. Few stop words
    leave it open if the language is known by other marked blocks; b.label is that of the first pass."""
    density = b.links / len(b.text)
    if not alone:
        return "bad" if density > LINKS else "good"
    if len(b.text) < SHORT or density > LINKS:
        return ""
    return "good" if not known or b.label == "good" or stop_words(b) >= MILD else ""


def is_entry(b: Block) -> bool:
    """Whether a block looks like a menu's entry: an item of few words, all of them a link."""
    return b.item and b.links > 0.8 * len(b.text) and len(b.text.split()) < ENTRY


def menus(blocks: list[Block]) -> None:
    """Items that are entries go where most of their list are: two at least, and more than half of the items in a row. One linked
    name among sentences is a part of them."""
    at = 0
    while at < len(blocks):
        end = at
        while end < len(blocks) and blocks[end].item:
            end += 1
        entries = [b for b in blocks[at:end] if is_entry(b)]
        if len(entries) >= 2 and 2 * len(entries) > end - at:
            for b in entries:
                b.label = "bad"
        at = max(end, at + 1)


def edges(blocks: list[Block]) -> None:
    """On pages without marks: before the first and behind the last block that is good by itself, items of few words without the
    end of a sentence are a menu's or a footer's, and so is a short line on copyright."""
    good = [i for i, b in enumerate(blocks) if b.label == "good"]
    if not good:
        return
    for i, b in enumerate(blocks):
        if not b.label and not good[0] < i < good[-1] and not b.heading:
            few = b.item and len(b.text.split()) < ENTRY and b.text[-1] not in ".!?:;"
            if few or (len(b.text) < SHORT and COPYRIGHT.match(b.text)):
                b.label = "bad"


def larger_part(blocks: list[Block]) -> bool:
    """Whether marked blocks hold the larger part of the text that the first pass calls good; or, if it calls none good,
    of the long text that it leaves open."""
    for label in ("good", ""):
        held = [(len(b.text), b.article > 0) for b in blocks if b.label == label and len(b.text) >= SHORT]
        if held:
            return 2 * sum(n for n, marked in held if marked) > sum(n for n, _ in held)
    return True


def main_text(html: str | None) -> str:
    """The article of a page, its blocks joined by one space."""
    blocks = blocks_of(html or "")
    for b in blocks:
        b.label = first_pass(b)
    marked = [b for b in blocks if b.article and not b.outside]
    if marked:
        alone, known = larger_part(blocks), any(b.label == "good" for b in marked)
        for b in marked:
            b.label = marked_pass(b, alone, known)
        if alone:
            blocks = marked
            menus(blocks)
    else:
        edges(blocks)
    second_pass(blocks)
    return " ".join(b.text for b in blocks if b.label == "good")


def extract(df: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """keep, text, n_chars (code points)."""

    @F.arrow_udf("string")
    def extracted(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(x.as_py()) for x in pages], pa.string())

    return df.select(*keep, extracted(html).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
