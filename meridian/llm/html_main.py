"""Main text of web pages by two-pass block rules.

A page is read once, tag by tag, into blocks (runs of text between block-level tags) with their
length, stop-word density, link density and region. Regions: *boilerplate* (menus, headers,
footers, sidebars, notices, adverts, forms, reader comments, by element, role or class word),
*article* (inside ``article`` or ``main``) and *page*.

First pass, on its own, each block becomes good, bad or undecided:
  boilerplate region, or mostly links -> bad; outside the article of a page that has one -> bad;
  dense in stop words and long -> good; long without stop words -> bad (undecided in an article,
  where lists, code and foreign words are content); everything short or in between -> undecided.
Second pass: an undecided block takes the label of the nearest decided blocks of its region
on both sides. If they differ: good when the nearer one is, or when it is a heading before a good
one. If there are none, a block is good; and so are a page's undecided blocks when no block of the page is good.

Inside an article, a ``header`` keeps its headings (the title) and loses the rest, and words of class
names that also name content there (``section-header``, a table's ``toolbar``) mark nothing.

The text is the good blocks in page order, white space folded, joined by one space.

Defined results: null html counts as empty, without text; broken markup (unclosed or stray tags, cut
references, an unclosed comment) is read as far as it goes, in time linear in its length; rows with null ids are kept;
repeated rows get equal results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as _html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from meridian.llm.common import slices

#: Common words of English, French, German and Spanish.
STOP_WORDS = frozenset((
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they "
    "this to was we were which will with you "
    "au aux avec ce ces dans de des du elle en est et eux il ils je la le les leur lui ma mais me même mes moi mon ne nos "
    "notre nous on ou par pas pour qu que qui sa se ses son sur ta te tes toi ton tu un une vos votre vous "
    "aber als am auch auf aus bei bin bis das dass dem den der die ein eine einem einen einer es für hat ich ihr im ist "
    "mit nach nicht noch nur oder sein sich sie sind so um und uns vom von vor war wie wir zu zum zur "
    "al como con del el ella ellos era es esta este fue ha la las lo los más no o para pero por se sin su sus te "
    "todo una unos y ya").split())
#: Class and id words that name boilerplate.
BOILERPLATE_WORDS = frozenset((
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments consent "
    "cookie cookies copyright disclaimer disqus feedback footer form gdpr header hidden login masthead menu modal nav "
    "navbar navigation newsletter notice notices notification pagination popup promo promoted promotion related "
    "reply responses search share sharing sidebar signup skip social sponsor sponsored subscribe tags teaser toolbar "
    "widget").split())
#: Those that mark even an article or main element.
ARTICLE_BOILERPLATE = frozenset("ad ads advert advertisement comment comments promo related reply sponsored teaser".split())
BOILERPLATE_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
BOILERPLATE_TAGS = frozenset("aside button datalist dialog fieldset footer form header input label legend menu nav option select".split())
RAW_TAGS = frozenset("audio canvas head iframe math noembed noframes noscript object script style svg template textarea title video".split())
BLOCK_TAGS = frozenset((
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section select "
    "summary table tbody td tfoot th thead tr ul").split())
#: Left out up to their end tag; without one, only the tag itself is.
MEDIA_TAGS = frozenset("audio canvas head math object svg video".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH = 0.10, 0.25
LINKS = 0.5

_TAG = re.compile(r"<(?:!--(?:.*?-->|.*)|(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
                  r"|(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>|[!?/][^>]*>|[a-zA-Z/!?][^<>]*$)", re.S)
#: What can still be a tag where no ">" follows: a comment without end, or a tag cut by the page's end.
_CUT_TAG = re.compile(r"<(?:!--.*|[a-zA-Z/!?][^<>]*$)", re.S)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_SPLIT = re.compile(r"[^a-z0-9]+")


def _marks(tag: str, attrs: str, inside: bool) -> tuple[bool, bool]:
    """(boilerplate, main) of an element; ``inside`` an article some words mark nothing."""
    bad, main = tag in BOILERPLATE_TAGS, tag in ("article", "main")
    if attrs:
        for m in _ATTR.finditer(attrs):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name == "role":
                bad = bad or value in BOILERPLATE_ROLES
                main = main or value == "main"
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                bad = True
            elif name in ("class", "id") and tag not in ("html", "body"):
                listed = ARTICLE_BOILERPLATE if main or (inside and tag == "table") else BOILERPLATE_WORDS
                for token in value.split():
                    words = set(_SPLIT.split(token))
                    if inside and len(words) > 1:
                        words.discard("header")
                    bad = bad or not listed.isdisjoint(words)
    return bad, main


class _Block:
    __slots__ = ("text", "links", "region", "heading", "label")

    def __init__(self, text, links, region, heading):
        self.text, self.links, self.region, self.heading, self.label = text, links, region, heading, ""


def read_blocks(page: str) -> list[_Block]:
    blocks: list[_Block] = []
    parts: list[str] = []
    links = 0
    stack: list[tuple[str, bool, bool, bool]] = []   # element, boilerplate, main, header of an article
    opened: dict[str, int] = {}                      # elements on the stack
    bad_open = main_open = head_open = 0             # marks on the stack; a header's is not a boilerplate mark
    own = False                                      # the paragraph's own mark
    heading = anchor = False

    def close():
        nonlocal parts, links
        text = " ".join("".join(parts).split())
        if text:
            dropped = own or bad_open or (head_open and not heading)
            blocks.append(_Block(text, links, "boilerplate" if dropped else "article" if main_open else "page", heading))
        parts, links = [], 0

    pos, n, last = 0, len(page), page.rfind(">")
    endless: set[str] = set()                        # raw elements without an end tag from here on
    while pos < n:
        m = (_TAG if pos <= last else _CUT_TAG).search(page, pos)
        piece = page[pos:m.start() if m else n]
        if piece:
            piece = _html.unescape(piece)
            parts.append(piece)
            if anchor:
                links += len(" ".join(piece.split()))
        if not m:
            break
        pos = m.end()
        tag = (m[2] or m[5] or "").lower() if m.re is _TAG else ""
        if not tag:
            continue
        closing, attrs = bool(m[1] or m[4]), m[3] if m[2] else m[6]
        if tag in RAW_TAGS:
            if not closing and not attrs.endswith("/"):
                end = None if tag in endless else re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, pos)
                if end is None:
                    endless.add(tag)
                    if tag in MEDIA_TAGS:            # it parts the words on its sides
                        parts.append(" ")
                pos = end.end() if end else (n if tag not in MEDIA_TAGS else pos)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag == "a":
            anchor = not closing
        if tag in BLOCK_TAGS:
            close()
            own = heading = anchor = False
        if closing:
            if opened.get(tag):
                i = len(stack) - 1
                while stack[i][0] != tag:
                    i -= 1
                if any(x[0] not in BLOCK_TAGS for x in stack[i:]):     # text of an inline element with a mark
                    close()
                for name, bad, main, head in stack[i:]:
                    opened[name] -= 1
                    bad_open, main_open, head_open = bad_open - bad, main_open - main, head_open - head
                del stack[i:]
        elif tag not in VOID_TAGS and not attrs.endswith("/"):
            bad, main = _marks(tag, attrs, main_open > 0)
            if tag == "p":
                own = bad
            elif tag in HEADINGS:
                heading, own = True, bad
            elif tag in BLOCK_TAGS or bad or main:
                if tag not in BLOCK_TAGS:
                    close()
                head = tag == "header" and main_open > 0 and bad_open == 0
                stack.append((tag, bad and not head, main, head))
                opened[tag] = opened.get(tag, 0) + 1
                bad_open, main_open, head_open = bad_open + (bad and not head), main_open + main, head_open + head
    close()
    return blocks


def classify(blocks: list[_Block]) -> None:
    """Set every block's label to ``good`` or ``bad`` (the two passes)."""
    has_article = any(b.region == "article" for b in blocks)
    for b in blocks:
        n = len(b.text)
        words = _WORD.findall(b.text.lower())
        density = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
        if b.region == "boilerplate" or (has_article and b.region == "page") or b.links > LINKS * n:
            b.label = "bad"
        elif n >= LONG and density >= STOP_HIGH:
            b.label = "good"
        elif n >= LONG and density < STOP_LOW and b.region == "page":
            b.label = "bad"
        elif n >= SHORT and density >= STOP_HIGH:
            b.label = "good"
    for region in ("article", "page"):
        part = [b for b in blocks if b.region == region]
        hopeless = region == "page" and not any(b.label == "good" for b in blocks)
        decided = [(b.label, i) if b.label else None for i, b in enumerate(part)]
        before, last = [], None
        for d in decided:
            last = d or last
            before.append(last)
        after, last = [], None
        for d in reversed(decided):
            last = d or last
            after.append(last)
        after.reverse()
        for i, b in enumerate(part):
            if decided[i]:
                continue
            x, y = before[i], after[i]
            if hopeless or (x is None and y is None):
                b.label = "good"
            elif x is None or y is None or x[0] == y[0]:
                b.label = (x or y)[0]
            elif b.heading and y[0] == "good":
                b.label = "good"
            else:
                b.label = x[0] if i - x[1] <= y[1] - i else y[0]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    blocks = read_blocks(page)
    classify(blocks)
    return " ".join(b.text for b in blocks if b.label == "good")


def _extract(schema, text):
    def run(batches):
        for b in slices(batches, text):
            out = [main_text(x) for x in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in schema.names[:-1]), pa.array(out, pa.string())], schema=schema)
    return run


def extract(df: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep``, ``text`` (main text) and ``n_chars`` (its code points) of every page."""
    src = df.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(keep)), F.col(html_col).cast("string").alias("html"))
    kept = src.drop("html").schema
    sch = pa.schema([*((f.name, to_arrow_type(f.dataType)) for f in kept), ("text", pa.string())])
    out = src.mapInArrow(_extract(sch, "html"), kept.add("text", "string"))
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(keep)), "text", F.char_length("text").cast("long").alias("n_chars"))
