"""Main text of web pages by two passes of block rules.

Markup is read once into blocks: runs of text between block-level tags (a single
line break is white space, two are a border). Pass one decides a block from where it
stands and what it holds: blocks in menus, headers, footers, sidebars, forms, notices,
adverts, comments and other page furniture (by tag, or by a whole class, id or role name that
says nothing else; an article or main element below a name of that kind stands for
itself), and blocks outside an article that are mostly links, are
boilerplate. A name or a form is not believed where it holds over ``WRAPPER_SHARE`` of the text and no article
stands elsewhere: such an element is the page's wrapper, and its blocks are decided by what they hold (names
of comments are always believed). Blocks of an article or main element are content, open if mostly links; of
other blocks, long ones dense in stop words, or in ends of sentences of any language, are content, and long ones
with neither boilerplate; from an article on, middling dense ones stay open too. Short and other
middling blocks stay open. Pass two gives each open block the label of its nearest neighbour that is
decided by what it holds; between two different ones at the same distance a heading takes the
following block's label and any other block the preceding one's. On a page with an
article, neighbours are those of articles' text or of one run outside, and a heading above
the first article may take the article's label; without a decided neighbour there, article
text is content and the rest boilerplate. Without an article and without such a neighbour
open blocks are content.

Defined results: null and empty html give an empty text; elements that are hidden (by the attributes hidden and
aria-hidden or by their style) have none; an unfinished comment, script or
tag reaches to the end; text outside any tag is a block; repeated rows give equal
results. Extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import BLOCK_BYTES, arrow_map, blocks

# Fixed values, own choice: tag and attribute words of the rules, and stop words.
RAW = frozenset("script style noscript template iframe svg canvas object video audio title textarea".split())
FURNITURE_TAGS = frozenset("nav footer aside form menu dialog button select option fieldset label head".split())
MAIN_TAGS = frozenset(("article", "main"))
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary table "
    "tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement adbox sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices alert sidebar aside menu menubar nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar "
    "toolbar comment comments reply replies disqus share sharing social related recommended subscribe subscription "
    "newsletter popup modal overlay widget login signup search pagination pager complementary contentinfo responses respond "
    "commentlist onetrust cookiebot".split()
)
# Parts that leave a name of furniture words one: "reader-comments", not "has-sidebar" or "related-work".
QUALIFIERS = frozenset(
    "area bar block body bottom box button buttons container content desktop fixed form global inner item items left link links list "
    "mobile outer page post primary reader right secondary section site sticky text title top user widget wrap wrapper "
    "posts articles stories news sdk thread count policy message inline unit slot google".split()
)
# A name with one of these parts is an advert's, unless another part denies it.
AD_WORDS = frozenset("ad ads advert adverts advertisement sponsored".split())
DENIALS = frozenset("no non not free without has with hide".split())
COMMENT_WORDS = frozenset("comment comments reply replies disqus responses respond commentlist".split())
DOUBTFUL_WORDS = frozenset("header banner".split())  # article text by these alone
# Asides and footers of an article with such a name are part of it.
NOTE_WORDS = frozenset("quote pullquote pull footnote footnotes note notes endnotes references".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
STOP_WORDS = frozenset(
    # English, German, French, Spanish
    "the of and to in is that it was for on are as with his they at be this have from or by not but what all were we when "
    "your can said there use an each which she do how their if will "
    "der die das und ist von zu mit den ein eine nicht sich auf für im dem des auch es an als wie oder aber sind wird bei "
    "le la les un une et est de des du que qui dans en pour pas sur au avec ce il elle ne se par plus ou sont "
    "el los las y del se por con para su al lo como más pero sus este ha una que no".split()
)
LINK_SHARE, SHORT, LONG, DENSE, SPARSE = 0.5, 70, 200, 0.15, 0.05
#: Characters for each end of a sentence at most, and the share of the text that a wrapper holds.
SENTENCE, WRAPPER_SHARE = 300, 0.7
CONTENT, BOILERPLATE, OPEN = 1, 0, -1
# Furniture by a name or a form's tag (may be a wrapper), by a name of comments, by its tag, hidden.
NAMED, FORM, COMMENTS, TAGGED, HIDDEN = 1, 2, 3, 4, 5
PLAIN, LIFTED = 1, 2  # main, or main below a furniture name

_TOKEN = re.compile(r"<!--(?:.*?-->|.*)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|$)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>?|</[^>]*+>?", re.S)
_ATTR = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORD = re.compile(r"[a-z]+")
_LETTERS = re.compile(r"[^\W\d_]+")
_SENTENCE_END = re.compile(r"[.!?…؟।](?=[\s\"'”’»)]|$)|[。！？]")
_QUOTED = re.compile(r"\"[^\"]*\"?|'[^']*'?")
_HIDDEN = re.compile(r"(?<![\w-])hidden(?![\w-])", re.I)
_UNSEEN = re.compile(r"(?<![\w-])(?:style\s*=\s*[\"']?[^\"']*(?:display\s*:\s*none|visibility\s*:\s*hidden)|aria-hidden\s*=\s*[\"']?true)", re.I)


@dataclass
class Block:
    runs: list[str] = field(default_factory=list)
    links: int = 0
    scopes: tuple[int, ...] = ()  # the furniture elements it stands in
    furniture: bool = False
    main: bool = False
    lifted: bool = False
    heading: bool = False
    text: str = ""


def _named(tag: str, attrs: str, in_main: bool) -> int:
    """NAMED or COMMENTS where a whole class, id or role token names furniture, else 0."""
    for kind, value in _ATTR.findall(attrs):
        is_id = kind.lower() == "id"
        if is_id and tag in HEADINGS:
            continue
        for token in value.lower().strip("\"'").split():
            words = _WORD.findall(token)
            known = FURNITURE_WORDS.intersection(words)
            if tag == "header" and in_main:
                known -= {"header"}
            if is_id and in_main and tag == "section":  # ids of sections are anchors
                known &= COMMENT_WORDS
            if in_main and len(words) == 1:
                known -= DOUBTFUL_WORDS
            if AD_WORDS.intersection(words) and not DENIALS.intersection(words):
                return NAMED
            if known and all(w in FURNITURE_WORDS or w in QUALIFIERS for w in words):
                return COMMENTS if known & COMMENT_WORDS else NAMED
    return 0


def _is_note(attrs: str) -> bool:
    return any(NOTE_WORDS.intersection(_WORD.findall(v.lower())) for _, v in _ATTR.findall(attrs))


def _is_hidden(attrs: str) -> bool:
    return bool(_HIDDEN.search(_QUOTED.sub("", attrs)) or _UNSEEN.search(attrs))


def _furniture(tag: str, attrs: str, in_main: bool) -> int:
    """The kind of furniture that an element is, or 0."""
    if "=" in attrs or "idden" in attrs.lower():
        if _is_hidden(attrs):
            return HIDDEN
    if tag in ("form", "fieldset"):
        return FORM
    if tag in FURNITURE_TAGS or (tag == "header" and not in_main):
        return 0 if in_main and tag in ("aside", "footer") and _is_note(attrs) else TAGGED
    if tag in MAIN_TAGS or tag in ("html", "body") or "=" not in attrs:
        return 0
    return _named(tag, attrs, in_main)


def _below(tag: str, attrs: str, above: tuple[str, tuple[int, ...], int], kinds: list[int]) -> tuple[str, tuple[int, ...], int]:
    """tag, furniture elements and main of what stands in an element: main of its own lifts the names above it."""
    _, scopes, main = above
    kind = _furniture(tag, attrs, main > 0)
    if tag in MAIN_TAGS and kind != HIDDEN:
        if scopes and not main and all(kinds[k] == NAMED for k in scopes) and not _named(tag, attrs, False):
            return tag, (), LIFTED
        return tag, scopes, main or PLAIN
    if kind:
        kinds.append(kind)
        scopes = (*scopes, len(kinds) - 1)
    return tag, scopes, main


def read_blocks(page: str) -> list[Block]:
    """The page's non-empty blocks in order."""
    out: list[Block] = []
    kinds: list[int] = []  # of each furniture element
    stack: list[tuple[str, tuple[int, ...], int]] = []  # tag, furniture elements and main below here
    anchors, breaks = 0, 0
    current = Block()

    def border(heading: bool = False) -> None:
        nonlocal current
        if current.runs:
            current.text = " ".join("".join(current.runs).split())
            if current.text:
                out.append(current)
        top = stack[-1] if stack else ("", (), 0)
        current = Block(scopes=top[1], main=top[2] > 0, lifted=top[2] == LIFTED, heading=heading)

    def say(s: str) -> None:
        nonlocal breaks
        if s:
            s = html.unescape(s) if "&" in s else s
            if s.strip():
                breaks = 0
                if anchors:
                    current.links += len("".join(s.split()))
            current.runs.append(s)

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, closing, attrs = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
        if closing:
            if tag == "a":
                anchors = max(0, anchors - 1)
            if tag in VOID_TAGS:
                continue
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    if tag in BLOCK_TAGS or any(f != (stack[k - 1][1] if k else ()) for _, f, _ in stack[k:]):
                        del stack[k:]
                        border()
                    else:
                        del stack[k]
                    break
            else:
                if tag in BLOCK_TAGS:
                    border()
            continue
        if tag in RAW:
            if not attrs.endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
                at = end.end() if end else n
            current.runs.append(" ")
            continue
        if tag == "br":
            breaks += 1
            current.runs.append(" ")
            if breaks >= 2:
                border()
            continue
        if tag == "a":
            anchors += 1
        above = stack[-1] if stack else ("", (), 0)
        below = _below(tag, attrs, above, kinds)
        if tag in VOID_TAGS:
            if tag in BLOCK_TAGS:
                border()
            continue
        if tag in BLOCK_TAGS or below[1] != above[1]:
            if tag == "p" or tag == "li":  # closes an open one of its kind
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        below = _below(tag, attrs, stack[-1] if stack else ("", (), 0), kinds)
                        break
                    if stack[k][0] in BLOCK_TAGS:
                        break
            stack.append(below)
            anchors = 0 if tag in BLOCK_TAGS and tag != "li" else anchors
            border(heading=tag in HEADINGS)
        elif tag not in ("a",):
            stack.append(below)
    border()
    wrappers = _wrappers(out, kinds)
    for b in out:
        b.furniture = any(k not in wrappers for k in b.scopes)
    return out


def _wrappers(found: list[Block], kinds: list[int]) -> set[int]:
    """Names and forms that hold most of the text, where no article stands elsewhere."""
    may = {k for k, kind in enumerate(kinds) if kind in (NAMED, FORM)}
    if not may or any(b.main and not b.scopes for b in found):
        return set()
    held = dict.fromkeys(may, 0)
    total = 0
    for b in found:
        if all(k in may for k in b.scopes):
            total += len(b.text)
            for k in b.scopes:
                held[k] += len(b.text)
    return {k for k, n in held.items() if n > WRAPPER_SHARE * total}


def first_pass(found: list[Block]) -> list[int]:
    """Label of each block, or OPEN."""
    # an article below a furniture name counts where no other stands
    plain = any(b.main and not b.furniture and not b.lifted for b in found)
    for b in found:
        b.main = b.main and not (plain and b.lifted)
    has_main = any(b.main and not b.furniture for b in found)
    labels, seen = [], False
    for b in found:
        size = len(b.text)
        seen = seen or (b.main and not b.furniture)
        linked = b.links > LINK_SHARE * len(b.text.replace(" ", ""))
        if b.furniture or (linked and not b.main):
            labels.append(BOILERPLATE)
        elif b.main:
            labels.append(OPEN if linked and not b.heading else CONTENT)
        elif size < SHORT or b.heading:
            labels.append(OPEN)
        else:
            words = _LETTERS.findall(b.text.lower())
            dense = sum(w in STOP_WORDS for w in words) / max(1, len(words))
            sure = size >= (LONG if has_main and seen else SHORT)
            told = size >= LONG and len(_SENTENCE_END.findall(b.text)) * SENTENCE >= size
            if (dense >= DENSE and sure) or told:
                labels.append(CONTENT)
            else:
                labels.append(BOILERPLATE if size >= LONG and dense < SPARSE else OPEN)
    return labels


def _nearest(found: list[Block], labels: list[int]) -> list[int]:
    """Labels, the open ones from the nearest decided neighbour; all open if there is none."""
    n = len(labels)
    before: list[int] = []
    last = -n - 1
    for k in range(n):
        last = k if labels[k] != OPEN else last
        before.append(last)
    out, ahead = labels[:], 2 * n + 1
    for k in range(n - 1, -1, -1):
        ahead = k if labels[k] != OPEN else ahead
        if labels[k] == OPEN and (ahead < n or before[k] >= 0):
            back, forth = k - before[k], ahead - k
            after = forth < back or (forth == back and found[k].heading)
            out[k] = labels[ahead] if after and ahead < n else labels[before[k]] if before[k] >= 0 else labels[ahead]
    return out


def second_pass(found: list[Block], labels: list[int]) -> list[int]:
    """Open blocks take the label of the nearest decided neighbour, in an article of its text, outside of the run between articles."""
    mains = [k for k, b in enumerate(found) if b.main and not b.furniture]
    out = labels[:]
    if not mains:
        # furniture says nothing about the blocks beside it
        plain = [k for k, b in enumerate(found) if not b.furniture]
        for k, x in zip(plain, _nearest([found[k] for k in plain], [labels[k] for k in plain])):
            out[k] = CONTENT if x == OPEN else x
        return out
    # headings above the first article may be its title
    whole = _nearest(found, labels[: mains[0]] + [CONTENT])
    for k in range(mains[0]):
        if found[k].heading:
            out[k] = whole[k]
    outside = [list(run) for main, run in groupby(range(len(found)), lambda k: found[k].main) if not main]
    for part, default in ((mains, CONTENT), *((run, BOILERPLATE) for run in outside)):
        for k, x in zip(part, _nearest([found[k] for k in part], [out[k] for k in part])):
            out[k] = default if x == OPEN else x
    return out


def main_text(page: str | None) -> str:
    found = read_blocks(page or "")
    labels = second_pass(found, first_pass(found)) if found else []
    return "\n".join(b.text for b, x in zip(found, labels) if x == CONTENT)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html)."""
    src = pages.select("page_id", "url", "html")
    id_type = src.schema["page_id"].dataType.simpleString()

    def run(batches):
        for b in blocks(batches, "html", BLOCK_BYTES):
            texts = [main_text(h) for h in b.column("html").to_pylist()]
            cols = [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["page_id", "url", "text", "n_chars"])

    return arrow_map(src, run, f"page_id {id_type}, url string, text string, n_chars long")
