"""Main text of web pages by two-pass block rules: decide clear blocks, then let short ones follow their neighbours."""

from __future__ import annotations

import html
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

# Elements of HTML by what they do to the text.
#: Contents are no text.
SKIPPED = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "embed", "applet", "canvas", "audio", "video", "map", "head", "title", "select", "option", "optgroup", "datalist", "textarea", "button", "input", "label", "form", "fieldset", "legend", "dialog"}
#: Contents are plain characters up to the end tag.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed", "noframes"}
#: Contents are furniture of the page.
FURNITURE = {"nav", "header", "footer", "aside", "menu"}
#: A new block starts and ends here.
BLOCKS = {"address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: Elements without contents.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Start tags that end an open element: the element, and the elements that it is not looked for beyond.
IMPLIED_END = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Words of class, id or role that name furniture, and words that name the article. An underscore ends a word, so that a
#: name of any length is read in linear time.
FURNITURE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:[^\W_]*nav(?:bar|igation)?|[^\W_]*menu[^\W_]*|breadcrumbs?|[^\W_]*foot(?:er)?|side-?bar[^\W_]*|aside|widget[^\W_]*|ad\d*|ads|advert[^\W_]*|adsense|ad-?(?:box|slot|unit)|banner[^\W_]*|sponsor[^\W_]*|promo[^\W_]*|cookie[^\W_]*|consent|gdpr|notice[^\W_]*|alert|popup[^\W_]*|modal[^\W_]*|overlay|newsletter[^\W_]*|subscri[^\W_]*|sign-?up|login|comment(?:s|list|area)?|replies|reply|respond|disqus|discussion|reactions?|share[^\W_]*|sharing|social[^\W_]*|related[^\W_]*|recommend[^\W_]*|more-?(?:stories|posts|articles)|trending|popular|tags?|tag-?cloud|pagination|pager|toolbar|search[^\W_]*|copyright|legal|disclaimer|skip-?link|complementary|contentinfo|alertdialog|form)(?:$|[\s_-])",
    re.I,
)
#: Names of a head: furniture of a page, but the title of an article inside one.
HEAD_NAMES = re.compile(r"(?:^|[\s_-])(?:[^\W_]*header|masthead|topbar)(?:$|[\s_-])", re.I)
#: Parts of names that tell what a wrapper has beside its text.
WRAPPER_NAMES = re.compile(r"(?:^|(?<=\s))(?:has|with|no|is)-\S+", re.I)
ARTICLE_NAMES = re.compile(r"(?:^|[\s_-])(?:article[^\W_]*|post-?(?:body|content|text)?|entry-?(?:content|body|text)?|main-?(?:content|text)?|content-?(?:body|main)?|story[^\W_]*|body-?text)(?:$|[\s_-])", re.I)
#: Function words of the languages of the pages; a text is known by how many of them it has.
STOP_WORDS = set(
    """the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which you were their been has will would
    der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem
    le la les de des et un une du en que qui dans pour pas au sur par plus avec ce il se ne sont est aux ou sa son mais comme nous vous
    el los las y del que por con una su para es al lo como más pero sus ya o este sí porque esta entre cuando muy sin sobre también
    il di che e per non sono con una del da si le dei alla più della nel gli het een van en dat op te zijn met voor niet aan um os do da em com não uma no na se""".split()
)

#: Blocks of fewer words are ambiguous by themselves; of more, they are told by their stop words.
SHORT_WORDS, LONG_WORDS = 8, 25
#: Share of stop words from which a long block is text, and below which it is none; share of words in links that is too much.
MANY_STOPS, FEW_STOPS, MOST_LINKED = 0.2, 0.08, 0.5

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_SPECIAL = re.compile(r"[\"'>]")
#: Numbers of characters that no character has.
_FAR_REFERENCE = re.compile(r"&#0*(?:[1-9][0-9]{8,}|[xX]0*[1-9a-fA-F][0-9a-fA-F]{8,});?")
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_WORD = re.compile(r"\w+")
#: Letters of scripts that are written without spaces; two count as a word.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\U00020000-\U0003ffff]")

TEXT, NONE, UNSURE = 1, 0, -1
#: Why a part is furniture: a name of it, or its element.
BY_NAME, BY_ELEMENT = 1, 2


class Block:
    """A run of text between block tags, with what the rules look at."""

    __slots__ = ("text", "linked", "home", "furniture", "heading", "label")

    def __init__(self, text: str, linked: int, home: int, furniture: bool, heading: bool):
        self.text, self.linked, self.home, self.furniture, self.heading, self.label = text, linked, home, furniture, heading, UNSURE


class Tags:
    """Start and end tags of a page from left to right; comments, declarations and lone `<` are none.

    A tag ends at the first `>` outside quotes. From a tag whose quotes are never closed on, it ends at the next `>`. No
    part of the page is searched twice: where nothing more is to be found is remembered.
    """

    def __init__(self, page: str):
        self.page, self.quoted, self.last = page, True, {c: page.rfind(c) for c in "\"'>"}

    def end_of(self, at: int) -> int:
        """Position of the `>` of a tag whose name ends at `at`; there is one."""
        page, start = self.page, at
        while self.quoted:
            special = _SPECIAL.search(page, at).start()
            c = page[special]
            if c == ">":
                return special
            if self.last[c] == special or self.last[">"] < (close := page.index(c, special + 1)):
                self.quoted = False
            else:
                at = close + 1
        return page.index(">", start)

    def __iter__(self):
        """(where it begins, where it ends, name in lower case, whether it closes, attributes, whether it is empty); name None: to be left out."""
        page, at = self.page, 0
        while (start := page.find("<", at)) >= 0:
            after = page[start + 1 : start + 2]
            if page.startswith("<!--", start) or page.startswith("<![CDATA[", start):
                mark = "-->" if page[start + 2] == "-" else "]]>"
                end = page.find(mark, start + 4)
                end = len(page) if end < 0 else end + 3
                yield start, end, None, False, "", False
            elif start > self.last[">"]:
                at = page.find("<!--", start + 1)
                if at < 0:
                    return
                continue
            elif after in ("!", "?"):
                end = page.index(">", start) + 1
                yield start, end, None, False, "", False
            elif m := _NAME.match(page, start):
                close = self.end_of(m.end())
                end = close + 1
                skip = yield start, end, m[1].lower(), page[start + 1] == "/", page[m.end() : close], page[close - 1] == "/"
                if skip is not None:
                    end = skip
                    yield None
            else:
                at = start + 1
                continue
            at = end


class Stack:
    """Open elements, with where the last one of each name and of each kind is, so that no search walks the stack."""

    def __init__(self):
        self.items: list[tuple[str, bool, int, int]] = []  # name, skipped, furniture, home
        self.of: dict[str, list[int]] = {}

    def push(self, name: str, *state) -> None:
        for kind in self._kinds(name):
            self.of.setdefault(kind, []).append(len(self.items))
        self.items.append((name, *state))

    @staticmethod
    def _kinds(name: str) -> tuple[str, ...]:
        return (name, *(("*block",) if name in BLOCKS else ()), *(("*border",) if name in ("table", "body", "html") else ()))

    def last(self, *names: str) -> int:
        return max((self.of[n][-1] for n in names if self.of.get(n)), default=-1)

    def cut(self, at: int) -> None:
        """Close the element at this place and all within it."""
        while len(self.items) > at:
            for kind in self._kinds(self.items.pop()[0]):
                self.of[kind].pop()

    def state(self) -> tuple[bool, int, int]:
        return self.items[-1][1:] if self.items else (False, 0, 0)


@lru_cache(10_000)
def named(names: str) -> tuple[bool, bool, bool]:
    """Whether class, id or role name furniture, a head, an article."""
    names = WRAPPER_NAMES.sub("", names)
    return bool(names.strip() and FURNITURE_NAMES.search(names)), bool(HEAD_NAMES.search(names)), bool(ARTICLE_NAMES.search(names))


def decoded(raw: str) -> str:
    return html.unescape(_FAR_REFERENCE.sub("\ufffd", raw) if "&#" in raw else raw)


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order. home is the number of the article element that a block is in, 0 outside all.

    Time is linear in the page, however it is broken.
    """
    out: list[Block] = []
    stack = Stack()
    mains: set[int] = set()  # homes that are no article elements
    parts: list[tuple[str, bool]] = []
    skipped = False
    furniture = home = homes = links = 0
    heading = False

    def close() -> None:
        nonlocal heading
        if parts:
            text = " ".join("".join(p for p, _ in parts).split())
            if text:
                out.append(Block(text, sum(len(p.strip()) for p, linked in parts if linked), home, furniture > 0, heading))
            parts.clear()
        heading = False

    def add(raw: str) -> None:
        if raw and not skipped:
            parts.append((decoded(raw), links > 0))

    at = 0
    tags = iter(Tags(page))
    for start, end, name, closing, attributes, empty in tags:
        add(page[at:start])
        at = end
        if name is None:
            continue
        if name in BLOCKS or name in SKIPPED:
            close()
        if closing:
            if name == "a":
                links = max(0, links - 1)
            i = stack.last(name)
            if i >= 0 and (name in ("table", "body", "html") or i > stack.last("*border")):
                stack.cut(i)
        else:
            if name == "a":
                links = 1  # links do not nest
            if name in RAW and not empty:
                stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = stop.end() if stop else len(page)
                tags.send(at)
                continue
            if name in VOID or empty:
                continue
            if name in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "div", "table", "section", "article", "blockquote", "footer", "header", "nav", "aside", "form"):
                i = stack.last("*block")
                if i >= 0 and stack.items[i][0] == "p":
                    stack.cut(i)
            if name in IMPLIED_END:
                ends, limits = IMPLIED_END[name]
                i = stack.last(*ends)
                if i > stack.last(*(limits - ends)):
                    stack.cut(i)
            found = {k.lower(): (v or "").strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)} if attributes else {}
            by_name, by_head, by_article = named(" ".join(found.get(k, "") for k in ("class", "id", "role")))
            hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
            up_skipped, up_furniture, up_home = stack.state()
            structural = name not in ("html", "body", "main", "article")
            is_article = name in ("article", "main") or (name in ("div", "section", "td") and by_article)
            # The header of an article holds its title; of a page, furniture.
            by_name = by_name or (not up_home and by_head)
            own = structural and ((name in FURNITURE and not (name == "header" and up_home)) or by_name)
            if name == "article" and by_name:
                own = True  # comments and teasers come as articles too
            if name == "main" and up_furniture == BY_NAME:
                up_furniture = 0  # a wrapper that is named after a part of it
            if is_article and not own and not up_furniture and (not up_home or (name == "article" and up_home in mains)):
                homes += 1
                up_home = homes
                if name != "article":
                    mains.add(homes)
            stack.push(name, up_skipped or name in SKIPPED or hidden, max(up_furniture, (BY_NAME if by_name and name not in FURNITURE else BY_ELEMENT) if own else 0), up_home)
        skipped, furniture, home = stack.state()
        if not closing and name in ("h1", "h2", "h3", "h4", "h5", "h6"):
            heading = True
    add(page[at:])
    close()
    # An article element within a main part is the text, unless it holds less than the rest of that part.
    inner = sum(len(b.text) for b in out if b.home and b.home not in mains and not b.furniture)
    outer = sum(len(b.text) for b in out if b.home in mains and not b.furniture)
    if inner and 2 * inner >= outer:
        for b in out:
            b.furniture = b.furniture or b.home in mains
    elif inner:
        for b in out:
            b.home = min(b.home, 1)
    return out


def stop_share(block: Block) -> float:
    words = _WORD.findall(block.text.lower())
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def first_pass(block: Block, in_article: bool, known: bool = True) -> int:
    """TEXT, NONE or UNSURE for a block by itself. in_article: the page has an article, and this block is in it; known: some
    block of the page has stop words. Without, the page is in a language that STOP_WORDS lack: length and links decide."""
    if block.furniture:
        return NONE
    words = _WORD.findall(block.text.lower())
    linked = block.linked / max(1, len(block.text))
    if linked > MOST_LINKED:
        return NONE if not in_article or len(words) < SHORT_WORDS else UNSURE
    if not known and not in_article:
        length = len(words) + len(_UNSPACED.findall(block.text)) // 2
        return TEXT if not block.heading and length >= LONG_WORDS and linked < MOST_LINKED / 2 else UNSURE
    if block.heading or len(words) < SHORT_WORDS:
        return UNSURE
    stops = stop_share(block)
    if stops >= MANY_STOPS and (len(words) >= LONG_WORDS or linked < MOST_LINKED / 2):
        return TEXT
    if stops < FEW_STOPS and not in_article:
        return NONE if len(words) >= LONG_WORDS else UNSURE
    return UNSURE if linked > MOST_LINKED / 2 else TEXT if in_article or stops >= FEW_STOPS else UNSURE


def _decided(blocks: list[Block], order: range) -> list[int | None]:
    """For each block, the nearest decided block met before it in that order, in the same article (or outside all)."""
    last: dict[int, int] = {}
    out: list[int | None] = [None] * len(blocks)
    for i in order:
        b = blocks[i]
        out[i] = last.get(b.home)
        if b.label != UNSURE and not (b.furniture and b.home):
            last[b.home] = i
    return out


def inherited(block: Block, i: int, before: int | None, after: int | None, blocks: list[Block], none: int) -> int:
    """The label of an ambiguous block from its nearest decided neighbours; none: the label where there is no such neighbour."""
    near = [j for j in (before, after) if j is not None]
    labels = [blocks[j].label for j in near]
    if block.home:
        return TEXT if not near or TEXT in labels else NONE
    if not near:
        return none
    if block.heading and after is not None:
        return blocks[after].label
    least = min(abs(j - i) for j in near)
    return min(label for j, label in zip(near, labels, strict=True) if abs(j - i) == least)


def extract(page: str | None) -> str:
    """The main text of a page: blocks labelled text, in order, joined by a space."""
    blocks = blocks_of(page or "")
    homes: dict[int, int] = {}
    for b in blocks:
        if b.home and not b.furniture:
            homes[b.home] = homes.get(b.home, 0) + len(b.text)
    article = bool(homes)
    known = any(not b.furniture and stop_share(b) >= FEW_STOPS for b in blocks)
    for b in blocks:
        b.label = first_pass(b, b.home > 0, known)
        if article and not b.home:
            b.label = NONE  # the page says which part is the article
    # Second pass: ambiguous blocks take the label of the nearest decided blocks, of their own article if they are in one.
    before, after = _decided(blocks, range(len(blocks))), _decided(blocks, range(len(blocks) - 1, -1, -1))
    none = NONE if any(b.label != UNSURE for b in blocks) else TEXT
    labels = [b.label if b.label != UNSURE else inherited(b, i, before[i], after[i], blocks, none) for i, b in enumerate(blocks)]
    return " ".join(b.text for b, label in zip(blocks, labels, strict=True) if label == TEXT)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: the main text of every page, from its whole HTML.

    Pass 1 decides blocks by stop-word density, length and link density, and by what the page's own markup says (menus,
    headers, footers, sidebars, notices, adverts, forms and comments are out; with an article element, what is outside it
    is out). Pass 2 gives ambiguous blocks the label of their nearest decided neighbour, in their own article if it has one.
    Character references are decoded, white space within a block is one space, blocks are joined by one space.
    Null or empty HTML gives empty text; malformed HTML is read as browsers do, as far as blocks go, and a page of any length
    and brokenness takes time linear in it and the memory of one page. Blocks at equal distance from a text and a
    non-text neighbour are none. Rows are kept one to one, repeated ones and null ids too; other columns are ignored,
    whatever their names; an empty table gives none.
    """

    def run(batches):
        for batch in slices(batches, "html"):
            texts = [extract(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return p.mapInArrow(run, "page_id long, url string, text string, n_chars long")
