"""Main text of web pages by two-pass block rules.

The page is cut into blocks at block-level tags. The first pass decides a block by its length, its
density of stop words and the share of its characters inside links: long blocks with many stop words
and few links are good. In scripts and languages without a list of stop words, sentence ends take their
place. Short blocks that no rule decides inherit, in the second pass, the label of the nearest decided
neighbour of the same container; ties and containers without one go to the prior.

Containers give priors. Blocks of navigation, footers, asides and hidden parts are bad. So are those of
forms and of containers whose class or id says advertising, comments and the like, unless no prose is left
then: the container that holds most prose of its own is then no boilerplate, nor are its siblings of equal
attributes and those around it (a page wrapped in one form, or in boxes named ad-free-comments). Weaker words, as
share, related, widget or legal, mark a container only if its name holds none but such words and neutral ones, and it
is not mostly prose with few links. Paragraphs and headings are not marked by their class. Where an article or main
element stands, its blocks need less to be good and what stands outside is bad (a headline before it as well), unless
the prose outside is more than OUTSIDE times as long as all that is inside, as beside a teaser; then all are judged
alike. A page without a good block gives its short text outside of boilerplate. Comments of readers in
an article of their own, without a mark, cannot be told from a second article, and stay.

Tags are read as browsers do: a quote opens a value only behind an equals sign and runs to its next
occurrence; one that never closes is an ordinary character. A slash at a tag's end closes nothing outside
drawings and formulas. Comments, scripts and tags that don't end swallow the rest of the page.

Null html counts as empty; an empty page, or one without a good block, has text "", an empty table no
rows. A null url stays null. Rows are treated one by one, so repeats do not matter; other input columns
are not read, so none clashes. Time grows in proportion to a page's length, however deep it nests.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Elements that start and end blocks.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav ol option p pre section select summary "
    "table tbody td textarea tfoot th thead title tr ul video audio canvas object".split()
)
# Elements whose content is not text of the page, and elements without content.
DROPPED = frozenset("script style noscript template svg math iframe object canvas audio video head title select textarea button noembed noframes".split())
RAW = frozenset("script style title textarea noembed noframes iframe xmp".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Containers that hold no main text; words of class, id and role that say so, as a form does.
BOILERPLATE = frozenset("nav footer header aside menu dialog".split())
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|nav|navbar|navigation|menus?|breadcrumbs?|sidebars?|side-bar|footers?|"
    r"site-header|masthead|cookies?|consent|gdpr|newsletter|subscribe|subscription|signup|login|comments?|comment-list|discussion|disqus|replies|reply|"
    r"respond|reader-comments|popup|modal|pagination|pager|toolbar)(?:$|[\s_-])",
    re.I,
)
#: Words that say it only if a name holds none but these and NEUTRAL ones: a share price or an elementor widget is neither.
WEAK = frozenset(
    "promo promos promotion promotions banner banners page-header notice notices share sharing social related recommended recommendations widget widgets "
    "overlay search form copyright legal disclaimer hidden".split()
)
NEUTRAL = frozenset("box bar list links link button buttons icon icons container wrapper wrap block area section inner outer header top bottom left right site page item items group panel media input field".split())
#: Elements whose class or id is looked at: those that hold others. A paragraph or a heading is text whatever its class.
CONTAINERS = frozenset("div section ul ol dl table tbody td tr form fieldset details header figure iframe center dir span li a".split())
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
# Function words of the languages of the pages.
STOP_WORDS = frozenset(
    "the be to of and a in that have it for not on with as you this but by from is are was were or an at he "
    "le la les de des et un une en que qui est du dans pour pas sur au aux avec ce "
    "der die das und den zu von mit ist ein eine nicht auf für im dem des sich auch "
    "el los las y del por con para se no su al lo como más o".split()
)

TOKEN = re.compile(r"<!--|<!\[CDATA\[|<[!?]|<(/?)([a-zA-Z][^\s/>]*)|[^<]+|<")
STOP = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"""(?:^|[\s/"'])(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
#: Ends of sentences; those of scripts without spaces need none behind them.
SENTENCE = re.compile(r"""[.!?…؟।][\s"'»”)\]]|[.!?…؟।]\Z|[。！？｡]""")

#: Characters from which a block of prose is long, and up to which it is short.
LONG, SHORT = 200, 70
MOST_LINKS, MANY_STOPS, SOME_STOPS = 0.33, 0.30, 0.10
#: Characters of a sentence at most, on average, where sentence ends stand for stop words.
SENTENCE_CHARS = 300
#: Prose outside an article, in lengths of what is inside, from which the article is a part of the page only; with
#: 1 / OUTSIDE of its prose in other text outside, a marked container stays boilerplate.
OUTSIDE = 2

GOOD, BAD, SHORT_BLOCK = 1, -1, 0
#: How a container is marked: by weak words, by its class or id or as a form, or for certain.
SLIGHT, SOFT, HARD = 1, 2, 3


def _weak(value: str) -> bool:
    """Whether one of the names consists of weak and neutral words, with a weak one."""
    for name in value.lower().split():
        parts = [p for p in re.split(r"[_-]", name) if p and not p.isdigit()]
        if (name in WEAK or any(p in WEAK for p in parts)) and (name in WEAK or all(p in WEAK or p in NEUTRAL for p in parts)):
            return True
    return False


def _marked(attributes: str, container: bool) -> int:
    mark = 0
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "role" and value.lower() in ROLES or name == "style" and UNSEEN.search(value):
            return HARD
        if name in ("class", "id") and container:
            mark = max(mark, SOFT if MARKED.search(value) else SLIGHT if _weak(value) else 0)
    return mark


@dataclass(frozen=True, slots=True)
class Block:
    text: str
    #: Characters inside links.
    linked: int
    #: Number of the outermost article or main around it, or 0.
    area: int
    #: Whether it stands in boilerplate, and the number of the innermost softly marked container, or 0.
    hard: bool
    soft: int
    #: Whether it is an item of a list.
    item: bool


@dataclass(frozen=True, slots=True)
class Box:
    """A marked container: the number of the one around it, its mark, and its attributes."""

    around: int
    mark: int
    attributes: str


def _tags_end(page: str) -> Callable[[int], int]:
    """A function from a place inside a tag to the place of its ">" (or the page's end)."""
    last = {q: page.rfind(q) for q in "\"'"}

    def end(at: int) -> int:
        i = at
        while m := STOP.search(page, i):
            quote, i = m[0], m.end()
            if quote == ">":
                return m.start()
            k = m.start() - 1
            while k >= at and page[k] in " \t\n\f\r":
                k -= 1
            if k >= at and page[k] == "=" and last[quote] >= i:
                i = page.index(quote, i) + 1
        return len(page)

    return end


def blocks(page: str) -> tuple[list[Block], list[Box]]:
    """All blocks with text, and the containers that are marked but not for certain; the first of them stands for none."""
    out: list[Block] = []
    boxes = [Box(0, 0, "")]
    parts: list[str] = []
    linked = 0
    #: Open elements: name, whether its content is dropped, hard, soft, area; and how many of each name are open.
    bottom = ("", False, False, 0, 0)
    stack = [bottom]
    count: Counter[str] = Counter()
    articles = 0
    lower = None
    tag_end = _tags_end(page)

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                _, _, hard, soft, area = stack[-1]
                out.append(Block(text, linked, area, hard, soft, count["li"] > 0))
            parts.clear()
        linked = 0

    def pop() -> str:
        name = stack.pop()[0]
        count[name] -= 1
        return name

    at, size = 0, len(page)
    while at < size:
        m = TOKEN.match(page, at)
        piece, name, at = m[0], m[2], m.end()
        if name is None:
            if piece == "<!--":
                end = page.find("-->", m.start() + 2)
                at = end + 3 if end >= 0 else size
            elif piece == "<![CDATA[":
                end = page.find("]]>", at)
                at = end + 3 if end >= 0 else size
            elif piece in ("<!", "<?"):
                end = page.find(">", at)
                at = end + 1 if end >= 0 else size
            elif not stack[-1][1]:
                parts.append(piece)
                if count["a"]:
                    linked += len(piece.strip())
            continue
        name = name.lower()
        end = tag_end(at)
        attributes, at = page[at:end], min(end + 1, size)
        if m[1]:
            if name in BLOCKS:
                close()
            if count[name]:
                if name in BLOCKS or name in DROPPED:
                    while pop() != name:
                        pass
                elif stack[-1][0] == name or name == "a":
                    k = len(stack) - 1
                    while stack[k][0] != name:
                        k -= 1
                    del stack[k]
                    count[name] -= 1
            continue
        if name in BLOCKS:
            close()
            if stack[-1][0] == "p" and name not in EMPTY:
                pop()
        if name in EMPTY:
            continue
        if attributes.endswith("/") and (name in ("svg", "math") or count["svg"] or count["math"]):
            continue
        mark = _marked(attributes, name in CONTAINERS) if attributes and name not in ("body", "html", "article", "main") else 0
        if not mark and name not in BLOCKS and name not in DROPPED and name != "a":
            continue
        _, dropped, hard, soft, area = stack[-1]
        if name in BOILERPLATE and not (name == "header" and area) or name == "article" and area and count["article"]:
            mark = HARD
        elif name == "form":
            mark = max(mark, SOFT)
        if mark:
            close()
        if mark in (SLIGHT, SOFT):
            boxes.append(Box(soft, mark, attributes.strip()))
            soft = len(boxes) - 1
        if name in ("article", "main") and not area:
            articles += 1
            area = articles
        stack.append((name, dropped or name in DROPPED, hard or mark == HARD, soft, area))
        count[name] += 1
        if name in RAW:
            if lower is None:
                lower = page.lower()
                if len(lower) != size:
                    lower = re.sub("[A-Z]+", lambda x: x[0].lower(), page)
            end = lower.find(f"</{name}", at)
            end = end if end >= 0 else size
            if not stack[-1][1]:
                parts.append(page[at:end])
            at = end
    close()
    return out, boxes


def _reads(text: str) -> bool:
    """Whether a text has the sentence ends of prose: for languages without stop words here."""
    ends = len(SENTENCE.findall(text))
    if not ends or len(text) > SENTENCE_CHARS * ends:
        return False
    letters = [c for c in text if c.isalpha()]
    other = sum(c > "\u024f" for c in letters)  # beyond the Latin letters
    return 2 * other > len(letters) or len(text.split()) >= FEW_WORDS


#: Words of a sentence at least, in a language without stop words here.
FEW_WORDS = 8
#: A line on rights, not a text that mentions them.
RIGHTS = re.compile(r"^\W*(?:©|\(c\)|copyright\b)|all rights reserved", re.I)


def first_pass(text: str, linked: int, prior: int, item: bool = False) -> int:
    """GOOD, BAD or SHORT_BLOCK, from the block alone and its container's prior."""
    if prior == BAD:
        return BAD
    size = len(text)
    density = linked / size
    if density > MOST_LINKS and (prior != GOOD or density > 0.8 and item):
        return BAD
    if size <= SHORT:
        return SHORT_BLOCK
    words = text.lower().split()
    stops = sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) / len(words)
    if prior == GOOD:
        return GOOD if stops >= SOME_STOPS or size >= LONG or _reads(text) else SHORT_BLOCK
    if size <= LONG and RIGHTS.search(text):
        return BAD
    if stops >= MANY_STOPS:
        return GOOD
    if stops >= SOME_STOPS:
        return GOOD if size >= LONG else SHORT_BLOCK
    return GOOD if _reads(text) else SHORT_BLOCK if item else BAD


def second_pass(labels: list[int], groups: list[int], priors: list[int]) -> list[bool]:
    """Undecided blocks take the label of the nearest decided neighbour of their container."""
    n = len(labels)
    near: list[list[tuple[int, int]]] = [[] for _ in labels]
    for order in (range(n), range(n - 1, -1, -1)):
        seen: dict[int, int] = {}
        for i in order:
            if priors[i] == BAD:
                continue
            if labels[i] != SHORT_BLOCK:
                seen[groups[i]] = i
            elif groups[i] in seen:
                k = seen[groups[i]]
                near[i].append((abs(i - k), labels[k]))
    out = []
    for i, label in enumerate(labels):
        if label == SHORT_BLOCK:
            close = min((d for d, _ in near[i]), default=0)
            said = {x for d, x in near[i] if d == close}
            label = said.pop() if len(said) == 1 else priors[i] or BAD
        out.append(label == GOOD)
    return out


def _no_boilerplate(found: list[Block], boxes: list[Box]) -> set[int]:
    """Marked containers that are no boilerplate after all.

    A slight mark counts only if the container holds no prose with few links. Of the others, none if there is an article,
    prose or as much other text outside of all of them; else the one with most prose of its own among the outermost that
    have any, its siblings with the same attributes, and those around it.
    """
    size, linked, prose_in = [0] * len(boxes), [0] * len(boxes), [0] * len(boxes)
    prose: Counter[int] = Counter()
    other, outside = 0, False
    for b in found:
        if b.hard:
            continue
        label = first_pass(b.text, b.linked, 0)
        size[b.soft] += len(b.text)
        linked[b.soft] += b.linked
        prose_in[b.soft] += len(b.text) if label == GOOD else 0
        outside |= bool(b.area and not b.soft)
        if label == GOOD:
            prose[b.soft] += len(b.text)
        elif label != BAD and not b.soft:
            other += len(b.text)
    for k in range(len(boxes) - 1, 0, -1):  # inner ones come later
        for sums in (size, linked, prose_in):
            sums[boxes[k].around] += sums[k]
    # As a share of its text, the prose of a form with labels and a notice is small, that of a section about related work is not.
    out = {k for k in range(1, len(boxes)) if boxes[k].mark == SLIGHT and 2 * prose_in[k] > size[k] and linked[k] <= MOST_LINKS * size[k]}
    for k in sorted(out & {*prose}, reverse=True):  # their prose is that of the container around
        up = boxes[k].around
        while up in out:
            up = boxes[up].around
        prose[up] += prose.pop(k)
    if outside or not prose or 0 in prose:
        return out
    depth = [0] * len(boxes)
    for k in range(1, len(boxes)):
        depth[k] = depth[boxes[k].around] + 1
    k = min(prose, key=lambda x: (depth[x], -prose[x], x))
    if OUTSIDE * other >= prose[k]:
        return out
    out |= {x for x in range(1, len(boxes)) if boxes[x] == boxes[k]}
    while k:
        out.add(k)
        k = boxes[k].around
    return out


def main_text(page: str | None) -> str:
    found, boxes = blocks(page or "")
    lifted = _no_boilerplate(found, boxes)
    soft = [False] * len(boxes)
    for k in range(1, len(boxes)):
        soft[k] = soft[boxes[k].around] or k not in lifted
    bad = [b.hard or soft[b.soft] for b in found]
    inside = sum(len(b.text) for b, x in zip(found, bad) if b.area and not x)
    outside = sum(len(b.text) for b, x in zip(found, bad) if not b.area and not x and first_pass(b.text, b.linked, 0) == GOOD) if inside else 0
    if inside and outside <= OUTSIDE * inside:  # an article's page: what stands outside is not its text
        priors = [GOOD if b.area and not x else BAD for b, x in zip(found, bad)]
    else:
        priors = [BAD if x else 0 for x in bad]
    labels = [first_pass(b.text, b.linked, p, b.item) for b, p in zip(found, priors)]
    keep = second_pass(labels, [b.area for b in found], priors)
    if not any(keep):  # a page of short text only
        keep = [p != BAD and b.linked <= MOST_LINKS * len(b.text) and not RIGHTS.search(b.text) for b, p in zip(found, priors)]
    return " ".join(b.text for b, good in zip(found, keep) if good)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """key, url, text and n_chars of every page. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(p) for p in b.column(2).to_pylist()]
            cols = [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=[key, url, "text", "n_chars"])

    kinds = dict(pages.dtypes)
    return pages.select(F.col(key), F.col(url), F.col(html)).mapInArrow(run, f"`{key}` {kinds[key]}, `{url}` {kinds[url]}, text string, n_chars bigint")


def op10(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
