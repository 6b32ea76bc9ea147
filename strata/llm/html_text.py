"""HTML extraction by two passes of block rules.

A page is cut into blocks at block-level tags; what can hold no main text (scripts, forms,
navigation, elements that name themselves as adverts, comments and the like, hidden ones) makes
no blocks. The first pass classifies each block by its share of link characters, its length
and its share of stop words: main text, boilerplate, or undecided where it is short or between
the bounds. In the second pass an undecided block takes the label of the nearest decided one, a
heading that of the next decided one. Inside an ``article`` (or ``main``, where a page has no
article) length and links decide alone, only neighbours of the same kind of container count,
and undecided blocks stay where none is decided to be main text; where it yields any, blocks
outside of it are not taken.

Cases: null and empty html give an empty text; markup that is cut off ends what is open. White
space is what ``str.split`` takes for it, no-break spaces included; ``br`` is white space.
Character references follow HTML5. Repeated rows, null ids and null urls give a row each;
columns other than the named ones are ignored. An empty table gives an empty result. A task
holds about ``AT_ONCE`` bytes of pages and at least one page; time is linear in its length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.batches import bound_batches, parts

AT_ONCE = 4 << 20
# Characters below which a block is short, and from which it can be decided by stop words.
SHORT, LONG = 70, 140
# Shares: of characters in links, outside and inside a container; of stop words among words,
# from which a block may be and is main text.
LINKS, INNER_LINKS, FEW_STOPS, MANY_STOPS = 0.2, 0.5, 0.15, 0.25
GOOD, BAD, OPEN = 1, 0, -1

# Frequent function words of the languages that are told from boilerplate.
STOP_WORDS = frozenset(
    # English
    "the of and to in a is that for it as was with be by on not he his but at are this have "
    "from or had an they which you were her she their we been has will would there what if "
    # German
    "der die das und ist ein eine einen dem den des im von zu mit sich auf für nicht als auch es "
    "an werden aus er hat dass sie nach wird bei noch wie über so sind war oder "
    # French
    "le la les de du un une et est que qui dans en pour pas au aux sur se ne ce il elle par avec "
    "plus son sont ont mais ou été cette "
    # Spanish
    "el los las del y que se por con para una su al lo como más pero sus este ha sí porque esta "
    "entre cuando muy sin sobre también fue".split()
)
# Elements of HTML by the role they have here.
DROPPED = frozenset(
    "head script style noscript template iframe object svg math canvas audio video map form "
    "button select textarea input label fieldset dialog menu nav aside footer".split()
)
RAW = frozenset("script style title textarea xmp noframes noembed iframe".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | DROPPED | frozenset(
    "address article blockquote body caption center dd details dir div dl dt fieldset figcaption "
    "figure header hgroup hr html legend li main ol optgroup option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
# An opening tag ends an open element of these kinds: itself, or what may not hold it.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"),
        "td": ("td", "th"), "th": ("td", "th")}
# Elements beyond which no element is ended that way.
SCOPES = frozenset(
    "ul ol dl table div section article main body blockquote figure details header".split()
) | DROPPED
# Words in class, id and role that mark boilerplate; those after the bar also as a prefix.
MARKS = frozenset(
    "ad ads nav menu share sharing social related notice alert banner login signup subscribe "
    "toolbar pager pagination consent gdpr modal overlay reply replies respond widget toc popup "
    "masthead dialog navigation contentinfo complementary search skip".split()
)
MARK_STARTS = ("advert", "comment", "cookie", "sidebar", "sponsor", "promo", "newsletter",
               "breadcrumb", "footer", "navbar", "disqus", "recommend", "teaser", "copyright")
# Words beside a mark that say that the element holds more than it, as in "with-sidebar".
WHOLE = frozenset("content main article post entry body page has with no without wrapper".split())

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^<>]*+>"
    r"|<(/?)([a-zA-Z][^\s/<>]*+)((?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^<>])*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_MARK_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    """Text of a block, what the first pass looks at, and the containers it stands in."""

    text: str
    link_share: float
    stop_share: float
    heading: bool
    in_article: bool
    in_main: bool


def _attributes(text: str) -> dict[str, str]:
    found = {}
    for name, value in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), value.strip("\"'"))
    return found


def _is_boilerplate(name: str, attributes: dict[str, str], in_container: bool) -> bool:
    """Whether an element is boilerplate by its name or by what it says about itself."""
    if name in DROPPED or (name == "header" and not in_container):
        return True
    if name in ("html", "body", "main") or not attributes:
        return False
    style = attributes.get("style", "").replace(" ", "").lower()
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in style:
        return True
    for key in ("role", "id", "class"):
        for part in attributes.get(key, "").split():
            words = [w.lower() for w in _MARK_WORD.findall(part)]
            if not WHOLE.isdisjoint(words):
                continue
            marked = not MARKS.isdisjoint(words) or any(w.startswith(MARK_STARTS) for w in words)
            if marked or (not in_container and "header" in words):
                return True
    return False


class _Reader:
    """Reads one page from tag to tag and gathers its blocks."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.stack: list[tuple[str, bool]] = []
        self.open: Counter[str] = Counter()
        self.dropped = 0
        self.parts: list[str] = []
        self.linked = 0
        self.in_link = self.heading = False

    def text(self, text: str) -> None:
        if self.dropped or not text:
            return
        if "&" in text:
            text = unescape(text)
        self.parts.append(text)
        if self.in_link:
            self.linked += len("".join(text.split()))

    def end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            words = _WORD.findall(text.lower())
            stops = sum(word in STOP_WORDS for word in words)
            self.blocks.append(Block(
                text, self.linked / max(len(text) - text.count(" "), 1), stops / max(len(words), 1),
                self.heading, self.open["article"] > 0, self.open["main"] > 0,
            ))
        self.parts, self.linked, self.heading = [], 0, False

    def close(self, name: str) -> None:
        if not self.open[name]:
            return
        while self.stack:
            top, boilerplate = self.stack.pop()
            self.open[top] -= 1
            self.dropped -= boilerplate
            if top == name:
                break

    def end_implied(self, name: str) -> None:
        for other in ("p", *ENDS.get(name, ())):
            for top, _ in reversed(self.stack):
                if top == other:
                    self.close(other)
                if top == other or top in SCOPES:
                    break

    def start(self, name: str, attribute_text: str) -> None:
        if name == "a":
            self.in_link = True
        elif name == "br":
            self.text(" ")
        if name in BLOCKS:
            self.end_block()
            self.end_implied(name)
            self.heading = name in HEADINGS
        if name in VOID:
            return
        inside = self.open["article"] + self.open["main"] > 0
        boilerplate = _is_boilerplate(name, _attributes(attribute_text), inside)
        if name in BLOCKS or boilerplate:
            self.stack.append((name, boilerplate))
            self.open[name] += 1
            self.dropped += boilerplate

    def end(self, name: str) -> None:
        if name == "a":
            self.in_link = False
        if name in BLOCKS:
            self.end_block()
        self.close(name)


def page_blocks(html: str) -> list[Block]:
    """The blocks of a page that are not boilerplate by their elements, in page order."""
    last = html.rfind("<")
    if last >= 0 and html.find(">", last) < 0 and re.match(r"<[a-zA-Z/!?]", html[last : last + 2]):
        html = html[:last]  # a tag that the page ends in
    reader, at = _Reader(), 0
    while found := _TOKEN.search(html, at):
        reader.text(html[at : found.start()])
        at, name = found.end(), (found[2] or "").lower()
        if found[1]:
            reader.end(name)
        elif name:
            reader.start(name, found[3])
            if name in RAW:
                closed = re.compile(f"</{name}(?=[\\s/>])", re.I).search(html, at)
                at = closed.start() if closed else len(html)
    reader.text(html[at:])
    reader.end_block()
    return reader.blocks


def first_pass(block: Block, inside: bool) -> int:
    """GOOD, BAD or OPEN by link density, length and stop-word density of the block alone."""
    length = len(block.text)
    if inside:
        if block.link_share > INNER_LINKS and not block.heading:
            return BAD
        return OPEN if length < SHORT or block.heading else GOOD
    if block.link_share > LINKS:
        return BAD
    if length < SHORT or block.heading:
        return OPEN
    if block.stop_share >= MANY_STOPS and length >= LONG:
        return GOOD
    return OPEN if block.stop_share >= FEW_STOPS else BAD


def second_pass(labels: list[int], headings: list[bool], default: int) -> list[int]:
    """Open labels replaced by that of the nearest decided block, BAD where two are as near."""
    n = len(labels)
    before: list[tuple[int, int]] = []
    place, label = -1, OPEN
    for i in range(n):
        if labels[i] != OPEN:
            place, label = i, labels[i]
        before.append((i - place, label))
    result = list(labels)
    place, label = n, OPEN
    for i in reversed(range(n)):
        if labels[i] != OPEN:
            place, label = i, labels[i]
            continue
        back, earlier = before[i]
        ahead = place - i
        if earlier == OPEN and label == OPEN:
            result[i] = default
        elif earlier == OPEN or (label != OPEN and headings[i]):
            result[i] = label
        elif label == OPEN or back < ahead:
            result[i] = earlier
        else:
            result[i] = label if ahead < back else min(label, earlier)
    return result


def kept_blocks(blocks: list[Block]) -> list[Block]:
    """Blocks of the main text: of the container where that yields any, else of the page."""
    articles = any(b.in_article for b in blocks)
    for inside in (True, False):
        chosen = [b for b in blocks if (b.in_article if articles else b.in_main) == inside]
        labels = [first_pass(b, inside) for b in chosen]
        if inside and GOOD not in labels:
            labels = [GOOD if label == OPEN else label for label in labels]
        labels = second_pass(labels, [b.heading for b in chosen], BAD)
        kept = [b for b, label in zip(chosen, labels, strict=True) if label == GOOD]
        if kept:
            return kept
    return []


def extract_text(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """One row per page: id, url, text, n_chars, n_blocks and n_kept (blocks of the text)."""
    bound_batches(pages.sparkSession)
    rows = pages.select(
        F.col(id_column).alias("_id"), F.col(url_column).alias("_url"), F.col(html_column).alias("_html")
    )
    fields = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "_html", AT_ONCE):
            texts, numbers, kept_numbers = [], [], []
            for html in batch.column("_html"):
                blocks = page_blocks(html.as_py() or "")
                kept = kept_blocks(blocks)
                texts.append("\n".join(b.text for b in kept))
                numbers.append(len(blocks))
                kept_numbers.append(len(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_url"), pa.array(texts, pa.string()),
                 pa.array(numbers, pa.int64()), pa.array(kept_numbers, pa.int64())],
                names=["_id", "_url", "_text", "n_blocks", "n_kept"],
            )

    return rows.mapInArrow(
        run, f"_id {fields['_id']}, _url {fields['_url']}, _text string, n_blocks long, n_kept long"
    ).select(
        F.col("_id").alias(id_column), F.col("_url").alias(url_column), F.col("_text").alias("text"),
        F.length("_text").cast("long").alias("n_chars"), "n_blocks", "n_kept",
    )
