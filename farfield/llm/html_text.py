"""Main text of HTML pages: streaming parser events, text-to-tag ratios, Gaussian smoothing, threshold clustering."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farfield.llm.common import small_batches

# Fixed values of HTML: elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCK - {"html", "body", "title", "option", "legend", "summary", "td", "th", "tr", "tbody", "thead", "tfoot"}
#: Elements whose content is no running text.
NO_TEXT = frozenset("button datalist embed frameset head iframe input map noframes noscript object optgroup option script select style template textarea title".split())
#: Elements that stand beside an article, those that list links (their ratio tells them, and counts half), and those
#: that may also be around an article.
BESIDE = frozenset("aside dialog footer search".split())
LISTS = frozenset("menu nav".split())
AROUND = frozenset("fieldset form header".split())
#: Words in class, id or role that speak for such content.
MARKS = frozenset(
    "ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer discussion disqus dropdown feedback footer form gdpr header hidden login "
    "menu menubar modal nav navbar navigation newsletter notice notices notification outbrain pager pagination popup popover promo promos promoted promotion recommend recommended related replies reply respond "
    "search share sharing sidebar signup skip social sponsor sponsored sponsors subscribe taboola tags toc toolbar tracking widget".split()
)
#: Words beside which they name a page's layout ("no-sidebar", "overflow-hidden").
LAYOUT = frozenset("has layout no overflow with without".split())
#: Elements that hold a page's article: marks on them name a theme, not what to skip.
HOLDERS = frozenset("html body main article".split())
SIGMA = 1.0
#: Part of the page's typical smoothed ratio (all ratios being logarithms) from which on blocks belong to the content.
THRESHOLD = 1 / 3
#: Part of that threshold which counts for blocks within <article> and <main>.
ARTICLE = 1 / 10
#: What a character within a link counts for.
LINKED = 1 / 10
#: What a mark takes from a block's ratio: a name whose words are all in MARKS ("cookie-notice"), another ("share-buttons"),
#: an element in BESIDE, and one in AROUND.
WHOLE, PART, STRUCTURE, FRAME = 5.0, 2.5, 8.0, 6.0
#: What a block loses beside an <article> or <main> that holds most of the text.
OUTSIDE = 2.5
#: A mark around more than this part of the text of <article> and <main>, or of the page's text, says nothing; of the
#: latter only where this is so many characters, or there is no other text to go by: an article may be one word.
MOST, LEAST = 0.5, 500
SPACE = re.compile(r"\s+")
MARK = re.compile(r"[a-z]+")


@lru_cache(maxsize=4096)
def marks(value: str, block: bool) -> tuple[tuple[str, float], ...]:
    """The marks among the names in a class, id or role, with what each takes from the ratio. Within a line of text
    only those count whose words are all in MARKS."""
    found = []
    for name in value.split():
        words = MARK.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())
        known = sum(w in MARKS for w in words)
        if known and (known == len(words) or (block and LAYOUT.isdisjoint(words))):
            found.append((name.lower(), WHOLE if known == len(words) else PART))
    return tuple(found)


class Blocks(HTMLParser):
    """Collects a page's blocks, in parts where marks change within a line of text: number of the block, text, number
    of tags within, characters within links, whether it is in an article, and the marks around it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[int, str, int, int, bool, tuple]] = []
        self.open: list[tuple[str, bool, tuple]] = []
        self.skipped = self.links = self.articles = self.tags = self.linked = self.number = 0
        self.text: list[str] = []
        self.around: Counter = Counter()

    def cut(self) -> None:
        """Ends a part of a block."""
        if self.text:
            self.blocks.append((self.number, "".join(self.text), self.tags, self.linked, self.articles > 0, tuple(self.around)))
            self.text = []
            self.tags = self.linked = 0

    def flush(self) -> None:
        """Ends a block."""
        self.cut()
        self.number += 1
        self.tags = self.linked = 0

    @staticmethod
    def hidden(tag: str, attrs: list) -> bool:
        if tag in NO_TEXT:
            return True
        if tag in HOLDERS:
            return False
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            if name == "style" and value and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True
        return False

    def marked(self, tag: str, attrs: list) -> tuple:
        if tag in HOLDERS:
            return ()
        found = {m for name, value in attrs if name in ("class", "id", "role") and value for m in marks(value, tag in BLOCK)}
        if tag in BESIDE:
            found.add((f"<{tag}>", STRUCTURE))
        elif tag in LISTS:
            found.add((f"<{tag}>", 0.0))
        elif tag in AROUND and not (tag == "header" and self.articles):  # an article's own header has its title
            found.add((f"<{tag}>", FRAME))
        return tuple(sorted(found))

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK:
            self.flush()
        elif tag == "br":
            self.text.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        if tag in CLOSES_P and self.open and any(o[0] == "p" for o in self.open):
            self.close_to("p", within=True)
        elif tag in ("li", "dd", "dt", "tr", "td", "th", "option") and self.open and self.open[-1][0] == tag:
            self.close_to(tag)
        skip, marked = self.hidden(tag, attrs), self.marked(tag, attrs)
        if marked:
            self.cut()
            self.around.update(marked)
        self.open.append((tag, skip, marked))
        self.skipped += skip
        self.links += tag == "a"
        self.articles += tag in ("article", "main")

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # "/>" closes nothing but void elements

    def close_to(self, tag: str, within: bool = False) -> None:
        """Closes open elements up to the last tag. within: not beyond a block other than it."""
        for i in range(len(self.open) - 1, -1, -1):
            name = self.open[i][0]
            if name == tag:
                break
            if within and name in BLOCK:
                return
            if not within and tag not in BLOCK and name in BLOCK:
                return  # an inline end tag doesn't end the blocks within it
        else:
            return
        while len(self.open) > i:
            name, skip, marked = self.open.pop()
            if marked:
                self.cut()
                self.around.subtract(marked)
                for m in marked:
                    if not self.around[m]:
                        del self.around[m]
            self.skipped -= skip
            self.links -= name == "a"
            self.articles -= name in ("article", "main")

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        self.tags += 1
        self.close_to(tag)

    def handle_data(self, data: str) -> None:
        if not self.skipped:
            self.text.append(data)
            if self.links:
                self.linked += len(data.strip())


def smoothed(ratio: np.ndarray) -> np.ndarray:
    """ratio under a Gaussian of SIGMA blocks."""
    reach = np.arange(-3, 4)
    kernel = np.exp(-(reach**2) / (2 * SIGMA**2))
    return np.convolve(np.pad(ratio, 3, mode="edge"), kernel / kernel.sum(), mode="valid")


def typical(ratio: np.ndarray) -> float:
    """The median of ratio, each block counting by its ratio: many blocks with hardly any text don't lower it, and one
    with very much text counts as a few."""
    ordered = np.sort(ratio)
    held = np.cumsum(ordered)
    return float(ordered[np.searchsorted(held, held[-1] / 2)])


def losses(around: list[tuple], own: np.ndarray, article: np.ndarray) -> np.ndarray:
    """What the marks around each block take from its ratio. own: its characters outside links."""
    if not any(around):
        return np.zeros(len(own))
    inner = own * article
    idle: set = set()
    for counted, least in ((inner, 0), (own, LEAST if inner.any() else 0)):
        held: Counter = Counter()
        for ms, n in zip(around, counted.tolist(), strict=True):
            for m in ms:
                held[m] += n
        idle |= {m for m, n in held.items() if m[1] < STRUCTURE and n > max(MOST * counted.sum(), least)}
    return np.array([sum(m[1] for m in ms if m not in idle) for ms in around], dtype=float)


def main_text(html: str) -> str:
    """The main text of a page: its blocks in page order, joined by newlines; empty where there is none."""
    parser = Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    # what of a block has the same marks is judged together
    parts: dict[tuple, list] = {}
    for number, text, tags, linked, article, around in parser.blocks:
        held = parts.setdefault((number, around), [0, 0, 0, article])
        held[0] += len(SPACE.sub(" ", text).strip())
        held[1] += tags
        held[2] += linked
    parts = {k: v for k, v in parts.items() if v[0]}
    if not parts:
        return ""
    own = np.array([max(0, chars - linked) + LINKED * linked for chars, _, linked, _ in parts.values()])
    article = np.array([v[3] for v in parts.values()])
    # logarithms: one block of any length moves neither its neighbours nor the threshold much
    ratio = np.log1p(own / (1 + np.array([v[1] for v in parts.values()])))
    listed = np.array([any(not m[1] for m in around) for _, around in parts])
    loss = losses([around for _, around in parts], own, article)
    free = (loss == 0) & ~listed
    if (own * free * article).sum() > MOST * (own * free).sum():  # the article is in <article> or <main>
        loss = np.where(free & ~article, OUTSIDE, loss)
    ratio = ratio / (1 + listed)
    plain = (loss == 0) & ~listed
    smooth = smoothed(np.where(plain, ratio, 0))
    threshold = max(THRESHOLD * typical(smooth[plain] if plain.any() else smooth), 1e-9)
    # a cluster of blocks at or above the threshold is content; one with evidence against it has to be it by itself
    content = np.where(plain, smooth, ratio - loss) >= threshold * np.where(article & plain, ARTICLE, 1)
    kept = {k for k, keep in zip(parts, content.tolist(), strict=True) if keep}
    lines: dict[int, list[str]] = {}
    for number, text, _, _, _, around in parser.blocks:
        if (number, around) in kept:
            lines.setdefault(number, []).append(text)
    return "\n".join(SPACE.sub(" ", "".join(texts)).strip() for texts in lines.values())


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars. Null html counts as empty, and gives an empty text; repeated rows
    each give one; an empty table gives an empty result; other columns are ignored. Whole pages are read."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) if h else "" for h in batch.column(2).to_pylist()]
            out = [pa.array(texts, type=pa.string()), pa.array([len(t) for t in texts], type=pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *out], names=["id", "u", "text", "n_chars"])

    small_batches(pages.sparkSession)
    own = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("u"), F.col(html_col).alias("h"))
    return own.mapInArrow(extract, "id long, u string, text string, n_chars long").withColumnsRenamed({"id": id_col, "u": url_col})
