"""Main text of web pages: what a page does not share with its nearest neighbours by URL.

Every page becomes lines: one for each block of text, with what its place in the markup says of
it. Pages of a host are put in the order of their URL paths, where the pages whose paths have
most in common with one's own stand next to it. The lines of two neighbours are aligned by
their longest common subsequence; what both have is the frame that the site puts around
its articles, and goes.

Two things temper this. A page that repeats a neighbour's article is a copy, not a frame: pages
that share four fifths of the text of the shorter one are passed over for the next neighbour. And
where markup is clear it is followed: menus, footers, adverts and the like go although no
neighbour shares them (a menu may differ from page to page), and text that a page itself marks as its
article stays although another page quotes it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.functions.lookups import lookup_join
from proofline.functions.ordered import row_numbers
from proofline.llm import tables
from proofline.llm.cascade import split_url

# neighbours on each side that a page is compared with
REACH = 2
# share of the shorter page's text from which two pages are near copies of each other
COPY = 0.8
# rows of the alignment table that are kept at a time
ALIGNED_ROWS = 256
# pages in order that one group compares, beside those that reach into it
CHUNK = 256

# fixed values: what HTML says of its elements
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = "script style noscript template svg math iframe object textarea title select canvas audio video"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img br nobr".split()
)
FRAME_ELEMENTS = frozenset("nav footer aside form button menu dialog fieldset head".split())
FRAME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
# fixed values: words of class and id names that name parts of a frame
FRAME_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos promotion banner "
    "breadcrumb breadcrumbs comment comments respond reply replies disqus cookie cookies consent gdpr notice notices notification "
    "notifications alert popup modal overlay paywall sidebar sidebars menu menus nav navbar navigation navigator footer foot masthead topbar "
    "header share sharing social related recommended recommendations teaser teasers newsletter subscribe subscription signup "
    "login search searchbox toolbar pagination pager widget widgets copyright skip".split()
)
MAIN_WORDS = frozenset("article main content body text post story entry page prose".split())
WITHOUT = frozenset("has with no without is not show hide".split())
STRONG = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored cookie cookies comment comments sidebar newsletter".split())

# how a line stands: in the frame, in neither, in the main element, in an article
FRAME, PLAIN, MAIN, ARTICLE = range(4)

_NEXT = re.compile(r"<(?:!--|[a-zA-Z/!?])")
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'<]++|"[^"<]*+"|'[^'<]*+')*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']+)))?""")
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in SILENT.split()}


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape("".join(values)))
    return found


def _frames(names: str) -> bool:
    """Does one of these class or id names say that the element is part of a frame?"""
    split = [[w.lower() for w in _NAMES.findall(name)] for name in names.split()]
    if any(len(words) == 1 and words[0] in MAIN_WORDS for words in split):
        return False

    def frame(words: list[str]) -> bool:
        if not words or words[0] in WITHOUT or (words[0] in MAIN_WORDS and words[-1] == "header"):
            return False
        return words[0] in FRAME_WORDS or words[-1] in FRAME_WORDS or not STRONG.isdisjoint(words)

    return any(map(frame, split))


class _Page:
    """The open elements of a page while it is read, and its lines."""

    def __init__(self) -> None:
        # (name, stands in a frame, stands in a main element or article)
        self.open: list[tuple[str, bool, int]] = [("", False, PLAIN)]
        self.count: dict[str, int] = {}
        self.text: list[str] = []
        self.lines: list[tuple[str, int]] = []

    def say(self, text: str) -> None:
        if text:
            self.text.append(html.unescape(text) if "&" in text else text)

    def end_line(self) -> None:
        if self.text:
            line = " ".join("".join(self.text).split())
            if line:
                _, frame, main = self.open[-1]
                self.lines.append((line, FRAME if frame else main))
            self.text = []

    def close_to(self, depth: int) -> None:
        for name, _, _ in self.open[depth:]:
            self.count[name] -= 1
        del self.open[depth:]

    def start(self, name: str, text: str) -> None:
        block = name not in INLINE
        if block:
            self.end_line()
            if name == "body":
                # a head that does not end ends here
                self.close_to(1)
            self._imply(name)
        elif name == "br":
            self.say(" ")
        if name in VOID:
            return
        _, frame, main = self.open[-1]
        now = (frame or name in FRAME_ELEMENTS, main)
        if name == "article":
            now = (now[0], ARTICLE)
        elif name == "main":
            now = (now[0], max(main, MAIN))
        elif name == "header":
            # the heading of an article is its own, that of a page is not
            now = (now[0] or main == PLAIN, main)
        if text.strip(" /\t\r\n"):
            now = self._marked(name, text, *now)
        if now[0] and not frame and not block:
            self.end_line()
        self.open.append((name, *now))
        self.count[name] = self.count.get(name, 0) + 1

    def _marked(self, name: str, text: str, frame: bool, main: int) -> tuple[bool, int]:
        said = _attributes(text)
        role = said.get("role", "").lower()
        if role in FRAME_ROLES or "hidden" in said or said.get("aria-hidden", "").lower() == "true":
            frame = True
        if re.search(r"display\s*:\s*none", said.get("style", "")):
            frame = True
        if role == "main":
            main = max(main, MAIN)
        if role == "article" or "articleBody" in said.get("itemprop", "").split():
            main = ARTICLE
        names = f"{said.get('class', '')} {said.get('id', '')}"
        if names != " " and name not in ("html", "body", "main"):
            if name == "article" or main > PLAIN and name in ("header", "h1", "h2", "h3", "h4", "h5", "h6"):
                frame = frame or bool({"comment", "comments", "reply", "ad", "advert", "teaser"} & {w.lower() for w in _NAMES.findall(names)})
            elif _frames(names):
                frame = True
        return frame, main

    def _imply(self, name: str) -> None:
        """End what this block ends without saying so: an open paragraph, or its like in a list or table."""
        alike = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}.get(name, ())
        for depth in range(len(self.open) - 1, 0, -1):
            at = self.open[depth][0]
            if at in alike:
                self.close_to(depth)
                return
            if at == "p" or at in INLINE:
                if at == "p":
                    self.close_to(depth)
                    if not alike:
                        return
            elif not (alike and at in ("td", "th") and name == "tr"):
                return

    def end(self, name: str) -> None:
        block = name not in INLINE
        if block:
            self.end_line()
        if not self.count.get(name):
            return
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth][0] == name:
                if not block and self.open[depth][1] and not self.open[depth - 1][1]:
                    self.end_line()
                self.close_to(depth)
                return
            if not block and self.open[depth][0] not in INLINE:
                return


def lines_of(source: str) -> list[tuple[str, int]]:
    """The lines of a page in order, references decoded, and how each stands."""
    page, at = _Page(), 0
    while True:
        found = _NEXT.search(source, at)
        if found is None:
            page.say(source[at:])
            break
        page.say(source[at : found.start()])
        at = found.start()
        if source.startswith("<!--", at):
            end = source.find("-->", at + 4)
            at = len(source) if end < 0 else end + 3
            continue
        tag = _TAG.match(source, at) or _LOOSE.match(source, at)
        if tag is None:
            # a comment of another kind, or an end that is missing
            end = source.find(">", at)
            at = len(source) if end < 0 else end + 1
            continue
        at, name = tag.end(), tag[2].lower()
        if tag[1]:
            page.end(name)
        elif name in _ENDS:
            if name not in INLINE:
                page.end_line()
            if not tag[3].endswith("/"):
                end = _ENDS[name].search(source, at)
                at = len(source) if end is None else end.end()
        else:
            page.start(name, tag[3])
    page.end_line()
    return page.lines


def aligned(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Which elements of two sequences are in a longest common subsequence, one of them.

    Equal starts and ends are taken off and elements of one side alone left out. The rest is
    done on rows of bits, of which a part is kept at a time: memory grows with the length.
    """
    left, right = np.zeros(len(a), bool), np.zeros(len(b), bool)
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    left[:start], right[:start] = True, True
    left[len(a) - end :], right[len(b) - end :] = True, True
    both = set(a[start : len(a) - end]) & set(b[start : len(b) - end])
    rows = [i for i in range(start, len(a) - end) if a[i] in both]
    columns = [j for j in range(start, len(b) - end) if b[j] in both]
    if not rows:
        return left, right
    where: dict[int, int] = {}
    for bit, j in enumerate(columns):
        where[b[j]] = where.get(b[j], 0) | (1 << bit)
    full = (1 << len(columns)) - 1

    def after(row: int, value: int) -> int:
        # a zero bit is a column at which the length grows by one
        hit = row & where[value]
        return ((row + hit) | (row - hit)) & full

    kept = [full]
    for number, i in enumerate(rows):
        row = after(kept[-1] if number % ALIGNED_ROWS == 0 else row, a[i])
        if (number + 1) % ALIGNED_ROWS == 0:
            kept.append(row)
    column = len(columns) - 1
    for part in range((len(rows) - 1) // ALIGNED_ROWS, -1, -1):
        own = rows[part * ALIGNED_ROWS : (part + 1) * ALIGNED_ROWS]
        states = [kept[part]]
        for i in own:
            states.append(after(states[-1], a[i]))
        for number in range(len(own) - 1, -1, -1):
            # columns to the left of which nothing grows are in no subsequence of these rows
            grown = ~states[number + 1] & ((1 << (column + 1)) - 1)
            if not grown:
                return left, right
            column = grown.bit_length() - 1
            if (states[number] >> column) & 1:
                left[own[number]] = right[columns[column]] = True
                column -= 1
                if column < 0:
                    return left, right
    return left, right


def _name(line: str) -> int:
    return xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass"))


def _kept(lines: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Lines that can be main text: those of articles if there are any, else of main elements, else outside the frame."""
    best = max((stands for _, stands in lines), default=FRAME)
    return [(line, stands) for line, stands in lines if stands == best and stands != FRAME]


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each page as numbers, and the length and standing of each."""
    for batch in batches:
        names, sizes = [], []
        for source in batch.column("html").to_pylist():
            lines = lines_of(source)
            names.append(np.array([_name(line) for line, _ in lines], np.uint64).astype("<u8").tobytes())
            # the frame's lines have no length: two pages are not copies for a common menu
            sizes.append(np.array([len(line) * (1 if stands != FRAME else 0) + (1 << 40) * stands for line, stands in lines], "<i8").tobytes())
        hosts, paths = zip(*map(split_url, batch.column("url").to_pylist())) if len(batch) else ((), ())
        made = [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(names, pa.binary()), pa.array(sizes, pa.binary())]
        columns = [*(batch.column(c) for c in ("url", "key", "key2")), *made]
        yield pa.RecordBatch.from_arrays(columns, ["url", "key", "key2", "host", "path", "names", "sizes"])


def _compared(chunk: int):
    """(key, key2, shared): for both pages of each pair of neighbours, the plain lines that they share."""
    names = ("chunk", "at", "host", "key", "key2", "names", "sizes")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            found: list[tuple[int, int, bytes]] = []
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                held = [x for x in held if x[0] == row[0] and row[1] - x[1] <= REACH]
                for other in held:
                    # a pair belongs to the chunk of its first page
                    if other[2] == row[2] and other[1] // chunk == other[0]:
                        found += _shared(other, row)
                held.append(row)
            columns = list(zip(*found)) or [(), (), ()]
            types = [pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["key", "key2", "shared"])

    return scan


def _shared(one: tuple, two: tuple) -> Iterator[tuple[int, int, bytes]]:
    sizes = [np.frombuffer(x[6], "<i8") for x in (one, two)]
    both = aligned(*(np.frombuffer(x[5], "<u8").tolist() for x in (one, two)))
    lengths = [x & ((1 << 40) - 1) for x in sizes]
    least = min(int(x.sum()) for x in lengths)
    # copies of one text share it for what it says; their frames are told by other neighbours
    if least and min(int(x[here].sum()) for x, here in zip(lengths, both)) >= COPY * least:
        return
    for page, here, size in zip((one, two), both, sizes):
        plain = here & ((size >> 40) == PLAIN)
        if plain.any():
            yield page[3], page[4], np.packbits(plain).tobytes()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for source, masks in zip(batch.column("html").to_pylist(), batch.column("shared").to_pylist()):
            lines = lines_of(source)
            gone = np.zeros(len(lines), bool)
            for mask in masks or ():
                gone |= np.unpackbits(np.frombuffer(mask, np.uint8), count=len(lines)).astype(bool)
            texts.append("\n\n".join(line for line, _ in _kept([x for x, g in zip(lines, gone) if not g])))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts)], ["page_id", "url", "text"])


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page, blocks apart by an empty line.

    White space in a block is one blank, character references are decoded, and blocks stand in
    the page's order. Text in ``article`` elements (or ``main``, where there are none) is kept
    but for what its markup says to be a menu, form, advert, comment and so on. A page without
    them keeps what is outside such elements and not shared with a neighbour by URL.

    A null html is an empty one and has an empty text. Pages without a host (null URLs and such
    without ``://``) have no neighbours. Rows that repeat page_id, url and html are one page with
    the same result for each; those that share a page_id alone are pages of their own. An empty
    table gives an empty one, and other columns are not read.
    """
    spark = pages.sparkSession
    named = pages.select(
        pages["page_id"].cast("long").alias("page_id"),
        pages["url"].cast("string").alias("url"),
        F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"),
    )
    keys = F.xxhash64("page_id", "url", "html").alias("key"), F.xxhash64("html", "url", "page_id").alias("key2")
    placed = named.select(F.coalesce("url", F.lit("")).alias("url"), *keys, "html")
    lines = placed.mapInArrow(_named, "url string, key long, key2 long, host string, path string, names binary, sizes binary")
    # only where a line is plain can a neighbour change anything, but every page is a neighbour
    lines = tables.stored(lines.where("host <> ''"), "lines")
    once = lines.dropDuplicates(["key", "key2"])
    ordered = row_numbers(once, ["host", "path", "url", "key", "key2"], "at")
    chunk = F.expr(f"at div {CHUNK}")
    # the first pages of a chunk are neighbours of the last ones of the chunk before
    chunks = F.when((F.col("at") % CHUNK < REACH) & (F.col("at") >= CHUNK), F.array(chunk, chunk - 1)).otherwise(F.array(chunk))
    dealt = ordered.select(F.explode(chunks).alias("chunk"), "at", "host", "key", "key2", "names", "sizes")
    compared = dealt.repartition("chunk").sortWithinPartitions("chunk", "at").mapInArrow(_compared(CHUNK), "key long, key2 long, shared binary")
    shared = tables.stored(compared.groupBy("key", "key2").agg(F.collect_list("shared").alias("shared")), "shared")
    found = lookup_join(named.select("page_id", "url", "html", *keys), shared, ["key", "key2"])
    texts = found.select("page_id", "url", "html", "shared").mapInArrow(_texts, "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
