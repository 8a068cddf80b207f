"""Main text of web pages: structure, and runs that a host repeats.

A page is read into blocks of white-space-normal text, in page order, each in a *zone*:

* ``chrome``: menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments, by
  element, role, class and id;
* ``article``: inside an article or main element, or what class names mark as one;
* ``plain``: the rest.

A class name or id is read as a whole: its words must all be chrome's or say nothing, and none may make it a statement ("no-sidebar"). An element
that is chrome by such a name, or a form, is not if it holds most of the text around it, and one named after links is not
if it holds prose. Pages are read once from left to right, in time proportional to their length.

A page that marks its article is that zone. Where nothing is marked, what repeats is told from what is
the page's own by suffix arrays of the host's token streams: the suffixes of all chrome and plain
tokens of a host's pages are grouped by their first ``depth`` tokens, which is what neighbours in the sorted array
share; a group that occurs on ``share`` of the host's distinct pages, and on two at least, is a repeated run, and the plain
tokens that such runs cover go, no others. Blocks of fewer tokens are compared as a whole. If all of a page's plain text would
go, as on a mirrored page, it stays.

From a marked article go blocks that ``share`` of the host's distinct articles have, and ``many`` at least: blocks of ``depth``
tokens as a whole, shorter ones where runs over neighbouring short blocks cover them. If half of the article's tokens or more would
go, as from mirrored articles, it stays whole.

The array is never built in one place: suffixes are dealt by a hash of host and prefix and of the page's content, so one host's,
or one prefix's, are spread over all tasks, and pages are counted in the tasks before a prefix's counts are shuffled. Only pages
with unmarked text look their runs up.

Defined results: a null or empty page has the empty text; a null or odd URL shares the host "" with its like; pages
are told apart by content, so repeated rows and copies do not make each other's text boilerplate; malformed markup is
read with the usual implied ends; very long pages are read whole. Only the named columns are read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_engine.llm.common import prepare, settled

DEPTH = 8  # tokens of a repeated run
SHARE = 0.3  # of a host's distinct pages that have a repeated run
MANY = 5  # distinct articles of a host that have a repeated block, at least

# Element, role and name lists.
HEADING_NAMES = frozenset("article content entry post story".split())  # beside "header" inside an article: its heading
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre section select summary "
    "table tbody td tfoot th thead title tr ul".split())
RAW = frozenset("script style textarea title xmp noscript iframe template svg math".split())
CHROME = frozenset(
    "head nav header footer aside form script style noscript template svg math iframe object button select textarea dialog menu "
    "title xmp audio video canvas input label".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
SOFT = frozenset(["form"])  # chrome unless it holds most of the text, as a form around a whole page does
CHROME_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist cookie cookies consent "
    "disclaimer disqus footer gdpr header masthead menu menubar modal nav navbar navigation newsletter notice notices "
    "pager pagination popup promo promotion promoted related reply replies respond share sharing sidebar skip social "
    "sponsor sponsored subscribe subscription toolbar widget widgets".split())
# Of these, those whose content is links; where one holds prose instead, its name means something else.
LINK_NAMES = frozenset(
    "breadcrumb breadcrumbs menu menubar nav navbar navigation pager pagination related share sharing skip social toolbar".split())
COMMENT_NAMES = frozenset("comment comments commentlist disqus reply replies respond".split())
# A name is chrome's if all its words are chrome names or say nothing: "site-footer", not "promo-code-explainer".
NEUTRAL = frozenset(
    "a area article aside bar big block blog body bottom box btn button buttons center col column container content count cta desktop element fixed float "
    "form global group head holder home icon icons id image inner item items js label large layer left level line link links list lower main mini mobile "
    "module msg message new news no1 outer page pane panel parent part placeholder post posts primary rail region right row secondary section section1 "
    "side signup site slot small space spot static sticky story sub tab table tag text the tile title top unit upper user view web wide wp wrap wrapper zone".split())
# Words that turn a name into a statement about the page: "no-sidebar", "has-header", "comments-off".
STATES = frozenset("no not non without with has have is off on open opened closed enabled disabled hide hides hidden show shows shown free less layout template".split())
ARTICLE_NAMES = frozenset(
    "article-body article-content articlebody entry-content main-content post-body post-content story-body".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
WALLS = frozenset("ul ol dl table article section div main body".split())
PROSE = 12  # words of a block that is no list of links

NAME = re.compile(r"/?([A-Za-z][^\s/>]*+)")
REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
ACROSS = 1024  # characters that a tag may take up if a "<" stands in one of its values
WORD = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
ENDS = {name: re.compile(rf"</{name}\s*[^>]*>", re.I) for name in RAW}


def _says(token: str) -> set[str]:
    """The chrome names in a class name or id, if it is one of chrome."""
    words = {w.lower() for w in WORD.split(token) if w and not w.isdigit()}
    if words & STATES or not words <= CHROME_NAMES | NEUTRAL:
        return set()
    return words & CHROME_NAMES


@dataclass
class Kind:
    """What an element is by its name and attributes: chrome for certain, or if what it holds agrees; of links; comments; the article."""

    hard: bool = False
    soft: bool = False
    links: bool = False
    comments: bool = False
    article: bool = False


def _kind(name: str, rest: str, in_article: bool) -> Kind:
    if name in ("html", "body"):
        return Kind()
    found = {m[0].lower(): (m[1] or m[2] or m[3]) for m in ATTRIBUTE.findall(rest)} if rest else {}
    names = (found.get("class", "") + " " + found.get("id", "")).split()
    words = set().union(*map(_says, names)) if names else set()
    if in_article and {w.lower() for n in names for w in WORD.split(n)} & HEADING_NAMES:
        words -= {"header"}
    comments = bool(words & COMMENT_NAMES)
    role = found.get("role", "").lower()
    article = name in ("article", "main") or role in ("main", "article") or bool(ARTICLE_NAMES & {n.lower() for n in names}) or (
        found.get("itemprop", "").lower() == "articlebody")
    hard = (name in CHROME - SOFT and not (name == "header" and in_article)) or role in CHROME_ROLES or (
        "hidden" in found or found.get("aria-hidden", "").lower() == "true" or bool(UNSEEN.search(found.get("style", ""))))
    soft = name in SOFT or role == "form" or bool(words)
    if article and not comments and not hard:
        soft = bool(words & {"ad", "ads", "advert", "sponsored", "promo", "related", "sidebar", "widget"})
    if name == "header" and in_article:
        soft = False  # an article's own header holds its heading
    return Kind(hard, soft and not hard, bool(words) and words <= LINK_NAMES, comments, article and not hard and not soft and not comments)


@dataclass
class Part:
    """An element that matters to what its text is, and how much text it holds: in all, in links, in prose."""

    parent: int
    kind: Kind
    main: bool
    size: int = 0
    links: int = 0
    prose: int = 0


class Reader:
    """Reads a page once, from left to right; the open elements are a stack, of which the places of each name are known."""

    def __init__(self, html: str):
        self.html, self.end = html, len(html)
        self.last = html.rfind(">")
        self.lost: set[str] = set()  # raw elements whose end does not come any more
        self.names: list[str] = []  # of open elements
        self.of: list[int] = []  # their part
        self.special: dict[str, int] = {}  # how many of a name are a part of their own
        self.places: dict[str, list[int]] = {}
        self.walls: list[int] = []
        self.chrome: list[int] = []  # places of open elements that are chrome
        self.parts = [Part(-1, Kind(), False)]
        self.text: list[str] = []
        self.linked = 0
        self.size = 0
        self.out: list[tuple[int, str]] = []  # part and text of each block

    def tag_end(self, at: int) -> int:
        """Where a tag ends whose name ends at ``at``; -1 if it is none. A value may hold "<" within some distance, and a quotation mark
        that is never closed is a character like any other."""
        if at > self.last:
            return -1
        ahead = self.html.find("<", at)
        ahead = self.end if ahead < 0 else ahead
        found = REST.match(self.html, at, ahead) or (ahead < self.end and REST.match(self.html, at, min(self.end, at + ACROSS)))
        return found.end() if found else self.html.find(">", at, ahead) + 1 or -1

    def flush(self) -> None:
        if self.text:
            found = " ".join(unescape("".join(self.text)).split())
            self.text.clear()
            if found:
                part = self.parts[self.of[-1] if self.of else 0]
                part.size += len(found)
                # White space counts in what was read between link tags, so this is an estimate.
                linked = min(len(found), self.linked)
                part.links += linked
                if found.count(" ") + 1 >= PROSE and 2 * linked < len(found):
                    part.prose += len(found)
                self.out.append((self.of[-1] if self.of else 0, found))
        self.linked = 0

    def cut(self, place: int) -> None:
        """Closes the elements from a place on the stack upwards."""
        while len(self.names) > place:
            name, of = self.names.pop(), self.of.pop()
            self.special[name] -= of != (self.of[-1] if self.of else 0)
            self.places[name].pop()
            if name in WALLS:
                self.walls.pop()
        while self.chrome and self.chrome[-1] >= place:
            self.chrome.pop()

    def open(self, name: str, kind: Kind) -> None:
        self.places.setdefault(name, []).append(len(self.names))
        if name in WALLS:
            self.walls.append(len(self.names))
        if kind.hard or kind.soft:
            self.chrome.append(len(self.names))
        of = self.of[-1] if self.of else 0
        if kind.hard or kind.soft or kind.article:
            self.parts.append(Part(of, kind, name == "main"))
            of = len(self.parts) - 1
        self.special[name] = self.special.get(name, 0) + (of != (self.of[-1] if self.of else 0))
        self.names.append(name)
        self.of.append(of)

    def within(self, flag: str) -> bool:
        at = self.of[-1] if self.of else 0
        return at > 0 and getattr(self.inside[at], flag)

    def run(self) -> Reader:
        html, at = self.html, 0
        self.inside = _Inside(self.parts)
        while at < self.end:
            if html[at] != "<":
                stop = html.find("<", at)
                stop = self.end if stop < 0 else stop
                self.text.append(html[at:stop])
                if self.places.get("a"):
                    self.linked += stop - at
                at = stop
                continue
            if html.startswith("<!--", at):
                stop = html.find("-->", at + 4)
                at = self.end if stop < 0 else stop + 3
                continue
            if html.startswith(("<!", "<?"), at) and at < self.last:
                at = html.find(">", at) + 1
                continue
            named = NAME.match(html, at + 1)
            stop = self.tag_end(named.end()) if named else -1
            if stop < 0:
                self.text.append("<")
                at += 1
                continue
            name, rest = named[1].lower(), html[named.end():stop - 1]
            closes, at = html[at + 1] == "/", stop
            if closes:
                if name in BLOCKS or self.special.get(name):
                    self.flush()
                own = self.places.get(name)
                # A stray end of an inner element does not close what holds it.
                if own and (name in WALLS or not self.walls or self.walls[-1] < own[-1]):
                    self.cut(own[-1])
                continue
            if name in RAW and not rest.endswith("/"):
                found = None if name in self.lost else ENDS[name].search(html, at)
                if not found:
                    self.lost.add(name)
                at = found.end() if found else (self.end if name in ("script", "style") else at)
                continue
            if name == "br":
                self.text.append(" ")
                continue
            kind = _kind(name, rest, self.within("article"))
            apart = kind.hard or kind.soft or kind.article
            if name in BLOCKS or apart:
                self.flush()
            if name in VOID or rest.endswith("/"):
                continue
            if name in BLOCKS:
                # A paragraph ends where a block begins; items, cells and terms end where the next one begins.
                wall = self.walls[-1] if self.walls else -1
                ended = [own[bisect_right(own, wall)] for n in ("p", *CLOSES.get(name, ())) if (own := self.places.get(n)) and own[-1] > wall]
                if ended:
                    self.cut(min(ended))
            if kind.article and self.chrome and not self.within("comments"):
                self.cut(self.chrome[0])  # no menu or advert holds the article: one that is still open was never closed
            self.open(name, kind)
        self.flush()
        return self


@dataclass
class _State:
    comments: bool = False
    article: bool = False


class _Inside(dict):
    """What surrounds each part, worked out once for each."""

    def __init__(self, parts: list[Part]):
        super().__init__()
        self.parts = parts

    def __missing__(self, at: int) -> _State:
        part = self.parts[at]
        outer = self[part.parent] if part.parent >= 0 else _State()
        kind = part.kind
        state = self[at] = _State(outer.comments or kind.comments, outer.article or kind.article)
        return state


def zones(parts: list[Part]) -> list[str]:
    """Of each part the zone of its own text: chrome, soft (chrome by a name alone), article, beside (an article that is not the page's main), plain."""
    size = [p.size for p in parts]
    links, prose = [p.links for p in parts], [p.prose for p in parts]
    for at in range(len(parts) - 1, 0, -1):  # parts come after what holds them
        up = parts[at].parent
        if not parts[at].kind.hard:  # what is chrome for certain says nothing about what holds it
            size[up] += size[at]
            links[up] += links[at]
            prose[up] += prose[at]
    state: list[tuple[str, int, bool]] = [("plain", size[0], False)]
    mains = False
    for at, part in enumerate(parts[1:], 1):
        zone, whole, main = state[part.parent]
        kind = part.kind
        if kind.hard:
            zone = "chrome"
        elif kind.soft and zone != "chrome":
            if not kind.comments and 2 * size[at] > whole:
                pass  # it holds most of the text
            elif kind.links and 2 * prose[at] > size[at]:
                pass  # it holds prose where links would be
            else:
                zone = "chrome" if kind.comments else "soft"
        elif kind.article and zone == "plain":
            zone, whole = "article", size[at]
        main = main or (part.main and zone == "article")
        mains = mains or (main and zone == "article" and size[at] > 0)
        state.append((zone, whole, main))
    return ["beside" if zone == "article" and mains and not main else zone for zone, _, main in state]


def blocks(html: str) -> list[tuple[str, str]]:
    """(zone, text) of each block with text, in page order: article, plain or chrome.

    Where a page has a main element, articles outside it are chrome. A page that would be left without any text keeps what is chrome by a
    class name alone.
    """
    read = Reader(html).run()
    zone = zones(read.parts)
    found = [(zone[of], text) for of, text in read.out]
    only_soft = not any(z in ("article", "plain") for z, _ in found)
    names = {"article": "article", "plain": "plain", "soft": "plain" if only_soft else "chrome"}
    return [(names.get(z, "chrome"), text) for z, text in found]


def host(url: str | None) -> str:
    found = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", url or "")
    return found[1].lower() if found else ""


def windows(tokens: list[str], depth: int = DEPTH) -> np.ndarray:
    """A 64-bit hash of the first ``depth`` tokens of every suffix that has so many."""
    n = len(tokens) - depth + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = np.fromiter((hash64(t) for t in tokens), np.uint64, len(tokens))
    total = np.zeros(n, np.uint64)
    for i in range(depth):
        total = (total * np.uint64(0x9E3779B97F4A7C15)) ^ h[i:i + n]
        total ^= total >> np.uint64(31)
    return total.view(np.int64)


def hash64(token: str) -> int:
    return xxhash.xxh3_64_intdigest(token.encode("utf-8", "surrogatepass"))


def stream(found: list[tuple[str, str]], zones: tuple[str, ...]) -> tuple[list[str], list[int]]:
    """Tokens of the blocks in the zones, in order, and for each the block it comes from."""
    tokens, places = [], []
    for i, (zone, text) in enumerate(found):
        if zone in zones:
            words = text.split(" ")
            tokens += words
            places += [i] * len(words)
    return tokens, places


def unmarked(found: list[tuple[str, str]]) -> bool:
    """Whether the page's text has to be told from what its host repeats."""
    return any(z == "plain" for z, _ in found) and not any(z == "article" for z, _ in found)


def salt(url: str | None) -> np.uint64:
    return np.uint64(hash64("\0" + host(url)))


def keyed(hashes: np.ndarray, of_host: np.uint64) -> np.ndarray:
    mixed = (hashes.view(np.uint64) ^ of_host) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


def short(found: list[tuple[str, str]], zones: tuple[str, ...], of_host: np.uint64) -> tuple[list[int], list[int]]:
    """Blocks of fewer tokens than a run has, and a key of each."""
    places = [i for i, (z, t) in enumerate(found) if z in zones and t.count(" ") + 1 < DEPTH]
    return places, keyed(np.array([hash64("\0" + found[i][1]) for i in places], np.uint64), of_host).tolist()


def keys(found: list[tuple[str, str]], zones: tuple[str, ...], of_host: np.uint64) -> np.ndarray:
    """Keys of all runs and short blocks."""
    own = np.array(short(found, zones, of_host)[1], np.int64)
    return np.concatenate([keyed(windows(stream(found, zones)[0]), of_host), own])


def chosen(found: list[tuple[str, str]], repeated: set[int], of_host: np.uint64 = np.uint64(0)) -> str:
    """The page's main text, given the keys its host repeats."""
    if any(z == "article" for z, _ in found):
        return "\n".join(t for z, t in found if z == "article")
    kept = [t for z, t in found if z == "plain"]
    if repeated:
        tokens, places = stream(found, ("plain",))
        covered, places = np.zeros(len(tokens), bool), np.array(places)
        for at, h in enumerate(keyed(windows(tokens), of_host).tolist()):
            if h in repeated:
                covered[at:at + DEPTH] = True
        for i, h in zip(*short(found, ("plain",), of_host)):
            if h in repeated:
                covered[places == i] = True
        own = {}
        for token, i, gone in zip(tokens, places.tolist(), covered.tolist()):
            if not gone:
                own.setdefault(i, []).append(token)
        kept = [" ".join(ts) for ts in own.values()] or kept
    return "\n".join(kept)


def article_keys(lines: list[str], of_host: np.uint64) -> tuple[list[int], np.ndarray, list[list[int]]]:
    """Of an article's blocks: the numbers of tokens, the keys, and the keys' blocks."""
    sizes = [t.count(" ") + 1 for t in lines]
    hashes, held, begin = [], [], 0
    for i, size in enumerate([*sizes, DEPTH]):
        if size < DEPTH:
            continue
        tokens = [(w, k) for k in range(begin, i) for w in lines[k].split(" ")]
        for at, h in enumerate(windows([w for w, _ in tokens]).tolist()):
            hashes.append(h)
            held.append([k for _, k in tokens[at:at + DEPTH]])
        if i < len(lines):
            hashes.append(np.uint64(hash64("\1" + lines[i])).view(np.int64))
            held.append([i] * size)
        begin = i + 1
    return sizes, keyed(np.array(hashes, np.int64), ~of_host), held


def trimmed(text: str, repeated: set[int], of_host: np.uint64) -> str:
    """A marked article without the blocks that its host repeats."""
    lines = text.split("\n")
    sizes, own, held = article_keys(lines, of_host)
    gone, begin = np.zeros(sum(sizes), bool), np.concatenate([[0], np.cumsum(sizes)])
    stream_at = [(k, j) for k, size in enumerate(sizes) for j in range(size)]
    first = {kj: at for at, kj in enumerate(stream_at)}
    run_at, last = 0, None
    for key, ks in zip(own.tolist(), held):
        # Windows of one sequence of short blocks come one token after another.
        run_at = run_at + 1 if last is not None and ks[0] in (last, last + 1) and sizes[ks[0]] < DEPTH and sizes[last] < DEPTH else first[(ks[0], 0)]
        last = ks[0]
        if key in repeated:
            gone[run_at:run_at + len(ks)] = True
    out = [k for k in range(len(lines)) if not gone[begin[k]:begin[k + 1]].all()]
    if 2 * (sum(sizes) - sum(sizes[k] for k in out)) >= sum(sizes):
        return text
    return "\n".join(lines[k] for k in out)


def main_text(pages: DataFrame, key="page_id", url="url", html="html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row."""
    prepare(pages.sparkSession, 256)
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Text, where the structure decides; else null and the page as it came, to be decided by its host's runs."""
        for batch in batches:
            text, open_pages = [], []
            for page in batch.column("html").to_pylist():
                found = blocks(page or "")
                text.append(None if unmarked(found) else chosen(found, set()))
                open_pages.append(page if text[-1] is None else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("page_id"), batch.column("url"), pa.array(open_pages, pa.string()), pa.array(text, pa.string())],
                ["row", "page_id", "url", "html", "text"])

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each page's runs, and its host as one more."""
        for batch in batches:
            out, contents = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for page, address in zip(batch.column("html").to_pylist(), batch.column("url").to_pylist()):
                found = blocks(page or "")
                if not found:
                    continue
                of_host = salt(address)
                # A run of plain text is the same whether or not a menu stands in it.
                own = [keys(found, zones, of_host) for zones in (("chrome", "plain"), ("plain",))]
                out.append(np.unique(np.concatenate([*own, np.array([of_host]).view(np.int64)])))
                content = np.uint64(hash64("\n".join(t for _, t in found))).view(np.int64)
                contents.append(np.full(len(out[-1]), content))
                lines = [t for z, t in found if z == "article"]
                if lines:
                    out.append(np.unique(np.append(article_keys(lines, of_host)[1], np.array([~of_host]).view(np.int64))))
                    contents.append(np.full(len(out[-1]), np.uint64(hash64("\n".join(lines))).view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out)), pa.array(np.concatenate(contents))], ["key", "content"])

    first = settled(rows.mapInArrow(read, "row long, page_id long, url string, html string, text string"), "page-text")
    done = first.where("text is not null").select("row", "page_id", "url", "text")
    waiting = first.where("text is null").select("row", "page_id", "url", "html")
    pages_of = rows.select("url", "html").mapInArrow(suffixes, "key long, content long").distinct()
    runs = settled(pages_of.groupBy("key").agg(F.count(F.lit(1)).alias("pages")).where("pages > 1"), "page-runs")
    return articles(done, runs).unionByName(decided(waiting, runs)).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def articles(done: DataFrame, runs: DataFrame) -> DataFrame:
    """Marked articles without the blocks that many others of the host have; texts travel only if there are such blocks."""

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, ids, hosts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for row, address, text in zip(*(batch.column(c).to_pylist() for c in ("row", "url", "text"))):
                if text:
                    of_host = salt(address)
                    out.append(np.unique(article_keys(text.split("\n"), of_host)[1]))
                    ids.append(np.full(len(out[-1]), row))
                    hosts.append(np.full(len(out[-1]), (~of_host).view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (ids, out, hosts)], ["row", "key", "of_host"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("url", "text", "runs"))
            text = [trimmed(t, set(found), salt(address)) if found else t for address, t, found in zip(*columns)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string())], ["page_id", "url", "text"])

    wanted = done.select("row", "url", "text").mapInArrow(looked_up, "row long, key long, of_host long")
    many = wanted.join(runs.where(F.col("pages") >= MANY), "key")
    hosts = runs.select(F.col("key").alias("of_host"), F.col("pages").alias("of_all"))
    own = many.join(hosts, "of_host").where(F.col("pages") >= SHARE * F.col("of_all")).groupBy("row").agg(F.collect_set("key").alias("runs"))
    own = settled(own, "page-articles")
    if own.isEmpty():
        return done.select("page_id", "url", "text")
    return done.join(own, "row", "left").select("page_id", "url", "text", "runs").mapInArrow(write, "page_id long, url string, text string")


def decided(waiting: DataFrame, runs: DataFrame) -> DataFrame:
    """Unmarked pages with the runs of their host looked up; each page gets only its own, gathered into one row."""

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for row, address, page in zip(*(batch.column(c).to_pylist() for c in ("row", "url", "html"))):
                of_host = salt(address)
                out.append(np.unique(np.append(keys(blocks(page or ""), ("plain",), of_host), np.array([of_host]).view(np.int64))))
                ids.append(np.full(len(out[-1]), row))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(out))], ["row", "key"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = []
            for page, address, found in zip(*(batch.column(c).to_pylist() for c in ("html", "url", "runs"))):
                of_host, pages = salt(address), {x["key"]: x["pages"] for x in found or ()}
                of_all = SHARE * pages.pop(int(of_host.view(np.int64)), 0)
                text.append(chosen(blocks(page or ""), {k for k, n in pages.items() if n >= of_all}, of_host))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string())], ["page_id", "url", "text"])

    wanted = waiting.select("row", "url", "html").mapInArrow(looked_up, "row long, key long")
    own = wanted.join(runs, "key").groupBy("row").agg(F.collect_list(F.struct("key", "pages")).alias("runs"))  # one page's keys
    return waiting.join(own, "row", "left").select("page_id", "url", "html", "runs").mapInArrow(write, "page_id long, url string, text string")
