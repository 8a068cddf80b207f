"""Benchmark items in documents, also with other numbers, names and units.

Texts become templates: numbers, quantities with a unit, and runs of names inside sentences are typed
placeholders, all else a literal word in lower case without outer punctuation. A capital at the begin of a sentence or quotation and a word in
capitals may be a name or not: texts with such words have a second, loose reading, where they are names, and windows of either
reading are looked up among the items' windows of both. Windows of ``window`` template tokens
are hashed; a document's windows are joined by hash with the items' windows inside the task that holds the document, so
nothing is shuffled. An item is found where, in one alignment with the document (place less place in the item, up to a
drift) or else in one stretch of it, at least ``coverage`` of its windows occur, or ``run`` of them one after another; then the values in its slots are compared: one item value must always stand for one document value
(in at least ``consistency`` of the slots), else the stretch only looks alike. With equal values it is a *verbatim* leak,
with others a *reparameterised* one.

The items are a stated query set and are taken in blocks of about ``block_windows`` windows, so what is broadcast is
bounded for any number of items; each block reads the documents once.

Items of fewer tokens than a window, and those without a window of two literal tokens, are looked up as a whole at every place:
by their words and, where the whole template has two literals, by it. A run of numbers is found with its own numbers only.

Defined results: null or empty texts and items match nothing; windows with fewer than two literal tokens say nothing; an item of
one or two tokens is found only as a sentence, a quotation or a text of its own; repeated rows and items each give their own
rows; an empty table gives no row. Only the named columns are read.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_engine.llm.common import mark, prepare, texts

LITERAL, NUMBER, QUANTITY, NAME = range(4)
CAPITAL, STOPS, NUMERIC, UNIT, FUSED, CAPITALS, OPENS = 1, 2, 4, 8, 16, 32, 64
LITERALS = 2  # of a window that says something
ANYWHERE = 3  # tokens from which a short item is found inside sentences
CACHE_WORDS = 300_000

# Units and number words.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs oz pound pounds ton tons tonnes "
    "ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year "
    "years % percent cent cents dollar dollars euro euros mph kph km/h m/s hz khz mhz ghz kb mb gb tb w kw kwh v volt volts a amp amps j kj cal kcal "
    "degree degrees °c °f c f k pa kpa mol".split())
NUMBER_WORDS = frozenset(
    "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty "
    "fifty sixty seventy eighty ninety hundred thousand million billion".split())
EDGES = re.compile(r"^[^\w%°$€£+\-]+|[^\w%°]+$")
OPENING = "\"'“‘«„([{"
SENTENCE_END = re.compile(r"[.!?:;…][\"')\]»”]*$")
NUMERAL = re.compile(r"[+\-]?[$€£]?\d[\d,.:/]*(st|nd|rd|th|[^\W\d]{1,4}|%|°[cf]?)?")


@dataclass(frozen=True)
class Settings:
    window: int = 5
    coverage: float = 0.8
    consistency: float = 0.9
    run: int = 20  # consecutive windows that are a leak whatever their share of the item
    block_windows: int = 500_000


def hash64(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


PLACEHOLDERS = np.array([0, *(hash64(f"\0{k}") for k in ("number", "quantity", "name"))], np.uint64)


POWERS = (0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Words(dict):
    """What a single word is: its literal's hash and flags; kept for the words seen most recently."""

    def __init__(self):
        super().__init__()
        self.hashes, self.flags = array("Q"), array("q")

    def __missing__(self, word: str) -> int:
        literal, flags = self._look(word)
        self.hashes.append(literal)
        self.flags.append(flags)
        at = self[word] = len(self)
        return at

    def _look(self, word: str) -> tuple[int, int]:
        core = word if word.isalnum() else EDGES.sub("", word)
        flags = STOPS if not word[-1].isalnum() and SENTENCE_END.search(word) else 0
        flags |= OPENS if word[0] in OPENING else 0
        low = core.lower()
        if not low.isalpha() and (m := NUMERAL.fullmatch(low)):
            flags |= NUMERIC | (FUSED if (m[1] and m[1] not in ("st", "nd", "rd", "th")) or low[0] in "$€£" else 0)
        elif low in NUMBER_WORDS:
            flags |= NUMERIC
        elif core[:1].isupper() and core[1:] != core[1:].upper():
            flags |= CAPITAL
        elif core[:1].isupper():
            flags |= CAPITALS
        if low in UNITS:
            flags |= UNIT
        return hash64(low), flags

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) > CACHE_WORDS:
            self.clear()
            self.hashes, self.flags = array("Q"), array("q")
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return np.frombuffer(self.hashes, np.uint64)[at], np.frombuffer(self.flags, np.int64)[at]


@dataclass
class Template:
    """Template tokens of a text, and for each the words it stands for; ``places`` counts in tokens of the strict reading,
    ``unsure`` tokens are names in the loose one only; ``literal`` has the hash of every word."""

    hashes: np.ndarray
    kinds: np.ndarray
    begins: np.ndarray
    words: list[str]
    places: np.ndarray
    unsure: np.ndarray
    literal: np.ndarray

    def end(self, at: int) -> int:
        return int(self.begins[at + 1]) if at + 1 < len(self.begins) else len(self.words)

    def value(self, at: int) -> str:
        """The words a token stands for; of a run of names the last, since a capital at a text's start may join the run."""
        end = self.end(at)
        begin = end - 1 if self.kinds[at] == NAME else int(self.begins[at])
        return "".join(EDGES.sub("", w).lower() for w in self.words[begin:end])

    def windows(self, size: int) -> np.ndarray:
        return spoken(self.hashes, self.kinds, size)


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size``: differences of sums of hash times power, brought to the same power."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    up, down = (np.cumprod(np.append(np.uint64(1), np.full(len(hashes) - 1, f, np.uint64))) for f in POWERS)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up)])
    return (sums[size:] - sums[:-size]) * down[:len(hashes) - size + 1]


def template(text: str, known: Words) -> Template:
    """The strict reading."""
    return readings(text, known)[0]


@dataclass
class Reading:
    """Template tokens of words that may be of several texts: their hashes, kinds and first words, and the words that are names."""

    hashes: np.ndarray
    kinds: np.ndarray
    begins: np.ndarray
    name: np.ndarray


def read(words: list[str], first: np.ndarray, known: Words) -> tuple[np.ndarray, list[Reading]]:
    """Hashes of the words, and the strict reading, where words that begin a sentence or quotation and words in capitals are literals, and,
    if there are any, the loose one, where they are names; ``first`` words begin a text, and nothing reaches over its end."""
    literal, flags = known.of(words)
    has = lambda f: (flags & f) > 0
    before = lambda x: np.concatenate([[False], x[:-1]]) & ~first
    number, ended = has(NUMERIC), first | before(has(STOPS)) | has(OPENS)
    unit = has(UNIT) & before(number & ~has(FUSED)) & ~number
    quantity = number & (has(FUSED) | np.append(unit[1:], False))
    strict, loose = has(CAPITAL) & ~ended & ~unit, has(CAPITAL | CAPITALS) & ~unit

    def tokens(name: np.ndarray) -> Reading:
        kinds = np.where(quantity, QUANTITY, np.where(number, NUMBER, np.where(name, NAME, LITERAL)))
        begins = np.flatnonzero(~(unit | (name & before(name) & ~ended)))
        kinds = kinds[begins]
        return Reading(np.where(kinds == LITERAL, literal[begins], PLACEHOLDERS[kinds]), kinds, begins, name)

    return literal, [tokens(strict), *([tokens(loose)] if (strict != loose).any() else [])]


def readings(text: str, known: Words) -> list[Template]:
    """The readings of one text."""
    words = text.split()
    if not words:
        empty = np.zeros(0, np.int64)
        return [Template(empty.astype(np.uint64), empty, empty, words, empty, empty.astype(bool), empty.astype(np.uint64))]
    literal, (strict, *loose) = read(words, np.arange(len(words)) == 0, known)
    out = [Template(strict.hashes, strict.kinds, strict.begins, words, np.arange(len(strict.begins)), np.zeros(len(strict.begins), bool), literal)]
    for r in loose:
        last = np.append(r.begins[1:], len(words)) - 1  # what begins a token here begins one in the strict reading, too
        out.append(Template(r.hashes, r.kinds, r.begins, words, np.searchsorted(strict.begins, r.begins), (r.kinds == NAME) & ~strict.name[last], literal))
    return out


def spoken(hashes: np.ndarray, kinds: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the windows at each token; 0 for those that say nothing."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total, literal = np.zeros(n, np.uint64), np.zeros(n, np.int64)
    for i in range(size):
        total = (total * np.uint64(0x9E3779B97F4A7C15)) ^ hashes[i:i + n]
        total ^= total >> np.uint64(29)
        literal += kinds[i:i + n] == LITERAL
    return np.where(literal >= min(LITERALS, size), total | np.uint64(1), np.uint64(0))


class Items:
    """A block of items, ready to be looked up."""

    def __init__(self, rows: list[tuple[int, str]], s: Settings):
        known, self.s = Words(), s
        self.ids, self.templates, self.counts, self.ranks = [], [], [], []
        places = defaultdict(list)
        # By the number of tokens or words, and the hash of the run: items found as a whole, with any values or with the same.
        self.whole, self.exact = defaultdict(lambda: defaultdict(list)), defaultdict(lambda: defaultdict(list))
        for item_id, text in rows:
            both = readings(text, known)
            number = len(self.ids)
            count = self._index(number, both, places)
            speaks = [(t.kinds == LITERAL).sum() >= LITERALS for t in both]
            for reading, t in enumerate(both):
                if speaks[reading] and (not count or len(t.hashes) < s.window):
                    self.whole[len(t.hashes)][int(runs(t.hashes, len(t.hashes))[0])].append((number, reading))
            if len(both[0].words) and (not count or len(both[-1].hashes) < s.window):
                self.exact[len(both[0].words)][int(runs(both[0].literal, len(both[0].words))[0])].append(number)
            self.ids.append(item_id)
            self.templates.append(both)
            self.counts.append(count or 1)
        self.places = dict(places)
        self.sorted = np.sort(np.fromiter(places, np.uint64, len(places)))

    def _index(self, number: int, both: list[Template], places: dict[int, list]) -> int:
        """Notes (item, place, reading, token) of each window that speaks, and gives the number of places. A window of the
        loose reading stands for all places that its first token takes up in the strict one, the last also for those after it."""
        windows = [t.windows(self.s.window) for t in both]
        spoken = np.flatnonzero(windows[0] > 0)
        if not len(spoken) and len(both) > 1:
            spoken = both[1].places[np.flatnonzero(windows[1] > 0)]
        noted = set()
        for reading, (t, hashes) in enumerate(zip(both, windows)):
            for token in np.flatnonzero(hashes > 0).tolist():
                after = t.places[token + 1] if token + 1 < len(hashes) else len(both[0].hashes)
                window = int(hashes[token])
                for place in spoken[np.searchsorted(spoken, t.places[token]):np.searchsorted(spoken, after)].tolist():
                    if (window, place) not in noted:
                        noted.add((window, place))
                        places[window].append((number, place, reading, token))
        self.ranks.append({place: rank for rank, place in enumerate(spoken.tolist())})
        return len(spoken)

    def touched(self, bodies: list[str], known: Words) -> list[int]:
        """Which texts have anything of an item at all: a window, or as a whole a short one. All are read at once."""
        parts = [body.split() for body in bodies]
        words = [w for part in parts for w in part]
        if not words:
            return []
        sizes = np.array([len(p) for p in parts])
        owner = np.repeat(np.arange(len(parts)), sizes)
        literal, both = read(words, np.concatenate([[True], owner[1:] != owner[:-1]]), known)
        hit = np.zeros(len(parts), bool)

        def note(hashes: np.ndarray, size: int, wanted: np.ndarray, of: np.ndarray) -> None:
            if len(hashes) and len(wanted):
                at = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
                begin = np.flatnonzero(wanted[at] == hashes)
                hit[of[begin[of[begin] == of[begin + size - 1]]]] = True

        for r in both:
            of = owner[r.begins]
            note(spoken(r.hashes, r.kinds, self.s.window), self.s.window, self.sorted, of)
            for size, wanted in self.whole.items():
                note(runs(r.hashes, size), size, np.sort(np.fromiter(wanted, np.uint64, len(wanted))), of)
        for size, wanted in self.exact.items():
            note(runs(literal, size), size, np.sort(np.fromiter(wanted, np.uint64, len(wanted))), owner)
        return np.flatnonzero(hit).tolist()

    def found(self, text: str, known: Words) -> list[tuple]:
        """(item, its windows, those found, share of consistent slots, slots, kind) of each leaked item, best occurrence."""
        both = readings(text, known)
        leaks = self._short(both)
        if len(self.sorted):
            for number, leak in self._long(both).items():
                leaks.setdefault(number, leak)
        return list(leaks.values())

    def _short(self, both: list[Template]) -> dict[int, tuple]:
        """Items that are found as a whole, at any place; those of very few tokens only as a sentence or quotation of their own."""
        out = {}

        def note(number: int, leak: tuple) -> None:
            if leak[3] >= self.s.consistency and (number not in out or (leak[3], leak[5] == "verbatim") > (out[number][3], out[number][5] == "verbatim")):
                out[number] = leak

        for size, wanted in self.whole.items():
            for other, t in enumerate(both):
                for place, h in self._at(runs(t.hashes, size), wanted):
                    for number, reading in wanted[h]:
                        if size >= ANYWHERE or self._apart(t.words, int(t.begins[place]), t.end(place + size - 1)):
                            note(number, self._judge(both, number, {(0, 0): (reading, 0, other, place)}, [(0, 0)], size, 1))
        for size, numbers in self.exact.items():
            for place, h in self._at(runs(both[0].literal, size), numbers):
                if size >= ANYWHERE or self._apart(both[0].words, place, place + size):
                    for number in numbers[h]:
                        n_slots = int((self.templates[number][0].kinds != LITERAL).sum())
                        note(number, (self.ids[number], 1, 1, 1.0, n_slots, "verbatim"))
        return out

    @staticmethod
    def _at(hashes: np.ndarray, wanted: dict[int, list]) -> list[tuple[int, int]]:
        at = np.flatnonzero(np.isin(hashes, np.fromiter(wanted, np.uint64, len(wanted))))
        return list(zip(at.tolist(), hashes[at].tolist()))

    @staticmethod
    def _apart(words: list[str], begin: int, end: int) -> bool:
        """Whether words stand as a sentence, a quotation or a text of their own."""
        first, last, named = words[begin], words[end - 1], any(EDGES.sub("", w) for w in words[begin:end])
        opened = begin == 0 or (named and (EDGES.match(first) or SENTENCE_END.search(words[begin - 1])))
        closed = end == len(words) or (named and EDGES.sub("", "x" + last) != "x" + last)
        return bool(opened and closed)

    def _long(self, both: list[Template]) -> dict[int, tuple]:
        """Items of which enough windows are found."""
        by_item = defaultdict(dict)
        for reading, t in enumerate(both):
            hashes = t.windows(self.s.window)
            tokens = np.flatnonzero(hashes > 0)
            if reading:  # other windows are the same in both
                unsure = np.concatenate([[0], np.cumsum(self._merged(t, both[0]))])
                tokens = tokens[unsure[tokens + self.s.window] > unsure[tokens]]
            looked = hashes[tokens]
            at = np.minimum(np.searchsorted(self.sorted, looked), len(self.sorted) - 1)
            for token in tokens[self.sorted[at] == looked].tolist():
                place = int(t.places[token])
                for number, inside, *of_item in self.places[int(hashes[token])]:
                    by_item[number].setdefault((place, inside), (*of_item, reading, token))
        out = {number: self._best(both, number, matches) for number, matches in by_item.items()}
        return {number: best for number, best in out.items() if best}

    @staticmethod
    def _merged(t: Template, strict: Template) -> np.ndarray:
        """Tokens that the strict reading reads otherwise."""
        sizes = np.append(t.places[1:], len(strict.hashes)) - t.places
        return t.unsure | (sizes > 1)

    def _best(self, both: list[Template], number: int, matches: dict[tuple[int, int], tuple]) -> tuple | None:
        """The best consistent occurrence of an item among its matches."""
        need = self.s.coverage * self.counts[number]
        if len({inside for _, inside in matches}) < min(need, self.s.run):
            return None
        length = len(self.templates[number][0].hashes)
        # What is found in one alignment needs no look at looser groups, which mix alignments.
        for groups in (self._aligned(matches, length, need), self._stretches(matches, length, need), self._consecutive(matches, number)):
            judged = [self._judge(both, number, matches, group, self.s.window) for group in groups]
            judged = [j for j in judged if j[3] >= self.s.consistency]
            if judged:
                return max(judged, key=lambda j: (j[2], j[3], j[5] == "verbatim"))
        return None

    def _consecutive(self, matches: Iterable[tuple[int, int]], number: int) -> Iterator[list[tuple[int, int]]]:
        """Chains of matches whose windows follow each other in the item (but for those that say nothing) and in the document,
        as a whole and in pieces, so that other values in a part of a chain do not hide the rest."""
        ranks, before, sizes, inner = self.ranks[number], {}, {}, set()
        for inside, shift in sorted((inside, place - inside) for place, inside in matches):
            at = (ranks[inside], shift)
            # Where names are read as one, the shift changes by the words that are no tokens of their own.
            last = max(((at[0] - 1, shift + d) for d in (0, -1, 1, -2, 2)), key=lambda x: sizes.get(x, 0))
            sizes[at] = 1 + sizes.get(last, 0)
            if last in sizes:
                before[at] = last
                inner.add(last)
        spoken = list(ranks)
        for at in sizes.keys() - inner:
            if sizes[at] >= self.s.run:
                chain = [at]
                while chain[-1] in before:
                    chain.append(before[chain[-1]])
                group = [(spoken[rank] + shift, spoken[rank]) for rank, shift in reversed(chain)]
                yield group
                for begin in range(len(group) - self.s.run + 1):
                    yield group[begin:begin + self.s.run]

    @staticmethod
    def _aligned(matches: list[tuple[int, int]], length: int, need: float) -> Iterator[list[tuple[int, int]]]:
        """Groups of enough matches whose place less place in the item differs by a small drift: a window that the item
        repeats, or that stands near by, has another alignment and cuts nothing."""
        drift, begin, seen = max(2, length // 8), 0, Counter()
        ordered = sorted((place - inside, inside) for place, inside in matches)
        for end, (shift, inside) in enumerate(ordered, 1):
            seen[inside] += 1
            last = end == len(ordered)
            if not last and ordered[end][0] <= ordered[begin][0] + drift:
                continue  # not as wide yet as it can be
            if len(seen) >= need:
                yield Items._one_each(ordered[begin:end])
            while not last and begin < end and ordered[begin][0] < ordered[end][0] - drift:
                seen[ordered[begin][1]] -= 1
                if not seen[ordered[begin][1]]:
                    del seen[ordered[begin][1]]
                begin += 1

    @staticmethod
    def _one_each(group: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Of (shift, place in the item) the one of each place that is nearest to the commonest shift, as matches."""
        common = Counter(shift for shift, _ in group).most_common(1)[0][0]
        nearest = {}
        for shift, inside in group:
            if inside not in nearest or abs(shift - common) < abs(nearest[inside] - common):
                nearest[inside] = shift
        return [(nearest[inside] + inside, inside) for inside in sorted(nearest)]

    @staticmethod
    def _stretches(matches: list[tuple[int, int]], length: int, need: float) -> Iterator[list[tuple[int, int]]]:
        """Groups of enough matches, in any order and with text between: up to a wide gap; also begun anew where the item
        seems to begin again; also every span of the item's length and a quarter."""
        ordered = sorted(matches)
        for anew in (True, False):
            part, seen = [], set()
            for place, inside in [*ordered, (None, None)]:
                if part and (place is None or place - part[-1][0] > length or (anew and inside in seen and place - part[0][0] >= length // 2)):
                    if len(seen) >= need:
                        yield part
                        if not anew:
                            yield Items._one_each([(p - i, i) for p, i in part])
                    part, seen = [], set()
                part.append((place, inside))
                seen.add(inside)
        begin, seen, span = 0, Counter(), length + length // 4
        for end, (place, inside) in enumerate(ordered, 1):
            seen[inside] += 1
            last = end == len(ordered)
            if not last and ordered[end][0] <= ordered[begin][0] + span:
                continue
            if len(seen) >= need:
                yield Items._one_each([(p - i, i) for p, i in ordered[begin:end]])
            while not last and begin < end and ordered[begin][0] < ordered[end][0] - span:
                seen[ordered[begin][1]] -= 1
                if not seen[ordered[begin][1]]:
                    del seen[ordered[begin][1]]
                begin += 1

    def _judge(self, both: list[Template], number: int, matches: dict[tuple[int, int], tuple], group: Iterable[tuple[int, int]], size: int, count: int = 0) -> tuple:
        slots = {}
        for match in group:
            reading, mine, other, theirs = matches[match]
            item, t = self.templates[number][reading], both[other]
            for k in range(size):
                if item.kinds[mine + k] != LITERAL:
                    slots.setdefault(item.end(mine + k), (item.value(mine + k), t.value(theirs + k), bool(item.unsure[mine + k])))
        values, sure = defaultdict(Counter), set()
        for mine, theirs, unsure in slots.values():
            values[mine][theirs] += 1
            if mine != theirs or not unsure:
                sure.add(mine)
        # A word that may be a name, but stands unchanged wherever it occurs, is no slot.
        values = {mine: c for mine, c in values.items() if mine in sure}
        n_slots = sum(c.total() for c in values.values())
        agreed = sum(c.most_common(1)[0][1] for c in values.values())
        same = all(set(c) == {v} for v, c in values.items())
        share = agreed / n_slots if n_slots else 1.0
        return (self.ids[number], count or self.counts[number], len({i for _, i in group}), share, n_slots, "verbatim" if same else "reparameterised")


COLUMNS = "doc_id long, mark long, item_id long, n_windows long, n_found long, slot_consistency double, n_slots long, kind string"


def template_leaks(docs: DataFrame, items: DataFrame, s: Settings = Settings(), key="doc_id", text="text", item_key="item_id", item_text="text") -> DataFrame:
    """A row for each document and item found in it; ``mark`` is a hash of the document's text."""
    spark = docs.sparkSession
    prepare(spark)
    wanted = items.select(F.col(item_key).cast("bigint").alias("item"), F.col(item_text).cast("string").alias("body")).where("body is not null")
    size = wanted.agg(F.sum(F.size(F.split("body", r"\s+")))).first()[0] or 0  # words, and so windows at most
    n_blocks = 1 + size // s.block_windows
    rows = texts(docs, key, text).withColumn("mark", mark(F.col("body").cast("string")))
    out = None
    for block in range(n_blocks):
        part = wanted.where(F.pmod(F.xxhash64("item", "body"), F.lit(n_blocks)) == block) if n_blocks > 1 else wanted
        held = spark.sparkContext.broadcast([(r["item"], r["body"]) for r in part.collect()])  # about block_windows words

        def find(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            block_items, known = Items(held.value, s), Words()
            for batch in batches:
                ids, marks = (batch.column(c).to_pylist() for c in ("id", "mark"))
                bodies = [(body or b"").decode("utf-8", "replace") for body in batch.column("body").to_pylist()]
                found = [(ids[k], marks[k], *leak) for k in block_items.touched(bodies, known) for leak in block_items.found(bodies[k], known)]
                if found:
                    kinds = [pa.int64()] * 5 + [pa.float64(), pa.int64(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], [c.split()[0] for c in COLUMNS.split(", ")])

        leaks = rows.mapInArrow(find, COLUMNS)
        out = leaks if out is None else out.unionByName(leaks)
    return out
