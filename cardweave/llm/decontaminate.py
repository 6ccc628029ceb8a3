"""Benchmark decontamination by template canonicalisation.

Texts become tokens in which numbers, names and units are typed placeholders. Windows of
these templates are joined by their hash with those of the benchmark items. What stood in the
placeholders is then compared: along one alignment of document and item, a value of the item
stands for the value of the document it meets most often, and a window counts when each of its
values is that one or has not changed. So an item is found again when its numbers, names or units were exchanged, and a text that merely has the
same shape is not.

Only capitals tell a name, so each text is read in three forms: with capital words inside sentences
as names, case-free with names as lower-cased words, and with every capital word as a name, also
where it opens a sentence. Each may find an item: the second finds copies in other capitals, the
third items whose sentences begin with the names that were exchanged. Windows of more than half
placeholders, and items of fewer than five tokens, have too few words for a template: their values
are hashed with them, so they are only found unchanged.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardweave.llm.kernel import SpanHasher, mix, slices, text_buffers, word_spans
from cardweave.storage import stage

#: Tokens of a window. Items of fewer are one window of their own; of fewer than LEAST_TOKENS, with their values.
WINDOW, LEAST_TOKENS = 8, 5
#: The share of an item's windows that must be found again.
SHARE = 0.5
#: Or so many tokens of it in a row, unchanged; of a shorter item all.
RUN = 13
#: Units of measure, singular, plural and short.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces "
    "pound pounds ton tons ml cl l liter liters litre litres gallon gallons second seconds minute minutes hour "
    "hours day days week weeks month months year years percent degree degrees celsius fahrenheit dollar dollars "
    "euro euros cent cents meter meters metre metres kilometer kilometers kilometre kilometres mph kph watt watts "
    "volt volts joule joules byte bytes kb mb gb"
).split()
#: Units in the singular, where it is not the plural without its s.
SINGULAR = {"inches": "inch", "feet": "foot"}
STEMS = {u: u[:-1] for u in UNITS if u[-1] == "s" and u[:-1] in UNITS} | SINGULAR
#: First and last code points of scripts without spaces, whose characters are tokens: Thai to Tibetan, Burmese, Khmer,
#: kana and Chinese characters.
UNSPACED = (
    (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x3040, 0x30FF),
    (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA9E0, 0xA9FF), (0xAA60, 0xAA7F), (0xF900, 0xFAFF),
    (0xFF66, 0xFF9F), (0x1B000, 0x1B16F),
)
SEPARATES, ALONE = 1, 2
NUMBER, NAME, UNIT = 1, 2, 3
#: Where in its text a token is.
FIRST, LAST = 1, 2
#: The forms: capital words inside sentences are names, no word is, or every capital word is.
INSIDE, NO_NAMES, EVERY = 0, 1, 2
FORMS = (INSIDE, NO_NAMES, EVERY)
#: Size of the filter of benchmark windows: bits for each window, and the bounds of the whole.
#: Beyond the largest size more windows of documents go through the join; no result changes.
BITS_PER_WINDOW, LEAST_BITS, MOST_BITS = 64, 1 << 16, 1 << 28


def _separators() -> np.ndarray:
    table = np.zeros(256, bool)
    for b in range(128):
        table[b] = not chr(b).isalnum()
    return table


@lru_cache(1)
def _folds() -> np.ndarray:
    """The lower-case form of each code point, where it has as many bytes in UTF-8."""
    table = np.arange(0x20000)
    for c in range(0x80, 0x1F000):
        folded = chr(c).casefold()
        if len(folded) == 1 and folded != chr(c) and len(folded.encode()) == len(chr(c).encode()):
            table[c] = ord(folded)
    return table


@lru_cache(1)
def _capitals() -> np.ndarray:
    """Which code points are capital letters."""
    return np.array([chr(c).isupper() or chr(c).istitle() for c in range(0x20000)])


@lru_cache(1)
def _classes() -> np.ndarray:
    """Which code points beyond ASCII separate words (marks, symbols, spaces), and which are words alone."""
    table = np.zeros(0x20001, np.int8)
    for c in range(0x80, 0x20000):
        if unicodedata.category(chr(c))[0] in "PSZ":
            table[c] = SEPARATES
    for low, high in UNSPACED:
        own = table[low : high + 1]
        own[own == 0] = ALONE
    # Whatever is higher is a Chinese character.
    table[-1] = ALONE
    return table


def _words(data: np.ndarray, bounds: np.ndarray, at: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words, where characters of scripts without spaces are words of their own."""
    classes = _classes()
    kind = classes[np.minimum(points, len(classes) - 1)]
    if not kind.any():
        return word_spans(data, bounds, _separators())
    lead = data[at]
    size = np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4))
    marks, alone = kind == SEPARATES, kind == ALONE
    plain, borders = data.copy(), [bounds, at[alone], at[alone] + size[alone]]
    for k in range(4):
        plain[(at + k)[marks & (size > k)]] = 32
    return word_spans(plain, np.unique(np.concatenate(borders)), _separators())


def _code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the code points beyond ASCII begin, and which they are."""
    at = np.flatnonzero(data >= 0xC0)
    padded = np.append(data, np.zeros(3, np.uint8))
    lead, a, b, c = (padded[at + k].astype(np.int64) for k in range(4))
    a, b, c = a & 63, b & 63, c & 63
    two, three = (lead & 31) << 6 | a, (lead & 15) << 12 | a << 6 | b
    return at, np.where(lead < 0xE0, two, np.where(lead < 0xF0, three, (lead & 7) << 18 | a << 12 | b << 6 | c))


def _lower(data: np.ndarray, at: np.ndarray, points: np.ndarray) -> np.ndarray:
    """``data`` with the code points beyond ASCII in lower case; the hasher folds the others."""
    table = _folds()
    lower = table[np.minimum(points, len(table) - 1)]
    turned = np.flatnonzero((points < len(table)) & (lower != points))
    if not len(turned):
        return data
    data, at, lower = data.copy(), at[turned], lower[turned]
    for n, low, high, lead in ((2, 0x80, 0x800, 0xC0), (3, 0x800, 0x10000, 0xE0), (4, 0x10000, 0x20000, 0xF0)):
        own = (lower >= low) & (lower < high)
        for k in range(n):
            part = lower[own] >> 6 * (n - 1 - k)
            data[at[own] + k] = part | lead if k == 0 else part & 63 | 0x80
    return data


class Tokens:
    """Words of texts, what is known of each, and the texts' bounds; the forms are made of them."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, hasher: SpanHasher):
        self.data, self.bounds = data, bounds
        at, points = _code_points(data)
        starts, ends = _words(data, bounds, at, points)
        hashes = hasher.words(_lower(data, at, points), starts, ends)
        text = np.searchsorted(bounds, starts, side="right") - 1
        opens = np.append(True, text[1:] != text[:-1])[: len(text)]
        digit = (data >= 48) & (data <= 57)
        digits = np.append(0, np.cumsum(digit, dtype=np.int64))
        number = digits[ends] > digits[starts]
        self.bare = digits[ends] - digits[starts] == ends - starts
        lead = data[starts] if len(starts) else np.zeros(0, np.uint8)
        first = lead.astype(np.int64)
        beyond = lead >= 0xC0
        first[beyond] = points[np.searchsorted(at, starts[beyond])]
        table = _capitals()
        capital = table[np.minimum(first, len(table) - 1)]
        # A sentence starts behind . ! ? : ; or a line break, and with the text.
        stop = np.isin(data, np.frombuffer(b".!?:;\n\r|\"", np.uint8))
        stops = np.append(0, np.cumsum(stop, dtype=np.int64))
        gap = np.append(0, ends[:-1])[: len(ends)]
        sentence = opens | (stops[starts] > stops[np.minimum(gap, starts)])
        unit_hashes = _unit_hashes(hasher)
        after_number = np.append(False, number[:-1])[: len(number)] & ~opens
        unit = np.isin(hashes, unit_hashes) & after_number & ~number
        tight = (starts - gap == 1) & np.isin(data[np.maximum(starts - 1, 0)] if len(starts) else lead, list(b".,/"))
        self.starts, self.ends, self.hashes, self.text, self.opens = starts, ends, hashes, text, opens
        self.number, self.unit, self.capital, self.sentence, self.tight = number, unit, capital, sentence, tight


class Canonical:
    """Tokens of texts in one form: hash, kind (0: a word), where its value lies, and each text's first token."""

    def __init__(self, tokens: Tokens, form: int):
        self.data, self.form = tokens.data, form
        starts, ends, hashes, text, opens = tokens.starts, tokens.ends, tokens.hashes, tokens.text, tokens.opens
        number, unit, capital, sentence = tokens.number, tokens.unit, tokens.capital, tokens.sentence
        name = capital & ~sentence & ~number & ~unit
        # What opens a sentence is a name when one follows it: Tom Smith.
        name |= capital & sentence & ~number & np.append(name[1:] & ~opens[1:], False)[: len(name)]
        if form != INSIDE:
            name = capital & ~number & ~unit if form == EVERY else np.zeros(len(name), bool)
        kind = np.select([number, name, unit], [NUMBER, NAME, UNIT], 0)
        # 3,500.25 is one number, and a run of names one name.
        previous = np.append(0, kind[:-1])[: len(kind)]
        joined = ~opens & (kind == previous)
        run = joined & (((kind == NUMBER) & tokens.tight) | ((kind == NAME) & ~sentence))
        first = np.flatnonzero(~run)
        last = np.append(first[1:], len(starts))[: len(first)] - 1
        self.kind = kind[first]
        self.start, self.end = starts[first], ends[last]
        placeholder = mix(np.array([0, NUMBER, NAME, UNIT], np.uint64) + np.uint64(77))
        self.hash = np.where(self.kind > 0, placeholder[self.kind], hashes[first])
        # Each token with its value: all of its words, by their place.
        self.exact = mix(hashes[first])
        longer = np.flatnonzero(run)
        if len(longer):
            token = np.cumsum(~run) - 1
            place = (longer - first[token[longer]]).astype(np.uint64)
            np.add.at(self.exact, token[longer], mix(hashes[longer] + place))
        self.text = text[first]
        self.edges = np.searchsorted(self.text, np.arange(len(tokens.bounds)))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First token and hash of every window of ``size`` tokens; with the values where fewer than half are words."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.text[:n] == self.text[size - 1 :])
        value = self._hashes(self.hash, at, size, size + 64 * self.form)
        words = np.append(0, np.cumsum(self.kind == 0))
        count = words[at + size] - words[at]
        few = np.flatnonzero((2 * count < size) | (size < LEAST_TOKENS))
        value[few] = self._hashes(self.exact, at[few], size, size + 64 * self.form + 32)
        return at, value

    @staticmethod
    def _hashes(tokens: np.ndarray, at: np.ndarray, size: int, salt: int) -> np.ndarray:
        value = mix(tokens[at] + np.uint64(salt))
        for k in range(1, size):
            value = mix(value * np.uint64(0x9E3779B97F4A7C15) + tokens[at + k])
        return value

    def slots(self, at: int, size: int) -> list[dict]:
        """Kind, place in the window, lower-cased value and edge of the text of each placeholder."""
        found = (np.flatnonzero(self.kind[at : at + size]) + at).tolist()
        own, n = self.text[at], len(self.text)
        return [
            {
                "kind": int(self.kind[k]),
                "place": k - at,
                "value": self.data[self.start[k] : self.end[k]].tobytes().decode("utf-8", "replace").lower(),
                "edge": FIRST * bool(k == 0 or self.text[k - 1] != own) + LAST * bool(k + 1 == n or self.text[k + 1] != own),
            }
            for k in found
        ]


def _hasher() -> SpanHasher:
    return SpanHasher(51, fold_case=True)


def _unit_hashes(hasher: SpanHasher) -> np.ndarray:
    joined = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    return hasher.words(joined, *word_spans(joined, np.array([0, len(joined)])))


_SLOTS = pa.list_(pa.struct([("kind", pa.int32()), ("place", pa.int32()), ("value", pa.string()), ("edge", pa.int32())]))


def _found(
    key: pa.Array, rows: list[int], form: int, size: int, at: list[int], value: list[int], slots: list
) -> pa.RecordBatch:
    return pa.record_batch(
        [
            key.take(pa.array(rows, pa.int64())),
            pa.array([form] * len(rows), pa.int32()),
            pa.array([size] * len(rows), pa.int32()),
            pa.array(at, pa.int64()),
            pa.array(value, pa.int64()),
            pa.array(slots, _SLOTS),
        ],
        ["key", "form", "size", "place", "hash", "slots"],
    )


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = _hasher()
    for batch in batches:
        data, offsets = text_buffers(batch.column(1))
        for row in range(batch.num_rows):
            own = data[offsets[row] : offsets[row + 1]]
            words = Tokens(own, np.array([0, len(own)]), hasher)
            for form in FORMS:
                tokens = Canonical(words, form)
                size = min(WINDOW, len(tokens.hash))
                # Numbers alone are no text.
                if words.bare.all():
                    continue
                at, value = tokens.windows(size)
                n = len(at)
                if n:
                    slots = [tokens.slots(k, size) for k in at.tolist()]
                    yield _found(batch.column(0), [row] * n, form, size, at.tolist(), value.view(np.int64).tolist(), slots)


def _document_windows(known, sizes: dict[int, list[int]], bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = _hasher(), known.value
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for first, last in slices(offsets):
                base = offsets[first]
                words = Tokens(data[base : offsets[last]], offsets[first : last + 1] - base, hasher)
                for form in sizes:
                    tokens = Canonical(words, form)
                    for size in sizes[form]:
                        at, value = tokens.windows(size)
                        bit = (value & np.uint64(bits - 1)).astype(np.int64)
                        hit = np.flatnonzero(table[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
                        for k in range(0, len(hit), 4096):
                            part = hit[k : k + 4096]
                            text = tokens.text[at[part]]
                            rows, places = (text + first).tolist(), (at[part] - tokens.edges[text]).tolist()
                            slots = [tokens.slots(i, size) for i in at[part].tolist()]
                            hashes = value[part].view(np.int64).tolist()
                            yield _found(batch.column(0), rows, form, size, places, hashes, slots)

    return run


def _window_filter(windows: DataFrame) -> tuple[np.ndarray, int, dict[int, list[int]]]:
    """A bitmap of the hashes of the benchmark's windows, at most 32 MB, its bits, and the window sizes of each form."""
    found = windows.agg(F.count("*").alias("n"), F.collect_set(F.struct("form", "size")).alias("sizes")).first()
    bits = 1 << max(0, BITS_PER_WINDOW * found["n"] - 1).bit_length()
    bits = min(max(bits, LEAST_BITS), MOST_BITS)
    # A row for each byte of the bitmap that is not zero.
    bit = F.col("hash").bitwiseAND(F.lit(bits - 1))
    filled = windows.select(F.shiftright(bit, 3).alias("byte"), F.expr(f"shiftleft(1, cast((hash & {bits - 1}) & 7 AS int))").alias("flag"))
    table = np.zeros(bits >> 3, np.uint8)
    for row in filled.groupBy("byte").agg(F.bit_or("flag").alias("flags")).toLocalIterator():
        table[row["byte"]] = row["flags"]
    sizes: dict[int, list[int]] = {}
    for form, size in sorted(found["sizes"]):
        sizes.setdefault(form, []).append(size)
    return table, bits, sizes


_SEPARATED = re.compile("[" + "".join(rf"\\x{b:02x}" for b in np.flatnonzero(_separators())) + "]+")


def _plain(kind: int, value: str) -> str:
    """A value as it is compared: units by their stem, names by their words."""
    if kind == UNIT:
        return STEMS.get(value, value)
    return " ".join(_SEPARATED.split(value)).strip() if kind == NAME else value


def _without_neighbours(ours: str, theirs: str, meant: str | None, edge: int) -> str:
    """A name at an edge of the item, without the capital words beside it in the document."""
    for value in (theirs, meant):
        if value and (edge & FIRST and f" {ours}".endswith(f" {value}") or edge & LAST and f"{ours} ".startswith(f"{value} ")):
            return value
    words, n = ours.split(), max(1, len(theirs.split()))
    return " ".join(words[-n:] if edge & FIRST else words[:n])


def _longest(places: list[tuple[int, int]]) -> int:
    """Tokens of the longest run of windows, given by their first token and size, each a token behind the one before."""
    longest, begin, last = 0, 0, None
    for place, size in places:
        if last is None or place > last + 1:
            begin = place
        longest, last = max(longest, place + size - begin), place
    return longest


def _agreeing(windows: list[dict]) -> tuple[list[dict], int, int]:
    """The windows of one alignment whose values agree with what most stand for, how many values differ in them,
    and the tokens of its longest unchanged run."""
    votes: dict[tuple[int, str], dict[str, set[int]]] = {}
    pairs = []
    for w in windows:
        own = []
        for a, b in zip(w["item_slots"], w["slots"], strict=True):
            kind, theirs, ours = a["kind"], _plain(a["kind"], a["value"]), _plain(a["kind"], b["value"])
            edge = a["edge"] if kind == NAME and theirs != ours else 0
            if not edge:
                votes.setdefault((kind, theirs), {}).setdefault(ours, set()).add(w["item_place"] + a["place"])
            own.append((kind, theirs, ours, edge, a["value"] != b["value"]))
        pairs.append(own)
    # Of values that are met equally often, the unchanged one, then the first.
    meant = {k: max(v, key=lambda ours: (len(v[ours]), ours == k[1], -min(v[ours]), ours)) for k, v in votes.items()}
    agreeing, changed, same = [], set(), []
    for w, own in zip(windows, pairs, strict=True):
        differ = set()
        for kind, theirs, ours, edge, other in own:
            if edge:
                ours = _without_neighbours(ours, theirs, meant.get((kind, theirs)), edge)
                other = ours != theirs
                meant.setdefault((kind, theirs), ours)
            if ours not in (theirs, meant[kind, theirs]):
                break
            if other:
                differ.add((kind, theirs, ours))
        else:
            agreeing.append(w)
            changed |= differ
            if not differ:
                same.append((w["item_place"], w["size"]))
    return agreeing, len(changed), _longest(same)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        judged = [_agreeing(sorted(ws, key=lambda w: w["item_place"])) for ws in batch.column(3).to_pylist()]
        places = pa.array([[w["item_place"] for w in agreeing] for agreeing, _, _ in judged], pa.list_(pa.int64()))
        changed, run = (pa.array([j[k] for j in judged], pa.int64()) for k in (1, 2))
        columns = [*batch.columns[:3], places, changed, run]
        yield pa.record_batch(columns, ["doc_id", "item_id", "form", "places", "changed", "run"])


def contaminated(df: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id, item_id, item_windows, windows_found and slots_changed of every document that holds an item.

    ``df`` has doc_id and text, ``benchmark`` item_id and text; other columns are not read. A document
    holds an item when, in one of the forms, 13 tokens of it in a row are found unchanged along one alignment,
    or all of them if it has fewer, or when ``share`` of the item's template windows are found in it along
    alignments, with values that have not changed or changed as most others of the alignment did: different
    values may become equal, units are compared by their stem, and capital words beside a name at an
    edge of the item are no part of it. The counts are those of the form
    that finds most. slots_changed counts the values that differ. Null
    and empty texts hold nothing and are held by nothing, nor are items of numbers alone. Windows of
    more than half placeholders, and items of fewer than five tokens, must be found with their values. Rows with the same doc_id, or
    item_id, count as one text; rows where it is null are left out. An empty table gives no rows.
    """
    doc_type, item_type = df.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    slots = "array<struct<kind: int, place: int, value: string, edge: int>>"
    schema = "key {}, form int, size int, place bigint, hash bigint, slots " + slots
    items = benchmark.where("item_id IS NOT NULL").select("item_id", "text")
    windows = stage(items.mapInArrow(_item_windows, schema.format(item_type.simpleString())), "benchmark-windows")
    documents = df.where("doc_id IS NOT NULL").select("doc_id", "text")
    table, bits, sizes = _window_filter(windows)
    known = df.sparkSession.sparkContext.broadcast(table)
    found = documents.mapInArrow(_document_windows(known, sizes, bits), schema.format(doc_type.simpleString()))

    totals = windows.groupBy("key", "form").agg(F.countDistinct("place").alias("item_windows"), F.max(F.col("place") + F.col("size")).alias("tokens")).withColumnRenamed("key", "item_id")
    theirs = windows.select(
        F.col("key").alias("item_id"), "form", "size", "hash", F.col("place").alias("item_place"), F.col("slots").alias("item_slots")
    )
    # A window that a document repeats in one alignment only counts once.
    matched = (
        found.withColumnRenamed("key", "doc_id")
        .join(theirs, ["hash", "size", "form"])
        .where(F.size("slots") == F.size("item_slots"))
        .withColumn("alignment", F.col("place") - F.col("item_place"))
    )
    aligned = matched.groupBy("doc_id", "item_id", "form", "alignment").agg(
        F.collect_set(F.struct("item_place", "size", "item_slots", "slots")).alias("windows")
    )
    ids = f"doc_id {doc_type.simpleString()}, item_id {item_type.simpleString()}"
    judged = aligned.select("doc_id", "item_id", "form", "windows").mapInArrow(
        _judge, f"{ids}, form int, places array<bigint>, changed bigint, run bigint"
    )
    held = judged.where(F.size("places") > 0).groupBy("doc_id", "item_id", "form").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("bigint").alias("windows_found"),
        F.max("changed").cast("bigint").alias("slots_changed"),
        F.max("run").alias("run"),
    )
    # Of the forms that find the item, the one that finds most of it.
    part = F.col("windows_found") / F.col("item_windows")
    best = F.max_by(F.struct("item_windows", "windows_found", "slots_changed"), F.struct(part, -F.col("form")))
    return (
        held.join(totals, ["item_id", "form"])
        .where((F.col("windows_found") >= F.col("item_windows") * share) | (F.col("run") >= F.least(F.lit(RUN), "tokens")))
        .groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select("doc_id", "item_id", "best.*")
    )


def decontaminate(df: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """``df`` without the documents that hold a benchmark item; rows with a null doc_id stay."""
    return df.join(contaminated(df, benchmark, share).select("doc_id").distinct(), "doc_id", "left_anti").select(*df.columns)
