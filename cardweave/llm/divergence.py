"""How the sources of a language differ in the words they use.

One pass over the texts counts, for each language, in how many documents a term occurs. The terms
kept are sorted and built into minimal acyclic transducers, each over a lexicographic range of bounded size. In a
second pass the texts stream through the transducers of their languages, which turn every word into its
ordinal, and only (language, source, ordinal) counts are shuffled. The shares are then compared block
by block: a block holds a range of ordinals for all sources of a language, as many as fit a
matrix of bounded size. Ties go by ordinal, which is the order of the terms, and the few
ordinals that are reported become terms again by the transducers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardweave.llm.kernel import lower_table, slices, text_buffers, word_spans
from cardweave.llm.transducer import Transducer, build
from cardweave.storage import stage

LEAST_DOCUMENTS = 10
TOP_TERMS = 10
#: Fixed value: shares are in units of a thousand-millionth.
SHARE = 10**9
#: Bytes of terms in one transducer, and of transducers that a task holds at once: what is beyond is another pass.
PART_BYTES, HELD_BYTES = 1 << 20, 64 << 20
#: Counts (sources times ordinals) in one block, and pairs of sources that one task compares.
CELLS, PAIRS = 1 << 17, 1 << 20
#: Entries that a task adds up before it passes them on, and bytes of text.
_ENTRIES, _TEXT_BYTES = 300_000, 256 << 20

#: Terms after lower-casing: runs of a-z and of bytes outside ASCII.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_GROUP = ["lang", "source"]


def _separators() -> np.ndarray:
    table = np.ones(256, bool)
    table[97:123] = table[128:] = False
    return table


def _named(df: DataFrame) -> DataFrame:
    """lang, source and text without nulls; no other column."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents of a task each term of each language occurs."""
    counts: dict[str, Counter] = {}
    read = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, own in counts.items():
            yield pa.record_batch(
                [pa.array([lang] * len(own), pa.string()), pa.array(own.keys(), pa.binary()), pa.array(own.values(), pa.int64())],
                ["lang", "term", "n"],
            )
        counts.clear()

    for batch in batches:
        data, offsets = text_buffers(batch.column("text"))
        langs = batch.column("lang").to_pylist()
        for first, last in slices(offsets):
            for k in range(first, last):
                text = data[offsets[k] : offsets[k + 1]].tobytes().lower()
                counts.setdefault(langs[k], Counter()).update(set(_TERM.findall(text)))
            read += int(offsets[last] - offsets[first])
            if read > _TEXT_BYTES or sum(map(len, counts.values())) > _ENTRIES:
                yield from flush()
                read = 0
    yield from flush()


def kept_terms(texts: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang and term (binary) of the terms in at least so many documents of the language."""
    counts = texts.select("lang", "text").mapInArrow(_document_counts, "lang string, term binary, n bigint")
    return counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least_documents).select("lang", "term")


def _key(term: bytes) -> int:
    """The first eight bytes as a number: a term before another has no larger one."""
    return int.from_bytes(term[:8].ljust(8, b"\0"), "big")


def _parts(part_bytes: int):
    """Sorted (lang, term) to transducers, one for each language and range of at most ``part_bytes``, or a single term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, number, lang, terms, size = TaskContext.get().partitionId(), 0, None, [], 0

        def close() -> pa.RecordBatch:
            row = [lang, place, number, len(terms), terms[0][:8], terms[-1][:8], build(terms)]
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            names = ["lang", "range", "number", "n_terms", "low", "high", "content"]
            return pa.record_batch([pa.array([x], kind) for x, kind in zip(row, kinds)], names)

        for batch in batches:
            for own, term in zip(batch.column("lang").to_pylist(), batch.column("term").to_pylist()):
                if terms and (own != lang or size + len(term) > part_bytes):
                    yield close()
                    number, terms, size = number + 1, [], 0
                lang, size = own, size + len(term)
                terms.append(term)
        if terms:
            yield close()

    return run


def transducers(kept: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """lang, range, number, n_terms, low, high, content: transducers over all terms, in order of (range, number)."""
    size = kept.agg(F.sum(F.octet_length("term"))).first()[0] or 0
    dealt = kept.repartitionByRange(max(1, -(-size // part_bytes)), "lang", "term").sortWithinPartitions("lang", "term")
    schema = "lang string, range int, number int, n_terms bigint, low binary, high binary, content binary"
    return dealt.mapInArrow(_parts(part_bytes), schema)


class Vocabulary:
    """Some transducers of some languages, as a task holds them."""

    def __init__(self, rows: list[tuple[str, int, int, bytes, bytes, bytes]]):
        self.parts: dict[str, list] = {}
        for lang, base, n_terms, low, high, content in rows:
            self.parts.setdefault(lang, []).append((base, n_terms, _key(low), _key(high), Transducer(content)))

    def ordinals(self, lang: str, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Ordinals among all terms of the language, -1 for what is no term of the parts held."""
        parts = self.parts[lang]
        if len(parts) == 1:
            base, _, _, _, transducer = parts[0]
            found = transducer.ordinals(data, starts, ends)
            return np.where(found < 0, -1, found + base)
        out, key = np.full(len(starts), -1, np.int64), np.zeros(len(starts), np.uint64)
        for i in range(8):
            at = starts + i
            key = key << np.uint64(8) | np.where(at < ends, data[np.minimum(at, len(data) - 1)], 0).astype(np.uint64)
        for base, _, low, high, transducer in parts:
            own = np.flatnonzero((key >= np.uint64(low)) & (key <= np.uint64(high)))
            found = transducer.ordinals(data, starts[own], ends[own])
            out[own[found >= 0]] = found[found >= 0] + base
        return out

    def term(self, lang: str, ordinal: int) -> bytes | None:
        for base, n_terms, _, _, transducer in self.parts.get(lang, ()):
            if base <= ordinal < base + n_terms:
                return transducer.term(ordinal - base)
        return None


def _held(parts: DataFrame, held_bytes: int) -> Iterator:
    """The transducers, group by group, as broadcasts of at most ``held_bytes`` (or of one)."""
    size = F.octet_length("content").alias("size")
    index = parts.select("lang", "range", "number", "n_terms", size).orderBy("range", "number").collect()  # a row for each MiB of terms
    bases, groups, total = Counter(), [], 0
    place = {}
    for row in index:
        place[row["range"], row["number"]] = bases[row["lang"]]
        bases[row["lang"]] += row["n_terms"]
        if not groups or total + row["size"] > held_bytes:
            groups.append([])
            total = 0
        groups[-1].append((row["range"], row["number"]))
        total += row["size"]
    spark = parts.sparkSession
    for group in groups:
        ordered = F.struct("range", "number")
        bound = lambda k: F.struct(F.lit(group[k][0]).alias("range"), F.lit(group[k][1]).alias("number"))  # noqa: B023, E731
        rows = parts.where((ordered >= bound(0)) & (ordered <= bound(-1))).collect()
        yield spark.sparkContext.broadcast(
            [(r["lang"], place[r["range"], r["number"]], r["n_terms"], r["low"], r["high"], r["content"]) for r in rows]
        )


def _recounted(held):
    """Occurrences of the terms held, for each language and source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, lower, separators = Vocabulary(held.value), lower_table(), _separators()
        codes: dict[tuple[str, str], int] = {}
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def added() -> tuple[np.ndarray, np.ndarray]:
            keys, counts = (np.concatenate(x) for x in zip(*waiting))
            unique, inverse = np.unique(keys, return_inverse=True)
            total = np.zeros(len(unique), np.int64)
            np.add.at(total, inverse, counts)
            return unique, total

        def flush() -> pa.RecordBatch:
            keys, counts = added()
            group = keys >> 40
            names = list(codes)
            langs, sources = (pa.array(x, pa.string()).take(pa.array(group)) for x in zip(*names))
            ordinals = pa.array(keys & ((1 << 40) - 1), pa.int64())
            return pa.record_batch([langs, sources, ordinals, pa.array(counts, pa.int64())], ["lang", "source", "ordinal", "n"])

        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            for first, last in slices(offsets):
                base = offsets[first]
                text, bounds = lower[data[base : offsets[last]]], offsets[first : last + 1] - base
                starts, ends = word_spans(text, bounds, separators)
                row = np.searchsorted(bounds, starts, side="right") - 1
                own = [codes.setdefault(group, len(codes)) for group in zip(langs[first:last], sources[first:last])]
                code, spoken = np.array(own, np.int64), np.array(langs[first:last], object)
                for lang in set(langs[first:last]) & set(vocabulary.parts):
                    words = np.flatnonzero((spoken == lang)[row])
                    found = vocabulary.ordinals(lang, text, starts[words], ends[words])
                    known = found >= 0
                    keys, counts = np.unique(code[row[words[known]]] << 40 | found[known], return_counts=True)
                    waiting.append((keys, counts))
                    size += len(keys)
                if size > 4 * _ENTRIES:
                    waiting[:] = [added()]
                    size = len(waiting[0][0])
                    if size > 2 * _ENTRIES:
                        yield flush()
                        waiting.clear()
                        codes.clear()
                        size = 0
        if waiting:
            yield flush()

    return run


def _spelt(held):
    """item, the term, for the ordinals that are in the transducers held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(held.value)
        for batch in batches:
            items = [vocabulary.term(*x) for x in zip(batch.column("lang").to_pylist(), batch.column("ordinal").to_pylist())]
            rows = pa.array([i for i, item in enumerate(items) if item is not None], pa.int64())
            spelt = pa.array([item.decode() for item in items if item is not None], pa.string())
            yield pa.record_batch([*batch.take(rows).columns, spelt], [*batch.schema.names, "item"])

    return run


def shares(counts: np.ndarray, totals: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(SHARE * (count + 2) / (total + 2 * terms)) of rows of counts, exactly."""
    exact = np.int64 if (int(counts.max(initial=0)) + 2) * SHARE < 1 << 63 else object
    below = (totals.astype(exact) + 2 * terms)[:, None]
    return (1 + (counts.astype(exact) + 2) * SHARE // below).astype(np.int64)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); shares are at most SHARE + 1, so the square fits 64 bits."""
    return (p - q) ** 2 // (p + q)


def _compared(top_terms: int):
    """One block: counts of a range of ordinals, and the sources of the language with their totals."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = {"lang": pa.string(), "source": pa.string(), "other": pa.string(), "ordinal": pa.int64(), "value": pa.int64()}
        if not right.num_rows:
            return pa.table({name: pa.array([], kind) for name, kind in kinds.items()})
        head = right.slice(0, 1).to_pylist()[0]
        right = right.sort_by("source")
        sources = right.column("source").combine_chunks()
        first = head["block"] * head["width"]
        width = max(0, min(head["width"], head["terms"] - first))
        counts = np.zeros((len(sources), width), np.int64)
        if left.num_rows:
            where = pc.index_in(left.column("source"), sources).to_numpy()
            counts[where, left.column("ordinal").to_numpy() - first] = left.column("n").to_numpy()
        totals = right.column("total").to_numpy()
        p = shares(counts, totals, head["terms"])
        q = shares(counts.sum(axis=0)[None], np.array([head["lang_total"]]), head["terms"])[0]
        begin = head["chunk"] * head["rows"]
        rows = []
        for s in range(begin, min(begin + head["rows"], len(sources))):
            value = divergence(p[s], p).sum(axis=1)
            others = np.delete(np.arange(len(sources)), s)
            rows.append((np.full(len(others), s), others, np.full(len(others), -1), value[others]))
            telling = np.flatnonzero((counts[s] > 0) & (p[s] > q))
            f = divergence(p[s, telling], q[telling])
            best = np.argsort(-f, kind="stable")[:top_terms]
            rows.append((np.full(len(best), s), np.full(len(best), s), telling[best] + first, f[best]))
        source, other, ordinal, value = (np.concatenate(x).astype(np.int64) for x in zip(*rows))
        is_pair = pa.array(ordinal < 0)
        return pa.table(
            {
                "lang": pa.array([head["lang"]] * len(source), pa.string()),
                "source": sources.take(pa.array(source)),
                "other": pc.if_else(is_pair, sources.take(pa.array(other)), None),
                "ordinal": pa.array(ordinal, pa.int64(), mask=ordinal < 0),
                "value": pa.array(value, pa.int64()),
            }
        )

    return run


def source_divergence(
    df: DataFrame,
    least_documents: int = LEAST_DOCUMENTS,
    top_terms: int = TOP_TERMS,
    part_bytes: int = PART_BYTES,
    held_bytes: int = HELD_BYTES,
    cells: int = CELLS,
    pairs: int = PAIRS,
) -> DataFrame:
    """lang, source, part, item, value and rank: how each source differs from the others and from its language.

    ``df`` has text, lang and source; a null is the empty text, and other columns are not read. Every
    row is a document, also a repeated one. Part ``pair`` has a row for each other source of the language,
    part ``term`` the ``top_terms`` kept terms that a source uses more than its language. A
    source alone in its language has no pair, and one without kept terms no term; a language
    without kept terms has pairs of value 0. An empty table gives no rows. The last four
    parameters bound what is held at once; they change no result.
    """
    texts = _named(df)
    parts = stage(transducers(stage(kept_terms(texts, least_documents), "kept-terms"), part_bytes), "transducers")
    counts = None
    held = list(_held(parts, held_bytes))
    for group in held:
        found = texts.mapInArrow(_recounted(group), "lang string, source string, ordinal bigint, n bigint")
        counts = found if counts is None else counts.unionByName(found)
    spark = df.sparkSession
    if counts is None:
        counts = spark.createDataFrame([], "lang string, source string, ordinal bigint, n bigint")
    counts = stage(counts.groupBy(*_GROUP, "ordinal").agg(F.sum("n").alias("n")), "term-counts")

    totals = counts.groupBy(*_GROUP).agg(F.sum("n").alias("total"))
    groups = texts.groupBy(*_GROUP).agg(F.lit(0).cast("bigint").alias("none"))
    groups = groups.join(totals, _GROUP, "left").select(*_GROUP, F.coalesce("total", "none").alias("total"))
    groups = stage(groups, "groups")
    langs = groups.groupBy("lang").agg(F.count("*").alias("sources"), F.sum("total").alias("lang_total"))
    langs = langs.join(parts.groupBy("lang").agg(F.sum("n_terms").alias("terms")), "lang", "left").select(
        "lang",
        "sources",
        "lang_total",
        F.coalesce("terms", F.lit(0).cast("bigint")).alias("terms"),
        F.greatest(F.lit(1), F.lit(cells) / F.col("sources")).cast("bigint").alias("width"),
        F.greatest(F.lit(1), F.lit(pairs) / F.col("sources")).cast("bigint").alias("rows"),
    )
    langs = stage(langs, "languages")
    upto = lambda n, size: F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.lit(0).cast("bigint"), F.expr(f"({n} - 1) div {size}"))))
    # Every block and chunk knows all sources of its language.
    right = groups.join(langs, "lang").select("*", upto("terms", "width").alias("block")).select("*", upto("sources", "rows").alias("chunk"))
    left = counts.join(langs.select("lang", "sources", "width", "rows"), "lang").select(
        "lang", "source", "ordinal", "n", F.expr("ordinal div width").alias("block"), upto("sources", "rows").alias("chunk")
    )
    key = ["lang", "block", "chunk"]
    compared = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        _compared(top_terms), "lang string, source string, other string, ordinal bigint, value bigint"
    )
    compared = stage(compared, "compared")
    pair = compared.where("ordinal IS NULL").groupBy(*_GROUP, F.col("other").alias("item")).agg(F.sum("value").alias("value"))
    within = Window.partitionBy(*_GROUP).orderBy(F.desc("value"), "item")
    pair = pair.select(*_GROUP, F.lit("pair").alias("part"), "item", "value", F.row_number().over(within).alias("rank"))
    within = Window.partitionBy(*_GROUP).orderBy(F.desc("value"), "ordinal")
    top = compared.where("ordinal IS NOT NULL").select(*_GROUP, "ordinal", "value", F.row_number().over(within).alias("rank"))
    top = stage(top.where(F.col("rank") <= top_terms), "top-terms")
    for group in held:
        spelt = top.mapInArrow(_spelt(group), "lang string, source string, ordinal bigint, value bigint, rank int, item string")
        pair = pair.unionByName(spelt.select(*_GROUP, F.lit("term").alias("part"), "item", "value", "rank"))
    return pair
