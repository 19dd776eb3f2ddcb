"""Shingle sets of documents or of lines, their rarest shingles as signatures, and exact comparison of sets.

The passes over the texts that the two similarity joins share. A unit is a document or a line. Units with
equal shingle sets form a class, named by a 128-bit digest; everything after the passes moves classes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import sketch
from tidemark.llm.common import cut, freeing, text_slices
from tidemark.llm.tokens import U64, mix, powers, split_hashes, window_hashes

TOKEN_BITS = 58
NO_ID = (1 << 63) - 1

#: A unit of a document: its place, class, size, the length of the prefix that its signatures show in full (or
#: 0), how many tokens of its prefix no other prefix has, the parities of the whole set, and its signatures with their
#: place in the set's order.
UNIT = "doc long, text_hash long, line int, class binary, n int, prefix int, own int, marks array<long>, sigs array<long>, places array<int>"
#: Documents asked for by name are broadcast up to this number (some 30 bytes each), and joined by a shuffle beyond it.
BROADCAST_NAMES = 300_000


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, text_hash, text): a document is named by its identifier and a hash of its text.

    Rows that repeat both are the same document. A null identifier is the largest number, a null text is empty.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    )


DOC, TEXT_HASH = "__tm_doc", "__tm_text_hash"


def with_key(docs: DataFrame) -> DataFrame:
    """``docs`` with the name of each document (see keyed) beside its own columns, whatever those are called."""
    return docs.withColumns(
        {
            DOC: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
            TEXT_HASH: F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))),
        }
    )


def named(rows: DataFrame, *columns: str) -> DataFrame:
    """(doc, text_hash) and ``columns`` of ``rows`` under names that no column of documents has."""
    return rows.select(
        F.col("doc").alias(DOC), F.col("text_hash").alias(TEXT_HASH), *[F.col(c).alias(f"__tm_{c}") for c in columns]
    )


@dataclass
class Units:
    """Distinct shingles of units: ``tokens[offsets[i]:offsets[i + 1]]`` belong to unit i, line ``line[i]`` of text ``text[i]``."""

    text: np.ndarray
    line: np.ndarray
    words: np.ndarray
    tokens: np.ndarray
    unit: np.ndarray

    @property
    def offsets(self) -> np.ndarray:
        return np.searchsorted(self.unit, np.arange(len(self.text) + 1))


def by_unit(tokens: np.ndarray, unit: np.ndarray, units: int) -> np.ndarray:
    """The order of tokens inside each of ``units`` units: by the unit and the tokens' first bits, if that already tells all."""
    if units <= 1 << 16:
        order = np.argsort(unit.astype(U64) << U64(48) | tokens >> U64(16))
        t, u = tokens[order], unit[order]
        if not ((t[1:] < t[:-1]) & (u[1:] == u[:-1])).any():
            return order
    return np.lexsort((tokens, unit))


def shingles_of(texts: list[bytes], k: int, by_line: bool, least_words: int) -> Units:
    """All shingles of the units in no order, repeated ones too, so without offsets.

    A-Z count as a-z. A unit of fewer than ``k`` words is one shingle; one of fewer than ``least_words`` has none.
    """
    raw = b"\n".join([t.lower() for t in texts])
    hashes, places = split_hashes(raw)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    starts = begins
    if by_line:
        starts = np.concatenate(([0], np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1)) if texts else begins
    text = np.searchsorted(begins, starts, side="right") - 1
    line = np.arange(len(starts)) - np.searchsorted(starts, begins)[text]
    offsets = np.append(np.searchsorted(places, starts), len(hashes))
    words = np.diff(offsets)
    owner = np.repeat(np.arange(len(starts)), words)
    shingles = window_hashes(hashes, k)
    whole = np.ones(len(shingles), bool)
    for ahead in range(1, k):  # the last words of a unit begin no shingle of it
        last = offsets[1:] - ahead
        whole[last[(last >= 0) & (last < len(whole))]] = False
    tokens, unit = shingles[whole], owner[: len(whole)][whole]
    short = np.flatnonzero((words > 0) & (words < k) & (words >= least_words))
    if len(short):
        inside = ((words < k) & (words >= least_words))[owner]
        place = np.arange(len(hashes))[inside] - offsets[owner[inside]]
        sums = np.add.reduceat(hashes[inside] * powers(k + 1)[place + 1], np.flatnonzero(place == 0))
        tokens, unit = np.concatenate((tokens, mix(sums, 4096))), np.concatenate((unit, short))
    if least_words > k:
        keep = words[unit] >= least_words
        tokens, unit = tokens[keep], unit[keep]
    tokens >>= U64(64 - TOKEN_BITS)
    return Units(text, line, words, tokens, unit)


def units_of(texts: list[bytes], k: int, by_line: bool, least_words: int, classes: np.ndarray | None = None) -> Units:
    """The units with their distinct shingles (see shingles_of), sorted.

    With ``classes`` the frequency class of a token stands above its 58 bits, so that tokens sort from rare to frequent.
    """
    units = shingles_of(texts, k, by_line, least_words)
    tokens, unit = units.tokens, units.unit
    if classes is not None:
        tokens |= sketch.classes_of(tokens, classes).astype(U64) << U64(TOKEN_BITS)
    order = by_unit(tokens, unit, len(units.text))
    tokens, unit = tokens[order], unit[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (unit[1:] != unit[:-1])
    return Units(units.text, units.line, units.words, tokens[new], unit[new])


def digests(units: Units) -> list[bytes]:
    """128-bit names of the sets, independent of any order or class."""
    plain = units.tokens & U64((1 << TOKEN_BITS) - 1)
    out = np.zeros((len(units.text), 2), "<u8")
    offsets = units.offsets
    full = np.flatnonzero(np.diff(offsets) > 0)
    if len(full):
        for side in range(2):
            out[full, side] = mix(np.add.reduceat(mix(plain, 11 + side), offsets[full]) + np.diff(offsets)[full].astype(U64), side)
    raw = out.tobytes()
    return [raw[i : i + 16] for i in range(0, len(raw), 16)]


def parities(units: Units, words: int) -> np.ndarray:
    """(units, words): each token flips one of 64 * ``words`` bits, so two sets differ in at least as many tokens as bits."""
    plain = units.tokens & U64((1 << TOKEN_BITS) - 1)
    flip, word = U64(1) << (plain & U64(63)), (plain >> U64(6)) % U64(max(1, words))
    out = np.zeros((len(units.text), words), "<u8")
    offsets = units.offsets
    full = np.flatnonzero(np.diff(offsets) > 0)
    if len(full):
        for w in range(words):
            out[full, w] = np.bitwise_xor.reduceat(np.where(word == U64(w), flip, U64(0)), offsets[full])
    return out


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """Of sets of ``n`` tokens: two that reach the similarity share a token among that many of their first ones."""
    return n - (n * percent + 99) // 100 + (n > 0)


@dataclass(frozen=True)
class Plan:
    """``marks``: words of parities that classes carry for few_apart; 0 for none."""

    k: int = 5
    percent: int = 80
    by_line: bool = False
    least_words: int = 1
    slice_bytes: int = 1_000_000
    marks: int = 0

    def chunks(
        self, batches: Iterator[pa.RecordBatch], classes: np.ndarray | None, distinct: bool = True
    ) -> Iterator[tuple[pa.RecordBatch, int, Units]]:
        for batch in batches:
            for first, _, texts in text_slices(batch, "text", self.slice_bytes):
                if distinct:
                    yield batch, first, units_of(texts, self.k, self.by_line, self.least_words, classes)
                else:
                    yield batch, first, shingles_of(texts, self.k, self.by_line, self.least_words)


def token_classes(source: DataFrame, plan: Plan, distinct: bool = True):
    """(broadcast frequency classes, number of tokens).

    Not ``distinct``: a token counts as often as it stands in a unit. That takes no sorting by units, and moves work, never results.
    """

    @freeing
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from sketch.count_parts(u.tokens for _, _, u in plan.chunks(batches, None, distinct))

    parts = cut(source.select("text").mapInArrow(count, sketch.COUNT_TYPE))
    total = parts.agg(F.coalesce(F.sum("keys"), F.lit(0)).alias("n")).first()["n"]
    return source.sparkSession.sparkContext.broadcast(sketch.count_classes(parts)), total


def signature_units(source: DataFrame, plan: Plan, signatures: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple], all_units: bool) -> DataFrame:
    """Rows of UNIT. Signatures that no other unit has, by a count-min sketch over all of them, are left out.

    ``signatures(tokens, sizes, offsets)`` gives (unit, signature, place) of the units of a slice, units ascending,
    and the prefix length of each unit; then, if given, which of the signatures stand for one token that every unit with it in its
    prefix shows alone. Units without any remaining signature are left out as well, unless ``all_units``.
    """
    classes, total = token_classes(source, plan)
    bits, depth = sketch.width_bits(total * (100 - plan.percent) // 100 + 1), 2

    def sigs_of(units: Units):
        offsets = units.offsets
        return signatures(units.tokens, np.diff(offsets), offsets)

    @freeing
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from sketch.sketch_parts((sigs_of(u)[1] for _, _, u in plan.chunks(batches, classes.value)), bits, depth)

    found = source.sparkSession.sparkContext.broadcast(
        sketch.repeated_cells(source.select("text").mapInArrow(parts, sketch.PART_TYPE), bits, depth)
    )

    @freeing
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, first, units in plan.chunks(batches, classes.value):
            unit, sig, place, prefix, *alone = sigs_of(units)
            keep = sketch.met_twice(sig, found.value, bits)
            own = np.bincount(unit[~keep & alone[0]] if alone else unit[:0], minlength=len(units.text))
            unit, sig, place = unit[keep], sig[keep], place[keep]
            sizes = np.diff(units.offsets)
            rows = np.arange(len(sizes)) if all_units else np.unique(unit)
            if not len(rows):
                continue
            names = digests(units)
            ends = np.append(np.searchsorted(unit, rows), len(unit)).astype(np.int32)
            doc = batch.column("doc").to_numpy(zero_copy_only=False)
            text_hash = batch.column("text_hash").to_numpy(zero_copy_only=False)
            of = units.text[rows] + first
            marks = parities(units, plan.marks)[rows].reshape(-1).view(np.int64)
            mark_ends = (np.arange(len(rows) + 1) * plan.marks).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc[of]),
                    pa.array(text_hash[of]),
                    pa.array(units.line[rows].astype(np.int32)),
                    pa.array([names[r] for r in rows], pa.binary()),
                    pa.array(sizes[rows].astype(np.int32)),
                    pa.array(prefix[rows].astype(np.int32)),
                    pa.array(own[rows].astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(mark_ends), pa.array(marks)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(sig.view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(place.astype(np.int32))),
                ],
                names=["doc", "text_hash", "line", "class", "n", "prefix", "own", "marks", "sigs", "places"],
            )

    rows = cut(source.mapInArrow(emit, UNIT))
    # The written rows never ask for them again; executors would keep them for the rest of the session.
    classes.unpersist()
    found.unpersist()
    return rows


def classes_of(units: DataFrame) -> DataFrame:
    """(cid, class, first, rows, n, prefix, own, marks, sigs, places), cut: the classes of ``units``, their first unit and number of units."""
    same = [F.first(c).alias(c) for c in ("n", "prefix", "own", "marks", "sigs", "places")]
    grouped = units.filter("n > 0").groupBy("class")
    found = grouped.agg(F.min(F.struct("doc", "text_hash", "line")).alias("first"), F.count("*").alias("rows"), *same)
    return cut(found.withColumn("cid", F.monotonically_increasing_id()))


def promising(pairs: DataFrame, classes: DataFrame, percent: int, words: int = 0) -> DataFrame:
    """The rows of ``pairs`` (a, b: cid) whose prefixes have enough in common, and whose parities are near enough.

    Tokens behind the prefix that ends first are all that can be common besides the common ones of both prefixes.
    """
    rest = classes.select("cid", "n", (F.col("n") - F.col("prefix")).alias("rest"), "sigs", "marks")
    a = rest.select(*[F.col(c).alias(f"{c}_a") for c in rest.columns])
    b = rest.select(*[F.col(c).alias(f"{c}_b") for c in rest.columns])
    met = pairs.join(a, pairs["a"] == a["cid_a"]).join(b, pairs["b"] == b["cid_b"])
    common = F.size(F.array_intersect("sigs_a", "sigs_b")) + F.greatest("rest_a", "rest_b")
    near = few_apart(percent, "n_a", "marks_a", "n_b", "marks_b", words)
    return met.filter(near & ((100 + percent) * common >= percent * (F.col("n_a") + F.col("n_b")))).select(*pairs.columns)


def asked_lines(batch: pa.RecordBatch, max_bytes: int) -> Iterator[tuple[list[int], list[bytes]]]:
    """(cids, lines) of slices of about ``max_bytes``: the lines that ``lines`` (line, cid) asks for, and no others."""
    cids, held, size = [], [], 0
    texts = batch.column("text").cast(pa.large_binary())
    for text, asked in zip(texts, batch.column("lines"), strict=True):
        own = (text.as_py() or b"").split(b"\n")
        for x in asked.as_py():
            if held and size + len(own[x["line"]]) > max_bytes:
                yield cids, held
                cids, held, size = [], [], 0
            cids.append(x["cid"])
            held.append(own[x["line"]])
            size += len(held[-1])
    if held:
        yield cids, held


def class_sets(source: DataFrame, wanted: DataFrame, plan: Plan, repeated: bool) -> DataFrame:
    """(cid, set), cut, of the classes ``wanted`` (cid, first): tokens as sorted 64-bit integers.

    ``repeated``: whether rows of ``source`` may repeat a document, so that a class is read more than once.
    """
    asked = cut(
        wanted.select("cid", "first.*").groupBy("doc", "text_hash").agg(F.collect_list(F.struct("line", "cid")).alias("lines"))
    )
    few = asked.count() <= BROADCAST_NAMES
    joined = source.join(F.broadcast(asked) if few else asked, ["doc", "text_hash"]).select("text", "lines")

    @freeing
    def line_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cids, lines in asked_lines(batch, plan.slice_bytes):
                units = units_of(lines, plan.k, False, plan.least_words)
                ends = units.offsets.astype(np.int32) * 8
                found = pa.Array.from_buffers(pa.binary(), len(cids), [None, pa.py_buffer(ends), pa.py_buffer(units.tokens)])
                yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), found], names=["cid", "set"])

    @freeing
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, first, units in plan.chunks(batches, None):
            lines, offsets = batch.column("lines"), units.offsets
            begin = np.searchsorted(units.text, np.arange(int(units.text.max(initial=-1)) + 1))
            rows = [(int(begin[t]) + x["line"], x["cid"]) for t in range(len(begin)) for x in lines[first + t].as_py()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([cid for _, cid in rows], pa.int64()),
                    pa.array([units.tokens[offsets[i] : offsets[i + 1]].tobytes() for i, _ in rows], pa.binary()),
                ],
                names=["cid", "set"],
            )

    found = joined.mapInArrow(line_sets if plan.by_line else sets, "cid long, set binary")
    return cut(found.dropDuplicates(["cid"]) if repeated else found)


def similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of ``pairs`` (a, b: cid) whose sets have percent of their union in common."""

    @freeing
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                both = np.concatenate((np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")))
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                marks.append(100 * common >= percent * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(marks, pa.bool_()))

    met = pairs.join(sets.withColumnsRenamed({"cid": "a", "set": "set_a"}), "a").join(
        sets.withColumnsRenamed({"cid": "b", "set": "set_b"}), "b"
    )
    return met.select("a", "b", "set_a", "set_b").mapInArrow(verify, "a long, b long")


@dataclass(frozen=True)
class Comparison:
    """Exact comparison of classes: by their signatures first, then by sets read from the texts once more."""

    source: DataFrame
    classes: DataFrame
    plan: Plan
    repeated: bool

    def links(self, pairs: DataFrame) -> DataFrame:
        """(a, b), cut: those of ``pairs`` (a, b: cid, distinct) that are similar."""
        near = cut(promising(pairs, self.classes, self.plan.percent, self.plan.marks))
        ids = near.select(F.col("a").alias("cid")).unionByName(near.select(F.col("b").alias("cid"))).distinct()
        sets = class_sets(self.source, self.classes.join(ids, "cid").select("cid", "first"), self.plan, self.repeated)
        return cut(similar(near, sets, self.plan.percent), rows=200)


def signature_rows(classes: DataFrame, *columns: str) -> DataFrame:
    """(sig, cid, n, place, and ``columns``): a row for each signature of each class."""
    return classes.select("cid", "n", *columns, F.explode(F.arrays_zip("sigs", "places")).alias("s")).select(
        F.col("s.sigs").alias("sig"), "cid", "n", F.col("s.places").alias("place"), *columns
    )


def may_reach(percent: int, n_a: str, place_a: str, n_b: str, place_b: str) -> F.Column:
    """Length and positional filters of two sets whose first common token stands at the given places of their orders.

    Similar sets pass at the first token they share; at a later one they may fail, which loses nothing.
    """
    a, b, i, j = (F.col(c) for c in (n_a, n_b, place_a, place_b))
    return (100 * F.least(a, b) >= percent * F.greatest(a, b)) & (
        (100 + percent) * F.least(a - i, b - j) >= percent * (a + b)
    )


def not_too_many_own(percent: int, n_a: str, own_a: str, n_b: str, own_b: str) -> F.Column:
    """Filter by the tokens of each prefix that no other prefix has.

    Of two sets, all prefix tokens of the one whose prefix ends first lie before the end of the other's prefix. If they were in the
    other set, they would be in its prefix: so that set's own tokens are not common. One of the two bounds holds.
    """
    a, b = F.col(n_a) - F.col(own_a), F.col(n_b) - F.col(own_b)
    return (100 + percent) * F.greatest(a, b) >= percent * (F.col(n_a) + F.col(n_b))


def few_apart(percent: int, n_a: str, marks_a: str, n_b: str, marks_b: str, words: int) -> F.Column:
    """Filter by the parities of both sets: similar ones differ in few tokens, so in few bits.

    With i tokens in common, n_a + n_b - 2 i differ, and i is at least percent / (100 + percent) of n_a + n_b.
    Nothing similar is lost at any size; sets of several times as many tokens as bits pass nearly always. A few words
    are counted first, which is enough to part most small sets.
    """

    def within(first: int, last: int) -> F.Column:
        apart = F.lit(0)
        for w in range(first, last):
            apart = apart + F.bit_count(F.get(marks_a, w).bitwiseXOR(F.get(marks_b, w)))
        return (100 + percent) * apart <= (100 - percent) * (F.col(n_a) + F.col(n_b))

    few = min(4, words)
    return within(0, few) & within(0, words) if words > few else within(0, words)
