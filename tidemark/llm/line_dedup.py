"""Repeated and nearly repeated lines of a corpus: an exact set-similarity join on the shingles of lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shingles import (
    DOC,
    TEXT_HASH,
    TOKEN_BITS,
    Comparison,
    Plan,
    digests,
    keyed,
    may_reach,
    named,
    prefix_length,
    signature_rows,
    token_classes,
    with_key,
)
from tidemark.llm import sketch
from tidemark.llm.common import cut, freeing
from tidemark.llm.tokens import U64, mix

#: Lines of a document that have words, at most ROW_LINES: the first one's number, and packed one after the other all their numbers, sizes,
#: classes (128 bits each) and the signatures of their prefixes, which are as long as their sizes say.
PREFIXES = "doc long, text_hash long, at int, line binary, n binary, class binary, sigs binary"
ROW_LINES = 1 << 16
#: A line that shares signatures: its place, class, size, and packed signatures with their places in the set's order.
LINE = "doc long, text_hash long, line int, high long, low long, n int, prefix binary"
#: A class that shares signatures with another: its first line, size, length of its prefix, and those signatures with their places.
SHARED = "cid long, doc long, text_hash long, line int, n int, prefix int, sigs array<long>, places array<int>"
SIGNATURE = np.dtype([("sig", "<i8"), ("place", "<i4")])


def rare_prefixes(percent: int):
    """The signatures of sets sorted from rare to frequent tokens: their prefixes."""

    def signatures(tokens: np.ndarray, sizes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        full = np.flatnonzero(sizes)
        units = np.repeat(full, sizes[full])
        place = np.arange(len(tokens)) - offsets[units]
        inside = place < prefix_length(sizes, percent)[units]
        return units[inside], mix(tokens[inside] & U64((1 << TOKEN_BITS) - 1), 5), place[inside], prefix_length(sizes, percent)

    return signatures


def unpacked(column: pa.Array, dtype: str | np.dtype) -> np.ndarray:
    """The numbers of all rows of a column of packed ones."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A column of packed numbers: row i holds ``values[ends[i]:ends[i + 1]]``."""
    at = (np.asarray(ends) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def line_prefixes(source: DataFrame, plan: Plan) -> tuple[DataFrame, int]:
    """(rows of PREFIXES, cut; a bound of the number of signatures). The texts are split into sets here, and no more."""
    classes, total = token_classes(source, plan, distinct=False)
    signatures = rare_prefixes(plan.percent)

    @freeing
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, first, units in plan.chunks(batches, classes.value):
            offsets = units.offsets
            sizes = np.diff(offsets)
            full = np.flatnonzero(sizes)
            if not len(full):
                continue
            unit, sig, _, prefix = signatures(units.tokens, sizes, offsets)
            text = units.text[full]
            opens = np.flatnonzero(np.diff(text, prepend=-1))
            number = np.arange(len(full)) - np.repeat(opens, np.diff(np.append(opens, len(full))))
            rows = np.flatnonzero(number % ROW_LINES == 0)
            ends = np.append(rows, len(full))
            of = text[rows] + first
            line = units.line[full].astype("<i4")
            names = np.frombuffer(b"".join(digests(units)), "V16")[full]
            columns = [
                pa.array(batch.column("doc").to_numpy(zero_copy_only=False)[of]),
                pa.array(batch.column("text_hash").to_numpy(zero_copy_only=False)[of]),
                pa.array(line[rows]),
                packed(line, ends),
                packed(sizes[full].astype("<i4"), ends),
                packed(names, ends),
                packed(sig, np.append(0, np.cumsum(prefix[full]))[ends]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "text_hash", "at", "line", "n", "class", "sigs"])

    rows = cut(source.mapInArrow(prefixes, PREFIXES), distinct=True)
    classes.unpersist()
    return rows, total * (100 - plan.percent) // 100 + 1


def repeated_signatures(packed_rows: DataFrame, dtype: str | np.dtype, keys: int):
    """(broadcast sketch, its bits): signatures met twice or more in the only column of ``packed_rows``, about ``keys`` in all."""
    bits, depth = sketch.width_bits(keys), 2

    @freeing
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (unpacked(batch.column(0), dtype) for batch in batches)
        yield from sketch.sketch_parts(((x if x.dtype.names is None else x["sig"]).astype(U64) for x in found), bits, depth)

    found = sketch.repeated_cells(packed_rows.mapInArrow(parts, sketch.PART_TYPE), bits, depth)
    return packed_rows.sparkSession.sparkContext.broadcast(found), bits


def sharing_lines(prefixes: DataFrame, keys: int, percent: int) -> DataFrame:
    """Rows of LINE, cut: the lines with a signature that another line has too, by a count-min sketch, and only those signatures."""
    found, bits = repeated_signatures(prefixes.select("sigs"), "<u8", keys)

    @freeing
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sig = unpacked(batch.column("n"), "<i4"), unpacked(batch.column("sigs"), "<u8")
            prefix = prefix_length(n.astype(np.int64), percent)
            unit = np.repeat(np.arange(len(n)), prefix)
            keep = sketch.met_twice(sig, found.value, bits)
            shown = np.bincount(unit[keep], minlength=len(n))
            rows = np.flatnonzero(shown)
            if not len(rows):
                continue
            held = np.empty(int(keep.sum()), SIGNATURE)
            held["sig"] = sig[keep].view("<i8")
            held["place"] = (np.arange(len(sig)) - np.repeat(np.cumsum(prefix) - prefix, prefix))[keep]
            of = np.repeat(np.arange(batch.num_rows), [len(x.as_buffer()) // 4 for x in batch.column("n")])[rows]
            names = unpacked(batch.column("class"), "<i8").reshape(-1, 2)[rows]
            columns = [
                pa.array(batch.column("doc").to_numpy(zero_copy_only=False)[of]),
                pa.array(batch.column("text_hash").to_numpy(zero_copy_only=False)[of]),
                pa.array(unpacked(batch.column("line"), "<i4")[rows]),
                pa.array(np.ascontiguousarray(names[:, 0])),
                pa.array(np.ascontiguousarray(names[:, 1])),
                pa.array(n[rows]),
                packed(held, np.append(0, np.cumsum(shown[rows]))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "text_hash", "line", "high", "low", "n", "prefix"])

    rows = cut(prefixes.drop("at").mapInArrow(lines, LINE), distinct=True)
    found.unpersist()
    return rows


def line_classes(lines: DataFrame) -> DataFrame:
    """(cid, high, low, first, rows, n, prefix), cut: the classes of equal sets, their first line and number of lines."""
    first = F.min(F.struct("doc", "text_hash", "line")).alias("first")
    found = lines.groupBy("high", "low").agg(first, F.count("*").alias("rows"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    return cut(found.withColumn("cid", F.monotonically_increasing_id()), distinct=True)


def sharing_classes(classes: DataFrame, percent: int) -> DataFrame:
    """Classes (see SHARED) as classes_of has them, cut: those with a signature that another class has too, and only those signatures.

    Most signatures that lines share are shared by copies alone. They are met once here, where a class counts once.
    """
    keys = classes.agg(F.coalesce(F.sum(F.octet_length("prefix")), F.lit(0)).alias("bytes")).first()["bytes"] // SIGNATURE.itemsize
    found, bits = repeated_signatures(classes.select("prefix"), SIGNATURE, keys)

    @freeing
    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = unpacked(batch.column("prefix"), SIGNATURE)
            unit = np.repeat(np.arange(batch.num_rows), [len(x.as_buffer()) // SIGNATURE.itemsize for x in batch.column("prefix")])
            keep = sketch.met_twice(held["sig"].astype(U64), found.value, bits)
            shown = np.bincount(unit[keep], minlength=batch.num_rows)
            rows = np.flatnonzero(shown)
            if not len(rows):
                continue
            ends, held = pa.array(np.append(0, np.cumsum(shown[rows])).astype(np.int32)), held[keep]
            n = batch.column("n").to_numpy(zero_copy_only=False)[rows]
            own = [batch.column(c).take(pa.array(rows)) for c in ("cid", "doc", "text_hash", "line")]
            columns = [
                *own,
                pa.array(n),
                pa.array(prefix_length(n.astype(np.int64), percent).astype(np.int32)),
                pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(held["sig"]))),
                pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(held["place"]))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["cid", "doc", "text_hash", "line", "n", "prefix", "sigs", "places"])

    rows = cut(classes.select("cid", "first.*", "n", "prefix").mapInArrow(shared, SHARED), distinct=True)
    found.unpersist()
    first = F.struct("doc", "text_hash", "line").alias("first")
    return rows.select("cid", first, "n", "prefix", F.lit(None).cast("array<long>").alias("marks"), "sigs", "places")


def matched_classes(rows: DataFrame, compare: Comparison, star_rounds: int) -> DataFrame | None:
    """(cid) of the classes that an earlier one is similar to; None if there are none.

    ``rows``: sig, cid, first, n, place. A star round compares the earliest class of each signature
    with the later ones and takes it out; a class that has its match asks no more, but may still be the match of
    later ones. What is left after ``star_rounds`` is compared in pairs, of which the later class has no match yet.
    """
    matched = tested = None
    for turn in range(star_rounds + 1):
        if matched is not None:
            known = matched.withColumn("done", F.lit(True))
            rows = rows.drop("done").join(known, "cid", "left").withColumn("done", F.coalesce("done", F.lit(False)))
        else:
            rows = rows.withColumn("done", F.lit(False))
        hubs = rows.groupBy("sig").agg(
            F.min(F.struct("first", "cid", "n", "place")).alias("hub"),
            F.max(F.when(~F.col("done"), F.col("first"))).alias("last_asking"),
        )
        hubs = hubs.filter(F.col("last_asking") > F.col("hub.first"))
        hubs = hubs.withColumn("hub", F.struct("hub.cid", "hub.n", "hub.place"))
        rows = cut(rows.join(hubs, "sig").filter(F.col("first") <= F.col("last_asking")).drop("last_asking"), distinct=True)
        if rows.isEmpty():
            break
        asking = F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col("place").alias("place_b")
        if turn < star_rounds:
            hub = [F.col(f"hub.{c}").alias(n) for c, n in (("cid", "a"), ("n", "n_a"), ("place", "place_a"))]
            met = rows.filter("not done").select(*hub, *asking).filter("a != b")
        else:
            left = rows.select("sig", F.col("cid").alias("a"), F.col("first").alias("first_a"), F.col("n").alias("n_a"), F.col("place").alias("place_a"))
            right = rows.filter("not done").select("sig", F.col("first").alias("first_b"), *asking)
            met = left.join(right, "sig").filter("first_a < first_b")
        pairs = met.filter(may_reach(compare.plan.percent, "n_a", "place_a", "n_b", "place_b")).select("a", "b").distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = cut(pairs)
        new = compare.links(pairs).select(F.col("b").alias("cid")).distinct()
        matched = cut(new if matched is None else matched.unionByName(new).distinct())
        tested = pairs if tested is None else tested.unionByName(pairs)
        rows = rows.filter(F.col("cid") != F.col("hub.cid")).drop("hub")
    return matched


def repeated_lines(docs: DataFrame, percent: int = 80, k: int = 5, least_words: int = 1, star_rounds: int = 2) -> DataFrame:
    """(doc, text_hash, lines): numbers of the lines of each document that an earlier line is similar to."""
    source = keyed(docs)
    plan = Plan(k, percent, by_line=True, least_words=least_words, slice_bytes=250_000)
    prefixes, keys = line_prefixes(source, plan)
    repeated = not prefixes.groupBy("doc", "text_hash", "at").count().filter("count > 1").isEmpty()
    units = sharing_lines(prefixes, keys, percent)
    classes = line_classes(units)
    shared = sharing_classes(classes, percent)
    matched = matched_classes(signature_rows(shared, "first"), Comparison(source, shared, plan, repeated), star_rounds)
    if matched is not None:
        classes = classes.join(matched.withColumn("matched", F.lit(True)), "cid", "left")
    else:
        classes = classes.withColumn("matched", F.lit(None).cast("boolean"))
    later = classes.filter("rows > 1 or matched").select("high", "low", "first", F.coalesce("matched", F.lit(False)).alias("matched"))
    place = F.struct("doc", "text_hash", "line")
    gone = units.select("doc", "text_hash", "line", "high", "low").join(later, ["high", "low"]).filter(F.col("matched") | (place != F.col("first")))
    return gone.groupBy("doc", "text_hash").agg(F.collect_set("line").alias("lines"))


def dedup_lines(docs: DataFrame, percent: int = 80, k: int = 5, least_words: int = 1, star_rounds: int = 2) -> DataFrame:
    """``docs`` with later repeats of lines taken out of ``text``, and ``__n_lines`` and ``__n_removed``.

    A line (text between line feeds) is removed if an earlier line of the corpus is similar: by number of the document, then
    place, whether or not that line was removed itself. Lines are sets of ``k``-word shingles (A-Z as
    a-z), similar at ``percent`` % of the union; a line of fewer than ``k`` words is one shingle, so it goes if the same words
    stood on an earlier line. Lines of fewer than ``least_words`` words are never touched; by default those are the blank ones. Each
    set's tokens are ordered by their rarity in the corpus; candidates share a token of their prefixes and
    pass the length and positional filters; Jaccard is then computed exactly. Lines with equal sets are one
    class and are compared once.

    A null text stays null and has no lines; an empty one has one line. Rows that repeat identifier and text keep the same
    lines. A null identifier is later than any other. No rows give no rows; other columns stay as they are.
    """
    gone = repeated_lines(docs, percent, k, least_words, star_rounds)
    # A document's numbers are few beside its text: hashed, so that texts are not sorted.
    marked = with_key(docs).join(named(gone, "lines").hint("shuffle_hash"), [DOC, TEXT_HASH], "left")
    # Inside the outer transform the split text is a value and is not split again for each line.
    whole = F.array(F.split("text", "\n", -1))

    def without(own: F.Column) -> F.Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(own) - 1), "__tm_lines")
        text = F.when(F.col("__tm_lines").isNotNull(), F.array_join(F.transform(kept, lambda i: F.get(own, i)), "\n"))
        return F.struct(F.size(own).alias("n"), text.alias("text"))

    marked = marked.withColumn("__tm_new", F.get(F.transform(whole, without), F.lit(0)))
    return marked.select(
        *[F.coalesce("__tm_new.text", "text").alias(c) if c == "text" else F.col(c) for c in docs.columns],
        F.when(F.col("text").isNull(), 0).otherwise(F.col("__tm_new.n")).cast("long").alias("__n_lines"),
        F.coalesce(F.size("__tm_lines"), F.lit(0)).cast("long").alias("__n_removed"),
    )
