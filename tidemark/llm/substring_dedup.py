"""Passages that occur earlier in the corpus: a count-min prefilter, then exact groups of word windows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import sketch
from tidemark.llm.common import text_slices
from tidemark.llm.shingles import NO_ID, keyed
from tidemark.llm.tokens import U64, mix, text_word_hashes, window_hashes

GRAM = 8
RUNS = "bucket long, kind int, doc binary, text_hash binary, start binary, size binary, anchor binary, keys binary"
RUN_NAMES = ["bucket", "kind", "doc", "text_hash", "start", "size", "anchor", "keys"]
CHECK, MARK = 0, 1
#: Windows of an anchor whose count has more bits than that are dealt to buckets one by one.
HOT_BITS = 10


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` neighbours the place of the smallest, the first of equal ones."""
    at, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        a, b = at[: len(at) - step], at[step:]
        at = np.where(values[b] < values[a], b, a)
        span += step
    return at


def windows(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, anchor hash, anchor place, hash) of all windows of ``size`` words that lie in one text.

    A window's anchor is the smallest of the hashes of its runs of a few words, so equal windows have equal
    anchors, and neighbouring windows mostly share theirs.
    """
    gram = min(GRAM, size)
    words, offsets = text_word_hashes(texts)
    counts = np.maximum(np.diff(offsets) - size + 1, 0)
    text = np.repeat(np.arange(len(texts)), counts)
    start = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    if not len(text):
        return text, start, np.empty(0, U64), np.empty(0, np.int64), np.empty(0, U64)
    at = offsets[text] + start
    grams = window_hashes(words, gram, 1)
    place = leftmost_minima(grams, size - gram + 1)[at]
    return text, start, grams[place], place, window_hashes(words, size, 2)[at]


def _runs(doc, text_hash, start, *same):
    """First indices and lengths of runs of windows that follow one another in a document and agree in each of ``same``."""
    new = np.ones(len(start), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (text_hash[1:] != text_hash[:-1]) | (start[1:] != start[:-1] + 1)
    for x in same:
        new[1:] |= x[1:] != x[:-1]
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(start)))


def covered_words(
    docs: DataFrame, size: int = 20, id_col: str = "doc_id", text_col: str = "text", most_bits: int = 27, per_bucket: int = 50_000,
    slice_bytes: int = 4_000_000, hot_bits: int = HOT_BITS,
) -> DataFrame:
    """(doc, text_hash, start, words): runs of words covered by a window whose words also start earlier."""
    source = keyed(docs, id_col, text_col)
    spark = source.sparkSession
    n_bytes = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    anchors = n_bytes // 40 + 1  # about six bytes a word, an anchor for seven windows; only sizes depend on it
    bits, depth = sketch.width_bits(anchors, most=most_bits), 2
    buckets = max(16, ceil(anchors / per_bucket))

    def met_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for _, _, texts in text_slices(batch, "text", slice_bytes):
                text, _, anchor, place, _ = windows(texts, size)
                new = np.ones(len(text), bool)
                new[1:] = place[1:] != place[:-1]  # places are those of the slice, so texts differ as well
                yield anchor[new]

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from sketch.sketch_parts(met_anchors(batches), bits, depth)

    found = spark.sparkContext.broadcast(
        sketch.repeated_cells(source.select("text").mapInArrow(parts, sketch.PART_TYPE), bits, depth)
    )

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from sketch.count_parts(met_anchors(batches))

    classes = spark.sparkContext.broadcast(sketch.count_classes(source.select("text").mapInArrow(counts, sketch.COUNT_TYPE)))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_of = batch.column("doc").to_numpy(zero_copy_only=False)
            hashes_of = batch.column("text_hash").to_numpy(zero_copy_only=False)
            for first, last, texts in text_slices(batch, "text", slice_bytes):
                text, start, anchor, _, key = windows(texts, size)
                keep = sketch.met_twice(anchor, found.value, bits)
                if not keep.any():
                    continue
                doc, text_hash = docs_of[first:last][text[keep]], hashes_of[first:last][text[keep]]
                hot = sketch.classes_of(anchor[keep], classes.value) > hot_bits
                yield from _emitted(doc, text_hash, start[keep], anchor[keep], key[keep], hot, buckets)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["bucket"] != held[0]["bucket"]:
                    yield from _judged(held, size)
                    held = []
                held.append(row)
        if held:
            yield from _judged(held, size)

    return (
        source.mapInArrow(emit, RUNS)
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(judge, "doc long, text_hash long, start int, words int")
    )


def _emitted(doc, text_hash, start, anchor, key, hot, buckets: int) -> Iterator[pa.RecordBatch]:
    """Of the windows of a slice: the first place of each, to be checked elsewhere; marks for all later ones.

    So of a window that is everywhere a bucket gets one entry for each slice. Windows are dealt by their anchor, which keeps
    neighbours in one entry; those of a ``hot`` anchor by their key as well, as only equal windows must meet.
    """
    order = np.lexsort((start, text_hash, doc, key, anchor))
    doc, text_hash, start, anchor, key, hot = (x[order] for x in (doc, text_hash, start, anchor, key, hot))
    new = np.ones(len(doc), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (key[1:] != key[:-1])
    group = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (doc != doc[group]) | (text_hash != text_hash[group]) | (start != start[group])
    rows: list[tuple] = []

    # marks, as runs of windows, dealt by document
    d, h, s = doc[later], text_hash[later], start[later]
    o = np.lexsort((s, h, d))
    d, h, s = d[o], h[o], s[o]
    if len(d):
        keep = np.ones(len(d), bool)
        keep[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1]) | (s[1:] != s[:-1])
        d, h, s = d[keep], h[keep], s[keep]
        first, length = _runs(d, h, s)
        bucket = (mix(d[first].view(U64)) % U64(buckets)).astype(np.int64)
        rows += _packed(bucket, MARK, d[first], h[first], s[first], length, np.zeros(len(first), U64), None)

    d, h, s, a, k, hot = doc[new], text_hash[new], start[new], anchor[new], key[new], hot[new]
    o = np.lexsort((s, h, d))
    d, h, s, a, k, hot = d[o], h[o], s[o], a[o], k[o], hot[o]
    dealt = mix(a, 3)
    bucket = (np.where(hot, mix(dealt ^ k, 4), dealt) % U64(buckets)).astype(np.int64)
    first, length = _runs(d, h, s, a, bucket)
    rows += _packed(bucket[first], CHECK, d[first], h[first], s[first], length, a[first], (first, k))
    columns = list(zip(*rows, strict=True))
    types = [pa.int64(), pa.int32(), *[pa.binary()] * 6]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=RUN_NAMES)


def _packed(bucket, kind, doc, text_hash, start, length, anchor, keys) -> list[tuple]:
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.concatenate(([True], np.diff(bucket[order]) != 0)))
    rows = []
    for x, y in zip(edges, np.append(edges[1:], len(order)), strict=True):
        i = order[x:y]
        packed = b"" if keys is None else np.concatenate([keys[1][f : f + n] for f, n in zip(keys[0][i], length[i], strict=True)]).tobytes()
        rows.append(
            (int(bucket[i[0]]), kind, doc[i].astype("<i8").tobytes(), text_hash[i].astype("<i8").tobytes(), start[i].astype("<u4").tobytes(),
             length[i].astype("<u4").tobytes(), anchor[i].tobytes(), packed)
        )
    return rows


def _judged(held: list[dict], size: int) -> Iterator[pa.RecordBatch]:
    """Runs of words to remove, from all entries of a bucket: windows that also have a smaller place."""

    def column(rows, name, kind):
        return np.frombuffer(b"".join(r[name] for r in rows), kind)

    def out(doc, text_hash, start, length):
        return pa.RecordBatch.from_arrays(
            [pa.array(doc), pa.array(text_hash), pa.array(start.astype(np.int32)), pa.array((length + size - 1).astype(np.int32))],
            names=["doc", "text_hash", "start", "words"],
        )

    marks = [r for r in held if r["kind"] == MARK]
    if marks:
        yield out(*(column(marks, n, t) for n, t in (("doc", "<i8"), ("text_hash", "<i8"), ("start", "<u4"), ("size", "<u4"))))
    rows = [r for r in held if r["kind"] == CHECK]
    if not rows:
        return
    length = column(rows, "size", "<u4").astype(np.int64)
    doc, text_hash, anchor = (np.repeat(column(rows, n, t), length) for n, t in (("doc", "<i8"), ("text_hash", "<i8"), ("anchor", "<u8")))
    inside = np.arange(len(doc)) - np.repeat(np.cumsum(length) - length, length)
    start = np.repeat(column(rows, "start", "<u4"), length) + inside
    key = column(rows, "keys", "<u8")
    order = np.lexsort((start, text_hash, doc, key, anchor))
    doc, text_hash, start, anchor, key = (x[order] for x in (doc, text_hash, start, anchor, key))
    new = np.ones(len(doc), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (key[1:] != key[:-1])
    group = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (doc != doc[group]) | (text_hash != text_hash[group]) | (start != start[group])
    doc, text_hash, start = doc[later], text_hash[later], start[later]
    if len(doc):
        order = np.lexsort((start, text_hash, doc))
        doc, text_hash, start = doc[order], text_hash[order], start[order]
        first, runs = _runs(doc, text_hash, start)
        yield out(doc[first], text_hash[first], start[first], runs)


def kept_words(text: bytes, spans: list[dict] | None) -> tuple[int, int, bytes]:
    """(words, removed words, the other words joined by blanks)."""
    words = text.split()
    if not spans:
        return len(words), 0, b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int32)
    np.add.at(gone, [s["start"] for s in spans], 1)
    np.add.at(gone, [s["start"] + s["words"] for s in spans], -1)
    keep = np.cumsum(gone[:-1]) == 0
    kept = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
    return len(words), len(words) - len(kept), b" ".join(kept)


def dedup_substrings(docs: DataFrame, size: int = 20, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept (the words left, joined by blanks).

    A word is removed if a window of ``size`` consecutive words covers it whose words also start at an earlier place: in a
    document of smaller number, or before in the same one. Windows are judged on the input. First pass: every partition
    sketches the anchors of its windows; the merged sketch never estimates less than the true number.
    Second pass: windows whose anchor is estimated once are unique and go no further; the others are grouped
    exactly, by 128 bits of hashes, in buckets whose number follows the size of the data. Anchors counted more than
    2 ** ``hot_bits`` times have their windows spread over all buckets; that moves work, never results.

    The merged sketch is 2 * 2 ** most_bits bits (32 MB) at most. Beyond some hundred million anchors it lets more
    windows pass, which costs work and loses none. Null and empty texts have no words. Rows that repeat
    identifier and text lose the same words, and are no repeats of each other. A null identifier is later than any other. No rows give no
    rows; other columns are ignored.
    """
    gone = covered_words(docs, size, id_col, text_col, **options)
    spans = gone.groupBy("doc", "text_hash").agg(F.collect_list(F.struct("start", "words")).alias("spans"))
    marked = keyed(docs, id_col, text_col).join(spans, ["doc", "text_hash"], "left").select("doc", "text", "spans")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in text_slices(batch, "text", 8_000_000):
                found = batch.column("spans").slice(first, last - first).to_pylist()
                rows = [kept_words(t, s) for t, s in zip(texts, found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc").slice(first, last - first),
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([r[1] for r in rows], pa.int64()),
                        pa.array([r[2].decode("utf-8", "replace") for r in rows], pa.string()),
                        pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string()),
                    ],
                    names=["doc", "n_words", "n_removed", "kept", "kept_sha256"],
                )

    return marked.mapInArrow(clean, "doc long, n_words long, n_removed long, kept string, kept_sha256 string").select(
        F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), "n_words", "n_removed", "kept", "kept_sha256"
    )
