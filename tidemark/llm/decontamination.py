"""Benchmark items in documents, with a budget of edits: pigeonhole pieces, then bit-parallel edit distance."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ROW, texts_of

Item = tuple[int | None, str, int]  # item_id, normalised text, edit budget

def normalise(text: str) -> str:
    return " ".join(text.lower().split())


def cut_pieces(length: int, budget: int) -> list[tuple[int, int]]:
    """(start, end) of budget + 1 pieces of nearly equal length: with at most ``budget`` edits one of them is untouched."""
    n = min(budget + 1, length)
    return [(length * i // n, length * (i + 1) // n) for i in range(n)]


class Pattern:
    """Myers' bit-parallel search of one pattern in texts; the machine word is a Python integer of any width."""

    def __init__(self, pattern: str) -> None:
        self.length = len(pattern)
        self.masks: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def best(self, text: str) -> tuple[int, int]:
        """(distance, end) of the substring of ``text`` nearest to the pattern; the first such end."""
        top, full = 1 << (self.length - 1), (1 << self.length) - 1
        plus, minus, score = full, 0, self.length
        found = (score, 0)
        masks = self.masks
        for j, c in enumerate(text):
            match = masks.get(c, 0)
            across = (((match & plus) + plus) ^ plus) | match | minus
            rise = minus | (full & ~(across | plus))
            drop = plus & across
            if rise & top:
                score += 1
            elif drop & top:
                score -= 1
            rise = (rise << 1) & full
            drop = (drop << 1) & full
            below = match | minus
            plus = drop | (full & ~(below | rise))
            minus = rise & below
            if score < found[0]:
                found = (score, j + 1)
        return found


class Scanner:
    """All items against one text."""

    def __init__(self, items: list[Item]) -> None:
        import ahocorasick

        self.items = [(item_id, text, budget, Pattern(text)) for item_id, text, budget in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text, budget) in enumerate(items):
            for start, end in cut_pieces(len(text), budget):
                places.setdefault(text[start:end], []).append((i, end))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, where)
        self.automaton.make_automaton()

    def matches(self, raw: str) -> list[tuple[int | None, int, int]]:
        """(item_id, edits, end in the normalised text) of the nearest place of every item within its budget."""
        text = normalise(raw)
        if not text:
            return []
        windows: dict[int, list[tuple[int, int]]] = {}
        for last, where in self.automaton.iter(text):
            for item, end in where:
                _, pattern, budget, _ = self.items[item]
                begin = last + 1 - end - budget
                windows.setdefault(item, []).append((max(0, begin), min(len(text), begin + len(pattern) + 2 * budget)))
        found = []
        for item, spans in sorted(windows.items()):
            item_id, _, budget, pattern = self.items[item]
            best = None
            for begin, end in joined(spans):
                edits, at = pattern.best(text[begin:end])
                if edits <= budget and (best is None or edits < best[0]):
                    best = (edits, begin + at)
            if best:
                found.append((item_id, *best))
        return found


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def items_of(benchmark: DataFrame, error_rate: float, block_chars: int) -> Iterator[list[Item]]:
    """The benchmark in blocks of about ``block_chars`` characters, so that what tasks hold is bounded."""
    known = (
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
        .filter(F.col("text").isNotNull())
        .mapInArrow(_normalised, "item_id long, text string")
        .filter("text != ''")
        .distinct()
    )
    total = known.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, ceil(total / block_chars))
    for b in range(blocks):
        part = known.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text")
        yield [(r["item_id"], r["text"], int(len(r["text"]) * error_rate)) for r in part.collect()]


def _normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [normalise(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(texts, pa.string())], names=["item_id", "text"])


def benchmark_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    error_rate: float = 0.05,
    block_chars: int = 2_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, __row, item_id, edits, end_char): each item that a document holds with at most ``error_rate`` edits a character.

    Texts and items are compared in lower case with white space as single blanks. An item of n characters may
    differ by int(n * error_rate) edits, wherever they are. It is cut into one piece more than that, so one
    piece occurs unchanged in every match; the pieces of all items are looked up in one pass over a text, and
    around each hit Myers' algorithm decides. ``edits`` and ``end_char`` (in the compared text) are those of the nearest place.

    Items are a stated query set: they come to the tasks in blocks of bounded size, each against all
    documents. Rows that differ in number or compared text are different items, so a document may have several rows with one
    item_id; the item_id of an item without number is null. Null, empty and blank items match nothing. Null and
    empty texts match nothing; repeated rows match alike (``__row`` tells them apart); no rows give no rows; other
    columns are ignored.
    """
    source = texts_of(docs, id_col, text_col)
    schema = f"doc_id long, {ROW} long, item_id long, edits int, end_char long"
    result = None
    for items in items_of(benchmark, error_rate, block_chars):
        found = source.mapInArrow(_search(items), schema)
        result = found if result is None else result.unionByName(found)
    return result


def _search(items: list[Item]):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not items:
            return
        scanner = Scanner(items)
        for batch in batches:
            out: list[tuple] = []
            for doc, text, row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", ROW)), strict=True):
                out.extend((doc, row, *match) for match in scanner.matches(text))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                    names=["doc_id", ROW, "item_id", "edits", "end_char"],
                )

    return search


def decontaminate(docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.05, block_chars: int = 2_000_000) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item (see benchmark_matches)."""
    for items in items_of(benchmark, error_rate, block_chars):
        docs = docs.mapInArrow(_without(items), docs.schema)
    return docs


def _without(items: list[Item]):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(items) if items else None
        for batch in batches:
            if scanner is None:
                yield batch
                continue
            marks = [not scanner.matches(text or "") for text in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(marks, pa.bool_()))

    return keep
