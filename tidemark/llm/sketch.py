"""Count-min sketches over partitions: which cells were met at least twice in the whole data."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch_rows
from tidemark.llm.tokens import U64, mix

BLOCK_BITS = 16
PART_TYPE = "line int, block int, once binary, more binary"
PART_SCHEMA = pa.schema([("line", pa.int32()), ("block", pa.int32()), ("once", pa.binary()), ("more", pa.binary())])


def cells(keys: np.ndarray, line: int, bits: int) -> np.ndarray:
    return (mix(keys, 77 + line) >> U64(64 - bits)).astype(np.int64)


def width_bits(keys: int, least: int = 18, most: int = 27) -> int:
    """Bits of the width for about that many keys: four cells a key, but never more than 2 ** most.

    Beyond that the sketch gets fuller and lets more keys pass; it never loses one.
    """
    return int(min(most, max(least, np.ceil(np.log2(max(1, keys) * 4)))))


def sketch_parts(key_chunks: Iterator[np.ndarray], bits: int, depth: int, held: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """The sketch of the keys of a partition, as sparse blocks: cells met once, and cells met more often.

    Keys are gathered up to ``held`` and then given out, so memory does not depend on the partition's size.
    """
    gathered, n = [], 0
    for keys in key_chunks:
        gathered.append(keys)
        n += len(keys)
        if n >= held:
            yield from _blocks(np.concatenate(gathered), bits, depth)
            gathered, n = [], 0
    if n:
        yield from _blocks(np.concatenate(gathered), bits, depth)


def _blocks(keys: np.ndarray, bits: int, depth: int) -> Iterator[pa.RecordBatch]:
    for line in range(depth):
        at = np.sort(cells(keys, line, bits))
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        counts = np.diff(np.append(first, len(at)))
        at = at[first]
        blocks = at >> BLOCK_BITS
        edges = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1])))
        once, more = [], []
        inner = (at & ((1 << BLOCK_BITS) - 1)).astype("<u2")
        for a, b in zip(edges, np.append(edges[1:], len(at)), strict=True):
            single = counts[a:b] == 1
            once.append(inner[a:b][single].tobytes())
            more.append(inner[a:b][~single].tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(edges), line, np.int32)),
                pa.array(blocks[edges].astype(np.int32)),
                pa.array(once, pa.binary()),
                pa.array(more, pa.binary()),
            ],
            schema=PART_SCHEMA,
        )


def _merged(blocks: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    line, block, bits = zip(*blocks, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(line, pa.int32()), pa.array(block, pa.int32()), pa.array(bits, pa.binary())], names=["line", "block", "bits"])


def repeated_cells(parts: DataFrame, bits: int, depth: int) -> np.ndarray:
    """(depth, 2 ** bits / 8) bits: whether a cell was met at least twice. ``parts`` holds rows of sketch_parts.

    Blocks are merged by the tasks they are dealt to, one block at a time; the driver gets depth * 2 ** bits / 8 bytes.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, count = None, np.zeros(1 << BLOCK_BITS, np.uint8)

        def done() -> tuple[int, int, bytes]:
            return (*at, np.packbits(count > 1, bitorder="little").tobytes())

        for batch in batches:
            line, block = (batch.column(i).to_numpy() for i in range(2))
            opens = np.flatnonzero(np.concatenate(([True], (line[1:] != line[:-1]) | (block[1:] != block[:-1])))) if len(line) else []
            once, more, ended = batch.column(2), batch.column(3), []
            for a, b in zip(opens, [*opens[1:], len(line)], strict=True):
                here = int(line[a]), int(block[a])
                if here != at:
                    if at is not None:
                        ended.append(done())
                    at = here
                    count[:] = 0
                single = np.frombuffer(b"".join(once[a:b].to_pylist()), "<u2")
                count += np.minimum(np.bincount(single, minlength=len(count)), 2).astype(np.uint8)
                count[np.frombuffer(b"".join(more[a:b].to_pylist()), "<u2")] = 2
                np.minimum(count, 2, out=count)
            if ended:
                yield _merged(ended)
        if at is not None:
            yield _merged([done()])

    out = np.zeros((depth, max(1, (1 << bits) // 8)), np.uint8)
    step = (1 << BLOCK_BITS) // 8
    dealt = parts.repartition(F.col("line"), F.col("block")).sortWithinPartitions("line", "block")
    merged = dealt.mapInArrow(merge, "line int, block int, bits binary")
    with batch_rows(parts.sparkSession, 1_000):
        blocks = merged.collect()
    for r in blocks:  # at most depth * 2 ** (bits - BLOCK_BITS) rows of 8 KB
        out[r["line"], r["block"] * step : (r["block"] + 1) * step] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def met_twice(keys: np.ndarray, found: np.ndarray, bits: int) -> np.ndarray:
    """Which keys have an estimate of two or more."""
    passed = np.ones(len(keys), bool)
    for line in range(len(found)):
        at = cells(keys, line, bits)
        passed &= (found[line][at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return passed


COUNT_BITS = 22
COUNT_TYPE = "block int, cells binary, counts binary, keys long"


def count_parts(key_chunks: Iterator[np.ndarray], held: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Counts of keys met more than once among ``held`` neighbouring keys, by cell, as sparse blocks.

    Rare keys, nearly all of them, leave nothing behind, so cells tell the frequent ones apart. ``keys`` counts all.
    """
    gathered, n = [], 0
    for keys in key_chunks:
        gathered.append(keys)
        n += len(keys)
        if n >= held:
            yield _counts(np.concatenate(gathered))
            gathered, n = [], 0
    if n:
        yield _counts(np.concatenate(gathered))


def _counts(keys: np.ndarray) -> pa.RecordBatch:
    ordered = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    counts = np.diff(np.append(first, len(ordered)))
    again = counts > 1
    at, counts = cells(ordered[first[again]], 0, COUNT_BITS), counts[again].astype("<u4")
    order = np.argsort(at >> BLOCK_BITS, kind="stable")
    at, counts = at[order], counts[order]
    blocks = at >> BLOCK_BITS
    edges = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1]))) if len(at) else np.empty(0, np.int64)
    inner = (at & ((1 << BLOCK_BITS) - 1)).astype("<u2")
    ends = np.append(edges[1:], len(at)) if len(at) else edges
    rows = [(-1, b"", b"", len(keys))]
    rows += [(int(blocks[a]), inner[a:b].tobytes(), counts[a:b].tobytes(), 0) for a, b in zip(edges, ends, strict=True)]
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.int64())],
        names=["block", "cells", "counts", "keys"],
    )


def count_classes(parts: DataFrame) -> np.ndarray:
    """For each of 2 ** COUNT_BITS cells the number of bits of its count: 4 MB, whatever the size of the data."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, at, counts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if block not in held:
                    held[block] = np.zeros(1 << BLOCK_BITS, np.int64)
                np.add.at(held[block], np.frombuffer(at, "<u2"), np.frombuffer(counts, "<u4").astype(np.int64))
        if held:
            sizes = [np.where(v > 0, np.ceil(np.log2(v + 1)), 0).astype(np.uint8).tobytes() for v in held.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(sizes, pa.binary())], names=["block", "bits"])

    out = np.zeros(1 << COUNT_BITS, np.uint8)
    step = 1 << BLOCK_BITS
    for r in parts.filter("block >= 0").repartition("block").mapInArrow(merge, "block int, bits binary").collect():
        out[r["block"] * step : (r["block"] + 1) * step] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def classes_of(keys: np.ndarray, classes: np.ndarray) -> np.ndarray:
    return classes[cells(keys, 0, COUNT_BITS)]
