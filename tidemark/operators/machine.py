"""State machines given by a table, on stored rows.

What a machine does over a stretch of rows is a map from the state before to the state after. Maps of neighbouring
stretches compose, so a key with any number of rows is cut into segments: each gives its map, the maps are composed
along the key, and then every segment runs from the state that it is known to start in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.compose import FAN, composed, then
from tidemark.plans.scans import attach
from tidemark.plans.skew import HOT, SEGMENT, segmented
from tidemark.session import ensure_checkpoint_dir

Table = dict[tuple[str, str], tuple[str, bool]]


def run_machine(df: DataFrame, key: str, order: list[str], symbol: str, table: Table, start: str) -> DataFrame:
    """``df`` with ``state``, the state after the row, and ``alert``, whether the row's step raises one.

    Each key has a machine of its own that begins in ``start`` and takes its rows in ``order``, a total order.
    ``table`` maps (state, input) to (next state, alert); an input without an entry, null too, leads back to ``start``. A null key
    is a key like any other. The same rows as from ``streaming.processors.TableMachine``, which takes them as they arrive.
    """
    if {"state", "alert"} & set(df.columns):
        raise ValueError("the columns state and alert are taken by the result")
    states = sorted({start, *(s for s, _ in table), *(s for s, _ in table.values())})
    inputs = sorted({i for _, i in table})
    number = {s: n for n, s in enumerate(states)}
    # Row 0 is for any other input.
    step = np.full((len(inputs) + 1, len(states)), number[start], np.int64)
    alerts = np.zeros(step.shape, bool)
    for (state, given), (after, alert) in table.items():
        step[inputs.index(given) + 1, number[state]] = number[after]
        alerts[inputs.index(given) + 1, number[state]] = alert
    code = F.coalesce(F.array_position(F.array(*[F.lit(i) for i in inputs]), F.col(symbol).cast("string")), F.lit(0))

    cut = segmented(df, [key], order)
    coded = cut.frame.withColumn("__code", code.cast("int"))
    if cut.count:
        at = [key, SEGMENT]
        maps = _segment_maps(coded.where(HOT).select(*dict.fromkeys([*at, *order, "__code"])), at, order, step)
        if cut.top > FAN:
            ensure_checkpoint_dir(df.sparkSession)
            maps = maps.checkpoint()
        every = F.array(*[F.lit(s).cast("long") for s in range(len(states))])
        entering = composed(maps, [key], SEGMENT, "__map", then, every, cut.top)
        entering = entering.select(*at, F.get("__before", number[start]).alias("__enter"))
        coded = attach(coded, entering, [key], cut)
    else:
        at = [key]
        coded = coded.withColumn("__enter", F.lit(None).cast("long"))
    names = F.array(*[F.lit(s) for s in states])
    walked = _walked(coded, at, order, step, alerts, number[start])
    return walked.select(*df.columns, F.get(names, F.col("__state")).alias("state"), F.col("__alert").alias("alert"))


def _changes(batch: pa.RecordBatch, columns: list[str], last: tuple | None) -> tuple[np.ndarray, tuple | None]:
    """Positions at which a new group of ``columns`` begins, and the last row's group."""
    groups = list(zip(*(batch.column(c).to_pylist() for c in columns), strict=True))
    new = [i for i, g in enumerate(groups) if g != (groups[i - 1] if i else last)]
    return np.array(new, np.int64), groups[-1] if groups else last


def _segment_maps(rows: DataFrame, at: list[str], order: list[str], step: np.ndarray) -> DataFrame:
    """(at, __map): where each state leads over the rows of a segment. Tasks hold one map at a time."""
    schema = T.StructType([*[rows.schema[c] for c in at], T.StructField("__map", T.ArrayType(T.LongType()))])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, here, kinds = None, None, None

        def out(done: list) -> pa.RecordBatch:
            columns = list(zip(*(g for g, _ in done), strict=True))
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([*arrays, pa.array([m.tolist() for _, m in done], pa.list_(pa.int64()))], names=schema.names)

        for batch in batches:
            kinds = [batch.schema.field(c).type for c in at]
            before, (new, last) = last, _changes(batch, at, last)
            codes, done, starts = batch.column("__code").to_numpy(zero_copy_only=False), [], set(new.tolist())
            groups = list(zip(*(batch.column(c).to_pylist() for c in at), strict=True))
            for i, c in enumerate(codes):
                if i in starts:
                    if here is not None:
                        done.append((groups[i - 1] if i else before, here))
                    here = np.arange(step.shape[1])
                here = step[c][here]
            if done:
                yield out(done)
        if here is not None:
            yield out([(last, here)])

    dealt = rows.repartition(*at).sortWithinPartitions(*at, *order)
    return dealt.select(*at, "__code").mapInArrow(walk, schema)


def _walked(rows: DataFrame, at: list[str], order: list[str], step: np.ndarray, alerts: np.ndarray, start: int) -> DataFrame:
    """``rows`` with __state and __alert; each group of ``at`` begins in __enter, or in ``start`` where that is null."""
    schema = T.StructType([*rows.schema.fields, T.StructField("__state", T.IntegerType()), T.StructField("__alert", T.BooleanType())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, start
        for batch in batches:
            new, last = _changes(batch, at, last)
            enter, starts = batch.column("__enter").to_pylist(), set(new.tolist())
            states, raised = [], []
            for i, c in enumerate(batch.column("__code").to_pylist()):
                if i in starts:
                    state = start if enter[i] is None else enter[i]
                raised.append(bool(alerts[c, state]))
                state = int(step[c, state])
                states.append(state)
            columns = [*batch.columns, pa.array(states, pa.int32()), pa.array(raised, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "__state", "__alert"])

    return rows.repartition(*at).sortWithinPartitions(*at, *order).mapInArrow(walk, schema)
