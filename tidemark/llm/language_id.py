"""Languages of texts and of spans inside them: script ranges, word scores, Viterbi."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_slices, texts_of

#: Code point ranges of scripts (fixed values from the Unicode block list); index 0 is any other script.
SCRIPTS = [
    (0x0041, 0x024F), (0x1E00, 0x1EFF), (0x0370, 0x03FF), (0x1F00, 0x1FFF), (0x0400, 0x052F), (0x0530, 0x058F),
    (0x0590, 0x05FF), (0x0600, 0x077F), (0x0900, 0x097F), (0x0980, 0x09FF), (0x0B80, 0x0BFF), (0x0E00, 0x0E7F),
    (0x10A0, 0x10FF), (0x1100, 0x11FF), (0xAC00, 0xD7AF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0x20000, 0x2FFFF),
]
SCRIPT_NAMES = [1, 1, 2, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 12, 13, 14, 14]
N_SCRIPTS = 15
TABLE_BITS = 17
NOT_A_CANDIDATE = np.float32(-40.0)
UNKNOWN = "und"

_tables: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """Script number + 1 of every code point that is a letter, else 0."""
    if "letters" not in _tables:
        table = np.zeros(0x110000, np.uint8)
        for c in range(0x110000):
            if chr(c).isalpha():
                table[c] = 1
        for (first, last), script in zip(SCRIPTS, SCRIPT_NAMES, strict=True):
            part = table[first : last + 1]
            part[part > 0] = script + 1
        _tables["letters"] = table
    return _tables["letters"]


@dataclass
class Words:
    """The words (runs of letters) of some texts: doc, letters, script, and the trigram hashes of their letters."""

    doc: np.ndarray
    size: np.ndarray
    script: np.ndarray
    grams: np.ndarray
    first: np.ndarray


def words_of(texts: list[str]) -> Words:
    joined = "\n".join([t.lower() for t in texts]) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    kind = _letters()[codes]
    letter = kind > 0
    ends = np.cumsum([len(t.lower()) + 1 for t in texts])
    c = np.where(letter, codes, np.uint32(32))
    padded = np.concatenate((np.array([32], np.uint32), c, np.array([32], np.uint32)))
    h = padded[:-2] * np.uint32(0x9E3779B1) + padded[1:-1] * np.uint32(0x85EBCA77) + padded[2:] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    at = np.flatnonzero(letter)
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    starts = np.flatnonzero(begins)
    first = np.searchsorted(at, starts)
    return Words(
        np.searchsorted(ends, starts, side="right"),
        np.diff(np.append(first, len(at))),
        kind[starts] - 1 if len(starts) else np.empty(0, np.uint8),
        h[at] >> np.uint32(32 - TABLE_BITS),
        first,
    )


@dataclass
class LanguageModel:
    langs: list[str]
    table: np.ndarray  # (2 ** TABLE_BITS, languages): log probability of a letter trigram, less the best language's
    candidates: np.ndarray  # (scripts, languages): 0, or a penalty where the language does not use the script
    penalty: float

    @staticmethod
    def fit(texts: list[str], labels: list[str], penalty: float = 12.0, smoothing: float = 0.2) -> "LanguageModel":
        langs = sorted(set(labels))
        counts = np.zeros((1 << TABLE_BITS, max(1, len(langs))))
        used = np.zeros((N_SCRIPTS, max(1, len(langs))))
        for j, lang in enumerate(langs):
            own = [t for t, x in zip(texts, labels, strict=True) if x == lang]
            for at in range(0, len(own), 64):
                words = words_of(own[at : at + 64])
                counts[:, j] += np.bincount(words.grams, minlength=1 << TABLE_BITS)
                used[:, j] += np.bincount(words.script, words.size, N_SCRIPTS)
        log = np.log((counts + smoothing) / (counts.sum(0) + smoothing * counts.shape[0]))
        share = used / np.maximum(1, used.sum(0))
        fits = share >= 0.005
        fits[~fits.any(1)] = True
        return LanguageModel(
            langs, (log - log.max(1, keepdims=True)).astype(np.float32), np.where(fits, np.float32(0), NOT_A_CANDIDATE), penalty
        )

    def word_scores(self, words: Words) -> np.ndarray:
        if not len(words.first):
            return np.empty((0, len(self.langs)), np.float32)
        return np.add.reduceat(self.table[words.grams], words.first) + self.candidates[words.script]


def best_path(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of every word; ``lengths`` words belong to each text and texts are independent.

    Changing the label between neighbouring words costs ``penalty``. All texts advance together, a word a
    step: they lie end to end in lanes no longer than the longest text or a 256th of all words.
    """
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int16)
    limit = max(int(lengths.max()), -(-total // 256))
    lane, place, lanes, used = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0, limit + 1
    for i in np.argsort(-lengths, kind="stable"):
        if used + lengths[i] > limit:
            lanes, used = lanes + 1, 0
        lane[i], place[i] = lanes - 1, used
        used += int(lengths[i])
    first = np.cumsum(lengths) - lengths
    inside = np.arange(total) - np.repeat(first, lengths)
    row, col = np.repeat(place, lengths) + inside, np.repeat(lane, lengths)
    n = scores.shape[1]
    grid = np.zeros((limit, lanes, n), np.float32)
    grid[row, col] = scores
    fresh = np.zeros((limit, lanes), bool)
    fresh[place[lengths > 0], lane[lengths > 0]] = True
    fresh[0] = True
    stays = np.empty((limit, lanes, n), bool)
    best = np.empty((limit, lanes), np.int16)
    delta, index = None, np.arange(lanes)
    new_start = fresh.any(1)
    for t in range(limit):
        if t == 0:
            delta = grid[0].copy()
        else:
            floor = delta.max(1, keepdims=True) - penalty
            np.greater_equal(delta, floor, out=stays[t])
            delta = np.maximum(delta, floor)
            if new_start[t]:
                delta[fresh[t]] = 0
            delta += grid[t]
        best[t] = delta.argmax(1)
    labels = np.empty((limit, lanes), np.int16)
    state = best[-1].astype(np.int64)
    for t in range(limit - 1, 0, -1):
        labels[t] = state
        change = ~stays[t][index, state]
        if new_start[t]:
            change |= fresh[t]
        if change.any():
            state = np.where(change, best[t - 1], state)
    labels[0] = state
    return labels[row, col]


RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("lang_pred", pa.string()),
        ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("lang", pa.string())]))),
    ]
)


def label(model: LanguageModel, texts: list[bytes], slice_bytes: int = 2_000_000) -> tuple[list[str], np.ndarray, list[list[dict]]]:
    """Language, share of its letters and labelled spans of each text."""
    scores, docs, sizes, at = [], [], [], 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= slice_bytes):
            size += len(texts[end])
            end += 1
        words = words_of([t.decode("utf-8", "replace") for t in texts[at:end]])
        scores.append(model.word_scores(words))
        docs.append(words.doc + at)
        sizes.append(words.size)
        at = end
    doc, size = np.concatenate(docs), np.concatenate(sizes)
    lengths = np.bincount(doc, minlength=len(texts))
    path = best_path(np.concatenate(scores), lengths, model.penalty).astype(np.int64)
    n = len(model.langs)
    held = np.bincount(doc * n + path, size, len(texts) * n).reshape(len(texts), n)
    winner, letters = held.argmax(1), held.sum(1)
    names = [model.langs[w] if x else UNKNOWN for w, x in zip(winner, letters, strict=True)]
    share = np.where(letters > 0, held.max(1) / np.maximum(1, letters), 0.0)
    spans: list[list[dict]] = [[] for _ in texts]
    if len(doc):
        edges = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (path[1:] != path[:-1]))))
        before = np.cumsum(lengths) - lengths
        for a, b in zip(edges, np.append(edges[1:], len(doc)), strict=True):
            d = int(doc[a])
            spans[d].append({"first_word": int(a - before[d]), "last_word": int(b - 1 - before[d]), "lang": model.langs[path[a]]})
    return names, share, spans


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, max_rows: int = 2_000) -> LanguageModel:
    """A model of all non-null ``lang`` values, of about ``max_rows`` rows of each that are not held out, drawn by a hash of doc_id.

    A language with no more rows gives all of them, so however rare it is, it is learned.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    )
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000_000)) * F.col("n") < 1_000_000_000 * max_rows
    sample = known.join(F.broadcast(counts), "lang").filter((F.col("n") <= max_rows) | drawn)
    found = sample.orderBy("doc_id", "lang", "text").select("text", F.col("lang").cast("string")).toArrow()
    return LanguageModel.fit(found.column("text").to_pylist(), found.column("lang").to_pylist())


def identify(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 12_000_000
) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score, spans, from the whole text alone.

    A word's script narrows the languages, its letter trigrams score them, and Viterbi chooses one label per
    word, so that a text of several languages falls into spans (first and last word, words being runs of
    letters). lang_pred is the language with most letters, score its share of them. Null, empty and letterless
    texts, and any text if the model knows no language, are ``und`` with score 0 and no spans. Repeated rows
    agree; no rows give no rows; other columns are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for first, last, texts in text_slices(batch, "text", batch_bytes):
                if model.langs:
                    names, share, spans = label(model, texts)
                else:
                    names, share, spans = [UNKNOWN] * len(texts), np.zeros(len(texts)), [[] for _ in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, last - first),
                        pa.array(names, pa.string()),
                        pa.array(share),
                        pa.array(spans, RESULT.field("spans").type),
                    ],
                    schema=RESULT,
                )

    return (
        texts_of(docs, id_col, text_col)
        .select("doc_id", "text")
        .mapInArrow(
            work,
            "doc_id long, lang_pred string, score double, "
            "spans array<struct<first_word: long, last_word: long, lang: string>>",
        )
    )
