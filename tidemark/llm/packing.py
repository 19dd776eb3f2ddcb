"""Packing token sequences: shortest pack first over the histogram of lengths."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from itertools import compress, count, repeat
from operator import is_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ROW, batch_of, cut, freeing, ranked, text_slices, texts_of

END_ID = 1
#: Printable ASCII without letters, digits, blanks and the apostrophe, which may begin a token of letters.
MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c != 39)

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        (ROW, pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
    ]
)

_encoders: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Token ids of whole texts, by a dictionary of the words met so far.

    For tokenizers that drop white space and never join characters across it: the ids of a text are then
    those of its words in a row. Words are cut at ASCII white space and lower-cased in ASCII, which the
    tokenizer would do itself. The dictionary takes no more
    words once it holds ``max_words``, so memory is bounded; rarer words are then encoded when they are met.
    """

    def __init__(self, path: str, max_words: int = 300_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.max_words = max_words
        self.ids: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        #: Where the strings of special tokens begin; words with such a character are encoded whole.
        self.special = {t.content[:1].encode() for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.ends_word = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _encode(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in found]

    def _encode_together(self, words: list[str]) -> list[bytes]:
        """Of words that are letters only: each has one token that ends a word, its last."""
        out = []
        for at in range(0, len(words), 1000):
            part = words[at : at + 1000]
            ids = np.asarray(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            ends = (np.flatnonzero(self.ends_word[ids]) + 1) * 4
            if len(ends) != len(part) or len(ends) and ends[-1] != 4 * len(ids):
                out += self._encode(part)
                continue
            raw, first = ids.tobytes(), 0
            for end in ends.tolist():
                out.append(raw[first:end])
                first = end
        return out

    def _learn(self, missing: set[bytes]) -> dict[bytes, bytes]:
        known, new, special = self.ids, {}, self.special
        stems: list[tuple[bytes, bytes, bytes]] = []
        letters: dict[bytes, str] = {}
        others: dict[bytes, str] = {}
        for word in missing:
            # The marks after a last letter a-z are tokens of their own, so both parts are looked up alone.
            stem = word.rstrip(MARKS)
            if stem and len(stem) < len(word) and 97 <= stem[-1] <= 122 and not any(c in word for c in special):
                mark = word[len(stem) :]
                stems.append((word, stem, mark))
                if mark not in known:
                    others[mark] = mark.decode()
                word = stem
                if word in known:
                    continue
            text = word.decode("utf-8", "replace")
            (letters if text.isalpha() else others)[word] = text
        new.update(zip(letters, self._encode_together(list(letters.values())), strict=True))
        new.update(zip(others, self._encode(list(others.values())), strict=True))
        for word, stem, mark in stems:
            new[word] = (new.get(stem) or known[stem]) + (new.get(mark) or known[mark])
        return new

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        split = [t.lower().split() for t in texts]
        found = [list(map(self.ids.get, words)) for words in split]
        gaps = [list(compress(count(), map(is_, ids, repeat(None)))) if None in ids else [] for ids in found]
        missing = {words[i] for words, places in zip(split, gaps, strict=True) for i in places}
        new = self._learn(missing) if missing else {}
        if len(self.ids) < self.max_words:
            self.ids.update(new)
        for words, ids, places in zip(split, found, gaps, strict=True):
            for i in places:
                ids[i] = new[words[i]]
            yield np.frombuffer(b"".join(ids), "<u4")


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every text with the end id, cut into pieces of ``capacity`` and a rest: place, length and CRC of each."""

    @freeing
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if tokenizer_path not in _encoders:
            _encoders[tokenizer_path] = WordEncoder(tokenizer_path)
        encoder = _encoders[tokenizer_path]
        for batch in batches:
            doc_ids, rows = batch.column("doc_id").to_pylist(), batch.column(ROW).to_pylist()
            for first, last, texts in text_slices(batch, "text"):
                out = []
                for i, ids in zip(range(first, last), encoder.encode(texts), strict=True):
                    ids = np.append(ids, np.uint32(END_ID)).astype("<u4", copy=False)
                    for start in range(0, len(ids), capacity):
                        part = ids[start : start + capacity]
                        out.append((doc_ids[i], rows[i], start, len(part), zlib.crc32(part.tobytes()), len(ids)))
                yield batch_of(PIECES, **dict(zip(PIECES.names, zip(*out, strict=True), strict=True)))

    return texts_of(docs, id_col, text_col).mapInArrow(
        pieces, f"doc_id long, {ROW} long, start long, length long, ids_crc32 long, doc_tokens long"
    )


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """(number of packs, lengths in the pack) patterns that hold every item of the histogram.

    Lengths go longest first, each to the packs that are the shortest so far; if none has room, new packs open.
    Packs of one pattern are counted, not listed, so work and result depend on the lengths that occur, not
    on the number of items.
    """
    if any(not 0 < length <= capacity for length in histogram):
        raise ValueError("a length is not between 1 and the capacity")
    open_packs: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    spaces: list[int] = []

    def put(space: int, count: int, pattern: tuple[int, ...]) -> None:
        if space not in open_packs:
            open_packs[space] = []
            heapq.heappush(spaces, -space)
        open_packs[space].append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while spaces and not open_packs[-spaces[0]]:
                del open_packs[-heapq.heappop(spaces)]
            if not spaces or -spaces[0] < length:
                put(capacity - length, left, (length,))
                break
            space = -spaces[0]
            count, pattern = open_packs[space].pop()
            taken = min(left, count)
            if count > taken:
                open_packs[space].append((count - taken, pattern))
            put(space - length, taken, (*pattern, length))
            left -= taken
    return [pack for space in sorted(open_packs) for pack in open_packs[space]]


def pack_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (cut; a length column, (__row, start) as key) with sequence_id and offset.

    Only the histogram, at most ``capacity`` counts, comes to the driver. The patterns go back as a table of
    (length, range of ranks) -> place, whose size depends on ``capacity`` alone and which is broadcast.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    used = dict.fromkeys(histogram, 0)
    places, sequences = [], 0
    for count, pattern in shortest_pack_first(histogram, capacity):
        offset = 0
        for length in pattern:
            places.append((length, used[length], used[length] + count, sequences, offset))
            used[length] += count
            offset += length
        sequences += count
    frame = pd.DataFrame(places, columns=["length", "first_rank", "end_rank", "first_sequence", "offset"], dtype="int64")
    table = spark.createDataFrame(frame, "length long, first_rank long, end_rank long, first_sequence long, offset long")
    ranks = ranked(pieces, ["length"], [ROW, "start"], "rank")
    return (
        ranks.join(
            F.broadcast(table),
            (ranks["length"] == table["length"]) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank")),
        )
        .drop(table["length"])
        .withColumn("sequence_id", F.col("first_sequence") + F.col("rank") - F.col("first_rank"))
        .drop("rank", "first_rank", "end_rank", "first_sequence")
    )


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its whole text and the end id; documents longer than ``capacity`` are cut
    into full pieces and a rest. Every piece lies in one sequence, which pieces fill from 0 without gaps.
    Null and empty texts hold the end id alone. Repeated rows and null identifiers are packed like any
    other; no rows give no rows; other columns are ignored.
    """
    pieces = cut(token_pieces(docs, tokenizer_path, capacity, id_col, text_col))
    return pack_pieces(pieces, capacity).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
