"""Bounded-space online packing of token sequences."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, filterfalse, islice
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from linenet.llm import text as T
from linenet.llm.scratch import written

if TYPE_CHECKING:
    from tokenizers import Tokenizer

CACHED_WORDS = 300_000
APART = "\x01"
# Letters of Latin-1, then marks that no letter joins.
LETTERS = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([.,;:!?]*)")
TEXT_BYTES = 1 << 20


class Words(dict):
    """The ids of words asked for earlier, and, in ``now``, of those asked for now that had no room."""

    now: dict[bytes, bytes]

    def __missing__(self, word: bytes) -> bytes:
        return self.now[word]


@dataclass
class Vocabulary:
    """A tokenizer, the ids of words it was asked for, and, where ``plain`` words can be asked for together, which ids end one."""

    tokenizer: Tokenizer
    known: Words
    plain: re.Pattern | None
    ends: np.ndarray


@lru_cache(maxsize=1)
def _vocabulary(path: str) -> Vocabulary:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    told = json.loads(tokenizer.to_str())
    suffix = told["model"].get("end_of_word_suffix")
    # Letters are split from marks, case is dropped, and the last id of each letter run is one that ends a word.
    apart = suffix and '"Lowercase"' in json.dumps(told["normalizer"]) and "[\\\\p{L}]+" in json.dumps(told["pre_tokenizer"])
    ends = np.zeros(tokenizer.get_vocab_size() + 1, bool)
    ends[[i for w, i in tokenizer.get_vocab().items() if suffix and w.endswith(suffix)]] = True
    return Vocabulary(tokenizer, Words(), LETTERS if apart else None, ends)


def _cut_at(ids: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[bytes]:
    body = ids.tobytes()
    return [body[4 * i : 4 * j] for i, j in zip(first.tolist(), last.tolist())]


def _asked(vocabulary: Vocabulary, words: list[bytes]) -> dict[bytes, bytes]:
    """The ids of words of any kind."""
    encode, found = vocabulary.tokenizer.encode, {}
    # Many words at once, with a control character between them; its id comes from no other word.
    some, odd = [w for w in words if APART.encode() not in w], [w for w in words if APART.encode() in w]
    (apart,) = encode(APART, add_special_tokens=False).ids
    for at in range(0, len(some), 1000):
        part = some[at : at + 1000]
        (told,) = vocabulary.tokenizer.encode_batch_fast([f" {APART} ".encode().join(part).decode()], add_special_tokens=False)
        ids = np.array(told.ids, "<u4")
        cuts = np.flatnonzero(ids == apart)
        found.update(zip(part, _cut_at(ids, np.append(0, cuts + 1), np.append(cuts, len(ids)))))
    for word in odd:
        found[word] = np.array(encode(word.decode(), add_special_tokens=False).ids, "<u4").tobytes()
    return found


def _asked_plain(vocabulary: Vocabulary, words: list[bytes]) -> dict[bytes, bytes]:
    """The ids of words of letters: one after another, a word ends with an id that ends one."""
    found = {}
    for at in range(0, len(words), 1000):
        part = words[at : at + 1000]
        (told,) = vocabulary.tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)
        ids = np.array(told.ids, "<u4")
        stop = np.flatnonzero(vocabulary.ends[ids]) + 1
        found.update(zip(part, _cut_at(ids, np.append(0, stop[:-1]), stop)))
    return found


def token_ids(texts: list[bytes], path: str) -> list[bytes]:
    """The ids of every text, as little-endian unsigned 32-bit numbers.

    The tokenizer drops white space and never looks across it, so ids of a text are those of its
    words one after another; each word is asked for once, and up to 300 000 are remembered (the
    number changes the time, not the result). Where the vocabulary splits letters from marks, a word with marks behind it is
    put together from both.
    """
    vocabulary = _vocabulary(path)
    known, plain = vocabulary.known, vocabulary.plain
    cut = [t.split() for t in texts]
    unknown = lambda words: set(filterfalse(known.__contains__, words))
    new = unknown(set(chain.from_iterable(cut)))
    parts = {w: (m[1].lower(), m[2]) for w in new if (m := plain.fullmatch(w))} if plain else {}
    letters = unknown(core for core, _ in parts.values())
    others = unknown({tail for _, tail in parts.values() if tail}.union(new.difference(parts)))
    known.now = {**_asked(vocabulary, list(others)), **_asked_plain(vocabulary, list(letters))}
    known.now |= {w: known[core] + (known[tail] if tail else b"") for w, (core, tail) in parts.items()}
    room = CACHED_WORDS - len(known)
    if room > 0:
        known.update(islice(known.now.items(), room))
    return [b"".join(map(known.__getitem__, ws)) for ws in cut]


class Windows:
    """A fixed number of open windows; a window holds pieces and is closed when it leaves."""

    def __init__(self, size: int, most: int) -> None:
        self.size, self.most, self.open = size, most, []

    def place(self, length: int) -> tuple[list | None, list | None]:
        """The window for a piece, by best fit, and the window that had to leave for it, if any."""
        fits = [w for w in self.open if w[0] + length <= self.size]
        if fits:
            return max(fits, key=lambda w: w[0]), None
        gone = None
        if len(self.open) >= self.most:
            gone = max(self.open, key=lambda w: w[0])
            self.open.remove(gone)
        self.open.append([0, []])
        return self.open[-1], gone

    def put(self, piece: tuple, length: int) -> list | None:
        """Place a piece; returns a window that is full or had to leave."""
        window, gone = self.place(length)
        window[0] += length
        window[1].append(piece)
        if window[0] == self.size:
            self.open.remove(window)
            if gone is None:
                return window
            self.open.append(window)
        return gone


FIELDS = ["start", "length", "ids_crc32", "doc_tokens", "offset"]


def _rows(ids: list, windows: list[tuple[int, bool, list]], kind: pa.DataType) -> pa.RecordBatch:
    """One row for each piece: document, fields, the window's number and whether it is closed."""
    doc, fields, number, closed = [], [[] for _ in FIELDS], [], []
    for n, done, (_, pieces) in windows:
        at = 0
        for piece in pieces:
            doc.append(piece[0])
            for out, value in zip(fields, (*piece[1:], at)):
                out.append(value)
            number.append(n)
            closed.append(done)
            at += piece[2]
    columns = [pa.array(doc, kind), *[pa.array(f, pa.int64()) for f in fields], pa.array(number, pa.int64()), pa.array(closed, pa.bool_())]
    return pa.record_batch(columns, names=["doc_id", *FIELDS, "window", "closed"])


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, size: int = 4096, open_windows: int = 64, least_cut: int = 64, merge: int = 32) -> DataFrame:
    """``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id`` and ``offset`` of every piece.

    A task takes its documents as they come. Whole windows are cut off a long document; the rest goes to the
    fullest of the open windows it fits in. If it fits in none, the fullest is filled with the beginning of
    the rest where its gap and what remains are ``least_cut`` ids or more, and leaves. Windows still open at the end of a
    task are merged piece by piece, by the same rule but without further cuts, ``merge`` tasks'
    leftovers at a time with as many open windows as these had, in rounds until one task's are left; a
    task never holds more than its open windows. Numbers of sequences are those of the round, the task and its count.

    A null or empty text is the end id alone; repeated rows are packed each; a null ``doc_id`` stays null; no rows
    give no rows; further columns are not returned.
    """
    kind = docs.schema["doc_id"]
    schema = StructType([StructField("doc_id", kind.dataType), *[StructField(f, LongType()) for f in FIELDS], StructField("window", LongType())])
    schema = schema.add("closed", "boolean")
    end = np.array([end_id], "<u4").tobytes()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, number = Windows(size, open_windows), 0
        out: list = []
        arrow = pa.int64()

        def put(doc: object, ids: bytes, start: int, length: int, total: int) -> None:
            nonlocal number
            piece = (doc, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), total)
            if left := state.put(piece, length):
                out.append((number, True, left))
                number += 1

        for batch in batches:
            names = batch.column("doc_id")
            arrow = names.type
            names = names.to_pylist()
            for s in T.slices(batch.column("text"), TEXT_BYTES):
                body = s.data.tobytes()
                texts = [body[a:b] for a, b in zip(s.offsets[:-1].tolist(), s.offsets[1:].tolist())]
                for i, ids in enumerate(token_ids(texts, tokenizer)):
                    doc, ids = names[s.first + i], ids + end
                    total, start = len(ids) // 4, 0
                    while total - start >= size:
                        piece = (doc, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)]), total)
                        out.append((number, True, [size, [piece]]))
                        number, start = number + 1, start + size
                    rest = total - start
                    if rest and len(state.open) >= state.most:
                        gap = size - max(w[0] for w in state.open)
                        if all(w[0] + rest > size for w in state.open) and gap >= least_cut and rest - gap >= least_cut:
                            put(doc, ids, start, gap, total)
                            start, rest = start + gap, rest - gap
                    if rest:
                        put(doc, ids, start, rest, total)
                if out:
                    yield _rows([], out, arrow)
                    out = []
        if state.open:
            yield _rows([], [(number + i, False, w) for i, w in enumerate(state.open)], arrow)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, number, arrow = Windows(size, open_windows * merge), 0, pa.int64()
        for batch in batches:
            arrow = batch.column("doc_id").type
            out = []
            for row in zip(*[c.to_pylist() for c in batch.columns[:5]]):
                if left := state.put(row, row[2]):
                    out.append((number, True, left))
                    number += 1
            if out:
                yield _rows([], out, arrow)
        if state.open:
            yield _rows([], [(number + i, False, w) for i, w in enumerate(state.open)], arrow)

    def numbered(df: DataFrame, round_: int) -> DataFrame:
        return df.withColumn("task", F.spark_partition_id()).withColumn("sequence_id", F.lit(round_ << 56) + F.col("task") * (1 << 32) + F.col("window"))

    first = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(packed, schema)
    rounds = [written(numbered(first, 0), "packed")]
    while True:
        left = rounds[-1].where("not closed")
        tasks = [r.task for r in left.select("task").distinct().limit(2).collect()]
        if len(tasks) < 2:
            break
        groups = left.agg(F.countDistinct("task")).first()[0]
        into = -(-groups // merge)
        # Each group's pieces meet in one partition, in an order that reruns repeat.
        dealt = left.withColumn("group", F.pmod("task", F.lit(into))).repartition(into, "group").sortWithinPartitions(F.desc("length"), "task", "window", "offset")
        again = dealt.select("doc_id", *FIELDS).mapInArrow(merged, schema)
        rounds.append(written(numbered(again, len(rounds)), "packed"))
    out = rounds[-1]
    for r in rounds[:-1]:
        out = out.union(r.where("closed"))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
