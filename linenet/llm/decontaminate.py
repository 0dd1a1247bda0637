"""Benchmark decontamination: texts are streamed through suffix automata of the benchmark's words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from linenet.llm import text as T
from linenet.llm.resample import lowered, words_of
from linenet.llm.scratch import written

# Words of one automaton, and words of an item that stay together; automata that go over the texts at once.
SHARD_WORDS, PIECE_WORDS, AT_ONCE = 1 << 17, 1 << 15, 8
# Words a walk takes at most before it is cut; parts overlap by what a window may need.
WALK = 256


class Builder:
    """A generalised suffix automaton over sequences of numbers: its states are the classes of their substrings."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, next_: dict[int, int], link: int) -> int:
        self.next.append(next_)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, symbol: int) -> int:
        """The state of the longest string of ``p`` with one more symbol, made of its own if it shares one with longer strings."""
        q = self.next[p][symbol]
        if self.length[q] == self.length[p] + 1:
            return q
        own = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = own
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = own
            p = self.link[p]
        return own

    def add(self, sequence: list[int]) -> None:
        last = 0
        for symbol in sequence:
            if symbol in self.next[last]:
                last = self._split(last, symbol)
                continue
            new, p = self._state(self.length[last] + 1, {}, 0), last
            while p >= 0 and symbol not in self.next[p]:
                self.next[p][symbol] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, symbol)
            last = new

    def place(self, sequence: list[int], size: int) -> Iterator[int]:
        """The state of every run of ``size`` symbols of a sequence that was added."""
        state = 0
        for i, symbol in enumerate(sequence):
            state = self.next[state][symbol]
            while self.length[self.link[state]] >= size:
                state = self.link[state]
            if i + 1 >= size:
                yield state


@dataclass
class Automaton:
    """Arrays of a finished automaton.

    ``keys`` are state times number of words plus word, in order, ``targets`` the states they lead to. ``top`` is the
    nearest state on the way of suffix links, itself included, at which a window ends; windows of state s are
    ``ends[s]`` to ``ends[s + 1]`` of ``sizes`` and ``owners`` (places in ``items``).
    """

    words: np.ndarray
    keys: np.ndarray
    targets: np.ndarray
    length: np.ndarray
    link: np.ndarray
    top: np.ndarray
    ends: np.ndarray
    sizes: np.ndarray
    owners: np.ndarray
    items: list[str | None]

    ARRAYS = {"words": "<u8", "keys": "<i8", "targets": "<i4", "length": "<i4", "link": "<i4", "top": "<i4", "ends": "<i4", "sizes": "<i4", "owners": "<i4"}

    @classmethod
    def of(cls, pieces: list[tuple[str | None, np.ndarray]], window: int) -> Automaton:
        """Of pieces of items, each an item's id and the hashes of its words. A piece has a window of each ``window`` words, a shorter one is a window."""
        words = np.unique(np.concatenate([np.zeros(0, np.uint64), *(h for _, h in pieces)]))
        built, told = Builder(), [(i, np.searchsorted(words, h).tolist()) for i, h in pieces]
        for _, sequence in told:
            built.add(sequence)
        items = sorted({i for i, _ in told}, key=lambda i: (i is not None, i or ""))
        number = {i: n for n, i in enumerate(items)}
        windows = sorted({(state, size, number[i]) for i, s in told if s for size in [min(window, len(s))] for state in built.place(s, size)})
        state, sizes, owners = (np.array(x, np.int32) for x in zip(*windows)) if windows else (np.zeros(0, np.int32),) * 3
        length, link = np.array(built.length, np.int32), np.array(built.link, np.int32)
        ends = np.searchsorted(state, np.arange(len(length) + 1)).astype(np.int32)
        top = np.where(ends[1:] > ends[:-1], np.arange(len(length)), -1).astype(np.int32)
        for s in np.argsort(length, kind="stable").tolist():
            if top[s] < 0 and link[s] >= 0:
                top[s] = top[link[s]]
        keys = np.array([s * len(words) + w for s, n in enumerate(built.next) for w in n], np.int64)
        targets = np.array([t for n in built.next for t in n.values()], np.int32)
        order = np.argsort(keys)
        return cls(words, keys[order], targets[order], length, link, top, ends, sizes, owners, items)

    def step(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The state one word on, or -1."""
        key = state.astype(np.int64) * len(self.words) + word
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.targets[at], -1)

    def walk(self, word: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Stream runs of known words, all at once, word by word: state and length of the longest match that ends at each word."""
        at_state, at_length = np.zeros(len(word), np.int32), np.zeros(len(word), np.int32)
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        state, matched = np.zeros(len(starts), np.int32), np.zeros(len(starts), np.int32)
        for t in range(int(sizes.max(initial=0))):
            n = int(np.searchsorted(-sizes, -t, "left"))
            here = word[starts[:n] + t]
            left = np.arange(n)
            while len(left):
                to = self.step(state[left], here[left])
                on = to >= 0
                state[left[on]] = to[on]
                matched[left[on]] += 1
                left = left[~on]
                state[left] = self.link[state[left]]
                matched[left] = self.length[state[left]]
            at_state[starts[:n] + t], at_length[starts[:n] + t] = state[:n], matched[:n]
        return at_state, at_length

    def windows(self, hashes: np.ndarray, rows: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows that occur: last word and size of the longest at each place, and the row and item of all."""
        none = np.zeros(0, np.int64)
        if not len(self.sizes) or not len(hashes):
            return none, none, none, none
        word = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        known = self.words[word] == hashes
        first = np.append(self.step(np.zeros(len(self.words), np.int32), np.arange(len(self.words))), 0)
        on = known[1:] & known[:-1] & (rows[1:] == rows[:-1])
        pair = np.flatnonzero(on)
        on[pair] = self.step(first[word[pair]], word[pair + 1]) >= 0
        begin = np.flatnonzero(known & ~np.concatenate([[False], on]))
        size = np.flatnonzero(known & ~np.concatenate([on, [False]])) + 1 - begin
        use = size >= self.sizes.min()
        begin, size = begin[use], size[use]
        # Long runs are cut; a part knows what a window needs after as many words less one.
        part = max(WALK, 4 * window)
        go = part - (window - 1)
        parts = np.maximum(1, -(-(size - (window - 1)) // go))
        of = np.repeat(np.arange(len(size)), parts)
        shift = (np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)) * go
        state, matched = np.zeros(len(word), np.int32), np.zeros(len(word), np.int32)
        flat = np.repeat(begin[of] + shift, s := np.minimum(part, size[of] - shift)) + np.arange(s.sum()) - np.repeat(np.cumsum(s) - s, s)
        st, ma = self.walk(word[flat], np.cumsum(s) - s, s)
        inner = np.arange(len(flat)) - np.repeat(np.cumsum(s) - s, s)
        right = (inner >= window - 1) | np.repeat(shift == 0, s)
        state[flat[right]], matched[flat[right]] = st[right], ma[right]

        at = np.flatnonzero(self.top[state] >= 0)
        long, seen = np.zeros(len(at), np.int64), []
        now = self.top[state[at]]
        at_, row_, matched_, place = at, rows[at], matched[at], np.arange(len(at))
        while len(at_):
            n = self.ends[now + 1] - self.ends[now]
            spot = np.repeat(self.ends[now] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            who = np.repeat(np.arange(len(now)), n)
            fits = self.sizes[spot] <= matched_[who]
            spot, who = spot[fits], who[fits]
            np.maximum.at(long, place[who], self.sizes[spot])
            seen.append(np.unique(row_[who] * len(self.items) + self.owners[spot]))
            up = self.link[now]
            now = np.where(up >= 0, self.top[np.maximum(up, 0)], -1)
            go_on = now >= 0
            now, at_, row_, matched_, place = now[go_on], at_[go_on], row_[go_on], matched_[go_on], place[go_on]
        pairs = np.unique(np.concatenate([none, *seen]))
        return at[long > 0], long[long > 0], pairs // len(self.items), pairs % len(self.items)


def _pieces(window: int):
    """The hashes of every item's words, long items in pieces that overlap by a window less one word."""
    go = PIECE_WORDS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_pylist()
            for s in T.slices(batch.column("text")):
                low = lowered(s)
                starts, ends = words_of(low)
                hashes, rows = low.hashes(starts, ends), low.row_of(starts)
                edges = np.searchsorted(rows, np.arange(s.rows + 1))
                out: list[tuple] = []
                for r, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
                    for n, at in enumerate(range(a, max(a + 1, b - window + 1), go) if b > a else ()):
                        part = hashes[at : min(b, at + go + window - 1)]
                        out.append((ids[s.first + r], n, len(part), part.tobytes()))
                cols = list(zip(*out)) if out else [(), (), (), ()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.int64(), pa.binary()))], names=["id", "piece", "n", "words"])

    return cut


def _build(window: int):
    def built(pieces: pa.Table) -> pa.Table:
        rows = zip(pieces.column("id").to_pylist(), pieces.column("words").to_pylist())
        made = Automaton.of([(i, np.frombuffer(w, np.uint64)) for i, w in rows], window)
        told = {n: pa.array([getattr(made, n).astype(t).tobytes()], pa.binary()) for n, t in Automaton.ARRAYS.items()}
        return pa.table({"shard": pieces.column("shard").slice(0, 1).cast(pa.int32()), **told, "items": pa.array([made.items], pa.list_(pa.string()))})

    return built


def automata(items: DataFrame, id_col: str = "item_id", window: int = 10) -> DataFrame:
    """One row for each suffix automaton; each holds some 131 072 words of ``items`` and is built in a task of its own.

    Items are dealt by hash, those of more than 32 768 words in pieces that overlap.
    """
    told = items.select(F.col(id_col).cast("string").alias("id"), "text").distinct()
    pieces = written(told.mapInArrow(_pieces(window), "id string, piece int, n long, words binary"), "contamination-pieces")
    shards = max(1, -(-(pieces.agg(F.sum("n")).first()[0] or 0) // SHARD_WORDS))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("words", "id"), F.lit(shards)).cast("int")).select("shard", "id", "words")
    kind = StructType([StructField("shard", pieces.schema["piece"].dataType), *(StructField(n, BinaryType()) for n in Automaton.ARRAYS), StructField("items", ArrayType(StringType()))])
    return written(dealt.groupBy("shard").applyInArrow(_build(window), kind), "contamination-automata")


def _marked(names: list[str], machines: list[Automaton], window: int):
    """Adds to ``hits`` (a bit for each word) and ``found`` (items) of every row what some automata tell."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before, listed = batch.column("hits"), batch.column("found")
            for s in T.slices(batch.column("text")):
                low = lowered(s)
                starts, ends = words_of(low)
                rows, hashes = low.row_of(starts), low.hashes(starts, ends)
                cover = np.zeros(len(starts) + 1, np.int64)
                found: dict[int, set[str]] = {}
                for m in machines:
                    last, size, row, item = m.windows(hashes, rows, window)
                    np.add.at(cover, last - size + 1, 1)
                    np.add.at(cover, last + 1, -1)
                    for r, i in zip(row.tolist(), item.tolist()):
                        found.setdefault(r, set()).add(m.items[i])
                hit = np.cumsum(cover)[:-1] > 0
                edges = np.searchsorted(rows, np.arange(s.rows + 1))
                bits, items = before.slice(s.first, s.rows).to_pylist(), listed.slice(s.first, s.rows).to_pylist()
                for r in np.unique(rows[hit]).tolist():
                    own = np.packbits(hit[edges[r] : edges[r + 1]])
                    bits[r] = (own | np.frombuffer(bits[r], np.uint8) if bits[r] else own).tobytes()
                    items[r] = sorted({*items[r], *(i for i in found.get(r, ()) if i is not None)})
                here = batch.slice(s.first, s.rows)
                told = [pa.array(np.diff(edges).astype(np.int64)), pa.array(bits, pa.binary()), pa.array(items, pa.list_(pa.string()))]
                yield pa.record_batch([*(here.column(c) for c in names), *told], names=[*names, "n_words", "hits", "found"])

    return marked


def _over(rows: DataFrame, items: DataFrame, id_col: str, window: int) -> DataFrame:
    """``rows`` (with ``text``) and ``n_words``, ``hits`` and ``found``."""
    made = automata(items, id_col, window)
    shards = sorted(r.shard for r in made.select("shard").collect())
    names = rows.columns
    kind = StructType([*rows.schema.fields, StructField("n_words", LongType()), StructField("hits", BinaryType()), StructField("found", ArrayType(StringType()))])
    told = rows.withColumns({"n_words": F.lit(0).cast("long"), "hits": F.lit(b""), "found": F.array().cast("array<string>")})
    for at in range(0, max(1, len(shards)), AT_ONCE):
        if at:
            told = written(told, "contamination-marked")
        few = made.where(F.col("shard").isin(shards[at : at + AT_ONCE])).collect()
        machines = [Automaton(**{n: np.frombuffer(r[n], t) for n, t in Automaton.ARRAYS.items()}, items=r["items"]) for r in few]
        told = told.mapInArrow(_marked(names, machines, window), kind)
    return told


def _hit_count() -> F.Column:
    bits = F.split(F.hex("hits"), "")
    ones = F.transform(bits, lambda x: F.bit_count(F.conv(F.when(x == "", "0").otherwise(x), 16, 10).cast("int")))
    return F.when(F.octet_length("hits") > 0, F.aggregate(ones, F.lit(0).cast("long"), lambda s, x: s + x)).otherwise(F.lit(0).cast("long"))


def overlaps(docs: DataFrame, items: DataFrame, id_col: str = "item_id", window: int = 10) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit`` and ``items`` (ids as strings, in order) of every row of ``docs``.

    A window is ``window`` consecutive words of an item, A-Z lower-cased, or all words of a shorter item; a document's
    word is hit if it lies in an occurrence of a window, and an item is listed if one of its windows occurs. The
    texts stream through generalised suffix automata of the items, which give the longest match that ends
    at each word; whole texts are read once for each eight automata, about a million words of items, whose arrays go to every task.
    Words compare by 64-bit hashes.

    A null, empty or wordless text has no words and hits; an item without words is no window. Items with a null
    id hit words and are not listed; repeated items, or ids, count once. Repeated documents are told each. No documents
    give no rows, no items no hits. Other columns are not read.
    """
    told = _over(docs.select("doc_id", "text"), items, id_col, window)
    return told.select("doc_id", "n_words", _hit_count().alias("n_hit"), F.col("found").alias("items"))


def _cut(names: list[str], text: str, most: float):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = batch.column("hits").to_pylist()
            texts, keep = batch.column("text").to_pylist(), np.ones(len(batch), bool)
            for s in T.slices(batch.column("text")):
                if not any(hits[s.first : s.first + s.rows]):
                    continue
                starts, ends = words_of(lowered(s))
                edges = np.searchsorted(s.row_of(starts), np.arange(s.rows + 1))
                for r in range(s.rows):
                    if not hits[s.first + r]:
                        continue
                    a, b = int(edges[r]), int(edges[r + 1])
                    hit = np.unpackbits(np.frombuffer(hits[s.first + r], np.uint8), count=b - a).astype(bool)
                    keep[s.first + r] = hit.mean() <= most
                    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
                    at, left = int(s.offsets[r]), []
                    for i, j in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
                        left.append(s.data[at : starts[a + i]].tobytes())
                        at = int(ends[a + j - 1])
                    left.append(s.data[at : s.offsets[r + 1]].tobytes())
                    texts[s.first + r] = b"".join(left).decode()
            told = [pa.array(texts, pa.string()) if c == text else batch.column(c) for c in names]
            yield pa.record_batch(told, names=names).filter(pa.array(keep))

    return cut


def decontaminated(docs: DataFrame, items: DataFrame, id_col: str = "item_id", window: int = 10, most: float = 0.5) -> DataFrame:
    """The rows of ``docs`` without the words that ``overlaps`` hits, and without rows of which more than the share ``most`` is hit.

    A run of hit words goes from its first to its last letter; all else of a text stays as it is, so rows without hits
    are untouched, null texts too. Columns are those of ``docs``, whatever they are called.
    """
    own = [f"_c{i}" for i in range(len(docs.columns))]
    text = own[docs.columns.index("text")]
    rows = docs.toDF(*own)
    told = _over(rows.withColumn("text", F.col(text)), items, id_col, window)
    kind = StructType([StructField(n, f.dataType) for n, f in zip(own, docs.schema.fields)])
    return told.mapInArrow(_cut(own, text, most), kind).toDF(*docs.columns)
