"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text gets the dummy prefix and is cut where no piece of the vocabulary can cross: before a
space mark that follows another character, and around line feeds. The distinct words of a block of
texts lie in one flat symbol array; each round finds every word's smallest pair rank by a segmented
minimum, merges the leftmost such pair of all words at once, and compacts the array, until no word
has a mergeable pair. This equals the library's agenda, which pops the best score and, among
equals, the leftmost pair.

Nulls and empty texts give no ids and an empty decoded text. Repeated rows give repeated rows.
Extra columns are not read. Very long words go through a heap with the same rule, so that their cost
stays n log n.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm.common import released, text_batches, text_slices

SPACE = "▁"
NO_RANK = np.int32(2**31 - 1)
#: Words of more symbols than this are merged by a heap.
LONG_WORD = 400
#: Words of at most KEEP_CHARS characters are remembered, KEEP_WORDS of them per Python worker.
KEEP_CHARS, KEEP_WORDS = 40, 150_000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with scores, read on the driver and sent to the workers."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    normal: tuple[bool, ...]
    bytes_at: tuple[int, ...]  # id of each of the 256 byte pieces

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = range(sp.get_piece_size())
        pieces = tuple(sp.id_to_piece(i) for i in n)
        ids = {p: i for i, p in enumerate(pieces)}
        plain = tuple(not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in n)
        return cls(pieces, tuple(sp.get_score(i) for i in n), plain, tuple(ids[f"<0x{b:02X}>"] for b in range(256)))


class Codec:
    """The tables of one vocabulary and the encoder and decoder over them."""

    def __init__(self, v: Vocabulary):
        self.size = len(v.pieces)
        symbols = {p: i for i, p in enumerate(v.pieces) if v.normal[i]}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in symbols):
            raise ValueError("a piece crosses a word boundary; this vocabulary needs whole texts as words")
        for c in sorted({c for p in symbols for c in p}):
            symbols.setdefault(c, len(symbols) + self.size)
        self.names = {i: p for p, i in symbols.items()}
        self.char = np.full(0x110000, -1, np.int32)
        for p, i in symbols.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        rank_of = {s: r for r, s in enumerate(sorted({v.scores[i] for p, i in symbols.items() if i < self.size}, reverse=True))}
        keys, ranks, made = [], [], []
        for p, i in symbols.items():
            if i < self.size:
                for k in range(1, len(p)):
                    a, b = symbols.get(p[:k]), symbols.get(p[k:])
                    if a is not None and b is not None:
                        keys.append((a << 32) | b)
                        ranks.append(rank_of[v.scores[i]])
                        made.append(i)
        self.slots(np.array(keys, np.int64), np.array(ranks, np.int32), np.array(made, np.int32))
        self.byte_ids = np.array(v.bytes_at, np.int32)
        self.word = re.compile(self.cuts(symbols)).findall
        # decoding: the bytes of every piece, with the space mark as a space
        raw = {i: bytes([b]) for b, i in enumerate(v.bytes_at)}
        parts = [raw.get(i, b"" if not v.normal[i] and i not in raw else p.replace(SPACE, " ").encode()) for i, p in enumerate(v.pieces)]
        for i, p in enumerate(v.pieces):
            if p == "<unk>":
                parts[i] = " ⁇ ".encode()
        self.out_len = np.array([len(p) for p in parts], np.int64)
        self.out_at = np.concatenate([[0], np.cumsum(self.out_len)])[:-1]
        self.out = np.frombuffer(b"".join(parts), np.uint8)
        self.is_byte = np.zeros(self.size, bool)
        self.is_byte[self.byte_ids] = True
        self.is_mark = np.array([p.startswith(SPACE) for p in v.pieces])
        self.forget()

    @staticmethod
    def cuts(symbols: dict[str, int]) -> str:
        """A pattern whose matches tile a text so that no piece of this vocabulary crosses from one to the next."""
        letter, mark = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]", SPACE
        if any(re.search(f"{letter}[^{mark}](?<!{letter})|[^{mark}](?<!{letter}){letter}|\n", p) for p in symbols):
            return f"{mark}*[^{mark}]+|{mark}+"
        return rf"{mark}*{letter}+|\n+|{mark}*(?:(?!{letter})[^{mark}\n])+|{mark}+"

    def slots(self, keys: np.ndarray, ranks: np.ndarray, made: np.ndarray) -> None:
        """An open-addressing table of the pairs, probed by whole arrays."""
        self.bits = max(16, int(len(keys) * 8).bit_length())
        self.keys = np.full((1 << self.bits) + 64, -1, np.int64)
        self.ranks, self.made = np.full(len(self.keys), NO_RANK), np.zeros(len(self.keys), np.int32)
        for k, i, r, m in zip(keys, self.slot(keys), ranks, made, strict=True):
            while self.keys[i] != -1:
                i += 1
            self.keys[i], self.ranks[i], self.made[i] = k, r, m

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.at, self.length = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; NO_RANK where it is no piece."""
        key = np.where((a < 0) | (b < 0), np.int64(-2), (a.astype(np.int64) << 32) | b)
        i = self.slot(key)
        found = self.keys[i]
        rest = np.flatnonzero((found != key) & (found != -1))
        while len(rest):
            i[rest] += 1
            found = self.keys[i[rest]]
            rest = rest[(found != key[rest]) & (found != -1)]
        return self.ranks[i], self.made[i]  # an empty slot has NO_RANK

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Final symbols of all words, in order of the words, with each symbol's characters' start, and the words' lengths."""
        text = "".join(words)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        size = np.array([len(w) for w in words], np.int64)
        sym, at, seg = self.char[points], np.arange(len(points)), np.repeat(np.arange(len(words)), size)
        done_sym, done_at, done_seg = [], [], []
        for w in np.flatnonzero(size > LONG_WORD):
            own = seg == w
            s, a = self.merge_long(sym[own], at[own])
            done_sym.append(s), done_at.append(a), done_seg.append(np.full(len(s), w))
        if done_sym:
            short = size[seg] <= LONG_WORD
            sym, at, seg = sym[short], at[short], seg[short]
        rank, made = np.full(len(sym), NO_RANK), np.zeros(len(sym), np.int32)
        if len(sym):
            inner = np.flatnonzero(seg[1:] == seg[:-1])
            rank[inner], made[inner] = self.pair(sym[inner], sym[inner + 1])
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
            least = np.minimum.reduceat(rank, first)
            length = np.diff(np.concatenate([first, [len(sym)]]))
            keep = np.repeat(least < NO_RANK, length)
            if not keep.all():
                ended = ~keep
                done_sym.append(sym[ended]), done_at.append(at[ended]), done_seg.append(seg[ended])
                sym, at, seg, rank, made = sym[keep], at[keep], seg[keep], rank[keep], made[keep]
                length, least = length[least < NO_RANK], least[least < NO_RANK]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == np.repeat(least, length))
            hit = hit[np.concatenate([[True], seg[hit][1:] != seg[hit][:-1]])]
            sym[hit] = made[hit]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            sym, at, seg, rank, made = sym[keep], at[keep], seg[keep], rank[keep], made[keep]
            hit = hit - np.arange(len(hit))  # one symbol went for each word before
            for i in (hit, hit[hit > 0] - 1):  # only the pairs beside a merged symbol change
                same = (i + 1 < len(sym)) & (seg[np.minimum(i + 1, len(sym) - 1)] == seg[i])
                rank[i[~same]] = NO_RANK
                i = i[same]
                rank[i], made[i] = self.pair(sym[i], sym[i + 1])
        sym, at, seg = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_sym, done_at, done_seg))
        order = np.argsort(seg, kind="stable")
        sym, at, seg = sym[order].astype(np.int32), at[order], seg[order]
        # what is no piece is spelt in bytes
        odd = (sym < 0) | (sym >= self.size)
        count = np.bincount(seg, minlength=len(words))
        if odd.any():
            spelt = [text[i].encode("utf-8", "replace") for i in at[odd]]
            reps = np.ones(len(sym), np.int64)
            reps[odd] = [len(s) for s in spelt]
            sym, odd, seg = np.repeat(sym, reps), np.repeat(odd, reps), np.repeat(seg, reps)
            sym[odd] = self.byte_ids[np.frombuffer(b"".join(spelt), np.uint8)]
            count = np.bincount(seg, minlength=len(words))
        return sym, seg, count

    def merge_long(self, sym: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same merges for one long word, by a heap of (rank, position)."""
        s = sym.tolist()
        n = len(s)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        rank, made = self.pair(sym[:-1], sym[1:])
        heap = [(int(r), i, int(m), s[i], s[i + 1]) for i, (r, m) in enumerate(zip(rank, made, strict=True)) if r != NO_RANK]
        heapq.heapify(heap)
        seen: dict[tuple[int, int], tuple[int, int]] = {}

        def push(i: int) -> None:
            j = after[i]
            if i >= 0 and j < n:
                k = (s[i], s[j])
                if k not in seen:
                    r, m = self.pair(np.array([k[0]], np.int32), np.array([k[1]], np.int32))
                    seen[k] = int(r[0]), int(m[0])
                r, m = seen[k]
                if r != NO_RANK:
                    heapq.heappush(heap, (r, i, m, *k))

        while heap:
            _, i, m, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or s[i] != a or s[j] != b:
                continue
            s[i], alive[j], after[i] = m, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        keep = np.array(alive)
        return np.array(s, np.int32)[keep], at[keep]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and the count of each text."""
        lists = [self.word(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        new = [w for w in set().union(*lists) if w not in self.index]
        if new:
            ids, _, count = self.merge(new)
            base, start = len(self.flat), len(self.at)
            self.flat = np.concatenate([self.flat, ids])
            self.at = np.concatenate([self.at, base + np.cumsum(count) - count])
            self.length = np.concatenate([self.length, count])
            self.index.update(zip(new, range(start, start + len(new)), strict=True))
        per = np.array([len(x) for x in lists], np.int64)
        which = np.fromiter(map(self.index.__getitem__, chain.from_iterable(lists)), np.int64, int(per.sum()))
        length = self.length[which]
        ids = self.flat[spread(self.at[which], length)]
        ends = np.concatenate([[0], np.cumsum(length)])[np.concatenate([[0], np.cumsum(per)])]
        for w in new:
            if len(w) > KEEP_CHARS:
                del self.index[w]
        if len(self.at) > KEEP_WORDS or len(self.flat) > 20 * KEEP_WORDS:
            self.forget()
        return ids, np.diff(ends)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat UTF-8 bytes and offsets of the decoded texts; the first piece of a text loses its space mark."""
        length = self.out_len[ids]
        flat = self.out[spread(self.out_at[ids], length)]
        ends = np.concatenate([[0], np.cumsum(length)])
        starts = np.concatenate([[0], np.cumsum(counts)])
        offsets = ends[starts]
        full = counts > 0
        first = ids[np.minimum(starts[:-1], max(len(ids) - 1, 0))] if len(ids) else np.zeros(len(counts), np.int32)
        drop = full & (self.is_mark[first] if len(ids) else False)
        if drop.any():
            keep = np.ones(len(flat), bool)
            keep[offsets[:-1][drop]] = False
            flat = flat[keep]
            offsets = offsets - np.concatenate([[0], np.cumsum(drop)])
        return flat, offsets


def spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... for length[0] entries, then the same for the next."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(start - (ends - length), length)


def valid_text(raw: bytes) -> str:
    """UTF-8 bytes as text; each byte that belongs to no character becomes U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(raw):
            for k in (1, 2, 3, 4):
                try:
                    out.append(raw[i : i + k].decode())
                    i += k
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                i += 1
        return "".join(out)


_codecs: dict[int, Codec] = {}


def codec(v: Vocabulary) -> Codec:
    """One codec for each vocabulary and Python worker."""
    key = hash((v.pieces, v.scores))
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(v)
    return _codecs[key]


def encode_decode(df: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Returns id_col, ids array<int>, decoded string for every row.

    The decoded text comes from the ids alone. Partitions stay as they are: no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1)):
                ids, counts = c.encode([t or "" for t in texts])
                flat, offsets = c.decode(ids, counts)
                if c.is_byte[ids].any():
                    raw = flat.tobytes()
                    decoded = pa.array([valid_text(raw[i:j]) for i, j in zip(offsets[:-1], offsets[1:], strict=True)], pa.string())
                else:
                    decoded = pa.StringArray.from_buffers(b - a, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(flat))
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists, decoded], names=[id_col, "ids", "decoded"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = text_batches(df.select(id_col, F.col(text_col).cast("string").alias("text_")))
    return rows.mapInArrow(lambda batches: released(run(batches)), f"`{id_col}` {kind}, ids array<int>, decoded string")


def decode(df: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Returns id_col and decoded string; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for batch in batches:
            lists = [np.array([i for i in x or [] if i is not None], np.int32) for x in batch.column(1).to_pylist()]
            flat, offsets = c.decode(np.concatenate([np.zeros(0, np.int32), *lists]), np.array([len(x) for x in lists], np.int64))
            raw = flat.tobytes()
            out = pa.array([valid_text(raw[i:j]) for i, j in zip(offsets[:-1], offsets[1:], strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), out], names=[id_col, "decoded"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, decoded string")
