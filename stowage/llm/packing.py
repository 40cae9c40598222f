"""Packing of tokenised documents into fixed-size sequences by order-preserving dynamic programming.

Tokens stay in the order of the table. A plan chooses window cuts among all document ends, all sentence ends and (where a run of
tokens without either is longer than a window, and near the end of a stretch) plain token positions, and minimises
padding plus a penalty for each cut inside a document. With f(j) the least cost of the first j cut places,

    f(j) = penalty(j) + min over i, 0 < pos(j) - pos(i) <= size, of f(i) + size - (pos(j) - pos(i)),

and the minimum over the sliding window of i is kept in a monotone queue, so a plan is linear in the cut places. Windows
whose length is a power of two need no padding; those lengths are tried beside the queue.

Scale: no shuffle. Each task packs the documents of its own input split in stretches of about `stretch` tokens and carries
the last, unfinished window into the next stretch, so memory is bounded by a stretch and one document.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .common import batch

SIZE = 4096
END = 2
#: Cost, in tokens of padding, of a cut at a sentence end inside a document and of a cut inside a sentence.
SENTENCE_CUT, WORD_CUT = 8, 24
STRETCH = 1 << 19
#: Bytes of text whose words are looked up at once.
GROUP = 8 << 20

PIECES = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def spans(ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of `ids` that begin at `start` and are `size` long, one after another."""
    ends = np.cumsum(size, dtype=np.int64)
    places = np.repeat(start - ends + size, size)
    places += np.arange(len(places))
    return ids[places]


class WordCache:
    """Token ids by white-space-separated chunk, with the same result as the tokenizer on the whole text.

    Holds for tokenizers that drop white space and never merge across it. Texts are split, and equal chunks found, by Arrow, for a
    group of texts at once. Chunks of plain Latin letters and then ASCII signs, nearly all of most texts, are cut into these two words
    by Arrow too, so that variants in case or punctuation share one look-up and no chunk becomes a Python object. Others of plain signs are cut into the
    tokenizer's words one by one; what else there is, and special tokens, goes to the tokenizer as it is. Known words are one Arrow
    column beside arrays of ids, places and uses (about 55 bytes a word); when they are too many, half of the limit stay, those most used.
    The cache of other chunks is emptied when full.
    """

    LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ňŊ-ž"
    PLAIN = re.compile(r"[!-~À-ÖØ-öø-įı-ňŊ-ž]+")
    #: The commonest chunks: letters, then signs other than an apostrophe.
    SIMPLE = rf"^(?P<head>[{LETTERS}]+)(?P<tail>[!-&(-/:-@\[-`{{-~]*)$"
    #: Fixed value: the word pattern of the tokenizer, for plain chunks.
    WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")

    def __init__(self, path: str, chunks: int = 200_000, words: int = 600_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.last = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.limits = chunks, words
        self.chunks: dict[str, bytes] = {}  # those that are not simple; ids as little-endian unsigned 32-bit numbers
        self.words = pa.array([""], pa.large_string())
        self.ids, self.start, self.size, self.uses = np.empty(0, "<u4"), *np.zeros((3, 1), np.int64)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: pa.Array, line: int = 200) -> None:
        words = new.to_pylist()
        ids = np.concatenate(self._whole([" ".join(words[s : s + line]) for s in range(0, len(words), line)]))
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):
            each = self._whole(words)
            ids, ends = np.concatenate(each), np.cumsum([len(x) for x in each])
        size = np.diff(ends, prepend=0)
        self.start = np.concatenate([self.start, len(self.ids) + ends - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, ids])
        self.uses = np.concatenate([self.uses, np.zeros(len(words), np.int64)])
        self.words = pa.concat_arrays([self.words, new])

    def _forget(self, most: int) -> None:
        keep = np.append(0, 1 + np.sort(np.argsort(-self.uses[1:], kind="stable")[:most]))
        self.ids, self.size = spans(self.ids, self.start[keep], self.size[keep]), self.size[keep]
        self.start, self.uses = np.cumsum(self.size) - self.size, self.uses[keep] >> 1
        self.words = self.words.take(pa.array(keep))

    def _look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An array of ids, and where in it each word's begin and how many they are."""
        found = pc.index_in(words, self.words)
        at = found.fill_null(0).to_numpy()
        if found.null_count:
            missing = found.is_null()
            new = words.filter(missing).dictionary_encode()
            at = at.copy()
            at[missing.to_numpy(zero_copy_only=False)] = new.indices.to_numpy() + len(self.words)
            self._learn(new.dictionary)
        self.uses += np.bincount(at, minlength=len(self.words))
        told = self.ids, self.start[at], self.size[at]
        if len(self.words) > self.limits[1]:
            self._forget(self.limits[1] // 2)
        return told

    def _others(self, chunks: list[str]) -> list[bytes]:
        parts = list(map(self.chunks.get, chunks))
        if new := [c for c, p in zip(chunks, parts) if p is None]:
            if len(self.chunks) + len(new) > self.limits[0]:
                self.chunks.clear()
                new = chunks
            plain, odd = [], []
            for c in new:
                (plain if self.PLAIN.fullmatch(c) and "<|" not in c else odd).append(c)
            self.chunks.update((c, x.tobytes()) for c, x in zip(odd, self._whole(odd)))
            if plain:
                words = [self.WORD.findall(c.lower()) for c in plain]
                ids, start, size = self._look_up(pa.array(chain.from_iterable(words), pa.large_string()))
                raw = spans(ids, start, size).tobytes()
                ends = (4 * np.cumsum(size)[np.cumsum([len(w) for w in words]) - 1]).tolist()
                self.chunks.update((c, raw[s:e]) for c, s, e in zip(plain, [0, *ends], ends))
            parts = [self.chunks[c] for c in chunks]
        return parts

    def _chunk_ids(self, unique: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks, one after another, and how many each has."""
        cut = pc.extract_regex(unique, self.SIMPLE)
        simple = cut.is_valid()
        parts = cut.filter(simple)
        simple = simple.to_numpy(zero_copy_only=False)
        n = len(parts)
        ids, start, size = self._look_up(pa.concat_arrays([pc.utf8_lower(parts.field("head")), parts.field("tail")]))
        others = self._others(unique.filter(pa.array(~simple)).to_pylist())
        # Two stretches of ids for a chunk: its head and its tail, or all of another chunk and none.
        starts, sizes = np.zeros((len(unique), 2), np.int64), np.zeros((len(unique), 2), np.int64)
        starts[simple, 0], starts[simple, 1], sizes[simple, 0], sizes[simple, 1] = start[:n], start[n:], size[:n], size[n:]
        if others:
            count = np.array([len(x) >> 2 for x in others])
            starts[~simple, 0], sizes[~simple, 0] = len(ids) + np.cumsum(count) - count, count
            ids = np.concatenate([ids, np.frombuffer(b"".join(others), "<u4")])
        return spans(ids, starts.ravel(), sizes.ravel()), sizes.sum(axis=1)

    def encode(self, texts: list[str] | pa.Array, group: int = GROUP) -> Iterator[np.ndarray]:
        """Ids of each text (none is null). Texts are taken in groups of about `group` bytes, or one that is longer."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        bytes_to = np.cumsum(pc.binary_length(texts).to_numpy())
        s = 0
        while s < len(texts):
            e = max(s + 1, int(np.searchsorted(bytes_to, group + (bytes_to[s - 1] if s else 0), "right")))
            split = pc.ascii_split_whitespace(texts[s:e])
            coded, bounds = split.flatten().dictionary_encode(), split.offsets.to_numpy()
            del split
            at = coded.indices.to_numpy()
            ids, size = self._chunk_ids(coded.dictionary)
            start = np.cumsum(size) - size
            for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
                yield spans(ids, start[at[a:b]], size[at[a:b]])
            s = e


@lru_cache(1)
def word_cache(path: str) -> WordCache:
    """One for each Python worker, so that its next task finds the words of the last."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    return WordCache(path)


@lru_cache(1)
def sentence_marks(path: str) -> np.ndarray:
    """Boolean by id: the token ends a sentence (its text is a full stop, question or exclamation mark, or several)."""
    vocabulary = Tokenizer.from_file(path).get_vocab()
    marks = np.zeros(max(*vocabulary.values(), END) + 1, dtype=bool)
    marks[[i for t, i in vocabulary.items() if re.fullmatch(r"[.!?]+(</w>)?", t)]] = True
    return marks


def plan(places: np.ndarray, penalties: np.ndarray, size: int = SIZE) -> list[int]:
    """Indices of the chosen cuts among `places` (ascending token positions from 0; the last one is always chosen).

    Neighbouring places must not be more than `size` apart. The cost is the padding of each window (none if its length
    is a power of two) plus the penalties of the chosen places.
    """
    n = len(places)
    # Pairs of places a power of two apart (a whole window needs no padding anyhow), by the later place.
    index = np.full(int(places[-1]) + 1, -1, dtype=np.int64)
    index[places] = np.arange(n)
    later, earlier, apart = [], [], []
    for p in (1 << k for k in range((size - 1).bit_length())):
        begin = np.searchsorted(places, p)
        o = index[places[begin:] - p]
        j = np.flatnonzero(o >= 0)
        later.append(j + begin)
        earlier.append(o[j])
        apart.append(np.full(len(j), p))
    later = np.concatenate([np.empty(0, np.int64), *later])
    order = np.argsort(later, kind="stable")
    upto = np.searchsorted(later[order], np.arange(n), "right").tolist()
    pairs = list(zip(*(np.concatenate([np.empty(0, np.int64), *x])[order].tolist() for x in (earlier, apart))))
    first = np.searchsorted(places, places - size).tolist()  # the earliest place a window may begin at
    keys, back = [0.0] * n, [0] * n  # keys: least cost + position, what the queue is ordered by
    queue, done = deque([0]), 0
    for j, (extra, begin, end) in enumerate(zip(penalties.tolist(), first, upto)):
        if not j:
            continue
        while queue[0] < begin:
            queue.popleft()
        i = queue[0]
        best = keys[i] + size
        if done < end:
            for o, p in pairs[done:end]:
                if keys[o] + p < best:
                    best, i = keys[o] + p, o
            done = end
        best += extra
        keys[j], back[j] = best, i
        while queue and keys[queue[-1]] >= best:
            queue.pop()
        queue.append(j)
    cuts, j = [], n - 1
    while j:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


def cut_places(tokens: np.ndarray, doc_ends: np.ndarray, marks: np.ndarray, size: int, final: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (from 0 to the number of tokens) where a window may end, and the penalty of each."""
    n = len(tokens)
    sentences = np.flatnonzero(marks[tokens]) + 1
    chosen = np.zeros(n + 1, dtype=bool)
    chosen[sentences] = chosen[doc_ends] = chosen[[0, n]] = True
    places = np.flatnonzero(chosen)
    far = np.flatnonzero(np.diff(places) > size)
    extra = [np.arange(places[g] + size, places[g + 1], size) for g in far.tolist()]
    for g in far.tolist():  # also what fills the window begun before the long run
        lo = np.searchsorted(places, places[g] - size)
        extra.append(places[lo : g + 1] + size)
    if final:  # the last windows may be cut to powers of two
        tail, base = [], n - n % size if n % size else n - size
        at = base
        for p in (1 << k for k in range(size.bit_length() - 1, -1, -1)):
            if at + p <= n:
                at += p
                tail.append(at)
        extra.append(np.array([base, *tail], dtype=np.int64))
    if extra:
        more = np.concatenate(extra)
        places = np.union1d(places, more[(more > 0) & (more < n)])
    penalty = np.full(len(places), float(WORD_CUT))
    penalty[np.searchsorted(places, sentences)] = SENTENCE_CUT
    penalty[np.searchsorted(places, doc_ends)] = 0
    penalty[[0, -1]] = 0
    return places, penalty


class Packer:
    """Packs a stream of (doc_id, ids) and returns rows of pieces whenever a stretch is full."""

    def __init__(self, marks: np.ndarray, size: int, stretch: int, first_sequence: int):
        self.marks, self.size, self.stretch, self.sequence = marks, size, stretch, first_sequence
        self.held: list[tuple] = []  # (doc_id, start, ids, doc_tokens) not packed yet
        self.tokens = 0

    def add(self, doc_id, ids: np.ndarray) -> list[tuple]:
        self.held.append((doc_id, 0, ids, len(ids)))
        self.tokens += len(ids)
        return self.flush(False) if self.tokens >= self.stretch else []

    def flush(self, final: bool) -> list[tuple]:
        if not self.held:
            return []
        tokens = np.concatenate([h[2] for h in self.held])
        ends = np.cumsum([len(h[2]) for h in self.held])
        places, penalties = cut_places(tokens, ends, self.marks, self.size, final)
        cuts = places[plan(places, penalties, self.size)]
        if not final:
            cuts = cuts[:-1]  # the last window is carried on
        done = int(cuts[-1]) if len(cuts) else 0
        rows, kept, at, window = [], [], 0, 0
        bounds = [0, *cuts.tolist()]
        for doc_id, start, ids, total in self.held:
            s, e = at, at + len(ids)
            while s < min(e, done):
                while bounds[window + 1] <= s:
                    window += 1
                t = min(e, bounds[window + 1])
                piece = ids[s - at : t - at]
                rows.append((doc_id, start + s - at, t - s, zlib.crc32(piece.tobytes()), total, self.sequence + window, s - bounds[window]))
                s = t
            if e > done:
                kept.append((doc_id, start + max(0, done - at), ids[max(0, done - at) :], total))
            at = e
        self.sequence += len(cuts)
        self.held, self.tokens = kept, at - done
        return rows


def pack(docs: DataFrame, tokenizer_path: str, size: int = SIZE, stretch: int = STRETCH, end_id: int = END) -> DataFrame:
    """Pieces of docs(doc_id, text; other columns are ignored) in sequences of at most `size` tokens.

    Columns: doc_id, start (tokens of its document before the piece), length, ids_crc32 (of the ids as little-endian
    unsigned 32-bit numbers), doc_tokens (with the end id), sequence_id, offset (place in the sequence; gapless from 0).
    Null and empty texts are the end id alone. Repeated rows are packed as often as they stand there. Documents longer
    than a sequence are cut into several pieces. An empty table gives no row. `tokenizer_path` must be readable on every
    executor. sequence_id holds the task's partition in its upper bits, so `docs` should be a stored table or a
    materialised one, whose splits are the same if a task runs again.
    """
    if size < 1 or stretch < 4 * size:
        raise ValueError("size must be positive and stretch at least four times as long")
    names = ["doc_id", *(c.split()[0] for c in PIECES.split(", "))]

    def table(rows: list[tuple], ids: pa.DataType) -> pa.RecordBatch:
        return batch(**{c: pa.array(v, ids if c == "doc_id" else pa.int64()) for c, v in zip(names, zip(*rows))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, marks = word_cache(tokenizer_path), sentence_marks(tokenizer_path)
        packer = Packer(marks, size, stretch, TaskContext.get().partitionId() << 32)
        kind = None
        for b in batches:
            kind = b.column("doc_id").type
            rows: list[tuple] = []
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), cache.encode(b.column("text").fill_null(""))):
                rows += packer.add(doc_id, np.append(ids, np.uint32(end_id)))
            if rows:
                yield table(rows, kind)
        if rows := packer.flush(True):
            yield table(rows, kind)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {PIECES}")
