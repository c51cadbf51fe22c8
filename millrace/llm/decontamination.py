"""Benchmark passages in documents, found by latent semantic retrieval and by words in common.

Texts are cut into blocks of words. The TF-IDF vectors of all blocks of the corpus and of the
benchmark items span a latent space, the leading directions of a distributed randomised SVD, with
document frequencies counted over the whole corpus. Every window of blocks is then compared with
every benchmark item (or part of a long one). A window is a candidate for an item if the cosine in
the latent space is high, or if it holds at least half of the item's words; so the latent space adds
paraphrases and never loses an item that stands there literally. A candidate is confirmed by the
longest common subsequence of its words with a stretch of the window: a long one, a shorter one with
the item's answer (its last sentence) or a high cosine, or a still shorter one with both.

Words are runs of letters and digits without regard to case; in scripts written without blanks
(Han, kana, Thai, Lao, Khmer, Burmese) each character is a word. Items of two to four words are
found where these stand in a row; an item of one word only where it is the whole text.

The benchmark is taken in blocks of bounded size, so what is broadcast never grows with it.
Null and empty texts, and items without a word, match nothing.
``flagged`` answers rows that repeat an id as one document, a null id like any other; ``clean`` looks at each row. Repeated items
each count. Empty tables give no match. Only the id and text columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import arrays
from millrace.llm.shared import prepared, stored, unused

STRIDE = 32
"""Words of a block; windows are two or four blocks, as the item needs."""
ITEM_WORDS = 64
"""Longer benchmark items are cut into passages of so many words."""
LEAST_WORDS = 5
"""Shorter items are sought as exact sequences."""
ITEMS_AT_ONCE = 1_000
CHARS_AT_ONCE = 500_000
RANK = 128
OVERSAMPLING = 16
POWER_STEPS = 2
CHUNK = 256
COMMON = 0.01
"""Words in a larger share of the corpus's blocks carry no weight; they count as words in common."""
CELLS = 1 << 22
"""Cells of a matrix of windows and parts that are worked on at once."""
NUMBERS = 1 << 15
"""Weights of blocks that are multiplied by directions at once."""
MARKS = 1 << 20
"""Words of stretches whose subsequences are sought at once, beside those of one part."""
GAP = 3
COPIED, PARAPHRASED, RETOLD = 0.7, 0.5, 0.4
"""Shares of an item in order: enough alone, with an answer or a high cosine, with both."""
ANSWERED = 0.8
NEIGHBOUR, SIMILAR, ALIKE = 0.25, 0.4, 0.5
"""Cosines: of a window that is a candidate, of a stretch retold with its answer, of a paraphrase without it."""


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and their text numbers."""
    data, offsets = arrays.flat(column)
    data = arrays.lower_letters(data)
    starts, ends, text = arrays.word_spans(data, offsets, arrays.NOT_WORD)
    starts, ends, text = arrays.characters_apart(data, starts, ends, text)
    return arrays.span_hashes(data, starts, ends, 31), text


def _places(item: np.ndarray) -> dict[int, int]:
    """Every word of the item with the bits of its places."""
    where: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        where[w] = where.get(w, 0) | 1 << i
    return where


def _common(where: dict[int, int], length: int, text: np.ndarray) -> int:
    full = (1 << length) - 1
    row = full
    for w in text.tolist():
        hit = row & where.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return length - row.bit_count()


def common_run(item: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, all cells of a row as bits of one number."""
    return _common(_places(item), len(item), text)


def _span(length: int) -> int:
    """Words of a stretch that may hold an item of so many words."""
    return max(4, length * 3 // 2)


def _bits(item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words of an item of at most 64 words, and the bits of their places."""
    words, number = np.unique(item, return_inverse=True)
    bits = np.zeros(len(words), np.uint64)
    np.bitwise_or.at(bits, number, np.uint64(1) << np.arange(len(item), dtype=np.uint64))
    return words, bits


def _runs(bits: np.ndarray, first: np.ndarray, count: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of many stretches with their items.

    A stretch is ``count`` of the ``bits`` from ``first`` on, one for each of its words, and its item has ``length``
    words. As in ``common_run`` all cells of a row are bits; the k-th words of all stretches are taken together.
    """
    order = np.argsort(-count, kind="stable")
    at, falling, length = first[order], -count[order], length[order]
    full = ~np.uint64(0) >> (64 - length).astype(np.uint64)
    row = full.copy()
    for k in range(int(-falling[0]) if len(order) else 0):
        n = int(np.searchsorted(falling, -k))
        old = row[:n]
        hit = old & bits[at[:n] + k]
        row[:n] = ((old + hit) | (old - hit)) & full[:n]
    out = np.empty(len(order), np.int64)
    out[order] = length - np.bitwise_count(row)
    return out


class Stretches:
    """Stretches of texts, 1.5 times as long as the item that each may hold."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, marks: np.ndarray, words: np.ndarray, length: int, least: float) -> None:
        """The stretches of texts of so many words, for an item of ``length`` words.

        ``marks`` has a row for each text, with the bits of the item's places that hold its words and 0
        where the item lacks the word or the text has ended: no such word lengthens a subsequence, and
        none is longer than the number of the others. Stretches with less than ``least`` of the item are left out.
        """
        span, step = _span(length), max(1, length // 4)
        held = marks != 0
        total = np.zeros((len(marks), marks.shape[1] + 1), np.int64)
        np.cumsum(held, axis=1, out=total[:, 1:])
        begins = np.arange(0, max(1, marks.shape[1] - span + step), step)
        low, high = total[:, np.minimum(begins, marks.shape[1])], total[:, np.minimum(begins + span, marks.shape[1])]
        fits = (begins < np.maximum(1, words - span + step)[:, None]) & (high - low >= least * length)
        text, k = np.nonzero(fits)
        bits = marks[held]
        before = np.cumsum(total[:, -1]) - total[:, -1]
        self.parts.append((bits, before[text] + low[text, k] + self.size, (high - low)[text, k], text, begins[k], np.full(len(text), length)))
        self.size += len(bits)

    def best(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each call of ``add``: the texts with a stretch, the largest share of the item in order, and where it first is."""
        runs = _runs(*(np.concatenate([p[k] for p in self.parts]) for k in (0, 1, 2, 5)))
        out, done = [], 0
        for _, _, _, text, begin, length in self.parts:
            run = runs[done: done + len(text)]
            done += len(text)
            order = np.lexsort((begin, -run, text))
            some, first = np.unique(text[order], return_index=True)
            first = order[first]
            out.append((some, run[first] / length[first], begin[first]))
        return out


def best_run(item: np.ndarray, text: np.ndarray, held: np.ndarray, least: float = 0.0) -> tuple[float, int]:
    """Largest share of the item in order within a stretch of 1.5 times its length, and where.

    ``held`` marks the words of the text that the item has. Shares below ``least`` count as none.
    """
    words, bits = _bits(item)
    marks = np.zeros((1, len(text)), np.uint64)
    marks[0, held] = bits[np.searchsorted(words, text[held])]
    found = Stretches()
    found.add(marks, np.array([len(text)]), len(item), least)
    some, share, at = found.best()[0]
    return (float(share[0]), int(at[0])) if len(some) and share[0] else (0.0, 0)


class Lookup:
    """Places of hashes in a list of distinct ones in order, found by their first bits."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = hashes
        bits = (16 * len(hashes)).bit_length()
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(hashes >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64))

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the hashes that are in the list, and their places there."""
        bucket = (hashes >> self.shift).astype(np.int64)
        place = self.first[bucket]
        left = self.first[bucket + 1] - place
        at, k, found = np.flatnonzero(left), 0, [(np.zeros(0, np.int64),) * 2]
        while len(at):
            same = at[self.hashes[place[at] + k] == hashes[at]]
            found.append((same, place[same] + k))
            k += 1
            at = at[left[at] > k]
        return tuple(np.concatenate(f) for f in zip(*found))


@dataclass
class Items:
    """A block of benchmark passages; ``words`` are whole items, ``answers`` their last sentences.

    ``extra`` are words of answers that the items don't have, as they were cut off by the end of a sentence.
    """

    ids: list
    words: list[np.ndarray]
    answers: list[np.ndarray]
    owner: np.ndarray
    parts: list[np.ndarray]
    vocabulary: np.ndarray
    extra: np.ndarray

    @property
    def unknown(self) -> int:
        """The number of every word that no item has."""
        return len(self.vocabulary) + len(self.extra)

    def lookups(self) -> list[Lookup]:
        return [Lookup(v) for v in (self.vocabulary, self.extra) if len(v)]

    def numbers(self, hashes: np.ndarray, lookups: list[Lookup]) -> np.ndarray:
        """The words' places in the vocabulary, and after it in the words that only an answer has."""
        out = np.full(len(hashes), self.unknown, np.min_scalar_type(self.unknown))
        for before, lookup in zip((0, len(self.vocabulary)), lookups):
            hit, place = lookup(hashes)
            out[hit] = before + place
        return out


def _items(ids: list, texts: list[str]) -> Items:
    def hashed(values: list[str]) -> list[np.ndarray]:
        h, t = tokens(pa.array(values, pa.string()))
        cut = np.searchsorted(t, np.arange(len(values) + 1))
        return [h[a:b] for a, b in zip(cut[:-1], cut[1:])]

    words = hashed(texts)
    last = [[s for s in re.split(r"(?<=[.!?:])\s+|(?<=[\u3002\uff01\uff1f])", t.strip()) if s] for t in texts]
    answers = hashed([s[-1] if len(s) > 1 else "" for s in last])
    answers = [a if 3 <= len(a) < len(w) else w[-max(3, len(w) // 4):] for a, w in zip(answers, words)]
    owner, parts = [], []
    for k, w in enumerate(words):
        count = max(1, -(-len(w) // ITEM_WORDS))
        for part in np.array_split(w, count):
            owner.append(k)
            parts.append(part)
    vocabulary, last = (np.unique(np.concatenate(w)) if w else np.zeros(0, np.uint64) for w in (words, answers))
    return Items(ids, words, answers, np.array(owner, np.int64), parts, vocabulary, np.setdiff1d(last, vocabulary))


def _binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Slices of a number array as binary values."""
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def _joined(words: pa.Array, numbers: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words and numbers of all rows of a batch, and the bounds of the rows."""
    def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return arrays.flat(column.cast(pa.large_binary()).view(pa.large_string()))

    data, ends = flat(words)
    return data.view(np.int32), flat(numbers)[0].view(kind), ends // 4


def _known(texts: DataFrame, items: Items) -> DataFrame:
    """(id, words): the words of each text that has any, as numbers in ``items``."""
    shared = texts.sparkSession.sparkContext.broadcast(items)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, lookups = shared.value, shared.value.lookups()
        for piece in arrays.pieces(batches, "text"):
            hashes, text = tokens(piece.column("text"))
            filled, first = np.unique(text, return_index=True)
            if len(filled):
                words = _binary(items.numbers(hashes, lookups), np.append(first, len(hashes)))
                yield pa.RecordBatch.from_arrays([piece.column("id").take(pa.array(filled)), words], ["id", "words"])

    return texts.mapInArrow(work, "id bigint, words binary")


def _read(batches: Iterator[pa.RecordBatch], unknown: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Ids, numbers of the words and their texts' bounds, for texts of ``_known`` of bounded size together."""
    kind = np.min_scalar_type(unknown)
    for batch in batches:
        wide = batch.column(1).cast(pa.large_binary()).view(pa.large_string())
        for piece in arrays.pieces([pa.RecordBatch.from_arrays([batch.column(0), wide], ["id", "words"])], "words"):
            data, ends = arrays.flat(piece.column(1))
            yield piece.column(0), data.view(kind), ends // kind.itemsize


def _passages(words: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Distinct (block, word) with a word of the vocabulary in order, how often each is there, and the number of all blocks."""
    blocks = (np.diff(bounds) + STRIDE - 1) // STRIDE
    hit = np.flatnonzero(words < width)
    text = np.searchsorted(bounds, hit, "right") - 1
    block = (np.cumsum(blocks) - blocks)[text] + (hit - bounds[text]) // STRIDE
    pair, times = np.unique(block * width + words[hit], return_counts=True)
    return pair // width, pair % width, times, int(blocks.sum())


def _frequencies(known: DataFrame, items: Items) -> tuple[np.ndarray, int]:
    """Blocks of the corpus that hold each word, and all blocks."""
    width, unknown = len(items.vocabulary), items.unknown

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, blocks = np.zeros(width, np.int64), 0
        for _, words, bounds in _read(batches, unknown):
            _, word, _, n = _passages(words, bounds, width)
            blocks += n
            counts += np.bincount(word, minlength=width)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1), pa.int64()), pa.array(np.append(counts[some], blocks), pa.int64())],
                                         ["word", "n"])

    rows = known.mapInArrow(work, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(width, np.int64)
    inside = rows["word"] >= 0
    counts[rows["word"][inside].to_numpy(np.int64)] = rows["n"][inside].to_numpy(np.int64)
    return counts, int(rows["n"][~inside].sum())


def _weighed(known: DataFrame, items: Items, value: np.ndarray) -> DataFrame:
    """(words, weights, energy): TF-IDF vectors of the blocks that hold a word of some weight."""
    shared, unknown = known.sparkSession.sparkContext.broadcast(value), items.unknown

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = shared.value
        for _, words, bounds in _read(batches, unknown):
            block, word, times, _ = _passages(words, bounds, len(value))
            heavy = value[word] > 0
            block, word, times = block[heavy], word[heavy], times[heavy]
            weights = (value[word] * (1 + np.log(times))).astype(np.float32)
            filled, first = np.unique(block, return_index=True)
            if len(filled):
                offsets = np.append(first, len(block))
                energy = np.add.reduceat(weights.astype(np.float64) ** 2, first)
                yield pa.RecordBatch.from_arrays([_binary(word.astype(np.int32), offsets), _binary(weights, offsets), pa.array(energy)],
                                                 ["words", "weights", "energy"])

    return known.mapInArrow(work, "words binary, weights binary, energy double")


def _summed(basis: np.ndarray, word: np.ndarray, weight: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Weighted rows of the basis added up over the segments that start at ``first``; none is empty.

    Segments of one length are multiplied together.
    """
    length = np.diff(first, append=len(word))
    out = np.empty((len(first), basis.shape[1]), basis.dtype)
    for size in np.unique(length):
        chosen = np.flatnonzero(length == size)
        at = first[chosen, None] + np.arange(size)
        out[chosen] = np.einsum("nk,nkc->nc", weight[at], np.take(basis, word[at], axis=0))
    return out


def _ranges(first: np.ndarray, count: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges of ``count`` numbers from ``first`` on, each with the range's ``other``."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum())), np.repeat(other, count)


@dataclass
class Sought:
    """Parts whose matches fit into windows of ``wide`` blocks, and how often each holds each word."""

    wide: int
    part: np.ndarray
    least: np.ndarray
    loose: np.ndarray
    dense: np.ndarray
    first: np.ndarray
    holder: np.ndarray
    times: np.ndarray

    def common(self, slot: np.ndarray, word: np.ndarray, number: np.ndarray, windows: int) -> np.ndarray:
        """Words of every part that lie in every window, by the distinct (slot, word) of the texts' words.

        Words of many blocks are multiplied as a matrix, the others looked up.
        """
        often = number[word] >= 0
        held = np.zeros((windows + self.wide - 1, len(self.dense)), np.float32)
        held[slot[often], number[word[often]]] = 1
        any_block = held[:windows].copy()
        for k in range(1, self.wide):
            np.maximum(any_block, held[k: k + windows], out=any_block)
        total = any_block @ self.dense
        rare = ~often & (self.first[word + 1] > self.first[word])
        place = np.sort(word[rare] * np.int64(windows + self.wide) + slot[rare])
        word, slot = place // (windows + self.wide), place % (windows + self.wide)
        # windows that hold a word, without those that hold it in an earlier block
        since = np.diff(place, prepend=-self.wide)
        low, high = np.maximum(slot - np.minimum(since, self.wide) + 1, 0), np.minimum(slot, windows - 1)
        window, word = _ranges(low, np.maximum(high - low + 1, 0), word)
        at, window = _ranges(self.first[word], self.first[word + 1] - self.first[word], window)
        np.add.at(total.reshape(-1), window * len(self.part) + self.holder[at], self.times[at])
        return total


def _sought(items: Items, usual: np.ndarray) -> tuple[list[Sought], np.ndarray]:
    """The parts by size of their windows, and the numbers of the usual words among themselves."""
    number = np.where(usual, np.cumsum(usual) - 1, -1)
    length = np.array([len(p) for p in items.parts])
    long_enough = np.array([len(items.words[k]) >= LEAST_WORDS for k in items.owner])
    out, last = [], 0
    for wide in (2, 4):
        # a stretch of one word more than wide - 1 blocks lies whole in the window its first block opens
        fits = (np.array([_span(n) for n in length]) <= (wide - 1) * STRIDE + 1) & (length > last)
        last = int(length[fits].max(initial=last))
        chosen = np.flatnonzero(fits & long_enough)
        if not len(chosen):
            continue
        dense = np.zeros((int(usual.sum()), len(chosen)), np.float32)
        word, holder, times = [], [], []
        for k, p in enumerate(chosen):
            some, n = np.unique(np.searchsorted(items.vocabulary, items.parts[p]), return_counts=True)
            often = usual[some]
            dense[number[some[often]], k] = n[often]
            word.append(some[~often])
            holder.append(np.full(len(word[-1]), k))
            times.append(n[~often])
        order = np.argsort(np.concatenate(word), kind="stable")
        first = np.searchsorted(np.concatenate(word)[order], np.arange(len(usual) + 1))
        out.append(Sought(wide, chosen, np.ceil(PARAPHRASED * length[chosen]), np.ceil(RETOLD * length[chosen]), dense, first,
                          np.concatenate(holder)[order], np.concatenate(times)[order].astype(np.float32)))
    return out, number


@dataclass
class Space:
    """The latent space of a block of items: weights of words, their directions, the unit vectors of the parts."""

    value: np.ndarray
    basis: np.ndarray
    parts: np.ndarray

    def blocks(self, slot: np.ndarray, word: np.ndarray, slots: int) -> np.ndarray:
        """Latent vectors of blocks, from (slot, word) of the texts' words in order of slots."""
        pair, times = np.unique(slot * np.int64(len(self.value)) + word, return_counts=True)
        return self.sums(pair // len(self.value), pair % len(self.value), times, slots)

    def sums(self, slot: np.ndarray, word: np.ndarray, times: np.ndarray, slots: int) -> np.ndarray:
        """Latent vectors of blocks, from the distinct (slot, word) in order and how often they are there."""
        out = np.zeros((slots, self.basis.shape[1]), np.float32)
        heavy = self.value[word] > 0
        slot, word, times = slot[heavy], word[heavy], times[heavy]
        some, first = np.unique(slot, return_index=True)
        if len(some):
            weight = (self.value[word] * (1 + np.log(times))).astype(np.float32)
            out[some] = _summed(self.basis, word, weight, first)
        return out

    def cosines(self, blocks: np.ndarray, wide: int, windows: int, part: np.ndarray) -> np.ndarray:
        """Cosine of every window of ``wide`` blocks with every part."""
        total = blocks[:windows].copy()
        for k in range(1, wide):
            total += blocks[k: k + windows]
        total /= np.maximum(np.sqrt(np.einsum("ij,ij->i", total, total)), 1e-12)[:, None]
        return total @ self.parts[part].T

    def cosine(self, word: np.ndarray, part: int) -> float:
        point = self.blocks(np.zeros(len(word), np.int64), word, 1)[0]
        return float(self.parts[part] @ point) / max(float(np.linalg.norm(point)), 1e-12)


def _exact(items: Items) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(words, keys, parts) of the items that are sought as sequences of so many words, keys in order."""
    out = []
    for size in range(1, LEAST_WORDS):
        parts = np.array([p for p, k in enumerate(items.owner) if len(items.words[k]) == size], np.int64)
        if len(parts):
            keys = np.array([_sequence(np.searchsorted(items.vocabulary, items.parts[p]), size)[0] for p in parts], np.uint64)
            order = np.argsort(keys, kind="stable")
            out.append((size, keys[order], parts[order]))
    return out


def _sequence(words: np.ndarray, size: int) -> np.ndarray:
    """A number for every run of ``size`` words."""
    count = max(0, len(words) - size + 1)
    total = np.zeros(count, np.uint64)
    for k, factor in enumerate(arrays.factors(size, 11)):
        total += words[k: k + count].astype(np.uint64) * factor
    return arrays.mix(total)


def _rows(known: DataFrame, items: Items, space: Space, usual: np.ndarray) -> DataFrame:
    """(id, item_id, cosine, share): the best stretch of each text for each part of an item that it holds."""
    lookups = items.lookups()
    shared = known.sparkSession.sparkContext.broadcast((items, space, *_sought(items, usual), _exact(items), [_bits(items.numbers(p, lookups)) for p in items.parts],
                                                   [items.numbers(a, lookups) for a in items.answers]))

    def confirmed(part: int, share: float, words: np.ndarray, begin: int, end: int, at: int) -> tuple[float, float] | None:
        """Share and cosine of the part in a stretch that holds this share of it in order, if it is a match."""
        items, space, *_, answers = shared.value
        length = len(items.parts[part])
        near = words[at: min(end, at + _span(length))]
        cosine = space.cosine(near[near < len(items.vocabulary)].astype(np.int64), part)
        if share >= COPIED or (share >= PARAPHRASED and cosine >= ALIKE):
            return share, cosine
        answer = answers[items.owner[part]]
        answered = common_run(answer, words[max(begin, at - length): min(end, at + 3 * length)]) >= ANSWERED * len(answer)
        if answered and (share >= PARAPHRASED or cosine >= SIMILAR):
            return share, cosine
        return None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, space, groups, number, exact, places, _ = shared.value
        width, unknown = len(items.vocabulary), items.unknown
        marks = np.zeros(unknown + 1, np.uint64)
        widest = max([g.wide for g in groups], default=0)
        step = max(1, CELLS // max([space.basis.shape[1], *(max(len(g.part), len(g.dense)) for g in groups)]))
        for ids, words, begin in _read(batches, unknown):
            hit = np.flatnonzero(words < width)
            if not len(hit):
                continue
            text = np.searchsorted(begin, hit, "right") - 1
            word = words[hit].astype(np.int64)
            best: dict[tuple[int, int], tuple[float, float]] = {}
            for size, keys, parts in exact:
                key = _sequence(words, size)
                low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
                for at in np.flatnonzero(high > low):
                    d = int(np.searchsorted(begin, at, "right")) - 1
                    if at + size <= begin[d + 1] and (size > 1 or begin[d + 1] - begin[d] == 1):
                        best.update({(d, int(p)): (1.0, 1.0) for p in parts[low[at]:high[at]]})
            # texts are kept apart by blank slots
            blocks = (np.diff(begin) + STRIDE - 1) // STRIDE
            base = np.cumsum(blocks + GAP) - blocks - GAP
            slot = base[text] + (hit - begin[text]) // STRIDE
            slots = int(base[-1] + blocks[-1]) if groups else 0
            for opened in range(0, slots, step):
                windows = min(step, slots - opened)
                low, high = np.searchsorted(slot, [opened, opened + windows + widest - 1])
                if low == high:
                    continue
                pair, times = np.unique((slot[low:high] - opened) * width + word[low:high], return_counts=True)
                block, own = pair // width, pair % width
                latent = space.sums(block, own, times, windows + widest - 1)
                for group in groups:
                    inside = slice(0, np.searchsorted(block, windows + group.wide - 1))
                    common = group.common(block[inside], own[inside], number, windows)
                    cosine = space.cosines(latent, group.wide, windows, group.part)
                    # a neighbour without so many words in common can't be confirmed
                    cell = np.flatnonzero(common >= group.loose)
                    window, column = np.divmod(cell, len(group.part))
                    near = (cosine.reshape(-1)[cell] >= NEIGHBOUR) | (common.reshape(-1)[cell] >= group.least[column])
                    order = np.flatnonzero(near)[np.argsort(column[near], kind="stable")]
                    column, window = column[order], window[order]
                    doc = np.searchsorted(base, window + opened, "right") - 1
                    real = window + opened - base[doc] < blocks[doc]
                    column, window, doc = column[real], window[real] + opened, doc[real]
                    opening = begin[doc] + (window - base[doc]) * STRIDE
                    ends = begin[doc + 1]
                    size = np.minimum(ends - opening, group.wide * STRIDE)
                    cut = np.flatnonzero(np.diff(column, prepend=-1, append=-1))
                    found, begun = Stretches(), []
                    for low, high in zip(cut[:-1], cut[1:]):
                        part = int(group.part[column[low]])
                        some, bits = places[part]
                        marks[some] = bits
                        place = opening[low:high, None] + np.arange(group.wide * STRIDE)
                        mark = marks[words[np.minimum(place, len(words) - 1)]]
                        mark[place >= ends[low:high, None]] = 0
                        marks[some] = 0
                        found.add(mark, size[low:high], len(items.parts[part]), RETOLD)
                        begun.append((part, low))
                        if found.size < MARKS and high < len(column):
                            continue
                        for (part, low), (chosen, share, at) in zip(begun, found.best()):
                            for j in np.flatnonzero(share >= RETOLD):
                                k = low + chosen[j]
                                d = int(doc[k])
                                got = confirmed(part, float(share[j]), words, int(begin[d]), int(ends[k]), int(opening[k] + at[j]))
                                if got and got > best.get((d, part), (0.0, 0.0)):
                                    best[d, part] = got
                        found, begun = Stretches(), []
            if best:
                doc, item, cosine, share = zip(*((d, items.ids[int(items.owner[p])], c, s) for (d, p), (s, c) in sorted(best.items())))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(doc)), pa.array(item, pa.int64()), pa.array(cosine, pa.float64()), pa.array(share, pa.float64())],
                    ["id", "item_id", "cosine", "share"])

    return known.mapInArrow(work, "id bigint, item_id bigint, cosine double, share double")


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Words and weights of the passages that have some, and how many each has, of several batches together."""
    kept: list[tuple[np.ndarray, ...]] = []
    size = 0
    for batch in batches:
        index, value, bounds = _joined(batch.column(0), batch.column(1), np.float32)
        length = np.diff(bounds)
        kept.append((index, value, length[length > 0]))
        size += len(index)
        if size >= NUMBERS:
            yield tuple(np.concatenate(c) for c in zip(*kept))
            kept, size = [], 0
    if size:
        yield tuple(np.concatenate(c) for c in zip(*kept))


def _gram_times(rows: DataFrame, basis: np.ndarray) -> np.ndarray:
    """A' A Q for the matrix A of all passages: partial sums per task, added up per block of words."""
    spark = rows.sparkSession
    width = basis.shape[1]
    shared = spark.sparkContext.broadcast(basis.astype(np.float32))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        total = np.zeros(q.shape, np.float32)
        used = np.zeros(len(q), bool)
        for index, value, length in _gathered(batches):
            points = _summed(q, index, value, np.cumsum(length) - length)
            row = np.repeat(np.arange(len(length)), length)
            order = np.argsort(index, kind="stable")
            some, first = np.unique(index[order], return_index=True)
            total[some] += _summed(points, row[order], value[order], first)
            used[some] = True
        blocks = [k for k in range(0, len(q), CHUNK) if used[k: k + CHUNK].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks, pa.int64()), pa.array([total[k: k + CHUNK].tobytes() for k in blocks], pa.binary())], ["block", "part"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(p, np.float32).astype(np.float64) for p in pdf["part"])
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "part": [total.tobytes()]})

    out = np.zeros(basis.shape)
    sums = rows.select("words", "weights").mapInArrow(work, "block bigint, part binary").groupBy("block").applyInPandas(add, "block bigint, part binary")
    for block, part in sums.toPandas().itertuples(index=False):
        out[block: block + CHUNK] = np.frombuffer(part, np.float64).reshape(-1, width)
    return out


def latent_basis(rows: DataFrame, width: int, rank: int = RANK, seed: int = 5) -> np.ndarray:
    """Leading right singular vectors of the passages, by a randomised range finder.

    Only matrices of ``width`` words by ``rank`` columns reach the driver; ``width`` is bounded
    by the words of one block of benchmark items.
    """
    columns = min(width, rank + OVERSAMPLING)
    q = np.random.default_rng(seed).standard_normal((width, columns))
    for _ in range(1 + POWER_STEPS):
        q, _ = np.linalg.qr(_gram_times(rows, q))
    small = q.T @ _gram_times(rows, q)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    keep = [i for i in np.argsort(-values)[: min(rank, columns)] if values[i] > 1e-9 * max(values.max(), 1e-12)]
    return (q @ vectors[:, keep]).astype(np.float32)


def _matches(texts: DataFrame, items: Items) -> DataFrame | None:
    """(id, item_id, cosine, share) of all confirmed pairs for one block of items."""
    spark = texts.sparkSession
    if not len(items.vocabulary):
        return None
    known = stored(_known(texts, items))
    counts, blocks = _frequencies(known, items)
    weight = np.log((blocks + 1.0) / (counts + 1.0)).astype(np.float32)
    often = counts > max(COMMON * blocks, 1.0)
    usual = often.copy()
    places = [np.searchsorted(items.vocabulary, p) for p in items.parts]
    for place in places:
        if usual[place].all():  # an item of common words only needs them
            usual[place] = False
    value = np.where(usual, 0, np.maximum(weight, 1e-3)).astype(np.float32)
    vectors = []
    for place in places:
        some, times = np.unique(place, return_counts=True)
        vectors.append((some.astype(np.int32), (value[some] * (1 + np.log(times))).astype(np.float32)))
    rows = stored(_weighed(known, items, value))
    # the items have as much say in the directions as the corpus
    energy = rows.agg(F.coalesce(F.sum("energy"), F.lit(0.0))).first()[0]
    own = sum(float((v.astype(np.float64) ** 2).sum()) for _, v in vectors)
    scale = np.float32(np.sqrt(max(energy, 1.0) / max(own, 1e-12)))
    asked = spark.createDataFrame(pd.DataFrame([(i.tobytes(), (v * scale).tobytes()) for i, v in vectors], columns=["words", "weights"]),
                                  "words binary, weights binary")
    basis = latent_basis(rows.select("words", "weights").unionByName(asked), len(items.vocabulary))
    latent = np.stack([v @ basis[i] for i, v in vectors])
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    return _rows(known, items, Space(value, basis, latent), often)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, item_id, cosine, share): documents that hold an item, once for each item."""
    spark = prepared(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    count, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(-(-count // ITEMS_AT_ONCE), -(-chars // CHARS_AT_ONCE))
    found = spark.createDataFrame([], "id bigint, item_id bigint, cosine double, share double")
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        if part:
            got = _matches(texts, _items([r[0] for r in part], [r[1] for r in part]))
            found = found if got is None else found.unionByName(stored(got))
    return stored(found.groupBy("id", "item_id").agg(F.max("cosine").alias("cosine"), F.max("share").alias("share")))


def flagged(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every id with ``contaminated``, the number of items it holds, the best of them and its scores."""
    best = leaks(docs, benchmark, id_col, text_col).groupBy(F.col("id").alias("_id")).agg(
        F.count("*").alias("n_items"), F.max_by("item_id", F.struct("share", -F.col("item_id"))).alias("item_id"),
        F.max("share").alias("share"), F.max("cosine").alias("cosine"))
    return (docs.select(F.col(id_col).cast("bigint").alias("id")).join(best, F.col("id").eqNullSafe(F.col("_id")), "left")
            .select("id", F.col("n_items").isNotNull().alias("contaminated"),
                    F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"), "item_id", "share", "cosine"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item.

    Rows are told apart by id and text: a clean text under the id of another, or without an id, stays.
    """
    row, text = (F.col(f"`{c}`").cast("string") for c in (id_col, text_col))
    key = F.xxhash64(row.isNull(), row, text)
    gone = leaks(docs.select(key.alias("doc_id"), text.alias("text")), benchmark)
    name = unused(docs, "_gone")
    return docs.join(gone.select(F.col("id").alias(name)).distinct(), key == F.col(name), "left_anti")
