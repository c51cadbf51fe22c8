"""Texts of an Arrow batch as flat byte arrays: words, their hashes and sums per text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20
"""Text bytes worked on at once; a single longer text is worked on alone."""

SPACES = np.zeros(256, bool)
SPACES[[0x20, 9, 10, 11, 12, 13]] = True
NOT_WORD = np.ones(256, bool)
NOT_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    h = values.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def factors(count: int, seed: int = 1) -> np.ndarray:
    """``count`` odd 64-bit numbers that depend on their place and the seed only."""
    steps = np.arange(1, count + 1, dtype=np.uint64) + np.uint64(seed << 32)
    return mix(steps * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 offsets of the texts in them; null is empty."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1]
    ends = ends.astype(np.int64)
    return np.frombuffer(data, np.uint8)[ends[0]: ends[-1]], ends - ends[0]


def pieces(batches: Iterable[pa.RecordBatch], text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts have about ``limit`` bytes together."""
    for batch in batches:
        _, ends = flat(batch.column(text))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(ends, ends[begin] + limit, "right")) - 1
            end = max(begin + 1, min(end, batch.num_rows))
            yield batch.slice(begin, end - begin)
            begin = end


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def lower_latin(data: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the accented letters of Latin-1."""
    out = _LOWER[data]
    if len(data) > 1:
        accented = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][accented] += 32
    return out


def lower_letters(data: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the Latin-1, Greek and Cyrillic letters without further marks."""
    out = lower_latin(data)
    if not ((data >= 0xCE) & (data <= 0xD0)).any():
        return out
    lead, tail = data[:-1], data[1:]
    greek, cyrillic = lead == 0xCE, lead == 0xD0
    for chosen, step, moved in ((greek & (tail >= 0x91) & (tail <= 0x9F), 0x20, 0), (greek & (tail >= 0xA0) & (tail <= 0xAB), -0x20, 1),
                                (cyrillic & (tail >= 0x90) & (tail <= 0x9F), 0x20, 0), (cyrillic & (tail >= 0xA0) & (tail <= 0xAF), -0x20, 1),
                                (cyrillic & (tail >= 0x80) & (tail <= 0x8F), 0x10, 1)):
        at = np.flatnonzero(chosen)
        out[at] += np.uint8(moved)
        out[at + 1] = (out[at + 1].astype(np.int16) + step).astype(np.uint8)
    return out


def characters_apart(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray):
    """The spans with each character of a script without blanks (Han, kana, Thai, Lao, Khmer, Burmese) as its own."""
    lead = np.flatnonzero(data >= 0xE0)
    if not len(lead) or not len(starts):
        return starts, ends, text
    first, second = data[lead], data[np.minimum(lead + 1, len(data) - 1)]
    three = ((first >= 0xE3) & (first <= 0xE9)) | ((first == 0xE0) & (second >= 0xB8) & (second <= 0xBB))
    three |= (first == 0xE1) & (((second >= 0x80) & (second <= 0x82)) | (second == 0x9E) | (second == 0x9F))
    four = (first == 0xF0) & (second >= 0xA0) & (second <= 0xB3)
    alone = lead[three | four]
    cuts = np.concatenate([starts, alone, alone + np.where(four, 4, 3)[three | four]])
    cuts = np.unique(cuts)
    word = np.searchsorted(starts, cuts, "right") - 1
    inside = (word >= 0) & (cuts < ends[word])
    cuts, word = cuts[inside], word[inside]
    return cuts, np.minimum(ends[word], np.append(cuts[1:], len(data))), text[word]


def word_spans(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = SPACES):
    """Start, end and text number of every word, a longest run without bytes of ``gaps``."""
    solid = ~gaps[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each byte span; spans are in order and don't overlap."""
    out = np.empty(len(starts), np.uint64)
    begin = 0
    while begin < len(starts):
        end = int(np.searchsorted(starts, starts[begin] + PIECE_BYTES, "left"))
        end = max(end, begin + 1)
        s, e = starts[begin:end], ends[begin:end]
        length = e - s
        place = np.cumsum(length) - length
        inside = np.arange(int(length.sum())) - np.repeat(place, length)
        values = data[np.repeat(s, length) + inside].astype(np.uint64) + np.uint64(1)
        values *= factors(int(length.max()), seed)[inside]
        out[begin:end] = np.add.reduceat(values, place) + length.astype(np.uint64)
        begin = end
    return mix(out)


def shingles(hashes: np.ndarray, text: np.ndarray, texts: int, width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of ``width`` words running for each text.

    A text with fewer words has one shingle, its whole word sequence; one without words none.
    """
    bounds = np.searchsorted(text, np.arange(texts + 1))
    weight = factors(width, 7)
    if len(hashes) >= width:
        runs = np.zeros(len(hashes) - width + 1, np.uint64)
        for i in range(width):
            runs += hashes[i: len(hashes) - width + 1 + i] * weight[i]
        runs = mix(runs)
    else:
        runs = np.zeros(0, np.uint64)
    out = []
    for begin, end in zip(bounds[:-1], bounds[1:]):
        if end - begin >= width:
            out.append(np.unique(runs[begin: end - width + 1]))
        elif end > begin:
            short = (hashes[begin:end] * weight[: end - begin]).sum(dtype=np.uint64)
            out.append(mix(np.array([short + np.uint64(end - begin)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]
