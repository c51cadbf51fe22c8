"""Runs of periodically repeated words.

A run is a longest stretch of words with smallest period q (words q apart are equal) and a length of
at least ``LEAST`` and 2 q. Its words occur at least twice in it, so a word that occurs once in a segment
of the text is in none of the segment's runs and splits it. Parts are split again by their own counts
until nothing changes; parts shorter than ``LEAST`` go. The segments that are left are scanned lag by lag:
a run of period q has more than max(q, LEAST - q) neighbouring words that equal the words q later, so it is enough
to look at every max(q, LEAST - q)-th word, about m ln m comparisons for m words, and to extend the hits.
Lags rise by doubling ranges; a hit within a known run whose period divides the lag belongs to that run, any
other one that is long enough is a run with the lag as its smallest period.

Null and empty texts and texts of fewer than ``LEAST`` words have no run. Rows that repeat an id are scanned each;
other columns are not read; without rows there are none. Words are told apart exactly. Memory grows with the
longest text only (about 100 bytes for each of its words).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import arrays
from millrace.llm.shared import prepared

LEAST = 12
ROUNDS = 64
"""Splitting ends here at the latest; it only saves comparisons, so the runs found stay the same."""
PROBES = 1 << 20
"""Words looked at together."""
NEAR = 8
"""Words by which all hits are extended together before the rest are extended one by one."""

RUN_TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"
_ARROW_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def segments(ids: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of the parts of a word sequence that may hold runs."""
    live, part = np.arange(len(ids)), np.zeros(len(ids), np.int64)
    words = int(ids.max()) + 1 if len(ids) else 1
    done: list[tuple[int, int]] = []
    for _ in range(ROUNDS):
        if not len(live):
            return done
        _, place, times = np.unique(part * words + ids[live], return_inverse=True, return_counts=True)
        stay = times[place] >= 2
        changed = np.zeros(int(part[-1]) + 1, bool)
        changed[part[~stay]] = True
        calm = ~changed[part]
        if calm.any():  # parts that lost no word are final
            rest = live[calm]
            first = np.concatenate([[True], np.diff(part[calm]) != 0])
            begins = rest[first]
            ends = np.append(rest[np.flatnonzero(first)[1:] - 1], rest[-1]) + 1
            done += [(int(a), int(b)) for a, b in zip(begins, ends)]
        live = live[stay & ~calm]
        part = np.concatenate([[0], np.cumsum(np.diff(live) != 1)]).astype(np.int64) if len(live) else live
        if len(live):
            long = np.bincount(part)[part] >= LEAST
            live, part = live[long], part[long]
            if len(live):
                part = np.concatenate([[0], np.cumsum(np.diff(part) != 0)])
    if not len(live):
        return done
    edge = np.flatnonzero(np.diff(part) != 0)
    begins, ends = live[np.concatenate([[0], edge + 1])], live[np.concatenate([edge, [len(live) - 1]])] + 1
    return done + [(int(a), int(b)) for a, b in zip(begins, ends)]


def _ahead(w: np.ndarray, at: int, lag: int) -> int:
    """How many words from ``at`` on equal the words ``lag`` later."""
    done, size = 0, 64
    while True:
        later = w[at + done + lag: at + done + lag + size]
        other = np.flatnonzero(w[at + done: at + done + len(later)] != later)
        if len(other):
            return done + int(other[0])
        done += len(later)
        if len(later) < size:
            return done
        size *= 2


def _back(w: np.ndarray, at: int, lag: int) -> int:
    """How many words right before ``at`` equal the words ``lag`` later."""
    done, size = 0, 64
    while done < at:
        low = max(at - done - size, 0)
        other = np.flatnonzero(w[low: at - done] != w[low + lag: at - done + lag])
        if len(other):
            return at - 1 - (low + int(other[-1]))
        done, size = at - low, size * 2
    return at


def _probes(m: int, lags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words to look at for each lag, and their lags."""
    step = np.maximum(lags, LEAST - lags)
    count = -(-(m - lags) // step)
    lag = np.repeat(lags, count)
    first = np.repeat(np.cumsum(count) - count, count)
    return (np.arange(len(lag)) - first) * np.repeat(step, count), lag


def _hits(w: np.ndarray, p: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The probes whose equal neighbours may be enough for a run."""
    same = w[p] == w[p + lag]
    p, lag = p[same], lag[same]
    reach = [np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)]
    for side, sign in ((0, 1), (1, -1)):
        alive = np.arange(len(p))
        for k in range(1, NEAR + 1):
            x = p[alive] + sign * k
            inside = (x >= 0) & (x + lag[alive] < len(w))
            alive, x = alive[inside], x[inside]
            alive = alive[w[x] == w[x + lag[alive]]]
            reach[side][alive] = k
    need = np.maximum(lag, LEAST - lag)
    stay = (reach[0] == NEAR) | (reach[1] == NEAR) | (reach[0] + reach[1] + 1 >= need)
    return p[stay], lag[stay]


def _unknown(p: np.ndarray, lag: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which hits lie in no known run whose period divides their lag."""
    fresh = np.ones(len(p), bool)
    if len(found) == 0 or len(p) == 0:
        return fresh
    if len(p) <= len(found):
        for i in range(len(p)):
            inside = (found[:, 0] <= p[i]) & (p[i] + lag[i] < found[:, 1])
            fresh[i] = not (lag[i] % found[inside, 2] == 0).any()
        return fresh
    order = np.argsort(p, kind="stable")
    sorted_p, sorted_lag = p[order], lag[order]
    for start, end, period in found:
        a, b = np.searchsorted(sorted_p, (start, end))
        covered = (sorted_p[a:b] + sorted_lag[a:b] < end) & (sorted_lag[a:b] % period == 0)
        fresh[order[a:b][covered]] = False
    return fresh


def scan(w: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs of a word sequence."""
    m, found, low = len(w), np.zeros((0, 3), np.int64), 1
    while 2 * low <= m:
        top = min(2 * low, m // 2 + 1)
        new: list[tuple[int, int, int]] = []
        begin = low
        while begin < top:  # lags of one doubling range, none a multiple of another
            each = m // max(begin, LEAST - begin) + 1
            end = min(top, begin + max(1, PROBES // each))
            p, lag = _hits(w, *_probes(m, np.arange(begin, end)))
            fresh = _unknown(p, lag, found)
            last, until = 0, 0
            for at, q in zip(p[fresh].tolist(), lag[fresh].tolist()):
                if q == last and at < until:
                    continue
                a, b = at - _back(w, at, q), at + _ahead(w, at, q)
                last, until = q, b
                if b - a >= max(q, LEAST - q):
                    new.append((a, b + q, q))
            begin = end
        if new:
            found = np.concatenate([found, np.array(new, np.int64)])
        low *= 2
    return [tuple(r) for r in found.tolist()]


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs by start, then period."""
    out = [(begin + s, e - s, q) for begin, end in segments(ids) for s, e, q in scan(ids[begin:end])]
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Words that no run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.flatnonzero(np.cumsum(change[:n]) == 0)


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs, collapsed) of every row: its runs, and its words without repeats, joined by blanks."""
    prepared(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrays.pieces(batches, "text"):
            data, ends = arrays.flat(piece.column("text"))
            counts, found, short = [], [], []
            for a, b in zip(ends[:-1], ends[1:]):
                words = data[a:b].tobytes().split()  # at ASCII blanks only
                runs = runs_of(numbered(words)) if len(words) >= LEAST else []
                counts.append(len(words))
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                if runs:
                    words = [words[i] for i in kept_words(len(words), runs).tolist()]
                short.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(counts, pa.int64()), pa.array(found, _ARROW_RUNS),
                                              pa.array(short, pa.binary()).cast(pa.string())], ["id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(work, f"id {kind}, n_words bigint, runs {RUN_TYPE}, collapsed string")
