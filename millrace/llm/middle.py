"""Fill-in-the-middle from seekable compressed frames.

``frames`` stores every text as independent zstandard frames of about ``FRAME`` bytes, each with the units
and characters it adds, so the k-th unit of a text is found by the running counts and one decompressed
frame. A unit is a longest run of ASCII letters or one other code point; a unit belongs to the frame
it begins in, so a run of letters of any length is cut over frames without moving a unit.

``fill`` cuts each stored text into prefix, middle and suffix and writes the output as a list of frames
again: only frames with a cut are decompressed and written anew, all others are taken over as they are.
``digests`` hashes the output, and the text rebuilt from it, frame by frame; ``output_text`` and
``restore`` give whole texts. Working memory is one frame beside the compressed text.

Null and empty texts have no frames and stay plain, as do texts that hold a marker. A null id is drawn for as
the empty string; rows that repeat an id are cut alike. Other columns are not read; without rows there are none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm import arrays
from millrace.llm.shared import prepared

FRAME = 1 << 16
LEVEL = 1
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
PLAIN_FROM = 90
"""Per cent of texts that are rearranged; the others stay plain."""
SPM_BELOW = 20
"""Per cent of the rearranged texts with the suffix first."""

FRAME_TYPE = "array<struct<data:binary,units:bigint,chars:bigint,joined:boolean>>"
_ARROW_FRAME = pa.list_(pa.struct([("data", pa.binary()), ("units", pa.int64()), ("chars", pa.int64()), ("joined", pa.bool_())]))
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def unit_starts(data: np.ndarray, joined: bool) -> np.ndarray:
    """Places of the bytes that begin a unit; ``joined`` if a letter stands before the data."""
    letter = _LETTER[data]
    before = np.empty(len(data), bool)
    before[:1] = joined
    before[1:] = letter[:-1]
    return np.flatnonzero(((data & 0xC0) != 0x80) & ~(letter & before))


def _chars(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def cut_frames(data: np.ndarray, size: int = FRAME) -> list[dict]:
    """The frames of one text, each ending at a whole code point."""
    press = zstandard.ZstdCompressor(level=LEVEL)
    out, begin = [], 0
    while begin < len(data):
        end = min(begin + size, len(data))
        while end < len(data) and end > begin + 1 and data[end] & 0xC0 == 0x80:
            end -= 1
        part = data[begin:end]
        joined = begin > 0 and bool(_LETTER[data[begin - 1]])
        out.append({"data": press.compress(part.tobytes()), "units": len(unit_starts(part, joined)), "chars": _chars(part), "joined": joined})
        begin = end
    return out


def frames(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = FRAME) -> DataFrame:
    """(id, n, marked, frames): units of every text, whether it holds a marker, and its frames in order."""
    prepared(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrays.pieces(batches, "text"):
            data, ends = arrays.flat(piece.column("text"))
            cut, marked = [], []
            for a, b in zip(ends[:-1], ends[1:]):
                text = data[a:b]
                cut.append(cut_frames(text, size))
                whole = text.tobytes()
                marked.append(any(m in whole for m in (PREFIX, SUFFIX, MIDDLE)))
            n = [sum(f["units"] for f in one) for one in cut]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(n, pa.int64()), pa.array(marked, pa.bool_()), pa.array(cut, _ARROW_FRAME)],
                                             ["id", "n", "marked", "frames"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(work, f"id {kind}, n bigint, marked boolean, frames {FRAME_TYPE}")


def draws(id_col: Column, seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit numbers from the digest of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


class _Text:
    """A stored text: places of units, spans of frames."""

    def __init__(self, stored: list[dict]):
        self.stored = stored
        self.unit_ends = np.cumsum([f["units"] for f in stored])
        self.chars_before = np.concatenate([[0], np.cumsum([f["chars"] for f in stored])])
        self.opened: dict[int, bytes] = {}

    def bytes_of(self, k: int) -> bytes:
        if k not in self.opened:  # at most the two frames with a cut are opened
            self.opened[k] = zstandard.ZstdDecompressor().decompress(self.stored[k]["data"])
        return self.opened[k]

    def place(self, unit: int) -> tuple[int, int, int]:
        """Frame and byte in it where a unit begins, and the characters before it; the end for the unit after the last."""
        if unit >= self.unit_ends[-1]:
            return len(self.stored), 0, int(self.chars_before[-1])
        k = int(np.searchsorted(self.unit_ends, unit, "right"))
        data = np.frombuffer(self.bytes_of(k), np.uint8)
        at = int(unit_starts(data, self.stored[k]["joined"])[unit - (int(self.unit_ends[k - 1]) if k else 0)])
        return k, at, int(self.chars_before[k]) + _chars(data[:at])

    def span(self, a: tuple[int, int], b: tuple[int, int], press: zstandard.ZstdCompressor) -> list[bytes]:
        """Frames from one place to another; whole frames are not touched."""
        out, (k, at) = [], a
        while (k, at) < b:
            end = b[1] if k == b[0] else None
            if at == 0 and end is None:
                out.append(self.stored[k]["data"])
            else:
                part = self.bytes_of(k)[at:end]
                if part:
                    out.append(press.compress(part))
            k, at = k + 1, 0
        return out


def rearranged(stored: list[dict], form: str, units: tuple[int, int], press: zstandard.ZstdCompressor) -> tuple[int, int, list[bytes]]:
    """(prefix characters, middle characters, frames of the output) with the middle between two units."""
    text = _Text(stored)
    (k1, b1, c1), (k2, b2, c2) = text.place(units[0]), text.place(units[1])
    parts = {PREFIX: text.span((0, 0), (k1, b1), press), MIDDLE: text.span((k1, b1), (k2, b2), press),
             SUFFIX: text.span((k2, b2), (len(stored), 0), press)}
    out: list[bytes] = []
    for mark in ORDER[form]:
        out += [press.compress(mark), *parts[mark]]
    return c1, c2 - c1, out


def fill(stored: DataFrame, seed: int = 1) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every stored text; ``output`` is a list of frames."""
    h1, h2, h3, h4 = draws(F.col("id"), seed)
    n1 = F.col("n") + 1
    form = F.when((F.col("n") == 0) | F.col("marked") | (h3 % 100 >= PLAIN_FROM), "plain").when(h4 % 100 < SPM_BELOW, "spm").otherwise("psm")
    rows = stored.select("id", "n", form.alias("form"), F.least(h1 % n1, h2 % n1).alias("a"), F.greatest(h1 % n1, h2 % n1).alias("b"), "frames")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            out: list[tuple] = []
            for form, a, b, cut in zip(*[batch.column(k).to_pylist() for k in range(2, 6)]):
                out.append((None, None, [f["data"] for f in cut]) if form == "plain" else rearranged(cut, form, (a, b), press))
            columns = list(zip(*out)) if out else [()] * 3
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *[pa.array(c, t) for c, t in zip(columns, kinds)]],
                                             ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(work, f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output array<binary>")


def stream(output: list[bytes]) -> Iterator[bytes]:
    """The bytes of the frames, one frame at a time."""
    expand = zstandard.ZstdDecompressor()
    for frame in output:
        yield expand.decompress(frame)


def _marks(output: list[bytes], form: str) -> list[int]:
    """Where each marker of the form begins; found in the bytes, also across frames."""
    found: list[int] = []
    tail, base = b"", 0
    for part in stream(output):
        view, at = tail + part, 0
        while len(found) < 3:
            at = view.find(ORDER[form][len(found)], at)
            if at < 0:
                break
            found.append(base + at)
            at += 3
        tail = view[-2:]  # too short for a marker that was found already
        base += len(view) - len(tail)
    return found


def restored(output: list[bytes], form: str) -> Iterator[bytes]:
    """The bytes of the text that an output was made from, in order, by parts of at most a frame."""
    if form == "plain":
        yield from stream(output)
        return
    marks = _marks(output, form)
    ends = [*marks[1:], None]
    spans = {mark: (a + 3, b) for mark, a, b in zip(ORDER[form], marks, ends)}
    for mark in (PREFIX, MIDDLE, SUFFIX):
        a, b = spans[mark]
        begin = 0
        for part in stream(output):
            end = begin + len(part)
            if end > a and (b is None or begin < b):
                yield part[max(a - begin, 0): None if b is None else max(b - begin, 0)]
            begin = end
            if b is not None and begin >= b:
                break


def output_text(output: list[bytes]) -> str:
    return b"".join(stream(output)).decode("utf-8", "surrogatepass")


def restore(output: list[bytes], form: str) -> str:
    return b"".join(restored(output, form)).decode("utf-8", "surrogatepass")


def _digest(parts: Iterator[bytes]) -> str:
    digest = hashlib.sha256()
    for part in parts:
        digest.update(part)
    return digest.hexdigest()


def digests(filled: DataFrame) -> DataFrame:
    """The filled rows with ``output_sha256`` and ``restored_sha256`` in place of the output."""
    keep = ["id", "n", "form", "prefix_chars", "middle_chars"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, again = [], []
            for form, output in zip(batch.column("form").to_pylist(), batch.column("output").to_pylist()):
                made.append(_digest(stream(output)))
                again.append(_digest(restored(output, form)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(made, pa.string()), pa.array(again, pa.string())],
                                             [*keep, "output_sha256", "restored_sha256"])

    kind = filled.schema["id"].dataType.simpleString()
    return filled.select(*keep, "output").mapInArrow(
        work, f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string")
