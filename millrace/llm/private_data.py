"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors: at-signs, address schemes, plus signs and digits that
can open a number, and words that announce an account. From each anchor a local parser expands
to the boundaries of its kind and validates what it got (domain labels, octets, check digits).

Kinds: ``email``, ``ip``, ``card`` (Luhn), ``phone`` are leftmost and don't overlap within a kind; a match that
fails validation is passed over whole. ``url`` (scheme with a host), ``iban`` (mod 97) and
``account`` (an announced identifier) are added. Offsets are code points, ends are exclusive.
Null and empty texts have no spans. Ids are carried as they are, repeated rows are answered each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.llm import arrays
from millrace.llm.shared import prepared

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "account")
CUES = ("iban", "account", "acct", "passport", "ssn", "token", "api_key", "apikey", "secret", "password")
SCHEMES = ("http://", "https://", "ftp://")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL = re.compile(r"(?:https?|ftp)://[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]+)?(?:/[^\s\"'<>]*)?", re.I)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"(?:\s++(?:no\.?|number|id))?\s*+[:=#]?\s*+[\"']?([A-Za-z0-9_-]{8,})", re.I)


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    found.add_word("@", ("email", 1))
    found.add_word("+", ("phone", 1))
    for d in "0123456789":
        found.add_word(d, ("digit", 1))
    for word in SCHEMES:
        for form in {word, word.upper(), word.capitalize()}:
            found.add_word(form, ("url", len(word)))
    for word in CUES:
        for form in {word, word.upper(), word.capitalize()}:
            found.add_word(form, ("cue", len(word)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _octet(digits: str) -> bool:
    digits = digits.lstrip("0")  # numbers of over 4300 digits can't be read
    return len(digits) <= 3 and int(digits or "0") <= 255


def _mod97(text: str) -> bool:
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def spans_of(text: str, anchors: ahocorasick.Automaton) -> dict[str, list[tuple[int, int]]]:
    """Start and end of every span of every kind."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys((*KINDS, "cue"), 0)
    for last, (kind, width) in anchors.iter(text):
        at = last - width + 1
        if kind == "email":
            start = at
            while start > done["email"] and text[start - 1] in _LOCAL:
                start -= 1
            hit = _DOMAIN.match(text, at) if start < at else None
            if hit:
                out["email"].append((start, hit.end()))
                done["email"] = hit.end()
        elif kind == "phone":
            hit = _PHONE.match(text, at) if at >= done["phone"] else None
            if hit:
                done["phone"] = hit.end()
                if 9 <= sum(c in _DIGITS for c in hit.group()) <= 15:
                    out["phone"].append(hit.span())
        elif kind == "digit":
            if at >= done["card"]:
                hit = _CARD.match(text, at)
                done["card"] = hit.end() if hit else at + 1
                if hit:
                    digits = hit.group().replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        out["card"].append(hit.span())
            # the last digit before a point opens an address from the first of its run
            if at >= done["ip"] and text[at + 1: at + 2] == ".":
                start = at
                while start > done["ip"] and text[start - 1] in _DIGITS:
                    start -= 1
                hit = _IP.match(text, start)
                if hit:
                    done["ip"] = hit.end()
                    if all(_octet(p) for p in hit.group().split(".")):
                        out["ip"].append(hit.span())
        elif kind == "url":
            hit = _URL.match(text, at) if at >= done["url"] else None
            if hit:
                end = hit.end()
                while text[end - 1] in ".,;:!?)":
                    end -= 1
                out["url"].append((at, end))
                done["url"] = end
        elif at >= done["cue"] and (at == 0 or not text[at - 1].isalnum()):
            word = text[at: last + 1].lower()
            start = last + 1
            while start < len(text) and text[start] in " :=#":
                start += 1
            hit = _IBAN.match(text, start) if word in ("iban", "account", "acct") else None
            if hit and _mod97(hit.group().replace(" ", "")):
                out["iban"].append(hit.span())
                done["cue"] = hit.end()
                continue
            hit = _ACCOUNT.match(text, last + 1)
            if hit and sum(c in _DIGITS for c in hit.group(1)) >= 4:
                out["account"].append(hit.span(1))
                done["cue"] = hit.end(1)
    return out


def redacted(text: str, spans: dict[str, list[tuple[int, int]]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind."""
    marks = sorted((s, -e, KINDS.index(k)) for k, v in spans.items() for s, e in v)
    out, at = [], 0
    for start, end, kind in marks:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
            at = -end
        else:
            at = max(at, -end)
    return "".join([*out, text[at:]])


_SPAN = "array<struct<kind:string,start:int,end:int>>"


def detect(docs: DataFrame, redact: bool = False, text_col: str = "text") -> DataFrame:
    """(row, spans[, redacted]): ``row`` is the input row, or only its id where nothing is redacted."""
    prepared(docs.sparkSession)
    names = docs.columns if redact else [c for c in docs.columns if c != text_col]
    frame = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = frame.select("row").schema.add("spans", T.StructType.fromDDL(f"s {_SPAN}")["s"].dataType).add("redacted", "string")
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton()
        for batch in arrays.pieces(batches, "text"):
            found, clean = [], []
            for text in batch.column("text").to_pylist():
                spans = spans_of(text or "", anchors)
                found.append([{"kind": k, "start": s, "end": e} for k in KINDS for s, e in spans[k]])
                clean.append((redacted(text, spans) if text and found[-1] else text) if redact else None)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, kind_type), pa.array(clean, pa.string())],
                                             ["row", "spans", "redacted"])

    return frame.mapInArrow(work, schema)


def digest(spans: str = "spans") -> list:
    """The counts of the base kinds, the digest of their spans and all spans as text."""
    part = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    base = F.filter(spans, lambda x: x["kind"].isin(*BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return [*[count(k) for k in BASE],
            F.sha2(F.array_join(F.transform(base, part), ","), 256).alias("base_sha256"),
            F.array_join(F.transform(F.col(spans), part), ",").alias("spans")]


def masked(docs: DataFrame) -> DataFrame:
    """The documents with their personal data replaced, ``n_chars`` counted anew."""
    found = detect(docs, redact=True)
    new = F.col("redacted")
    return found.select(*[new.alias(c) if c == "text" else F.when(new.isNull(), F.col("row")[c]).otherwise(F.char_length(new)).cast(docs.schema[c].dataType).alias(c)
                          if c == "n_chars" else F.col("row")[c].alias(c) for c in docs.columns])

