"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import itertools
import re

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_set(text: str | None, width: int) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if len(words) >= width:
        return frozenset(zip(*(words[i:] for i in range(width))))
    return frozenset([tuple(words)]) if words else frozenset()


def near_components(texts: dict[int, str | None], width: int, percent: int) -> tuple[dict[int, int], dict[int, int]]:
    """Component and number of shingles of each id; all pairs are compared."""
    sets = {i: word_set(t, width) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}, {i: len(s) for i, s in sets.items()}


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text: str | None) -> str:
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m.group())
            if (kind == "ip" and any(int(p.lstrip("0")[:4] or "0") > 255 for p in m.group().split("."))
                    or kind == "card" and not (13 <= len(digits) <= 19 and _luhn(digits))
                    or kind == "phone" and not 9 <= len(digits) <= 15):
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def mixing_targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, full = float(sum(sizes.values())), {}
    while True:
        open_ = [s for s in names if s not in full]
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > 3 * sizes[s]]
        if not over:
            return full | {s: left * weight[s] / total for s in open_}
        for s in over:
            full[s] = 3.0 * sizes[s]
        left = sum(sizes.values()) - sum(full.values())


def edited(texts: list[str]) -> list[str]:
    """Texts in descending order of ids, each with its last half replaced."""
    out = []
    for k, t in enumerate(texts):
        after, half = texts[(k + 1) % len(texts)], len(t) // 2
        out.append(t[: len(t) - half] + after[:half])
    return out


def subsequence(a: list, b: list) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]
