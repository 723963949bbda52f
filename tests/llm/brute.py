"""Plain versions of the operators, one document or pair at a time."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

BLANK = re.compile("[^\x20\x09-\x0d]+")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def quality(text: str | None) -> tuple:
    text = text or ""
    words = BLANK.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if BLANK.search(line):
            dup += line in seen
            seen.add(line)
    times = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if times[tuple(words[i : i + 3])] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), failed


def quality_keeps(rows: list[dict], limit: float = 0.8) -> list[bool]:
    failed = [quality(r["text"])[5] for r in rows]
    by_host = defaultdict(list)
    for r, f in zip(rows, failed, strict=True):
        if r["source"] is not None:
            by_host[r["source"]].append(f)
    rates = [sum(v) / len(v) for v in by_host.values()]
    m = sum(rates) / len(rates) if rates else 0
    v = sum((x - m) ** 2 for x in rates) / len(rates) if rates else 0
    weight = max(m * (1 - m) / v - 1, 0) if v > 1e-12 else None
    shrunk = {h: (sum(x) + m * weight) / (len(x) + weight) if weight is not None else m for h, x in by_host.items()}
    return [not f and shrunk.get(r["source"], 0) < limit for r, f in zip(rows, failed, strict=True)]


def shingles(text: str | None) -> frozenset:
    words = BLANK.findall(lower(text))
    return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))) if words else frozenset()


def jaccard_classes(rows: list[dict]) -> list[int]:
    sets = [shingles(r["text"]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r["doc_id"] is not None:
            least[find(i)] = min(least.get(find(i), r["doc_id"]), r["doc_id"])
    return [least.get(find(i)) if sets[i] else r["doc_id"] for i, r in enumerate(rows)]


def repeats(texts: list[bytes], size: int = 200) -> list[list[tuple[int, int]]]:
    times = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for t in texts:
        spans: list = []
        for i in range(len(t) - size + 1):
            if times[t[i : i + size]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], i + size)
                else:
                    spans.append((i, i + size))
        out.append(spans)
    return out


def cut(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    gone = {k for a, b in spans for k in range(a, b)}
    return bytes(c for k, c in enumerate(data) if k not in gone)


def hits(text: str | None, items: list[tuple[str, str | None]]) -> tuple[int, int, list[str]]:
    words, hit, found = WORD.findall(lower(text)), set(), set()
    for name, item in items:
        ws = WORD.findall(lower(item))
        for w in {tuple(ws[i : i + 13]) for i in range(max(1, len(ws) - 12))} if ws else ():
            for i in range(len(words) - len(w) + 1):
                if tuple(words[i : i + len(w)]) == w:
                    hit.update(range(i, i + len(w)))
                    found.add(name)
    return len(words), len(hit), sorted(found)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
