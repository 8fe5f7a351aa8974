"""Plain versions of the operators, over all pairs or words, to compare with."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)


class Union:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def root(self, n):
        while self.up[n] != n:
            n = self.up[n]
        return n

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def near(texts: dict, width: int) -> dict:
    """id -> (set size, component), comparing every pair."""
    sets = {}
    for i, t in texts.items():
        words = WORD.findall((t or "").translate(LOWER))
        runs = [tuple(words[k : k + width]) for k in range(len(words) - width + 1)]
        sets[i] = set(runs or ([tuple(words)] if words else []))
    groups, ids = Union(sets), sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                groups.join(a, b)
    return {i: (len(sets[i]), groups.root(i)) for i in ids}


def exact(texts: dict) -> dict:
    """id -> (keep, size, digest)."""
    held = defaultdict(list)
    for i, t in texts.items():
        held[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    return {i: (min(g), len(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in held.items() for i in g}


def base_secrets(text: str) -> list[str]:
    found = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [s for _, _, s in sorted(found)]


def quality_counts(text: str) -> tuple:
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    count, inside = Counter(windows), set()
    for k, w in enumerate(windows):
        if count[w] > 1:
            inside |= set(range(k, k + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed


def licence_names(text: str) -> tuple:
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))
    names = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    found = [(k, label) for p, label in names.items() for k in range(len(words)) if tuple(words[k : k + len(p)]) == p]
    at = [k for k, _ in found]
    return len(words), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))
