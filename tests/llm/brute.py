"""Plain statements of what the operators compute, and documents that are hard on them."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def shingles(text: str | None, k: int) -> frozenset:
    w = words(lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def near_components(rows: list[tuple], k: int, percent: int) -> dict:
    """{id: (shingles, least id reached)} by comparing every pair that shares a shingle."""
    sets = {i: shingles(t, k) for i, t in rows if i is not None}
    by_shingle = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            by_shingle[g].append(i)
    common = Counter()
    for ids in by_shingle.values():
        for n, x in enumerate(ids):
            for y in ids[:n]:
                common[x, y] += 1
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (x, y), n in common.items():
        if 100 * n >= percent * (len(sets[x]) + len(sets[y]) - n):
            a, b = root(x), root(y)
            parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def repeat_words(text: str | None) -> int:
    w = words(text)
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    marked = {j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(marked)


def dup_lines(text: str | None) -> int:
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(lines) - len(set(lines))


class KneserNey:
    """Interpolated modified Kneser-Ney over dictionaries."""

    def __init__(self, texts: list, order: int):
        self.order = order
        seqs = [["<s>"] * (order - 1) + words(lower(t or "")) + ["</s>"] for t in texts]
        self.raw = Counter(w for s in seqs for w in s[order - 1:])
        self.tokens, self.types = sum(self.raw.values()), len(self.raw)
        grams = Counter(tuple(s[i - order + 1:i + 1]) for s in seqs for i in range(order - 1, len(s)))
        raws = {order: grams}
        for k in range(order - 1, 0, -1):
            raws[k] = Counter()
            for g, c in raws[k + 1].items():
                raws[k][g[1:]] += c
        self.count = {order: grams}
        for k in range(order - 1, 0, -1):
            self.count[k] = Counter()
            for g in self.count[k + 1]:
                self.count[k][g[1:]] += raws[k + 1][g] if k > 1 and g[1] == "<s>" else 1
        self.discount = {k: self._discount(c) for k, c in self.count.items()}
        self.follow = {k: defaultdict(list) for k in self.count}
        for k, c in self.count.items():
            for g, n in c.items():
                self.follow[k][g[:-1]].append(n)

    @staticmethod
    def _discount(counts: Counter) -> list[float]:
        n = [sum(c == j for c in counts.values()) for j in range(1, 5)]
        if min(n) == 0:
            return [0.5, 1.0, 1.5]
        y = n[0] / (n[0] + 2 * n[1])
        d = [j - (j + 1) * y * n[j] / n[j - 1] for j in (1, 2, 3)]
        return d if all(0 <= x <= j for j, x in enumerate(d, 1)) else [0.5, 1.0, 1.5]

    def probability(self, context: tuple, word: str, k: int) -> float:
        if k == 0:
            return 1 / (self.types + 1)
        below = self.probability(context[1:] if k > 1 else (), word, k - 1)
        counts = self.follow[k].get(context)
        if not counts:
            return below
        d = [0.0, *self.discount[k]]
        c = self.count[k].get((*context, word), 0)
        left = sum(d[min(3, n)] for n in counts)
        return (max(0.0, c - d[min(3, c)]) + left * below) / sum(counts)

    def score(self, text: str | None) -> float:
        s = ["<s>"] * (self.order - 1) + words(lower(text or "")) + ["</s>"]
        return sum(math.log10(self.probability(tuple(s[i - self.order + 1:i]), s[i], self.order)) for i in range(self.order - 1, len(s)))


HARD_TEXTS = [
    None, "", " ", "\n\n", "\t \r\n", "one", "one two", "One TWO three", "a  b", "a \n b ", "  lead", "trail  ", "x\x00y z", "é ü 日本 語 😀 x", "▁ a▁b", " nbsp  x",
    "it's we'll don't 12 3.5 #$%", "same line\nsame line\nsame line", "the cat sat on the cat sat on the cat sat", "<|endoftext|> hi </s>[INST] x [/INST] \\ \\\\ <\\s>",
    "x" * 3000, "the " * 4000, ("word%d " * 40) % tuple(range(40)) * 2, "́combining é", "a b c\u0085d",
]
