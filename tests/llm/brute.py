"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

BLANKS = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, kind=LETTERS):
    return kind.findall((text or "").translate(SMALL))


def shingles(text):
    own = words(text, BLANKS)
    n = min(5, len(own))
    return {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()


def components(docs):
    """doc_id -> (size of the set, smallest id reachable), for rows (id, text) with distinct ids."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def hits(docs, items):
    """doc_id -> (words, hit words, items)."""
    windows = defaultdict(set)
    for item, text in items:
        own = words(text)
        n = min(10, len(own))
        for i in range(len(own) - n + 1 if own else 0):
            windows[tuple(own[i : i + n])].add(str(item))
    sizes = {len(w) for w in windows}
    found = {}
    for doc, text in docs:
        own, covered, names = words(text), set(), set()
        for n in sizes:
            for i in range(len(own) - n + 1):
                if names_here := windows.get(tuple(own[i : i + n])):
                    covered.update(range(i, i + n))
                    names |= names_here
        found[doc] = (len(own), len(covered), sorted(names))
    return found


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c)
        total += v if i % 2 == 0 else v * 2 - (9 if v > 4 else 0)
    return total % 10 == 0


def personal(text):
    """Base spans (kind, start, end) by kind as listed, then start."""
    x, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x):
        digits = re.sub(r"\D", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x):
        if 9 <= len(re.sub(r"\D", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def licenses(text):
    """Words, and places of the base phrases as (label, first word)."""
    own = words(text)
    phrases = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
    found = []
    for label, phrase in phrases.items():
        p = phrase.split()
        found += [(label, i) for i in range(len(own)) if own[i : i + len(p)] == p]
    return len(own), found


def backoff(docs):
    """Per row: words, trigrams that others have, rounded score."""
    own = [words(t) for _, t in docs]
    grams = lambda w, n: Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    mine = [{n: grams(w, n) for n in (1, 2, 3)} for w in own]
    whole = {n: sum((m[n] for m in mine), Counter()) for n in (1, 2, 3)}
    total = sum(map(len, own))
    rows = []
    for w, m in zip(own, mine):
        c = lambda g: whole[len(g)][tuple(g)] - m[len(g)][tuple(g)]  # noqa: E731, B023
        rest, value, full = total - len(w), 0.0, 0

        def s(g):
            if len(g) == 1:
                return c(g) / rest if c(g) else 0.4 / (rest + 1)  # noqa: B023
            return c(g) / c(g[:-1]) if c(g) else 0.4 * s(g[1:])  # noqa: B023

        for i in range(len(w)):
            g = w[max(0, i - 2) : i + 1]
            value += math.log(s(g))
            full += len(g) == 3 and c(g) > 0
        rows.append((len(w), full, round(value / len(w), 6) if w else None))
    return rows


def repeated(docs, length=50):
    """Per row: bytes, removed bytes, spans, sha256 of the kept bytes."""
    big = float("inf")
    rows = [((i if i is not None else big), (t or "").encode()) for i, t in docs]
    least = {}
    for i, b in rows:
        for s in range(len(b) - length + 1):
            g = b[s : s + length]
            least[g] = min(least.get(g, big), i)
    out = []
    for i, b in rows:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if least[b[s : s + length]] < i:
                gone[s : s + length] = b"\x01" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
