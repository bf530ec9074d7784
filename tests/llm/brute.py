"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import itertools
import re

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def contamination(docs, tests, window=10):
    """(n_words, n_hit, items) per text."""
    windows = collections.defaultdict(set)
    for item, text in tests:
        words = PLAIN.findall((text or "").translate(LOWER))
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i : i + n])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for text in docs:
        words = PLAIN.findall((text or "").translate(LOWER))
        hit, items = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                found = windows.get(tuple(words[i : i + n]))
                if found:
                    hit.update(range(i, i + n))
                    items |= found
        out.append((len(words), len(hit), sorted(items)))
    return out


def shingles(text):
    words = SPACED.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else frozenset()


def near_components(docs, percent=85):
    """id -> (n_shingles, component); ``docs`` has distinct ids."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(i for i in sets if sets[i]), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def repeats(docs, length=100):
    """(n_bytes, n_removed, n_spans, sha of what is left) per text, in the order given."""
    seen, out = set(), []
    for text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            piece = data[i : i + length]
            if piece in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(piece)
        kept = bytes(x for x, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(data), sum(gone), spans, sha(kept)))
    return out


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (2 if i % 2 else 1)
        total += x // 10 + x % 10
    return total % 10 == 0


def base_spans(text):
    text, out = text or "", []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = SPACED.findall(text)
    places = collections.defaultdict(list)
    for i in range(len(words) - 2):
        places[tuple(words[i : i + 3])].append(i)
    again = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [line for line in text.split("\n") if SPACED.search(line)]
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again),
        n < 50 or 100 * len(again) > 50 * n,
    )
