"""Plain versions of the operators, for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def shingles(text, width=5):
    words = WORD.findall((text or "").translate(UPPER))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def components(rows, percent=75):
    """{doc_id: (n, component)} of (doc_id, text) rows, comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 8 <= len(digits) <= 15,
            }[kind]
            if good():
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def edited(texts):
    """Edited text of each of the texts, which are in their order."""
    out = []
    for i, text in enumerate(texts):
        half = len(text) // 2
        out.append(text[: len(text) - half] + texts[(i + 1) % len(texts)][:half])
    return out


def units(text, words):
    """Distinct paragraphs, cut after so many words."""
    out = set()
    for line in (text or "").split("\n"):
        found = list(re.finditer(r"\S+", line, re.ASCII))
        for k in range(0, len(found), words):
            part = found[k : k + words]
            out.add(line[part[0].start() : part[-1].end()])
    return out


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0
