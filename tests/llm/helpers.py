"""Brute-force versions of the text operators, straight from their definitions."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

LAST = 2**63 - 1  # where a null id sorts


def digest(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def place(doc_id):
    return LAST if doc_id is None else doc_id


def later_cover(rows, parse, width):
    """Per (doc_id, text): symbols, and which of them a window that starts earlier elsewhere covers."""
    texts = [(d, parse(t or "")) for d, t in rows]
    first = {}
    for d, s in texts:
        for i in range(len(s) - width + 1):
            w = tuple(s[i : i + width])
            first[w] = min(first.get(w, (place(d), i)), (place(d), i))
    for d, s in texts:
        gone = [False] * len(s)
        for i in range(len(s) - width + 1):
            if first[tuple(s[i : i + width])] < (place(d), i):
                gone[i : i + width] = [True] * width
        yield d, s, gone


def shingle_set(text):
    words = (text or "").split()
    k = min(5, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def near_copies(rows):
    """(links, class) per row: number of other rows with Jaccard 0.8 or more, and the least id of the component."""
    sets, n = [shingle_set(t) for _, t in rows], len(rows)
    near = defaultdict(set)
    for i in range(n):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 5 * both >= 4 * len(sets[i] | sets[j]):
                near[i].add(j)
                near[j].add(i)
    label = {}
    for i in range(n):
        if i not in label:
            todo, group = [i], {i}
            while todo:
                for j in near[todo.pop()] - group:
                    group.add(j)
                    todo.append(j)
            head = min(place(rows[j][0]) for j in group)
            label |= dict.fromkeys(group, None if head == LAST else head)
    return [(len(near[i]), label[i]) for i in range(n)]


def text_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    at = defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i : i + 8])].append(i)
    repeated = {p + k for places in at.values() if len(places) > 1 for p in places for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated),
    )


KINDS = ("email", "ip", "card", "phone")
PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    doubled = [2 * int(x) if k % 2 else int(x) for k, x in enumerate(reversed(digits))]
    return sum(x // 10 + x % 10 for x in doubled) % 10 == 0


def personal_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = (
                True,
                kind == 1 and all(int(x) <= 255 for x in m[0].split(".")),
                12 <= len(digits) <= 19 and luhn(digits),
                9 <= len(digits) <= 15,
            )[kind]
            if good:
                out.append((m.start(), kind, m.end()))
    return [(k, s, e) for s, k, e in sorted(out)]
