"""Plain versions of the training-data operators, for small inputs."""

import math
import re
import string
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text, lower=False):
    return WORD.findall((text or "").translate(LOWER) if lower else text or "")


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(text, items, n=10):
    """Words, words hit, ids of items with a window in the text."""
    found, hit, ids = item_words(text), set(), set()
    for key, item in items:
        w = item_words(item)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            for j in range(len(found) - size + 1):
                if found[j:j + size] == w[i:i + size]:
                    hit.update(range(j, j + size))
                    ids.add(str(key))
    return len(found), len(hit), sorted(ids)


def quality(text):
    w = words(text)
    places = {}
    for i in range(len(w) - 2):
        places.setdefault(tuple(w[i:i + 3]), []).append(i)
    again = {i + j for p in places.values() if len(p) > 1 for i in p for j in range(3)}
    seen, copies = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            copies += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), copies, len(again)


def base_scores(docs):
    """Per document: held out, tokens, known tokens, training tokens, base score."""
    def tokens(text):
        return words(text, lower=True) + [" end "]

    def held(key):
        return zlib.crc32(str(key).encode() if key is not None else b"") % 10 == 0

    counts = Counter(t for key, text in docs if not held(key) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    for key, text in docs:
        got = tokens(text)
        yield (held(key), len(got), sum(counts[t] > 0 for t in got), n,
               sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in got))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def personal(text):
    text, out = text or "", []
    for kind, pattern in (
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if ((kind == "ip" and any(int(p) > 255 for p in m[0].split(".")))
                    or (kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)))
                    or (kind == "phone" and not 9 <= len(digits) <= 15)):
                continue
            out.append((kind, m.start(), m.end()))
    return out


def shingles(text, n=5):
    w = words(text, lower=True)
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def components(docs):
    """Set size and smallest reachable id, for documents as (id, text)."""
    sets = [shingles(text) for _, text in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(docs)):
        groups.setdefault(root(i), []).append(docs[i][0])
    low = {r: min((k for k in g if k is not None), default=None) for r, g in groups.items()}
    return [(docs[i][0], len(sets[i]), low[root(i)] if sets[i] else docs[i][0]) for i in range(len(docs))]
