"""What the operators must return, worked out the plain way."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def two_letter_words(steps):
    """Words of 2**steps letters in the Thue-Morse order and its complement; they agree for many polynomial hashes."""
    order = "".join("ab"[bin(i).count("1") % 2] for i in range(1 << steps))
    return order, order.translate(str.maketrans("ab", "ba"))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def components(nodes, links):
    parent = {x: x for x in nodes}

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return {x: top(x) for x in nodes}


def similar(sets, percent):
    holders = defaultdict(set)
    for i, s in sets.items():
        for g in s:
            holders[g].add(i)
    common = Counter(p for h in holders.values() for p in combinations(sorted(h), 2))
    return [(a, b) for (a, b), n in common.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]


def shingles(text, width):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def near(rows, width=4, percent=80):
    sets = {i: shingles(t, width) for i, t in rows if i is not None}
    of = components(sets, similar(sets, percent))
    return {i: (len(s), of[i], of[i] == i) for i, s in sets.items()}


def fuzzy_lines(rows, width=10, percent=80):
    places, sets = [], {}
    for i, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            if line := line.translate(LOWER).strip(" \t\n\x0b\x0c\r"):
                places.append((i, k, line))
                sets[line] = {line[j : j + width] for j in range(max(1, len(line) - width + 1))}
    of = components(sets, similar(sets, percent))
    first, out = {}, {i: [0, []] for i, _ in rows}
    for i, k, line in sorted(places, key=lambda p: (p[0] is not None, p[0] or 0, p[1])):
        out[i][0] += 1
        if first.setdefault(of[line], (i, k)) != (i, k):
            out[i][1].append(k)
    return {i: (n, len(gone), sorted(set(gone))) for i, (n, gone) in out.items()}


def repeats(rows, width=50):
    out, seen, late, last = [], set(), set(), None
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        if i != last:
            seen, late, last = seen | late, set(), i
        gone = [False] * len(data)
        for s in range(len(data) - width + 1 if i is not None else 0):
            if data[s : s + width] in seen:
                gone[s : s + width] = [True] * width
            late.add(data[s : s + width])
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest()))
    return out


def hits(text, items, window=10):
    w = alnum(text)
    hit, names = set(), set()
    for name, item in items:
        v = alnum(item)
        size = min(window, len(v))
        for j in range(len(v) - size + 1 if v else 0):
            for i in range(len(w) - size + 1):
                if w[i : i + size] == v[j : j + size]:
                    hit.update(range(i, i + size))
                    names.add(name)
    return len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(str(n) for n in names)).encode()).hexdigest(), bool(hit)


def base_phrases(text, phrases):
    w = alnum(text)
    found = [(i, label) for p, label in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    at = [i for i, _ in found]
    return len(w), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def counts(text):
    text = text or ""
    w = words(text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    again = {p for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if words(x)]
    failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), failed


def crc(text):
    return zlib.crc32((text or "").encode())
