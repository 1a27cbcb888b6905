"""Plain versions of the operators, for small inputs: (id, text) pairs in, dicts by id out."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def words(text: str | None) -> list[str]:
    return ALNUM.findall(lower(text or ""))


def quality_counts(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    w = SPACED.findall(text)
    runs = list(zip(w, w[1:], w[2:], strict=False))
    twice = {r for r, c in Counter(runs).items() if c > 1}
    covered = {i + k for i, r in enumerate(runs) if r in twice for k in range(3)}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def base_failed(text: str | None) -> bool:
    n, _, _, _, repeated = quality_counts(text)
    return n < 50 or 100 * repeated > 50 * n


def contamination(docs, items, size: int = 13):
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    sizes = {len(k) for k in windows}
    out = {}
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[a : a + n]))) is not None:
                    hit |= set(range(a, a + n))
                    found |= got
        out[i] = (len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w))
    return out


def proximity(docs, items, size: int = 13, slop: int = 2):
    """For each text the items with a window of which every word stands within ``slop`` words of its place."""
    out = {}
    for i, text in docs:
        w, found = words(text), set()
        for item, told in items:
            v = words(told)
            n = min(size, len(v))
            for window in {tuple(v[a : a + n]) for a in range(len(v) - n + 1)} if n else ():
                for at in range(len(w) - n + 1):
                    if all(window[k] in w[max(0, at + k - slop) : at + k + slop + 1] for k in range(n)):
                        found.add(str(item))
        out[i] = sorted(found)
    return out


def line_dedup(docs, min_words: int = 8):
    """Texts without later copies of line runs of so many words or more: every run in every place is looked at."""
    seen: set = set()
    gone: dict = {}
    split = {}
    for i, text in docs:
        lines = (text or "").split("\n")
        filled = [(k, x.strip(" \t\r\v\f")) for k, x in enumerate(lines) if x.strip(" \t\r\v\f")]
        weights = [max(x.count(" ") + 1, len(x) // 10) for _, x in filled]
        split[i] = (lines, filled)
        for k in range(len(filled)):
            total = 0
            for end in range(k, min(len(filled), k + 2 * min_words)):
                total += weights[end]
                if total >= min_words:
                    run = tuple(x for _, x in filled[k : end + 1])
                    if run in seen:
                        gone.setdefault(i, set()).update(range(k, end + 1))
                    seen.add(run)
    out = {}
    for i, _ in docs:
        lines, filled = split[i]
        drop = {filled[k][0] for k in gone.get(i, ())}
        out[i] = (len(filled), len(drop), "\n".join(x for k, x in enumerate(lines) if k not in drop))
    return out


def bag(text: str | None) -> Counter:
    w = words(text)
    return Counter(zip(*[w[k:] for k in range(5)], strict=False)) if len(w) >= 5 else Counter([tuple(w) or (text or "")])


def near_classes(docs, multiset: bool = True):
    bags = [(i, bag(t) if multiset else Counter(set(bag(t)))) for i, t in docs]
    root = {i: i for i, _ in bags}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, x) in enumerate(bags):
        for j, y in bags[:a]:
            if 9 * sum((x & y).values()) >= 4 * (sum(x.values()) + sum(y.values())):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i, _ in bags}


def repeated_passages(docs, pieces, stretch: int = 20):
    """For each text the places of words in runs around a piece that an earlier text, or an earlier place, has.

    ``pieces`` gives the (first word, word after the last) of a text's pieces. Every two places of an equal piece are
    looked at, and extended word by word.
    """
    split = {i: words(t) for i, t in docs}
    places: dict[tuple, list] = {}
    gone = {}
    for i, t in docs:
        w, mine = split[i], set()
        for lo, hi in pieces(t):
            before = places.setdefault(tuple(w[lo:hi]), [])
            for j, at in before:
                v, a, z = split[j], 0, 0
                while lo - a > 0 and at - a > 0 and w[lo - a - 1] == v[at - a - 1]:
                    a += 1
                while hi + z < len(w) and at + hi - lo + z < len(v) and w[hi + z] == v[at + hi - lo + z]:
                    z += 1
                mine.update(range(lo - a, hi + z))
            before.append((i, lo))
        starts = [k for k in sorted(mine) if k - 1 not in mine]
        for k in starts:
            end = k
            while end in mine:
                end += 1
            if end - k < stretch:
                mine.difference_update(range(k, end))
        gone[i] = mine
    return gone


def similar_paragraphs(docs, min_words: int = 20):
    """Lines of enough words, as (document, begin, end) in bytes, and those similar to an earlier one."""
    found = []
    for i, t in docs:
        at = 0
        for line in (t or "").encode().split(b"\n"):
            if len(words(line.decode())) >= min_words:
                found.append(((i, at, at + len(line)), frozenset(bag(line.decode()))))
            at += len(line) + 1
    root = list(range(len(found)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    having: dict[tuple, list[int]] = {}
    for a, (_, x) in enumerate(found):
        for b, k in Counter(b for s in x for b in having.get(s, ())).items():
            if 5 * k >= 4 * (len(x) + len(found[b][1]) - k):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
        for s in x:
            having.setdefault(s, []).append(a)
    return [f for f, _ in found], {f for a, (f, _) in enumerate(found) if find(a) != a}


def substring_dedup(docs, pieces):
    """(paragraphs, stretches cut, bytes cut, rest) of each text."""
    gone = repeated_passages(docs, pieces)
    lines, similar = similar_paragraphs(docs)
    out = {}
    for i, t in docs:
        body = (t or "").encode()
        starts = [len((t or "")[: m.start()].encode()) for m in ALNUM.finditer(lower(t or ""))] + [len(body)]
        cut = bytearray(len(body) + 1)
        for k in gone[i]:
            cut[starts[k] : starts[k + 1]] = b"\1" * (starts[k + 1] - starts[k])
        for d, a, z in similar:
            if d == i:
                cut[a : z + 1] = b"\1" * (z + 1 - a)
        cut = cut[: len(body)]
        spans = sum(1 for k in range(len(body)) if cut[k] and (k == 0 or not cut[k - 1]))
        rest = bytes(b for b, c in zip(body, cut, strict=True) if not c).decode()
        out[i] = (sum(d == i for d, _, _ in lines), spans, sum(cut), rest)
    return out


def cut_substrings(docs, size: int = 50):
    first: dict[bytes, int] = {}
    texts = {i: (t or "").encode() for i, t in docs}
    for i in sorted(texts):
        for k in range(len(texts[i]) - size + 1):
            first.setdefault(texts[i][k : k + size], i)
    out = {}
    for i, t in texts.items():
        gone = bytearray(len(t))
        for k in range(len(t) - size + 1):
            if first[t[k : k + size]] < i:
                gone[k : k + size] = b"\1" * size
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest())
    return out


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def personal(text: str | None):
    spans, counts = [], []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        n = 0
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                n += 1
                spans.append((m.start(), order, kind, m.end()))
        counts.append(n)
    return counts, ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))


def stands_for(kind: str, found: str) -> set[str]:
    digits = re.sub("[^0-9]", "", found)
    value = digits if kind in ("card", "phone") else found.lower()
    part = {"email": found.lower().rpartition("@")[2], "ip": ".".join(found.split(".")[:3]), "card": digits[:6], "phone": digits[:-4]}[kind]
    return {f"{kind}:{value}", f"{kind}/{part}"}


def disclosing(texts, support: int = 3, least: float = 0.5):
    """For each text the words that disclose one of its entities or classes."""
    import math

    import regex

    word = regex.compile(r"[\p{L}\p{N}]+")
    texts = sorted({t or "" for t in texts})
    words_in = {t: set(word.findall(t.lower())) for t in texts}
    entities, candidates, own = {}, {}, {}
    for t in texts:
        outside, entities[t], own[t] = t, set(), []
        for part in filter(None, personal(t)[1].split(",")):
            kind, a, z = part.split(":")
            entities[t] |= stands_for(kind, t[int(a) : int(z)])
            own[t].append((int(a), int(z)))
        for a, z in own[t]:
            outside = outside.replace(t[a:z], " ")
        candidates[t] = set(word.findall(outside.lower()))
    n = len(texts)
    n_e = Counter(e for t in texts for e in entities[t])
    n_t = Counter(w for t in texts for w in words_in[t])
    n_et = Counter((e, w) for t in texts for e in entities[t] for w in candidates[t])
    z2 = 1.6448536269514722**2

    def share(hits, of):
        p = hits / of
        return (p + z2 / (2 * of) - math.sqrt(z2 * (p * (1 - p) / of + z2 / (4 * of * of)))) / (1 + z2 / of)

    terms = {(e, w) for (e, w), k in n_et.items() if k >= support and share(k, n_t[w]) >= least and share(k, n_t[w]) * n / n_e[e] >= 2}
    out = {}
    for t in texts:
        told = {w for e, w in terms if e in entities[t] and w in words_in[t]}
        places = [m for m in word.finditer(t) if m[0].lower() in told]
        out[t] = {m[0].lower() for m in places if not any(m.start() < z and a < m.end() for a, z in own[t])}
    return out
