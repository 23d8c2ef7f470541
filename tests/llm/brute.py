"""Plain Python versions of what the operators compute."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

BLANKS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def lowered(text):
    return (text or "").translate(LOWER)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def duplicates(rows):
    """(doc_id, text) rows -> sorted (doc_id, keep_id, group_size, sha)."""
    small = lambda i: (i is not None, i or 0)
    groups = {}
    for i, t in rows:
        groups.setdefault(lowered(t), []).append(i)
    return sorted(
        ((i, max(groups[lowered(t)], key=small), len(groups[lowered(t)]), sha(lowered(t))) for i, t in rows),
        key=lambda r: small(r[0]),
    )


def windows_removed(rows, size):
    """Row number -> (n_words, n_removed, kept text)."""
    words = [BLANKS.findall(t or "") for _, t in rows]
    count = Counter(tuple(w[j:j + size]) for w in words for j in range(len(w) - size + 1))
    out = []
    for w in words:
        covered = [False] * len(w)
        for j in range(len(w) - size + 1):
            if count[tuple(w[j:j + size])] > 1:
                covered[j:j + size] = [True] * size
        kept = [x for x, gone in zip(w, covered) if not gone]
        out.append((len(w), len(w) - len(kept), " ".join(kept)))
    return out


def shingles(text, size):
    w = BLANKS.findall(lowered(text))
    return {tuple(w[j:j + size]) for j in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def near_classes(texts, size, percent):
    """doc_id -> (n_shingles, smallest id reachable); looks at all pairs."""
    sets = {i: shingles(t, size) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= percent * (len(a) + len(b) - common):
                    parent[max(root(i), root(j))] = min(root(i), root(j))
    return {i: (len(sets[i]), root(i)) for i in ids}


def secrets(text):
    """Base spans (start, rank, end, kind)."""
    text = text or ""
    assign = re.compile(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
    )
    out = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m.group(2)) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(out)


def _one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def spellings(rows, divisor=0, least_length=7, least_count=2, ratio=10):
    """word -> (n, n_near, form, form_n, root); looks at all pairs of words of about the same length."""
    total = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if divisor and h % divisor == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    words = {w: n for w, n in total.items() if len(w) >= least_length and n >= least_count}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and _one_edit(v, w)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best and words[best] >= ratio * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (n, len(near[w]), form.get(w), words.get(form.get(w)), root(w)) for w, n in words.items()}


def ranking(docs, items, k):
    """(item_id, rank, doc_id, score) rows of the formula, every document against every item."""
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    held = [(i, Counter(term.findall(lowered(t)))) for i, t in docs]
    size, n_words = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        asked, scored = Counter(term.findall(lowered(text))), []
        for i, c in held:
            m = 75 + (25 * sum(c.values()) * size) // max(n_words, 1)
            score = sum(
                times * math.floor(1000 * math.log((2 * size + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t, times in asked.items() if c[t]
            )
            scored.append((-score, i is None, i or 0, i))
        best = sorted(x for x in scored if x[0] < 0)[:k]
        out += [(item, rank + 1, i, -score) for rank, (score, _, _, i) in enumerate(best)]
    return out
