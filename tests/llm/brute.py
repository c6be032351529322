"""Plain versions of the operators, for small tables."""

import hashlib
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np


def roots(nodes, links):
    """The smallest node each node reaches."""
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingle_set(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return set()
    if len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def jaccard_components(rows):
    """(doc_id, text) rows with distinct ids -> {doc_id: (set size, component)}."""
    sets = {doc: shingle_set(text) for doc, text in rows}
    by = defaultdict(set)
    for doc, found in sets.items():
        for s in found:
            by[s].add(doc)
    links, seen = [], set()
    for docs in by.values():
        docs = sorted(docs)
        for i, a in enumerate(docs):
            for b in docs[i + 1 :]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= 80 * len(sets[a] | sets[b]):
                        links.append((a, b))
    home = roots(sets, links)
    return {doc: (len(found), home[doc]) for doc, found in sets.items()}


def removal(rows, length):
    """(doc_id, text) rows -> digest rows, in order."""
    bodies = [(text or "").encode() for _, text in rows]
    times = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for (doc, _), b in zip(rows, bodies, strict=True):
        marked = np.zeros(len(b) + 2, np.int8)
        for i in range(len(b) - length + 1):
            if times[b[i : i + length]] > 1:
                marked[i + 1 : i + 1 + length] = 1
        kept = bytes(x for x, m in zip(b, marked[1:-1], strict=True) if not m)
        spans = int((np.diff(marked) == 1).sum())
        out.append((doc, len(b), int(marked.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def cosine_links(rows, least):
    """(vec_id, vector, label) rows with distinct ids -> {vec_id: (links, component)}."""
    good = {}
    for vec, v, label in rows:
        ok = v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        if ok:
            good[vec] = (np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)), label)
    links = []
    ids = sorted(good)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if good[a][1] == good[b][1] and len(good[a][0]) == len(good[b][0]) and good[a][0] @ good[b][0] >= least:
                links.append((a, b))
    n = Counter(x for pair in links for x in pair)
    home = roots([r[0] for r in rows], links)
    return {r[0]: (n[r[0]], home[r[0]]) for r in rows}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def words_at(text):
    """(first, end) of each word: letters and digits, hyphens and apostrophes between two, single characters of scripts without blanks."""
    blocks = [("\u0e00", "\u0eff"), ("\u1000", "\u109f"), ("\u1780", "\u17ff"), ("\u3040", "\u30ff"), ("\u3400", "\u9fff"), ("\uf900", "\ufaff"), ("\U00020000", "\U0003ffff")]

    def letter(c):
        return c.isalnum() or unicodedata.combining(c) > 0

    def single(c):
        return letter(c) and any(low <= c <= high for low, high in blocks)

    out, i = [], 0
    while i < len(text):
        if single(text[i]):
            out.append((i, i + 1))
            i += 1
        elif letter(text[i]):
            start = i
            while i < len(text) and (
                (letter(text[i]) and not single(text[i]))
                or (text[i] in "-'\u2019" and i + 1 < len(text) and letter(text[i + 1]) and not single(text[i + 1]) and letter(text[i - 1]))
            ):
                i += 1
            out.append((start, i))
        else:
            i += 1
    return out


def cut_passages(rows, length):
    """(key, text) rows -> the texts without words that lie in a run of ``length`` words which also starts elsewhere."""
    found = [(text or "", words_at(text or "")) for _, text in rows]
    windows = [[tuple(t[a:b] for a, b in w[i : i + length]) for i in range(len(w) - length + 1)] for t, w in found]
    times = Counter(x for some in windows for x in some)
    out = []
    for (text, words), some in zip(found, windows, strict=True):
        covered = set()
        for i, x in enumerate(some):
            if times[x] > 1:
                covered |= set(range(i, i + length))
        kept, at, i = [], 0, 0
        while i < len(words):
            if i in covered:
                last = i
                while last + 1 in covered:
                    last += 1
                kept.append(text[at : words[i][0]])
                at, i = words[last][1], last
            i += 1
        out.append("".join(kept) + text[at:])
    return out
