"""Plain Python versions of the operators, for small tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- quality rules

def statistics(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = defaultdict(list)
    for i in range(len(w) - 7):
        windows[tuple(w[i:i + 8])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


def features(s):
    n = max(s["n_words"], 1)
    return [math.log1p(s["n_words"]), (s["word_chars"] + 20 * 5.5) / (s["n_words"] + 20), math.sqrt(s["n_symbols"] / n),
            math.log1p(s["n_dup_lines"]), math.sqrt(s["n_repeat_words"] / n)]


def raised(cov, floors):
    units = np.outer(floors, floors)
    values, vectors = np.linalg.eigh(cov / units)
    up = np.maximum(values, 1)
    return np.linalg.inv(vectors @ np.diag(up) @ vectors.T * units), (np.log(up) + values / up).sum()


def distances(x, floors, support=0.75, factor=1.0, tolerance=0.01):
    """Squared robust distances of the rows of one group: steps from three starts, the least
    criterion after two of them goes on until it settles."""
    x = np.array(x)
    n = len(x)

    def d2_of(mean, inv):
        return np.einsum("ij,jk,ik->i", x - mean, inv, x - mean)

    def step(mean, inv):
        bins = np.minimum(np.floor(np.log2(1 + d2_of(mean, inv)) * 32), 1023)
        weight, left = np.zeros(n), support * n
        for b in np.unique(bins):
            own = bins == b
            weight[own] = min(1, max(0, left) / own.sum())
            left -= own.sum()
        mean = weight @ x / (support * n)
        cov = (x - mean).T @ ((x - mean) * weight[:, None]) / (support * n)
        inv, criterion = raised(cov, floors)
        return criterion, mean, inv

    rank = lambda p: np.sort(x, axis=0)[max(math.ceil(p * n) - 1, 0)]
    median, inv = rank(0.5), raised(np.diag(((rank(0.75) - rank(0.25)) / 1.349) ** 2), floors)[0]
    z = (x - median) * np.sqrt(np.diag(inv))
    u = z / np.maximum(np.sqrt((z ** 2).sum(axis=1)), 1e-300)[:, None]
    scale = 1 / np.sqrt(np.diag(inv))
    begin = [(median, inv), (x.mean(axis=0), raised(np.cov(x.T, bias=True), floors)[0]),
             (median, raised(5 * u.T @ u / n * np.outer(scale, scale), floors)[0])]
    seen = [step(*b) for b in begin]
    second = [step(*b[1:]) for b in seen]
    at = min(second, key=lambda b: b[0])
    seen += second
    while True:
        after = step(*at[1:])
        seen.append(after)
        if after[0] >= at[0] - tolerance:
            break
        at = after
    best = min(seen, key=lambda b: b[0])
    return d2_of(*best[1:]) / factor


# --- line dedup

def dedup_lines(docs):
    """docs: [(doc_id, text)] of distinct ids -> {doc_id: (text, removed)}"""
    has = lambda x: bool(WORD.search(x))
    first, later = {}, defaultdict(set)
    for i, text in sorted((d for d in docs if d[1] is not None), key=lambda d: d[0]):
        own = [x for x in text.split("\n") if has(x)]
        for k in range(len(own) - 2):
            if first.setdefault(tuple(own[k:k + 3]), (i, k)) != (i, k):
                later[i] |= {k, k + 1, k + 2}
    out = {}
    for i, text in docs:
        if text is None or not later[i]:
            out[i] = (text, 0)
            continue
        kept, k = [], -1
        for line in text.split("\n"):
            k += has(line)
            if not (has(line) and k in later[i]):
                kept.append(line)
        out[i] = ("\n".join(kept), len(later[i]))
    return out


# --- near duplicates

def shingles(text, size=5):
    w = words(lower(text))
    return {tuple(w[j:j + size]) for j in range(max(1, len(w) - size + 1))} if w else set()


def components(docs, percent=75):
    """docs: [(doc_id, text)] -> {doc_id: component}"""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in range(len(ids)):
        for b in range(a + 1, len(ids)):
            x, y = sets[ids[a]], sets[ids[b]]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(ids[a]), find(ids[b])
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


# --- repeated passages

def repeated(docs, window=35):
    """docs: [(key, text)] -> {key: (n_words, n_removed, kept text)}; a key may stand twice."""
    w = [(k, words(t)) for k, t in docs]
    count = Counter(tuple(x[j:j + window]) for _, x in w for j in range(len(x) - window + 1))
    out = {}
    for k, x in w:
        gone = {p for j in range(len(x) - window + 1) if count[tuple(x[j:j + window])] > 1 for p in range(j, j + window)}
        kept = [y for p, y in enumerate(x) if p not in gone]
        out[k] = (len(x), len(gone), " ".join(kept))
    return out


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- decontamination

def similarity(a, b):
    a, b = Counter(a), Counter(b)
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def grams(w, size=5):
    k = min(size, len(w))
    return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)] if w else []


def hits(docs, items, percent=75):
    """{(doc_id, item_id): (similarity, start)} of the best windows; a text shorter than the item is one"""
    out = {}
    for i, text in docs:
        w = words(lower(text))
        for item, t in items:
            own = words(lower(t))
            m = len(own)
            g = grams(own)
            if not m or not set(g) & set(grams(w, min(m, 5))):
                continue
            best = max(((similarity(grams(w[a:a + m]), g), -a) for a in range(max(1, len(w) - m + 1))), default=(0, 0))
            if 100 * best[0] >= percent:
                out[i, item] = (round(best[0], 9), -best[1])
    return out
