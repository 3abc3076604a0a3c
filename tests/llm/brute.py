"""Plain versions of the operators, written from their definitions alone."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def repeated_windows(docs, width=50):
    """docs: (doc_id, text) rows -> {row index: (n_words, n_removed, kept text)}."""
    first = {}
    split = [words(t) for _, t in docs]
    for (doc_id, _), w in zip(docs, split):
        if doc_id is None:
            continue
        for i in range(len(w) - width + 1):
            key = tuple(w[i : i + width])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for (doc_id, _), w in zip(docs, split):
        gone = set()
        for i in range(len(w) - width + 1):
            if doc_id is not None and first[tuple(w[i : i + width])] < doc_id:
                gone.update(range(i, i + width))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((doc_id, len(w), len(gone), " ".join(kept)))
    return out


def shingles(text, n=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def components(nodes, links):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def similar(docs, threshold=0.8, n=5):
    """docs: {doc_id: text} -> {doc_id: (class_id, n_links, component_id)}."""
    sets = {d: shingles(t, n) for d, t in docs.items()}
    holders = {}
    for d, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(d)
    links = []
    for d, s in sets.items():
        shared = {}
        for x in s:
            for o in holders[x]:
                if o > d:
                    shared[o] = shared.get(o, 0) + 1
        links += [(d, o) for o, c in shared.items() if c >= threshold * (len(s) + len(sets[o]) - c) - 1e-9]
    count = dict.fromkeys(docs, 0)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    same = {}
    for d, t in docs.items():
        key = tuple(words(t)) or d
        same[key] = min(same.get(key, d), d)
    comp = components(docs, links)
    return {d: (same[tuple(words(t)) or d], count[d], comp[d]) for d, t in docs.items()}


_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(_FOLD)


def deduped_lines(docs, min_chars=10):
    """docs: (doc_id, text) rows -> (doc_id, n_lines, n_dropped, kept text) in order."""
    holders = {}
    for d, t in docs:
        for line in (t or "").split("\n"):
            if d is not None and len(line_key(line)) >= min_chars:
                holders.setdefault(line_key(line), set()).add(d)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [
            x for x in lines if d is None or len(line_key(x)) < min_chars or d == min(holders[line_key(x)])
        ]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def clusters(rows, k=8, rounds=10, seed="3"):
    """rows: (vec_id, list or None) -> (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == 64 and None not in v and all(math.isfinite(x) for x in v):
            ints = [math.floor(1024 * float(x)) if abs(x) < 1e300 else 1 << 60 for x in v]
            if all(abs(x) < 1 << 56 for x in ints):
                kept.append((i, ints))
    known = [(sha(f"{seed}:{i}"), i, v) for i, v in kept if i is not None]
    centers = [v for _, _, v in sorted(known)[:k]]

    def nearest(v):
        far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centers]
        return min(range(len(far)), key=lambda n: (far[n], n)), min(far)

    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(nearest(v)[0], []).append(v)
        centers = [
            [sum(x) // len(own[c]) for x in zip(*own[c])] if c in own else centers[c] for c in range(len(centers))
        ]
    last = [(i, *nearest(v)) for i, v in kept]
    fit = lambda x: x if x < 1 << 63 else None
    of = {c: sum(d for _, n, d in last if n == c) for _, c, _ in last}
    text = [sha(",".join(map(str, c))) for c in centers]
    return [(i, c, fit(d), fit(of[c]), fit(sum(of.values())), text[c]) for i, c, d in last]


def variant_words(docs, least_size=5, least_n=3):
    """docs: (doc_id, text) rows -> {word: n}."""
    n = {}
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(_FOLD)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] = n.get(run, 0) + 1
    return {w: c for w, c in n.items() if len(w) >= least_size and c >= least_n}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def variants(n):
    """{word: n} -> {word: (form, root, n, n_near, form_n)}."""
    holders = {}
    for w in n:  # two near words agree once the right code point of one or both is left out
        for i in range(len(w) + 1):
            holders.setdefault(w[:i] + w[i + 1 :], []).append(w)
    near = {w: {x for i in range(len(w) + 1) for x in holders[w[:i] + w[i + 1 :]] if one_edit(w, x)} for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def repeated_bytes(docs, width=400):
    """docs: (doc_id, text) rows -> (doc_id, n_bytes, spans, kept bytes) in order."""
    data = [(t or "").encode() for _, t in docs]
    digest = lambda b, i: hashlib.md5(b[i : i + width]).digest() if width > 16 else b[i : i + width]
    times = Counter(digest(b, i) for b in data for i in range(len(b) - width + 1))
    out = []
    for (d, _), b in zip(docs, data):
        spans = []
        for i in range(len(b) - width + 1):
            if times[digest(b, i)] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], i + width)
                else:
                    spans.append((i, i + width))
        ends = [0, *(x for s in spans for x in s), len(b)]
        out.append((d, len(b), spans, b"".join(b[s:e] for s, e in zip(ends[::2], ends[1::2]))))
    return out


def trigrams(text):
    """Bucket of every three neighbouring bytes, one space before and two behind the text."""
    kinds = []
    last = 0
    for b in f" {text}  ".encode():
        low = b + 0x20 if last == 0xC3 and 0x80 <= b <= 0x9E else b
        last = b
        kinds.append(low - 101 if low >= 128 else low % 32 if chr(low).isalpha() else 0)
    codes = [(a * 160 + b) * 160 + c for a, b, c in zip(kinds, kinds[1:], kinds[2:])]
    return [max((c * 0x9E3779B1 % 2**32) >> 16, 1) for c in codes if c]


def languages(docs, buckets=1 << 16, evidence=20):
    """docs: (doc_id, text, lang) rows of two to five languages -> (doc_id, held_out, lang_pred, score) rows."""
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 0
    counts = {}
    for d, t, x in docs:
        if d is not None and t is not None and x is not None and not held(d):
            counts.setdefault(x, Counter()).update(trigrams(t))
    names = sorted(counts)
    totals = {x: sum(counts[x].values()) + buckets / 2 for x in names}
    share = lambda x, g: (counts[x][g] + 0.5) / totals[x]
    # Every split of the languages into two sides, the first one always on the same side.
    bits = [{names[0], *(x for k, x in enumerate(names[1:]) if m >> k & 1)} for m in range(2 ** (len(names) - 1) - 1)]
    odds, weights = [], []
    for side in bits:
        mean = lambda g, inside: sum(share(x, g) for x in names if (x in side) == inside) / sum((x in side) == inside for x in names)
        both = [(mean(g, True), mean(g, False)) for g in range(buckets)]
        odds.append([math.log(y / n) for y, n in both])
        weights.append(sum(y * math.log(2 * y / (y + n)) + n * math.log(2 * n / (y + n)) for y, n in both))
    average = sum(weights) / len(weights)
    out = []
    for d, t, _ in docs:
        if t is None or not any(c.isalpha() for c in t):
            out.append((d, held(d), "und", 0.0))
            continue
        found = trigrams(t)
        margins = [sum(o[g] for g in found) * min(1, evidence / len(found)) for o in odds]
        loss = {
            x: sum(w / average * math.log1p(math.exp(-m if x in side else m)) for w, m, side in zip(weights, margins, bits))
            for x in names
        }
        best = min(names, key=lambda x: loss[x])
        out.append((d, held(d), best, 1 / sum(math.exp(loss[best] - loss[x]) for x in names)))
    return out
