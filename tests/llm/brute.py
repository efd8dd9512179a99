"""Brute-force versions of the training-data operators (plain Python)."""

import hashlib
import re
from collections import Counter, defaultdict

import pandas as pd

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
MARK_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def order(rows):
    return sorted((tuple(None if pd.isna(x) else x for x in r) for r in rows),
                  key=lambda r: tuple((x is None, x) for x in r))


def jaccard_components(rows, k=5, percent=80):
    """rows (id, text) -> (id, set size, component id)."""
    sets = []
    for _, text in rows:
        w = SPACE_WORD.findall(lower(text))
        sets.append(frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x])
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n) and rows[i][0] is not None and rows[j][0] is not None:
                parent[find(i)] = find(j)
        for x in s:
            holders[x].append(i)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)].append(d)
    return order((d, len(sets[i]), min(least[find(i)]) if d is not None else None) for i, (d, _) in enumerate(rows))


def quality(rows, min_docs=3, max_lost=50):
    """rows (id, source, text) -> id, base figures, base_failed, kept, lost words."""
    lines, hosts, size, per, out = defaultdict(set), defaultdict(set), {}, [], []
    for d, s, t in rows:
        t = t or ""
        w = SPACE_WORD.findall(t)
        full = [x for x in t.split("\n") if SPACE_WORD.search(x)]
        count = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        held = {i + j for i in range(len(w) - 4) if count[tuple(w[i:i + 5])] > 1 for j in range(5)}
        norm = [tuple(re.sub("[0-9]", "0", lower(x)) for x in SPACE_WORD.findall(line)) for line in full]
        for n in set(norm):
            lines[s, n].add(t)
            size[s, n] = min(size.get((s, n), 10 ** 9), norm.count(n) * len(n))
        hosts[s].add(t)
        per.append((d, s, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(full) - len(set(full)), len(held), norm))
    for d, s, n, chars, symbols, dup, rep, norm in per:
        lost = sum(len(x) for x in norm if len(lines[s, x]) > max(min_docs, 0.16 * len(hosts[s]) ** 0.8 * (8 / size[s, x]) ** 0.5))
        failed = n < 10 or 100 * rep > 20 * n
        out.append((d, n, chars, symbols, dup, rep, failed, not failed and 100 * lost <= max_lost * n, lost))
    return order(out)


def contamination(rows, items):
    """(id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    windows = defaultdict(set)
    for i, t in items:
        w = MARK_WORD.findall(lower(t))
        for j in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[j:j + 10])].add("" if i is None else str(i))
    sizes = {len(x) for x in windows}
    out = []
    for d, t in rows:
        w = MARK_WORD.findall(lower(t))
        hit, found = set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if (x := tuple(w[j:j + n])) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[x]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return order(out)


def phrases(rows, base):
    """(id, n_words, n_base, first, last, base labels)."""
    out = []
    for d, t in rows:
        w = MARK_WORD.findall(lower(t))
        at = [(i, label) for label, text in base for i in range(len(w)) if w[i:i + len(text.split())] == text.split()]
        starts = [i for i, _ in at]
        out.append((d, len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))))
    return order(out)
