"""Plain versions of the pipeline's stages for small tables."""

import hashlib
import re
from collections import Counter
from itertools import combinations


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def link_classes(rows):
    """{key: smallest key reachable by links}."""
    sets, root = {k: shingles(t) for k, t in rows}, {k: k for k, _ in rows}
    for a, b in combinations(sorted(root), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            low, high = sorted((root[a], root[b]))
            root = {k: low if v == high else v for k, v in root.items()}
    return root


def contaminated(rows, items):
    """Keys of texts with a run of shingles that is similar to an item."""
    out = set()
    for key, text in rows:
        w = (text or "").encode().lower().split()
        grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        for _, item in items:
            v = (item or "").encode().lower().split()
            need = Counter(tuple(v[i : i + 5]) for i in range(len(v) - 4))
            total = sum(need.values())
            for a in (i for i, g in enumerate(grams) if g in need):
                seen, shared = Counter(), 0
                for b in range(a, min(len(grams), a + 2 * total)):
                    seen[grams[b]] += 1
                    shared += seen[grams[b]] <= need[grams[b]]
                    if 100 * shared >= 75 * (total + b - a + 1 - shared):
                        out.add(key)
    return out


def mixed_copies(rows, weights=(1, 2, 3), seed=17):
    """Copies of each key under systematic sampling; rows are (key, text, source)."""
    size = {k: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t, _ in rows}
    sources = sorted({s for *_, s in rows})
    total = {s: sum(size[k] for k, _, x in rows if x == s) for s in sources}
    weight = {s: weights[i % 3] for i, s in enumerate(sources)}
    target, free, left = {}, list(sources), float(sum(total.values()))
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * total[s]]
        if not over:
            target |= share
            break
        target |= {s: 3.0 * total[s] for s in over}
        left -= sum(3.0 * total[s] for s in over)
        free = [s for s in free if s not in over]
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    out = Counter()
    for s in sources:
        offset = int(md5(f"{seed}:s{s}")[:8], 16) / 2**32
        order = sorted((f"{len(bin(size[k])) - 2:02d}{bin(size[k])[2:6]}", md5(str(k)), k) for k, _, x in rows if x == s)
        rate, before = target[s] / total[s] if total[s] else 0.0, 0
        for rank, (*_, k) in enumerate(order, 1):
            upto = int(rate * rank + offset)
            if upto > before:
                out[k] += upto - before
            before = upto
    return out
