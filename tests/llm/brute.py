"""Plain versions that the operators are held against."""

import hashlib
import re


def substring_dedup(rows, width=20):
    """rows: (doc_id, text). {doc_id: (n_words, n_removed, kept_sha256)}; doc_ids are distinct."""
    words = {d: re.findall(r"[^\x20\x09-\x0D]+", t or "") for d, t in rows}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - width + 1):
            first.setdefault(tuple(words[d][i : i + width]), (d, i))
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i : i + width])] != (d, i):
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def simhash(rows, bits=2):
    """rows: (doc_id, text). {doc_id: (fingerprint, component_id)} from all pairs of distinct fingerprints."""
    import numpy as np
    import xxhash

    prints = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
        h = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in s]
        prints[d] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    ids = sorted(prints)
    f = np.array([prints[d] for d in ids], np.uint64)
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(f[i + 1 :] ^ f[i]) <= bits):
            a, b = find(i), find(int(j) + i + 1)
            root[max(a, b)] = min(a, b)
    return {d: (f"{prints[d]:016x}", ids[find(i)]) for i, d in enumerate(ids)}


def contaminated(docs, items, units, width=5, literals=3, share=0.5, least=3):
    """{(doc_id, item_id): (windows, reparameterised)}, by comparing every window of every document and item."""
    import itertools

    def tokens(text):
        """(word, lower case, kind) of each token; kind is L, N, P, U, or S for a sentence start that may be a name."""
        out, end = [], 0
        for m in re.finditer("[A-Za-z\u0080-\U0010ffff]+|[0-9]+", text or ""):
            w = m[0]
            low = re.sub("[A-Z\u00c0-\u00d6\u00d8-\u00de]", lambda c: c[0].lower(), w)
            fresh = not out or re.search("[.!?\n]", text[end : m.start()])
            capital = low != w and low[0] != w[0] and low[1:] == w[1:]
            kind = "N" if w[0].isdecimal() and w[0].isascii() else "U" if out and out[-1][1] == "N" and low in units else "L" if not capital else "S" if fresh else "P"
            out.append((low, kind))
            end = m.end()
        return out

    def slots(found):
        out = []
        for low, kind in found:
            if out and kind in "NPU" and out[-1][0] == kind:
                out[-1] = (kind, (*out[-1][1], low))
            else:
                out.append((kind, (low,)))
        return out

    def readings(window):
        plain = sum(k in "LS" for k, _ in window)
        if plain < literals:
            return
        may = [i for i, (k, _) in enumerate(window) if k == "S"]
        for n in range(len(may) + 1):
            for names in itertools.combinations(may, n):
                if not n or plain - n >= literals - 1:
                    yield tuple("P" if i in names else v if k in "LS" else k for i, (k, v) in enumerate(window))

    def windows(s):
        return [(i, set(readings(s[i : i + width]))) for i in range(len(s) - width + 1) if sum(k in "LS" for k, _ in s[i : i + width]) >= literals]

    out = {}
    for (d, text), (item, ask) in itertools.product(docs, items):
        mine, theirs = tokens(text), tokens(ask)
        a, b = slots(mine), slots(theirs)
        own = windows(b)
        if not own:
            n = len(theirs)
            if n >= least and any([x[0] for x in mine[i : i + n]] == [x[0] for x in theirs] for i in range(len(mine) - n + 1)):
                out[d, item] = (1, False)
            continue
        found, same, by = set(), True, {}
        for (i, x), (j, y) in itertools.product(windows(a), own):
            if x & y:
                by.setdefault(i - j, set()).add(j)
        for step, places in by.items():
            stands, odd = {}, set()
            for q in sorted({j + k for j in places for k in range(width)}):
                kind, value = b[q]
                other = a[q + step][1]
                if kind == "S" and value != other:
                    kind = "P"
                if kind in "NPU":
                    same &= value == other
                    if stands.setdefault((kind, value), other) != other:
                        odd.add(q)
            found |= {j for j in places if not odd & set(range(j, j + width))}
        if len(found) >= share * len(own):
            out[d, item] = (len(found), not same)
    return out
