"""Plain versions of the operators' results, for small tables."""

import hashlib
import re

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def shingles(text):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOW))
    return {tuple(w)} if 0 < len(w) < 5 else set(zip(w, w[1:], w[2:], w[3:], w[4:]))


class Components:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        x, y = sorted((self.root(x), self.root(y)))
        self.up[y] = x


def near(docs):
    """{doc_id: (n_shingles, component_id)} of [(doc_id, text)] with distinct ids."""
    sets = {d: shingles(t) for d, t in docs}
    c = Components(sets)
    ids = sorted(sets)
    for i, x in enumerate(ids):
        for y in ids[i + 1:]:
            both = len(sets[x] & sets[y])
            if both and 100 * both >= 75 * (len(sets[x]) + len(sets[y]) - both):
                c.join(x, y)
    return {d: (len(sets[d]), c.root(d)) for d in ids}


def repeats(docs, length=100):
    """{doc_id: (bytes, removed, spans, sha of the rest, rest)} of [(doc_id, text)] with distinct ids."""
    seen, out = set(), {}
    for d, t in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0)):
        b = (t or "").encode()
        gone = bytearray(len(b))
        own = []
        for s in range(len(b) - length + 1):
            w = b[s:s + length]
            if w in seen:
                gone[s:s + length] = b"\1" * length
            else:
                seen.add(w)
                own.append(w)
        rest = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest(), rest)
    return out


def holds_item(text, item):
    words = lambda t: re.findall(r"[^\W\d_]+|\d+", (t or "").lower())
    a, b = words(text), words(item)
    return any(a[k:k + len(b)] == b for k in range(len(a) - len(b) + 1))
