"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import re

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = " \t\n\x0b\x0c\r"


def judge_url(url, rules, default="allow"):
    if url is None or "://" not in url:
        host, path = "", ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(UP)
    fits = [(len(h + p), len(h), v == "block", h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, default
    best = max(fits)
    return host, path, best[3], "block" if best[2] else "allow"


def remove_repeats(rows, length):
    """rows: (doc_id, text). Per row (n_bytes, n_removed, n_spans, kept)."""
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        if doc is not None:
            for s in range(len(data) - length + 1):
                w = data[s : s + length]
                first[w] = min(first.get(w, (doc, s)), (doc, s))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        if doc is not None:
            for s in range(len(data) - length + 1):
                if first[data[s : s + length]] < (doc, s):
                    gone[s : s + length] = b"\1" * length
        runs = sum(1 for k in range(len(data)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((len(data), sum(gone), runs, bytes(b for b, g in zip(data, gone) if not g)))
    return out


def shingles(text, n=5):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(UP)) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1)))


def components(rows, percent=75):
    """Of rows (doc_id, text) with distinct ids: {doc_id: (n_shingles, component)}."""
    sets = {d: shingles(t) for d, t in rows if d is not None}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    ra, rb = root(a), root(b)
                    parent[max(ra, rb)] = min(ra, rb)
    return {d: (len(sets[d]), root(d)) for d in ids}


def words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP)) if w]


def contamination(text, items, size=13, share=20):
    """(n_words, n_hit, items, contaminated)."""
    w, hit, found = words(text), set(), set()
    for item_id, item in items:
        v = words(item)
        if item_id is None or not v:
            continue
        for s in range(max(1, len(v) - size + 1)):
            window = v[s : s + size]
            for at in range(len(w) - len(window) + 1):
                if w[at : at + len(window)] == window:
                    hit |= set(range(at, at + len(window)))
                    found.add(str(item_id))
    return len(w), len(hit), sorted(found), len(hit) > 0 and share * len(hit) >= len(w)


def dedup_lines(rows, min_docs=3, min_chars=20):
    """Of rows (doc_id, text): per row (n_lines, n_dropped, kept text)."""
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(BLANKS).translate(UP)
            if doc is not None and len(key) >= min_chars:
                holders.setdefault(key, set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            h = holders.get(line.strip(BLANKS).translate(UP), ())
            if doc is None or len(h) < min_docs or doc == max(h):
                kept.append(line)
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def base_licenses(text, phrases):
    """(n_words, n_base, first, last, labels)."""
    w = words(text)
    found = [(k, label) for phrase, label in phrases.items() for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()]
    at = [k for k, _ in found]
    return len(w), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in found}))
