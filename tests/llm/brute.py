"""Plain-Python versions of the operators, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

BLANK_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=5):
    words = BLANK_WORDS.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def components(docs, percent):
    """doc_id -> (set size, smallest linked id); docs is a list of (doc_id, text)."""
    sets = {i: shingles(t) for i, t in docs}
    label = {i: i for i in sets}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return {i: (len(sets[i]), label[i]) for i in sets}


def covered(docs, length, first_stays=False):
    """Per row of (doc_id, text) a flag for every byte in a repeated string (or one that an earlier id holds)."""
    raw = [(i, (t or "").encode()) for i, t in docs]
    count, least = Counter(), {}
    for i, b in raw:
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            count[w] += 1
            least[w] = min(least.get(w, i), i)
    out = []
    for i, b in raw:
        flags = bytearray(len(b))
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if least[w] < i if first_stays else count[w] > 1:
                flags[s : s + length] = b"\1" * length
        out.append((i, b, flags))
    return out


def removal(i, b, flags):
    kept = bytes(c for c, f in zip(b, flags, strict=True) if not f)
    spans = sum(1 for k in range(len(b)) if flags[k] and (k == 0 or not flags[k - 1]))
    return (i, len(b), sum(flags), spans, hashlib.sha256(kept).hexdigest())


def without(b, flags):
    """Text left; a character that is only partly flagged stays."""
    out, at = [], 0
    for c in b.decode():
        n = len(c.encode())
        if not all(flags[at : at + n]):
            out.append(c)
        at += n
    return "".join(out)


def contamination(docs, items, span):
    words = {k: ALNUM_WORDS.findall((t or "").translate(LOWER)) for k, t in items}
    windows = defaultdict(set)
    for k, w in words.items():
        m = min(span, len(w))
        for i in range(len(w) - m + 1) if m else ():
            windows[tuple(w[i : i + m])].add(k)
    sizes = {len(w) for w in windows}
    out = []
    for i, t in docs:
        w = ALNUM_WORDS.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for m in sizes:
            for at in range(len(w) - m + 1):
                if tuple(w[at : at + m]) in windows:
                    hit.update(range(at, at + m))
                    found |= windows[tuple(w[at : at + m])]
        listed = ",".join(sorted(str(k) for k in found))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return out


def text_statistics(text):
    text = text or ""
    words = BLANK_WORDS.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if BLANK_WORDS.search(line):
            dups += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(inside)


def repeated_from(doc_id, words):
    """The words of a document, those of every tenth one repeating from some word on."""
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def runs_of(words, least=12):
    """(start, length, period) of every run, by comparing the words with themselves at every distance."""
    number = {}
    codes = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    smallest = {}
    for q in range(1, len(words) // 2 + 1):
        same = np.concatenate(([0], codes[:-q] == codes[q:], [0])).astype(int)
        steps = np.diff(same)
        for s, e in zip(np.nonzero(steps == 1)[0].tolist(), np.nonzero(steps == -1)[0].tolist(), strict=True):
            if e - s + q >= max(least, 2 * q):
                smallest.setdefault((s, e - s + q), q)
    return sorted(((s, n, q) for (s, n), q in smallest.items()), key=lambda r: (r[0], r[2]))


def run_digests(doc_id, words):
    runs = runs_of(words)
    s, n, q = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None,) * 3
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return doc_id, len(runs), s, n, q, 1000 * n // q if runs else None, sha(listed), sha(kept)
