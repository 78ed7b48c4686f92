"""What the operators have to give, worked out the plain way."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

SPACE_WORD = re.compile("[^\x20\x09-\x0d]+")
ITEM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def low(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sha(value: str | bytes) -> str:
    return hashlib.sha256(value.encode() if isinstance(value, str) else value).hexdigest()


def substring_dedup(docs, window=20):
    seen, out = set(), {}
    for i, t in sorted(docs, key=lambda d: d[0]):
        words = SPACE_WORD.findall(t or "")
        covered = [False] * len(words)
        for at in range(len(words) - window + 1):
            run = tuple(words[at : at + window])
            if run in seen:
                covered[at : at + window] = [True] * window
            seen.add(run)
        out[i] = (len(words), sum(covered), sha(" ".join(w for w, c in zip(words, covered, strict=True) if not c)))
    return out


def contamination(docs, items, window=10):
    runs = collections.defaultdict(set)
    for i, t in items:
        words = ITEM_WORD.findall(low(t or ""))
        n = min(window, len(words))
        for at in range(len(words) - n + 1 if words else 0):
            runs[tuple(words[at : at + n])].add(i)
    out = {}
    for i, t in docs:
        words, hit, found = ITEM_WORD.findall(low(t or "")), set(), set()
        for n in {len(r) for r in runs}:
            for at in range(len(words) - n + 1):
                if (run := tuple(words[at : at + n])) in runs:
                    hit.update(range(at, at + n))
                    found |= {str(x) for x in runs[run] if x is not None}
        out[i] = (len(words), len(hit), sorted(found), bool(hit))
    return out


def near_duplicates(docs, percent=75, length=5):
    sets = {}
    for i, t in docs:
        words = SPACE_WORD.findall(low(t or ""))
        whole = [tuple(words)] if words else []
        sets[i] = {tuple(words[a : a + length]) for a in range(len(words) - length + 1)} if len(words) >= length else set(whole)
    least = {i: i for i in sets}

    def top(x):
        while least[x] != x:
            x = least[x]
        return x

    names = sorted(sets)
    for n, a in enumerate(names):
        for b in names[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((top(a), top(b)))
                least[q] = p
    return {i: (len(sets[i]), top(i)) for i in sets}


def exact_groups(docs):
    groups = collections.defaultdict(list)
    for i, t in docs:
        groups[low(t or "")].append(i)
    return {i: (max(ids), len(ids), i == max(ids), sha(text)) for text, ids in groups.items() for i in ids}


def line_dedup(docs, min_docs=3, min_chars=20):
    def key(line):
        return low(line.strip(" \t\n\x0b\x0c\r"))

    holders = collections.defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = {}
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < min_docs or max(holders[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def base_spans(text):
    assign = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


def suffix_dedup(docs, length):
    texts = [(i, (t or "").encode()) for i, t in docs]
    seen = collections.Counter(b[a : a + length] for _, b in texts for a in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = [False] * len(b)
        for a in range(len(b) - length + 1):
            if seen[b[a : a + length]] > 1:
                gone[a : a + length] = [True] * length
        spans = sum(g and (at == 0 or not gone[at - 1]) for at, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone, strict=True) if not g))))
    return sorted(out, key=str)


def resample(docs, items, percent=5, min_words=20, buckets=10_000, seed=42):
    def features(text):
        words = ITEM_WORD.findall(low(text or ""))
        runs = [" ".join(words[a : a + n]) for n in (1, 2, 3) for a in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    held = [(i, *features(t)) for i, t in docs]
    s, t = collections.Counter(b for _, _, f in held for b in f), collections.Counter(b for x in items for b in features(x)[1])
    of = (sum(s.values()) + buckets) / (sum(t.values()) + buckets)
    gains = {b: math.floor(1000 * math.log((t[b] + 1) * of / (s[b] + 1))) for b in s}
    rows = []
    for i, n_words, f in held:
        h = int(sha(f"{seed}:{'' if i is None else i}")[:8], 16)
        weight = sum(gains[b] for b in f)
        rows.append((n_words, i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in rows if r[0] >= min_words), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2]))
    n = percent * len(able) // 100
    drawn = [(*r[1:], rank) for rank, r in enumerate(able[:n], 1)]
    return sorted(drawn + [(*r[1:], None) for r in able[n:] + [r for r in rows if r[0] < min_words]], key=str)


def audit_sources(rows, min_docs=30, top=50):
    """Rows of (text, lang, source)."""
    rows = [tuple(v or "" for v in r) for r in rows]
    words = [(re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", low(t)), lang, source) for t, lang, source in rows]
    out = []
    for lang in {r[1] for r in rows}:
        docs = collections.Counter(w for t, g, _ in words if g == lang for w in set(t))
        kept = sorted(w for w, n in docs.items() if n >= min_docs)
        counts = {s: collections.Counter() for _, g, s in rows if g == lang}
        for t, g, s in words:
            if g == lang:
                counts[s].update(w for w in t if docs[w] >= min_docs)

        def shares(c, kept=kept):
            return [1 + 10**9 * (c[w] + 5) // (sum(c.values()) + 5 * len(kept)) for w in kept]

        p, q = {s: shares(c) for s, c in counts.items()}, shares(sum(counts.values(), collections.Counter()))
        for s in counts:
            pairs = [(-sum(abs(a - b) for a, b in zip(p[s], p[x], strict=True)), x.encode(), x) for x in counts if x != s]
            terms = [(y - x, w.encode(), w) for x, y, w in zip(p[s], q, kept, strict=True) if counts[s][w] and x > y]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, w, -v, n) for n, (v, _, w) in enumerate(found, 1)]
    return sorted(out)
