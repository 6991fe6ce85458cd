"""Plain-Python versions of the operators' contracts."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def shingles(text, width):
    w = WORD.findall(lower(text))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def groups(rows, width, num, den):
    """Smallest id reachable by links, by row number."""
    sets = [shingles(t, width) for _, t in rows]
    lists = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            lists[g].append(i)
    shared = Counter((a, b) for members in lists.values() for i, a in enumerate(members) for b in members[i + 1:])
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for (a, b), n in shared.items():
        if den * n >= num * (len(sets[a]) + len(sets[b]) - n):
            root[find(b)] = find(a)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)].append(d)
    return [(d, len(sets[i]), min(least[find(i)], default=None) if sets[i] else d)
            for i, (d, _) in enumerate(rows)]


def spans(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text or "") if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 32]
    found += [(m.start(), 3, "pem", m.end()) for m in re.finditer("-----BEGIN [A-Z ]*PRIVATE KEY-----", text or "")]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def redacted(text, mark="[SECRET]"):
    out, at = [], 0
    for _, a, b in spans(text):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:] if out else text


def contamination(text, items, width=13):
    """(n_words, n_hit, item ids as strings, sorted)."""
    w = BENCH_WORD.findall(lower(text))
    hit, found = set(), set()
    for item, t in items:
        x = BENCH_WORD.findall(lower(t))
        size = min(width, len(x))
        for s in range(len(x) - size + 1 if size else 0):
            for p in range(len(w) - size + 1):
                if w[p:p + size] == x[s:s + size]:
                    hit.update(range(p, p + size))
                    found.add(item)
    return len(w), len(hit), sorted(str(i) for i in found if i is not None)


def tiktoken_encoding():
    import public_tokenizers
    import tiktoken
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def collocations(rows, max_words=3, least=10, share=50, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) of (text, lang) rows."""
    count = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall("[^\x20\x09]+", piece)
            for k in range(1, max_words + 1):
                count["und" if lang is None else lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in count.items():
        n = sum(f for p, f in c.items() if len(p) == 1)
        many = {p: f for p, f in c.items() if f >= least and len(p) > 1}
        inside = {p[i:j] for p, f in many.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                  if j - i < len(p) and 100 * f >= share * c[p[i:j]]}
        found = []
        for p, a in many.items():
            if p not in inside:
                score, _, left, right = min((10 ** 6 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]])
                                            for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        found.sort()
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s)
                for i, (s, a, p, left, right) in enumerate(found[:top])]
    return sorted(out)


def spelling_words(rows, every=31, min_chars=7, least=2):
    c = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            c[run[:h % len(run)] + run[h % len(run) + 1:] if h % every == 0 else run] += 1
    return {w: n for w, n in c.items() if n >= least and len(w) >= min_chars}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(count, ratio=10):
    """(form, root, n, n_near, form_n) by word."""
    by = defaultdict(set)
    for w in count:
        for x in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            by[x].add(w)
    near = defaultdict(set)
    for group in by.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w in near:
        best = min(near[w], key=lambda x: (-count[x], x), default=None)
        if best is not None and count[best] >= ratio * count[w]:
            form[w] = best
    out = {}
    for w, n in count.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near[w]), count[form[w]] if w in form else None)
    return out
