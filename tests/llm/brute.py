"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
PATTERNS = (
    ("assign", re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def base_spans(text: str | None) -> list[tuple[int, int, int, str]]:
    return sorted(
        (m.start(), i, m.end(), kind) for i, (kind, pattern, group, least) in enumerate(PATTERNS)
        for m in pattern.finditer(text or "") if len(m.group(group)) >= least)


def entropy_spans(text, classes, allowed):
    base, out = base_spans(text), []
    for number, c in enumerate(classes):
        for m in re.finditer(f"[0-9{c.letters}]+", text or ""):
            v = m.group()
            if len(v) < c.window or not re.search("[0-9]", v) or any(re.search(a, v) for a in allowed):
                continue
            spans = []
            for a in range(len(v) - c.window + 1):
                counts = Counter(v[a: a + c.window]).values()
                if -sum(n / c.window * math.log2(n / c.window) for n in counts) >= c.bits - 1e-9:
                    if spans and spans[-1][1] >= a:
                        spans[-1][1] = a + c.window
                    else:
                        spans.append([a, a + c.window])
            out += [(m.start() + a, 3 + number, m.start() + b, c.kind) for a, b in spans]
    return sorted(s for s in out if not any(b[0] <= s[0] and b[2] >= s[2] for b in base))


def repeats_removed(rows, window):
    texts = [words(t) for _, t in rows]
    counts = Counter(tuple(w[i: i + window]) for w in texts for i in range(len(w) - window + 1))
    for (doc_id, _), w in zip(rows, texts, strict=True):
        gone = {j for i in range(len(w) - window + 1) if counts[tuple(w[i: i + window])] > 1
                for j in range(i, i + window)}
        yield doc_id, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()


def near(rows, size, percent):
    sets = []
    for _, text in rows:
        w = words((text or "").encode().translate(LOWER).decode())
        sets.append({tuple(w[i: i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for j in range(i):
            both = len(s & sets[j])
            if both and 100 * both >= percent * len(s | sets[j]):
                parent[root(i)] = root(j)
    best = {}
    for i, (doc_id, _) in enumerate(rows):
        if sets[i] and doc_id is not None:
            best[root(i)] = min(doc_id, best.get(root(i), doc_id))
    return [(d, len(sets[i]), best.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def source_targets(sizes: dict, weights=(5, 2, 1), share=1.5, most=2.0) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if target[s] + left * weight[s] / total >= most * sizes[s]}
        if not over:
            for s in open_:
                target[s] += left * weight[s] / total
            break
        # those that overflow are filled; what they cannot take is dealt again
        given = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s in open_:
            room = most * sizes[s] - target[s]
            take = min(room, given[s])
            target[s] += take
            left += given[s] - take
        open_ -= over
    return target


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def by_text(rows):
    return sorted(map(tuple, rows), key=str)


def planted_words(text, doc_id):
    """Words of a text with the repetition that the hash of its doc_id plants."""
    w = words(text)
    if doc_id is None or not w:
        return w
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def all_runs(seq):
    """Every maximal stretch of exponent two or more with its smallest period, by trying all periods."""
    n, out = len(seq), set()
    for q in range(1, n // 2 + 1):
        k = 0
        while k < n - q:
            if seq[k] != seq[k + q]:
                k += 1
                continue
            j = k
            while j < n - q and seq[j] == seq[j + q]:
                j += 1
            s, length = k, j - k + q
            part = seq[s:s + length]
            if length >= 2 * q and min(r for r in range(1, q + 1) if part[r:] == part[:-r]) == q:
                out.add((s, length, q))
            k = j
    return sorted(out)


def periodic(text, doc_id):
    w = planted_words(text, doc_id)
    runs = sorted((r for r in all_runs(w) if r[1] >= max(6, 4 * r[2])), key=lambda r: (r[0], r[2]))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    head = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *head, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def _template_items(template):
    """Template as (kind, value) items: word, slot, or optional with its items."""
    out, stack, at = [], [[]], 0
    for m in re.finditer(r"\[\[|\]\]|<<[^>]*>>", template):
        stack[-1].extend(("word", w) for w in license_words(template[at:m.start()]))
        at = m.end()
        if m.group() == "[[":
            stack.append([])
        elif m.group() == "]]":
            inner = stack.pop()
            stack[-1].append(("optional", inner))
        else:
            stack[-1].append(("slot", None))
    stack[-1].extend(("word", w) for w in license_words(template[at:]))
    out = stack[0]
    return out


def _pattern(items, slot, upto=None):
    """A regular expression over words joined by single spaces; ``upto`` mandatory words at most."""
    parts, count = [], 0
    for kind, value in items:
        if upto is not None and count == upto:
            break
        if kind == "word":
            parts.append(re.escape(value) + " ")
            count += 1
        elif kind == "slot":
            parts.append(f"(?:\\S+ ){{1,{slot}}}")
        else:
            parts.append(f"(?:{_pattern(value, slot)})?")
    return "".join(parts)


def licenses(text, base, templates, slot):
    w = license_words(text)
    joined = "".join(x + " " for x in w)
    offsets, at = [], 0
    for x in w:
        offsets.append(at)
        at += len(x) + 1
    places = sorted((i, label) for phrase, label in base for i in range(len(w))
                    if w[i:i + len(phrase.split())] == phrase.split())
    labels, score = {label for _, label in places}, 0.0
    starts_all = offsets
    for label, template in templates:
        offsets = starts_all
        items = _template_items(template)
        mandatory = sum(1 for k, _ in items if k == "word")
        if any(re.compile(_pattern(items, slot)).match(joined, o) for o in offsets):
            labels.add(label)
        for k in range(1, mandatory + 1):  # a longer prefix of the template matches only where a shorter one does
            pattern = re.compile(_pattern(items, slot, k))
            offsets = [o for o in offsets if pattern.match(joined, o)]
            if not offsets:
                break
            score = max(score, k / mandatory)
    starts = [i for i, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({lb for _, lb in places})), ",".join(sorted(labels)), score)
