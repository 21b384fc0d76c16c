"""Plain versions of the text operators, for small inputs."""

import hashlib
import re
from collections import defaultdict

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text, pattern=ALNUM):
    return pattern.findall((text or "").translate(LOWER))


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def edited(docs):
    """doc_id -> (n_chars, edited text) for distinct doc_ids."""
    order = sorted(docs)
    out = {}
    for i, (d, t) in enumerate(order):
        nxt, t = order[(i + 1) % len(order)][1] or "", t or ""
        cut = len(t) // 4
        out[d] = (len(t), t[: len(t) - cut] + nxt[:cut])
    return out


def phrases(text, table):
    w = words(text)
    found = [(i, label) for p, label in table.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in found]
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def repeats(docs, length=50):
    """doc_id -> (n_bytes, n_removed, n_spans, sha of the rest)."""
    first = {}
    for d, t in sorted((d, (t or "").encode()) for d, t in docs):
        for i in range(len(t) - length + 1):
            first.setdefault(t[i : i + length], d)
    out = {}
    for d, t in docs:
        t = (t or "").encode()
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if first[t[i : i + length]] < d:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[d] = (len(t), sum(gone), spans, sha(kept))
    return out


def contamination(text, items, window=13):
    """(n_words, n_hit, n_items, sha of the items, contaminated)."""
    w = words(text)
    hit, found = set(), set()
    for item, t in items:
        v = words(t)
        if not v:
            continue
        size = min(window, len(v))
        keys = {tuple(v[i : i + size]) for i in range(len(v) - size + 1)}
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in keys:
                hit.update(range(i, i + size))
                found.add(item)
    ids = ",".join(sorted(map(str, found)))
    return len(w), len(hit), len(found), sha(ids), bool(hit) and 20 * len(hit) >= len(w)


def shingles(text, width=5):
    w = words(text, BLANK)
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def alike(a, b, share=75):
    return bool(a) and bool(b) and 100 * len(a & b) >= share * len(a | b)


def near_duplicates(docs):
    """doc_id -> (n_shingles, component_id)."""
    sets = {d: shingles(t) for d, t in docs}
    home = {d: d for d in sets}

    def root(d):
        while home[d] != d:
            d = home[d]
        return d

    holders = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            holders[x].add(d)
    for d, s in sets.items():
        for e in {e for x in s for e in holders[x] if e < d}:
            if alike(s, sets[e]):
                a, b = sorted((root(d), root(e)))
                home[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


def repeated_lines(docs, width=5):
    """(doc_id, line number) of lines like an earlier one; a line of fewer words is one shingle, as in `shingles`."""
    holders, sets, out = defaultdict(list), [], set()
    for d, t in sorted((d, t) for d, t in docs if t is not None):
        for i, line in enumerate(t.split("\n")):
            w = [x for x in re.split(r"[\x20\x09-\x0D]+", line.lower()) if x]
            s = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
            if any(alike(s, sets[j]) for j in {j for x in s for j in holders[x]}):
                out.add((d, i))
            for x in s:
                holders[x].append(len(sets))
            sets.append(s)
    return out


def quote_sources(messages):
    """(turn, level, words of the passage) -> source turn or None, for (turn, text) of one conversation."""
    norm = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    split = lambda t: [norm(x) for x in re.split(r"\n\s*\n", t) + t.split("\n")]
    own, units, passages = {}, {}, []
    for turn, text in messages:
        said, broken, last = [], [], 0
        for line in text.split("\n"):
            marks = re.match(r"([ \t]*>[> \t]*)?", line)[0]
            level, body = marks.count(">"), line[len(marks) :]
            if level and level == last:
                passages[-1][2].append(body)
            elif level:
                passages.append((turn, level, [body]))
            else:
                said.append(line)
            broken.append("" if level else line)
            last = level
        own[turn], units[turn] = norm("\n".join(said)), {*split("\n".join(broken)), *split("\n".join(said))[-len(said) :], norm("\n".join(said))}
    out = {}
    for turn, level, bodies in passages:
        w = norm("\n".join(bodies))
        earlier = [t for t in own if t < turn]
        has = lambda t, x: f" {x} " in f" {own[t]} "
        pieces = set(split("\n".join(bodies))) - {"", w}
        votes = [(sum(has(t, x) for x in pieces), t) for t in earlier]
        if w:
            best = [t for t in earlier if w in units[t]] or [t for t in earlier if has(t, w)] or [max(v for v in votes if v[0])[1]] if any(v[0] for v in votes) or any(has(t, w) for t in earlier) else []
            out[turn, level, w] = max(best, default=None)
    return out
