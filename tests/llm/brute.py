"""Plain single-process versions of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from html import unescape

WS = re.compile(r"[\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return [w for w in WS.split(text or "") if w]


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text)


# --- op3
def secrets(text: str | None) -> dict:
    text = text or ""
    out = []
    for i, (kind, pat, least) in enumerate([
        ("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8),
        ("access", r"(AKIA[A-Z0-9]+)", 16), ("hex", r"([0-9a-f]+)", 32)]):
        for m in re.finditer(pat, text):
            if len(m[m.re.groups]) >= least:
                out.append((m.start(), i, kind, m.end()))
    out.sort()
    joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in out)
    c = Counter(x[2] for x in out)
    return {"n_assign": c["assign"], "n_access": c["access"], "n_hex": c["hex"], "base_sha256": hashlib.sha256(joined.encode()).hexdigest(), "base": [f"{k}:{s}:{e}" for s, _, k, e in out]}


# --- op4
def shingle_set(text: str | None, n: int = 3) -> frozenset:
    w = words(lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def jaccard_components(rows: list[tuple[int, str | None]], num: int = 90, den: int = 100) -> dict[int, tuple[int, int]]:
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders: dict = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    same: Counter = Counter()
    for h in holders.values():
        for a in range(len(h)):
            for b in range(a):
                same[(min(h[a], h[b]), max(h[a], h[b]))] += 1
    for (a, b), n in same.items():
        if den * n >= num * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            if x != y:
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


# --- op5
def dedup_lines(rows: list[tuple[int, str]], min_words: int = 50) -> dict[int, str]:
    """Deletes a line if it lies in a run of lines with min_words words that occurred before. Texts by doc_id."""
    docs = {i: [(p, x, len(words(x))) for p, x in enumerate(t.split("\n")) if words(x)] for i, t in sorted(rows)}
    first: dict = {}
    dead: dict = {i: set() for i in docs}
    for i, lines in docs.items():
        for s in range(len(lines)):
            n, e = 0, s
            while e < len(lines) and n < min_words:
                n += lines[e][2]
                e += 1
            if n < min_words:
                break
            key = tuple(x[1] for x in lines[s:e])
            if key not in first:
                first[key] = (i, s)
                continue
            j, q = first[key]
            src = docs[j]
            a, b = s, e
            while b < len(lines) and q + b - s < len(src) and lines[b][1] == src[q + b - s][1]:
                b += 1
            while a > 0 and q + a - 1 - s >= 0 and lines[a - 1][1] == src[q + a - 1 - s][1]:
                a -= 1
            if (j, q + a - s) != (i, a):
                dead[i] |= {lines[k][0] for k in range(a, b)}
    return {i: "\n".join(x for p, x in enumerate(t.split("\n")) if p not in dead[i]) for i, t in rows}


def dedup_lines_all(rows: list[tuple[int, str]], min_words: int = 50) -> dict[int, str]:
    """The same, each line compared with all of its earlier occurrences, however their runs begin and end."""
    docs = {i: [(p, x, len(words(x))) for p, x in enumerate(t.split("\n")) if words(x)] for i, t in sorted(rows)}
    seen: dict = {}
    dead: dict = {i: set() for i in docs}
    for i, lines in docs.items():
        for s in range(len(lines)):
            for j, q in seen.setdefault(lines[s][1], []):
                n, e = 0, s
                while e < len(lines) and q + e - s < len(docs[j]) and lines[e][1] == docs[j][q + e - s][1]:
                    n += lines[e][2]
                    e += 1
                if n >= min_words:
                    dead[i] |= {lines[k][0] for k in range(s, e)}
            seen[lines[s][1]].append((i, s))
    return {i: "\n".join(x for p, x in enumerate(t.split("\n")) if p not in dead[i]) for i, t in rows}


# --- op6
def rules(text: str | None) -> dict:
    text = text or ""
    w = words(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times = Counter(grams)
    hit = set()
    for i, g in enumerate(grams):
        if times[g] > 1:
            hit |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": dup, "n_repeat_words": len(hit),
            "base_failed": len(w) < 50 or 100 * len(hit) > 50 * len(w)}


# --- op7
def chat(turns: list[tuple[str | None, str | None]]) -> dict:
    t = [(r or "", x or "") for r, x in turns]
    loss = "".join(x for r, x in t if r == "assistant")
    return {"n_turns": len(t), "turns_sha256": hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in t).encode()).hexdigest(),
            "loss_chars": len(loss), "loss_sha256": hashlib.sha256(loss.encode()).hexdigest()}


# --- op8
def pieces(ids: list[int], length: int = 2048) -> list[tuple[int, int, int, int]]:
    ids = [*ids, 0]
    cuts = [0, *range(len(ids) % length or length, len(ids), length)] if len(ids) > length else [0]
    ends = [*cuts[1:], len(ids)]
    return [(k, a, b - a, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[a:b]))) for k, (a, b) in enumerate(zip(cuts, ends, strict=True))]


# --- pipeline, after the classifier
def pipeline(rows: list[tuple[int, str | None]], encode, scope: int = 400) -> set[tuple]:
    """(doc_id, piece, start, length, ids_crc32) of what is left of documents with different ids."""
    from perron.llm.secrets import KINDS, find

    before = {i: t or "" for i, t in rows}
    after = dedup_lines_all(list(before.items()))
    left = {i: t for i, t in after.items() if t == before[i] or words(t)}
    sets = {i: shingle_set(t, 5) for i, t in left.items()}
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 100 * (n := len(sets[a] & sets[b])) >= 80 * (len(sets[a]) + len(sets[b]) - n) and n:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    role, alone, out = {k: r for k, r, _ in KINDS}, {k for k, _, a in KINDS if a}, set()
    for i, t in left.items():
        if root[i] != i:
            continue
        found, made, at = find(t), "", 0
        for k, s, e in found:
            near = {role[x] for x, y, _ in found if abs(y - s) <= scope}
            if k not in alone and not {"identifier", "secret"} <= near:
                continue
            if s >= at:
                made += t[at:s] + "[SECRET]"
            at = max(at, e)
        out |= {(i, *p) for p in pieces(encode(made + t[at:]))}
    return out


# --- op1, for pages whose article is one <article> element without boilerplate inside
def article(page: str) -> str:
    m = re.search(r"<article>(.*?)</article>", page, re.DOTALL)
    if not m:
        return ""
    text = re.sub(r"</?(?:p|h1|div|ul|li|br)[^>]*>", " ", m[1])
    return " ".join(unescape(re.sub(r"<[^>]+>", "", text)).split())
