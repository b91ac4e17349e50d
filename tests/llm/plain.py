"""Plain versions of operators 11 to 13."""

from __future__ import annotations

import hashlib
import math
import zlib


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# --- op11
def embedding_links(rows: list[tuple[int | None, list | None]]) -> list[tuple]:
    """(vec_id, n_links, component_id, kept) of each row."""
    vectors = {}
    for i, v in rows:
        ok = i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        if ok:
            vectors[(i, tuple(v))] = [x / math.sqrt(math.fsum(y * y for y in v)) for x in v]
    keys = list(vectors)
    links = {k: 0 for k in keys}
    least = {i: i for i, _ in rows if i is not None}

    def top(i):
        while least[i] != i:
            i = least[i]
        return i

    for a in range(len(keys)):
        for b in range(a):
            x, y = vectors[keys[a]], vectors[keys[b]]
            if len(x) == len(y) and math.fsum(p * q for p, q in zip(x, y, strict=True)) >= 0.9:
                links[keys[a]] += 1
                links[keys[b]] += 1
                p, q = sorted((top(keys[a][0]), top(keys[b][0])))
                least[q] = p
    out = []
    for i, v in rows:
        c = top(i) if i is not None else None
        out.append((i, links.get((i, tuple(v)), 0) if v else 0, c, i == c))
    return out


# --- op12
def _up(level: list[str]) -> list[str]:
    return [sha(*level[k : k + 16]) for k in range(0, len(level), 16)]


def _levels(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append(_up(out[-1]))
    return out


def merkle(rows: list[tuple]) -> list[tuple]:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each (doc_id, source, lang, n_chars, text)."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    by = {}
    for r in rows:
        leaf = sha(*map(field, r))
        bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf, sha(*map(field, (*r[:4], r[4].translate(lower)))) if bad else leaf))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: _levels([x[2] for x in sorted(by[s])]) for s in sources}
    crown = _levels([trees[s][-1][0] for s in sources])
    out = []
    for at, s in enumerate(sources):
        for k, (has, i, leaf, altered) in enumerate(sorted(by[s])):
            node, siblings = altered, []
            for place, levels in ((k, trees[s]), (at, crown)):
                for level in levels[:-1]:
                    run = level[place - place % 16 : place - place % 16 + 16]
                    siblings += run[: place % 16] + run[place % 16 + 1 :]
                    node = sha(*run[: place % 16], node, *run[place % 16 + 1 :])
                    place //= 16
            root = crown[-1][0]
            out.append((i if has else None, leaf, trees[s][-1][0], root, sha(*siblings), node, node == root))
    return out


# --- op13
def trie(rows: list[tuple]) -> set[tuple]:
    """The nodes for (conv_id, turn, role, text) rows."""
    said = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            said.setdefault(c, []).append((turn is not None, turn or 0, sha(f"{len(role.encode())}:{role}{text}"), role, text))
    said = {c: [x[3:] for x in sorted(t)] for c, t in said.items()}
    made = {}
    for c in said:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))
        made[c] = said.get(base, [])[:h] + said[c][h:]
    nodes = {}
    for c, t in made.items():
        for d in range(len(t) + 1):
            nodes.setdefault(tuple(t[:d]), []).append(c)
    kids, leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(members) - 1) * len(p[-1][1].encode()) if p else 0
    return {(min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
             sha(",".join(str(c) for c in sorted(m) if len(made[c]) == len(p)))) for p, m in nodes.items()}
