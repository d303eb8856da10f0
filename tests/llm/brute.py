"""Brute-force versions of the numbered operators over small Python lists."""
import re
from collections import Counter

WORD = r"[^\x20\x09-\x0D]+"


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def components(rows, k, percent):
    """{doc_id: (set size, smallest reachable id)}"""
    sets = {}
    for i, t in rows:
        w = re.findall(WORD, low(t or ""))
        sets[i] = frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    parent, inverted = {i: i for i in sets}, {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in sorted(sets):
        shared = Counter(j for g in sets[i] for j in inverted.get(g, ()))
        for j, c in shared.items():
            if 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for g in sets[i]:
            inverted.setdefault(g, []).append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def dedup(rows, window=20):
    """{doc_id: (words, removed, kept text)}"""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        w = re.findall(WORD, t or "")
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            key = tuple(w[j:j + window])
            if key in seen:
                gone[j:j + window] = [True] * window
            seen.add(key)
        out[i] = len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)
    return out


def base_counts(t):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    w = re.findall(WORD, t or "")
    n = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + d for i in range(len(w) - 2) if n[tuple(w[i:i + 3])] > 1 for d in range(3)}
    lines = [x for x in (t or "").split("\n") if re.search(WORD, x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered)


def contamination(rows, items, window=10):
    """{doc_id: (n_words, n_hit, sorted item ids as text)}"""
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t or ""))
    wins = {}
    for item, t in items:
        w = words(t)
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            wins.setdefault(tuple(w[i:i + window]), set()).add(str(item))
    sizes, out = {len(x) for x in wins}, {}
    for i, t in rows:
        w, hit, names = words(t), set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if (key := tuple(w[j:j + n])) in wins:
                    hit |= set(range(j, j + n))
                    names |= wins[key]
        out[i] = len(w), len(hit), sorted(names)
    return out


def merkle(rows):
    """Rows (doc_id, source, lang, n_chars, text) to (doc_id, leaf, subroot, root, proof, folded root, verified)."""
    import hashlib
    import zlib

    def h(*parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def leaf(i, source, lang, n, text):
        return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (i, source, lang, n, text)))

    def climb(nodes, at, claim):
        proof = []
        while len(nodes) > 1:
            run = list(range(at // 8 * 8, min(at // 8 * 8 + 8, len(nodes))))
            proof += [nodes[r] for r in run if r != at]
            claim = h(*(claim if r == at else nodes[r] for r in run))
            nodes, at = [h(*nodes[r:r + 8]) for r in range(0, len(nodes), 8)], at // 8
        return nodes[0], proof, claim

    trees = {}
    for r in rows:
        bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        claim = leaf(*r[:4], low(r[4]) if bad and r[4] is not None else r[4])
        trees.setdefault(r[2], []).append((r[0], leaf(*r), claim))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for x in langs:
        trees[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    subroots = [climb([r[1] for r in trees[x]], 0, "")[0] for x in langs]
    out = []
    for t, x in enumerate(langs):
        nodes = [r[1] for r in trees[x]]
        for at, (i, own, claim) in enumerate(trees[x]):
            subroot, low_proof, folded = climb(nodes, at, claim)
            root, top_proof, folded = climb(subroots, t, folded)
            out.append((i, own, subroot, root, h(*low_proof, *top_proof), folded, folded == root))
    return out


def aligned(rows, tokens):
    """Rows (doc_id, text) to (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups); ``tokens(text)`` gives both sides'
    (id, bytes) lists."""
    per, count = [], Counter()
    for _, t in rows:
        sides = tokens(t) if t else None
        if sides is None or any(b"".join(b for _, b in s) != (" " + t).encode() for s in sides):
            per.append(None)
            continue
        spans = []
        for s in sides:
            end, own = 0, []
            for i, b in s:
                own.append((i, end, end + len(b)))
                end += len(b)
            spans.append(own)
        links, j = [], 0
        for a, s, e in spans[0]:
            while spans[1][j][2] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < e:
                links.append((a, spans[1][k][0]))
                k += 1
        groups, at = [], [0, 0]
        for cut in sorted({x[2] for x in spans[0]} & {x[2] for x in spans[1]}):
            sides = []
            for k, own in enumerate(spans):
                first = at[k]
                while at[k] < len(own) and own[at[k]][2] <= cut:
                    at[k] += 1
                sides.append(",".join(str(i) for i, _, _ in own[first:at[k]]))
            groups.append("|".join(sides))
        per.append((len(spans[0]), len(spans[1]), len(groups), links, ";".join(groups)))
        count.update(set(links))
    highest = {}
    for (a, _), n in count.items():
        highest[a] = max(n, highest.get(a, 0))
    return [(i, 0, 0, 0, 0, 0, 0, "") if p is None else (i, *p[:3], len(p[3]), sum(count[x] == highest[x[0]] for x in p[3]), sum(count[x] for x in p[3]), p[4])
            for (i, _), p in zip(rows, per)]
