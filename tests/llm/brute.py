"""Plain Python versions of the operators, and the small tables they run on."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def spaced(text):
    return SPACED.findall((text or "").translate(LOWER))


def alnum(text):
    return ALNUM.findall((text or "").translate(LOWER))


def components(n, links):
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(i) for i in range(n)]


def similar_groups(rows, k, num, den):
    """{(doc_id, n_shingles, component_id)} as a sorted list of strings."""
    sets = []
    for _, t in rows:
        w = spaced(t)
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b]
             and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    root = components(len(rows), links)
    least = {}
    for r, (d, _) in zip(root, rows, strict=True):
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted(str((d, len(s), least.get(r))) for (d, _), s, r in zip(rows, sets, root, strict=True))


def kept_lines(rows):
    """{key: (n_lines, kept)} for rows of distinct keys."""
    seen, first, out = [], set(), {}
    for d, t in sorted(rows):
        kept = []
        lines = (t or "").split("\n")
        for n, line in enumerate(lines):
            s = frozenset(w for w in re.split("[ \t\x0b\f\r]+", line.lower()) if w)
            if not s or (s not in first and not any(9 * len(s & x) >= 4 * (len(s) + len(x)) for x in seen)):
                kept.append(n)
            if s and s not in first:
                first.add(s)
                seen.append(s)
        out[d] = (len(lines), kept)
    return out


def decontaminate(rows, items, window=10):
    """{doc_id: (n_words, n_hit, n_items, sha256)}."""
    found = collections.defaultdict(set)
    for i, t in items:
        w = alnum(t)
        m = min(window, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            found[tuple(w[k:k + m])].add(str(i))
    sizes = {len(k) for k in found}
    out = {}
    for d, t in rows:
        w, hit, ids = alnum(t), set(), set()
        for m in sizes:
            for k in range(len(w) - m + 1):
                if tuple(w[k:k + m]) in found:
                    hit.update(range(k, k + m))
                    ids |= found[tuple(w[k:k + m])]
        out[d] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest())
    return out


def nearest(rows, is_query, k):
    """[(query_id, rank, vec_id, score)] by brute force."""
    ok = [(i, np.array(v, np.float64)) for i, v in rows
          if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    out = []
    for q, x in sorted({i: v for i, v in reversed(ok)}.items()):
        if is_query(q):
            d = sorted((float(np.sqrt(((v - x) ** 2).sum())), i) for i, v in ok if i != q)
            out += [(q, r + 1, i, s) for r, (s, i) in enumerate(d[:k])]
    return out


def crc(data: bytes) -> int:
    return zlib.crc32(data)


def words(rng, n, vocabulary=2000):
    return " ".join(f"w{i}" for i in rng.integers(0, vocabulary, n))


def corpus(seed=0, n=120):
    """(doc_id, text) rows with exact and near copies, shared lines and passages, and odd cases."""
    rng = np.random.default_rng(seed)
    rows = [(i, "\n".join(words(rng, int(rng.integers(3, 60))) for _ in range(int(rng.integers(1, 6))))) for i in range(n)]
    passage = words(rng, 70)
    for i in range(0, 30):
        src = rows[int(rng.integers(0, 40))][1].split(" ")
        for _ in range(i % 4):
            src[int(rng.integers(0, len(src)))] = f"edit{rng.integers(0, 9)}"
        rows.append((n + i, " ".join(src)))
    for i in range(10):
        rows.append((n + 30 + i, f"{words(rng, 30)}\n{passage}\n{words(rng, 20)}"))
    rows += [(n + 50, None), (n + 51, ""), (n + 52, " \n\t\n"), (n + 53, "one"), (n + 54, "One two"), (n + 55, "one two"),
             (n + 56, "the " * 4000), (n + 57, words(rng, 6000)), (n + 58, "Ünï Çödé ÉCOLE   x")]
    return rows


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def merkle_leaf(row):
    """Digest of (doc_id, source, lang, n_chars, text)."""
    return _sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def _tree(digests, fanout):
    """Top, and each leaf's siblings and (left, right) steps up to it."""
    steps = [[] for _ in digests]
    level, owners = list(digests), [[i] for i in range(len(digests))]
    while len(level) > 1:
        above, above_owners = [], []
        for a in range(0, len(level), fanout):
            run = level[a:a + fanout]
            for s in range(len(run)):
                for leaf in owners[a + s]:
                    steps[leaf].append(("".join(run[:s]), "".join(run[s + 1:])))
            above.append(_sha("".join(run)))
            above_owners.append(sum(owners[a:a + fanout], []))
        level, owners = above, above_owners
    return level[0], steps


def merkle(rows, fanout=3):
    """Sorted contract rows for (doc_id, source, lang, n_chars, text) rows."""
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[1]].append((r, merkle_leaf(r)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subroots, out = [], []
    for s in names:
        groups[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        subroots.append(_tree([d for _, d in groups[s]], fanout))
    if not names:
        return []
    root, upper = _tree([t for t, _ in subroots], fanout)
    for s, (subroot, steps), more in zip(names, subroots, upper, strict=True):
        for (r, leaf), own in zip(groups[s], steps, strict=True):
            shown = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                shown = merkle_leaf((*r[:4], r[4].replace("\n", "")))
            for left, right in own + more:
                shown = _sha(left + shown + right)
            out.append((r[0], leaf, subroot, root, _sha("".join(a + b for a, b in own + more)), shown, shown == root))
    return sorted(out, key=str)


def trie(rows):
    """Sorted contract rows of the prefix trie for (conv_id, turn, role, text) rows."""
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn or 0), role, mark, text))
    turns = {c: [(r, t) for _, r, _, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(turns.get(c - c % 20, [])[:h] + turns[c][h:])
    members = collections.defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    kids = collections.defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)

    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        words = len(SPACED.findall(p[-1][1])) if p else 0
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in kids[p])
    return sorted([(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                    _sha(",".join(str(c) for c in sorted(m) if built[c] == p))) for p, m in members.items()], key=str)


PII = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"),
    "card": re.compile(r"[0-9](?:[\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def pii_base(text):
    """[(kind, start, end)] of the base patterns, by kind, then start."""
    out = []
    for kind, regex in PII.items():
        for m in regex.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                  "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


SPACE_RE = r"[ \t\n\x0b\f\r]"
NON_SPACE = r"[^ \t\n\x0b\f\r]"
COULD = {
    "email": rf"[^@ \t\n\x0b\f\r]+@[^@ \t\n\x0b\f\r]+",
    "ip": r"(?:[0-9a-f]{0,4}:){2,7}[0-9a-f]{0,4}|[0-9]{1,3}(?:[-_][0-9]{1,3}){3}",
    "card": r"[0-9](?:[ ./-]?[0-9]){11,18}",
    "phone": r"[(]?[0-9](?:[ ()./-]{0,3}[0-9]){6,14}",
}


def pii_spans(texts, support=5, confidence=0.8, score=0.8, rounds=4):
    """Per text all spans: the base ones and those that bootstrapped contexts add."""
    token = rf"(?={NON_SPACE}*[0-9@]){NON_SPACE}+"
    chunk = re.compile(rf"(?<!{NON_SPACE}){token}(?: {token})*")
    bases = [pii_base(t) for t in texts]
    places, seeds, held = [], {}, collections.defaultdict(set)
    for n, t in enumerate(texts):
        t, end = t or "", 0
        for m in chunk.finditer(t):
            before, after = t[end:m.start()][-80:], re.split(rf"(?<!{NON_SPACE}){token}", t[m.end():])[0][:80]
            end = m.end()
            lead = re.match(r"[^A-Za-z0-9+(]*(?:[A-Za-z_]+[:=])?[^A-Za-z0-9+(]*", m.group()).group()
            tail = re.search(r"[^A-Za-z0-9)]*$", m.group()).group()
            a, b = m.start() + len(lead), m.end() - len(tail)
            if a >= b:
                continue
            kinds = [k for k, s, e in bases[n] if (s, e) == (a, b)]
            if not kinds and any(s < b and a < e for _, s, e in bases[n]):
                continue
            word = t[a:b].lower()
            places.append((n, a, b, word, bool(kinds)))
            w, v = f"{before} {lead}".lower().split(), after.lower().split()
            names = [f"{w[-2]} {w[-1]} _"] if len(w) > 1 else []
            names += [f"{w[-1]} _ {v[0]}"] if w and v else []
            names += [f"{w[-1]} _"] if w and w[-1][-1] in ":=#" else []
            could = {k for k, r in COULD.items() if re.fullmatch(r, word)}
            if kinds or could or len(re.findall("[0-9]", word)) >= 4:
                for name in names:
                    held[name].add(word)
                if kinds and names:
                    seeds[word] = max(kinds)
    found = {}
    for _ in range(rounds):
        trusted = {}
        for name, words in held.items():
            for k in PII:
                mine = [1.0 if w in seeds else found[w][1] if w in found else 0.0 for w in words if (seeds.get(w) or found.get(w, [None])[0]) == k]
                rest = sum(1.0 if w in seeds else found[w][1] for w in words if (w in seeds or w in found) and (seeds.get(w) or found[w][0]) != k)
                odd = sum(1 for w in words if w not in seeds and w not in found and not re.fullmatch(COULD[k], w))
                if sum(mine) >= support - 1e-9 and sum(mine) / (sum(mine) + rest + odd + 1) >= confidence:
                    trusted[name] = (k, sum(mine) / (sum(mine) + rest + odd + 1))
        left = collections.defaultdict(lambda: 1.0)
        for name, (k, c) in trusted.items():
            for w in held[name]:
                if w not in seeds and re.fullmatch(COULD[k], w):
                    left[w, k] *= 1 - c
        now = {}
        for (w, k), miss in left.items():
            if 1 - miss >= score - 1e-9:
                now[w] = max(now.get(w, (0, "")), (1 - miss, k))
        now = {w: (k, s) for w, (s, k) in now.items()}
        same, found = len(now) == len(found), now
        if same:
            break
    order = list(PII)
    out = [list(b) for b in bases]
    for n, a, b, word, seed in places:
        if not seed and word in found:
            out[n].append((found[word][0], a, b))
    return [sorted(s, key=lambda x: (order.index(x[0]), x[1], x[2])) for s in out]
