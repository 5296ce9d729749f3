"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def contamination(docs, items, n=13):
    grams = defaultdict(set)
    for i, t in items:
        w = LOW_WORD.findall(lower(t))
        k = min(n, len(w))
        for j in range(len(w) - k + 1 if w else 0):
            grams[tuple(w[j : j + k])].add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w = LOW_WORD.findall(lower(t))
        hit, found = set(), set()
        for k in {len(g) for g in grams}:
            for j in range(len(w) - k + 1):
                if g := grams.get(tuple(w[j : j + k])):
                    found |= g
                    hit.update(range(j, j + k))
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def quality(t):
    w = SPACE_WORD.findall(t or "")
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 5)}
    lines = [x for x in (t or "").split("\n") if SPACE_WORD.search(x)]
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n


def link_components(docs, k, numer, denom):
    sets = []
    for _, t in docs:
        w = SPACE_WORD.findall(lower(t))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    up = list(range(len(docs)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and denom * both >= numer * (len(a) + len(sets[j]) - both):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(docs)]


def secrets(t):
    t = t or ""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return [sum(f[1] == k for f in found) for k in range(3)], sha(",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found)))


def substrings(docs, window=50):
    toks = [(d, SPACE_WORD.findall(t or "")) for d, t in docs]
    big = 1 << 62
    first = {}
    for d, w in toks:
        for j in range(len(w) - window + 1):
            g = tuple(w[j : j + window])
            first[g] = min(first.get(g, big), big if d is None else d)
    out = []
    for d, w in toks:
        gone = set()
        for j in range(len(w) - window + 1):
            if first[tuple(w[j : j + window])] < (big if d is None else d):
                gone.update(range(j, j + window))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def outliers(docs, cutoff=18.467, support=0.75, prior=40.0, factor=1.4863):
    """Squared distances for (doc_id, text, lang, source): the subset of smallest determinant, by trying
    all subsets of small groups, else by concentration from many random starts; None without statistics."""
    import itertools

    import numpy as np

    floors = np.diag((np.array([0.05, 0.06, 0.06, 0.12]) * 1024) ** 2)
    stats, groups = {}, defaultdict(list)
    for i, (_, t, lang, source) in enumerate(docs):
        n, chars, symbols, dup, rep, failed = quality(t)
        if not failed:
            v = [np.log((chars + 150) / (n + 30)), (symbols / chars) ** 0.5, (dup / n) ** 0.5, (rep / n) ** 0.5]
            stats[i] = np.round(np.array(v) * 1024)
            groups[lang, source].append(i)

    def of(x):
        d = x - x.mean(0)
        return x.mean(0), factor * d.T @ d / len(x) + floors

    def far(x, est):
        d = x - est[0]
        return np.einsum("ij,jk,ik->i", d, np.linalg.inv(est[1]), d)

    def estimate(x):
        h = int(np.ceil(len(x) * support))
        if len(x) <= 12:
            tries = [of(x[list(c)]) for c in itertools.combinations(range(len(x)), h)]
        else:
            rng, tries = np.random.default_rng(0), []
            for _ in range(40):
                est = of(x[rng.permutation(len(x))[: max(2, len(x) // 2)]])
                for _ in range(12):
                    est = of(x[np.argsort(far(x, est), kind="stable")[:h]])
                tries.append(est)
        return min(tries, key=lambda e: np.linalg.det(e[1]))

    out = [None] * len(docs)
    if stats:
        whole = estimate(np.array(list(stats.values())))
        for members in groups.values():
            x = np.array([stats[i] for i in members])
            own, share = estimate(x), len(x) / (len(x) + prior)
            for i, v in zip(members, far(x, [share * a + (1 - share) * b for a, b in zip(own, whole)])):
                out[i] = float(v)
    return out
