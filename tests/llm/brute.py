"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall((t or "").lower())


def shingles(t, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def components(sets, least=80, of=100):
    """{id: set} -> {id: smallest reachable id}."""
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        both = Counter(j for x in s for j in holders[x] if j > i)
        for j, n in both.items():
            if of * n >= least * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def bm25(docs, queries, k=10, k1=1.2, b=0.75):
    """{id: text}, ids -> {query: [(id, score)]}."""
    tf = {i: Counter(words(t)) for i, t in docs.items()}
    size = {i: sum(c.values()) for i, c in tf.items()}
    n, mean = len(docs), max(sum(size.values()) / max(len(docs), 1), 1e-9)
    df = Counter(w for c in tf.values() for w in c)
    out = {}
    for q in queries:
        scores = Counter()
        for w in tf[q]:
            idf = math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
            for i, c in tf.items():
                if w in c:
                    scores[i] += idf * c[w] * (k1 + 1) / (c[w] + k1 * (1 - b + b * size[i] / mean))
        out[q] = [(i, -s) for s, i in sorted((-round(s, 6), i) for i, s in scores.items())[:k]]
    return out


def tiling(doc, item, k):
    """Tokens of item in tiles, by trying every pair of places."""
    free_d, free_p = [True] * len(doc), [True] * len(item)
    covered = 0
    while True:
        best, found = k - 1, []
        for d in range(len(doc)):
            for p in range(len(item)):
                n = 0
                while d + n < len(doc) and p + n < len(item) and free_d[d + n] and free_p[p + n] and doc[d + n] == item[p + n]:
                    n += 1
                if n > best:
                    best, found = n, [(d, p)]
                elif n == best and n >= k:
                    found.append((d, p))
        if best < k:
            return covered
        for d, p in found:
            if all(free_d[d : d + best]) and all(free_p[p : p + best]):
                free_d[d : d + best] = free_p[p : p + best] = [False] * best
                covered += best


def nearest(examples, asked, k, docs=None, leave_out=False):
    """[(id, text, label)], [(id, text)] -> {asked id: [(example id, cosine)]} by TF-IDF over words and their first 5 and 7 bytes.

    idf from docs (else asked), times 1 + sqrt(G) for terms that lean to label 1, each distinct text once. Only positive cosines.
    leave_out: asked are examples too; each without itself and without the terms that it alone holds.
    """

    def terms(t):
        return Counter(x for w in words(t) for x in [w, *((n, w.encode()[:n].decode(errors="ignore")) for n in (5, 7) if len(w.encode()) >= n)])

    every = {i: terms(t) for i, t in asked}
    df, n_docs = Counter(x for _, t in docs or asked for x in terms(t)), len(docs or asked)
    once = {(t, y) for _, t, y in examples}
    n = [sum(y == label for _, y in once) for label in (0, 1)]
    held = [Counter(x for t, y in once if y == label for x in terms(t)) for label in (0, 1)]

    def telling(x):
        cells = [(held[y][x], n[y], sum(h[x] for h in held)) for y in (0, 1)]
        if cells[1][0] * n[0] <= cells[0][0] * n[1]:
            return 1.0
        pairs = [(seen, size * both / sum(n)) for a, size, all_ in cells for seen, both in ((a, all_), (size - a, sum(n) - all_))]
        return 1 + math.sqrt(max(0, 2 * sum(a * math.log(a / e) for a, e in pairs if a)))

    holders = Counter(x for _, t, _ in examples for x in terms(t))

    def vector(c, least=1):
        v = {x: (1 + math.log(k)) * (math.log((1 + n_docs) / (1 + df[x])) + 1) * telling(x) for x, k in c.items() if holders[x] >= least}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {x: w / size for x, w in v.items()}

    of = sorted((i, vector(terms(t))) for i, t, _ in examples)
    out = {}
    for i, c in every.items():
        v = vector(c, 2 if leave_out else 1)
        cosines = [(e, round(sum(w * x.get(t, 0) for t, w in v.items()), 8)) for e, x in of]
        out[i] = sorted((r for r in cosines if r[1] > 0 and not (leave_out and r[0] == i)), key=lambda r: (-r[1], r[0]))[:k]
    return out


def toxicity(docs, examples, k=25):
    """[(id, text)], [(id, text, label)] -> {id: score}: votes of the nearest, calibrated by isotonic regression (the max-min form)."""
    label = {i: y for i, _, y in examples}

    def vote(near):
        w = [(1 / (1.02 - min(max(c, 0), 1)), label[e]) for e, c in near]
        return sum(a * y for a, y in w) / sum(a for a, _ in w)

    out = nearest(examples, [(i, t) for i, t, _ in examples], k, docs=docs, leave_out=True)
    pairs = sorted(((vote(v), i, label[i]) for i, v in out.items() if v), key=lambda r: (r[0], r[1]))
    x, y = [p[0] for p in pairs], [p[2] for p in pairs]
    mean = lambda a, z: sum(y[a:z]) / (z - a)
    level = [max(min(mean(a, z) for z in range(i + 1, len(y) + 1)) for a in range(i + 1)) for i in range(len(y))]
    pools = [(g[0], g[-1] + 1) for _, g in ((v, [i for i, u in enumerate(level) if u == v]) for v in sorted(set(level)))]
    xs = [sum(x[a:z]) / (z - a) for a, z in pools]
    ys = [(sum(y[a:z]) + 0.5 * sum(y) / len(y)) / (z - a + 0.5) for a, z in pools]
    for i in range(1, len(ys)):
        ys[i] = max(ys[i], ys[i - 1])
    xs, ys = [0.0, *xs, 1.0], [ys[0] * 0.5, *ys, max(ys[-1], 0.999)]

    def calibrated(v):
        if v >= xs[-1]:
            return ys[-1]
        i = max(j for j in range(len(xs) - 1) if xs[j] <= v)
        return ys[i] + (ys[i + 1] - ys[i]) * (v - xs[i]) / (xs[i + 1] - xs[i]) if xs[i + 1] > xs[i] else ys[i + 1]

    prior = sum(label.values()) / len(label)
    return {i: min(max(0.98 * calibrated(vote(v)) + 0.02 * vote(v), 0), 1) if v else prior for i, v in nearest(examples, docs, k).items()}


def mix(docs, topics, u, temper, budget):
    """{id: (source, lang, text)} -> {kept id: (topic, tokens, probability, weight)}."""
    import numpy as np

    from vacatia.llm import mixing
    from vacatia.llm.common import SPACE, Words

    def place(w):
        raw = np.frombuffer(w.encode(), np.uint8)
        return int(mixing.features(Words(raw, np.array([0, len(raw)]), SPACE))[0])

    def topic(t, lang):
        c = Counter(place(w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        v = {x: (1 + math.log(k)) * topics.idf[x] for x, k in c.items()}
        size = max(math.sqrt(sum(x * x for x in v.values())), 1e-12)
        taken = topics.taken.get(lang, topics.taken[None])
        near = [round(sum(w * float(topics.centres[x, k]) for x, w in v.items()) / size - taken[k], 9) for k in range(topics.centres.shape[1])]
        return "topic" + str(near.index(max(near)) if c else 0), sum(c.values())

    rows = {}
    for i, (source, lang, text) in docs.items():
        source, lang = source or "(none)", lang or "(none)"
        rows[i] = (source, lang, *topic(text, lang))
    cells = Counter()
    for source, lang, name, n in rows.values():
        cells[source, lang, name] += n
    total = sum(cells.values())
    w = {c: n / total for c, n in cells.items()}
    for _ in range(200):
        off = 0
        for d, power in enumerate(temper.values()):
            of, now = Counter(), Counter()
            for c, n in cells.items():
                of[c[d]] += n
                now[c[d]] += w[c]
            whole = sum(t**power for t in of.values() if t)
            aim = {v: t**power / whole if t else 0 for v, t in of.items()}
            off = max(off, max(abs(now[v] - aim[v]) for v in of if now[v] > 0))
            w = {c: x * aim[c[d]] / now[c[d]] if now[c[d]] > 0 else 0 for c, x in w.items()}
        if off < 1e-9:
            break
    full, p = set(), {}
    while True:
        rest = budget * total - sum(cells[c] for c in full)
        scale = rest / sum(w[c] for c in cells if c not in full and w[c] > 0)
        p = {c: 1.0 if c in full else scale * w[c] / n if n else budget for c, n in cells.items()}
        over = {c for c, x in p.items() if x > 1 and c not in full}
        if not over:
            break
        full |= over
    expected = sum(p[c] * n for c, n in cells.items())
    out = {}
    for i, (source, lang, name, n) in rows.items():
        c = source, lang, name
        if u[i] < p[c]:
            out[i] = (name, n, p[c], w[c] * expected / (p[c] * cells[c]) if cells[c] else 0.0)
    return out


def languages(docs, lang_of, switch=14.0):
    """{id: text}, {id: lang} to learn from (all of them) -> {id: (lang, score)}: every word against every language, full Viterbi."""
    import unicodedata

    letter = lambda ch: unicodedata.category(ch)[0] == "L"
    word = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")

    def script(ch):
        from vacatia.llm.langid import SCRIPTS

        return [n for s, n in SCRIPTS if s <= ord(ch)][-1]

    def grams(w):
        raw = re.sub("[A-Z]", lambda m: m[0].lower(), w).encode()
        padded = b" " + raw + b" "
        return [((padded[i] << 16 | padded[i + 1] << 8 | padded[i + 2]) * 0x9E3779B1 & 0xFFFFFFFF) >> 16 for i in range(len(raw))]

    def parsed(t):
        out = []
        for w in word.findall(t or ""):
            of = Counter(script(ch) for ch in w if letter(ch))
            out.append((grams(w), sum(of.values()), of))
        return out

    langs = sorted(set(lang_of.values()))
    counts, scripts, texts = ({v: Counter() for v in langs} for _ in range(3))
    for i, v in lang_of.items():
        if docs[i] is None:
            continue
        texts[v]["n"] += 1
        for g, n, of in parsed(docs[i]):
            if n:
                counts[v].update(g)
                scripts[v].update(of)
    used = len({x for c in counts.values() for x in c})
    logs = {v: (c, sum(c.values()) + 0.2 * used) for v, c in counts.items()}
    fits = {v: {s for s, n in scripts[v].items() if n >= 0.01 * sum(scripts[v].values())} for v in langs}
    prior = [math.log((texts[v]["n"] + 1) / (sum(t["n"] for t in texts.values()) + len(langs))) for v in langs]
    out = {}
    names = sorted({n for _, n in __import__("vacatia.llm.langid", fromlist=["SCRIPTS"]).SCRIPTS})
    for i, t in docs.items():
        words = parsed(t)
        total = sum(n for _, n, _ in words)
        if not total:
            out[i] = ("und", 0.0)
            continue
        scores = []
        for g, n, of in words:
            if not n:
                scores.append([0.0] * (len(langs) + 1))
                continue
            own = max(names, key=lambda s: (of[s], -names.index(s)))
            raw = [sum(math.log((logs[v][0][x] + 0.2) / logs[v][1]) for x in g) for v in langs]
            top = max(raw)
            row = [max(r - top, -30.0) if own in fits[v] else -60.0 for v, r in zip(langs, raw, strict=True)]
            scores.append([*row, -60.0 if any(own in fits[v] for v in langs) else 0.0])
        start = [*prior, 0.0]
        v, back = [a + b for a, b in zip(scores[0], start, strict=True)], []
        for row in scores[1:]:
            top = v.index(max(v))
            back.append([k if v[k] >= v[top] - switch else top for k in range(len(v))])
            v = [max(x, v[top] - switch) + y for x, y in zip(v, row, strict=True)]
        path = [v.index(max(v))]
        for b in reversed(back):
            path.append(b[path[-1]])
        path.reverse()
        weight = [sum(n for (_, n, _), k in zip(words, path, strict=True) if k == x) for x in range(len(langs))]
        top = weight.index(max(weight))
        out[i] = (langs[top], weight[top] / total) if any(weight) else (langs[prior.index(max(prior))], 0.0)
    return out
