"""Plain Python versions of the operators, for small tables."""

import math
import re
import zlib
from collections import Counter

import xxhash

BLANK = " \t\x0b\f\r"


def words(text):
    return (text or "").encode().lower().split()


def fingerprint(text):
    w = words(text)
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    """Least node reachable, for all pairs for which ``linked``."""
    label = {n: n for n in nodes}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def line_words(line):
    return tuple(re.split(f"[{BLANK}]+", line.lower().strip(BLANK)))


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def removed_lines(docs):
    """{doc_id: places of lines with an earlier equal or near one}."""
    lines = [(d, p, line_words(line)) for d, t in sorted(docs) for p, line in enumerate(t.split("\n"))]
    lines = [x for x in lines if len(x[2]) >= 5]
    out = {d: [] for d, _ in docs}
    for i, (d, p, w) in enumerate(lines):
        if any(one_edit(w, other) for _, _, other in lines[:i]):
            out[d].append(p)
    return out


def ngram_scores(docs, trigram, bigram, unigram):
    """{doc_id: (held_out, n_tokens, n_known, train_tokens, base, score)}."""
    rows = [(d, zlib.crc32(str(d).encode()) % 10 == 0, [*words(t), b""]) for d, t in docs]
    one, two, three, n = Counter(), Counter(), Counter(), 0
    for _, out, w in rows:
        if not out:
            n += 1
            x = [b" ", b" ", *w]
            one.update(w)
            two.update(zip(x[1:], x[2:]))
            three.update(zip(x, x[1:], x[2:]))
    total, different = sum(one.values()), len(one)
    context = one + Counter({b" ": n})
    two[b" ", b" "] = n

    def base(w):
        return (one[w] + 0.1) / (total + 0.1 * (different + 1))

    result = {}
    for d, out, w in rows:
        x = [b" ", b" ", *w]
        score = sum(
            math.log10(
                (trigram * three[u, v, t] + bigram * two[v, t] + unigram * base(t)) / (trigram * two[u, v] + bigram * context[v] + unigram)
            )
            for u, v, t in zip(x, x[1:], w)
        )
        result[d] = (out, len(w), sum(one[t] > 0 for t in w), total, sum(math.log10(base(t)) for t in w), score)
    return result
