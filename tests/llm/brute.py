"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def quality(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    count, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if count[x] > 1:
            covered.update(range(i, i + 8))
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "base_failed": len(w) < 20 or 100 * len(covered) > 30 * len(w)}


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def url_rule(url, rules):
    host, path = url_parts(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.key), default=None)


SECRETS = {
    "assign": re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                         re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def secrets(text):
    text, found = text or "", []
    for k, (kind, pattern) in enumerate(SECRETS.items()):
        for m in pattern.finditer(text):
            if len(m.group(2) if kind == "assign" else m.group()) >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                found.append((m.start(), k, m.end(), kind))
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(text):
    return zlib.crc32((text or "").encode())


def targets(sizes, weights=(5, 2, 1), repeats=3):
    """sizes: words by source. The excess over the cap is reshared by weight until none is above."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, target, capped = sum(sizes.values()), {}, set()
    while True:
        left = total - sum(repeats * sizes[s] for s in capped)
        free = sum(weight[s] for s in sizes if s not in capped)
        target = {s: repeats * sizes[s] if s in capped else left * weight[s] / free for s in sizes}
        more = {s for s in sizes if s not in capped and target[s] > repeats * sizes[s]}
        if not more:
            return target
        capped |= more


def components(n, links):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def shingles(text, k):
    w = words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near_components(ids, texts, k, percent):
    """Smallest id reachable through links of 100 * common >= percent * union."""
    order = sorted(range(len(ids)), key=lambda i: ids[i])
    sets = [shingles(texts[i], k) for i in order]
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    common = Counter()
    for found in where.values():
        for a in range(len(found)):
            for b in range(a):
                common[found[b], found[a]] += 1
    links = [p for p, n in common.items() if 100 * n >= percent * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    return {ids[order[i]]: (len(sets[i]), ids[order[r]]) for i, r in enumerate(components(len(sets), links))}


def repeats(texts, length):
    """Per text: its words, and which of them lie in a window of ``length`` words that starts anywhere else too."""
    split = [words(t) for t in texts]
    count = Counter(tuple(w[i:i + length]) for w in split for i in range(len(w) - length + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - length + 1):
            if count[tuple(w[i:i + length])] > 1:
                gone.update(range(i, i + length))
        out.append((w, gone))
    return out


# ---- the battery of randomness tests, in plain Python

COMMON, RARE = "etaoinsrhl", "bcdfgjkmpquvwxyz"
LETTER_CLASSES = [COMMON, RARE, COMMON.upper(), RARE.upper(), "0123456789", "+/-_"]
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = [DIGITS + "abcdef", DIGITS + "ABCDEF", UPPER + "234567", LOWER + DIGITS, UPPER + LOWER + DIGITS,
             UPPER + LOWER + DIGITS + "+/-_"]


def normal_tail(z):
    return 1 / (1 + math.exp(max(-80.0, min(80.0, z * 1.5976 + z ** 3 * 0.07056))))


def chi_tail(x, freedom):
    spread = 2 / (freedom * 9)
    return normal_tail((max(x, 1e-9) / freedom) ** (1 / 3) / math.sqrt(spread) - (1 - spread) / math.sqrt(spread))


def randomness(token):
    """The combined p-value of chi-squared (characters, classes), runs and serial correlation."""
    body = token.replace("=", "")
    letters = next(a for a in ALPHABETS if set(body) <= set(a))
    x, size, n = [letters.index(ch) for ch in body], len(letters), len(body)
    if n < 20:
        return 0.0
    even = chi_tail(sum(c * c for c in Counter(x).values()) * size / n - n, size - 1)
    classes = [(sum(ch in c for ch in body), sum(ch in c for ch in letters)) for c in LETTER_CLASSES]
    held = [(seen, of) for seen, of in classes if of]
    by_class = chi_tail(sum(seen * seen * size / of for seen, of in held) / n - n, len(held) - 1)
    high = [2 * v >= size for v in x]
    n_high, n_low = sum(high), n - sum(high)
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    product = 2 * n_high * n_low
    variance = max(product * (product - n) / (n * n * (n - 1)), 1e-9)
    runs_p = 2 ** (1 - n) if not n_high or not n_low else 2 * normal_tail(
        abs(runs - product / n - 1) / math.sqrt(variance))
    mean = sum(x) / n
    own = sum((v - mean) ** 2 for v in x)
    serial = sum((a - mean) * (b - mean) for a, b in zip(x, x[1:])) / own if own else 1.0
    serial_p = 2 * normal_tail(abs(serial) * math.sqrt(n))
    fisher = -2 * sum(math.log(max(p, 1e-40)) for p in (even, by_class, runs_p, serial_p))
    return max(chi_tail(fisher, 8), 1e-40)
