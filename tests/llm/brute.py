"""Plain Python versions of the text operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from functools import lru_cache

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(text or "")


def tokens(text):
    return TOKEN.findall((text or "").translate(UPPER))


def shingles(text, k):
    w = words((text or "").translate(UPPER))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def components(docs, k):
    """(key, text) rows to {row: smallest key reachable}; rows with null keys stay alone."""
    sets = [shingles(t, k) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and docs[i][0] is not None and docs[j][0] is not None:
                common = len(a & b)
                if 100 * common >= 80 * (len(a) + len(b) - common):
                    root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(docs):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [least.get(find(i)) for i in range(len(docs))]


def without_windows(docs, size):
    seen = Counter(tuple(w[i : i + size]) for _, t in docs for w in [words(t)] for i in range(len(w) - size + 1))
    out = []
    for _, text in docs:
        w = words(text)
        gone = {j for i in range(len(w) - size + 1) if seen[tuple(w[i : i + size])] > 1 for j in range(i, i + size)}
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def benchmark_hits(docs, items, size=10):
    phrases = defaultdict(set)
    for item, text in items:
        w = tokens(text)
        for i in range(max(len(w) - size + 1, 1 if w else 0)):
            phrases[tuple(w[i : i + size])].add(str(item))
    lengths = {len(p) for p in phrases}
    out = []
    for _, text in docs:
        w, hit, found = tokens(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (p := tuple(w[i : i + n])) in phrases:
                    hit.update(range(i, i + n))
                    found |= phrases[p]
        out.append((len(w), len(hit), sorted(found)))
    return out


def viterbi(token: bytes, scores):
    @lru_cache(None)
    def best(end):
        if not end:
            return 0.0, 0
        ways = [(best(i)[0] + scores[token[i:end]], best(i)[1] - 1) for i in range(end) if token[i:end] in scores]
        return max(ways)

    return -best(len(token))[1]


def line_fails(line):
    w = words(line)
    n = len(w)
    if not n:
        return False
    phrases = (
        "accept all cookies|all rights reserved|back to top|click here to|cookie policy|cookie settings|enable javascript|follow us on|"
        "forgot your password|log in to|lorem ipsum|privacy policy|share this|sign up for|skip to content|subscribe to our|"
        "terms of service|terms of use|this site uses cookies"
    ).split("|")
    low = line.translate(UPPER)
    in_phrases = sum(len(p.split()) for p in phrases if re.search(rf"(?<!\w){p}(?!\w)", low))
    marks = len(re.findall("!!+", line))
    separators = sum(x in "| / > < » › · • - – —".split() for x in w)
    return (
        (n > 10 and not re.search("[.!?:;…。！？．：；।॥։՞՜؟۔؛።፧፨။།]", line))
        or (marks >= 2 and marks * 4 >= n)
        or len(re.findall(r"[#*$%&|<>{}=~^_]", line)) * 10 > len(line)
        or (separators >= 3 and separators * 6 >= n)
        or (n >= 10 and sum(a == b for a, b in zip(w, w[1:])) * 2 >= n)
        or (len(line) <= 300 and in_phrases > 0 and in_phrases * 3 >= n)
    )


def cleaned(text):
    """The text without failed lines, or None if the document is rejected."""
    w = words(text)
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    again = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    if len(w) < 20 or 100 * len(again) > 30 * len(w):
        return None
    lines = text.split("\n")
    chars = lambda some: sum(len(x) for line in some for x in words(line))
    if chars(filter(line_fails, lines)) * 100 > 50 * chars(lines):
        return None
    return "\n".join(line for line in lines if not line_fails(line))


def longest_ascending(values):
    """Indices of the longest ascending run whose end, and then each one before, is smallest."""
    length = []
    for i, v in enumerate(values):
        length.append(1 + max((length[j] for j in range(i) if values[j] < v), default=0))
    run, upto, below = [], len(values), float("inf")
    for n in range(max(length, default=0), 0, -1):
        i = min((i for i in range(upto) if length[i] == n and values[i] < below), key=lambda i: values[i])
        run.append(i)
        upto, below = i, values[i]
    return run[::-1]


def heaviest(a, b):
    """The common block with most characters, the first to end in `a`; where it first stands in `b`."""
    best = (0, 0, 0, 0)
    for end in range(1, len(a) + 1):
        n = next((n for n in range(end, 0, -1) if any(b[j : j + n] == a[end - n : end] for j in range(len(b) - n + 1))), 0)
        chars = sum(map(len, a[end - n : end]))
        if chars > best[3]:
            best = (end - n, next(j for j in range(len(b)) if b[j : j + n] == a[end - n : end]), n, chars)
    return best


def aligned_lines(a, b, least):
    """Pairs of positions by the definition: equal ends, then unique lines in order, else the heaviest block."""
    front = 0
    while front < min(len(a), len(b)) and a[front] == b[front]:
        front += 1
    if front:
        return [(i, i) for i in range(front)] + [(front + i, front + j) for i, j in aligned_lines(a[front:], b[front:], least)]
    if a and b and a[-1] == b[-1]:
        return [*aligned_lines(a[:-1], b[:-1], least), (len(a) - 1, len(b) - 1)]
    in_a, in_b = Counter(a), Counter(b)
    unique = [(a.index(line), j) for j, line in enumerate(b) if in_b[line] == 1 == in_a[line]]
    anchors = [unique[i] for i in longest_ascending([i for i, _ in unique])]
    if anchors:
        out, before = [], (-1, -1)
        for i, j in [*anchors, (len(a), len(b))]:
            p, q = before[0] + 1, before[1] + 1
            out += [(p + x, q + y) for x, y in aligned_lines(a[p:i], b[q:j], least)] + [(i, j)]
            before = (i, j)
        return out[:-1]
    i, j, n, chars = heaviest(a, b)
    if not n or chars < least:
        return []
    rest = aligned_lines(a[i + n :], b[j + n :], least)
    return aligned_lines(a[:i], b[:j], least) + [(i + k, j + k) for k in range(n)] + [(i + n + x, j + n + y) for x, y in rest]


def lines_removed(docs, min_chars=60):
    """docs: (key, text) with different keys. For each the text left."""
    lines = {k: [line.strip(" \t\n\x0b\f\r") for line in t.split("\n")] for k, t in docs}

    def runs(ls):
        """From every line that is not blank, on and back, the fewest lines that have the characters."""
        for i, line in enumerate(ls):
            for rest, back in ((ls[i:], False), (ls[i::-1], True)):
                total = 0
                for n, x in enumerate(rest if line else [], 1):
                    total += len(x)
                    if total >= min_chars:
                        yield tuple(rest[:n][::-1] if back else rest[:n])
                        break

    first = {}
    for k in sorted(lines):
        for run in runs(lines[k]):
            first.setdefault(run, k)
    out = {}
    for k, text in docs:
        gone = set()
        for p in {first[run] for run in runs(lines[k])} - {k}:
            block = []
            for i, j in [*aligned_lines(lines[p], lines[k], min_chars), (-1, -1)]:
                if block and (i, j) != (block[-1][0] + 1, block[-1][1] + 1):
                    if sum(len(lines[k][q]) for _, q in block) >= min_chars:
                        gone |= {q for _, q in block}
                    block = []
                block.append((i, j))
        out[k] = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def zipf(pieces):
    total = math.log(sum(1 / (r + 1) for r in range(len(pieces))))
    return {p: -math.log(r + 1) - total for r, p in enumerate(pieces)}
