"""Plain Python versions of ball codes, byte dedup and token alignment."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict


def ball_codes(rows, parts, entries, rounds, scale=1024):
    """rows: (key, vector). Returns (key, codes, error) in any order, and the codebooks."""
    kept = [(k, [math.floor(scale * x) for x in v]) for k, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], []
    size = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == size]
    width = size // parts
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    cuts = [cut(v) for _, v in kept]
    books = [[c[p] for c in cuts[:entries]] for p in range(parts)]
    apart = lambda x, e: sum((a - b) ** 2 for a, b in zip(x, e))
    nearest = lambda x, book: min((apart(x, e), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for c in cuts:
                own[nearest(c[p], books[p])[1]].append(c[p])
            books[p] = [[sum(col) // len(own[i]) for col in zip(*own[i])] if i in own else e for i, e in enumerate(books[p])]
    out = []
    for (k, _), c in zip(kept, cuts):
        near = [nearest(x, book) for x, book in zip(c, books)]
        out.append((k, [i for _, i in near], sum(d for d, _ in near)))
    return out, books


def without_earlier_bytes(rows, size=50):
    """rows: (key, text). For each (key, n_bytes, n_removed, n_spans, kept)."""
    first = {}
    for k, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - size + 1 if k is not None else 0):
            first[b[i : i + size]] = min(k, first.get(b[i : i + size], k))
    out = []
    for k, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1 if k is not None else 0):
            if first[b[i : i + size]] < k:
                gone[i : i + size] = b"\1" * size
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((k, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return out


def byte_values():
    """The bytes that characters of a byte-level vocabulary stand for."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def aligned(rows, bpe, pieces):
    """rows: (key, text). For each (key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)."""
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe)
    t.encode_special_tokens = True
    s = sentencepiece.SentencePieceProcessor(model_file=pieces)
    value = byte_values()
    a_bytes = {i: bytes(value[c] for c in x) for x, i in t.get_vocab(with_added_tokens=False).items()}

    def b_bytes(i):
        x = s.id_to_piece(i)
        return bytes([int(x[3:5], 16)]) if s.is_byte(i) else x.replace("▁", " ").encode()

    def places(parts):
        out, at = [], 0
        for x in parts:
            out.append((at, at + len(x)))
            at += len(x)
        return out

    done = []
    for key, text in rows:
        raw = (" " + (text or "")).encode()
        a = t.encode(" " + text, add_special_tokens=False).ids if text else []
        b = s.encode(text) if text else []
        if not text or b"".join(a_bytes[i] for i in a) != raw or b"".join(map(b_bytes, b)) != raw:
            done.append((key, [], [], [], ""))
            continue
        ra, rb = places(a_bytes[i] for i in a), places(b_bytes(i) for i in b)
        links, j = [], 0
        for (begin, end), i in zip(ra, a):
            while rb[j][1] <= begin:
                j += 1
            k = j
            while k < len(b) and rb[k][0] < end:
                links.append((i, b[k]))
                k += 1
        groups, ia, ib = [], 0, 0
        for end in sorted({e for _, e in ra} & {e for _, e in rb}):
            na = sum(1 for _, e in ra[ia : ia + 200] if e <= end)
            nb = sum(1 for _, e in rb[ib : ib + 200] if e <= end)
            groups.append(",".join(map(str, a[ia : ia + na])) + "|" + ",".join(map(str, b[ib : ib + nb])))
            ia, ib = ia + na, ib + nb
        done.append((key, a, b, links, ";".join(groups)))
    held = Counter(pair for r in done for pair in set(r[3]))
    best = defaultdict(int)
    for (i, _), n in held.items():
        best[i] = max(best[i], n)
    return [
        (key, len(a), len(b), g.count(";") + 1 if g else 0, len(links), sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links), hashlib.sha256(g.encode()).hexdigest() if g else "")
        for key, a, b, links, g in done
    ]
