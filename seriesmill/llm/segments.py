"""Texts cut at single spaces into segments that tokenise independently, each distinct one once.

In the pre-tokenising pattern of the byte-level vocabularies a single space between two other
characters always begins a new piece. So a text may be cut before every such space, its segments
encoded apart, and the ids joined. Words repeat, so an Arrow batch is dictionary-encoded first and
only segments not met before in this worker are encoded.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space beside a space, or a space at either end: such texts are cut by the slower pattern.
_WHITE = "\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
_IRREGULAR = f"^ | $|[{_WHITE}] | [{_WHITE}]"
_CUT = re.compile(r"(?<=\S) (?=\S)")
# Segments kept per generation of the cache; the older of two generations is dropped.
CACHED = 450_000
MARKS = tuple(".,!?;:")
# Byte-level vocabularies write a byte as its Latin-1 character if that is printable, else as the next from 256 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHARS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
SPACE_CHAR = chr(BYTE_CHARS[0x20])


class Distinct:
    """The segments of some texts: distinct keys, the code of every segment, segments per text."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, _IRREGULAR)
        if pc.any(odd).as_py():
            cut = [_CUT.split(t) if o else t.split(" ") for t, o in zip(texts.to_pylist(), odd.to_pylist())]
            lists = pa.array(cut, pa.large_list(pa.large_string()))
        else:
            lists = pc.split_pattern(texts, pattern=" ")
        self.offsets = np.asarray(lists.offsets, dtype=np.int64) - lists.offsets[0].as_py() if len(lists) else np.zeros(1, np.int64)
        words = lists.flatten().dictionary_encode() if len(lists) else pa.array([], pa.large_string()).dictionary_encode()
        self.codes = np.asarray(words.indices, dtype=np.int64).copy()
        # Keys of segments: the string stands for itself after a space, a tuple of it for the first of a text.
        self.keys = words.dictionary.to_pylist()
        firsts, n = self.offsets[:-1], len(self.keys)
        self.keys += [(self.keys[c],) for c in self.codes[firsts]]
        self.codes[firsts] = n + np.arange(len(firsts))


def segment_text(key: str | tuple[str]) -> str:
    return " " + key if isinstance(key, str) else key[0]


class Cache:
    """Values by segment, in two generations so that memory stays bounded."""

    def __init__(self, make: Callable[[list[str]], Sequence], most: int = CACHED):
        self.make, self.most = make, most
        self.young: dict = {}
        self.old: dict = {}

    def values(self, keys: list) -> list:
        young, old = self.young, self.old
        out = list(map(young.get, keys))
        absent = [i for i, v in enumerate(out) if v is None]
        if absent:
            new = {}
            for i in absent:
                k = keys[i]
                if (v := old.get(k)) is None:
                    new[k] = None
                else:
                    young[k] = v
            if new:
                young.update(zip(new, self.make(list(new))))
            for i in absent:
                out[i] = young[keys[i]]
        if len(young) > self.most:
            self.old, self.young = young, {}
        return out

    def get(self, key):
        found = self.young.get(key)
        return self.old.get(key) if found is None else found


class Encoder:
    """Ids by the tokenizers library and the given vocabulary file, special strings as ordinary text."""

    def __init__(self, path: str, cached: int = CACHED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.model = self.tokenizer.model
        self.cache = Cache(self._encode, cached)
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.marks = dict(zip(MARKS, self._full(list(MARKS))))

    def _full(self, strings: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]

    def _word(self, word: str) -> bytes:
        """A space and letters are one piece, which needs no pre-tokenising: the library's model takes it as it is."""
        piece = SPACE_CHAR + (word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_CHARS))
        return array(self.code, [t.id for t in self.model.tokenize(piece)]).tobytes()

    def _encode(self, keys: list) -> list[bytes]:
        """Words of Latin letters, with a closing mark or without, go to the model, all else the full way.

        The mark is a piece of its own, so a word's ids serve for all marks.
        """
        out, rest, young, old, marks = [None] * len(keys), [], self.cache.young, self.cache.old, self.marks
        for i, k in enumerate(keys):
            if k.__class__ is str:
                mark = marks.get(k[-1:])
                word = k if mark is None else k[:-1]
                if word.isalpha() and (word.isascii() or max(word) < "ɐ"):
                    ids = young.get(word) or old.get(word)
                    if ids is None:
                        ids = young[word] = self._word(word)
                    out[i] = ids if mark is None else ids + mark
                    continue
            rest.append(i)
        for i, ids in zip(rest, self._full([segment_text(keys[i]) for i in rest])):
            out[i] = ids
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and where each text begins (one more entry than texts)."""
        parts = Distinct(texts)
        values = self.cache.values(parts.keys)
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // self.dtype.itemsize
        flat = np.frombuffer(b"".join(values), self.dtype)
        begins = np.cumsum(sizes) - sizes
        each = sizes[parts.codes]
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(ends) else 0
        index = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
        ids = flat[np.repeat((begins[parts.codes] - (ends - each)).astype(index), each) + np.arange(total, dtype=index)]
        return ids, np.concatenate([[0], ends])[parts.offsets] if len(ends) else np.zeros(1, np.int64)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary file, so later tasks find its cache."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def slices(batch: pa.RecordBatch, most_bytes: int = 12 << 20):
    """A batch in parts of about that many bytes, at least one row each; texts are never cut.

    Parts are copies: string kernels of Arrow (`ascii_lower`) go wrong on arrays with an offset.
    """
    rows = max(1, int(len(batch) * most_bytes / max(batch.nbytes, 1)))
    if rows >= len(batch):
        yield batch
        return
    for at in range(0, len(batch), rows):
        yield batch.take(pa.array(np.arange(at, min(at + rows, len(batch)))))
