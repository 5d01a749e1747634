"""Token ids by the tokenizers library, remembered for the recurring pieces of a text.

A piece is a stretch of text whose ends are always ends of the pre-tokenizer's parts, so that encoding pieces one by one
gives the ids of the whole text: it ends before white space that follows something else, or where a letter meets ASCII
punctuation. Texts with other white space, or with a bar in angle brackets as special tokens have, are encoded whole.

A column is cut on its bytes, before white space only; Arrow finds its distinct stretches, and only those meet Python.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa

_LETTER = r"A-Za-zÀ-ÖØ-öø-ÿ"
_SIGN = r"!-/:-@\[-`{-~"
_BLANK = r" \t\r\n"
_CORE = f"(?:[{_LETTER}]++(?![^{_SIGN}{_BLANK}])|[{_SIGN}]++(?![^{_BLANK}])|[^{_BLANK}]++)"
_PIECES = re.compile(rf"[{_BLANK}]*+{_CORE}|[{_BLANK}]+\Z")
_PIECES_WITHOUT_BLANKS = re.compile(_CORE)
_ODD = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]")
_BLANK_BYTE = np.zeros(256, bool)
_BLANK_BYTE[[9, 10, 13, 32]] = True
_MAY_BE_ODD = np.zeros(256, bool)  # control characters, and the first bytes of the other white space; "<" of "<|"
_MAY_BE_ODD[[*range(9), 11, 12, *range(14, 32), 0x3C, 0x7F, 0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True


def _stretches(texts: pa.Array, blanks: bool) -> tuple[pa.Array, np.ndarray, set[int]]:
    """The texts cut before white space that follows something else, the number of stretches before each text and after
    the last, and the texts that are one stretch as they must be encoded whole. Without ``blanks`` the white space of all
    other texts is left out."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)
    low = int(offsets[0])
    bounds = offsets.astype(np.int64) - low
    size = int(bounds[-1])
    data = np.frombuffer(texts.buffers()[2], np.uint8)[low : low + size] if size else np.empty(0, np.uint8)
    blank = _BLANK_BYTE[data]
    cut = blank.copy()
    cut[1:] &= ~blank[:-1]
    whole = set()
    suspects = np.searchsorted(bounds, np.flatnonzero(_MAY_BE_ODD[data]), side="right") - 1
    for i in np.unique(suspects).tolist():
        text = texts[i].as_py()
        if "<|" in text or _ODD.search(text):
            whole.add(i)
            cut[bounds[i] : bounds[i + 1]] = False
    cut[bounds[:-1][bounds[:-1] < bounds[1:]]] = True  # empty texts have no stretch
    starts = np.flatnonzero(cut)
    before, ends = np.searchsorted(starts, bounds), np.append(starts, size)
    if not blanks:
        for i in whole:
            blank[bounds[i] : bounds[i + 1]] = False
        left = np.concatenate(([0], np.cumsum(~blank)))
        data, ends = data[~blank], left[ends]
    pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data))
    return pieces, before, whole


class TextEncoder:
    """Little-endian unsigned 32-bit ids of texts. Remembers the first ``limit`` pieces, among them all common ones."""

    def __init__(self, path: str, limit: int = 800_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._limit = limit
        self._known: dict[str, bytes] = {}
        # A tokenizer that drops white space gives a piece the same ids with and without it.
        one, two = (self._tokenizer.encode(x, add_special_tokens=False).ids for x in ("a", "a a"))
        self._blanks = two != 2 * one
        self._split = (_PIECES if self._blanks else _PIECES_WITHOUT_BLANKS).findall
        self._joined: dict[str, bytes] = {}  # stretches of several pieces

    def _encode(self, texts: list[str]) -> list[bytes]:
        done = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in done]

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if "<|" in text or _ODD.search(text):
            return self._encode([text])[0]
        pieces, known = self._split(text), self._known
        try:
            return b"".join(map(known.__getitem__, pieces))
        except KeyError:
            new = list(set(pieces).difference(known))
            ids = dict(zip(new, self._encode(new), strict=True))
            if len(known) < self._limit:
                known.update(ids)
                return b"".join(map(known.__getitem__, pieces))
            return b"".join([known.get(p) or ids.get(p, b"") for p in pieces])

    def _learnt(self, stretches: list[str]) -> list[bytes]:
        """Ids of stretches without other white space, by their pieces."""
        known, joined, split = self._known, self._joined, self._split
        out = list(map(known.get, stretches))
        # One flat list: many small ones would be walked by the garbage collector again and again.
        missing, pieces, counts = [], [], []
        for i, x in enumerate(out):
            if x is None:
                out[i] = joined.get(stretches[i])
                if out[i] is None:
                    some = split(stretches[i])
                    missing.append(i)
                    pieces.extend(some)
                    counts.append(len(some))
        new = list(set(pieces).difference(known))
        ids = dict(zip(new, self._encode(new), strict=True))
        if len(known) < self._limit:
            known.update(ids)
        remember, at = len(joined) < self._limit // 4, 0
        for i, n in zip(missing, counts, strict=True):
            out[i] = b"".join([ids[p] if p in ids else known[p] for p in pieces[at : at + n]])
            if remember and n > 1:
                joined[stretches[i]] = out[i]
            at += n
        return out

    def column(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts behind each other, each text with ``end_id`` at its end, and the bounds of the texts."""
        if not pa.types.is_string(texts.type):
            texts = texts.cast(pa.string())
        if texts.null_count:
            texts = texts.fill_null("")
        if not len(texts):
            return np.empty(0, np.uint32), np.zeros(1, np.int64)
        stretches, before, whole = _stretches(texts, self._blanks)
        coded = stretches.dictionary_encode()
        values, which = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        if whole:
            special = {int(which[before[i]]) for i in whole}
            plain = [k for k in range(len(values)) if k not in special]
            known = dict(zip(plain, self._learnt([values[k] for k in plain]), strict=True))
            ids = [known[k] if k in known else self._encode([v])[0] for k, v in enumerate(values)]
        else:
            ids = self._learnt(values)
        # The end is one more stretch of each text.
        which = np.insert(which.astype(np.int64), before[1:], len(ids))
        ids.append(np.asarray([end_id], "<u4").tobytes())
        sizes = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
        first = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(ids), "<u4")
        lengths = sizes[which]
        ends = np.cumsum(lengths)
        out = flat[np.arange(int(ends[-1])) + np.repeat(first[which] - (ends - lengths), lengths)]
        texts_end = ends[before[1:] + np.arange(len(texts))]
        return out, np.concatenate(([0], texts_end))


_ENCODERS: dict[tuple[str, int], TextEncoder] = {}


def encoder(path: str, limit: int = 800_000) -> TextEncoder:
    """The encoder of a vocabulary file; a Python worker keeps it over its tasks."""
    if (path, limit) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, limit] = TextEncoder(path, limit)
    return _ENCODERS[path, limit]
