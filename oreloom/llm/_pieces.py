"""Token ids of many whole texts at once, each distinct piece of them encoded once.

Which pieces are right depends on the tokenizer file: its normalizer and pre-tokenizer are compared with the two kinds known
here, and texts of any other file are encoded one by one by the tokenizers library.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

from ._text import LOWER

#: The published pre-token pattern of byte-level BPE (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The published pre-token pattern of word BPE in lower case without white space (fixed value).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Distinct pieces whose ids a worker keeps.
_CACHE_PIECES = 200_000
_ENCODERS: dict[tuple[str, bool], TextEncoder] = {}
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4

#: Of bytes: 0 part of a non-ASCII character or a control, 1 white space, 2 letter or digit, 3 apostrophe, 4 other punctuation.
KIND = np.zeros(256, dtype=np.uint8)
KIND[0x21:0x7F] = 4
KIND[[0x20, *range(0x09, 0x0E)]] = 1
KIND[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = 2
KIND[0x27] = 3


def _byte_letters() -> dict[int, str]:
    """The published byte alphabet of byte-level BPE: printable bytes stand for themselves, the others for U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(0x100 + k) for k, b in enumerate(other)}


BYTE_LETTERS = _byte_letters()


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of every code point, by the classes of the pattern."""
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    at = np.frombuffer(every.encode("utf-32-le"), np.uint32)
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, own in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(own, every):
            out[at[m.start() : m.end()]] = kind
    return out


def pretoken_starts(code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of some texts begin, from their code points and the place where each text begins.

    What PATTERN does, at once: a run of one class is a pre-token; of a run of white space before something else the last
    character stands apart, and a last space goes with what follows; a contraction ends where it ends.
    """
    n = len(code)
    if not n:
        return np.zeros(0, np.int64)
    kind = _classes()[code]
    fresh = np.zeros(n, bool)
    fresh[first[first < n]] = True
    begin = fresh.copy()
    begin[1:] |= kind[1:] != kind[:-1]
    space, blank = kind == SPACE, code == 0x20
    turn = np.flatnonzero(space[:-1] & ~space[1:] & ~fresh[1:])  # the last white space of a run before something else
    begin[turn] = True
    begin[turn[blank[turn]] + 1] = False
    mark = np.flatnonzero(code == 0x27)
    mark = mark[begin[mark]]  # a quote that goes with what precedes begins nothing
    if len(mark):
        def at(k: int) -> np.ndarray:
            p = mark + k
            own = p < n
            out = np.zeros(len(mark), np.uint32)
            out[own] = code[p[own]]
            return out

        a, b = at(1), at(2)
        cut = lambda k: (mark + k >= n) | fresh[np.minimum(mark + k, n - 1)]
        one, two = ~cut(1), ~cut(1) & ~cut(2)
        letter = lambda x, which: np.isin(x, np.array([ord(c) for c in which], np.uint32))
        length = np.where(one & letter(a, "stmd"), 2, np.where(two & (((a == 0x72) | (a == 0x76)) & (b == 0x65) | (a == 0x6C) & (b == 0x6C)), 3, 0))
        p, length = mark[length > 0], length[length > 0]
        begin[p + 1] = False
        stop = p + length
        begin[stop[stop < n]] = True
    return np.flatnonzero(begin)


def code_points(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Code points of UTF-8 texts, the places of texts in them, and the byte of every one (None: the same place)."""
    if not len(data) or data.max() < 0x80:
        return data, at, None
    place = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32), np.searchsorted(place, at), place


class TextEncoder:
    """Encodes whole texts with a tokenizer, as its library does; this class one by one, its heirs piece by piece.

    ``special``: the strings of special tokens in a text become these tokens, as the library has it; else they are text.
    """

    def __init__(self, tokenizer, special: bool = True):
        self.tokenizer = tokenizer
        self.tokenizer.encode_special_tokens = not special
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = 2 if self.size <= 1 << 16 else 4
        self.special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()] if special else []
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.first = np.zeros(1 << 14, dtype=np.int64)  # the ids of piece k: flat[first[k] : first[k + 1]]

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each text)"""
        raw = data.tobytes()
        coded = [e.ids for e in self.tokenizer.encode_batch_fast([raw[a:b].decode() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], add_special_tokens=False)]
        return np.fromiter((i for ids in coded for i in ids), np.uint32), np.array([len(x) for x in coded], np.int64)

    def _keep(self, pieces: list[bytes], ids: list[int], sizes: list[int]) -> None:
        n, begin = len(self.known), int(self.first[len(self.known)])
        ends = begin + np.cumsum(sizes)
        for name, need in (("flat", int(ends[-1])), ("first", n + len(pieces) + 1)):
            own = getattr(self, name)
            if need > len(own):
                setattr(self, name, np.concatenate([own, np.zeros(max(need - len(own), len(own)), own.dtype)]))
        self.flat[begin : int(ends[-1])] = ids
        self.first[n + 1 : n + 1 + len(pieces)] = ends
        self.known.update(zip(pieces, range(n, n + len(pieces)), strict=True))

    def _pieces(self, data: np.ndarray, starts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As encode(), of texts cut into pieces at ``starts`` (bytes)."""
        offsets = np.append(starts, len(data)).astype(np.int64)
        runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        distinct = runs.dictionary.to_pylist()
        if len(self.known) > _CACHE_PIECES:
            self.clear()
        known = self.known
        new = [r for r in distinct if r not in known]
        if new:
            self._learn(new)
        code = np.fromiter(map(known.__getitem__, distinct), dtype=np.int64, count=len(distinct))[runs.indices.to_numpy()]
        each = self.first[code + 1] - self.first[code]
        before = np.concatenate(([0], np.cumsum(each)))
        step = np.repeat(self.first[code] - before[:-1], each)
        step += np.arange(len(step))
        return self.flat[step], np.diff(before[np.searchsorted(starts, at)])


class ByteEncoder(TextEncoder):
    """For byte-level BPE that cuts by PATTERN and changes no text before: a pre-token is a piece."""

    def _learn(self, pieces: list[bytes]) -> None:
        tokenize = self.tokenizer.model.tokenize  # a pre-token in the byte alphabet is what the model sees
        coded = [[t.id for t in tokenize(p.decode("latin-1").translate(BYTE_LETTERS))] for p in pieces]
        self._keep(pieces, [i for ids in coded for i in ids], list(map(len, coded)))

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.special and any(x in LOWER[data].tobytes() for x in self.special):
            return super().encode(data, at)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(at) - 1, np.int64)
        code, chars_at, place = code_points(data, at)
        starts = pretoken_starts(code, chars_at[:-1])
        return self._pieces(data, starts if place is None else place[starts], at)


class WordEncoder(TextEncoder):
    """For BPE that lower-cases, drops white space and cuts by WORD_PATTERN.

    Pieces are cut behind ASCII white space, between an ASCII letter or digit and ASCII punctuation, and between
    punctuation other than the apostrophe and a letter or digit: all of these are pre-token boundaries. Texts that hold
    the string of a special token are cut behind white space only. Pieces are encoded by the tokenizers library, many
    in one call with a special token between them that none of them holds.
    """

    def __init__(self, tokenizer, special: bool = True):
        super().__init__(tokenizer, special)
        marks = [(t.content, i) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        self.mark, self.mark_id = marks[0] if marks else ("", -1)

    def _learn(self, runs: list[bytes]) -> None:
        """Pieces of lower-case Latin letters, all below U+0250 and so stable under NFC, are one pre-token, which the
        model encodes directly in the byte alphabet; the others take the whole way."""
        words, other, mixed, mark = [], [], [], self.mark.encode()
        flat: list[int] = []
        sizes: list[int] = []
        tokenize = self.tokenizer.model.tokenize
        for r in runs:
            w = r.rstrip()
            if w.isalpha() and w.islower():
                text = w.decode()
            elif not w.isascii() and (text := w.decode()).isalpha() and text.islower() and max(text) < "\u0250" and text == text.lower():
                text = w.decode("latin-1").translate(BYTE_LETTERS)
            else:
                text = ""
            if text:
                ids = [t.id for t in tokenize(text)]
                words.append(r)
                flat += ids
                sizes.append(len(ids))
            elif mark and mark not in r:
                other.append(r)
            else:
                mixed.append(r)
        groups = [b"".join(x for r in other[i : i + 512] for x in (r, mark)).decode() for i in range(0, len(other), 512)]
        for e in self.tokenizer.encode_batch_fast(groups, add_special_tokens=False):
            ids = np.array(e.ids, dtype=np.uint32)
            at = np.flatnonzero(ids == self.mark_id)
            sizes += (np.diff(at, prepend=-1) - 1).tolist()
            flat += np.delete(ids, at).tolist()
        for e in self.tokenizer.encode_batch_fast([r.decode() for r in mixed], add_special_tokens=False):
            flat += e.ids
            sizes.append(len(e.ids))
        self._keep([*words, *other, *mixed], flat, sizes)

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = LOWER[data]
        kind = KIND[low]
        begin = np.ones(len(data), dtype=bool)
        begin[1:] = (kind[:-1] == 1) & (kind[1:] != 1)
        raw = low.tobytes()
        if not any(x in raw for x in self.special):
            data = np.where(kind == 1, np.uint8(0x20), low)
            begin[1:] |= (kind[:-1] == 2) & (kind[1:] >= 3)
            begin[1:] |= (kind[:-1] == 4) & (kind[1:] == 2)
        begin[at[:-1][at[:-1] < len(data)]] = True
        return self._pieces(data, np.flatnonzero(begin), at)


def _settings(part) -> dict:
    return json.loads(part.__getstate__()) if part is not None else {}


def kind_of(tokenizer) -> type[TextEncoder]:
    """The class that is right for the settings of a tokenizer."""
    model, norm, cut = tokenizer.model, _settings(tokenizer.normalizer), _settings(tokenizer.pre_tokenizer)
    plain = type(model).__name__ == "BPE" and not any((model.dropout, model.unk_token, model.continuing_subword_prefix, model.fuse_unk, model.byte_fallback, model.ignore_merges, tokenizer.truncation, tokenizer.padding))
    if plain and not norm and not model.end_of_word_suffix and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True):
        return ByteEncoder
    steps, cuts = norm.get("normalizers") or [], cut.get("pretokenizers") or []
    lower = [s.get("type") for s in steps] == ["NFC", "Replace", "Lowercase"] and steps[1].get("pattern") == {"Regex": r"\s+"} and steps[1].get("content") == " "
    words = [c.get("type") for c in cuts] == ["Split", "ByteLevel"] and cuts[0].get("pattern") == {"Regex": WORD_PATTERN} and cuts[0].get("behavior") == "Removed" and cuts[0].get("invert") and not cuts[1].get("add_prefix_space") and not cuts[1].get("use_regex", True)
    return WordEncoder if plain and lower and words else TextEncoder


def encoder(file: str, special: bool = True) -> TextEncoder:
    """The encoder of a file, one for each worker."""
    if (file, special) not in _ENCODERS:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(file)
        own = kind_of(tokenizer)
        _ENCODERS[file, special] = (TextEncoder if own is WordEncoder and not special else own)(tokenizer, special)
    return _ENCODERS[file, special]
