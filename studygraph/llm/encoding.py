"""Token ids of whole texts by a public tokenizer of the tokenizers library.

The library's own splitting never lets a token cross certain places of a text (before white space, between an ASCII
letter and ASCII punctuation, around the string of an added token). Texts are cut at such places into units, each distinct unit is encoded once by the library
and kept, and a text's ids are its units' ids one after the other. This gives the same ids as encoding the text at once,
for much less work, as most units are words that were met before."""

from __future__ import annotations

import os
import re
from functools import cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from studygraph.llm import arrays

#: Distinct units that a worker keeps the ids of; past these it starts anew.
KEPT_UNITS = 600_000

_ASCII_SPACE = arrays._SPACE
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[33:48] = _PUNCT[58:65] = _PUNCT[91:97] = _PUNCT[123:127] = True
_PUNCT[39] = False  # the apostrophe begins contractions
#: First bytes of the characters among which are white space and marks beyond ASCII.
_ODD = np.zeros(256, bool)
_ODD[[0xC2, 0xCC, 0xCD, 0xE1, 0xE2, 0xE3]] = True


def cuts(raw: np.ndarray, offsets: np.ndarray, spaced: bool) -> np.ndarray:
    """Sorted places where units start. spaced: a space belongs to the unit after it (byte-level splitting); otherwise
    white space only separates."""
    n = len(raw)
    cut = np.zeros(n + 1, bool)
    if n > 1:
        before, after = raw[:-1], raw[1:]
        space = _ASCII_SPACE[raw]
        odd = _ODD[raw]
        near = odd.copy()  # the last byte of a character whose first byte is odd is at most two bytes on
        near[1:] |= odd[:-1]
        near[2:] |= odd[:-2]
        plain = ~near[:-1] & ~near[1:]
        edge = (_LETTER[before] & _PUNCT[after]) | (_PUNCT[before] & _LETTER[after])
        edge |= ~space[:-1] & space[1:] & plain
        if spaced:
            # one white space character that is not a space, between two that are none, is a unit
            alone = np.zeros(n, bool)
            alone[1:-1] = space[1:-1] & (raw[1:-1] != 32) & ~space[:-2] & ~space[2:]
            alone[1:-1] &= ~near[:-2] & ~near[2:]
            edge |= alone[:-1]
        else:
            edge |= space[:-1] & ~space[1:] & plain
        cut[1:n] = edge
    cut[offsets] = True
    return np.flatnonzero(cut[:n])


class Encoder:
    """Ids of texts by a tokenizer file, as its library gives them without adding special tokens: an added token's string
    in a text is that token."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        #: Tokens that reach beyond their string, or are found after normalising, leave no place to cut: whole texts are units.
        self.whole = any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added)
        self.added = sorted((t.content.encode() for t in added), key=lambda t: (-len(t), t))
        kind = self.tokenizer.pre_tokenizer
        self.spaced = type(kind).__name__ == "ByteLevel" and self.tokenizer.normalizer is None
        self.clear()

    def clear(self) -> None:
        self.unit: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 16, np.int64)

    def learn(self, fresh: list[bytes]) -> None:
        for at in range(0, len(fresh), 4096):
            some = fresh[at : at + 4096]
            found = [e.ids for e in self.tokenizer.encode_batch([x.decode() for x in some], add_special_tokens=False)]
            flat = [i for ids in found for i in ids]
            known, start = len(self.unit), int(self.ends[len(self.unit)])
            if start + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(max(len(flat), len(self.ids)), np.uint32)])
            if known + len(some) + 1 > len(self.ends):
                self.ends = np.concatenate([self.ends, np.zeros(len(self.ends), np.int64)])
            self.ids[start : start + len(flat)] = flat
            self.ends[known + 1 : known + 1 + len(some)] = start + np.cumsum([len(ids) for ids in found])
            self.unit.update(zip(some, range(known, known + len(some)), strict=True))

    def specials(self, raw: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
        """Where the strings of added tokens stand in the texts, from left to right, the longest first."""
        data = raw.tobytes()
        if self.whole or not any(t in data for t in self.added):
            return []
        pattern = re.compile(b"|".join(map(re.escape, self.added)))
        return [(int(a) + m.start(), int(a) + m.end()) for a, z in zip(offsets[:-1], offsets[1:], strict=True) for m in pattern.finditer(data[a:z])]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of a string column, where each text's ids start and one more). Null is the empty text."""
        raw, offsets = arrays.text_bytes(column)
        special = self.specials(raw, offsets)
        if self.whole:
            starts = np.unique(offsets[:-1][np.diff(offsets) > 0])
        else:
            given = raw
            if not self.spaced:
                raw = arrays._LOWER[raw]  # the tokenizer lowers letters itself; done before, fewer units differ
                raw = np.where(_ASCII_SPACE[raw], np.uint8(32), raw)
            starts = cuts(raw, offsets, self.spaced)
            if special:  # each is a unit of its own, and what is beside it as at a text's bounds
                inside = np.zeros(len(raw) + 1, bool)
                bounds = np.array(special)
                for a, z in special:
                    inside[a:z] = True
                    if raw is not given:
                        raw[a:z] = given[a:z]
                starts = np.unique(np.concatenate([starts[~inside[starts]], bounds[:, 0], bounds[bounds[:, 1] < len(raw), 1]]))
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        sift = not self.spaced and not self.whole
        if sift:
            keep = ~((raw[starts] == 32) & (np.append(starts[1:], len(raw)) - starts == 1))
        bounds = np.append(starts, len(raw))
        units = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(raw.tobytes())])
        if sift:
            units, starts = units.filter(pa.array(keep)), starts[keep]
        coded = units.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.unit) + len(distinct) > KEPT_UNITS:
            self.clear()
        known = self.unit
        place = np.array([known.get(x, -1) for x in distinct], np.int64)
        if (new := np.flatnonzero(place < 0)).size:
            place[new] = len(known) + np.arange(len(new))
            self.learn([distinct[i] for i in new.tolist()])
        at, to = self.ends[place], self.ends[place + 1]
        code = coded.indices.to_numpy()
        first, sizes = at[code], (to - at)[code]
        total = np.concatenate(([0], np.cumsum(sizes)))
        ids = self.ids[np.repeat(first - total[:-1], sizes) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, offsets)]


@cache
def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    return Encoder(path)
