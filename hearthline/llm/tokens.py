"""Token ids of whole texts by a public tokenizer file, one distinct piece at a time.

A text is cut only where its tokenizer cuts as well: before white space that follows
something else, and between ASCII letters and marks.  What lies between two cuts is encoded by the ``tokenizers`` library
once per distinct piece, and the ids are gathered; the result equals that of encoding
whole texts, at the price of the distinct pieces.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from hearthline.llm.words import SPACE, slices, text_bytes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Pieces that a Python worker keeps, at about 200 bytes each; beyond them it drops those used once.
KEPT_PIECES = 500_000
# Pieces encoded at a time; the library's results take much more memory than their ids.
AT_ONCE = 10_000


def of(*chars: int) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(chars)] = True
    return mask


# Last and next to last bytes in UTF-8 of the white space beyond ASCII.
LAST = of(0x85, 0xA0, *range(0x80, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F)
NEXT_TO_LAST = of(0xC2, 0x9A, 0x80, 0x81)
LETTER = of(*range(0x41, 0x5B), *range(0x61, 0x7B))
MARK = of(*(c for c in range(0x21, 0x7F) if not chr(c).isalnum()))
# Letters after an apostrophe may belong to it ("'s").
PLAIN_MARK = MARK & ~of(0x27)
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 32


class TextEncoder:
    """Ids of texts, each followed by ``end_id``.

    ``spaced``: the tokenizer's pieces keep the white space before them (byte-level
    vocabularies); else it drops white space.  ``special``: special tokens' strings in a
    text have the ids of these tokens, as by the library's defaults; else they are ordinary
    text.
    """

    def __init__(self, file: str, end_id: int, spaced: bool, special: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = not special
        added = self.tokenizer.get_added_tokens_decoder().values() if special else ()
        self.added = sorted((str(t.content).encode() for t in added), key=len, reverse=True)
        self.pattern = re.compile(b"|".join(map(re.escape, self.added)))
        self.lowers = '"type":"Lowercase"' in self.tokenizer.to_str()
        self.end_id, self.spaced = end_id, spaced
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.begin, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.uses = np.zeros(0, np.int32)

    def prune(self) -> None:
        """Keep the pieces that more than one slice of text has used; start anew if these are many too."""
        kept = np.flatnonzero(self.uses > 1)
        if len(kept) > KEPT_PIECES // 2:
            return self.forget()
        pieces = list(self.known)
        self.known = {pieces[k]: i for i, k in enumerate(kept.tolist())}
        size = self.size[kept]
        before = np.cumsum(size) - size
        self.flat = self.flat[np.repeat(self.begin[kept] - before, size) + np.arange(int(size.sum()))]
        self.begin, self.size, self.uses = before, size, np.zeros(len(kept), np.int32)

    def special_places(self, content: np.ndarray, begin: np.ndarray) -> list[tuple[int, int]]:
        """Where special tokens' strings lie, each within one text; the longest of those that start first."""
        data, found = content.tobytes(), []
        if not any(token in data for token in self.added):
            return found
        at = 0
        while m := self.pattern.search(data, at):
            stop = int(begin[np.searchsorted(begin, m.start(), "right")])
            if m := self.pattern.search(data, m.start(), stop):
                found.append(m.span())
            at = m.end() if m else stop
        return found

    def pieces(self, column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """A code for each piece, the distinct pieces, and the first piece of each text.

        Cuts: before white space after something else, and between ASCII letters and ASCII
        marks, except that nothing is cut behind an apostrophe.  A special token's string is a
        piece of its own, found before letters are lowered.
        """
        raw, begin = text_bytes(column)
        content = raw
        if self.lowers:
            content = FOLD[raw]
        blank, letter = SPACE[content], LETTER[content]
        cut = np.zeros(len(content), bool)
        cut[1:] = (letter[:-1] & MARK[content[1:]]) | (PLAIN_MARK[content[:-1]] & letter[1:])
        if self.spaced:
            opens = blank.copy()
            opens[1:] &= ~blank[:-1]
            opens[2:] &= ~(LAST[content[1:-1]] & NEXT_TO_LAST[content[:-2]])
            cut |= opens
        else:
            cut[1:] |= blank[:-1]
        for a, b in self.special_places(raw, begin):
            if self.lowers:
                content[a:b] = raw[a:b]
            cut[a : b + 1] = False
            cut[[a, *([b] if b < len(cut) else [])]] = True
        cut[begin[:-1][np.diff(begin) > 0]] = True
        if not self.spaced:
            cut &= ~blank
        starts = np.flatnonzero(cut)
        first = np.searchsorted(starts, begin)
        if not self.spaced:
            content, starts = content[~blank], np.flatnonzero(cut[~blank])
        found = slices(content, np.diff(np.append(starts, len(content)))).dictionary_encode()
        return found.indices.to_numpy(zero_copy_only=False), found.dictionary, first

    def learn(self, distinct: list[bytes]) -> np.ndarray:
        """The number of each piece among the kept ones, encoding those not seen before."""
        if len(self.known) > KEPT_PIECES:
            self.prune()
        numbers = list(map(self.known.get, distinct))
        missing = [i for i, n in enumerate(numbers) if n is None]
        if missing:
            size, ids, first = [], [], len(self.known)
            for at in range(0, len(missing), AT_ONCE):
                texts = [distinct[i].decode() for i in missing[at : at + AT_ONCE]]
                found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
                size.append(np.fromiter(map(len, found), np.int64, len(found)))
                ids.append(np.fromiter(chain.from_iterable(found), np.uint32))
            size, ids = np.concatenate(size), np.concatenate(ids)
            self.begin = np.append(self.begin, len(self.flat) + np.cumsum(size) - size)
            self.size, self.flat = np.append(self.size, size), np.append(self.flat, ids)
            self.uses = np.append(self.uses, np.zeros(len(missing), np.int32))
            for number, i in enumerate(missing, first):
                self.known[distinct[i]] = numbers[i] = number
        found = np.array(numbers, np.int64)
        self.uses[found] += 1
        return found

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the number of ids of each, its end included."""
        codes, distinct, first = self.pieces(column)
        kept = self.learn(distinct.to_pylist())
        piece = kept[codes] if len(codes) else np.zeros(0, np.int64)
        size = self.size[piece]
        before = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=before[1:])
        counts = np.diff(before[first]) + 1
        ids = np.full(int(counts.sum()), self.end_id, np.uint32)
        token = np.repeat(self.begin[piece] - before[:-1], size)
        token += np.arange(len(token))
        place = np.repeat(np.arange(len(counts)), counts - 1)
        place += np.arange(len(place))
        ids[place] = self.flat[token]
        return ids, counts


@lru_cache(maxsize=2)
def encoder(file: str, end_id: int, spaced: bool, special: bool = True) -> TextEncoder:
    """One encoder for all tasks of a Python worker."""
    return TextEncoder(file, end_id, spaced, special)
