"""Pre-tokens of the byte-level BPE vocabulary and their pieces.

The library splits a text at fixed places (letters, digits, other signs, each
with one leading space, and runs of white space) and merges inside each
pre-token alone. So a text's ids are its pre-tokens' ids in a row, and each
distinct pre-token needs the library once. The splitting runs over whole
arrays of code points; pieces come from the tokenizers library.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from operator import attrgetter

import numpy as np

from personalens.llm.common import mix64, span_hashes

DEFAULT_TOKENIZER = "byte_bpe_50k.json"
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4
# Unicode White_Space, fixed.
WHITE_SPACE = [0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Distinct pre-tokens whose pieces a Python worker remembers; beyond it, it starts afresh.
REMEMBERED = 1_500_000


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


_classes = np.zeros(0, np.uint8)


def code_classes(top: int = 0x10FFFF) -> np.ndarray:
    """Class of every code point up to top at least; a worker makes them as far as its texts go."""
    global _classes
    if len(_classes) <= top:
        size = min(0x110000, max(0x4000, 1 << int(top).bit_length()))
        kind = {"L": LETTER, "N": NUMBER}
        c = np.fromiter((kind.get(unicodedata.category(chr(i))[0], OTHER) for i in range(size)), np.uint8, size)
        c[[w for w in WHITE_SPACE if w < size]] = SPACE
        _classes = c
    return _classes


@lru_cache(1)
def code_hashes() -> np.ndarray:
    """The 64-bit code by which every code point enters a hash."""
    return mix64(np.arange(1, 0x110001, dtype=np.uint64))


@lru_cache(1)
def _short_id_codes() -> np.ndarray:
    return mix64(np.arange(1, (1 << 16) + 1, dtype=np.uint64))


def id_codes(ids: np.ndarray) -> np.ndarray:
    """The 64-bit code by which every id enters the hash of a word's ids."""
    return _short_id_codes()[ids] if ids.itemsize == 2 else mix64(ids.astype(np.uint64) + np.uint64(1))


def contraction_ends(code: np.ndarray, at: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Length of the contraction ('s 't 'm 'd 're 've 'll) that starts at each apostrophe, or 0. limit: where its text ends."""
    pad = np.concatenate([code, np.zeros(3, code.dtype)])
    a, b = pad[at + 1], pad[at + 2]
    one = np.isin(a, [ord(x) for x in "stmd"]) & (at + 1 < limit)
    two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
    return np.where(one, 2, np.where(two & (at + 2 < limit), 3, 0))


def boundaries(code: np.ndarray, text_start: np.ndarray) -> np.ndarray:
    """Sorted starts of the pre-tokens of texts that lie one after the other in code."""
    n = len(code)
    if not n:
        return np.zeros(0, np.int64)
    kind = code_classes(int(code.max()))[code]
    first = np.zeros(n + 1, bool)
    first[text_start[text_start < n]] = True
    change = np.empty(n + 1, bool)
    change[0] = change[n] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:n])
    change[:n] |= first[:n]
    first[n] = True
    space, blank = kind == SPACE, code == 0x20
    cut = change[:n].copy()
    # A space before a word in the same text belongs to the word: the word's own start is no cut.
    after_blank = np.zeros(n, bool)
    after_blank[1:] = blank[:-1] & ~first[1:n] & ~space[1:]
    cut[after_blank] = False
    # The last of several white-space signs before a word starts a pre-token of its own.
    cut[:-1] |= space[:-1] & ~space[1:] & ~first[1:n]
    # A lone apostrophe that starts a pre-token takes a contraction from the letters after it.
    mark = np.flatnonzero((code == ord("'")) & cut & change[:n] & change[1:])
    if len(mark):
        ends = np.append(np.unique(text_start[text_start < n]), n)
        limit = ends[np.searchsorted(ends, mark, "right")]
        size = contraction_ends(code, mark, limit)
        mark, limit, size = mark[size > 0], limit[size > 0], size[size > 0]
        cut[mark + 1] = False
        rest = mark + size
        cut[rest[rest < limit]] = True
    return np.flatnonzero(cut)


class Numbers:
    """Numbers of distinct 64-bit hashes in the order in which they were added, by open addressing."""

    def __init__(self):
        self.bits, self.n, self.key = 18, 0, np.zeros(1 << 15, np.uint64)
        self.table = np.full(1 << self.bits, -1, np.int32)

    def __len__(self) -> int:
        return self.n

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).view(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each hash, -1 where it was never added."""
        place = self._places(hashes)
        number = self.table[place]
        left = np.flatnonzero((self.key[number] != hashes) & (number >= 0))
        while len(left):  # another hash has the place: look at the next one
            place[left] = place[left] + 1 & len(self.table) - 1
            number[left] = found = self.table[place[left]]
            left = left[(self.key[found] != hashes[left]) & (found >= 0)]
        return number

    def add(self, hashes: np.ndarray) -> None:
        """Number hashes that are distinct and new."""
        n = self.n + len(hashes)
        while n > len(self.key):
            self.key = np.resize(self.key, 2 * len(self.key))
        self.key[self.n:n] = hashes
        first, self.n = self.n, n
        if 2 * n > len(self.table):  # at most half full, so that searches end soon
            self.bits = (4 * n - 1).bit_length()
            self.table, first = np.full(1 << self.bits, -1, np.int32), 0
        number = np.arange(first, n, dtype=np.int32)
        place = self._places(self.key[first:n])
        while len(number):
            free = self.table[place] < 0
            self.table[place[free]] = number[free]
            left = self.table[place] != number  # another one was there before, or came at the same time
            number, place = number[left], place[left] + 1 & len(self.table) - 1


class PieceCounter:
    """Pre-tokens of texts and their ids by one tokenizer file; remembers the ids of distinct pre-tokens."""

    def __init__(self, path: str):
        import json
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        whole = Tokenizer.from_file(path)
        self.model = whole.model
        self.dtype = np.uint16 if whole.get_vocab_size() <= 1 << 16 else np.uint32
        with open(path) as f:
            self.special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        self.to_chars = np.array(_byte_chars(), "<u4")
        self.forget()

    def forget(self) -> None:
        self.known = Numbers()
        self.ids, self.n_ids = np.zeros(1 << 16, self.dtype), 0
        self.first, self.size = np.zeros(1 << 15, np.int64), np.zeros(1 << 15, np.int32)
        self.id_hash = np.zeros(1 << 15, np.uint64)

    def pieces(self, pretokens: list[str]) -> list[list[int]]:
        """Ids of each pre-token, by the library's merges."""
        flat, size = self.flat_pieces(pretokens)
        end = np.cumsum(size, dtype=np.int64)
        return [flat[a:b] for a, b in zip((end - size).tolist(), end.tolist(), strict=True)]

    def flat_pieces(self, pretokens: list[str]) -> tuple[list[int], list[int]]:
        """The ids of all pre-tokens in a row, and how many each has."""
        raw = [p.encode() for p in pretokens]
        chars = self.to_chars[np.frombuffer(b"".join(raw), np.uint8)].tobytes().decode("utf-32-le")  # one character a byte
        special = set(self.special.keys() & pretokens) if self.special else ()
        tokenize, token_id, at = self.model.tokenize, attrgetter("id"), 0
        flat: list[int] = []
        size: list[int] = []
        for r, p in zip(raw, pretokens, strict=True):
            end = at + len(r)
            if p in special:
                flat.append(self.special[p])
                size.append(1)
            else:
                tokens = tokenize(chars[at:end])
                flat.extend(map(token_id, tokens))
                size.append(len(tokens))
            at = end
        return flat, size

    def split(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(joined text, starts, ends, hash and text index of every pre-token); special strings are pre-tokens of their own."""
        owner, parts = range(len(texts)), texts
        if any(s in t for s in self.special for t in texts):
            owner, parts = zip(*((i, p) for i, t in enumerate(texts) for p in self._parts(t)), strict=True)
        joined = "".join(parts)
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.fromiter((len(p) for p in parts), np.int64, len(parts))
        text_start = np.cumsum(size) - size
        start = boundaries(code, text_start)
        whole = [i for i, p in enumerate(parts) if p in self.special] if parts is not texts else []
        if whole:
            inside = np.zeros(len(code) + 1, np.int64)
            for i in whole:
                inside[text_start[i] + 1] += 1
                inside[text_start[i] + size[i]] -= 1
            start = start[np.cumsum(inside)[start] == 0]
        end = np.append(start[1:], len(code))
        part = np.searchsorted(text_start + size, start, "right")
        doc = np.asarray(owner)[part] if len(start) else np.zeros(0, np.int64)
        return joined, start, end, span_hashes(code_hashes()[code], start, end), doc

    def _parts(self, text: str):
        import re
        pattern = "(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")"
        return re.split(pattern, text)

    def look_up(self, joined: str, start, end, hashes) -> np.ndarray:
        """Index into the memory of every pre-token; new ones are put through the library, once per distinct one."""
        slot = self.known.find(hashes)
        miss = np.flatnonzero(slot < 0)
        if len(miss):
            distinct, at, which = np.unique(hashes[miss], return_index=True, return_inverse=True)
            if len(self.known) + len(distinct) > REMEMBERED and len(self.known):
                self.forget()
                return self.look_up(joined, start, end, hashes)
            slot[miss] = len(self.known) + which
            where = miss[at]
            places = zip(start[where].tolist(), end[where].tolist(), strict=True)
            self._remember(distinct, *self.flat_pieces([joined[a:b] for a, b in places]))
        return slot.astype(np.int64)

    def _remember(self, hashes: np.ndarray, ids: list[int], sizes: list[int]) -> None:
        """Add distinct pre-tokens and their ids to the memory, all at once."""
        k, size, flat = len(self.known), np.array(sizes, np.int32), np.array(ids, self.dtype)
        n = k + len(size)
        self.known.add(hashes)
        while n > len(self.first):
            self.first, self.size, self.id_hash = (np.resize(x, 2 * len(x)) for x in (self.first, self.size, self.id_hash))
        while self.n_ids + len(flat) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        end = np.cumsum(size, dtype=np.int64)
        self.size[k:n] = size
        self.first[k:n] = self.n_ids + end - size
        self.id_hash[k:n] = span_hashes(id_codes(flat), end - size, end)
        self.ids[self.n_ids:self.n_ids + len(flat)] = flat
        self.n_ids += len(flat)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """(ids of all texts in a row, where each text's begin (one more than texts), then of every pre-token
        its hash, its text's index, its length in code points, its number of ids and the hash of its ids)."""
        joined, start, end, hashes, doc = self.split(texts)
        slot = self.look_up(joined, start, end, hashes)
        size = self.size[slot].astype(np.int64)
        begin = np.cumsum(size) - size
        flat = self.ids[np.arange(size.sum()) + np.repeat(self.first[slot] - begin, size)]
        total = np.bincount(doc, size, len(texts)).astype(np.int64)
        return flat, np.concatenate(([0], np.cumsum(total))), hashes, doc, end - start, size, self.id_hash[slot]

    def encode_ended(self, texts: list[str], end_id: int):
        """encode() with end_id after each text's ids."""
        flat, begin, *words = self.encode(texts)
        k = np.arange(len(texts))
        out = np.empty(len(flat) + len(texts), self.ids.dtype)
        text = np.ones(len(out), bool)
        text[begin[1:] + k] = False
        out[text] = flat
        out[begin[1:] + k] = end_id
        return out, begin + np.append(k, len(texts)), *words


@lru_cache(2)
def counter(path: str) -> PieceCounter:
    """One counter a Python worker and tokenizer file."""
    return PieceCounter(path)


def _byte_chars() -> list[int]:
    """The character that stands for each byte in the vocabulary: printable bytes for themselves, the others from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [b if b in shown else next(hidden) for b in range(256)]


def text_chunks(texts: list[str], limit: int = 1 << 20):
    """Index ranges of consecutive texts of about `limit` characters."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)
