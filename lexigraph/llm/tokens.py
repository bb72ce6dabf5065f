"""Token ids of whole texts by the tokenizers library, with each distinct string encoded once.

The vocabulary's pre-tokens (letter runs, single digits, contractions, runs of other signs) are
encoded independently of each other and never cross white space, so a text's ids are its pre-tokens'
ids in order.  A text is cut at white space, and before a sign that ends a word; what stands between
is looked up, and the library encodes only what a worker has not seen before, many at once.  Strings
are told apart by a 64-bit hash and by a second number that is the string itself up to eight bytes.
The rule holds over the characters in `_PLAIN` alone; any other text, any that may hold a special
token's string, and any with a string of more than `_LONG` bytes, is encoded by the library as it stands.
"""

from __future__ import annotations

import re
from functools import cached_property
from itertools import chain

import numpy as np

from .common import caches, trim
from .shingles import mix64

_PLAIN = "\t\n\r -~¡§«°·»¿À-įı-ſ‐-‟…€"
_OTHER = re.compile(f"[^{_PLAIN}]|<\\|")
_PRETOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_LONG = 512
_HELD = 700_000  # distinct strings that a worker keeps: about 50 MB
_PAD = b" " * 9  # so that eight bytes can be read wherever a string starts

_PLAIN_PAIRS = np.zeros(1 << 16, dtype=bool)  # by the two bytes that a character of two bytes has in UTF-8
for _c in range(0x80, 0x800):
    if not _OTHER.match(chr(_c)):
        _PLAIN_PAIRS[int.from_bytes(chr(_c).encode(), "big")] = True
_PLAIN_TRIPLES = np.array([int.from_bytes(chr(c).encode(), "big") for c in range(0x2000, 0x2100) if not _OTHER.match(chr(c))])
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
_IS_SIGN = np.isin(np.arange(256), [ord(c) for c in _SIGNS])


class _Rows:
    """Lists of ids, numbered as they are added."""

    def __init__(self):
        self.flat = np.empty(1 << 16, dtype=np.uint32)
        self.bounds = np.zeros(1 << 16, dtype=np.int64)
        self.known = 0

    def add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        end, after = self.bounds[self.known], self.known + len(counts)
        while end + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while after + 1 > len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.zeros_like(self.bounds)])
        self.flat[end : end + len(ids)] = ids
        self.bounds[self.known + 1 : after + 1] = end + np.cumsum(counts)
        self.known = after

    def joined(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the numbered lists one after another, and the end of each."""
        starts = self.bounds[codes]
        lengths = self.bounds[codes + 1] - starts
        ends = np.cumsum(lengths)
        return self.flat[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)], ends


class _Table:
    """Open addressing from 64-bit hashes of strings to their numbers, for whole arrays at once."""

    def __init__(self, most: int):
        size = 1 << max(8, (most * 7 // 5).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys, self.checks, self.codes = np.zeros(size, np.uint64), np.zeros(size, np.uint64), np.zeros(size, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or where it would go."""
        slots = keys & self.mask
        held = self.keys[slots]
        rest = np.flatnonzero((held != keys) & (held != 0))
        while len(rest):
            slots[rest] = (slots[rest] + np.uint64(1)) & self.mask
            held = self.keys[slots[rest]]
            rest = rest[(held != keys[rest]) & (held != 0)]
        return slots

    def put(self, keys: np.ndarray, checks: np.ndarray, first: int) -> None:
        """Numbers distinct new keys from `first` on."""
        rest = np.arange(len(keys))
        while len(rest):
            slots = self.find(keys[rest])
            _, winner = np.unique(slots, return_index=True)
            won = rest[winner]
            at = slots[winner]
            self.keys[at], self.checks[at], self.codes[at] = keys[won], checks[won], first + won
            rest = np.delete(rest, winner)


def _odd(whole: bytes) -> bool:
    """Whether UTF-8 bytes hold a control sign, a character that isn't plain, or what a special token starts with."""
    block = np.frombuffer(whole, dtype=np.uint8)
    if np.count_nonzero(block < 32) != sum(map(whole.count, (b"\t", b"\n", b"\r"))) or b"\x7f" in whole or b"<|" in whole:
        return True
    if whole.isascii():
        return False
    lead = np.flatnonzero(block >= 0xC0)
    pair = block[lead].astype(np.int64) << 8 | block[lead + 1]
    longer = lead[pair >= 0xE000]
    triple = block[longer].astype(np.int64) << 16 | block[longer + 1].astype(np.int64) << 8 | block[longer + 2]
    return not (_PLAIN_PAIRS[pair[pair < 0xE000]].all() and np.isin(triple, _PLAIN_TRIPLES).all())


class Encoder:
    def __init__(self, path: str, held: int = _HELD):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.path, self.held, self.words = path, held, Tokenizer.from_file(path)
        line = "It's we'll I'd 12 a_b --x! Émigré, don't.\tÇa «va» 3.5€ …"  # shows any difference from _PRETOKEN
        whole = self.words.encode(line, add_special_tokens=False).ids
        # pre-tokens come lower-cased and apart, and need no more passes over their characters
        self.words.normalizer = normalizers.Sequence([])
        self.words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.words.get_vocab()
        self.closes = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)  # ids that end a pre-token
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        parts = _PRETOKEN.findall(line.lower())
        ids = self.words.encode(" ".join(parts), add_special_tokens=False).ids
        self.fast = ids == whole and int(self.closes[ids].sum()) == len(parts)
        self._forget()

    @cached_property
    def library(self):
        """The tokenizer as its file has it; few texts need it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _forget(self) -> None:
        # strings between white space and signs, and the pre-tokens that they are made of
        self.table, self.rows, self.clash = _Table(self.held), _Rows(), False
        self.signs = np.zeros(256, dtype=np.int64)
        if self.fast:
            self.signs[[ord(c) for c in _SIGNS]] = np.arange(len(_SIGNS))
            self.rows.add(*self._encoded(" ".join(_SIGNS), len(_SIGNS)))

    def _encoded(self, text: str, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of n pre-tokens with a space between, and how many each has."""
        cuts = [0]
        while cuts[-1] < len(text):
            space = text.find(" ", cuts[-1] + 2000)
            cuts.append(space + 1 if space >= 0 else len(text))
        found = self.words.encode_batch_fast([text[a:b] for a, b in zip(cuts, cuts[1:])], add_special_tokens=False)
        ids = np.array(list(chain.from_iterable(e.ids for e in found)), dtype=np.uint32)
        ends = np.flatnonzero(self.closes[ids])
        if len(ends) == n:
            return ids, np.diff(ends, prepend=-1)
        each = [self.library.encode(w, add_special_tokens=False).ids for w in text.split(" ")]
        return np.array(list(chain.from_iterable(each)), dtype=np.uint32), np.array([len(x) for x in each])

    def _learn(self, block: np.ndarray, starts: np.ndarray, lengths: np.ndarray, keys: np.ndarray, checks: np.ndarray, single: bool) -> None:
        """Adds distinct new strings: letter runs and pre-tokens by the library, others by their pre-tokens."""
        ends = np.cumsum(lengths + 1)
        flat = np.full(ends[-1], 32, dtype=np.uint8)
        inner = np.ones(len(flat), dtype=bool)
        inner[ends - 1] = False
        flat[inner] = block[np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())]
        firsts = ends - lengths - 1
        letters = np.logical_and.reduceat((flat >= 97) & (flat <= 122) | ~inner, firsts)
        text = flat.tobytes()
        mixed = [] if single else np.flatnonzero(~letters).tolist()
        parts = {}
        for i in mixed:
            s = text[firsts[i] : ends[i] - 1].decode()
            p = _PRETOKEN.findall(s)
            if p != [s]:
                parts[i] = p
        made = np.fromiter(parts, dtype=np.int64)
        alone = np.ones(len(lengths), dtype=bool)
        alone[made] = False
        if alone.any():
            first = self.rows.known
            self.rows.add(*self._encoded(flat[np.repeat(alone, lengths + 1)][:-1].tobytes().decode(), int(alone.sum())))
            self.table.put(keys[alone], checks[alone], first)
        if parts:
            codes, _, sound = self._codes(" ".join(chain.from_iterable(parts.values())).encode() + _PAD, single=True)
            self.clash |= not sound
            ids, to = self.rows.joined(codes)
            sizes = np.cumsum([0, *map(len, parts.values())])
            first = self.rows.known
            self.rows.add(ids, np.diff(np.concatenate([[0], to])[sizes]))
            self.table.put(keys[made], checks[made], first)

    def _codes(self, whole: bytes, single: bool = False) -> tuple[np.ndarray, np.ndarray, bool]:
        """Number and start of each string; and whether all are told apart."""
        block = np.frombuffer(whole, dtype=np.uint8)
        space = block <= 32
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        edge = edge if space[0] else np.concatenate([[0], edge])
        starts, ends = edge[0::2], edge[1::2]
        lengths = ends - starts
        if not len(lengths):
            return np.empty(0, np.int64), starts, True
        if lengths.max() > _LONG:
            return np.empty(0, np.int64), starts, False
        last, before = block[ends - 1], block[ends - 2]
        signed = _IS_SIGN[last] & (before >= 97) & (before <= 122) & (lengths > 1)
        lengths = lengths - signed
        eight = np.ndarray((len(whole) - 7,), dtype="<u8", buffer=whole, strides=(1,))
        checks = eight[starts] & _MASKS[np.minimum(lengths, 8)]
        keys = mix64(checks * np.uint64(0x9E3779B97F4A7C15) + lengths.astype(np.uint64))
        at, longer = 8, np.flatnonzero(lengths > 8)
        while len(longer):
            more = eight[starts[longer] + at] & _MASKS[np.minimum(lengths[longer] - at, 8)]
            keys[longer] = mix64(keys[longer] + more)
            checks[longer] = checks[longer] * np.uint64(0xD1342543DE82EF95) + more
            at += 8
            longer = longer[lengths[longer] > at]
        keys |= np.uint64(1)
        slots = self.table.find(keys)
        fresh = np.flatnonzero(self.table.keys[slots] == 0)
        if len(fresh):
            _, first = np.unique(keys[fresh], return_index=True)
            first = fresh[first]
            self._learn(block, starts[first], lengths[first], keys[first], checks[first], single)
            slots[fresh] = self.table.find(keys[fresh])
        codes, sound = self.table.codes[slots].astype(np.int64), bool((self.table.checks[slots] == checks).all())
        closers = np.flatnonzero(signed)
        if len(closers):
            codes = np.insert(codes, closers + 1, self.signs[last[closers]])
            starts = np.insert(starts, closers + 1, ends[closers] - 1)
        return codes, starts, sound

    def _block(self, texts: list[str]) -> list[np.ndarray] | None:
        """Ids of plain texts; None if one isn't plain, or has too long a string, or two strings the same hash."""
        if self.rows.known > self.held:
            self._forget()
        data = [t.lower().encode() for t in texts]
        whole = b" ".join(data) + _PAD
        if _odd(whole):
            return None
        codes, starts, sound = self._codes(whole)
        if not sound or self.clash:
            if self.clash or len(codes):
                self._forget()
            return None
        ids, to = self.rows.joined(codes)
        at = np.concatenate([[0], to])[np.searchsorted(starts, np.cumsum([0] + [len(d) + 1 for d in data]))]
        return [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]

    def encode(self, texts: list[str | None], block: int = 1 << 18) -> list[np.ndarray]:
        """uint32 ids of each text; a null text has none."""
        out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(texts)
        some, size = [], 0

        def flush():
            nonlocal some, size
            found = self._block([texts[i] for i in some]) if some and self.fast else None
            if found is None:
                rest = [i for i in some if not self.fast or _OTHER.search(texts[i])]
                some = sorted(set(some) - set(rest))
                found = self._block([texts[i] for i in some]) if some else []
                for i in rest:
                    out[i] = self._alone(texts[i])
            for i, x in zip(some, found if found is not None else map(self._alone, [texts[i] for i in some])):
                out[i] = x
            some, size = [], 0

        for i, t in enumerate(texts):
            if t:
                some.append(i)
                size += len(t)
                if size >= block:
                    flush()
        flush()
        return out

    def _alone(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


_encoders: dict[tuple[str, int], Encoder] = caches.setdefault("tokens", {})


def encoder(path: str, held: int = _HELD) -> Encoder:
    """This process's encoder for a vocabulary file, which keeps up to so many distinct strings."""
    if (path, held) not in _encoders:
        _encoders[path, held] = Encoder(path, held)
        trim()  # reading the vocabulary's file takes several times what stays
    return _encoders[path, held]


def default_vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))
