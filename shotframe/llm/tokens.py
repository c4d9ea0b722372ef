"""Encoding of many texts at once: their pre-tokens are found by array operations over code points, a word met
before takes its ids from a table, and the tokenizers library merges only the words that are new.

What cuts a text (letters, numbers, white space, lower case) is read off the library itself, code point by code
point: Alphabet. Texts with other code points, or with special strings, are given whole to the library.
"""

from __future__ import annotations

import os
import unicodedata
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np

from .windows import span_hashes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Words that a worker's table holds; when it is full, those not met since it was last full make room.
WORDS = 1 << 19
#: Code points that an alphabet classifies; texts with later ones go whole to the library.
CODES = 0x20000
#: Code points that are cut and looked up at a time; a longer text is cut at spaces between words.
AT_ONCE = 1 << 19
SPACE, LETTER, NUMBER, OTHER, ODD, BREAK = range(6)
_BREAK = CODES
#: Stands between words; later than all code points of an alphabet.
_MARK = "\U0010ffff"
_KEYS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass(frozen=True)
class Alphabet:
    """Of a vocabulary's pre-tokenizer: the class of each code point, what the normalizer makes of it (None: it has
    none), and whether a space goes with the word after it."""

    classes: np.ndarray
    lower: np.ndarray | None

    @property
    def joins_space(self) -> bool:
        return self.lower is None


@cache
def alphabet(path: str) -> Alphabet:
    """Classes by Unicode's categories, each held against the library's own pre-tokenizer; code points on which they
    differ are odd. Driver work of under a second, once a vocabulary."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    spans = lambda text: len(whole.pre_tokenizer.pre_tokenize_str(text))
    joins = whole.normalizer is None
    classes = np.full(CODES + 1, ODD, np.uint8)
    classes[_BREAK] = BREAK
    first = {"L": LETTER, "N": NUMBER, "Z": SPACE, "P": OTHER, "S": OTHER, "M": OTHER, "C": OTHER}
    kinds: dict[int, list[int]] = {SPACE: [*range(9, 14), 0x85], LETTER: [], NUMBER: [], OTHER: []}
    for c in range(CODES):
        category = unicodedata.category(chr(c))
        if category not in ("Cn", "Cs") and c not in kinds[SPACE]:
            kinds[first[category[0]]].append(c)
    agree = {
        LETTER: lambda t: spans(f"A{t}A") == 1,
        OTHER: lambda t: spans(f"!{t}!") == 1,
        NUMBER: lambda t: spans(f"1{t}1") == 1 if joins else spans("A" + "A".join(t) + "A") == spans("!" + "!".join(t) + "!") == 2 * len(t) + 1,
        SPACE: lambda t: spans(t) == joins,
    }

    def settle(codes: list[int], kind: int) -> None:
        if agree[kind]("".join(map(chr, codes))):
            classes[codes] = kind
        elif len(codes) > 1:
            settle(codes[: len(codes) // 2], kind)
            settle(codes[len(codes) // 2 :], kind)

    for kind, codes in kinds.items():
        settle(codes, kind)
    if joins:
        return Alphabet(classes, None)
    lower = np.arange(CODES + 1, dtype=np.uint32)
    # a code point that takes part in compositions with its neighbours, or becomes several, makes a text odd
    parts = (unicodedata.decomposition(chr(c)).split() for c in range(CODES))
    second = {int(p[1], 16) for p in parts if len(p) == 2 and p[0][0] != "<"} | set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))
    codes = np.flatnonzero((classes != SPACE) & (classes < ODD)).tolist()
    made = whole.normalizer.normalize_str("".join(chr(c) + "\n" for c in codes)).split(" ")  # each white space becomes one space
    for c, m in zip(codes, made[:-1], strict=True):
        own = chr(c)
        if len(m) != 1 or ord(m) >= CODES or c in second or unicodedata.combining(own) or unicodedata.normalize("NFC", own) != own or classes[ord(m)] != classes[c]:
            classes[c] = ODD
        else:
            lower[c] = ord(m)
    return Alphabet(classes, lower)


class WordTable:
    """Word hashes and where the values of each word lie: open addressing over arrays."""

    def __init__(self, most: int, kind: np.dtype):
        self.most, self.kind = most, kind
        self._clear(1 << 16)

    def _clear(self, slots: int) -> None:
        self.mask = slots - 1
        self.key, self.check = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)
        self.start, self.size = np.zeros(slots, np.uint32), np.zeros(slots, np.uint32)
        self.met = np.zeros(slots, bool)
        self.pool, self.filled, self.held = np.empty(1 << 18, self.kind), 0, 0

    def find(self, h: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The slot of each word, or -1. Both hashes, 128 bits, have to agree."""
        out = np.full(len(h), -1, np.int64)
        at, slot = np.arange(len(h)), (h & np.uint64(self.mask)).astype(np.int64)
        while len(at):
            key = self.key[slot]
            hit = (key == h[at]) & (self.check[slot] == check[at])
            out[at[hit]] = slot[hit]
            on = ~hit & (key != 0)
            at, slot = at[on], (slot[on] + 1) & self.mask
        self.met[out[out >= 0]] = True
        return out

    def add(self, h: np.ndarray, check: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> None:
        """Words that are not in the table, each once."""
        if 2 * (self.held + len(h)) > len(self.key):
            old = np.flatnonzero((self.key != 0) & (self.met if self.held + len(h) > self.most else True))
            if len(old) + len(h) > self.most:  # all that is held was met again: begin anew
                old = old[:0]
            kept = (self.key[old], self.check[old], self.size[old], self.values(old))
            slots = len(self.key)
            while 2 * (len(old) + len(h)) > slots or (4 * (len(old) + len(h)) > slots and slots < 2 * self.most):
                slots *= 2
            self._clear(slots)
            self._put(*kept)
        self._put(h, check, sizes, values)

    def _put(self, h: np.ndarray, check: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> None:
        need = self.filled + len(values)
        if need > len(self.pool):
            self.pool = np.concatenate((self.pool[: self.filled], np.empty(max(need, 2 * len(self.pool)) - self.filled, self.kind)))
        self.pool[self.filled : need] = values
        start = self.filled + np.cumsum(sizes) - sizes
        self.filled, self.held = need, self.held + len(h)
        at, slot = np.arange(len(h)), (h & np.uint64(self.mask)).astype(np.int64)
        while len(at):
            free = self.key[slot] == 0
            self.key[slot[free]] = h[at[free]]
            self.check[slot[free]] = check[at[free]]  # of two words for one slot, the later has it in either line
            got = free & (self.key[slot] == h[at]) & (self.check[slot] == check[at])
            self.start[slot[got]], self.size[slot[got]] = start[at[got]], sizes[at[got]]
            at, slot = at[~got], (slot[~got] + 1) & self.mask

    def values(self, slots: np.ndarray) -> np.ndarray:
        """The values of the words in these slots, one after the other."""
        size = self.size[slots].astype(np.int64)
        return self.pool[np.repeat(self.start[slots] - (np.cumsum(size) - size), size) + np.arange(size.sum())]


class WordEncoder:
    """Ids of texts as the tokenizers library gives them without added special tokens."""

    def __init__(self, path: str, letters: Alphabet, most: int = WORDS):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.merger = Tokenizer(self.whole.model)  # no normalizer and no pre-tokenizer: it gets words
        self.letters = letters
        self.table = WordTable(most, np.dtype(np.uint16 if self.whole.get_vocab_size() <= 1 << 16 else np.uint32))
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the public byte-level alphabet
        hidden = [b for b in range(256) if b not in shown]
        self.bytes = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)} | {255: "\n"}  # UTF-8 has no 255
        self.special = sorted(x.content for x in self.whole.get_added_tokens_decoder().values())

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and all ids: the library's merges."""
        spelled = _MARK.join(words).encode().replace(_MARK.encode(), b"\xff").decode("latin-1").translate(self.bytes).split("\n")
        ids = [e.ids for e in self.merger.encode_batch_fast(spelled, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return sizes, np.fromiter(chain.from_iterable(ids), self.table.kind, int(sizes.sum()))

    def learned(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and values of new words: here their ids."""
        return self.merged(words)

    def whole_text(self, text: str) -> np.ndarray:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)

    def _tokens(self, c: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of each pre-token; c begins and ends with a break."""
        new = np.empty(len(c), bool)
        new[0] = True
        np.not_equal(kind[1:], kind[:-1], out=new[1:])
        if self.letters.joins_space:
            word = np.flatnonzero(new[1:] & (kind[:-1] == SPACE) & (kind[1:] < ODD)) + 1  # after white space
            new[word - 1] = True
            new[word] = c[word - 1] != 32
        else:
            new |= kind == NUMBER
        quote = np.flatnonzero(c == 39)
        quote = quote[new[quote] & (kind[quote + 1] == LETTER)]
        if len(quote):
            a, b = c[quote + 1], c[np.minimum(quote + 2, len(c) - 1)]
            one = (a == 115) | (a == 116) | (a == 109) | (a == 100)
            two = ((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108)
            new[quote[one | two] + 1] = False
            after = np.concatenate((quote[one] + 2, quote[two] + 3))
            new[after] = True
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(c))
        keep = kind[begin] != BREAK
        if not self.letters.joins_space:
            keep &= kind[begin] != SPACE
        return begin[keep], end[keep]

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Number of values of each text, all values, and which texts the library has to take whole."""
        joined = "".join(texts)
        sizes = np.array([len(t) for t in texts])
        c = np.full(len(joined) + len(texts) + 1, _BREAK, np.uint32)
        owner = np.repeat(np.arange(len(texts)), sizes)
        place = np.arange(len(joined)) + owner + 1
        raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        c[place] = np.minimum(raw, _BREAK)
        kind = self.letters.classes[c]
        bad = set(owner[(raw >= CODES) | (kind[place] == ODD)].tolist())
        bad.update(i for i, t in enumerate(texts) if any(x in t for x in self.special))
        if bad:
            out = np.isin(owner, sorted(bad))
            c[place[out]], kind[place[out]] = _BREAK, BREAK
        if self.letters.lower is not None:
            c = self.letters.lower[c]
        begin, end = self._tokens(c, kind)
        word_owner = np.searchsorted(np.cumsum(sizes + 1), begin, side="right")
        raw_words = c.tobytes()
        h, check = (span_hashes(raw_words, 4 * begin, 4 * end, key) for key in _KEYS)
        h[h == 0] = 1
        slot = self.table.find(h, check)
        missing = np.flatnonzero(slot < 0)
        if len(missing):
            # words of equal hash and unequal check would be different words: only the first is looked for here
            _, first, same = np.unique(h[missing], return_index=True, return_inverse=True)
            first = missing[first]
            clash = check[missing] != check[first][same]
            if clash.any():
                bad.update(word_owner[missing[clash]].tolist())
            long = end[first] - begin[first] + 1  # with a mark after each
            spelled = c[np.minimum(np.repeat(begin[first] - (np.cumsum(long) - long), long) + np.arange(long.sum()), len(c) - 1)]
            spelled[np.cumsum(long) - 1] = ord(_MARK)
            self.table.add(h[first], check[first], *self.learned(spelled[:-1].tobytes().decode("utf-32-le").split(_MARK)))
            slot = self.table.find(h, check)
            slot[slot < 0] = 0  # of a text that goes to the library
        count = self.table.size[slot].astype(np.int64)
        if bad:
            count[np.isin(word_owner, sorted(bad))] = 0
            slot = slot[count > 0]
        return np.bincount(word_owner, count, len(texts)).astype(np.int64), self.table.values(slot), sorted(bad)

    def _parts(self, text: str) -> list[str]:
        """A text in parts of about AT_ONCE: cut before a space between two other characters, none of them white
        space, which no pre-token reaches across."""
        if len(text) <= AT_ONCE:
            return [text]
        out, a = [], 0
        while len(text) - a > AT_ONCE:
            b = text.rfind(" ", a + 1, a + AT_ONCE)
            while b > a and (text[b - 1].isspace() or text[b + 1].isspace()):
                b = text.rfind(" ", a + 1, b)
            if b <= a:
                return [text]
            out.append(text[a:b])
            a = b
        return [*out, text[a:]]

    def groups(self, texts: list[str]):
        """(position, part) of texts in groups of about AT_ONCE code points."""
        group, size = [], 0
        for i, t in enumerate(texts):
            for part in self._parts(t):
                if group and size + len(part) > AT_ONCE:
                    yield group
                    group, size = [], 0
                group.append((i, part))
                size += len(part)
        if group:
            yield group

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, unsigned 32-bit."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for group in self.groups(texts):
            counts, values, odd = self._plain([p for _, p in group])
            values, ends = values.astype(np.uint32), np.cumsum(counts).tolist()
            odd = set(odd)
            for k, (i, part) in enumerate(group):
                out[i].append(self.whole_text(part) if k in odd else values[ends[k] - counts[k] : ends[k]])
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]


class WordCounter(WordEncoder):
    """Numbers of ids. Words that are proved to be one id are counted without the library's merges."""

    def __init__(self, path: str, letters: Alphabet, proved: frozenset[str], most: int = WORDS):
        super().__init__(path, letters, most)
        self.proved = proved
        self.table = WordTable(most, np.dtype(np.uint32))  # a word can have more ids than the vocabulary

    def learned(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Each word has one value, its number of ids: 1 if proved, else by the library's merges."""
        counts = np.ones(len(words), np.int64)
        rest = [i for i, w in enumerate(words) if w not in self.proved]
        if rest:
            counts[rest] = self.merged([words[i] for i in rest])[0]
        return np.ones(len(words), np.int64), counts

    def count(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        for group in self.groups(texts):
            words, values, odd = self._plain([p for _, p in group])
            total = np.bincount(np.repeat(np.arange(len(group)), words), values, len(group)).astype(np.int64)
            for k in odd:
                total[k] = len(self.whole_text(group[k][1]))
            for k, (i, _) in enumerate(group):
                out[i] += total[k]
        return out


_LOADED: dict[str, WordEncoder] = {}


def encoder(path: str, letters: Alphabet) -> WordEncoder:
    """This worker's encoder of the vocabulary; workers are reused, and with them what they remember."""
    if path not in _LOADED:
        _LOADED[path] = WordEncoder(path, letters)
    return _LOADED[path]


_COUNTERS: dict[str, WordCounter] = {}


def counter(path: str, letters: Alphabet, proved: frozenset[str]) -> WordCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = WordCounter(path, letters, proved)
    return _COUNTERS[path]
