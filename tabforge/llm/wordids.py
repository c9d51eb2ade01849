"""Token ids of texts by a hashed table of whole words, in array operations."""

from __future__ import annotations

import unicodedata

import numpy as np

#: Words a Python worker remembers before it starts afresh.
WORDS = 880_000
#: Bytes of texts handled at once.
CHUNK = 1 << 20
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class WordTable:
    """Ids of texts under a tokenizer that drops white space and never merges across it.

    A text's ids are then those of its words in turn. Words are found by two 64-bit hashes in an open-addressing table,
    whole batches at a time; the tokenizer sees a word only the first time. Special strings hold no white space either.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        vocab = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)  # tokens that end a word
        self.last[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.powers: list[tuple[np.ndarray, np.ndarray]] = []
        self.clear()

    def clear(self) -> None:
        self.bits = 16
        self.key = np.zeros((1 << self.bits, 2), np.uint64)
        self.entry = np.zeros(1 << self.bits, np.int32)
        self.n = 0
        self.at = np.zeros(1 << 15, np.int64)
        self.size = np.zeros(1 << 15, np.int32)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _hashes(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        n = len(data)
        if not self.powers or len(self.powers[0][0]) < n + 1:
            size = max(n + 1, CHUNK + (CHUNK >> 3))
            self.powers = []
            for base in _BASES:
                both = []
                for b in (base, pow(base, -1, 1 << 64)):
                    steps = np.full(size, np.uint64(b), np.uint64)
                    steps[0] = 1
                    both.append(np.multiply.accumulate(steps))
                self.powers.append((both[0], both[1]))
        out = np.empty((len(start), 2), np.uint64)
        plus = data.astype(np.uint64) + np.uint64(1)
        sums = np.zeros(n + 1, np.uint64)
        for k, (up, down) in enumerate(self.powers):
            np.cumsum(plus * up[:n], out=sums[1:])
            code = (sums[end] - sums[start]) * down[start]
            code ^= code >> np.uint64(32)
            code *= np.uint64(0xD6E8FEB86659FD93)
            out[:, k] = code ^ (code >> np.uint64(29))
        out[:, 0] |= np.uint64(1)  # zero marks a free slot
        return out

    def _find(self, codes: np.ndarray) -> np.ndarray:
        """Entry of each word, -1 if it isn't known."""
        out = np.full(len(codes), -1, np.int64)
        mask = (1 << self.bits) - 1
        slot = (codes[:, 0] >> np.uint64(64 - self.bits)).astype(np.int64)
        todo = np.arange(len(codes))
        while len(todo):
            there = self.key[slot]
            same = (there[:, 0] == codes[todo, 0]) & (there[:, 1] == codes[todo, 1])
            out[todo[same]] = self.entry[slot[same]]
            on = ~same & (there[:, 0] != 0)
            todo, slot = todo[on], (slot[on] + 1) & mask
        return out

    def _insert(self, codes: np.ndarray, entries: np.ndarray) -> None:
        """Put distinct words into free slots; of those that want one slot, one gets it and the others go on."""
        mask = (1 << self.bits) - 1
        slot = (codes[:, 0] >> np.uint64(64 - self.bits)).astype(np.int64)
        todo = np.arange(len(codes))
        while len(todo):
            free = self.key[slot, 0] == 0
            self.entry[slot[free]] = entries[todo[free]]
            own = np.zeros(len(todo), bool)
            own[free] = self.entry[slot[free]] == entries[todo[free]]
            self.key[slot[own]] = codes[todo[own]]
            todo, slot = todo[~own], (slot[~own] + 1) & mask

    def _add(self, codes: np.ndarray, lists: list[np.ndarray]) -> None:
        sizes = np.array([len(x) for x in lists], np.int64)
        flat = np.concatenate(lists).astype(np.uint32) if lists else np.zeros(0, np.uint32)
        while 2 * (self.n + len(lists)) > 1 << self.bits:
            old, self.bits = self.key[:, 0] != 0, self.bits + 1
            keys, entries = self.key[old], self.entry[old]
            self.key, self.entry = np.zeros((1 << self.bits, 2), np.uint64), np.zeros(1 << self.bits, np.int32)
            self._insert(keys, entries)
        while len(self.at) < self.n + len(lists):
            self.at, self.size = np.r_[self.at, np.zeros_like(self.at)], np.r_[self.size, np.zeros_like(self.size)]
        while len(self.ids) < self.used + len(flat):
            self.ids = np.r_[self.ids, np.zeros_like(self.ids)]
        new = slice(self.n, self.n + len(lists))
        self.at[new] = self.used + np.cumsum(sizes) - sizes
        self.size[new] = sizes
        self.ids[self.used : self.used + len(flat)] = flat
        self._insert(codes, np.arange(self.n, self.n + len(lists)))
        self.n, self.used = self.n + len(lists), self.used + len(flat)

    def _tokenise(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word by the tokenizer."""
        out: list[np.ndarray | None] = [None] * len(words)
        # words of plain letters stay whole, so many go in one call and are told apart by their last tokens
        plain = [i for i, w in enumerate(words) if w.isalpha() and max(w) < "Ā"]
        for at in range(0, len(plain), 256):
            some = plain[at : at + 256]
            found = np.array(self.tokenizer.encode(" ".join([words[i] for i in some]), add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(self.last[found]) + 1
            if len(ends) == len(some):
                for i, a, b in zip(some, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                    out[i] = found[a:b]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, e in zip(rest, self.tokenizer.encode_batch([words[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, np.uint32)
        return out

    def _solid(self, stem: str) -> bool:
        """Whether the tokenizer sees a letter or digit at the end of ``stem``, which it normalises first."""
        if not stem[-1].isascii():
            # a letter may become a letter and a mark, which would go with the stop
            stem = self.tokenizer.normalizer.normalize_str(stem) if self.tokenizer.normalizer else stem
        return bool(stem) and unicodedata.category(stem[-1])[0] in "LN"

    def _learn(self, codes: np.ndarray, words: list[str]) -> None:
        # a single stop or comma after a letter or digit is a token of its own
        tail = [len(w) > 1 and w[-1] in ".," and self._solid(w[:-1]) for w in words]
        stems = [w[:-1] if t else w for w, t in zip(words, tail, strict=True)]
        heads = [s for s, t in zip(stems, tail, strict=True) if t]
        if heads:
            raw = [w.encode() for w in [*heads, ".", ","]]
            data = np.frombuffer(b" ".join(raw), np.uint8)
            ends = np.cumsum([len(w) + 1 for w in raw]) - 1
            found = self._entries(data, np.r_[0, ends[:-1] + 1], ends)
            parts = [self.ids[a : a + n] for a, n in zip(self.at[found].tolist(), self.size[found].tolist(), strict=True)]
            stop, comma = parts[-2:]
            known = iter(parts)
            whole = iter(self._tokenise([s for s, t in zip(stems, tail, strict=True) if not t]))
            lists = [
                np.concatenate([next(known), stop if w[-1] == "." else comma]) if t else next(whole)
                for w, t in zip(words, tail, strict=True)
            ]
            new = self._find(codes) < 0  # a stem may have been one of the words
            self._add(codes[new], [x for x, n in zip(lists, new, strict=True) if n])
        else:
            self._add(codes, self._tokenise(words))

    def _entries(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        codes = self._hashes(data, start, end)
        found = self._find(codes)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            _, first = np.unique(codes[missing, 0], return_index=True)
            new = missing[first]
            raw = data.tobytes()
            self._learn(codes[new], [raw[a:b].decode() for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)])
            found[missing] = self._find(codes[missing])
            if (found < 0).any():  # two words with one first hash: the second one comes now
                return self._entries(data, start, end)
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit values. Long texts are cut between words."""
        out: list[bytes] = []
        held: list[bytes] = []
        size = 0
        for text in texts:
            raw = text.encode()
            if held and size + len(raw) > CHUNK:
                out += self._encode(held)
                held, size = [], 0
            if len(raw) > CHUNK:
                out.append(b"".join(p for part in self._parts(raw) for p in self._encode([part])))
                continue
            held.append(raw)
            size += len(raw) + 1
        return out + self._encode(held) if held else out

    @staticmethod
    def _parts(raw: bytes):
        at = 0
        while len(raw) - at > CHUNK:
            cut = max(raw.rfind(b" ", at, at + CHUNK), raw.rfind(b"\n", at, at + CHUNK))
            if cut <= at:  # a word longer than a chunk stays whole
                cut = min((x for x in (raw.find(b" ", at + CHUNK), raw.find(b"\n", at + CHUNK)) if x >= 0), default=len(raw))
            yield raw[at:cut]
            at = cut
        yield raw[at:]

    def _encode(self, raws: list[bytes]) -> list[bytes]:
        if self.n > WORDS:
            self.clear()
        data = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
        gap = np.flatnonzero((data == 32) | (data == 10))
        start = np.r_[0, gap[:-1] + 1]
        solid = gap > start
        start, end = start[solid], gap[solid]
        found = self._entries(data, start, end)
        sizes = self.size[found]
        upto = np.r_[0, np.cumsum(sizes)]
        flat = np.repeat(self.at[found] - upto[:-1], sizes) + np.arange(upto[-1])
        ids = self.ids[flat].astype("<u4")
        bounds = np.r_[0, np.cumsum([len(r) + 1 for r in raws])]
        cuts = upto[np.searchsorted(start, bounds)].tolist()
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]


_TABLES: dict[str, WordTable] = {}


def worker_table(tokenizer_file: str) -> WordTable:
    """The table of this Python worker, which keeps it from task to task."""
    if tokenizer_file not in _TABLES:
        _TABLES[tokenizer_file] = WordTable(tokenizer_file)
    return _TABLES[tokenizer_file]
