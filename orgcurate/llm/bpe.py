"""BPE encoding and decoding by speculation and verification.

Greedy longest match proposes the tokens of a word. A sequence of tokens is what
BPE merging gives exactly when every adjacent pair is what merging gives for the
two tokens' joined characters; a table of pairs, filled on demand by exact merging
and consulted with one vectorised search for all proposed pairs, decides that.
Only words with a failing pair are merged exactly.

A worker keeps the ids of the pieces between white space that it saw first (at most CACHE of them, short
ones only); other pieces are encoded anew, all distinct words of a slice at once. Pieces, words and
proposed tokens are found by 64-bit hashes and confirmed by their bytes. Tokens of more than PROPOSED
letters are never proposed and words of more than LONG bytes are merged at once, with the same results.

Defined results: null and empty texts have no ids; the decoded text of no ids is
empty; strings of the special tokens become their ids, as the library does.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from ._spark import arrow_type, ship
from ._text import MULT, U64, Words, mix, power_pair, ragged, random_table, slices, strings, table_of

#: Pieces kept by a worker, and the longest of them; pairs kept; the longest word merged in rounds; the longest proposed token.
CACHE, SHORT, PAIRS, LONG, PROPOSED = 1 << 18, 32, 1 << 20, 64, 16
END = "\ue000"  # stands for the end-of-word suffix, as one character
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
NOT_PLAIN = re.compile("[\x1c-\x1f\u0250-\U0010ffff]")
#: Pieces lie between ASCII white space, across which nothing here depends on anything.
LUT, VALUES = table_of(lambda b: b != 32 and not 9 <= b <= 13, seed=3)
#: For slices in which a special token may stand, whose case matters.
CASED, CASED_VALUES = table_of(lambda b: b != 32 and not 9 <= b <= 13, seed=4, lower=False)
#: Classes of bytes: 1 letters, 2 digits, 3 others; ODD bytes need the general way: controls, the
#: apostrophe, the opening bracket of special tokens, and all beyond U+00FF and Latin-1 signs.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
KIND = np.array([1 if 97 <= b <= 122 or b >= 128 else 2 if 48 <= b <= 57 else 3 for b in range(256)], np.uint8)
ODD = np.array([b < 32 or b in (39, 60, 127, 0xC2) or b > 0xC3 for b in range(256)])
SPECIAL = "\ue001"  # before a special token, as a key among words


@lru_cache(maxsize=1)
def byte_letters() -> list[str]:
    """The letter of each byte in byte-level vocabularies: printable Latin-1 stands for
    itself, the others follow from U+0100 in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


class Table:
    """Open-addressed map from non-zero 64-bit keys to integers, filled and searched by arrays."""

    def __init__(self, room: int):
        self.bits = max(4, (4 * room - 1).bit_length())
        self.keys, self.values = np.zeros(1 << self.bits, U64), np.full(1 << self.bits, -1, np.int32)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) >> U64(64 - self.bits)).astype(np.int64)

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Adds distinct keys that are not yet there."""
        slot = self.slot(keys)
        while len(keys):
            _, one = np.unique(slot, return_index=True)
            one = one[self.keys[slot[one]] == 0]
            self.keys[slot[one]], self.values[slot[one]] = keys[one], values[one]
            rest = np.ones(len(keys), bool)
            rest[one] = False
            keys, values, slot = keys[rest], values[rest], (slot[rest] + 1) & (len(self.keys) - 1)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 where there is none."""
        slot = self.slot(keys)
        at = self.keys[slot]
        out = np.where(at == keys, self.values[slot], -1)
        rest = np.flatnonzero((at != keys) & (at != 0))
        while len(rest):
            slot[rest] = (slot[rest] + 1) & (len(self.keys) - 1)
            at = self.keys[slot[rest]]
            hit = at == keys[rest]
            out[rest[hit]] = self.values[slot[rest[hit]]]
            rest = rest[~hit & (at != 0)]
        return out


def table_from(keys: np.ndarray, values: np.ndarray) -> Table:
    t = Table(len(keys))
    t.put(keys, values)
    return t


class Lists:
    """Numbered lists of integers in one growing array."""

    def __init__(self, kind: str):
        self.flat, self.off = np.zeros(1 << 16, kind), np.zeros(1 << 14, np.int64)
        self.n = 0

    def extend(self, flat: np.ndarray, size: np.ndarray) -> None:
        used, k = self.off[self.n], len(size)
        while len(self.flat) < used + len(flat):
            self.flat = np.append(self.flat, np.zeros_like(self.flat))
        while len(self.off) < self.n + k + 1:
            self.off = np.append(self.off, np.zeros_like(self.off))
        self.flat[used : used + len(flat)] = flat
        self.off[self.n + 1 : self.n + k + 1] = used + np.cumsum(size)
        self.n += k

    def get(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists one after another, and their lengths."""
        size = self.off[which + 1] - self.off[which]
        return self.flat[ragged(self.off[which], size)], size


class Bpe:
    """Encodes as the tokenizers library does for a lower-casing byte-level BPE with word ends."""

    def __init__(self, path: str):
        spec = json.loads(open(path, encoding="utf-8").read())
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or model["end_of_word_suffix"] != "</w>" or model.get("ignore_merges"):
            raise ValueError("this encoder is for lower-casing BPE with word ends")
        self.library = Tokenizer.from_file(path)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.vocab = {(k[:-4] + END if k.endswith("</w>") else k): v for k, v in model["vocab"].items()}
        self.ranks = {}
        for r, m in enumerate(model["merges"]):
            a, b = (x[:-4] + END if x.endswith("</w>") else x for x in (m if isinstance(m, list) else m.split(" ")))
            self.ranks[a, b] = r
        self.longest = min(PROPOSED, max(map(len, self.vocab)))
        self.text = {v: k for k, v in self.vocab.items()}
        self.names = {v: k.encode() for k, v in model["vocab"].items()} | {v: k.encode() for k, v in self.special.items()}
        letters = byte_letters()
        self.bytes = {c: b for b, c in enumerate(letters)} | {END: 256}
        #: Tokens that merging their own characters does not give cannot be proposed.
        own = [(k, v) for k, v in self.vocab.items() if len(k) <= self.longest and (len(self.symbols(k)) == 1 or self.merged(k) == [v])]
        codes = random_table(11, 257)
        self.codes = codes
        sums = []
        for k, _ in own:
            h = 0
            for i, c in enumerate(k):
                h += int(codes[self.bytes[c]]) * pow(MULT, i, 1 << 64)
            sums.append(h & ((1 << 64) - 1) | 1 << 63)
        self.tokens = table_from(np.array(sums, U64), np.array([v for _, v in own]))
        self.token_codes = np.full((max(self.vocab.values()) + 1, self.longest), -1, np.int16)
        for k, v in own:
            self.token_codes[v, : len(k)] = [self.bytes[c] for c in k]
        rank = [(self.vocab[a], self.vocab[b], self.vocab[a + b], r) for (a, b), r in self.ranks.items()]
        a, b, into, r = (np.array(x, np.int64) for x in zip(*rank, strict=True))
        self.merges = table_from(pair_key(a, b), r)
        self.into = np.zeros(len(self.ranks), np.int64)
        self.into[r] = into
        self.first = np.array([self.vocab[c] for c in letters])
        self.final = np.array([self.vocab[c + END] for c in letters])
        self.pair_keys, self.pair_ok = np.zeros(0, U64), np.zeros(0, bool)
        self.known, self.lists = Table(CACHE), Lists("<u4")
        self.kept_words, self.kept_size = np.zeros((CACHE, SHORT // 8), U64), np.zeros(CACHE, np.uint8)
        order = [self.names.get(i, b"") + b" " for i in range(max(self.names) + 1)]
        self.spelt = Lists("u1")
        self.spelt.extend(np.frombuffer(b"".join(order), np.uint8), np.array([len(x) for x in order]))
        self.counts = {"words": 0, "merged": 0}

    @staticmethod
    def symbols(word: str) -> list[str]:
        return [*word[:-2], word[-2:]] if word.endswith(END) else [*word]

    def merged(self, word: str) -> list[int]:
        """Exact merging of one word in byte letters: always the leftmost pair of the lowest rank."""
        s = self.symbols(word)
        n = len(s)
        after, before, ranks = list(range(1, n + 1)), list(range(-1, n - 1)), self.ranks
        heap = [(r, i, s[i], s[i + 1]) for i in range(n - 1) if (r := ranks.get((s[i], s[i + 1]))) is not None]
        heapify(heap)
        while heap:
            _, i, a, b = heappop(heap)
            j = after[i]
            if j >= n or s[i] != a or s[j] != b:
                continue
            s[i], s[j], after[i] = a + b, "", after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := ranks.get((s[i], s[after[i]]))) is not None:
                    heappush(heap, (r, i, s[i], s[after[i]]))
            if (k := before[i]) >= 0 and (r := ranks.get((s[k], s[i]))) is not None:
                heappush(heap, (r, k, s[k], s[i]))
        return [self.vocab[x] for x in s if x]

    def merged_all(self, sym: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many short words, given as token ids of their single symbols.

        One round merges the leftmost pair of the lowest rank in every word that has
        one. Returns the ids, word by word, and their numbers.
        """
        n, none = len(size), np.int64(1 << 40)
        out, word = [], np.repeat(np.arange(n), size)
        last = np.zeros(len(sym), bool)
        last[np.cumsum(size) - 1] = True
        rank = np.full(len(sym), none)

        def put(at: np.ndarray) -> None:
            r = self.merges.get(pair_key(sym[at], sym[at + 1]))
            rank[at] = np.where(r < 0, none, r)

        put(np.flatnonzero(~last))
        while len(sym):
            start = np.flatnonzero(np.concatenate([[True], last[:-1]]))
            low = np.minimum.reduceat(rank, start)
            length = np.diff(np.append(start, len(sym)))
            done = np.repeat(low == none, length)
            if done.any():
                out.append((word[done], sym[done]))
                sym, word, last, rank = (x[~done] for x in (sym, word, last, rank))
                if not len(sym):
                    break
                length, low = length[low != none], low[low != none]
                start = np.cumsum(length) - length
            hits = np.flatnonzero(rank == np.repeat(low, length))
            at = hits[np.concatenate([[True], word[hits[1:]] != word[hits[:-1]]])]
            sym[at] = self.into[rank[at]]
            last[at] = last[at + 1]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))
            sym, word, last, rank = (x[keep] for x in (sym, word, last, rank))
            rank[at[last[at]]] = none
            put(at[~last[at]])
            before = at[at > 0] - 1
            put(before[~last[before]])
        word, sym = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (word, sym)
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=n)

    def proposals(self, code: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match of many words at once; 0 tokens for words where it gets stuck.

        code: the words' bytes, each word with 256 at its end.
        """
        up, down = power_pair(len(code) + 1)
        total = np.concatenate([np.zeros(1, U64), np.cumsum(self.codes[code] * up[: len(code)])])
        end = start + size
        who, pos = np.arange(len(start)), start.copy()
        found = []
        stuck = np.zeros(len(start), bool)
        while len(who):
            token, took = np.full(len(who), -1, np.int64), np.zeros(len(who), np.int64)
            open_ = np.arange(len(who))
            for k in range(self.longest, 0, -1):
                fits = open_[pos[open_] + k <= end[who[open_]]]
                p = pos[fits]
                t = self.tokens.get((total[p + k] - total[p]) * down[p] | U64(1 << 63))
                some = np.flatnonzero(t >= 0)
                hit = np.zeros(len(t), bool)
                hit[some] = (self.token_codes[t[some], :k] == code[p[some][:, None] + np.arange(k)]).all(1)
                token[fits[hit]], took[fits[hit]] = t[hit], k
                open_ = open_[token[open_] < 0]
                if not len(open_):
                    break
            ok = token >= 0
            stuck[who[~ok]] = True
            found.append((who[ok], token[ok]))
            who, pos = who[ok], pos[ok] + took[ok]
            on = pos < end[who]
            who, pos = who[on], pos[on]
        who, token = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (who, pos)
        order = np.argsort(who, kind="stable")
        who, token = who[order], token[order]
        token, who = token[~stuck[who]], who[~stuck[who]]
        return token, np.bincount(who, minlength=len(start))

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether exact merging of the two tokens' characters gives just these two tokens."""
        keys = pair_key(a, b)
        if not len(keys):
            return np.zeros(0, bool)
        distinct, back = np.unique(keys, return_inverse=True)
        at = np.searchsorted(self.pair_keys, distinct)
        near = np.minimum(at, max(0, len(self.pair_keys) - 1))
        new = distinct[self.pair_keys[near] != distinct] if len(self.pair_keys) else distinct
        if len(new):
            ok = np.array([self.pair(k >> 20, k & 0xFFFFF) for k in (new & U64((1 << 40) - 1)).tolist()], bool)
            put = np.searchsorted(self.pair_keys, new)
            self.pair_keys, self.pair_ok = np.insert(self.pair_keys, put, new), np.insert(self.pair_ok, put, ok)
        out = self.pair_ok[np.searchsorted(self.pair_keys, distinct)][back]
        if len(self.pair_keys) > PAIRS:
            self.pair_keys, self.pair_ok = np.zeros(0, U64), np.zeros(0, bool)
        return out

    def pair(self, a: int, b: int) -> bool:
        return self.merged(self.text[a] + self.text[b]) == [a, b]

    def words(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, given as their bytes one after another, and their numbers."""
        begin = np.cumsum(size) - size
        who, found = [], []
        for k in np.flatnonzero(size > LONG).tolist():
            letters = byte_letters()
            ids = self.merged("".join([letters[b] for b in data[begin[k] : begin[k] + size[k]].tolist()]) + END)
            who.append(np.full(len(ids), k))
            found.append(np.array(ids))
        short = np.flatnonzero(size <= LONG)
        if len(short):
            n = size[short]
            data = data[ragged(begin[short], n)] if len(short) < len(size) else data
            at = np.cumsum(n) - n
            code = np.full(len(data) + len(n), 256, np.int64)
            start = at + np.arange(len(n))
            code[ragged(start, n)] = data
            with np.errstate(over="ignore"):
                token, many = self.proposals(code, start, n + 1)
            bad = many == 0
            ends = np.cumsum(many)
            inner = np.ones(len(token), bool)
            inner[ends[~bad] - 1] = False
            inner = np.flatnonzero(inner)
            ok = self.compatible(token[inner], token[inner + 1])
            bad[np.searchsorted(ends, inner[~ok], side="right")] = True
            again = np.flatnonzero(bad)
            if len(again):
                sym = self.first[data[ragged(at[again], n[again])]]
                sym[np.cumsum(n[again]) - 1] = self.final[data[at[again] + n[again] - 1]]
                ids, m = self.merged_all(sym, n[again])
                who.append(np.repeat(short[again], m))
                found.append(ids)
            of = np.repeat(np.arange(len(short)), many)
            who.append(short[of[~bad[of]]])
            found.append(token[~bad[of]])
            self.counts["words"] += len(short)
            self.counts["merged"] += len(again)
        who, ids = np.concatenate(who), np.concatenate(found)
        return ids[np.argsort(who, kind="stable")].astype("<u4"), np.bincount(who, minlength=len(size))

    def pieces(self, text: str) -> list[str]:
        """A text, normalised as the library does, cut at white space, or into words that end
        with END, and its special tokens."""
        if self.specials and self.specials.search(text):
            return [w for x in self.specials.split(text) if x for w in ([SPECIAL + x] if x in self.special else self.pieces(x))]
        if not NOT_PLAIN.search(text):
            if not text.isascii() and not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.lower()
            if text.isascii() or not NOT_PLAIN.search(text):
                return text.split()
        text = self.library.normalizer.normalize_str(text)
        return [bytes(self.bytes[c] for c in w).decode() + END for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def plain(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of ASCII without apostrophes and Latin-1 letters, cut into words
        by whole-array steps: runs of letters, single digits, runs of others."""
        low = LOWER[data]
        second = np.flatnonzero(data == 0xC3) + 1
        low[second] += np.where((data[second] < 0x9F) & (data[second] != 0x97), 32, 0).astype(np.uint8)
        kind = KIND[low]
        begin = np.ones(len(low), bool)
        begin[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        begin[off[:-1]] = True
        start = np.flatnonzero(begin)
        size = np.diff(np.append(start, len(low)))
        up, down = power_pair(len(low))
        with np.errstate(over="ignore"):
            h = mix(np.add.reduceat(self.codes[low] * up[: len(low)], start) * down[start])
        one, back = distinct(h, low, start, size)
        ids, n = self.words(low[ragged(start[one], size[one])], size[one])
        at = np.cumsum(n) - n
        total = np.concatenate([[0], np.cumsum(n[back])])
        return ids[ragged(at[back], n[back])], np.diff(total[np.searchsorted(start, off)])

    def spans(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the distinct pieces at these bounds, one after another, and their numbers."""
        size = end - start
        text = data[ragged(start, size)]
        off = np.concatenate([[0], np.cumsum(size)])
        odd = ODD[text]
        odd[1:] |= (text[:-1] == 0xC3) & ((text[1:] == 0x97) | (text[1:] == 0xB7))
        odd = np.add.reduceat(odd, off[:-1], dtype=np.int64) > 0
        easy, hard = np.flatnonzero(~odd), np.flatnonzero(odd)
        who, found = [], []
        if len(easy):
            ids, n = self.plain(text[ragged(off[easy], size[easy])], np.concatenate([[0], np.cumsum(size[easy])]))
            who.append(np.repeat(easy, n))
            found.append(ids)
        if len(hard):
            raw = text.tobytes()
            fine = [self.pieces(raw[a:b].decode()) for a, b in zip(off[hard].tolist(), off[hard + 1].tolist(), strict=True)]
            parts = [[w] if w[0] == SPECIAL else [w[:-1]] if w[-1] == END else SPLIT.findall(w) for x in fine for w in x]
            words = list({w for x in parts for w in x if w[0] != SPECIAL})
            spelt = [w.encode() for w in words]
            of = {SPECIAL + t: np.array([i], "<u4") for t, i in self.special.items()}
            if words:
                ids, n = self.words(np.frombuffer(b"".join(spelt), np.uint8), np.array([len(x) for x in spelt]))
                of |= zip(words, np.split(ids, np.cumsum(n)[:-1]), strict=True)
            piece = np.repeat(hard, [len(x) for x in fine]).tolist()
            got = [(k, of[w]) for k, x in zip(piece, parts, strict=True) for w in x]
            who += [np.full(len(x), k) for k, x in got]
            found += [x for _, x in got]
        if not who:
            return np.zeros(0, "<u4"), np.zeros(len(size), np.int64)
        who, ids = np.concatenate(who), np.concatenate(found)
        return ids[np.argsort(who, kind="stable")].astype("<u4"), np.bincount(who, minlength=len(size))

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the rows of a slice, one row after another, and their numbers."""
        raw = data.tobytes()
        special = any(t.encode() in raw for t in self.special)
        w = Words(data, off, CASED, CASED_VALUES) if special else Words(data, off, LUT, VALUES)
        keys = w.h | U64(1 << 63)
        which = self.known.get(keys).astype(np.int64)
        length = w.end - w.start
        words = short_words(w.bytes, w.start, length)
        which[~self.same(which, words, length)] = -1
        lack = np.flatnonzero(which < 0)
        kept = self.lists.n
        if len(lack):
            one, back = distinct(keys[lack], w.bytes, w.start[lack], length[lack])
            at = lack[one]
            flat, size = self.spans(data, w.start[at], w.end[at])
            self.lists.extend(flat, size)
            which[lack] = kept + back
        ids, size = self.lists.get(which)
        total = np.concatenate([[0], np.cumsum(size)])
        if len(lack):
            room = max(0, CACHE - kept)
            short = np.flatnonzero(length[at] <= SHORT)
            _, first = np.unique(keys[at[short]], return_index=True)  # of pieces with one hash one can be kept
            short = short[np.sort(first)]
            short = short[self.known.get(keys[at[short]]) < 0][:room]
            flat, size = self.lists.get(kept + short)
            self.lists.n = kept
            self.lists.extend(flat, size)
            self.known.put(keys[at[short]], kept + np.arange(len(short)))
            self.kept_size[kept : kept + len(short)] = length[at[short]]
            for k, x in enumerate(words):
                self.kept_words[kept : kept + len(short), k] = x[at[short]]
        return ids, np.diff(total[w.first])

    def same(self, which: np.ndarray, words: list[np.ndarray], length: np.ndarray) -> np.ndarray:
        """Whether the kept pieces have these bytes; words: as of short_words. True where which is -1."""
        ok = (which < 0) | (self.kept_size[which] == length) & (self.kept_words[which, 0] == words[0])
        for k in range(1, len(words)):
            long_ = np.flatnonzero((length > 8 * k) & (which >= 0))
            if not len(long_):
                break
            ok[long_] &= self.kept_words[which[long_], k] == words[k][long_]
        return ok

    def decode(self, ids: np.ndarray, count: np.ndarray) -> list[bytes]:
        """UTF-8 text of each run of ids: this vocabulary has no decoder, so it is the
        tokens' names with a space between."""
        text, size = self.spelt.get(ids.astype(np.int64))
        end = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(count)])]
        raw = text.tobytes()
        return [raw[a : b - 1] if b > a else b"" for a, b in zip(end[:-1].tolist(), end[1:].tolist(), strict=True)]


def short_words(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
    """The first SHORT bytes from each start, as numbers of 8 bytes each, 0 beyond the length."""
    padded = np.concatenate([data, np.zeros(SHORT, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    out = []
    for k in range(SHORT // 8):
        x = np.zeros(len(start), U64)
        some = np.flatnonzero(length > 8 * k)
        if len(some):
            left = np.minimum(8, length[some] - 8 * k).astype(U64)
            x[some] = eight[start[some] + 8 * k] & (U64(0xFFFFFFFFFFFFFFFF) >> (U64(64) - U64(8) * left))
        out.append(x)
    return out


def distinct(h: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of distinct strings, the number of each string among them). Strings are found by
    their hashes h; one whose bytes differ from those of the first with its hash is its own."""
    _, one, back = np.unique(h, return_index=True, return_inverse=True)
    first = one[back]
    bad = size != size[first]
    again = np.flatnonzero(~bad & (first != np.arange(len(h))))
    if len(again):
        n = size[again]
        differ = data[ragged(start[again], n)] != data[ragged(start[first[again]], n)]
        bad[again] = np.add.reduceat(differ, np.cumsum(n) - n) > 0
    odd = np.flatnonzero(bad)
    back = back.copy()
    back[odd] = len(one) + np.arange(len(odd))
    return np.concatenate([one, odd]), back


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(U64) << U64(20)) | b.astype(U64) | U64(1 << 41)


@lru_cache(maxsize=2)
def encoder(path: str) -> Bpe:
    return Bpe(path)


def encoded(batch: pa.RecordBatch, path: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, ids, their number in each row) of slices of a batch."""
    bpe = encoder(path)
    data, off = strings(batch.column("text"))
    for i, j, part, bounds in slices(data, off, keep=True):
        yield i, j, *bpe.encode(part, bounds)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """All columns of docs and ids: array<int>, which replaces a column of that name."""
    ship(docs.sparkSession)
    schema = T.StructType([*(f for f in docs.schema if f.name != "ids"), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, ids, count in encoded(b, path):
                off = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                new = pa.ListArray.from_arrays(pa.array(off), pa.array(ids.astype(np.int32)))
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([new.cast(f.type) if f.name == "ids" else part.column(f.name) for f in arrow], schema=arrow)

    return docs.mapInArrow(run, schema)


def tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array<int>), n_tokens, ids_sha256, decoded_sha256 of every document."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    schema = pa.schema([("doc_id", arrow_type(docs, "doc_id")), ("ids", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for b in batches:
            for i, j, ids, count in encoded(b, path):
                off = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(off, pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), lists.cast(schema.field("ids").type), pa.array(count, pa.int64()), *sha256s(bpe, ids, count)], schema=schema)

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string")


def sha256s(bpe: Bpe, ids: np.ndarray, count: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Digests of each row's ids, as 32-bit integers, and of its decoded text."""
    raw, end = ids.astype("<u4").tobytes(), (np.cumsum(count) * 4).tolist()
    a = [hashlib.sha256(raw[s:e]).hexdigest() for s, e in zip([0, *end], end, strict=False)]
    return pa.array(a, pa.string()), pa.array([hashlib.sha256(x).hexdigest() for x in bpe.decode(ids, count)], pa.string())


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes, decodes the ids, and digests both."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    schema = pa.schema([("doc_id", arrow_type(docs, "doc_id")), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for b in batches:
            for i, j, ids, count in encoded(b, path):
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), pa.array(count, pa.int64()), *sha256s(bpe, ids, count)], schema=schema)

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
