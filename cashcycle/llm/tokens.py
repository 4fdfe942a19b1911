"""Token ids of whole batches by a public tokenizer.

Words repeat, so a worker encodes a word once and looks it up afterwards. This gives
the tokenizer's own ids wherever no token spans white space, as with vocabularies that
split on it (``word_bpe_49k.json``).
"""

from __future__ import annotations

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

from cashcycle.llm.textops import mix, span_hashes, word_spans

_LETTERS_AT_ONCE = 256
_MARKS = (".", ",")
_WHOLE = np.uint64(0x5851F42D4C957F2D)  # tells whole words from runs of letters with equal bytes


def _letters(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to Latin letters (A-Z, a-z, À-Þ, ß-ÿ), and the bytes in lower case."""
    lower = buf.copy()
    upper = (buf >= 65) & (buf <= 90)
    lower[upper] += 32
    inside = (lower >= 97) & (lower <= 122)
    lead = np.flatnonzero(buf[:-1] == 0xC3)
    second = buf[lead + 1]
    there = (second >= 0x80) & (second <= 0xBF) & (second != 0x97) & (second != 0xB7)
    lead, second = lead[there], second[there]
    inside[lead] = inside[lead + 1] = True
    lower[lead + 1] += np.where(second <= 0x9E, np.uint8(32), np.uint8(0))
    return inside, lower


class WordEncoder:
    """Encodes texts word by word.

    The ids of earlier words are kept in a table of ``slots`` places, where a word takes the
    place of another one with the same slot; all are forgotten when ``kept_ids`` ids are kept.
    A worker so holds 20 bytes a slot and 4 bytes an id at most, whatever the corpus.
    """

    def __init__(self, path: str, slots: int = 1 << 20, kept_ids: int = 6_000_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.slots, self.kept_ids = slots, kept_ids
        self.closes = None
        model = self.tokenizer.model
        if getattr(model, "end_of_word_suffix", None) == "</w>":
            closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
            for token, number in self.tokenizer.get_vocab(False).items():
                closes[number] = token.endswith("</w>")
            self.plain = Tokenizer(model)
            self.plain.pre_tokenizer = pre_tokenizers.Sequence(
                [
                    pre_tokenizers.WhitespaceSplit(),
                    pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
                ]
            )
            marks = [e.ids for e in self.tokenizer.encode_batch_fast(list(_MARKS), add_special_tokens=False)]
            if all(len(ids) == 1 for ids in marks):
                self.closes = closes
                self.marks = np.array([0] + [ids[0] for ids in marks], np.uint32)
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(self.slots, np.uint64)
        self.first = np.zeros(self.slots, np.int64)  # where a word's ids begin in self.ids
        self.count = np.zeros(self.slots, np.int32)  # 0: the slot is free
        self.ids = np.empty(1 << 16, np.uint32)
        self.used = 0

    def _keys(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Each word's key, its bytes (from ``source``, up to ``ends``), whether they are a run of
        letters, and the mark behind the run.

        Latin letters with or without one mark behind them are always a run of letters, in lower
        case, and a mark for the tokenizer, so the ids are those of the two.
        """
        if self.closes is None:
            return span_hashes(buf, starts, ends), buf, ends, np.zeros(len(starts), bool), None
        inside, lower = _letters(buf)
        last = buf[ends - 1]
        mark = np.zeros(len(starts), np.int8)
        for number, sign in enumerate(_MARKS, 1):
            mark[(last == ord(sign)) & (ends - starts > 1)] = number
        others = np.concatenate([[0], np.cumsum(~inside)])
        core = ends - (mark > 0)
        plain = others[core] == others[starts]
        mark[~plain] = 0
        core = np.where(plain, core, ends)
        keys = span_hashes(lower, starts, core)
        whole = np.flatnonzero(~plain)
        if len(whole):
            keys[whole] = mix(span_hashes(buf, starts[whole], ends[whole]) ^ _WHOLE)
        return keys, lower, core, plain, mark

    def _encode_letters(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs of lower-case letters, many in one call, and how many each has: the last
        one of each is an end-of-word id."""
        if not words:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        blocks = [
            b" ".join(words[lo : lo + _LETTERS_AT_ONCE]).decode()
            for lo in range(0, len(words), _LETTERS_AT_ONCE)
        ]
        found = self.plain.encode_batch_fast(blocks, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in found])
        return ids, np.diff(np.flatnonzero(self.closes[ids]), prepend=-1)

    def _encode_whole(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if not words:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        found = self.tokenizer.encode_batch_fast(
            [w.decode("utf-8", "replace") for w in words], add_special_tokens=False
        )
        ids = [e.ids for e in found]
        count = np.array([len(x) for x in ids], np.int64)
        return np.fromiter((i for x in ids for i in x), np.uint32, int(count.sum())), count

    def _learn(self, keys: np.ndarray, words: list[bytes], plain: np.ndarray):
        """Encodes and keeps new words; returns where their ids begin and how many they are."""
        letters, rest = np.flatnonzero(plain), np.flatnonzero(~plain)
        parts = self._encode_letters([words[k] for k in letters]), self._encode_whole([words[k] for k in rest])
        count = np.empty(len(words), np.int64)
        first = np.empty(len(words), np.int64)
        for at, (ids, each) in zip((letters, rest), parts, strict=True):
            need = self.used + len(ids)
            if need > len(self.ids):
                grown = np.empty(max(need, len(self.ids) * 3 // 2), np.uint32)
                grown[: self.used] = self.ids[: self.used]
                self.ids = grown
            self.ids[self.used : need] = ids
            count[at], first[at] = each, self.used + np.cumsum(each) - each
            self.used = need
        slot = (keys % np.uint64(self.slots)).astype(np.int64)
        _, at = np.unique(slot, return_index=True)  # one word a slot
        self.keys[slot[at]], self.first[slot[at]], self.count[slot[at]] = keys[at], first[at], count[at]
        return first, count

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and each document's bounds in them."""
        if self.used > self.kept_ids:
            self._forget()
        starts, ends, documents = word_spans(buf, offsets)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        keys, source, ends, plain, mark = self._keys(buf, starts, ends)
        slot = (keys % np.uint64(self.slots)).astype(np.int64)
        first, count = self.first[slot], self.count[slot].astype(np.int64)
        new = np.flatnonzero((self.keys[slot] != keys) | (count == 0))
        if len(new):
            distinct, at, which = np.unique(keys[new], return_index=True, return_inverse=True)
            at = new[at]
            low, data = source.tobytes(), buf.tobytes()
            spans = zip(plain[at].tolist(), starts[at].tolist(), ends[at].tolist(), strict=True)
            words = [low[a:b] if p else data[a:b] for p, a, b in spans]
            begins, counts = self._learn(distinct, words, plain[at])
            first[new], count[new] = begins[which], counts[which]
        behind = mark > 0 if mark is not None else np.zeros(len(starts), bool)
        whole = count + behind
        closing = np.cumsum(whole)
        total = int(closing[-1])
        place = np.repeat(first - closing + whole, whole) + np.arange(total)
        if behind.any():
            place[closing[behind] - 1] = 0
        ids = self.ids[place]
        if behind.any():
            ids[closing[behind] - 1] = self.marks[mark[behind]]
        edges = np.concatenate([np.zeros(1, np.int64), closing])
        return ids, edges[np.searchsorted(documents, np.arange(len(offsets)))]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This worker's encoder of a vocabulary; a task finds the words of earlier ones."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def forget_encoders() -> None:
    """For a step that encodes nothing in workers that did."""
    _encoders.clear()
