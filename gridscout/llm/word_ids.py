"""Token ids of Arrow text batches by a tokenizer whose ids are those of parts of words.

The tokenizer drops white space, never joins over it, and splits words into parts (runs of letters, single
digits, runs of other characters) before it looks anything up; so the ids of a part are the same wherever it
stands. Parts are found and looked up with numpy; only parts that are new go to the tokenizer.
"""

from __future__ import annotations

import os

import numpy as np

from gridscout.llm import words as W

MOST_UNITS = 1_000_000  # parts and words that a worker remembers
JOINED = 500  # parts that go to the tokenizer in one text
LETTER, DIGIT, OTHER = 0, 1, 2


def _code_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lower case, class, plain) of the characters below U+0180: printable ASCII and Latin letters. A plain character
    is its own NFC form and has one lower-case form below U+0180 as well; U+0130 has not."""
    lower, kind, plain = np.arange(0x180), np.full(0x180, OTHER, np.uint8), np.zeros(0x180, bool)
    for code in [*range(0x21, 0x7F), *range(0xC0, 0x180)]:
        if code == 0x130:
            continue
        low = chr(code).lower()
        lower[code], plain[code] = ord(low), True
        kind[code] = DIGIT if low in "0123456789" else LETTER if low.isalpha() else OTHER
    plain[ord("'")] = False  # begins parts of its own, as 's
    return lower, kind, plain


_LOWER, _KIND, _PLAIN = _code_tables()


class WordIds:
    """Units, which are parts of plain words or other whole words, with their ids.

    A unit is found by its 64-bit hash and counts only if its bytes are the same.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.ends = np.zeros(self.model.get_vocab_size(), bool)
        for token, i in self.model.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, W.U64)  # sorted; self.place is the unit of each
        self.place = np.zeros(0, np.int64)
        self.text, self.text_at = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.ids, self.ids_at = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, the n + 1 places where those of a row begin)."""
        text, starts, ends, whole = units(data, offsets)
        if not len(starts):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        hashes = W.hash_words(text, starts, ends)
        hashes[whole] = ~hashes[whole]
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        known = self._find(distinct, text, starts[first], ends[first])
        if (known < 0).any():
            if len(self.keys) + int((known < 0).sum()) > MOST_UNITS:
                self.forget()
                known[:] = -1
            new = np.flatnonzero(known < 0)
            some = first[new]
            self._learn(distinct[new], text, starts[some], ends[some], whole[some])
            known = self._find(distinct, text, starts[first], ends[first])
        unit = known[which]
        same = _equal(text, starts, ends, self.text, self.text_at[unit], self.text_at[unit + 1])
        if (known < 0).any() or not same.all():  # two units of one hash: all words of this slice by the tokenizer itself
            return self._plainly(data, offsets)
        n = self.ids_at[unit + 1] - self.ids_at[unit]
        bounds = np.concatenate([[0], np.cumsum(n)])
        return self.ids[_runs(self.ids_at[unit], n)], bounds[np.searchsorted(starts, offsets)]

    def _find(self, hashes: np.ndarray, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The unit of each hash, -1 where there is none."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.place[at], -1)

    def _learn(self, hashes: np.ndarray, text: np.ndarray, starts: np.ndarray, ends: np.ndarray, whole: np.ndarray) -> None:
        """New units: parts are joined by blanks and come back apart at the tokens that end a part."""
        ids, sizes = [], np.zeros(len(starts), np.int64)
        parts = np.flatnonzero(~whole)
        lengths = ends - starts
        for i in range(0, len(parts), JOINED):
            some = parts[i : i + JOINED]
            blanked = np.full(int(lengths[some].sum()) + len(some), 0x20, np.uint8)
            blanked[_runs(np.cumsum(lengths[some] + 1) - lengths[some] - 1, lengths[some])] = text[_runs(starts[some], lengths[some])]
            found = np.array(self.model.encode(blanked.tobytes().decode(), add_special_tokens=False).ids, "<u4")
            ids.append(found)
            sizes[some] = np.diff(np.concatenate([[0], np.flatnonzero(self.ends[found]) + 1]))
        others = np.flatnonzero(whole)
        for i in range(0, len(others), 10_000):
            some = others[i : i + 10_000]
            strings = [text[starts[j] : ends[j]].tobytes().decode() for j in some]
            for j, x in zip(some, self.model.encode_batch_fast(strings, add_special_tokens=False), strict=True):
                ids.append(np.array(x.ids, "<u4"))
                sizes[j] = len(x.ids)
        order = np.concatenate([parts, others])
        base = len(self.ids_at) - 1
        self.text = np.concatenate([self.text, text[_runs(starts[order], lengths[order])]])
        self.text_at = np.concatenate([self.text_at, self.text_at[-1] + np.cumsum(lengths[order])])
        self.ids = np.concatenate([self.ids, *ids])
        self.ids_at = np.concatenate([self.ids_at, self.ids_at[-1] + np.cumsum(sizes[order])])
        keys = np.concatenate([self.keys, hashes[order]])
        place = np.concatenate([self.place, base + np.arange(len(order))])
        by_key = np.argsort(keys, kind="stable")
        self.keys, self.place = keys[by_key], place[by_key]

    def _plainly(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts = [data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:], strict=False)]
        found = [np.array(x.ids, "<u4") for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, "<u4"), *found]), np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of the runs, one run after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def _equal(a: np.ndarray, a_starts, a_ends, b: np.ndarray, b_starts, b_ends) -> np.ndarray:
    """Whether the stretches of a and b are the same, one by one."""
    n = a_ends - a_starts
    same = n == b_ends - b_starts
    if not same.all():
        return same
    differ = a[_runs(a_starts, n)] != b[_runs(b_starts, n)]
    counts = np.concatenate([[0], np.cumsum(differ)])
    ends = np.cumsum(n)
    return counts[ends] == counts[ends - n]


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, starts, ends, whole): the units in text order. Words of plain characters are lower-cased and cut into
    parts; any other word, with an apostrophe, a special token or further characters, is a unit as it stands."""
    starts, ends, _ = W.find_words(data, offsets)
    text = data.copy()
    if not len(starts):
        return text, starts, ends, np.zeros(0, bool)
    follows = (data & 0xC0) == 0x80
    code = data.astype(np.int32)
    wide = np.flatnonzero((data >= 0xC3) & (data <= 0xC5))  # leads of two-byte characters from U+00C0 to U+017F
    code[wide] = (code[wide] & 0x1F) << 6 | (code[wide + 1] & 0x3F)
    known = code < 0x180
    known[(data >= 0x80) & ~follows] = False
    known[wide] = True
    code[~known] = 0
    plain = _PLAIN[code]
    plain[wide + 1] = plain[wide]  # and other continuation bytes are none
    plain[:-1] &= ~((data[:-1] == ord("<")) & (data[1:] == ord("|")))
    bad = np.concatenate([[0], np.cumsum(~plain)])
    whole = bad[ends] > bad[starts]
    kind = _KIND[code]
    kind[wide + 1] = kind[wide]
    low = _LOWER[code].astype(np.int32)
    single = ~follows
    single[wide] = False
    narrow = np.flatnonzero(single & plain)
    inside = np.zeros(len(data), bool)  # bytes of plain words
    change = np.zeros(len(data) + 1, np.int32)
    change[starts[~whole]] += 1
    change[ends[~whole]] -= 1
    inside = np.cumsum(change[:-1]) > 0
    narrow = narrow[inside[narrow]]
    text[narrow] = low[narrow]
    wide = wide[inside[wide]]
    text[wide], text[wide + 1] = 0xC0 | low[wide] >> 6, 0x80 | low[wide] & 0x3F
    cut = np.zeros(len(data), bool)
    cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    cut &= inside & ~follows
    cut[starts] = True
    begin = np.flatnonzero(cut)
    end = np.empty_like(begin)
    end[:-1] = begin[1:]
    of_word = np.searchsorted(starts, begin, "right") - 1
    end[-1:] = ends[-1:]
    end = np.minimum(end, ends[of_word])
    return text, begin, end, whole[of_word]


_loaded: dict[str, WordIds] = {}  # the files are read once by a worker, and what it has learnt stays with it


def word_ids(tokenizer: str) -> WordIds:
    if tokenizer not in _loaded:
        _loaded[tokenizer] = WordIds(tokenizer)
    return _loaded[tokenizer]
