"""Subword ids of whole texts, encoding each different word once per worker.

The tokenizers used here drop white space and never join across it, so a text's ids are
those of its words in order; the tests compare with encoding whole texts. A worker keeps
the ids of the words it has met, up to ``MAX_WORDS``, and starts anew beyond that.
"""

from __future__ import annotations

import os
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from wayside.llm.spans import Words, utf8, word_hashes, words_of

MAX_WORDS = 1_000_000
#: Words are found by these leading bits of their hash, else by search.
SLOT_BITS = 21


def default_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTable:
    """Words by hash: each has a place, counted from 0 in the order they were added.

    The leading bits of a hash name a slot; words whose slot is taken are searched for.
    """

    def __init__(self):
        self.keys = np.zeros(0, np.uint64)
        self.slot = np.full(1 << SLOT_BITS, -1, np.int32)
        self.crowded = np.zeros(0, np.uint64)
        self.crowded_place = np.zeros(0, np.int32)

    def add(self, keys: np.ndarray) -> None:
        """Adds distinct words that are not in the table."""
        place = np.arange(len(self.keys), len(self.keys) + len(keys), dtype=np.int32)
        self.keys = np.concatenate([self.keys, keys])
        slot = (keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        free = self.slot[slot] < 0
        self.slot[slot[free]] = place[free]
        left = self.slot[slot] != place
        both = np.concatenate([self.crowded, keys[left]])
        order = np.argsort(both, kind="stable")
        self.crowded = both[order]
        self.crowded_place = np.concatenate([self.crowded_place, place[left]])[order]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each word, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        place = np.take(self.slot, (keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64))
        missed = np.flatnonzero(np.take(self.keys, place, mode="clip") != keys)
        if len(missed):
            place[missed] = -1
            if len(self.crowded):
                wanted = keys[missed]
                at = np.searchsorted(self.crowded, wanted).clip(0, len(self.crowded) - 1)
                found = self.crowded[at] == wanted
                place[missed[found]] = self.crowded_place[at[found]]
        return place


class Known(NamedTuple):
    """Words and ids by place, as they were at one time."""

    keys: np.ndarray
    begin: np.ndarray
    length: np.ndarray
    ids: np.ndarray


class SubwordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        probe = ["Ab", "a-b", "ab"]
        ids = [e.ids for e in self.whole.encode_batch_fast(probe, add_special_tokens=False)]
        self.lowers = ids[0] == ids[2]
        #: Words of a-z alone reach the model unchanged.
        self.plain = self.lowers and [t.id for t in self.model.tokenize("ab")] == ids[2]
        self.life = 0
        self.forget()

    def forget(self) -> None:
        """Drops all known words; places count from 0 again, and a new life begins."""
        self.table = WordTable()
        self.begin = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.int32)
        self.life += 1

    def known(self) -> Known:
        return Known(self.table.keys, self.begin, self.length, self.ids)

    @property
    def size(self) -> int:
        return self.whole.get_vocab_size(with_added_tokens=True)

    def words(self, column: pa.Array) -> Words:
        """Words in the form they are looked up in; ``<`` may start a special token, case counts there."""
        data, _ = utf8(column)
        return words_of(column, lower=self.lowers and not (data == ord("<")).any())

    def _learn(self, words: Words, at: np.ndarray, keys: np.ndarray) -> None:
        """Adds the words at these positions, whose distinct hashes are the keys."""
        lengths, flat = [], []
        for a in range(0, len(at), 20_000):
            spans = zip(words.starts[at[a : a + 20_000]].tolist(), words.ends[at[a : a + 20_000]].tolist(), strict=True)
            text = [words.data[i:j].tobytes().decode("utf-8", "replace") for i, j in spans]
            out: list[list[int]] = [[]] * len(text)
            other = []
            for i, w in enumerate(text):
                if self.plain and w.isascii() and w.isalpha() and w.islower():
                    out[i] = [t.id for t in self.model.tokenize(w)]
                else:
                    other.append(i)
            encoded = self.whole.encode_batch_fast([text[i] for i in other], add_special_tokens=False)
            for i, e in zip(other, encoded, strict=True):
                out[i] = e.ids
            lengths.append(np.array([len(o) for o in out], np.int32))
            flat.append(np.fromiter((x for o in out for x in o), np.int32, int(lengths[-1].sum())))
        length = np.concatenate(lengths)
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.ids = np.concatenate([self.ids, *flat])
        self.table.add(keys)

    def places(self, words: Words, hashes: np.ndarray) -> np.ndarray:
        """The place of every word; words not met before are encoded."""
        place = self.table.find(hashes)
        missed = np.flatnonzero(place < 0)
        if len(missed):
            keys, first = np.unique(hashes[missed], return_index=True)
            if len(self.begin) and len(self.begin) + len(keys) > MAX_WORDS:
                self.forget()
                return self.places(words, hashes)
            self._learn(words, missed[first], keys)
            place[missed] = self.table.find(hashes[missed])
        return place

    def encode(self, words: Words, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in order, and each text's offsets in them."""
        ids, at = self.encode_words(words, hashes)
        return ids, at[words.at]

    def encode_words(self, words: Words, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in order, and each word's offsets in them."""
        return self.ids_at(self.places(words, word_hashes(words) if hashes is None else hashes))

    def ids_at(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words at these places in order, and each one's offsets in them."""
        length = self.length[at].astype(np.int64)
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        source = np.repeat(self.begin[at] - (ends - length), length) + np.arange(total)
        return self.ids[source], np.concatenate([[0], ends])


@cache
def encoder(path: str) -> SubwordEncoder:
    """One for each file and worker."""
    return SubwordEncoder(path)
