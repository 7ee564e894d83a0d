"""Fast exact ids of a word-end BPE tokenizer: each distinct word is encoded once.

The tokenizer drops white space and never joins across it, so a text's ids are those of
its space-separated words in order. Known words come from a bounded dictionary; the rest
are encoded by the ``tokenizers`` library, many to a call.
"""

from __future__ import annotations

import os
from operator import add

import numpy as np

#: Words held at once; the dictionary starts anew beyond this.
WORDS_HELD = 700_000
#: Words in one call of the tokenizer.
WORDS_A_CALL = 4096
#: Punctuation that never joins a letter before it into one word of the tokenizer.
TAIL = ".,!?;:#$%&*|"

_OPEN: dict[str, WordEncoder] = {}


class WordEncoder:
    """text -> ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs one task a core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocab.values()) + 3, dtype=bool)
        self.ends[[k for word, k in vocab.items() if word.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}
        self.cores: dict[str, bytes] = {"": b""}

    def _direct(self, words: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in coded]

    def _plain(self, words: list[str]) -> list[bytes]:
        """Ids of words of Latin letters only, each of which ends with its one word-end token."""
        out: list[bytes] = []
        for k in range(0, len(words), WORDS_A_CALL):
            part = words[k : k + WORDS_A_CALL]
            coded = self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0]
            ids = np.array(coded.ids, dtype="<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part):
                out += self._direct(part)
                continue
            raw, last = ids.tobytes(), 0
            for stop in (stops * 4).tolist():
                out.append(raw[last:stop])
                last = stop
        return out

    def _learn(self, words: list[str]) -> None:
        # lists side by side: a tuple a word would keep the garbage collector busy
        split: list[str] = []
        lows: list[str] = []
        tails: list[str] = []
        whole: list[str] = []
        plain: set[str] = set()
        known, cores = self.known, self.cores
        for word in words:
            core = word.rstrip(TAIL)
            low = core if core.islower() else core.lower()  # the same object is held once
            if core.isalpha() and (core.isascii() or max(low) < "ɐ" and len(low) == len(core)):
                tail = word[len(core) :]
                split.append(word)
                lows.append(low)
                tails.append(tail)
                if low not in cores:
                    plain.add(low)
                if tail not in cores:
                    cores[tail] = self._direct([tail])[0]
            else:
                whole.append(word)
        fresh = list(plain)
        cores.update(zip(fresh, self._plain(fresh)))
        of = cores.__getitem__
        known.update(zip(split, map(add, map(of, lows), map(of, tails))))
        known.update(zip(whole, self._direct(whole)))

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > WORDS_HELD or len(self.cores) > WORDS_HELD:
            self.known, self.cores = {"": b""}, {"": b""}
        split = [text.replace("\n", " ").split(" ") for text in texts]
        fresh = set()
        for words in split:
            fresh.update(words)
        fresh = fresh.difference(self.known)  # looks each one up; difference_update would go through all known words
        if fresh:
            self._learn(list(fresh))
        find = self.known.__getitem__
        return [b"".join(map(find, words)) for words in split]


def encoder(path: str) -> WordEncoder:
    """One encoder a Python worker."""
    if path not in _OPEN:
        _OPEN[path] = WordEncoder(path)
    return _OPEN[path]
