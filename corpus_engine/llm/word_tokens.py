"""Token ids of whole texts by a public tokenizer file, encoded word by word.

The tokenizer splits at white space and never joins across it, so the ids of a text are those of its
words in turn. Most words of a corpus have been seen before; their ids come from a bounded cache,
and only new words go to the library, many in one call.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

CACHE_WORDS = 450_000  # of a generation; two are kept, so words in use outlive a full cache
ENCODE_AT_ONCE = 256
END_ID = 1
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
# Letters below this code point keep their category and number under NFC and lower-casing, but for one.
PLAIN_LETTERS_BELOW = "ɐ"
UNSTABLE_LETTER = "İ"


def _plain(text: str) -> bool:
    return text.isalpha() and max(text) < PLAIN_LETTERS_BELOW and UNSTABLE_LETTER not in text


class WordEncoder:
    """Ids of texts as little-endian unsigned 16-bit bytes (the vocabulary must have at most 65,536 entries)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        if max(vocabulary.values()) > 0xFFFF:
            raise ValueError("ids beyond 16 bits")
        self.ends_word = np.zeros(0x10000, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, body: bytes | None) -> bytes:
        """Ids of the text's words, without an end id; null has none."""
        if not body:
            return b""
        # The tokenizer lower-cases what it reads, except the text of a special token.
        words = body.split() if b"<|" in body else body.lower().split()
        known = self.cache
        ids = list(map(known.get, words))
        if None in ids:
            gaps = [i for i, found in enumerate(ids) if found is None]
            missing = {words[i] for i in gaps}
            if len(known) + len(missing) > CACHE_WORDS:
                known, self.older = {}, known
                self.cache = known
            if self.older:
                found = {w: old for w in missing if (old := self.older.get(w)) is not None}
                known.update(found)
                missing -= found.keys()
            self._learn(missing, known)
            for i in gaps:
                ids[i] = known[words[i]]
        return b"".join(ids)

    def _learn(self, words: set[bytes], known: dict[bytes, bytes]) -> None:
        plain, cores, odd, older = [], {}, [], self.older
        for w in words:
            core = w.rstrip(PUNCTUATION)
            tail = w[len(core):]
            # Letters and what follows them but letters and digits are split before they are encoded.
            if core.isalpha() or _plain(core.decode("utf-8", "replace")):
                plain.append((w, core, tail))
                cores[core] = known.get(core) or older.get(core)
            else:
                odd.append(w)
        fresh = [c for c, ids in cores.items() if ids is None]
        for at in range(0, len(fresh), ENCODE_AT_ONCE):
            group = fresh[at:at + ENCODE_AT_ONCE]
            ids = np.array(self._ids(b" ".join(group).decode()), "<u2")
            stops = np.flatnonzero(self.ends_word[ids]) + 1
            if len(stops) != len(group):  # never seen; such a group is encoded word by word
                odd.extend(group)
                continue
            begin = 0
            for core, stop in zip(group, stops.tolist()):
                cores[core] = ids[begin:stop].tobytes()
                begin = stop
        if odd:
            found = self.tokenizer.encode_batch([w.decode("utf-8", "replace") for w in odd], add_special_tokens=False)
            for w, e in zip(odd, found):
                known[w] = np.array(e.ids, "<u2").tobytes()
        for w, core, tail in plain:
            ids = cores[core] or known[core]
            known[core] = ids  # it may come again with something else behind it
            if tail:
                known[w] = ids + self._tail(tail)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    @lru_cache(maxsize=4096)  # noqa: B019  one encoder lives as long as its worker
    def _tail(self, tail: bytes) -> bytes:
        return np.array(self._ids(tail.decode()), "<u2").tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker, so that its cache outlives a task."""
    return WordEncoder(path)


def default_tokenizer() -> str:
    """The public tokenizer file of the queries; any path may be given instead."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
