"""Whole-text encoding with a tokenizers file, through a cache of words.

The vocabulary's pre-tokenizer drops white space, and none of its pieces crosses it, so the ids of a text are those of its
white-space separated words in turn. Words are encoded by the tokenizers library and kept in two generations: a word met
again moves to the younger one, and when that is full the older one is dropped, so frequent words stay. Texts that hold "<|"
(where a special token may stand) go to the library whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np

from riverlog.llm.common import kept

#: What map_arrow calls the owner of a worker's encoders.
OWNER = "tokens"
#: Words of one generation of a worker's cache; two are kept, at some 170 bytes a word.
CACHE_WORDS = 200_000
#: Characters whose words are looked at at once: what is held besides the cache does not depend on batches or texts.
PART_CHARS = 1 << 20
SPACE = re.compile(r"[ \t\n]")
TAIL = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class WordEncoder:
    """encode(text) -> ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        #: Ids that end a piece: a joined text of one-piece words is cut after them.
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self.cache_words = cache_words
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def _joined(self, words: list[bytes]) -> None:
        """Learns words of one piece each, many to a call."""
        texts = [b" ".join(words[i : i + 256]).decode() for i in range(0, len(words), 256)]
        ids = np.concatenate([np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        at = np.flatnonzero(self.ends[ids]) + 1
        if len(at) != len(words) or at[-1] != len(ids):  # some word has more pieces
            self.words.update(zip(words, self._library([w.decode() for w in words])))
            return
        raw, cuts = ids.tobytes(), [0, *(at * 4).tolist()]
        self.words.update((w, raw[cuts[i] : cuts[i + 1]]) for i, w in enumerate(words))

    def _learn(self, new: set[bytes]) -> None:
        words = self.words
        # A last run of ASCII marks after a letter is a piece of its own (an apostrophe may start a contraction).
        cut = {w: b for w in new if w[-1] in TAIL and (b := w.rstrip(TAIL)) and (97 <= b[-1] <= 122 or b[-1] > 127 and b.decode().lower().isalpha())}
        bare = {cut.get(w, w) for w in new if cut.get(w, w) not in words} | {t for w, b in cut.items() if (t := w[len(b) :]) not in words}
        letters = [w for w in bare if w.decode().isalpha()]
        rest = [w for w in bare if not w.decode().isalpha()]
        if letters:
            self._joined(letters)
        if rest:
            words.update(zip(rest, self._library([w.decode() for w in rest])))
        for w, b in cut.items():
            words[w] = words[b] + words[w[len(b) :]]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids; unknown words of neighbouring texts are learned together."""
        out, held, size = [], [], 0
        for t in texts:
            if not t or "<|" in t or len(t) > PART_CHARS:
                out += self._each(held)
                held, size = [], 0
                out.append(b"" if not t else self._library([t])[0] if "<|" in t else b"".join(b"".join(self._each([x])) for x in _cut(t)))
                continue
            if size + len(t) > PART_CHARS:
                out += self._each(held)
                held, size = [], 0
            held.append(t)
            size += len(t)
        return out + self._each(held)

    def _each(self, texts: list[str]) -> list[bytes]:
        parts = [t.encode("utf-8", "replace").lower().split() for t in texts]  # bytes.lower() changes A-Z only
        missing = set().union(*parts).difference(self.words)
        known = {w: ids for w in missing if (ids := self.older.get(w)) is not None}
        self.words.update(known)
        if missing := missing.difference(known):
            self._learn(missing)
        words = self.words
        out = [b"".join([words[w] for w in p]) for p in parts]
        if len(words) > self.cache_words:
            self.words, self.older = {}, words
        return out


def _cut(text: str) -> Iterator[str]:
    """Parts of about PART_CHARS that end before white space; one without any stays whole."""
    at = 0
    while at < len(text):
        end = SPACE.search(text, at + PART_CHARS)
        yield text[at : end.start() if end else len(text)]
        at = end.start() if end else len(text)


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a file; it stays between tasks of OWNER."""
    encoders = kept(OWNER)
    if path not in encoders:
        encoders[path] = WordEncoder(path)
    return encoders[path]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
