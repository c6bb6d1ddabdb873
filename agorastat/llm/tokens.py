"""Token ids by the public vocabularies, with the words of a task remembered."""

from __future__ import annotations

import array
import functools
import re
import sys

import pyarrow as pa

from agorastat.llm.common import word_codes

KNOWN_WORDS = 250_000  # remembered words of one worker; older ones are looked up anew and results stay the same
LONG_WORD = 64  # longer words are not remembered

# Letters, digits and signs of Latin-1 whose class, case and composition are plain; other words take the long way.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]*\Z")
_PARTS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^a-zß-öø-ÿ0-9]+")


def _byte_letters() -> dict[int, int]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next code point from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return dict(zip(shown, shown)) | {b: 256 + n for n, b in enumerate(hidden)}


def _packed(ids: list[int]) -> bytes:
    packed = array.array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class _Memory(dict):
    """A dictionary that asks ``find`` for unknown words and remembers the answers.

    When it is full it becomes the older half, in which words that come again are found.
    """

    def __init__(self, find):
        super().__init__()
        self.find, self.older = find, {}

    def __missing__(self, word):
        ids = self.older.get(word)
        if ids is None:
            ids = self.find(word)
        if len(word) <= LONG_WORD:
            if len(self) >= KNOWN_WORDS // 2:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class WordIds:
    """Ids of texts, for a vocabulary that drops white space and case.

    The tokenizer splits at white space and treats each word alone, so the ids of a
    text are those of its words in order. Words of plain Latin-1 letters are split by
    the vocabulary's own rule and go to its merge table; any other word goes through
    the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.parts = _Memory(self._part)
        self.words = _Memory(self._word)

    def _part(self, part: str) -> bytes:
        spelled = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        return _packed([t.id for t in self.whole.model.tokenize(spelled)])

    def _word(self, word: str) -> bytes:
        if _PLAIN.match(word) and "<|" not in word:
            return b"".join(map(self.parts.__getitem__, _PARTS.findall(word.lower())))
        return _packed(self.whole.encode(word, add_special_tokens=False).ids)

    def texts_ids(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as little-endian uint32."""
        starts, codes, words = word_codes(texts)
        found = list(map(self.words.__getitem__, words.to_pylist()))
        ids, places = list(map(found.__getitem__, codes.tolist())), starts.tolist()
        return [b"".join(ids[i:j]) for i, j in zip(places, places[1:])]


@functools.lru_cache(maxsize=4)
def word_ids(path: str) -> WordIds:
    """One per worker and vocabulary."""
    return WordIds(path)


def public_path(name: str) -> str:
    """Where a public vocabulary lies on this machine; called in the tasks."""
    import public_tokenizers

    return public_tokenizers.path(name)
