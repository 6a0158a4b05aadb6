"""Token ids by a public tokenizer, one cached look-up a word.

The tokenizer drops white space and never joins pieces across it, so the ids of
a text are the ids of its white-space separated words in order.  A worker
remembers the ids of the words it has met, and asks the tokenizer only for new
ones.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import MEMORIES

#: Words a worker remembers: about 200 bytes each.
CACHE_WORDS = 800_000
#: ASCII signs, which end a run of letters or digits; a special token begins with "<".
MARKS = "!\"#$%&'()*+,-./:;=>?@[\\]^_`{|}~"
_MARKS = MARKS.encode()
#: Letters below this are single characters in every normal form.
LATIN_END = "\u0100"
#: How byte-level models spell bytes: printable ones as themselves, the others as letters from U+0100 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LETTERS = {b: 0x100 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}
#: Longer runs without white space are not remembered.
LONG_WORD = 64


class WordIds(dict):
    """word (UTF-8) -> its ids as little-endian unsigned 32-bit integers.

    When half the words are reached they become the older half, and the older half
    before them is forgotten: a word that is met again in time is never forgotten,
    the many that occur once are.
    """

    def __init__(self, path: str, words: int = CACHE_WORDS) -> None:
        super().__init__()
        self.half = words // 2
        self.older: dict[bytes, bytes] = {}
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model

    def __missing__(self, word: bytes) -> bytes:
        value = self.older.get(word)
        if value is None:
            value = self._ids(word)
        if len(word) <= LONG_WORD:
            if len(self) >= self.half:
                self.older.clear()
                self.older.update(self)
                self.clear()
            self[word] = value
        return value

    def _ids(self, word: bytes) -> bytes:
        # the tokenizer lower-cases, and cuts punctuation off a letter: the ids of a
        # plain word serve its other spellings (a special token holds "<")
        if word.isalpha():      # ASCII letters alone
            plain = word.lower()
            if plain != word:
                return self[plain]
            return array("I", [t.id for t in self.model.tokenize(plain.decode())]).tobytes()
        if word.isascii() and b"<" not in word:
            plain = word.lower()
            core = plain.rstrip(_MARKS)
            if core and core != word and core[-1:].isalnum():
                return self[core] + (self[plain[len(core):]] if len(core) < len(plain) else b"")
        text = word.decode("utf-8", "replace")
        core = text.rstrip(MARKS)
        if core.isalpha() and max(core) < LATIN_END:
            # letters alone are one piece, and these have no other normal form than
            # lower case: the model can take them without the steps before it
            lower = core.lower().encode()
            if len(core) < len(text):
                return self[lower] + self[text[len(core):].encode()]
            spelled = lower.decode("latin-1").translate(BYTE_LETTERS)
            return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


@lru_cache(maxsize=4)
def word_ids(path: str, words: int = CACHE_WORDS) -> WordIds:
    return WordIds(path, words)


#: The name of the word memory, for tasks that pass it on.
WORD_MEMORY = "word ids"
MEMORIES[WORD_MEMORY] = word_ids.cache_clear


def default_path() -> str:
    """Where the public tokenizer of the production queries lies on this machine."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def encode(body: bytes | None, ids: WordIds) -> bytes:
    """The ids of a whole text, four bytes each."""
    return b"".join(map(ids.__getitem__, body.split())) if body else b""


def encode_rows(bodies: pa.Array, ids: WordIds, size: int = 8 << 20) -> Iterator[np.ndarray]:
    """The ids of each of many texts, as ``encode`` gives them.

    Texts are taken in blocks of about ``size`` bytes (a longer one by itself), and a
    word is looked up once a block.
    """
    text = bodies.view(pa.string() if pa.types.is_binary(bodies.type) else pa.large_string())
    ends = np.cumsum(pc.fill_null(pc.binary_length(bodies), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(text):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
        words = pc.ascii_split_whitespace(text.slice(start, stop - start))
        met = words.flatten().dictionary_encode()
        keys = met.dictionary.cast(pa.large_string())
        at, raw = np.frombuffer(keys.buffers()[1], np.int64)[:len(keys) + 1].tolist(), keys.buffers()[2]
        raw = raw.to_pybytes() if raw else b""
        values = pa.array([ids[raw[a:b]] for a, b in zip(at, at[1:], strict=False)], pa.large_binary())
        found = values.take(met.indices)
        places = np.zeros(len(found) + 1, np.int64)
        np.cumsum(pc.binary_length(found).to_numpy(zero_copy_only=False), out=places[1:])
        counts = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
        bounds = places[np.concatenate([[0], np.cumsum(counts)])] // 4
        data = np.frombuffer(found.buffers()[2] or b"", "<u4")
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            yield data[a:b]
        start = stop
