"""The word memory and the block-wise look-up give the tokenizer's own ids, with little work."""

import random

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from ledgerline.llm import tokens

CORES = ["word", "Word", "WORD", "été", "Été", "ÉTÉ", "straße", "ñandú", "ab12", "12", "x1y", "µm", "ªº", "ÿ", "J̌",
         "İ", "é", "Ελλάς", "中文", "don't", "l'été", "a-b", "é-ü", " ", "\u0085", "x̸", "", "<|endoftext|>"]
TAILS = ["", ".", ",", "!?", "&&&", "***", "'", "'s", "'S", "’", "=", "≠", "<", "<|", "$%#", "_", "~`", "́", "\x00"]


def words():
    return [a + b for a in CORES for b in TAILS] + [b + a + c for a in CORES for b, c in (("(", ")"), ('"', '",'), ("--", ";"))]


def test_every_spelling_has_the_tokenizers_ids():
    plain, ids = Tokenizer.from_file(tokens.default_path()), tokens.WordIds(tokens.default_path())
    for w in words():
        assert tokens.encode(w.encode(), ids) == np.array(
            plain.encode(w, add_special_tokens=False).ids, "<u4").tobytes(), w


def test_marked_latin_words_are_not_sent_through_the_whole_tokenizer():
    ids = tokens.WordIds(tokens.default_path())
    asked = []
    whole = ids.tokenizer

    class Asked:
        def encode(self, text, **options):
            asked.append(text)
            return whole.encode(text, **options)

    ids.tokenizer = Asked()
    tokens.encode("Été, étés. ÉTÉ!!! été*** word&&& Word%%%".encode(), ids)
    assert set(asked) <= {",", ".", "!!!", "***", "&&&", "%%%"}


def test_words_met_again_are_not_forgotten():
    ids = tokens.WordIds(tokens.default_path(), 200)
    done = []
    ids._ids = lambda w, f=ids._ids: done.append(w) or f(w)
    for i in range(2000):
        ids[f"w{i}".encode()]
        ids[b"often"]
    assert done.count(b"often") == 1
    assert len(ids) + len(ids.older) <= 200


def test_blocks_equal_single_texts():
    rng = random.Random(5)
    some = words()
    texts = [None, b"", b" \t\n\x0b\x0c\r ", b"\xff\xfe a\x80b \xc3", b"a" * 5000, b"\x1c\x1d\x1e\x1f x\x85y \xc2\xa0z"]
    for n in range(200):
        texts.append(rng.choice([" ", "\n", "  ", " \t"]).join(rng.choices(some, k=n % 37)).encode())
    rng.shuffle(texts)
    ids = tokens.WordIds(tokens.default_path())
    want = [tokens.encode(t, ids) for t in texts]
    for kind in (pa.binary(), pa.large_binary()):
        for size in (1, 300, 8 << 20):
            column = pa.array([b"before", *texts], kind).slice(1)
            got = [x.tobytes() for x in tokens.encode_rows(column, tokens.WordIds(tokens.default_path(), 50), size)]
            assert got == want
    assert list(tokens.encode_rows(pa.array([], pa.binary()), ids)) == []
    assert [len(x) for x in tokens.encode_rows(pa.array([None, None], pa.binary()), ids)] == [0, 0]
