"""Packing: strings of added tokens against the JSON tokenizer as it comes."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cohortloom.llm import packing

JSON = public_tokenizers.path(packing.VOCABULARY)
TOKENIZER = Tokenizer.from_file(JSON)
END = "<|endoftext|>"


def plain_ids(text):
    return [*TOKENIZER.encode(text, add_special_tokens=False).ids, packing.END_ID]


@pytest.mark.parametrize("part", [packing.PART_CHARS, 1, 7, 100])
def test_ids(monkeypatch, part):
    monkeypatch.setattr(packing, "PART_CHARS", part)
    encoding = packing.load_encoding(public_tokenizers.path(packing.RANKS), packing.added_tokens(JSON))
    rng = random.Random(5)
    pieces = ["word ", " b", "\n", "it's", "é", "  ", "1", END, "<|endof", "text|>"]
    for text in (f"a{END}b", END, END * 3, f"  {END}  x", *("".join(rng.choices(pieces, k=200)) for _ in range(20))):
        assert packing.token_ids(encoding, text).tolist() == plain_ids(text)


def test_pack(documents):
    text = f"a{END}b"
    (row,) = packing.pack(documents([(1, text)])).collect()
    assert plain_ids(text) == [64, 50256, 65, 2]
    assert (row.length, row.ids_crc32) == (4, zlib.crc32(np.array(plain_ids(text), "<u4").tobytes()))
