"""Units encoded many at once, and what an encoder may hold."""

from __future__ import annotations

import random

import public_tokenizers as P
import pyarrow as pa
from tokenizers import Tokenizer

from gleanframe.llm import tokens

JSON = P.path("byte_bpe_50k.json")


def test_lumps_agree_with_the_library_on_odd_units():
    rng = random.Random(3)
    letters = ["a", "B", "é", "日", "7", "'s", ".", "\n", "\t", "\x1c", "\x85", " ", "　", "Ġ", "\x00", "<|endoftext|>", "🙂"]
    units = [" " + "".join(rng.choices(letters, k=rng.randint(0, 6))) for _ in range(3000)]
    units += ["", " ", "  ", "a", "a b", " a b", " x" * 3, " " + "y" * 500, " \n", "\n"]
    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    wanted = [library.encode(x, add_special_tokens=False).ids for x in units]
    encoder = tokens.json_encoder(JSON)
    assert [memoryview(x).cast("H").tolist() for x in encoder.missing(units)] == wanted


def test_an_encoder_holds_few_units_whatever_it_reads():
    rng = random.Random(4)
    tokens.json_encoder.cache_clear()
    encoder, before = tokens.json_encoder(JSON), pa.total_allocated_bytes()
    for _ in range(30):
        encoder([" ".join("".join(rng.choices("abcdefghijklmnop", k=9)) + "." for _ in range(15_000))])
    held = len(encoder.memo) + len(encoder.missing.other.memo if hasattr(encoder.missing, "other") else encoder.missing.memo)
    assert held <= 300_000  # 450,000 and as many pieces before
    assert pa.total_allocated_bytes() <= before + (1 << 20)
    tokens.json_encoder.cache_clear()
