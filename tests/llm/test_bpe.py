import json
import random

import numpy as np
import public_tokenizers
import pytest
from helpers import clash, documents, odd_rows, prose
from tokenizers import Tokenizer

from shelfwatch.llm import bpe as B

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    with open(PATH, encoding="utf-8") as f:
        return B.Codec(f.read())


ALPHABETS = ["abcdefgh", "aab", " \n\t x", "é漢字🙂a ", "0123456789", "the and ing tion er ", "'re'll's!!", " "]
WORDS = ["<|endoftext|>", "<|endof", " the", "ing", "    ", "'re", "\r\n"]


def test_joined_pieces_equal_the_library(library, codec):
    rng = random.Random(5)
    for _ in range(400):
        text = "".join(rng.choice(rng.choice(ALPHABETS)) if rng.random() < 0.7 else rng.choice(WORDS) for _ in range(rng.randint(1, 900)))
        size = rng.randint(1, 90)
        parts = [(p.encode(), codec.encode(p)) for p in (text[i : i + size] for i in range(0, len(text), size))]
        assert codec.concat(parts).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a" * 60_000, " " * 50_000 + "x", "ab" * 20_000 + "<|endoftext|>" * 50, "é" * 40_000, "123" * 20_000])
def test_unsplit_text(library, codec, text):
    parts = [(p.encode(), codec.encode(p)) for p in (text[i : i + 7001] for i in range(0, len(text), 7001))]
    assert codec.concat(parts).tolist() == library.encode(text, add_special_tokens=False).ids


def test_small_windows_grow(codec):
    text = "a" * 3000 + prose(3, 50)
    left, right = text[:1501], text[1501:]
    whole = codec.join((left.encode(), codec.encode(left)), (right.encode(), codec.encode(right)), window=1)
    assert whole[1].tolist() == codec.encode(text).tolist()


def test_decoding_any_ids(library, codec):
    rng = random.Random(1)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 30))]
        assert codec.decode(np.array(ids, np.uint32)) == library.decode(ids, skip_special_tokens=False)


def test_other_files_are_refused():
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {**spec["pre_tokenizer"], "add_prefix_space": True}}):
        with pytest.raises(ValueError):
            B.Codec(json.dumps(spec | change))


def test_round_trip_of_whole_texts(spark, library):
    rows = [*odd_rows(), (20, "<|endoftext|> a<|endoftext|>", "en", "a"), (21, prose(8, 30_000) + "z" * 40_000, "en", "a")]
    docs = clash(documents(spark, rows), "ids", "decoded", "_part")
    out = B.encode(docs, PATH, decoded="decoded").collect()
    assert len(out) == len(rows)
    for r in out:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False) == (r["text"] or "") and r["_part"] == "kept"
    back = B.decode(B.encode(documents(spark, rows), PATH, piece=500), PATH).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in back)
    assert B.encode(docs.limit(0), PATH, decoded="decoded").count() == 0
