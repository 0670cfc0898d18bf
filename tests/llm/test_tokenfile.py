from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import pfor, tokenfile
from tidemark.scratch import scratch_folder

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 300), max_size=1300), st.integers(0, 1300), st.integers(0, 1300))
@settings(max_examples=60, deadline=None)
def test_blocks_round_trip(values, a, b):
    values = np.array(values, np.uint64)
    stream = pfor.encode(values)
    assert (pfor.decode(stream) == values).all()
    a, b = sorted((a, b))
    assert (pfor.decode(stream, a, b) == values[a:b]).all()


@pytest.mark.parametrize("percentile", [50.0, 90.0, 100.0])
def test_outliers_are_exceptions(percentile):
    values = np.arange(5000, dtype=np.uint64) % np.uint64(100)
    values[::97] = 2**40
    stream = pfor.encode(values, percentile)
    assert (pfor.decode(stream) == values).all()
    if percentile == 90.0:
        assert len(stream) < len(pfor.encode(values, 100.0)) / 3


@pytest.mark.parametrize("width", range(1, 20))
def test_every_width_is_packed_bit_by_bit(width):
    r = np.random.default_rng(width)
    rows = r.integers(0, 2**width, (3, pfor.BLOCK), np.uint64)
    bits = (rows[..., None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    plain = np.packbits(bits.astype(np.uint8).reshape(3, -1), axis=-1, bitorder="little")
    assert (pfor._pack(rows, width) == plain).all()
    assert pfor._bits(rows).tolist() == [[int(v).bit_length() for v in row] for row in rows]


def test_letters_without_accents_are_not_spelt_anew(monkeypatch):
    encoder, asked = tokenfile.WordEncoder(PATH), []
    real = encoder._letters

    class Watched(dict):
        def __getitem__(self, code):
            asked.append(code)
            return real[code]

    encoder._letters = Watched()
    text = "plain Words, größer and plain"
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder._tokenizer.encode(text, add_special_tokens=False).ids
    assert set(map(ord, "größer")) <= set(asked) and ord("d") not in asked


ALPHABET = "abcXYZ .,!?'\n\t \x01\x0b\x85 éÉßµªİıſAngströḿ̇中文ñ123_$<|endoftext|>😀"


@given(st.lists(st.text(st.sampled_from(ALPHABET), max_size=20) | st.just(" <|endoftext|> "), max_size=6))
@settings(max_examples=300, deadline=None)
def test_words_give_the_ids_of_whole_texts(parts):
    encoder, text = tokenfile._encoder(PATH), "".join(parts)
    expected = encoder._tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == expected


def test_word_store_is_bounded(monkeypatch):
    monkeypatch.setattr(tokenfile, "CACHED_WORDS", 20)
    encoder = tokenfile.WordEncoder(PATH)
    r = random.Random(1)
    for _ in range(50):
        text = " ".join(f"w{r.randrange(60)} Abc{r.choice('xyz')}." for _ in range(10))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder._tokenizer.encode(text).ids
    assert len(encoder._known) < 100


def test_files_round_trip(spark, documents):
    r = random.Random(4)
    rows = [(k * 7 - 50, " ".join(r.choice("one two Three, 4 fünf".split()) for _ in range(r.randint(0, 60)))) for k in range(200)]
    rows += [(None, "no id"), (None, None), (3000, ""), (3000, "same id"), (3001, "word " * 20_000)]
    r.shuffle(rows)
    path = scratch_folder(spark, "tokens")
    tokenfile.write_tokens(documents(rows), path, PATH, 2, segment_ids=500)
    out = sorted(tokenfile.read_tokens(spark, path).collect(), key=lambda x: x["start"])
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    tokenizer, start = Tokenizer.from_file(PATH), 0
    assert [x["doc_id"] for x in out] == [x[0] for x in order]
    for row, (_, text) in zip(out, order):
        expected = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert np.frombuffer(row["ids"], "<u4").tolist() == expected
        assert (row["start"], row["n_tokens"]) == (start, len(expected))
        start += len(expected)


def test_empty_table(spark, documents):
    path = scratch_folder(spark, "tokens")
    tokenfile.write_tokens(documents([]), path, PATH, 2)
    assert tokenfile.read_tokens(spark, path).count() == 0
