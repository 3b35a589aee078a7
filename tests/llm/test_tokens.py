"""Token ids against the library's own, for whole texts."""

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from millrace.llm import packing, tokenfiles, tokens
from tokenizers import Tokenizer

FILES = {"byte": "byte_bpe_50k.json", "word": "word_bpe_49k.json"}
ODD = ["'s", "'LL", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "É", "ß", "İ", "Σς", "́", "日本", "²", "7", "!?", "<|endoftext|>", "<|startoftext|>", "<|", "ab", "Zed", "🙂"]


@pytest.fixture(scope="module", params=sorted(FILES))
def encoder(request):
    path = public_tokenizers.path(FILES[request.param])
    made = tokens.Encoder(tokens.read_tokenizer(path), kept_pieces=50)
    assert made.kind == request.param
    made.untouched = Tokenizer.from_file(path)
    return made


def library(encoder, text):
    ids = encoder.untouched.encode(text, add_special_tokens=False).ids
    return np.array(ids, dtype="<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from(ODD), max_size=12).map("".join), max_size=4))
def test_ids_are_the_librarys(encoder, texts):
    assert encoder.encode(texts) == [library(encoder, t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=40))
def test_any_text(encoder, text):
    assert encoder.encode([text]) == [library(encoder, text)]


def test_names_of_special_tokens(encoder):
    texts = ["hello <|endoftext|> world", "<|startoftext|>a", "<|ENDOFTEXT|>", "x<|endoftext|><|endoftext|>"]
    assert encoder.encode(texts) == [library(encoder, t) for t in texts]
    last = 50256 if encoder.kind == "byte" else 49407
    assert last in np.frombuffer(encoder.encode(texts)[0], dtype="<u4")


def test_names_as_ordinary_text():
    path = public_tokenizers.path(FILES["byte"])
    plain, untouched = tokens.Encoder(tokens.read_tokenizer(path), special_names=False), Tokenizer.from_file(path)
    untouched.encode_special_tokens = True
    for text in ["hello <|endoftext|> world", " <|endoftext|>", "a <| b"]:
        ids = untouched.encode(text, add_special_tokens=False).ids
        assert 50256 not in ids
        assert plain.encode([text]) == [np.array(ids, dtype="<u4").tobytes()]


def test_other_tokenizers_get_whole_texts():
    assert tokens._kind({"pre_tokenizer": {"type": "Whitespace"}, "model": {}}) == "other"
    assert tokens._kind({"truncation": {}, "padding": {"x": 1}, "model": {}}) == "other"


@given(st.lists(st.integers(0, 2**32 - 1), max_size=40))
def test_coding_goes_both_ways(numbers):
    control, data = tokenfiles.code(np.array(numbers, dtype="<u4"))
    assert tokenfiles.decode(control, data, len(numbers)).tolist() == numbers


def test_a_number_takes_the_bytes_it_needs():
    control, data = tokenfiles.code(np.array([0, 255, 256, 65535, 65536, 2**24, 2**32 - 1]))
    assert len(control) == 2 and len(data) == 1 + 1 + 2 + 2 + 3 + 4 + 4


@given(st.lists(st.integers(0, 16), max_size=60))
def test_first_fit_like_a_plain_search(lengths):
    bins, offsets = packing.first_fit(lengths, 16)
    used = []
    for length, found, offset in zip(lengths, bins, offsets, strict=True):
        place = next((k for k, u in enumerate(used) if u + length <= 16), len(used))
        if place == len(used):
            used.append(0)
        assert (found, offset) == (place, used[place])
        used[place] += length
