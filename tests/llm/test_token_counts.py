import random
import tracemalloc

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sitefold.llm import token_counts as token_counts_module
from sitefold.llm.token_counts import Counter, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def counter():
    return Counter(PATH)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def made(seed, n=60):
    r = random.Random(seed)
    parts = ["the", " of", "tion", "'s", "'re", "  ", "\n", " \n\n ", "é", "ñandú", "数据", "🙂", " ", "　", "\t", "123", "4.5", "!!", "<|endoftext|>", "x" * 30, "I'll", "\x1c", "\x85", "​", "á"]
    return "".join(r.choice(parts) if r.random() < 0.8 else chr(r.choice([r.randrange(32, 0x3000), r.randrange(0x3000, 0xD800), r.randrange(0xE000, 0x1FFFF)])) for _ in range(n))


def test_counts_equal_the_library(counter, library):
    for seed in range(1000):
        text = made(seed)
        assert counter.count(text) == library(text), repr(text)


def test_every_chunk_size_gives_the_same_total(counter, library):
    for seed in range(60):
        text = made(seed, 80)
        for size in (1, 2, 3, 7, 19, 64):
            assert counter.count(text, size) == library(text), (size, text)


def test_prefix_scan_has_every_prefix(counter, library):
    for seed in range(20):
        text = made(seed, 120).replace("<|endoftext|>", "")
        maps = [counter.chunk_map(text[i : i + 16]) for i in range(0, len(text), 16)]
        assert [counter.applied(m) for m in counter.scan(maps)] == [library(text[: i + 16]) for i in range(0, len(text), 16)]


def test_tables_that_start_anew_change_nothing(library, monkeypatch):
    monkeypatch.setattr(token_counts_module, "MOST_WORDS", 5)
    monkeypatch.setattr(token_counts_module, "MOST_STATES", 40)
    small = Counter(PATH)
    for seed in range(60):
        text = made(seed)
        assert small.count(text) == library(text), repr(text)
    assert len(small.spaced) <= 5 and len(small.spaced.older) <= 5


def test_one_very_long_word(counter, library):
    text = "abcdefghij" * 3000
    assert counter.count(text) == library(text)


def test_texts_without_white_space(counter, library):
    r = random.Random(4)
    for k in range(60):
        text = "".join(r.choice(["a", "漢字", "é", "9", "!", "'", "'ll", "\u0378", "\U000e0fff"]) * r.choice([1, 1, 90]) for _ in range(20))
        for size in (7, 64, 100):
            assert counter.count(text, size) == library(text), (size, text)


def test_long_texts_without_white_space_take_little_memory(counter, library):
    r = random.Random(5)
    signs = [chr(0x4E00 + r.randrange(3000)) for _ in range(2000)]
    text = "".join(r.choices(signs, k=600_000)) + " end"
    counter.count(text[:10_000])
    tracemalloc.start()
    counted = counter.count(text)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 150e6  # its states and fragments; the maps of all prefixes would hold 11 million characters
    assert counted == library(text)


def test_nulls_repeats_and_extra_columns(spark):
    df = spark.createDataFrame([(1, None, 5), (1, None, 5), (None, "", 6), (2, "a b", 7)], "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, token_counts(df, PATH).collect()), key=str)
    assert got == sorted([(1, 0, 0, False), (1, 0, 0, False), (None, 0, 0, False), (2, 3, 2, False)], key=str)
    assert token_counts(df.limit(0), PATH).count() == 0
