"""Short cuts of the word cache against the tokenizer itself, over random words."""

import random
import struct

from tokenizers import Tokenizer

from queuelens.llm import tokens
from queuelens.llm.queries import tokenizer_path


def test_words_of_any_letters_and_marks():
    tokenizer = Tokenizer.from_file(tokenizer_path())
    cache = tokens.WordCache(tokenizer, 2)
    r = random.Random(3)
    pool = [chr(i) for i in range(33, 0x250)] + [*"İıßẞǅ́̇"] * 20 + [".", ","] * 40 + [*"abcdefghijklmnopqrstuvwxyzABC"] * 4
    pool += [chr(r.randrange(0x250, 0xD7FF)) for _ in range(300)] + [chr(r.randrange(0x1F300, 0x1FAFF)) for _ in range(30)]
    words = ["İ.", "xİ,", "Éı.", "ß,", "ǅ."] + ["".join(r.choice(pool) for _ in range(r.randint(1, 9))) for _ in range(20_000)]
    wrong = []
    for word in words:
        got = cache[word.encode().lower()]  # bytes.lower() changes A-Z alone
        if list(struct.unpack(f"<{len(got) // 2}H", got)) != tokenizer.encode(word, add_special_tokens=False).ids:
            wrong.append(word)
    assert not wrong


def test_words_met_once_are_not_kept():
    """Most words of a corpus occur once; a worker keeps those that come again."""
    tokenizer = Tokenizer.from_file(tokenizer_path())
    cache = tokens.WordCache(tokenizer, 2, limit=50, new=300)
    for i in range(2_000):
        for word in (f"once{i}", f"often{i % 20}"):
            got = cache[word.encode()]
            assert list(struct.unpack(f"<{len(got) // 2}H", got)) == tokenizer.encode(word, add_special_tokens=False).ids
        assert len(cache) <= 50 and len(cache.new) <= 300
    assert set(cache) == {f"often{i}".encode() for i in range(20)}
