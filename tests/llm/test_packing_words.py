"""Words are learned in one thread, a task's core, and cut all together."""

import os

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from erpspark.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_words_are_learned_in_one_thread(monkeypatch):
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    mine, tokenizer = packing.WordEncoder(PATH), Tokenizer.from_file(PATH)
    texts = ["it's a1b22c!'s don't", "", " \n ", "Ünï-Cödé's\r\n'll ''ll x", "a\x0bb\x0cc\td", "日本's <|endoftext|> plain", "e-mail@x.org, 3.14 'S 'T"]
    for _ in range(2):
        for text, ids in zip(texts, mine.texts([t.encode() for t in texts]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
    assert "\n" not in mine.parts
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
