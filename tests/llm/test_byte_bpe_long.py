"""Encoding takes no shuffle, and a long run without a break does not cost its square."""

import base64
import random
import time

import public_tokenizers
import pytest
import regex
import tiktoken
from llm_fixtures import docs

from erpspark.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_long_runs_without_a_shuffle(spark, reference):
    rng = random.Random(7)
    texts = ["".join(rng.choices("abcdetnrsaei", k=k)) for k in (255, 256, 257, 5000, 60000)] + ["ab" * 3000, "é" * 3000]
    out = byte_bpe.encode(docs(spark, texts), PATH)
    assert "Exchange" not in out._jdf.queryExecution().toString()
    began = time.time()
    got = {r.doc_id: r["__ids"] for r in out.collect()}
    assert time.time() - began < 60
    for i, text in enumerate(texts):
        assert got[i] == " ".join(map(str, reference.encode_ordinary(text)))


def test_both_merges_agree(reference):
    ranks = {t: i for i, t in enumerate(byte_bpe.read_ranks(PATH))}
    rng = random.Random(3)
    for _ in range(300):
        word = "".join(rng.choices("etaoin srhé日0", k=rng.randint(1, 60))).encode()
        if word not in ranks:
            assert byte_bpe.merge(word, ranks) == byte_bpe._merge_long(word, ranks)


def test_latin_pattern_agrees():
    rng, full = random.Random(5), regex.compile(byte_bpe.PATTERN)
    for c in map(chr, range(0x2C2)):
        text = f"a{c}{c} {c}1{c}'{c}"
        assert byte_bpe.words(text) == full.findall(text), repr(c)
    for _ in range(500):
        text = "".join(rng.choices([*map(chr, range(0x2C2)), " ", " ", "\n", "'", "日", "१"], k=40))
        assert byte_bpe.words(text) == full.findall(text)
