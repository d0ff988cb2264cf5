import base64
import hashlib

import duckdb
import public_tokenizers
import pytest
import tiktoken
from llm_fixtures import docs
from pyspark.sql import functions as F

from erpspark.llm import byte_bpe, catalog

DATA = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_data(spark, reference):
    texts = dict(duckdb.sql(f"select doc_id, text from '{DATA}/documents.parquet'").fetchall())
    got = catalog.QUERIES["op6_byte_bpe"](spark, DATA).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("limit", [0, 5, 1 << 18])
def test_edges(spark, reference, limit):
    odd = [None, "", " ", "   \n\n  x", "it's I'LL we'd don't", "a  b c 　d\x85e\x1cf", "日本語 😀‼ ½²³ १२٣", "x" * 300 + " " + "ab" * 100, "<|endoftext|> AKIA0==\r\n\t", "\x00\x01é́ ſ ß", "word word word word " * 500]
    got = byte_bpe.decode(byte_bpe.encode(docs(spark, odd), PATH, limit), PATH).select("doc_id", "__ids", F.col("__bytes").alias("back")).collect()
    assert len(got) == len(odd)
    for r in got:
        text = odd[r.doc_id] or ""
        assert r["__ids"] == " ".join(map(str, reference.encode_ordinary(text))), repr(text[:50])
        assert bytes(r.back) == text.encode()
    assert byte_bpe.decode(byte_bpe.encode(docs(spark, []), PATH), PATH).count() == 0
