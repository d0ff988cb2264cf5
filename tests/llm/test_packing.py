import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
from llm_fixtures import docs, plain
from tokenizers import Tokenizer

from erpspark.llm import catalog, packing

DATA = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


def whole(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, texts, size=4096):
    """Every piece has the ids of a plain encoding, and sequences are gapless and not over-full."""
    tokenizer, by_doc, by_seq = Tokenizer.from_file(PATH), defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc_id, text in texts.items():
        ids = whole(tokenizer, text)
        want = [(k, at, len(p := ids[at : at + size]), zlib.crc32(np.array(p, "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), size))]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[doc_id]) == want, doc_id
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return len(by_seq), -(-sum(r.length for rows in by_seq.values() for r in rows) // size)


def test_data(spark):
    texts = dict(duckdb.sql(f"select doc_id, text from '{DATA}/documents.parquet'").fetchall())
    used, least = check(catalog.QUERIES["op4_best_fit_packing"](spark, DATA).collect(), texts)
    assert used <= least + 1


def test_edges(spark):
    texts = [None, "", "  \n", "Hello World don't STOP", "a<|endoftext|>b <|startoftext|>", "x y  z \x1c q\x1fr", "İstanbul ΣΑΣ ſ ŉ é é ǅ", "日本語 😀‼ ½ ²³ १२", "word " * 9000, "z" * 5000, "it's I'LL we'd 'SO"]
    check(packing.pack(packing.pieces(docs(spark, texts), PATH)).collect(), dict(enumerate(texts)))
    assert packing.pack(packing.pieces(plain(spark, []), PATH)).count() == 0
    twice = packing.pack(packing.pieces(plain(spark, [(1, "same text")] * 3 + [(None, "x")]), PATH)).collect()
    assert Counter(r.doc_id for r in twice) == {1: 3, None: 1} and len({(r.sequence_id, r.offset) for r in twice}) == 4


def test_encoder_agrees_on_odd_strings(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 50)
    rng, tokenizer, mine = random.Random(5), Tokenizer.from_file(PATH), packing.WordEncoder(PATH)
    chars = [chr(c) for c in [*range(1, 0x250), *range(0x300, 0x330), 0x3A3, 0x1E9E, 0x2160, 0x3000, 0x4E00, 0x1F600, 0xFB01]] + ["'s", "'LL", "<|", "|>", " ", "\n"] * 20
    texts = ["".join(rng.choices(chars, k=rng.randint(0, 40))) for _ in range(1500)]
    for text, ids in zip(texts, mine.texts([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_sum_of_squares():
    def slow(lengths, size):
        gaps, out = [], []
        for n in lengths:
            fits = [g for g in sorted(set(gaps)) if g >= n]
            if fits:
                def after(g):
                    c = Counter(gaps)
                    c[g] -= 1
                    if g > n:
                        c[g - n] += 1
                    return sum(v * v for v in c.values())

                g = min(fits, key=after)
                gaps.remove(g)
            else:
                g = size
                out.append(0)
            if g > n:
                gaps.append(g - n)
        return len(out), sorted(gaps)

    rng = random.Random(3)
    for size in (10, 37):
        lengths = sorted((rng.randint(1, size) for _ in range(200)), reverse=True)
        bins, offsets = packing.sum_of_squares(np.array(lengths), size)
        fill = Counter()
        for b, o, n in zip(bins, offsets, lengths, strict=True):
            assert fill[b] == o
            fill[b] += n
        assert (len(fill), sorted(size - f for f in fill.values() if f < size)) == slow(lengths, size)
