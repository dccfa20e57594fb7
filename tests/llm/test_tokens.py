"""Token files against the tokenizers library."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparkmine.llm import tokens
from sparkmine.plans.workspace import new_path

PATH = public_tokenizers.path("word_bpe_49k.json")
OTHER = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("path", [PATH, OTHER])
def test_encoder_equals_encode(path):
    enc = tokens.Encoder(path)
    assert enc.by_word == (path == PATH)
    random.seed(1)
    signs = "aAbzE é̈ßÉ'’…,.#%<|>123٣½²Ⅷſİ  \x85\x1c\n\t 数据क्‍ष'sT'Re-_`~"
    texts = ["".join(random.choices(signs, k=random.randint(0, 14))) for _ in range(4000)]
    texts += [t + random.choice(["<|endoftext|>", "x<|startoftext|>y", "<|ENDOFTEXT|>", " <|endoftext|> "]) for t in texts[:400]]
    got = [np.frombuffer(b, enc.dtype).tolist() for b in enc.encode(texts)]
    assert got == [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_words_beyond_the_limit_are_encoded_too():
    enc = tokens.Encoder(PATH, keep=2)
    texts = ["alpha beta gamma", "gamma delta", "alpha"]
    got = [np.frombuffer(b, enc.dtype).tolist() for b in enc.encode(texts)]
    assert got == [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def expected(docs):
    tok, at, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def encoded(spark, docs, **options):
    df = spark.createDataFrame(docs, "doc_id long, text string, ids int, mask int").repartition(3)
    root = new_path(spark, "tokens")
    shards = tokens.write(df, root, PATH, **options)
    return root, shards, tokens.read(shards, root)


def test_round_trip(spark, rows):
    long = "word soup, " * 30_000
    docs = [(7, "Seven words of text, in two lines.\nYes", 1, 1), (3, None, 1, 1), (5, "", 1, 1), (9, long, 1, 1), (2, "x", 1, 1), (2, "x", 1, 1), (None, "no id", 1, 1)]
    _, _, got = encoded(spark, docs, length=16)
    assert rows(got) == sorted(expected([d[:2] for d in docs]), key=repr)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_random_access(spark, monkeypatch):
    monkeypatch.setattr(tokens, "BATCH_IDS", 1 << 19)
    docs = [(i, f"document number {i} says hello", 0, 0) for i in range(50)]
    root, shards, _ = encoded(spark, docs, length=8)
    tok = Tokenizer.from_file(PATH)
    flat = [i for _, t, *_ in docs for i in [*tok.encode(t, add_special_tokens=False).ids, 1]]
    got = []
    for shard, n in sorted((r.shard, r.n_tokens) for r in shards.collect()):
        kept = 0
        for i in range(-(-n // 8)):
            ids, mask = tokens.sequence(f"{root}/shard-{shard:06d}.arrow", i)
            assert len(ids) == len(mask) == 8 and not ids.flags.owndata
            got += ids[mask].tolist()
            kept += mask.sum()
        assert kept == n
    assert got == flat


def test_empty_table(spark):
    assert encoded(spark, [])[2].collect() == []
