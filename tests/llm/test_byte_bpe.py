import base64
import random

import numpy as np
import public_tokenizers as P
import tiktoken
from edge_cases import SF, TEXTS, documents, no_documents

from predial.llm import byte_bpe
from predial.llm.support import prepare

PATH = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
ENCODING = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODEC = byte_bpe.TextCodec(PATH, P.PATTERN)


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_random_texts_as_the_library_encodes_them():
    rng = random.Random(1)
    letters = "ab Zé1 \n\t  '’sß\x1c\x1d\x85\xa0 　中文\U0001f642٣\xb2​᠎-.,!"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    for start in range(0, len(texts), 100):
        some = texts[start : start + 100]
        for text, packed in zip(some, CODEC.encode_many(some)):
            assert ids(packed) == ENCODING.encode_ordinary(text)
            assert CODEC.decode(packed) == text.encode()


def test_long_pieces():
    for text in ("a" * 5000, "ab" * 3000 + "x" * 999, "\n" * 500, " " * 3000 + "x", "é" * 2000,
                 "12" * 1000, "<|endoftext|>"):
        assert ids(CODEC.encode_many([text])[0]) == ENCODING.encode_ordinary(text)


def test_trees_take_the_leftmost_of_equal_ranks():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaaa": 257, b"aab": 258}
    table = byte_bpe.MergeTable(ranks)
    pieces = [b"aaa", b"aaaa", b"aaab", b"aab", b"ba"]
    plain = [byte_bpe.Forest([p], 4, table).run()[0] for p in pieces]
    assert byte_bpe.Forest(pieces, 4, table).run() == plain
    assert [ids(p) for p in plain] == [[256, 97], [257], [256, 97, 98], [258], [98, 97]]


def test_memory_is_bounded(monkeypatch):
    small = byte_bpe.TextCodec(PATH, P.PATTERN)
    small.recent.entries = 50
    rng = random.Random(2)
    for _ in range(30):
        texts = [" ".join("".join(rng.choice("abcde") for _ in range(5)) for _ in range(20))]
        assert ids(small.encode_many(texts)[0]) == ENCODING.encode_ordinary(texts[0])
    assert len(small.recent.young) <= 50 + 20 and len(small.recent.old) <= 50 + 20


def round_trip(df):
    decoded = byte_bpe.decode(byte_bpe.encode(df, PATH, P.PATTERN), PATH, P.PATTERN)
    return decoded.collect()


def test_edges(spark):
    rows = round_trip(documents(spark))
    want = sorted(((i, tuple(ENCODING.encode_ordinary(t or ""))) for i, t in TEXTS), key=str)
    assert sorted(((r.doc_id, tuple(ids(r.ids))) for r in rows), key=str) == want
    texts = sorted((t or "").encode() for _, t in TEXTS)
    assert sorted(bytes(r.decoded) for r in rows) == texts
    assert round_trip(no_documents(spark)) == []


def test_given_documents(spark):
    df = prepare(spark).read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in round_trip(df):
        assert ids(r.ids) == ENCODING.encode_ordinary(texts[r.doc_id])
        assert bytes(r.decoded) == texts[r.doc_id].encode()
