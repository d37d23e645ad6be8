import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from edge_cases import SF, TEXTS, documents, no_documents
from tokenizers import Tokenizer

from predial.llm import packing
from predial.llm.support import prepare

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def pieces(text, capacity):
    ids = np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
    return [(i // capacity, i, len(ids[i : i + capacity]), zlib.crc32(ids[i : i + capacity].tobytes()))
            for i in range(0, len(ids), capacity)]


def check_sequences(rows, capacity):
    """Every sequence is filled from 0 without a gap, up to the capacity; how many there are."""
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def first_fit_decreasing(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        for i, free in enumerate(bins):
            if free >= n:
                bins[i] -= n
                break
        else:
            bins.append(capacity - n)
    return len(bins)


@pytest.mark.parametrize("seed", range(8))
def test_plan_places_every_piece(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 64, 2048])
    top = capacity if seed % 2 else capacity // 2
    lengths = [rng.randint(1, top) for _ in range(rng.choice([3, 500, 3000]))]
    histogram = Counter(lengths)
    rows = packing.plan(histogram, capacity).tolist()
    used, seen = defaultdict(int), Counter()
    by_length = defaultdict(list)
    for length, first, beside, sequence, offset in rows:
        by_length[length].append((first, beside, sequence, offset))
    for length, count in histogram.items():
        starts = by_length[length]
        for rank in range(count):
            first, beside, sequence, offset = [r for r in starts if r[0] <= rank][-1]
            at = sequence + (rank - first) // beside
            used[at] += length
            seen[length] += 1
    assert seen == histogram and max(used.values()) <= capacity
    assert len(used) <= 1.01 * first_fit_decreasing(lengths, capacity) + 1
    assert len(used) >= -(-sum(lengths) // capacity)


def test_large_pieces_pair_at_most_twice():
    rows = packing.plan(Counter({700: 5, 1300: 2, 1400: 1, 2047: 1, 2048: 3}), 2048).tolist()
    per = Counter()
    for length, _, beside, sequence, _ in rows:
        per[sequence] += beside
    assert max(per.values()) <= 2


def test_tokens_by_words_are_tokens_of_the_text():
    rng = random.Random(1)
    letters = "ab Zé1 \n\t  '’sß\x1c\x1d\x85\xa0　中\U0001f642٣​̈ΣσİI.,!e"
    ours = packing.WordTokenizer(PATH)
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        text += rng.choice(["", "<|endoftext|>x"])
        ids = np.frombuffer(ours.encode_many([text])[0], "<u4").tolist()
        assert ids == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_edges(spark):
    rows = packing.pack(documents(spark), PATH, capacity=64).collect()
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert got == Counter((i, *p) for i, t in TEXTS for p in pieces(t, 64))
    check_sequences(rows, 64)
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in rows)
    assert packing.pack(no_documents(spark), PATH).count() == 0


def test_given_documents(spark):
    df = prepare(spark).read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack(df, PATH).collect()
    texts = {r.doc_id: r.text for r in df.collect()}
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert got == Counter((i, *p) for i, t in texts.items() for p in pieces(t, 2048))
    lengths = [r.length for r in rows]
    assert check_sequences(rows, 2048) <= first_fit_decreasing(lengths, 2048)


def test_sequences_hold_the_ids(spark):
    df = prepare(spark).read.parquet(f"{SF}/documents.parquet")
    packed = packing.pack(df, PATH)
    total = packed.agg({"length": "sum"}).first()[0]
    sequences = packing.sequences(packed).collect()
    assert sum(len(r.ids) for r in sequences) == 4 * total
    assert all(len(r.ids) <= 4 * 2048 for r in sequences)


def test_many_buckets_of_one_length(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 10)
    df = prepare(spark).createDataFrame([(i, "a b c") for i in range(500)], "doc_id long, text string")
    rows = packing.pack(df, PATH, capacity=11).collect()
    assert check_sequences(rows, 11) == 250


def test_words_of_letters_go_to_the_model(monkeypatch):
    """Ids are those of the whole text whatever is known of its words, and each is looked up once."""
    rng = random.Random(2)
    ours = packing.WordTokenizer(PATH)
    ours.words.entries = 300
    asked = []
    tokenise = ours._tokenise
    monkeypatch.setattr(ours, "_tokenise", lambda words: asked.append(list(words)) or tokenise(words))
    syllables = "an the tion wh er ist LL 's 12 . , <|endoftext|> \u017f \u00e9 x".split()
    for _ in range(60):
        texts = [" ".join("".join(rng.choices(syllables, k=rng.randint(1, 5))) for _ in range(40)) for _ in range(5)]
        texts += ["z" * 80 + ", " + "z" * 80 + " end. end", None, ""]
        for text, ids in zip(texts, ours.encode_many(texts)):
            want = TOKENIZER.encode(text or "", add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want
    assert all(len(words) == len(set(words)) for words in asked)
    assert len(ours.words) <= 300 + 500 and all(type(ids) is bytes for ids in ours.words.values())
    vowels = "aeiou"
    words = ["".join(rng.choices(vowels + "bcdfghlmnprst", k=rng.randint(1, 14))) for _ in range(5000)]
    assert list(tokenise([w.encode() for w in words])) == [
        np.array(e.ids, "<u4").tobytes() for e in TOKENIZER.encode_batch(words, add_special_tokens=False)]
