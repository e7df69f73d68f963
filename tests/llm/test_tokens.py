"""BPE and token counts against the tokenizers library, over odd texts and whole tables."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tiermill.llm import bpe, token_counts
from tiermill.llm.vocab import default_path

ODD = "ab aa e the ing 'll's 'RE \n\t  1234567890 -=_!?.,;éèÇüß日本語🙂İΣςK\x85\xa0\x1c ­<|endoftext|>½Ⅷ²"


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    for _ in range(n):
        kind = rng.random()
        if kind < 0.3:
            yield "".join(rng.choice(ODD) for _ in range(rng.randint(0, 150)))
        elif kind < 0.6:
            pick = ["the", "tion", "<|endoftext|>", "<|startoftext|>", "aaaa" * rng.randint(1, 50), "ΑΣ", "I'LL", "  ", "\n\n \n", "====", " x"]
            yield " ".join(rng.choice(pick) for _ in range(rng.randint(0, 40)))
        else:
            places = [(97, 110), (32, 126), (0xA0, 0x17F), (0x370, 0x5FF), (1, 0x2FFF), (0x10000, 0x1FFFF)]
            yield "".join(chr(rng.randint(*rng.choice(places))) for _ in range(rng.randint(0, 120)))


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(default_path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(default_path("word_bpe_49k.json"))


def ids_of(library, texts):
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_ids_equal_the_librarys(byte_library):
    texts = [*odd_texts(1500), "a" * 5000, ".-" * 2000, "thetion" * 900, "", " ", "\n"]
    got = [np.frombuffer(x, "<u4").tolist() for x in bpe.load(default_path("byte_bpe_50k.json")).encode(texts)]
    assert got == ids_of(byte_library, texts)


def test_every_token_decodes(byte_library):
    mine = bpe.load(default_path("byte_bpe_50k.json"))
    rng = random.Random(5)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 12))]
        assert mine.decode(np.array(ids, np.int64)).decode() == byte_library.decode(ids, skip_special_tokens=False)


def test_failing_proposals_are_merged_exactly():
    """Greedy longest matches alone would give other ids for some words."""
    mine = bpe.load(default_path("byte_bpe_50k.json"))
    words = [a + b for a in ("thandst", "eronthwh", "ouedes") for b in ("ering", "tionou", "atthes")]
    raw = mine._joined([w.encode() for w in words])
    token, length = mine.propose(raw)
    assert (length[raw < 256] > 0).all() and len(token) == len(raw)
    exact, owner = mine.merge([w.encode() for w in words])
    for i, got in enumerate(mine.encode_words(words)):
        assert np.frombuffer(got, "<u4").tolist() == exact[owner == i].tolist()


def test_memory_bound_changes_nothing(byte_library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 8)
    mine, texts = bpe.ByteBpe(default_path("byte_bpe_50k.json")), list(odd_texts(200, 9))
    got = [np.frombuffer(x, "<u4").tolist() for i in range(0, 200, 10) for x in mine.encode(texts[i : i + 10])]
    assert got == ids_of(byte_library, texts)


def test_counts_equal_the_librarys(word_library):
    texts = [*odd_texts(1500, 4), "a" * 5000, "haha" * 900, "", " "]
    assert token_counts.load(default_path("word_bpe_49k.json")).count(texts) == [len(x) for x in ids_of(word_library, texts)]


def test_whole_table(spark, sf_dir, byte_library, word_library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = dict(zip(texts, ids_of(byte_library, list(texts.values())), strict=True))
    for r in bpe.encode_decode(docs).collect():
        assert r.n_tokens == len(ids[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(np.array(ids[r.doc_id], "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    counts = dict(zip(texts, map(len, ids_of(word_library, list(texts.values()))), strict=True))
    for r in token_counts.count_tokens(docs).collect():
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), counts[r.doc_id], counts[r.doc_id] > 2048)


def test_edges(edges, spark):
    empty = hashlib.sha256(b"").hexdigest()
    rows = bpe.encode_decode(edges, with_ids=True).collect()
    assert len(rows) == 9
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[1].n_tokens, by_id[1].ids_sha256, by_id[1].decoded_sha256, by_id[1].ids) == (0, empty, empty, [])
    assert by_id[6].decoded_sha256 == hashlib.sha256(b"x" * 120_000).hexdigest() and None in by_id
    counted = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(edges).collect()}
    assert counted[1] == counted[2] == counted[3] == 0 and counted[7] == 40_000 and len(counted) == 8
    assert bpe.encode_decode(edges.limit(0)).count() == token_counts.count_tokens(edges.limit(0)).count() == 0
