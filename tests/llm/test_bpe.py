import hashlib
import random
import string
import time

import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tickforge.llm.bpe import ByteBpe, bpe_digest, bpe_tokens, load, read_ranks

PATH = P.path("byte_bpe_multi_50k.tiktoken")
REFERENCE = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})
TEXTS = [None, "", " ", "word", "it's 3.14 times\n\n  über-große Straße", "漢字 😀 é́", "ab" * 700, "x" * 3000, "\t \n" * 50, "<|endoftext|>", "word", "word"]


def test_matches_library(spark):
    rows = spark.createDataFrame([(i, t, t) for i, t in enumerate(TEXTS)] + [(None, "null id", "x")], "doc_id long, text string, id string")
    got = {r.doc_id: r for r in bpe_digest(rows, PATH, P.PATTERN).collect()}
    assert len(got) == len(TEXTS) + 1
    for i, t in enumerate(TEXTS):
        ids = REFERENCE.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    full = {r.doc_id: r.ids for r in bpe_tokens(rows, PATH, P.PATTERN).collect()}
    assert full[4] == REFERENCE.encode_ordinary(TEXTS[4]) and full[0] == []


def test_empty_table(spark):
    assert bpe_digest(spark.createDataFrame([], "doc_id long, text string"), PATH, P.PATTERN).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    bpe = load(PATH, P.PATTERN)
    ids = bpe.encode(text)
    assert ids == REFERENCE.encode_ordinary(text) and bpe.decode(ids).decode() == text


def test_small_cache_stays_right():
    bpe = ByteBpe(read_ranks(PATH), P.PATTERN, most_cached=3)
    for t in ("one two three", "four five six seven", "one two"):
        pieces = bpe.split(t)
        known = bpe.learn(set(pieces))
        assert ",".join(known[p][1] for p in pieces) == ",".join(map(str, REFERENCE.encode_ordinary(t)))


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text("abcx", min_size=1, max_size=200), st.text("aAe ti\n", min_size=1, max_size=80), st.text(min_size=1, max_size=60)))
def test_long_pieces_round_by_round(piece):
    bpe = load(PATH, P.PATTERN)
    assert bpe._merge_long(piece.encode()) == REFERENCE._core_bpe.encode_single_piece(piece.encode())


def test_very_long_pieces():
    bpe = load(PATH, P.PATTERN)
    r = random.Random(3)
    letters = "".join(r.choice(string.ascii_letters) for _ in range(1 << 20))
    for text in ("x" * 300_000, "ab" * 100_000, "the" * 50_000, letters):
        pieces = bpe.split(text)
        began = time.thread_time()
        ids = bpe.encode(text)
        took = time.thread_time() - began
        print(len(text), len(pieces), max(map(len, pieces)), took)
        assert ids == REFERENCE.encode_ordinary(text) and bpe.decode(ids).decode() == text
        assert took < 60
