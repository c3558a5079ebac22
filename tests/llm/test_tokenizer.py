import random

import numpy as np
import pytest
import regex
import tiktoken

from postloom.llm import tokenizer as tk
from postloom.runtime import table

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@pytest.fixture(scope="module")
def pair():
    enc = tk.encoder(tk.VOCABULARY)
    return enc, tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=enc.ranks, special_tokens={})


def texts(n, seed=1):
    r = random.Random(seed)
    alphabet = list("abc dé12 \n\t''! ?..  \r\n  x²½ъά你") + ["'s", "'t", "'re", "'ll", "'ve", "'d", "'m", "\U0001f600", "​", "\x1c", "<|endoftext|>", "S'T"]
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, 30))) for _ in range(n)]


def test_random_texts_against_a_library(pair):
    ours, theirs = pair
    batch = [*texts(4000), "", " ", "   ", "'", "a" * 5000, "=" * 3000 + "x", " " * 3000 + "y", "ab" * 50_000]
    got = ours.encode_batch(batch)
    assert got == [theirs.encode_ordinary(t) for t in batch]
    assert all(ours.decode(ids) == t.encode() for ids, t in zip(got, batch))


def test_boundaries_against_a_pattern():
    batch = texts(2000, 2)
    for text, at in zip(batch, tk.boundaries(batch)):
        assert [text[a:b] for a, b in zip(at, at[1:])] == regex.findall(PATTERN, text)


def test_scan_is_the_same_for_any_number_of_blocks():
    cls = np.random.default_rng(3).integers(0, 9, 5000).astype(np.int8)
    assert len({tk.scan_begins(cls, b).tobytes() for b in (1, 2, 7, 1024, 5000)}) == 1


def test_nulls_empty_and_extra_columns(spark):
    df = spark.createDataFrame([(1, None, 9), (2, "", 9), (None, "hi", 9), (2, "", 9)], "doc_id long, text string, ids int")
    got = sorted((r.doc_id or 0, r.ids) for r in tk.encode_texts(df).collect())
    assert got == [(0, tk.encoder(tk.VOCABULARY).encode_batch(["hi"])[0]), (1, []), (2, []), (2, [])]
    assert tk.encode_texts(df.limit(0)).count() == 0
    assert sorted(r.n_tokens for r in tk.count_tokens(df).collect()) == [0, 0, 0, 1]


def test_whole_table(spark, folder, pair):
    docs = table(spark, folder, "documents")
    want = {r.doc_id: pair[1].encode_ordinary(r.text or "") for r in docs.collect()}
    assert {r.doc_id: r.ids for r in tk.encode_texts(docs).collect()} == want


def test_places_and_decoding(spark, folder, pair):
    docs = table(spark, folder, "documents")
    for r in tk.encode_with_places(docs).join(docs, "doc_id").collect():
        text, at = r.text or "", r.places
        assert len(at) == len(r.ids) and at == sorted(at)
        # The ids of a slice are the bytes of the text from its place to the next one.
        starts = sorted(set(at))
        for a, b in zip(starts, [*starts[1:], len(text) + 1]):
            assert pair[0].decode([i for i, p in zip(r.ids, at) if p == a]).decode() == text[a - 1 : b - 1]
    assert {r.doc_id: r.text for r in tk.decode_ids(tk.encode_texts(docs)).collect()} == {r.doc_id: r.text or "" for r in docs.collect()}
    odd = spark.createDataFrame([(1, None), (2, []), (3, pair[0].encode_batch(["\U0001f600"])[0][:1])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in tk.decode_ids(odd).collect()} == {1: None, 2: "", 3: "\ufffd"}
