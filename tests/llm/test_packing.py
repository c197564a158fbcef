import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hearthline.llm import packing, queries, texts

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


def check_bins(rows, capacity):
    """Offsets are gapless from 0 and no sequence is over-full."""
    bins = defaultdict(list)
    for length, sequence, offset in rows:
        bins[sequence].append((offset, length))
    for content in bins.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 5), max_size=8), st.integers(0, 30))
def test_best_fill_is_the_largest_sum(counts, space):
    content = packing.best_fill(counts, space)
    sums = {0}
    for length, n in counts.items():
        sums = {s + length * k for s in sums for k in range(n + 1)}
    assert sum(n * c for n, c in content.items()) == max(s for s in sums if s <= space)
    assert all(c <= counts[n] for n, c in content.items())


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
def test_layout_places_every_piece(counts):
    found = packing.layout(counts, 64)
    length = np.repeat(list(counts), list(counts.values())).astype(np.int64)
    rank = np.concatenate([np.arange(c) for c in counts.values()] or [np.empty(0, np.int64)]).astype(np.int64)
    bins, offset = packing.place(found, length, rank)
    check_bins(zip(length, bins, offset), 64)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aB é'st.,!3́ \x1c—Σς<|endoftxsar>\n", max_size=60))
def test_encoder_agrees_with_the_tokenizer(text):
    expected = Tokenizer.from_file(PATH) if not hasattr(test_encoder_agrees_with_the_tokenizer, "t") else None
    t = test_encoder_agrees_with_the_tokenizer.__dict__.setdefault("t", expected)
    text = text.encode("utf-8", "ignore").decode()
    ids = packing.encoder(PATH)(pa.array(["a b", text, ""]))[1].tolist()
    assert ids == t.encode(text, add_special_tokens=False).ids


def test_encoder_on_special_strings():
    t = Tokenizer.from_file(PATH)
    for text in ("a<|endoftext|>b <|STARTOFTEXT|> <|startoftext|>", "it's DON'T we'll 12a3.", "école, naïve!"):
        assert packing.encoder(PATH)(pa.array(["a b", text, ""]))[1].tolist() == t.encode(
            text, add_special_tokens=False).ids


def test_tables_go_when_another_operator_begins():
    batch = pa.RecordBatch.from_pydict({"text": ["a b"]})
    held = packing.encoder(PATH)
    assert list(texts.small([batch], table=texts.WORD_HASHES)) and packing.encoder(PATH) is not held
    held = packing.encoder(PATH)
    assert list(packing._batches([batch])) and packing.encoder(PATH) is held


def test_tokenizer_takes_bounded_lists(monkeypatch):
    """One thread a task, few results at a time, and the same ids as before."""
    own, taken = Tokenizer.from_file(PATH), []

    class Counted:
        from_file = staticmethod(lambda path: Counted())

        def encode_batch_fast(self, found, **how):
            taken.append(len(found))
            return own.encode_batch_fast(found, **how)

    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    texts.only(None)
    try:
        n = 4_101
        text = " ".join(f"w{k}x" for k in range(n))
        assert packing.encoder(PATH)(pa.array([text]))[0].tolist() == own.encode(text, add_special_tokens=False).ids
        assert max(taken) <= 2_048 and sum(taken) >= n
        assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
    finally:
        texts.only(None)


def test_pack_awkward_rows(spark, texts_frame):
    long = "word " * 5_000
    docs = texts_frame([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (4, long)])
    rows = packing.pack(packing.token_pieces(docs, PATH, capacity=64), 64).collect()
    assert check_bins([(r.length, r.sequence_id, r.offset) for r in rows], 64) == -(-sum(r.length for r in rows) // 64)
    assert Counter(r.doc_id for r in rows if r.doc_id != 4) == {1: 1, 2: 1, 3: 2, None: 1}
    own = sorted((r.piece, r.start, r.length) for r in rows if r.doc_id == 4)
    assert [p for p, _, _ in own] == list(range(len(own))) and sum(n for _, _, n in own) == 5_001
    assert all(s == 64 * p for p, s, _ in own)
    assert packing.pack(packing.token_pieces(docs.limit(0), PATH)).count() == 0


def test_query_against_brute_force(spark):
    t = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = set()
    for d in docs:
        ids = np.array(t.encode(d.text or "", add_special_tokens=False).ids + [0], "<u4")
        for k in range(0, len(ids), 2_048):
            expected.add((d.doc_id, k // 2_048, k, len(ids[k:k + 2_048]), zlib.crc32(ids[k:k + 2_048].tobytes())))
    rows = queries.QUERIES["op9_packing"](spark, SF).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == expected and len(rows) == len(expected)
    bins = check_bins([(r.length, r.sequence_id, r.offset) for r in rows], 2_048)
    assert bins <= 1.02 * sum(r.length for r in rows) / 2_048 + 1
