import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from hearthline.llm import queries, simhash
from hearthline.llm.texts import shingle_hashes

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, most=2):
    lowest = list(range(len(prints)))

    def root(i):
        while lowest[i] != i:
            i = lowest[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= most:
                a, b = root(i), root(j)
                lowest[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="ab é\t\x1c ", max_size=700))
def test_fingerprint(text):
    found = simhash.fingerprint(shingle_hashes(text.encode(), 3), 64)
    assert int.from_bytes(found, "little") == plain_fingerprint(text)


def test_fingerprint_long_text():
    text = " ".join(random.Random(1).choices("one two three four five".split(), k=3_000))
    assert int.from_bytes(simhash.fingerprint(shingle_hashes(text.encode(), 3), 64), "little") == plain_fingerprint(text)


def test_forest_connects_what_pairs_connect():
    rng = random.Random(2)
    prints = [rng.getrandbits(64) for _ in range(30)]
    for _ in range(90):
        prints.append(rng.choice(prints) ^ (1 << rng.randrange(64)))
    prints = sorted(set(prints))
    edges = simhash.forest(list(range(len(prints))), [p.to_bytes(8, "little") for p in prints], 2)
    assert len(edges) == len(prints) - len(set(plain_components(prints)))
    assert all((prints[a] ^ prints[b]).bit_count() == d <= 2 for a, b, d in edges)


@pytest.mark.parametrize("chunk", [1_024, 4])
def test_links_lose_nothing(spark, chunk):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    prints = {centre}
    for _ in range(60):
        prints.add(centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
        prints.add(rng.getrandbits(64))
    prints = sorted(prints)
    frame = spark.createDataFrame([(i, bytearray(p.to_bytes(8, "little"))) for i, p in enumerate(prints)],
                                  "node long, fp binary")
    edges = simhash.links(frame, chunk=chunk).collect()
    assert all((prints[e.a] ^ prints[e.b]).bit_count() == e.distance <= 2 for e in edges)
    lowest = list(range(len(prints)))
    for _ in prints:
        for e in edges:
            lowest[e.a] = lowest[e.b] = min(lowest[e.a], lowest[e.b])
    assert lowest == plain_components(prints)


def test_groups_of_awkward_rows(spark, texts_frame):
    long = "word " * 40_000
    docs = texts_frame([(5, None), (3, ""), (9, " \n"), (4, "a b c d"), (2, "A  b c\td"), (2, "a b c d"),
                        (None, "alone here"), (7, long), (8, long), (1, "quite another text of words")])
    rows = simhash.simhash_groups(docs).collect()
    by = {(r.doc_id, r.component) for r in rows}
    assert len(rows) == 10
    assert by == {(5, 3), (3, 3), (9, 3), (4, 2), (2, 2), (None, None), (7, 7), (8, 7), (1, 1)}
    assert simhash.simhash_groups(docs.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    prints = [plain_fingerprint(d.text) for d in docs]
    groups = plain_components(prints)
    expected = {(d.doc_id, f"{p:016x}", docs[g].doc_id) for d, p, g in zip(docs, prints, groups)}
    rows = queries.QUERIES["op4_simhash"](spark, SF).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == expected
    assert len(rows) == len(docs)


@pytest.mark.parametrize("chunk", [1_024, 3])
def test_distinct_documents(spark, texts_frame, monkeypatch, chunk):
    """The smallest id of every group stays, as plain code says."""
    monkeypatch.setattr(simhash.links, "__defaults__", (64, 4, 2, 2, chunk))
    rng = random.Random(4)
    rows = []
    for i in range(60):
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(3, 9))) for _ in range(400)]
        rows.append((500 - i, " ".join(words)))
        for k in range(i % 3):
            words[rng.randrange(400)] = "changed"
            rows.append((1_000 + 3 * i + k, " ".join(words)))
        if i % 5 == 0:
            rows.append(rows[-1])
    rows += [(15, ""), (16, None), (17, "tiny"), (None, "solo"), (None, "solo"), (None, "tiny"), (2_000, "SOLO")]
    docs = texts_frame(rows)
    groups = plain_components([plain_fingerprint(t) for _, t in rows])
    expected = {g: min((i is None, i or 0) for (i, _), h in zip(rows, groups) if h == g) for g in set(groups)}
    found = simhash.distinct_documents(docs)
    assert found.columns == docs.columns
    kept = found.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == sorted(expected.values())
    assert len(set(groups)) < len(set(rows))
    assert {(r.doc_id, r.text) for r in kept} <= set(rows)
    assert simhash.distinct_documents(docs.limit(0)).count() == 0
