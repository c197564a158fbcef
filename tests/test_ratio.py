import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hearthline.operators import ratio as R
from hearthline.operators import text as X


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def key(text):
    return " ".join(sorted(re.sub(r"[^\w]+", " ", text.lower()).split()))


def ratio(a, b):
    a, b = key(a), key(b)
    return round(200 * common(a, b) / (len(a) + len(b))) if a or b else 100


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("abcé ", max_size=12), st.text("abcé ", max_size=12)), max_size=8))
def test_common_lengths(pairs):
    found = R.common_lengths([a for a, _ in pairs], [b for _, b in pairs])
    assert found.tolist() == [common(a, b) for a, b in pairs]


def test_long_texts_and_batches(monkeypatch):
    rng = random.Random(1)
    pairs = [("".join(rng.choices("abcd", k=rng.randint(0, n))), "".join(rng.choices("abcd", k=rng.randint(0, n))))
             for n in [5, 62, 63, 64, 65, 130, 300] for _ in range(8)]
    expected = [common(a, b) for a, b in pairs]
    for size in (4_096, 3):
        monkeypatch.setattr(R, "PAIRS", size)
        assert R.common_lengths([a for a, _ in pairs], [b for _, b in pairs]).tolist() == expected


def words(rng, n):
    base = ["".join(rng.choices("abcdeé", k=rng.randint(1, 9))) for _ in range(n)]
    out = []
    for w in base:
        out.append(w)
        for _ in range(rng.randint(0, 3)):
            w = list(w)
            for _ in range(rng.randint(1, 2)):
                at = rng.randrange(len(w) + 1)
                w[at:at + rng.randint(0, 1)] = rng.choice(["", "a", "b", " "])
            out.append("".join(w) or "a")
            w = out[-1]
    return out + ["Two words", "words two", "WORDS, TWO!", "a", "ab", "abc", "aa", "aaa", "aaaa", "", "!!", "x" * 90, "x" * 88 + "yy"]


@pytest.mark.parametrize("threshold,group", [(83, 2_000), (83, 3), (80, 2_000), (95, 2), (100, 2_000), (70, 2_000), (60, 2_000)])
def test_pairs_lose_none(spark, monkeypatch, threshold, group):
    monkeypatch.setattr(R, "GROUP", group)
    own = words(random.Random(threshold), 60)
    found = R.ratio_pairs(spark.createDataFrame([(w,) for w in [*own, None, own[0]]], "w string"), "w", threshold)
    expected = {(a, b, ratio(a, b)) for a in set(own) for b in set(own) if a < b and key(a) and key(b) and ratio(a, b) >= threshold}
    rows = [tuple(r) for r in found.collect()]
    assert set(rows) == expected and len(rows) == len(expected)


def test_join(spark):
    rng = random.Random(3)
    left, right = words(rng, 40), words(rng, 40) + ["tow words"]
    frame = lambda ws, c: spark.createDataFrame([(w,) for w in [*ws, None]], f"{c} string")
    found = R.ratio_join(frame(left, "kw"), "kw", frame(right, "dict"), "dict", 80)
    assert found.columns == ["kw", "dict", "similarity"]
    assert {tuple(r) for r in found.collect()} == {
        (a, b, ratio(a, b)) for a in set(left) for b in set(right) if key(a) and key(b) and ratio(a, b) >= 80}
    assert R.ratio_join(frame([], "kw"), "kw", frame(right, "dict"), "dict", 80).count() == 0


def test_columns_and_closest(spark):
    df = spark.createDataFrame([("new york mets", "mets york NEW!"), ("fuzzy wuzzy", "wuzzy fuzy"), (None, "x"), ("", "")], "a string, b string")
    assert [r.ratio for r in R.with_ratio(df, "a", "b").collect()] == [100, ratio("fuzzy wuzzy", "wuzzy fuzy"), None, 100]
    best = R.closest_by_ratio(df, "a", "york new", 2).collect()
    assert [r.a for r in best] == ["new york mets", "fuzzy wuzzy"]


def test_condense_and_expand(spark):
    own = spark.createDataFrame([(w,) for w in ["yogurt", "yoghurt", "yogourt", "cheese", "cheeses", "milk"]], "w string")
    got = {r.keyword: r.label for r in X.condense_keywords(own, "w", 83, R.ratio_pairs).collect()}
    assert got["yogurt"] == got["yoghurt"] == got["yogourt"] and got["cheese"] == got["cheeses"] and got["milk"] is None
    stats = {r.threshold: (r.partitions, r.longest, r.misfits) for r in X.condense_stats(own, "w", [83, 100], R.ratio_pairs).collect()}
    assert stats == {83: (2, 3, 1), 100: (0, 0, 6)}
    seeds = spark.createDataFrame([("yogurt",)], "cat string")
    reached = {r.w for r in X.expand_keywords(seeds, "cat", own, "w", 80, R.ratio_join, R.ratio_pairs).collect()}
    assert reached == {"yogurt", "yoghurt", "yogourt"}
