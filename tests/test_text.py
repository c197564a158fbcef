"""Keyword matching against brute force, and text edge cases."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from hearthline.functions.predicates import regex_match
from hearthline.operators import text as X
from hearthline.operators.components import connected_components


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def key(text):
    return " ".join(sorted(text.lower().split()))


def similar(a, b, threshold):
    a, b = key(a), key(b)
    longest = max(len(a), len(b))
    return (longest - edits(a, b)) * 100 >= threshold * longest


def words(seed, n=120):
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))
        out.add(word if rng.random() < 0.8 else word + " " + "".join(rng.choice("ab") for _ in range(4)))
    return sorted(out)


@pytest.mark.parametrize("threshold", [60, 75, 83, 100])
def test_similar_pairs_loses_none(spark, threshold):
    items = words(threshold)
    df = spark.createDataFrame([(w,) for w in items], "word string")
    got = {(r[0], r[1]) for r in X.similar_pairs(df, "word", threshold).select("word_a", "word_b").collect()}
    assert got == {(a, b) for a, b in combinations(items, 2) if similar(a, b, threshold)}


def test_fuzzy_dictionary_join(spark):
    left, right = words(1, 80), words(2, 80)
    got = X.fuzzy_dictionary_join(spark.createDataFrame([(w,) for w in left], "kw string"), "kw",
                                  spark.createDataFrame([(w,) for w in right], "rw string"), "rw", 70)
    assert {(r["kw"], r["rw"]) for r in got.collect()} == {
        (a, b) for a in left for b in right if similar(a, b, 70)}


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)]
    # A long chain and a hub.
    edges += [(100 + i, 101 + i) for i in range(30)] + [(500, 501 + i) for i in range(40)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b")
    assert {(r[0], r[1]) for r in got.collect()} == {
        (x, root(x)) for e in edges for x in e if e[0] != e[1] or x in parent}


def test_condense_labels_and_misfits(spark):
    items = ["strawberry", "strawbery", "strawberrys", "lime", "limes", "vodka"]
    got = {r["keyword"]: r["label"] for r in X.condense_keywords(
        spark.createDataFrame([(w,) for w in items], "w string"), "w", 80).collect()}
    assert got["strawbery"] == got["strawberrys"] == got["strawberry"] == "strawberry"
    assert got["lime"] == got["limes"] == "lime"
    assert got["vodka"] is None


def test_condense_nothing_similar(spark):
    got = X.condense_keywords(spark.createDataFrame([("abc",), ("xyz",)], "w string"), "w", 90).collect()
    assert [r["label"] for r in got] == [None, None]


def test_keywords_drop_manufacturer_numbers_and_units(spark):
    df = spark.createDataFrame([("ACME Lemon (Tea) 12 oz 6pk x ™Fresh®", "Acme"), (None, "Acme"), ("lemon", None)],
                               "name string, maker string")
    got = {r["keyword"]: r["n"] for r in X.extract_keywords(df, ["name"], "maker").collect()}
    assert got == {"lemon": 2, "tea": 1, "fresh": 1, "oz": 1}


@pytest.mark.parametrize("strip", [X.STRIP_CHARACTERS, "", "^-]&a", "( "])
def test_words_are_stripped_as_one_by_one(spark, strip):
    rng = random.Random(4)
    texts = ["".join(rng.choices("ab^-&()[]™ \t\n", k=rng.randint(0, 30))) for _ in range(400)]
    texts += [None, "", " ", "()", "(" * 5000 + "ab " + ")" * 5000, " (( (ab)) () ab((", "\t(ab)\n"]
    df = spark.createDataFrame(enumerate(texts), "i int, t string")
    words = F.split(F.trim("t"), r"\s+")
    one_by_one = F.filter(F.transform(words, lambda w: F.trim(w, F.lit(strip))), lambda w: w != "")
    assert df.where(~X._words(F.col("t"), strip).eqNullSafe(one_by_one)).count() == 0
    counted = X.extract_keywords(df, ["t", "t"], strip=strip)
    slow = df.select(F.explode(one_by_one).alias("keyword")).where(F.length("keyword") > 1)
    assert {tuple(r) for r in counted.collect()} == {
        (r[0], 2 * r[1]) for r in slow.groupBy("keyword").count().collect()}


def test_keywords_are_split_without_a_step_per_word(spark):
    df = spark.createDataFrame([("a (lemon) tea",)], "t string")
    plan = X.extract_keywords(df, ["t"])._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" in plan and "lambda" not in plan


def test_tagging_a_missing_text(spark):
    df = spark.createDataFrame([(1, None), (2, "Red [Bolt] bolt")], "id long, name string")
    got = {r["id"]: (r["keyword_match"], r["name_keywords"]) for r in X.tag_keywords(df, ["bolt"], ["name"]).collect()}
    assert got == {1: (False, []), 2: (True, ["bolt", "bolt"])}


def test_normalize_falls_back_to_description(spark):
    df = spark.createDataFrame([("(@)", " Fresh/Sliced  [Bread]! "), ("A_b", "x")], "n string, d string")
    got = [tuple(r) for r in X.normalize_text(df, "n", "d").select("n", "n_cleaned", "d_cleaned").collect()]
    assert got == [("fresh sliced bread", "", "fresh sliced bread"), ("A b", "a b", "x")]


def test_regex_without_exclusion_and_null_text(spark):
    df = spark.createDataFrame([(1, "red bolt", None), (2, None, "red nut"), (3, None, None)],
                               "id long, name string, about string")
    found = lambda spec: {r["id"] for r in df.where(regex_match(["name", "about"], spec)).collect()}
    assert found({"must_contain": [["red"]]}) == {1, 2}
    assert found({"must_contain": [["red"], ["nut", "bolt"]], "must_not_contain": [["nut"]]}) == {1}
    assert found({"must_not_contain": [["red"]]}) == {3}


def test_sentences(spark):
    df = spark.createDataFrame([
        (1, "tea", ["VEGAN"], ["vegan", "low-salt"]), (2, "milk", [], []), (3, "rice", ["KETO", "KETO"], [])],
        "id long, d string, own array<string>, feed array<string>")
    got = {r["id"]: r["sentence"] for r in X.product_sentence(df, "id", "d", "own", "feed").collect()}
    assert got[2] == "milk."
    assert got[3] == "The rice is a product classified for a keto diet."
    assert got[1] == "The tea is a product classified for a vegan diet, low salt."


def test_top_words_tie_in_word_order(spark):
    df = spark.createDataFrame([("g", "b a c"), ("g", "c")], "g string, t string")
    assert X.top_words(df, ["g"], "t", 2).first()["words"] == "c, a"


def test_condense_stats_counts_every_word(spark):
    items = words(11, 60)
    df = spark.createDataFrame([(w,) for w in items], "w string")
    for row in X.condense_stats(df, "w", [70, 85, 95]).collect():
        linked = {w for p in combinations(items, 2) if similar(*p, row["threshold"]) for w in p}
        assert row["misfits"] == len(items) - len(linked)


def test_expansion_follows_chains(spark):
    items = spark.createDataFrame([("berry",), ("berrys",), ("berryss",), ("stone",)], "w string")
    seeds = spark.createDataFrame([("berri",), ("cloud",)], "c string")
    got = {(r["c"], r["w"]) for r in X.expand_keywords(seeds, "c", items, "w", 79).collect()}
    assert got == {("berri", "berry"), ("berri", "berrys"), ("berri", "berryss")}
    assert items.where(F.col("w") == "stone").count() == 1


def test_long_keys_lose_no_pair(spark):
    rng = random.Random(12)
    items = set()
    for _ in range(6):
        base = "".join(rng.choices("abcdefgh", k=rng.randint(120, 150)))
        items.add(base)
        for edits in (3, 12, 20, 27):
            text = list(base)
            for _ in range(edits):
                at = rng.randrange(len(text))
                text[at:at + 1] = rng.choice([[], [rng.choice("abcdefgh")], [text[at], "x"]])
            items.add("".join(text))
    items = sorted(items)
    df = spark.createDataFrame([(w,) for w in items], "w string")
    got = {(r["word_a"], r["word_b"]) for r in X.similar_pairs(df, "w", 80).collect()}
    want = {(a, b) for a, b in combinations(items, 2) if similar(a, b, 80)}
    assert got == want and len(want) > 20
