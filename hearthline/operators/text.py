"""Words, keywords and fuzzy matching over product and document text."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.operators.components import connected_components
from hearthline.operators.ranks import row_positions, value_positions
from hearthline.operators.skew import lookup_join

# Characters stripped from the ends of a word.
STRIP_CHARACTERS = "()[]{}™®"
# Words that are only a number with a unit.
UNIT_PATTERN = r"^[0-9.]+ ?(pr?f|pk|pack|oz|ct|lt|mls?|%)?$"
# Characters replaced by a space, and characters deleted.
SPACE_PATTERN = r"[/\\\-_|+]"
DELETE_PATTERN = r"[<>?!;:}{=&%$#@~^*()\[\]]"


# Up to this many rows per group, Spark limits groups before the shuffle.
PRE_SHUFFLE_LIMIT = 1_000


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean_text(text) -> Column:
    """Separators become spaces, symbols go, spaces are squeezed; case is kept."""
    out = F.regexp_replace(_col(text), SPACE_PATTERN, " ")
    out = F.regexp_replace(out, DELETE_PATTERN, "")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def normalize_text(df: DataFrame, name: str, description: str) -> DataFrame:
    """Cleaned and lower-cased text; an empty name falls back to the description."""
    lowered = F.lower(clean_text(description))
    cleaned = clean_text(name)
    return df.withColumns({
        f"{name}_cleaned": F.lower(cleaned), f"{description}_cleaned": lowered,
        name: F.when(F.length(cleaned) == 0, lowered).otherwise(cleaned)})


def coalesce_text(df: DataFrame, a: str, b: str) -> DataFrame:
    """Fill each of two texts from the other one where it is missing."""
    return df.withColumns({a: F.coalesce(a, b), b: F.coalesce(b, a)})


def word_counts(df: DataFrame, groups: list[str], text: str) -> DataFrame:
    """How often each space-separated word occurs in each group."""
    words = df.select(*groups, F.explode(F.split(F.col(text), " ")).alias("word"))
    return words.groupBy(*groups, "word").agg(F.count(F.lit(1)).alias("n"))


def top_n(df: DataFrame, groups: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group; every task drops its surplus before the shuffle."""
    window = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("position", F.row_number().over(window)).where(F.col("position") <= n)


def joined_by_group(df: DataFrame, groups: list[str], order: str, value: str, name: str,
                    sep: str = ", ") -> DataFrame:
    """Values of a group as one string, in order. The caller bounds the group."""
    pairs = F.sort_array(F.collect_list(F.struct(order, value)))
    text = F.array_join(F.transform(pairs, lambda p: p[value].cast("string")), sep)
    return df.groupBy(*groups).agg(text.alias(name))


def top_words(df: DataFrame, groups: list[str], text: str, n: int) -> DataFrame:
    """The ``n`` most frequent words of each group as one string; ties in word order."""
    best = top_n(word_counts(df, groups, text), groups, [F.desc("n"), F.asc("word")], n)
    return joined_by_group(best, groups, "position", "word", "words")


def global_top_words(df: DataFrame, text: str, n: int) -> DataFrame:
    """The most frequent words of all rows, written ``word (count)``."""
    return (word_counts(df, [], text).orderBy(F.desc("n"), "word").limit(n)
            .select(F.format_string("%s (%d)", "word", "n").alias("word_count")))


def sample_per_group(df: DataFrame, groups: list[str], key: str, n: int) -> DataFrame:
    """``n`` representatives per group in hash order of the key, the same on every run.

    A sample too large for the pre-shuffle limit is first cut down by hash range:
    rows are counted per range, and only the ranges that can hold one of the
    first ``n`` rows go on.
    """
    digest = F.md5(F.col(key).cast("string"))
    if n > PRE_SHUFFLE_LIMIT:
        ranged = df.withColumn("_hash_range", F.conv(F.substring(digest, 1, 5), 16, 10).cast("long"))
        last = (value_positions(ranged, groups, "_hash_range").where(F.col("n_before") < n)
                .groupBy(*groups).agg(F.max("_hash_range").alias("_last")))
        df = (lookup_join(ranged, last, groups, key).where(F.col("_hash_range") <= F.col("_last"))
              .drop("_hash_range", "_last"))
    return top_n(df, groups, [digest, F.col(key)], n)


def _split_words(text: Column, strip: str) -> Column:
    """Words without the stripped characters at their ends; a word of nothing else is left empty.

    The separators take those characters along, so that no word is handled by itself. A run of
    them is tried from its first character only, so that a long one costs no more than its length.
    """
    strip = re.sub(r"\s", "", strip, flags=re.ASCII)  # no word has any
    if not strip:
        return F.split(F.trim(text), r"\s+")
    end = f"[{re.escape(strip)}]"
    separator = rf"\s+{end}*|{end}(?<!{end}{end}){end}*+\s+{end}*"
    return F.split(F.trim(F.trim(text), F.lit(strip)), separator)


def _words(text: Column, strip: str) -> Column:
    return F.filter(_split_words(text, strip), lambda w: w != "")


def keyword_rows(df: DataFrame, keep: list[str], fields: list[str], manufacturer: str | None = None,
                 strip: str = STRIP_CHARACTERS, patterns: tuple[str, ...] = (UNIT_PATTERN,)) -> DataFrame:
    """One row per keyword occurrence.

    The manufacturer's name is removed from the text, words are stripped, and
    single characters, numbers and blocked patterns are dropped.
    """
    texts = [F.lower(f) for f in fields]
    if manufacturer is not None:
        maker = F.trim(F.lower(F.coalesce(manufacturer, F.lit(""))), F.lit(strip))
        texts = [F.replace(t, maker, F.lit("")) for t in texts]
    lists = [F.coalesce(_split_words(t, strip), F.array().cast("array<string>")) for t in texts]
    exploded = df.select(*keep, F.explode(F.concat(*lists)).alias("keyword"))
    blocked = reduce(or_, [F.col("keyword").rlike(p) for p in patterns], F.col("keyword").rlike("^[0-9]+$"))
    return exploded.where((F.length("keyword") > 1) & ~blocked)


def extract_keywords(df: DataFrame, fields: list[str], manufacturer: str | None = None,
                     groups: list[str] | None = None, **options) -> DataFrame:
    """Keywords with their number of occurrences, per group or overall."""
    groups = groups or []
    return keyword_rows(df, groups, fields, manufacturer, **options).groupBy(*groups, "keyword").agg(
        F.count(F.lit(1)).alias("n"))


def cluster_keywords(df: DataFrame, cluster: str, fields: list[str], manufacturer: str | None = None,
                     n: int = 5) -> DataFrame:
    """Most common keywords of every cluster as one string."""
    counted = extract_keywords(df, fields, manufacturer, [cluster])
    best = top_n(counted, [cluster], [F.desc("n"), F.asc("keyword")], n)
    return joined_by_group(best, [cluster], "position", "keyword", "keywords")


def cluster_top_categories(df: DataFrame, cluster: str, category: str, n: int = 3) -> DataFrame:
    """Most common categories of every cluster as one string."""
    counted = df.groupBy(cluster, category).agg(F.count(F.lit(1)).alias("n"))
    best = top_n(counted, [cluster], [F.desc("n"), F.asc(category)], n)
    return joined_by_group(best, [cluster], "position", category, f"top_{category}")


def token_sort_key(text) -> Column:
    """Lower-cased words in alphabetical order, joined by single spaces."""
    plain = F.trim(F.regexp_replace(F.lower(_col(text)), r"[^\p{L}\p{N}_]+", " "))
    return F.array_join(F.array_sort(F.split(plain, " ")), " ")


def key_similarity(a, b) -> Column:
    """100 for equal keys, less by the share of the longer key that must be edited.

    It counts single-character edits. Ratios that count insertions and deletions
    only give other numbers, so thresholds do not carry over between the two.
    """
    a, b = _col(a), _col(b)
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 100.0).otherwise(
        F.round((longest - F.levenshtein(a, b)) * 100 / longest, 4))


def token_sort_similarity(a, b) -> Column:
    """Similarity of two texts whatever the order of their words, 0 to 100."""
    return key_similarity(token_sort_key(a), token_sort_key(b))


def closest_labels(df: DataFrame, column: str, phrase: str, k: int = 5) -> DataFrame:
    """The ``k`` distinct values most similar to a phrase."""
    similarity = token_sort_similarity(F.col(column), F.lit(phrase))
    return (df.select(column).distinct().withColumn("similarity", similarity)
            .orderBy(F.desc("similarity"), column).limit(k))


def _pieces(words: DataFrame, threshold: int) -> DataFrame:
    """Pieces of each word as the shorter side of a pair, for every longer length in reach."""
    size = F.length("key")
    longer = F.explode(F.sequence(size, F.floor(size * 100 / threshold).cast("int")))
    edits = F.floor(F.col("long_len") * (100 - threshold) / 100).cast("int")
    start = F.floor(F.col("piece") * size / (F.col("edits") + 1)).cast("int")
    stop = F.floor((F.col("piece") + 1) * size / (F.col("edits") + 1)).cast("int")
    return (words.withColumn("long_len", longer).withColumn("edits", edits)
            .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("edits"))))
            .select("text", "key", size.alias("short_len"), "long_len", "edits", "piece",
                    F.col("key").substr(start + 1, stop - start).alias("part")))


def _probes(words: DataFrame, threshold: int) -> DataFrame:
    """Substrings of each word as the longer side, at the places a piece may sit.

    Of all edits at most as many as there are pieces before a piece can have shifted
    it, or else an earlier piece is intact; the same holds from the other end, where
    the words differ by their lengths. Such places are enough to lose no pair.
    """
    size = F.length("key")
    edits = F.floor(size * (100 - threshold) / 100).cast("int")
    shorter = F.explode(F.sequence(F.ceil(size * threshold / 100).cast("int"), size))
    start = F.floor(F.col("piece") * F.col("short_len") / (F.col("edits") + 1)).cast("int")
    stop = F.floor((F.col("piece") + 1) * F.col("short_len") / (F.col("edits") + 1)).cast("int")
    span = stop - start
    longer, after = size - F.col("short_len"), F.col("edits") - F.col("piece")
    return (words.withColumn("edits", edits).withColumn("short_len", shorter)
            .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("edits"))))
            .withColumn("low", F.greatest(start - F.col("piece"), start + longer - after, F.lit(0)).cast("int"))
            .withColumn("high", F.least(start + F.col("piece"), start + longer + after, size - span).cast("int"))
            .where("low <= high").withColumn("at", F.explode(F.sequence("low", "high")))
            .select("text", "key", "short_len", size.alias("long_len"), "piece",
                    F.col("key").substr(F.col("at") + 1, span).alias("part")).distinct())


def _keyed(words: DataFrame, column: str) -> DataFrame:
    return (words.select(F.col(column).alias("text")).where(F.col("text").isNotNull()).distinct()
            .withColumn("key", token_sort_key("text")).where(F.length("key") > 0))


def _match(shorter: DataFrame, longer: DataFrame, threshold: int) -> DataFrame:
    """Pairs within the edit budget, found through a shared piece.

    A word cut into one piece more than the allowed edits keeps at least one
    piece intact, so sharing a piece loses no pair. The distance is checked
    inside the join, and only similar pairs leave it.
    """
    a, b = _pieces(shorter, threshold).alias("a"), _probes(longer, threshold).alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("short_len", "long_len", "piece", "part")]
    near = F.levenshtein(F.col("a.key"), F.col("b.key")) <= F.col("a.edits")
    return (a.join(b, [*same, near])
            .select(F.col("a.text").alias("short_text"), F.col("a.key").alias("short_key"),
                    F.col("b.text").alias("long_text"), F.col("b.key").alias("long_key")).distinct())


def similar_pairs(words: DataFrame, column: str, threshold: int) -> DataFrame:
    """Unordered pairs of distinct texts with token-sort similarity of at least ``threshold``."""
    keyed = _keyed(words, column)
    found = _match(keyed, keyed, threshold).where(F.col("short_text") != F.col("long_text"))
    return found.select(
        F.least("short_text", "long_text").alias("word_a"),
        F.greatest("short_text", "long_text").alias("word_b"),
        key_similarity("short_key", "long_key").alias("similarity")).distinct()


def fuzzy_dictionary_join(keywords: DataFrame, column: str, dictionary: DataFrame, word: str,
                          threshold: int) -> DataFrame:
    """Dictionary words similar to each keyword."""
    left, right = _keyed(keywords, column), _keyed(dictionary, word)
    up = _match(left, right, threshold).select(
        F.col("short_text").alias(column), F.col("long_text").alias(word),
        key_similarity("short_key", "long_key").alias("similarity"))
    down = _match(right, left, threshold).select(
        F.col("long_text").alias(column), F.col("short_text").alias(word),
        key_similarity("short_key", "long_key").alias("similarity"))
    return up.unionByName(down).distinct()


def condense_keywords(words: DataFrame, column: str, threshold: int = 83, pairs_of=similar_pairs) -> DataFrame:
    """Partition keywords into groups of similar spelling.

    ``pairs_of`` finds the similar ones: :func:`similar_pairs` by edits, or
    :func:`hearthline.operators.ratio.ratio_pairs` by insertions and deletions.

    Linked keywords form a group, named after its member with the most links (the
    first in word order if tied). Keywords without a link are misfits and have
    no label.
    """
    pairs = pairs_of(words, column, threshold)
    return _condense(words.select(F.col(column).alias("keyword")).distinct(), pairs)


def _condense(keywords: DataFrame, pairs: DataFrame) -> DataFrame:
    ends = pairs.select(F.explode(F.array("word_a", "word_b")).alias("keyword"))
    links = ends.groupBy("keyword").agg(F.count(F.lit(1)).alias("links"))
    groups = connected_components(pairs, "word_a", "word_b").withColumnRenamed("node", "keyword")
    linked = links.join(groups, "keyword")
    labels = linked.groupBy("component").agg(
        F.min(F.struct((-F.col("links")).alias("o"), F.col("keyword").alias("label")))["label"].alias("label"))
    members = linked.join(labels, "component").select("keyword", "label", "links")
    return keywords.join(members, "keyword", "left").fillna(0, ["links"])


def condense_stats(words: DataFrame, column: str, thresholds: list[int], pairs_of=similar_pairs) -> DataFrame:
    """Number, longest and mean size of the groups, and misfits, per threshold.

    Pairs are found once at the lowest threshold. All thresholds share one run of
    the component search, on nodes that carry their threshold.
    """
    pairs = pairs_of(words, column, min(thresholds))
    levels = F.explode(F.array(*[F.lit(t) for t in thresholds]))
    leveled = pairs.withColumn("threshold", levels).where(F.col("similarity") >= F.col("threshold"))
    node = lambda c: F.concat_ws(":", F.col("threshold").cast("string"), c)
    groups = connected_components(
        leveled.select(node("word_a").alias("a1"), node("word_b").alias("b1")), "a1", "b1")
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "threshold", F.substring_index("component", ":", 1).cast("int"))
    total = words.select(F.count_distinct(column)).first()[0]
    found = sizes.groupBy("threshold").agg(
        F.count(F.lit(1)).alias("partitions"), F.max("n").alias("longest"),
        F.round(F.avg("n"), 6).alias("average"), (F.lit(total) - F.sum("n")).alias("misfits"))
    every = words.sparkSession.createDataFrame([(t,) for t in thresholds], "threshold int")
    return every.join(found, "threshold", "left").fillna(0).withColumn(
        "misfits", F.when(F.col("partitions") == 0, F.lit(total)).otherwise(F.col("misfits")))


def expand_keywords(seeds: DataFrame, category: str, items: DataFrame, column: str,
                    threshold: int = 80, join=fuzzy_dictionary_join, pairs_of=similar_pairs) -> DataFrame:
    """Keywords reached from each category through chains of similar keywords.

    A category reaches the keywords similar to it and everything linked to them.
    Following links to the end gives whole components, so the growth needs no
    loop per category.
    """
    above = F.col("similarity") > threshold
    first = join(seeds, category, items, column, threshold).where(above)
    links = pairs_of(items, column, threshold).where(above)
    groups = connected_components(links, "word_a", "word_b").withColumnRenamed("node", column)
    placed = first.select(category, column).join(groups, column, "left")
    direct = placed.select(category, column)
    reached = (placed.where(F.col("component").isNotNull()).select(category, "component").distinct()
               .join(groups, "component").select(category, column))
    return direct.unionByName(reached).distinct()


def curate_keywords(condensed: DataFrame, keep: list[str], blacklist: dict[str, list[str]],
                    overrides: dict[str, list[str]], extra: list[str]) -> DataFrame:
    """Final keyword list: kept groups without blacklisted words, overrides and extras."""
    spark = condensed.sparkSession
    flat = lambda d: [(k, w) for k, words in d.items() for w in words]
    schema = "label string, keyword string"
    banned = spark.createDataFrame(flat(blacklist), schema)
    replaced = spark.createDataFrame(flat(overrides), schema)
    added = spark.createDataFrame([(w,) for w in extra], "keyword string")
    kept = (condensed.where(F.col("label").isin([k for k in keep if k not in overrides]))
            .select("label", "keyword").join(banned, ["label", "keyword"], "left_anti"))
    return kept.unionByName(replaced).select("keyword").unionByName(added).distinct()


def tag_keywords(df: DataFrame, keywords: list[str], fields: list[str],
                 strip: str = STRIP_CHARACTERS) -> DataFrame:
    """Mark rows that contain a keyword, list the hits, and combine the fields.

    For keyword lists short enough to be part of the plan.
    """
    known = F.array(*[F.lit(k) for k in keywords])
    hits = {f"{f}_keywords": F.coalesce(
        F.filter(_words(F.lower(f), strip), lambda w: F.array_contains(known, w)),
        F.array().cast("array<string>")) for f in fields}
    tagged = df.withColumns(hits)
    tagged = tagged.withColumns({f"{f}_match": F.size(f"{f}_keywords") > 0 for f in fields})
    return tagged.withColumn("keyword_match", reduce(or_, [F.col(f"{f}_match") for f in fields]))


def tag_by_keyword_table(df: DataFrame, key: str, text: str, keywords: DataFrame, column: str,
                         strip: str = STRIP_CHARACTERS) -> DataFrame:
    """Number of keyword occurrences and of different keywords per row, for long lists.

    The text becomes one row per word; words are counted per row before they meet
    the keyword table.
    """
    words = df.select(key, F.explode(_words(F.lower(text), strip)).alias(column))
    counted = words.groupBy(key, column).agg(F.count(F.lit(1)).alias("_n"))
    hits = lookup_join(counted, keywords.select(column).distinct(), [column], key, "left_semi")
    return hits.groupBy(key).agg(F.sum("_n").alias("hits"), F.count(F.lit(1)).alias("keywords"))


def flag_comparison(tx: DataFrame, flags: DataFrame, columns: list[str]) -> DataFrame:
    """Households reached by each of several product flags, in one pass."""
    flagged = lookup_join(tx.select("hh_id", "upc"), flags, ["upc"], "hh_id", computed=False)
    per_household = flagged.groupBy("hh_id").agg(
        *[F.max(F.col(c).cast("int")).alias(c) for c in columns])
    totals = per_household.agg(*[F.sum(c).alias(c) for c in columns])
    return totals.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("flag"), F.col(c).alias("households")) for c in columns])).alias("_f")
    ).select("_f.*")


def cluster_text(df: DataFrame, cluster: str, key: str, text: str, span: int = 1_000) -> DataFrame:
    """Texts of a cluster without digits, tab-joined, in parts of ``span`` texts in key order.

    A key counts once in its cluster; only the last part may hold fewer texts.
    """
    plain = F.trim(F.regexp_replace(text, "[0-9]", ""))
    rows = df.where(F.col(text).isNotNull()).groupBy(cluster, key).agg(F.min(plain).alias("_t"))
    placed = row_positions(rows, [cluster], key, "_position").withColumn(
        "part", F.floor((F.col("_position") - 1) / span))
    return joined_by_group(placed, [cluster, "part"], key, "_t", "digest", "\t")


def pattern_cascade(df: DataFrame, text: str, rules: dict[str, str], rest: str = "uncaught") -> DataFrame:
    """Name of the first rule whose pattern matches each text."""
    lowered = F.lower(text)
    label = F.lit(None).cast("string")
    for name, pattern in reversed(rules.items()):
        label = F.when(lowered.rlike(pattern), name).otherwise(label)
    return df.withColumn("rule", F.coalesce(label, F.lit(rest)))


def keyword_categories(lines: DataFrame, column: str, sep: str = ",") -> DataFrame:
    """Distinct keyword and category pairs from delimited lines."""
    parts = F.split(F.col(column), sep, 2)
    return lines.select(F.trim(parts[0]).alias("keyword"), F.trim(parts[1]).alias("category")).where(
        F.col("category").isNotNull() & (F.col("keyword") != "")).distinct()


# The wording of a product sentence.
SENTENCE_MIDDLE = " is a product classified for a "


def product_sentence(df: DataFrame, key: str, description: str, own_diets: str, feed_diets: str) -> DataFrame:
    """Sentence for each product from its description and two lists of diet names.

    ``own_diets`` and ``feed_diets`` are arrays of names. Feed names lose their
    dashes, all names but the last of the feed end in ``diet``, and repeated
    names are dropped.
    """
    def named(name: Column) -> Column:
        return F.when(name.endswith(" diet"), name).otherwise(F.concat(name, F.lit(" diet")))

    own = F.transform(F.coalesce(own_diets, F.array()), lambda n: named(F.lower(n)))
    spaced = F.transform(F.coalesce(feed_diets, F.array()), lambda n: F.replace(n, F.lit("-"), F.lit(" ")))
    count = F.size(spaced)
    feed = F.transform(spaced, lambda n, i: F.when(i < count - 1, named(n)).otherwise(n))
    # Feed names without own ones are followed by an empty name, which is part of the wording.
    last = F.when((F.size(own) == 0) & (count > 0), F.array(F.lit(""))).otherwise(own)
    diets = F.array_join(F.array_distinct(F.concat(feed, last)), ", ")
    text = F.when(diets == "", F.concat(F.col(description), F.lit("."))).otherwise(
        F.concat(F.lit("The "), F.col(description), F.lit(SENTENCE_MIDDLE), diets, F.lit(".")))
    return df.select(key, text.alias("sentence"))
