"""Text and keyword queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearthline.operators import text as X
from hearthline.operators.reports import describe
from hearthline.plans.bindings import with_tx
from hearthline.plans.registry import query
from hearthline.sources.tables import read_table, spread, transactions

WORDS = "w AS (SELECT lang, unnest(string_split(lower(text), ' ')) AS word FROM documents)"


def documents(spark, folder):
    docs = spread(read_table(spark, folder, "documents", ["doc_id", "lang", "text"]), "doc_id")
    return docs.withColumn("text", F.lower("text"))


@query("x01_word_counts", f"WITH {WORDS} SELECT lang, word, COUNT(*) AS n FROM w GROUP BY 1, 2")
def x01(spark, folder):
    return X.word_counts(documents(spark, folder), ["lang"], "text")


@query("x02_top_words_per_group", f"""
WITH {WORDS}, c AS (SELECT lang, word, COUNT(*) AS n FROM w GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rn FROM c)
SELECT lang, string_agg(word, ', ' ORDER BY rn) AS words FROM r WHERE rn <= 100 GROUP BY 1""")
def x02(spark, folder):
    return X.top_words(documents(spark, folder), ["lang"], "text", 100)


@query("x03_global_top_words", f"""
WITH {WORDS}, c AS (SELECT word, COUNT(*) AS n FROM w GROUP BY 1)
SELECT word || ' (' || CAST(n AS VARCHAR) || ')' AS word_count FROM c ORDER BY n DESC, word LIMIT 50""")
def x03(spark, folder):
    return X.global_top_words(documents(spark, folder), "text", 50)


CHARS = "()[]{}™®"
UNIT = "^[0-9.]+ ?(pr?f|pk|pack|oz|ct|lt|mls?|%)?$"
KEYWORDS = f"""kw AS (
  SELECT k AS keyword, @keep FROM (
    SELECT trim(unnest(string_split_regex(trim(replace(lower(p_name), lower(split_part(p_name, ' ', 1)), '')), '\\s+')), '{CHARS}') AS k, @keep FROM part)
  WHERE length(k) > 1 AND NOT regexp_matches(k, '{UNIT}') AND NOT regexp_matches(k, '^[0-9]+$'))"""


def makers(spark, folder):
    """Products with the first word of their name standing for the manufacturer."""
    return read_table(spark, folder, "part").withColumn("maker", F.split("p_name", " ")[0])


@query("x04_extract_keywords", f"""
WITH {KEYWORDS.replace('@keep', 'p_type')} SELECT keyword, COUNT(*) AS n FROM kw GROUP BY 1""")
def x04(spark, folder):
    return X.extract_keywords(makers(spark, folder), ["p_name"], "maker")


@query("x04_extract_keywords_documents", f"""
WITH kw AS (SELECT trim(unnest(string_split_regex(trim(lower(text), ' '), '\\s+')), '{CHARS}') AS k FROM documents)
SELECT k AS keyword, COUNT(*) AS n FROM kw
WHERE k <> '' AND length(k) > 1 AND NOT regexp_matches(k, '{UNIT}') AND NOT regexp_matches(k, '^[0-9]+$') GROUP BY 1""")
def x04_documents(spark, folder):
    return X.extract_keywords(documents(spark, folder), ["text"])


@query("x05_cluster_keywords", f"""
WITH {KEYWORDS.replace('@keep', 'p_size')}, c AS (SELECT p_size, keyword, COUNT(*) AS n FROM kw GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY p_size ORDER BY n DESC, keyword) AS rn FROM c)
SELECT p_size, string_agg(keyword, ', ' ORDER BY rn) AS keywords FROM r WHERE rn <= 5 GROUP BY 1""")
def x05(spark, folder):
    return X.cluster_keywords(makers(spark, folder), "p_size", ["p_name"], "maker")


@query("x06_cluster_top_categories", """
WITH c AS (SELECT p_size, p_brand, COUNT(*) AS n FROM part GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY p_size ORDER BY n DESC, p_brand) AS rn FROM c)
SELECT p_size, string_agg(p_brand, ', ' ORDER BY rn) AS top_p_brand FROM r WHERE rn <= 3 GROUP BY 1""")
def x06(spark, folder):
    return X.cluster_top_categories(read_table(spark, folder, "part"), "p_size", "p_brand")


KEY = ("array_to_string(list_sort(string_split(trim(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g')), ' ')), ' ')")
# DuckDB counts edits in bytes: each accented letter becomes one unused letter, so that they are edits of characters.
PLAIN = "translate(" + KEY + ", 'äöüßéèêëàâçñáíóúîôûùïœ', 'ABCDEFGHIJKLMNOPQRSTUV')"
SIM = ("ROUND((greatest(length({0}), length({1})) - levenshtein({0}, {1})) * 100 / greatest(length({0}), length({1})), 4)")


@query("x07_token_sort_similarity", f"""
WITH k AS (SELECT p_partkey, {KEY.format('p_name')} AS a, {KEY.format("p_type || ' ' || split_part(p_name, ' ', 2)")} AS b FROM part)
SELECT p_partkey, {SIM.format('a', 'b')} AS similarity FROM k""")
def x07(spark, folder):
    other = F.concat_ws(" ", "p_type", F.split("p_name", " ")[1])
    return read_table(spark, folder, "part").select(
        "p_partkey", X.token_sort_similarity("p_name", other).alias("similarity"))


@query("x08_closest_labels", f"""
WITH k AS (SELECT DISTINCT p_name, {KEY.format('p_name')} AS a FROM part)
SELECT p_name, {SIM.format('a', "'gadget read'")} AS similarity FROM k ORDER BY similarity DESC, p_name LIMIT 5""")
def x08(spark, folder):
    return X.closest_labels(read_table(spark, folder, "part"), "p_name", "Read gadget", 5)


def tokens(spark, folder):
    """Distinct keywords of the benchmark passages."""
    return X.keyword_rows(read_table(spark, folder, "benchmark"), [], ["text"]).distinct()


TOKENS = f"""toks AS (
  SELECT DISTINCT k AS keyword, {PLAIN.format('k')} AS key FROM (
    SELECT trim(unnest(string_split_regex(trim(lower(text), ' '), '\\s+')), '{CHARS}') AS k FROM benchmark)
  WHERE length(k) > 1 AND NOT regexp_matches(k, '{UNIT}') AND NOT regexp_matches(k, '^[0-9]+$'))"""
NEAR = ("(greatest(length({0}), length({1})) - levenshtein({0}, {1})) * 100 >= {2} * greatest(length({0}), length({1}))")


@query("x09_similar_pairs", f"""
WITH {TOKENS} SELECT a.keyword AS word_a, b.keyword AS word_b, {SIM.format('a.key', 'b.key')} AS similarity
FROM toks a JOIN toks b ON a.keyword < b.keyword WHERE length(a.key) > 0 AND length(b.key) > 0 AND {NEAR.format('a.key', 'b.key', 83)}""")
def x09_pairs(spark, folder):
    return X.similar_pairs(tokens(spark, folder), "keyword", 83)


COMPONENTS = f"""WITH RECURSIVE {TOKENS},
pairs AS (SELECT a.keyword AS u, b.keyword AS v FROM toks a JOIN toks b ON a.keyword <> b.keyword
          WHERE length(a.key) > 0 AND length(b.key) > 0 AND {NEAR.format('a.key', 'b.key', '{t}')}),
reach(u, v) AS (SELECT u, v FROM pairs UNION SELECT r.u, p.v FROM reach r JOIN pairs p ON r.v = p.u),
comp AS (SELECT u AS keyword, least(u, MIN(v)) AS component FROM reach GROUP BY u),
deg AS (SELECT u AS keyword, COUNT(*) AS links FROM pairs GROUP BY 1)"""


@query("x09_condense_keywords", COMPONENTS.replace("{t}", "83") + """,
best AS (SELECT component, keyword AS label FROM (
  SELECT component, keyword, row_number() OVER (PARTITION BY component ORDER BY links DESC, keyword) AS rn FROM comp JOIN deg USING (keyword)) WHERE rn = 1)
SELECT t.keyword, COALESCE(b.label, '') AS label, COALESCE(d.links, 0) AS links
FROM toks t LEFT JOIN comp c USING (keyword) LEFT JOIN best b USING (component) LEFT JOIN deg d ON d.keyword = t.keyword""")
def x09(spark, folder):
    return X.condense_keywords(tokens(spark, folder), "keyword", 83).fillna("", ["label"])


SAID = f"""words AS (
  SELECT DISTINCT w AS word, {PLAIN.format('w')} AS key FROM (SELECT unnest(string_split(lower(text), ' ')) AS w FROM conversations) WHERE w <> '')"""


def spoken(spark, folder):
    """Distinct words of the conversations."""
    said = read_table(spark, folder, "conversations").select(F.explode(F.split(F.lower("text"), " ")).alias("word"))
    return said.where("word <> ''").distinct()


ABOVE = "(greatest(length({0}), length({1})) - levenshtein({0}, {1})) * 100 > 80 * greatest(length({0}), length({1}))"


@query("x10_expand_keywords", f"""WITH RECURSIVE {TOKENS}, {SAID},
pairs AS (SELECT a.keyword AS u, b.keyword AS v FROM toks a JOIN toks b ON a.keyword <> b.keyword
          WHERE length(a.key) > 0 AND length(b.key) > 0 AND {ABOVE.format('a.key', 'b.key')}),
reach(word, keyword) AS (
  SELECT word, keyword FROM words JOIN toks ON length(toks.key) > 0 AND length(words.key) > 0
    AND abs(length(toks.key) - length(words.key)) * 100 <= 20 * greatest(length(toks.key), length(words.key))
    AND {ABOVE.format('toks.key', 'words.key')}
  UNION SELECT r.word, p.v FROM reach r JOIN pairs p ON r.keyword = p.u)
SELECT word, keyword FROM reach""")
def x10(spark, folder):
    return X.expand_keywords(spoken(spark, folder), "word", tokens(spark, folder), "keyword", 80)


@query("x11_curate_keywords", """
WITH c AS (SELECT DISTINCT p_type AS label, lower(p_name) AS keyword FROM part)
SELECT DISTINCT keyword FROM (
  SELECT keyword FROM c WHERE label IN ('ECONOMY', 'PROMO') AND NOT (label = 'ECONOMY' AND keyword IN ('red bolt', 'hot rod'))
  UNION ALL SELECT unnest(['gold ring', 'silver ring']) UNION ALL SELECT unnest(['spare part']))""")
def x11(spark, folder):
    condensed = read_table(spark, folder, "part").select(
        F.col("p_type").alias("label"), F.lower("p_name").alias("keyword")).distinct()
    return X.curate_keywords(condensed, ["ECONOMY", "PROMO", "SMALL"], {"ECONOMY": ["red bolt", "hot rod"]},
                             {"SMALL": ["gold ring", "silver ring"]}, ["spare part"])


@query("x12_fuzzy_dictionary_join", f"""
WITH {TOKENS}, {SAID}
SELECT keyword, word, {SIM.format('toks.key', 'words.key')} AS similarity FROM toks JOIN words
ON length(toks.key) > 0 AND length(words.key) > 0 AND abs(length(toks.key) - length(words.key)) * 100 <= 20 * greatest(length(toks.key), length(words.key))
  AND {NEAR.format('toks.key', 'words.key', 80)}""")
def x12(spark, folder):
    return X.fuzzy_dictionary_join(tokens(spark, folder), "keyword", spoken(spark, folder), "word", 80)


TAGS = ["bolt", "ring", "widget"]


@query("x13_tag_keywords", """
WITH t AS (SELECT p_partkey, p_type, list_filter(string_split(lower(p_name), ' '), lambda w: w IN ('bolt', 'ring', 'widget')) AS hits FROM part)
SELECT p_partkey, array_to_string(hits, ',') AS hits, len(hits) > 0 AS keyword_match FROM t""")
def x13(spark, folder):
    tagged = X.tag_keywords(read_table(spark, folder, "part"), TAGS, ["p_name", "p_type"])
    return tagged.select("p_partkey", F.array_join("p_name_keywords", ",").alias("hits"), "keyword_match")


@query("x13_tag_by_keyword_table", f"""
WITH {TOKENS}, w AS (SELECT doc_id, trim(unnest(string_split_regex(trim(lower(text), ' '), '\\s+')), '{CHARS}') AS word FROM documents)
SELECT doc_id, COUNT(*) AS hits, COUNT(DISTINCT word) AS keywords FROM w WHERE word IN (SELECT keyword FROM toks) GROUP BY 1""")
def x13_table(spark, folder):
    return X.tag_by_keyword_table(documents(spark, folder), "doc_id", "text",
                                  tokens(spark, folder), "keyword")


@query("x14_flag_comparison", with_tx(body=""",
f AS (SELECT p_partkey AS upc, p_name LIKE '%ring' AS manual, p_type = 'SMALL' AS subcom, p_name LIKE '%ring' OR p_type = 'SMALL' AS augmented FROM part)
SELECT 'manual' AS flag, COUNT(DISTINCT CASE WHEN manual THEN hh_id END) AS households FROM tx JOIN f USING (upc)
UNION ALL SELECT 'subcom', COUNT(DISTINCT CASE WHEN subcom THEN hh_id END) FROM tx JOIN f USING (upc)
UNION ALL SELECT 'augmented', COUNT(DISTINCT CASE WHEN augmented THEN hh_id END) FROM tx JOIN f USING (upc)"""))
def x14(spark, folder):
    manual, subcom = F.col("p_name").like("%ring"), F.col("p_type") == "SMALL"
    flags = read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("upc"), manual.alias("manual"), subcom.alias("subcom"),
        (manual | subcom).alias("augmented"))
    return X.flag_comparison(transactions(spark, folder), flags, ["manual", "subcom", "augmented"])


@query("x15_text_stats", """
SELECT lang, COUNT(*) AS count, ROUND(CAST(SUM(length(text)) AS BIGINT) / COUNT(*), 4) AS mean, ROUND(stddev_samp(length(text)), 2) AS stddev,
  CAST(MIN(length(text)) AS INTEGER) AS min, CAST(quantile_disc(length(text), 0.25) AS INTEGER) AS q1, CAST(quantile_disc(length(text), 0.5) AS INTEGER) AS median,
  CAST(quantile_disc(length(text), 0.75) AS INTEGER) AS q3, CAST(MAX(length(text)) AS INTEGER) AS max FROM documents GROUP BY 1""")
def x15(spark, folder):
    lengths = read_table(spark, folder, "documents").select("lang", F.length("text").alias("len"))
    return describe(lengths, "len", ["lang"])


@query("x16_cluster_text", """
SELECT p_type, (n - 1) // 1000 AS part, string_agg(trim(regexp_replace(p_name || ' ' || p_size, '[0-9]', '', 'g')), chr(9) ORDER BY p_partkey) AS digest
FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS n FROM part) GROUP BY 1, 2""")
def x16(spark, folder):
    texts = read_table(spark, folder, "part").withColumn("t", F.concat_ws(" ", "p_name", F.col("p_size").cast("string")))
    return X.cluster_text(texts, "p_type", "p_partkey", "t")


RULES = {"two_words": r"^[a-z]+ (bolt|rod)$", "old_things": r"^old ", "flavour": r"(hot|cold|red)"}


@query("x17_pattern_cascade", """
SELECT CASE WHEN regexp_matches(lower(p_name), '^[a-z]+ (bolt|rod)$') THEN 'two_words' WHEN regexp_matches(lower(p_name), '^old ') THEN 'old_things'
  WHEN regexp_matches(lower(p_name), '(hot|cold|red)') THEN 'flavour' ELSE 'uncaught' END AS rule, COUNT(*) AS products FROM part GROUP BY 1""")
def x17(spark, folder):
    return X.pattern_cascade(read_table(spark, folder, "part"), "p_name", RULES).groupBy("rule").agg(
        F.count(F.lit(1)).alias("products"))


@query("x18_keyword_categories", """
WITH c AS (SELECT DISTINCT p_name AS keyword, p_type AS category FROM part)
SELECT category, COUNT(*) AS keywords FROM c GROUP BY 1""")
def x18(spark, folder):
    lines = read_table(spark, folder, "part").select(F.concat("p_name", F.lit(" , "), "p_type").alias("line"))
    return X.keyword_categories(lines, "line").groupBy("category").agg(F.count(F.lit(1)).alias("keywords"))


@query("x19_condense_stats", "SELECT * FROM (" + " UNION ALL ".join(
    "(" + COMPONENTS.replace("{t}", str(t)) + f""", sizes AS (SELECT component, COUNT(*) AS n FROM comp GROUP BY 1)
SELECT {t} AS threshold, COUNT(*) AS partitions, COALESCE(MAX(n), 0) AS longest, COALESCE(ROUND(AVG(n), 6), 0) AS average,
  CAST((SELECT COUNT(*) FROM toks) - COALESCE(SUM(n), 0) AS BIGINT) AS misfits FROM sizes)""" for t in (80, 85, 90)) + ")")
def x19(spark, folder):
    return X.condense_stats(tokens(spark, folder), "keyword", [80, 85, 90])
