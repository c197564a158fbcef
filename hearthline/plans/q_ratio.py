"""Queries on the insert-delete ratio of texts, at the thresholds that such ratios are used with."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearthline.operators import ratio as R
from hearthline.operators import text as X
from hearthline.plans.q_text import KEY, SAID, TOKENS, spoken, tokens
from hearthline.plans.registry import query
from hearthline.sources.tables import read_table

# Longest common subsequence by one row of the table at a time; the pairs are in "cand (u, v, a, b)".
COMMON = """
steps AS (
  SELECT u, v, a, b, 1 AS j, list_transform(range(1, length(a) + 1), lambda k: CAST(0 AS BIGINT)) AS r FROM cand
  UNION ALL
  SELECT u, v, a, b, j + 1, list_transform(range(1, length(a) + 1), lambda k: list_max(list_transform(range(1, k + 1),
    lambda i: greatest(r[i], CASE WHEN a[i] = b[j] THEN 1 + CASE WHEN i > 1 THEN r[i - 1] ELSE 0 END ELSE 0 END))))
  FROM steps WHERE j <= length(b)),
rated AS (
  SELECT u, v, CAST(CASE WHEN length(a) + length(b) = 0 THEN 100
    ELSE round_even(200.0 * CASE WHEN length(a) = 0 THEN 0 ELSE r[length(a)] END / (length(a) + length(b)), 0) END AS BIGINT) AS ratio
  FROM steps WHERE j = length(b) + 1)"""
# Edits of one character are never more than insertions and deletions.
NEAR = "length({0}) > 0 AND length({1}) > 0 AND 200 * levenshtein({0}, {1}) <= (201 - 2 * {2}) * (length({0}) + length({1}))"


def rated(sources: str, pairs: str) -> str:
    return f"WITH RECURSIVE {sources}, cand AS ({pairs}), {COMMON}"


@query("x07_token_sort_ratio", rated(
    "p AS (SELECT DISTINCT p_name, p_type || ' ' || split_part(p_name, ' ', 2) AS other FROM part)",
    f"SELECT p_name AS u, other AS v, {KEY.format('p_name')} AS a, {KEY.format('other')} AS b FROM p")
    + " SELECT u AS name, v AS other, ratio FROM rated")
def x07_ratio(spark, folder):
    other = F.concat_ws(" ", "p_type", F.split("p_name", " ")[1])
    pairs = read_table(spark, folder, "part").select(F.col("p_name").alias("name"), other.alias("other")).distinct()
    return R.with_ratio(pairs, "name", "other")


@query("x08_closest_by_ratio", rated(
    "p AS (SELECT DISTINCT p_name FROM part)", f"SELECT p_name AS u, '' AS v, {KEY.format('p_name')} AS a, 'gadget read' AS b FROM p")
    + " SELECT u AS p_name, ratio FROM rated ORDER BY ratio DESC, p_name LIMIT 5")
def x08_ratio(spark, folder):
    return R.closest_by_ratio(read_table(spark, folder, "part"), "p_name", "Read gadget", 5)


PART_PAIRS = rated(
    f"p AS (SELECT DISTINCT p_name, {KEY.format('p_name')} AS key FROM part)",
    f"SELECT x.p_name AS u, y.p_name AS v, x.key AS a, y.key AS b FROM p x JOIN p y ON x.p_name < y.p_name AND {NEAR.format('x.key', 'y.key', 80)}")


@query("j12_ratio_join", PART_PAIRS + " SELECT u AS word_a, v AS word_b, ratio AS similarity FROM rated WHERE ratio >= 80")
def j12_ratio(spark, folder):
    return R.ratio_pairs(read_table(spark, folder, "part"), "p_name", 80)


def token_pairs(threshold: int) -> str:
    return rated(TOKENS, f"""SELECT x.keyword AS u, y.keyword AS v, x.key AS a, y.key AS b FROM toks x JOIN toks y
ON x.keyword < y.keyword AND abs(length(x.key) - length(y.key)) * 200 <= (201 - 2 * {threshold}) * (length(x.key) + length(y.key))
 AND {NEAR.format('x.key', 'y.key', threshold)}""")


GROUPS = """,
pairs AS (SELECT u, v FROM rated WHERE {0} UNION ALL SELECT v, u FROM rated WHERE {0}),
reach(u, v) AS (SELECT u, v FROM pairs UNION SELECT r.u, p.v FROM reach r JOIN pairs p ON r.v = p.u),
comp AS (SELECT u AS keyword, least(u, MIN(v)) AS component FROM reach GROUP BY u),
deg AS (SELECT u AS keyword, COUNT(*) AS links FROM pairs GROUP BY 1)"""


@query("x09_condense_by_ratio", token_pairs(83) + GROUPS.format("ratio >= 83") + """,
best AS (SELECT component, keyword AS label FROM (
  SELECT component, keyword, row_number() OVER (PARTITION BY component ORDER BY links DESC, keyword) AS rn FROM comp JOIN deg USING (keyword)) WHERE rn = 1)
SELECT t.keyword, COALESCE(b.label, '') AS label, COALESCE(d.links, 0) AS links
FROM toks t LEFT JOIN comp c USING (keyword) LEFT JOIN best b USING (component) LEFT JOIN deg d ON d.keyword = t.keyword""")
def x09_ratio(spark, folder):
    return X.condense_keywords(tokens(spark, folder), "keyword", 83, R.ratio_pairs).fillna("", ["label"])


def said_pairs(threshold: int) -> str:
    return f"""SELECT toks.keyword AS u, words.word AS v, toks.key AS a, words.key AS b FROM toks JOIN words
ON abs(length(toks.key) - length(words.key)) * 200 <= (201 - 2 * {threshold}) * (length(toks.key) + length(words.key))
 AND {NEAR.format('toks.key', 'words.key', threshold)}"""


@query("x12_ratio_dictionary_join", rated(f"{TOKENS}, {SAID}", said_pairs(80))
       + " SELECT u AS keyword, v AS word, ratio AS similarity FROM rated WHERE ratio >= 80")
def x12_ratio(spark, folder):
    return R.ratio_join(tokens(spark, folder), "keyword", spoken(spark, folder), "word", 80)


@query("x19_ratio_stats", token_pairs(80) + """,
level AS (SELECT unnest([80, 85, 90]) AS t),
pairs AS (SELECT t, u, v FROM rated, level WHERE ratio >= t UNION ALL SELECT t, v, u FROM rated, level WHERE ratio >= t),
reach(t, u, v) AS (SELECT t, u, v FROM pairs UNION SELECT r.t, r.u, p.v FROM reach r JOIN pairs p ON r.v = p.u AND r.t = p.t),
comp AS (SELECT t, u AS keyword, least(u, MIN(v)) AS component FROM reach GROUP BY 1, 2),
sizes AS (SELECT t, component, COUNT(*) AS n FROM comp GROUP BY 1, 2)
SELECT t AS threshold, COUNT(n) AS partitions, COALESCE(MAX(n), 0) AS longest, COALESCE(ROUND(AVG(n), 6), 0) AS average,
  CAST((SELECT COUNT(*) FROM toks) - COALESCE(SUM(n), 0) AS BIGINT) AS misfits FROM level LEFT JOIN sizes USING (t) GROUP BY 1""")
def x19_ratio(spark, folder):
    return X.condense_stats(tokens(spark, folder), "keyword", [80, 85, 90], R.ratio_pairs)
