"""Quality rules: cutoffs whose false rejections are bounded on labelled holdouts, all in SQL expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spill, table

#: Rule name, statistic over the features (the larger, the worse) and its cutoff at each level, from lenient to strict.
RULES = {
    "symbols": ("100D * n_symbols / n_words", (80, 60, 40, 30, 20, 15, 10, 5)),
    "repeats": ("100D * n_repeat_words / n_words", (48, 45, 40, 35, 30, 25, 20, 15)),
    "same_lines": ("100D * n_dup_lines / n_words", (16, 12, 8, 6, 5, 4, 3, 2)),
    "long_words": ("1D * word_chars / n_words", (20, 16, 14, 12, 11, 10, 9, 8)),
}
LEVELS = 8
#: Strata by number of words, from (inclusive).
STRATA = (0, 200, 600)

#: All features of one text in one pass; w are its words and s its 3-word windows by hash and place.
FEATURES = r"""
transform(array(filter(split(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), x -> x <> '')), w -> named_struct(
  'n_words', cast(size(w) as bigint),
  'word_chars', cast(length(array_join(w, '')) as bigint),
  'n_repeat_words', if(size(w) < 4, 0L, transform(
    array(sort_array(transform(sequence(0, size(w) - 3), i -> struct(xxhash64(w[i], w[i + 1], w[i + 2]) as h, i as i)))),
    s -> transform(
      array(sort_array(transform(filter(s, (x, j) -> (j > 0 and s[if(j > 0, j - 1, 0)].h = x.h) or (j < size(s) - 1 and s[if(j < size(s) - 1, j + 1, 0)].h = x.h)), x -> x.i))),
      p -> aggregate(transform(p, (x, j) -> if(j < size(p) - 1, least(3, p[if(j < size(p) - 1, j + 1, 0)] - x), 3)), 0L, (a, x) -> a + x))[0])[0]))
)[0]
"""
LINES = r"transform(array(filter(split(coalesce(text, ''), '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')), l -> cast(size(l) - size(array_distinct(l)) as bigint))[0]"
SYMBOLS = "cast(length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>', '')) as bigint)"


def features(docs: DataFrame) -> DataFrame:
    """doc_id, the base features, base_failed and the stratum of every whole text of docs (doc_id, text).

    Null is the text without words. Repeated 3-word windows are told by 64-bit hashes within a text.
    """
    rows = docs.select("doc_id", F.expr(FEATURES).alias("f"), F.expr(SYMBOLS).alias("n_symbols"), F.expr(LINES).alias("n_dup_lines"))
    rows = rows.select("doc_id", "f.n_words", "f.word_chars", "n_symbols", "n_dup_lines", "f.n_repeat_words")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stratum = sum((F.when(F.col("n_words") >= low, 1).otherwise(0) for low in STRATA[1:]), F.lit(0))
    return rows.withColumns({"base_failed": failed, "stratum": stratum})


def tail(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), summed from the exact terms in logarithms; for k <= n * p."""
    start = F.struct((n * F.log1p(F.lit(-p))).alias("l"), F.exp(n * F.log1p(F.lit(-p))).alias("s"))

    def add(acc: Column, i: Column) -> Column:
        step = acc["l"] + F.log((n - i + 1) / i * F.lit(p / (1 - p)))
        return F.struct(step.alias("l"), (acc["s"] + F.exp(step)).alias("s"))

    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
    return F.aggregate(terms, start, add)["s"]


def _rejects(level: int) -> Column:
    """Whether any rule's statistic reaches its cutoff of the level."""
    return F.expr(" OR ".join(f"{stat} >= {cuts[level]}" for stat, cuts in RULES.values()))


def cutoffs(rows: DataFrame, alpha: float, delta: float) -> DataFrame:
    """stratum, level and each rule's cutoff: the strictest proven to reject at most alpha of a stratum's good documents.

    rows are features of labelled documents with `good`. Each stratum tests one sequence of ever
    tighter joint cutoffs, all rules together, from lenient to strict, and stops at the first that
    is not proven. The exact binomial upper bound of a level's false rejection rate lies under alpha
    just when seeing so few rejections would have probability delta / strata at that rate. A fixed
    sequence needs no further correction for its length, so all choices hold at once with probability
    1 - delta. A level without any false rejection needs log(delta / strata) / log(1 - alpha) good
    labels in its stratum: 203 for alpha 0.02 and delta 0.05. Strata with no proven level have null
    cutoffs, and there the base alone decides.
    """
    seen = rows.filter("good and not base_failed").groupBy("stratum").agg(F.count("*").alias("n"), *[F.count_if(_rejects(i)).alias(f"k_{i}") for i in range(LEVELS)])
    n, proven, level = F.col("n"), F.lit(True), F.lit(0)
    for i in range(LEVELS):
        k = F.col(f"k_{i}")
        proven = proven & (F.when(k <= n * F.lit(alpha), tail(k, n, alpha)).otherwise(1.0) <= delta / len(STRATA))
        level = level + F.when(proven, 1).otherwise(0)
    seen = seen.select("stratum", level.alias("level"))
    at = lambda cuts: F.when(F.col("level") > 0, F.element_at(F.array(*[F.lit(float(c)) for c in cuts]), F.col("level")))
    return seen.select("stratum", "level", *[at(cuts).alias(f"cut_{rule}") for rule, (_, cuts) in RULES.items()])


def judge(docs: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """features() of docs with kept: not base_failed, and under every proven cutoff of its stratum.

    labels has doc_id and quality (1: good); null and other values, null ids and ids not in docs
    take no part, a repeated label counts once; a statistic that equals its cutoff is rejected. Without
    labels no level is proven, and the base decides. Repeated documents get equal verdicts; other columns are ignored.
    """
    rows = spill(features(docs))
    good = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("labelled")).distinct()
    known = rows.join(good, F.col("doc_id") == F.col("labelled"), "left_semi").withColumn("good", F.lit(True))
    cuts = spill(cutoffs(known, alpha, delta)).withColumnRenamed("stratum", "s")
    # At most a row for each of the strata.
    judged = rows.join(F.broadcast(cuts), F.col("stratum") == F.col("s"), "left")
    fine = ~F.col("base_failed")
    for rule, (stat, _) in RULES.items():
        fine = fine & F.coalesce(F.when(F.col("n_words") > 0, F.expr(stat)) < F.col(f"cut_{rule}"), F.lit(True))
    return judged.withColumn("kept", fine).drop("s", "level", *[f"cut_{r}" for r in RULES])


def op1(spark, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    rate, level = 0.02, 0.05 / len(STRATA)
    stats = {r: s.replace("100D", "100::DOUBLE").replace("1D", "1::DOUBLE") for r, (s, _) in RULES.items()}
    rows = ", ".join(f"({i}, {', '.join(f'{cuts[i]}::DOUBLE' for _, cuts in RULES.values())})" for i in range(LEVELS))
    names = ", ".join(f"cut_{r}" for r in RULES)
    reached = " OR ".join(f"{s} >= cut_{r}" for r, s in stats.items())
    return rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM w WHERE len(w) >= 3),
d AS (SELECT doc_id, i FROM s QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
r AS (SELECT doc_id, count(DISTINCT i + j)::BIGINT AS n FROM d, range(3) x(j) GROUP BY 1),
f AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  (len(list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))))::BIGINT AS n_dup_lines,
  coalesce(r.n, 0) AS n_repeat_words FROM w LEFT JOIN r ON r.doc_id = w.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, CASE WHEN n_words >= {STRATA[2]} THEN 2 WHEN n_words >= {STRATA[1]} THEN 1 ELSE 0 END AS stratum FROM f),
g AS (SELECT * FROM b WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
v(lev, {names}) AS (VALUES {rows}),
k AS (SELECT stratum, lev, count(*) AS n, count(*) FILTER (WHERE {reached}) AS k FROM g CROSS JOIN v GROUP BY 1, 2),
p AS (SELECT stratum, lev, k <= n * {rate} AND list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({rate}) + (n - i) * ln(1 - {rate})))) <= {level} AS ok FROM k),
c AS (SELECT stratum, max(lev) AS lev FROM p WHERE ok AND NOT EXISTS (SELECT 1 FROM p q WHERE q.stratum = p.stratum AND q.lev < p.lev AND NOT q.ok) GROUP BY 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce({reached}, false) AS kept FROM b LEFT JOIN c USING (stratum) LEFT JOIN v USING (lev)
"""


OP1_SQL = _sql()
