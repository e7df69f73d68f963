"""Filter interaction audit: what each filter takes out in every order of the filters.

Filters on single texts give a bit each. That a text is identical to one of a smaller id is an existential self-join: a
left-semi join on the text's hash, the exact text and the smaller id. The rows it marks are united with those of the
other failures, and one aggregate makes a combination of bits of each document. All orders are then worked out from the
counts of combinations, of which a part has 2 ** filters at most, so that no order reads a document again.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm.lineage import cut, tidy

LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT = 200, 50, 2
SYMBOLS = r"[#$%&*|]"
#: Documents of a part with a combination of failures, those labelled good and those labelled toxic.
COUNTED = ("n", "good", "toxic")


def few_words(words: Column, text: Column) -> Column:
    return F.size(words) < LEAST_WORDS


def repeats_words(words: Column, text: Column) -> Column:
    return F.size(F.array_distinct(words)) * 100 < F.size(words) * LEAST_DISTINCT_PERCENT


def many_capitals(words: Column, text: Column) -> Column:
    capitals = F.length(text) - F.length(F.translate(text, string.ascii_uppercase, ""))
    return capitals * 100 > F.length(text) * MOST_CAPITALS_PERCENT


def has_symbols(words: Column, text: Column) -> Column:
    return text.rlike(SYMBOLS)


#: Failure conditions on a text and its words, by the letter of the filter.
TEXT_FILTERS: Mapping[str, Callable[[Column, Column], Column]] = {"A": few_words, "B": repeats_words, "C": many_capitals, "D": has_symbols}
COPY = "E"


def copies(rows: DataFrame) -> DataFrame:
    """Of rows (id, hash, part, text) those whose text a smaller id has too, without the text.

    Only texts whose hash has several ids are compared. Of each text the other side of the semi join holds its smallest id
    alone, combined before the shuffle: if any smaller id exists, that one is smaller. Both sides of the join are plain
    scans, so that adaptive execution can split the rows of a text that a third of them have.
    """
    often = cut(rows.groupBy("hash").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most").select("hash"))
    held = cut(rows.join(often, "hash", "left_semi"))
    earlier = cut(held.groupBy(F.col("hash").alias("_hash"), F.col("text").alias("_text")).agg(F.min("id").alias("_id")))
    same = (F.col("hash") == F.col("_hash")) & (F.col("text") == F.col("_text")) & (F.col("_id") < F.col("id"))
    return held.join(earlier, same, "left_semi").drop("text")


def combinations(docs: DataFrame, filters: Mapping[str, Callable[[Column, Column], Column]] = TEXT_FILTERS, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """id, hash, part, failures, n: the rows of each id and text in a part, and the bits of the filters that they fail.

    Bit k is the k-th filter's, the last bit that of copies.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text")).withColumn("hash", F.xxhash64("text"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    bits = [F.when(fails(F.col("words"), F.col("text")), 1 << k).otherwise(0) for k, fails in enumerate(filters.values())]
    failed = rows.select("id", "hash", "part", "text", words.alias("words")).select("id", "hash", "part", sum(bits[1:], bits[0]).alias("failures"), F.lit(1).alias("n"))
    copied = copies(rows.select("id", "hash", "part", "text")).select("id", "hash", "part", F.lit(1 << len(filters)).alias("failures"), F.lit(0).alias("n"))
    return failed.union(copied).groupBy("id", "hash", "part").agg(F.bit_or("failures").alias("failures"), F.sum("n").alias("n"))


@tidy
def filter_audit(
    docs: DataFrame, labels: DataFrame, filters: Mapping[str, Callable[[Column, Column], Column]] = TEXT_FILTERS, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A row for each part (value of `part_col`, null as an empty string), order of the filters' letters and step in it; zeros
    are included. Counts are rows of `docs`, so that a row repeated counts as often. A null text is an empty one. A row
    without an id is no copy of another and none of it, and has no label. Of several labels of an id, one that is 1 counts.
    An empty table has no parts, hence no rows. Other columns are not read.
    """
    letters = [*filters, COPY]
    found = cut(combinations(docs, filters, id_col, text_col, part_col))
    known = labels.groupBy(F.col("doc_id").alias("_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("is_good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("is_toxic")
    )
    named = found.filter("id is not null").join(known, F.col("id") == F.col("_id"), "left").select("part", "failures", "n", "is_good", "is_toxic")
    unnamed = found.filter("id is null").select("part", "failures", "n", F.lit(False), F.lit(False))
    counted = named.union(unnamed).groupBy("part", "failures").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("is_good"), F.col("n"))), F.lit(0)).alias("good"), F.coalesce(F.sum(F.when(F.col("is_toxic"), F.col("n"))), F.lit(0)).alias("toxic")
    )
    # at most 2 ** len(letters) combinations of a part
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("failures", *COUNTED)).alias("combinations"))
    return parts.select("part", "combinations", F.explode(_steps(letters)).alias("s")).select("part", F.col("s.filter_order"), F.col("s.step"), *_figures(len(letters)))


def _steps(letters: list[str]) -> Column:
    """All steps of all orders: the bits of the filters before, and that of the step's own."""
    every = F.sequence(F.lit(1), F.lit(len(letters)))
    orders = F.array(*(F.lit("".join(order)) for order in permutations(letters)))

    def bits(order: Column, upto: Column) -> Column:
        own = [F.when(F.position(F.lit(letter), order) <= upto, 1 << k).otherwise(0) for k, letter in enumerate(letters)]
        return sum(own[1:], own[0])

    step = lambda o, i: F.struct(o.alias("filter_order"), i.alias("step"), bits(o, i - 1).alias("before"), (bits(o, i) - bits(o, i - 1)).alias("own"))
    return F.flatten(F.transform(orders, lambda o: F.transform(every, lambda i: step(o, i))))


def _figures(n_filters: int) -> list[Column]:
    """The counts of a step, from the combinations of its part."""
    before, own = F.col("s.before"), F.col("s.own")
    total = lambda what, where: F.aggregate("combinations", F.lit(0).cast("long"), lambda a, c: a + F.when(where(c["failures"]), what(c)).otherwise(0))
    count = lambda name, where: total(lambda c: c[name], where)
    here = lambda f: (f.bitwiseAND(before) == 0) & (f.bitwiseAND(own) != 0)
    # a document that fails k filters is removed by each of them in one of k orders
    in_orders = lambda c: c["n"] * (F.lit(factorial(n_filters)) / F.greatest(F.bit_count(c["failures"]), F.lit(1))).cast("long")
    return [
        count("n", lambda f: f.bitwiseAND(before.bitwiseOR(own)) == 0).alias("kept"),
        count("n", here).alias("removed"),
        count("n", lambda f: (f.bitwiseAND(before) != 0) & (f.bitwiseAND(own) != 0)).alias("redundant"),
        count("n", lambda f: f == own).alias("unique_fails"),
        count("good", here).alias("good_lost"),
        count("toxic", here).alias("toxic_lost"),
        total(in_orders, lambda f: f.bitwiseAND(own) != 0).alias("shapley"),
    ]


_FILTERS = ", ".join(f"('{letter}', {1 << k})" for k, letter in enumerate([*TEXT_FILTERS, COPY]))
#: The same in SQL.
SQL = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
bits AS (SELECT doc_id, part,
  CASE WHEN len(ws) < {LEAST_WORDS} THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(ws)) < {LEAST_DISTINCT_PERCENT} * len(ws) THEN 2 ELSE 0 END
  + CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > {MOST_CAPITALS_PERCENT} * len(text) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(text, '{SYMBOLS}') THEN 8 ELSE 0 END
  + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS f FROM d),
label AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
combo AS (SELECT part, f, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM bits LEFT JOIN label USING (doc_id) GROUP BY part, f),
letter(l, b) AS (VALUES {_FILTERS}),
orders AS (SELECT v.l || w.l || x.l || y.l || z.l AS filter_order, [v.b, w.b, x.b, y.b, z.b] AS bs FROM letter v, letter w, letter x, letter y, letter z
  WHERE len(list_distinct([v.b, w.b, x.b, y.b, z.b])) = 5),
steps AS (SELECT filter_order, step, bs[step] AS own, CAST(coalesce(list_sum(bs[1:step - 1]), 0) AS INT) AS before FROM orders, (SELECT unnest(range(1, 6)) AS step)),
kinds AS (SELECT DISTINCT before, own FROM steps),
alone AS (SELECT part, own, sum(CASE WHEN f & own <> 0 THEN n * 120 // bit_count(f) ELSE 0 END) AS shapley FROM combo, (SELECT DISTINCT own FROM kinds) GROUP BY part, own),
figure AS (SELECT part, before, own,
  sum(CASE WHEN f & (before | own) = 0 THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN f & before = 0 AND f & own <> 0 THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN f & before <> 0 AND f & own <> 0 THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN f = own THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN f & before = 0 AND f & own <> 0 THEN good ELSE 0 END) AS good_lost,
  sum(CASE WHEN f & before = 0 AND f & own <> 0 THEN toxic ELSE 0 END) AS toxic_lost FROM combo, kinds GROUP BY part, before, own)
SELECT part, filter_order, CAST(step AS INT) AS step, {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))}
FROM figure JOIN steps USING (before, own) JOIN alone USING (part, own)
"""
