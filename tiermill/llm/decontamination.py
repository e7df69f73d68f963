"""Benchmark decontamination by spaced seeds.

A seed is the hash of a window's tokens at the places that a fixed mask marks with 1; substitutions at the other places
don't change it. Seeds of the texts meet those of the benchmark in a join; each meeting fixes how the two lie against
each other, and the tokens there are compared one by one. Only DataFrame functions are used.

A text is cut into tokens once. Its windows are rows of the hashes of neighbouring tokens, so that the seeds of all masks
are plain columns of one generated loop, and only windows whose seed the benchmark has go on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm.lineage import cut, tidy

#: Fixed masks over neighbouring tokens: each passage of WHOLE tokens at least meets a seed for every pattern of substitutions that SHARE allows.
MASKS = ("11010111", "1110010111", "110100011", "111011")
#: Passages of fewer tokens are looked for as they are, by a mask without gaps; those of fewer than SHORTEST say nothing.
WHOLE, SHORTEST = 8, 4
#: An overlap counts if this many tokens in a row (all of a shorter passage) have SHARE percent of equal ones at least.
WINDOW, SHARE = 15, 80
#: Seeds of the benchmark up to this number (of 24 bytes each) are sent to all executors; more are joined by a shuffle.
BROADCAST_SEEDS = 1_000_000
#: And the passages themselves, if their characters are no more than this.
BROADCAST_CHARACTERS = 8_000_000


def tokens(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def _seeds(rows: DataFrame, masks: list[str], *passing: str) -> DataFrame:
    """`passing`, pos (from 0), number (of the mask), seed: the windows of rows with `words`.

    A window is a row with the hashes of a token and those after it; the last ones of a text have nulls, and no seed of a
    mask that reaches beyond its end.
    """
    width = max(map(len, masks))
    hashed = rows.select(*passing, F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    beside = F.arrays_zip(*(F.slice("h", i + 1, F.greatest(F.size("h") - i, F.lit(0))).alias(f"h{i}") for i in range(width)))
    windows = hashed.select(*passing, F.posexplode(beside).alias("pos", "w")).select(*passing, "pos", "w.*")
    seeds = [F.struct(F.lit(k).alias("number"), F.when(F.col(f"h{len(m) - 1}").isNotNull(), F.xxhash64(F.lit(m), *(F.col(f"h{i}") for i, c in enumerate(m) if c == "1"))).alias("seed")) for k, m in enumerate(masks)]
    return windows.select(*passing, "pos", F.inline(F.array(*seeds))).filter("seed is not null")


def _found(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """What `leaks` gives, and the version of the text: its xxhash64."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("version")).filter("text is not null")
    passages = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("passage")).filter("passage is not null").distinct()
    items = cut(passages.select("item_id", tokens(F.col("passage")).alias("words")).withColumn("n", F.size("words")).filter(F.col("n") >= SHORTEST))
    # the few lengths that short passages have: a mask without gaps for each
    short = sorted(r["n"] for r in items.filter(F.col("n") < WHOLE).select("n").distinct().collect())
    masks = [*MASKS, *("1" * n for n in short)]
    whole = F.when(F.col("n") < WHOLE, F.col("number") == len(MASKS) + sum((F.when(F.col("n") > n, 1).otherwise(0) for n in short), F.lit(0))).otherwise(F.col("number") < len(MASKS))
    seeds = cut(_seeds(items, masks, "item_id", "n").filter(whole).select("item_id", "n", F.col("pos").alias("item_pos"), "seed").distinct())
    if seeds.limit(BROADCAST_SEEDS + 1).count() <= BROADCAST_SEEDS:
        seeds = F.broadcast(seeds)
    windows = _seeds(docs.select("doc_id", "version", tokens(F.col("text")).alias("words")), masks, "doc_id", "version").drop("number")
    hits = windows.join(seeds, "seed").select("doc_id", "version", "item_id", "n", (F.col("pos") - F.col("item_pos")).alias("shift")).distinct()
    placed = hits.groupBy(F.col("doc_id").alias("_doc"), F.col("version").alias("_version")).agg(F.collect_set(F.struct("item_id", "n", "shift")).alias("places"))
    # only the tokens that lie beside a passage go on
    beside = F.transform("places", lambda p: F.struct(p["item_id"].alias("_item"), p["n"].alias("_n"), F.least(p["shift"], F.lit(0)).alias("shift"), F.slice("words", F.greatest(p["shift"], F.lit(0)) + 1, p["n"]).alias("words")))
    met = (
        docs.join(placed, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("version") == F.col("_version")))
        .select("doc_id", "version", tokens(F.col("text")).alias("words"), "places")
        .select("doc_id", "version", F.explode(beside).alias("p"))
    )
    own = items.select(F.col("item_id").alias("_item"), F.col("n").alias("_n"), F.col("words").alias("item"))
    characters = items.select(F.sum(F.aggregate("words", F.lit(0), lambda a, w: a + F.length(w) + 16))).first()[0] or 0
    paired = met.join(F.broadcast(own) if characters <= BROADCAST_CHARACTERS else own, F.col("p._item").eqNullSafe(F.col("_item")) & (F.col("p._n") == F.col("_n")))
    flags = F.transform("item", lambda t, j: F.when((j + F.col("p.shift") >= 0) & (F.get("p.words", j + F.col("p.shift")) == t), 1).otherwise(0))
    width = F.least(F.size("item"), F.lit(WINDOW))
    share = F.when(F.size("item") < WHOLE, 100).otherwise(SHARE)
    passes = lambda f: F.exists(
        F.sequence(F.lit(1), F.size(f) - width + 1), lambda s: F.aggregate(F.slice(f, s, width), F.lit(0), lambda a, x: a + x) * 100 >= width * share
    )
    found = paired.select("doc_id", "version", "_item", "item", flags.alias("flags"), width.alias("width"), share.alias("share")).filter(passes(F.col("flags")))
    return found.groupBy("doc_id", "version", F.col("_item").alias("item_id")).agg(
        F.max(F.size("item")).alias("item_tokens"), F.max(F.aggregate("flags", F.lit(0), lambda a, x: a + x)).alias("matched_tokens")
    )


@tidy
def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, item_tokens, matched_tokens: passages of the benchmark that a document holds.

    matched_tokens is the number of equal tokens in the best position that passes. A passage of SHORTEST to WHOLE - 1 tokens
    counts where all its tokens stand in a row; null and empty texts and shorter passages give nothing. A passage or document that occurs in several rows counts
    once per id and text; null ids are ids like others. Other columns are not read.
    """
    found = _found(docs, benchmark, id_col, text_col, item_col, item_text)
    return found.groupBy("doc_id", "item_id").agg(F.max("item_tokens").alias("item_tokens"), F.max("matched_tokens").alias("matched_tokens"))


@tidy
def _leaking(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return _found(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias("_leaking"), F.col("version").alias("_leaking_version")).distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the rows whose text holds a passage of the benchmark, by id and text; all columns stay."""
    bad = _leaking(docs, benchmark, id_col, text_col)
    return docs.join(bad, docs[id_col].eqNullSafe(F.col("_leaking")) & (F.xxhash64(docs[text_col]) == F.col("_leaking_version")), "left_anti")


def _sql_seeds(table: str, key: str, mask: str, where: str) -> str:
    places = [i for i, c in enumerate(mask) if c == "1"]
    seed = ", ".join(f"w[i + {p}]" for p in places)
    return (
        f"SELECT {key}, i, '{mask}' AS mask, concat_ws(' ', {seed}) AS seed "
        f"FROM (SELECT {key}, w, unnest(range(1, len(w) - {len(mask)} + 2)) AS i FROM {table} WHERE len(w) >= {len(mask)} AND {where})"
    )


_WORDS = r"[x FOR x IN string_split_regex(lower({0}), '[^\p{{L}}\p{{N}}]+') IF x <> '']"
_SHORT = ["1" * n for n in range(SHORTEST, WHOLE)]
#: The same in SQL.
SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents WHERE text IS NOT NULL),
b AS (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
ds AS ({" UNION ALL ".join(_sql_seeds("d", "doc_id", m, "true" if m in MASKS else f"{len(m)} IN (SELECT len(w) FROM b)") for m in (*MASKS, *_SHORT))}),
bs AS ({" UNION ALL ".join(_sql_seeds("b", "item_id", m, f"len(w) >= {WHOLE}" if m in MASKS else f"len(w) = {len(m)}") for m in (*MASKS, *_SHORT))}),
hit AS (SELECT DISTINCT doc_id, item_id, ds.i - bs.i AS shift FROM ds JOIN bs USING (mask, seed)),
pair AS (SELECT hit.*, d.w AS words, b.w AS item FROM hit JOIN d USING (doc_id) JOIN b USING (item_id)),
flag AS (SELECT doc_id, item_id, shift, len(item) AS m, j,
  CASE WHEN j + shift >= 1 AND j + shift <= len(words) AND words[j + shift] = item[j] THEN 1 ELSE 0 END AS f
  FROM (SELECT *, unnest(range(1, len(item) + 1)) AS j FROM pair)),
win AS (SELECT *, sum(f) OVER (PARTITION BY doc_id, item_id, shift ORDER BY j ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) AS s,
  sum(f) OVER (PARTITION BY doc_id, item_id, shift) AS matched FROM flag),
ok AS (SELECT DISTINCT doc_id, item_id, m, matched FROM win
  WHERE j >= least(m, {WINDOW}) AND s * 100 >= least(m, {WINDOW}) * CASE WHEN m < {WHOLE} THEN 100 ELSE {SHARE} END)
SELECT doc_id, item_id, CAST(max(m) AS INT) AS item_tokens, CAST(max(matched) AS INT) AS matched_tokens FROM ok GROUP BY doc_id, item_id
"""
