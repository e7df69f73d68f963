"""Quality rules: figures of each text, and lines that too many documents of a host share.

Normalised lines are hashed; for each host (the column `source`) the distinct documents that hold a line are counted,
copies of one text as one. Lines above the limit are removed, and a document that is left with too little is rejected.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm.lineage import cut
from tiermill.llm.rows import map_texts
from tiermill.llm.words import Words

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
#: Fewer words, or more percent of words in repeated windows, fail.
LEAST_WORDS, MOST_REPEATED = 20, 30
#: A line of so many words at least is common if so many distinct documents of its host hold it: a number that doesn't
#: grow with the host, so that a line is as common in a large host as in a small one.
COMMON_WORDS, COMMON_DOCS = 3, 10
#: A document is depleted if common lines leave it less than this percent of its words, or fewer than LEAST_WORDS.
LEFT_PERCENT = 30
#: Normal form of a line: lower case, digits alike, single spaces.
NORMAL = bytes.maketrans(bytes(range(65, 91)) + b"123456789", bytes(range(97, 123)) + b"000000000")


def normal(line: bytes) -> bytes:
    return b" ".join(line.translate(NORMAL).split())


def hash_of(line: bytes) -> int:
    return xxhash.xxh64_intdigest(line) - (1 << 63)


def figures(coded: list[bytes]) -> dict[str, list]:
    words = Words(coded)
    n = len(coded)
    per_doc = lambda marks: np.add.reduceat(np.append(marks, 0), words.doc_starts[:-1]) if n else np.zeros(0, np.int64)
    spaces, symbols = np.zeros(256, np.int64), np.zeros(256, np.int64)
    spaces[list(b" \t\n\x0b\x0c\r")] = 1
    symbols[list(SYMBOLS)] = 1
    points = ((words.raw & 0xC0) != 0x80) & (spaces[words.raw] == 0)
    hashes, at = words.windows(WINDOW)
    repeated = np.zeros(len(words.hashes) + 1, np.int64)
    if len(at):
        own = hashes ^ words.doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        order = np.argsort(own, kind="stable")
        same = (own[order][1:] == own[order][:-1]) & (words.doc[at[order][1:]] == words.doc[at[order][:-1]])
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        np.add.at(repeated, at[twice], 1)
        np.add.at(repeated, at[twice] + WINDOW, -1)
    covered = np.cumsum(repeated)[:-1] > 0
    return {
        "n_words": words.counts.tolist(),
        "word_chars": per_doc(points.astype(np.int64)).tolist(),
        "n_symbols": per_doc(symbols[words.raw]).tolist(),
        "n_repeat_words": np.bincount(words.doc[covered], minlength=n).tolist() if n else [],
    }


def work(texts: list[str]) -> dict:
    coded = [t.encode() for t in texts]
    out = figures(coded)
    out["n_dup_lines"], out["lines"] = [], []
    for text in coded:
        seen, again, lines = set(), 0, []
        for line in text.split(b"\n"):
            if words := line.split():
                again += line in seen
                seen.add(line)
                lines.append({"h": hash_of(normal(line)), "n": len(words)})
        out["n_dup_lines"].append(again)
        out["lines"].append(lines)
    return out


SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lines array<struct<h:long,n:int>>"


def host_of(host: Column) -> Column:
    """The host as a key without nulls."""
    return F.coalesce(F.concat(F.lit("="), host.cast("string")), F.lit(""))


def version_of(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """doc_id, the figures, base_failed, n_common_lines, n_common_words, kept, and `common`, the hashes of its common lines.

    One row per row of `docs`, in which rows of the same id stay apart. A null or empty text has no words and
    fails. A null host is a host of its own. Ties can't arise: a count is above the limit or not. Other columns
    are not read.
    """
    keys = {"doc_id": F.col(id_col), "host": host_of(F.col(host_col)), "version": version_of(F.col(text_col))}
    rows = cut(map_texts(docs, work, SCHEMA, keys, text_col).withColumn("row", F.monotonically_increasing_id()))
    long_lines = F.filter("lines", lambda x: x["n"] >= COMMON_WORDS)
    held = rows.select("host", "version", F.explode(F.array_distinct(F.transform(long_lines, lambda x: x["h"]))).alias("h"))
    # counts of distinct documents in two steps, both combined before their shuffle
    common = cut(held.distinct().groupBy("host", "h").agg(F.count("*").alias("c")).filter(F.col("c") >= COMMON_DOCS).select("host", "h"))
    lines = rows.select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.h", "x.n")
    lost = lines.join(common, ["host", "h"]).groupBy("row").agg(F.count("*").alias("n_common_lines"), F.sum("n").alias("n_common_words"), F.collect_set("h").alias("common"))
    all_rows = rows.drop("lines").join(lost, "row", "left").drop("row").fillna(0, ["n_common_lines", "n_common_words"])
    left = F.col("n_words") - F.col("n_common_words")
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    depleted = (F.col("n_common_lines") > 0) & ((left < LEAST_WORDS) | (left * 100 < F.col("n_words") * LEFT_PERCENT))
    return all_rows.select(
        "doc_id", "host", "version", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), "n_common_lines", "n_common_words", (~failed & ~depleted).alias("kept"), "common",
    )


def without_lines(texts: list[str], common: list) -> list[str]:
    """Texts without the lines whose hashes are given."""
    out = []
    for text, hashes in zip(texts, common, strict=True):
        if hashes:
            gone = set(hashes)
            text = b"\n".join(x for x in text.encode().split(b"\n") if not x.split() or hash_of(normal(x)) not in gone).decode()
        out.append(text)
    return out


_LINE = "trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'), '[\\x20\\x09-\\x0D]+', ' ', 'g'))"
#: The same in SQL.
SQL = f"""
WITH d AS (SELECT doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws, text, host FROM d),
word AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
win AS (SELECT doc_id, i, ws[i:i + {WINDOW - 1}] AS run FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w WHERE len(ws) >= {WINDOW})),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, run) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM again) GROUP BY doc_id),
line AS (SELECT doc_id, host, text, line, i FROM (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS line,
  unnest(range(len(string_split(text, chr(10))))) AS i FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
dup AS (SELECT doc_id, sum(c - 1) AS n FROM (SELECT doc_id, line, count(*) AS c FROM line GROUP BY ALL) GROUP BY doc_id),
norm AS (SELECT doc_id, host, text, {_LINE} AS x, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n FROM line),
common AS (SELECT host, x FROM norm WHERE n >= {COMMON_WORDS} GROUP BY host, x HAVING count(DISTINCT text) >= {COMMON_DOCS}),
lost AS (SELECT doc_id, count(*) AS lines, sum(n) AS n FROM norm JOIN common USING (host, x) GROUP BY doc_id),
figure AS (SELECT w.doc_id, len(ws) AS n_words, CAST(coalesce(list_sum([len(x) FOR x IN ws]), 0) AS BIGINT) AS word_chars,
  len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
  coalesce(lost.lines, 0) AS n_common_lines, coalesce(lost.n, 0) AS n_common_words
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id)),
judged AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM figure)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, CAST(n_common_lines AS BIGINT) AS n_common_lines, CAST(n_common_words AS BIGINT) AS n_common_words,
  NOT base_failed AND NOT (n_common_lines > 0 AND (n_words - n_common_words < {LEAST_WORDS}
  OR (n_words - n_common_words) * 100 < n_words * {LEFT_PERCENT})) AS kept
FROM judged
"""
