"""Substring dedup by sliding spans of sentences.

A sentence ends at . ! ? ; or a line's end; one of more than LONG words is also cut after commas and colons. From each
sentence on, the span of several sentences that has LEAST_WORDS words first is hashed. Spans that occur again anywhere
but in the first place lose the sentences that they cover.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm.lineage import cut
from tiermill.llm.rows import map_texts
from tiermill.llm.words import LOWER, MIX_A, P, Words, mix

#: Sentences of more words are cut at commas and colons too.
LONG = 12
#: A span has so many words and sentences at least.
LEAST_WORDS, LEAST_SENTENCES = 16, 2
ENDS, SOFT_ENDS = b".!?;", b",:"


def _marked(chars: bytes) -> np.ndarray:
    marks = np.zeros(256, bool)
    marks[list(chars)] = True
    return marks


def _prefix(hashes: np.ndarray, factor: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums over hashes[i] * factor**i up to each place, and factor**-i, so that any run's hash takes one step."""
    powers, inverse = np.full(len(hashes) + 1, factor, np.uint64), np.full(len(hashes) + 1, pow(factor, -1, 1 << 64), np.uint64)
    powers[0] = inverse[0] = 1
    powers, inverse = np.cumprod(powers), np.cumprod(inverse)
    return np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers[:-1])]), inverse


def sentence_ends(words: Words) -> np.ndarray:
    """For each word, whether a sentence ends with it."""
    if not len(words.hashes):
        return np.zeros(0, bool)
    last = words.raw[words.ends - 1]
    lines = np.cumsum(words.raw == 10)
    following = np.append(words.starts[1:], len(words.raw) - 1)
    ends = _marked(ENDS)[last] | (lines[following] > lines[words.ends - 1])
    ends[np.append(words.doc[1:] != words.doc[:-1], True)] = True
    first = np.concatenate([[0], np.flatnonzero(ends)[:-1] + 1])
    lengths = np.diff(np.append(first, len(ends)))
    return ends | (np.repeat(lengths, lengths) > LONG) & _marked(SOFT_ENDS)[last]


def spans(texts: list[str]) -> dict[str, list]:
    """Hashes, starts and ends (code points) of the spans of each text."""
    words = Words([t.encode().translate(LOWER) for t in texts])
    ends = np.flatnonzero(sentence_ends(words)) + 1
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    last = np.maximum(np.searchsorted(ends, starts + LEAST_WORDS), np.arange(len(starts)) + LEAST_SENTENCES - 1)
    keep = last < len(ends)
    starts, ends = starts[keep], ends[last[keep]]
    keep = words.doc[starts] == words.doc[ends - 1] if len(starts) else keep[:0]
    starts, ends = starts[keep], ends[keep]
    size = (ends - starts).astype(np.uint64)
    made = []
    for factor in (P, MIX_A):
        sums, inverse = _prefix(words.hashes, factor)
        made.append(mix((sums[ends] - sums[starts]) * inverse[starts] + size))
    points = np.concatenate([[0], np.cumsum((words.raw & 0xC0) != 0x80)])
    doc = words.doc[starts]
    base = points[words.doc_starts[doc]]
    columns = {
        "h": made[0].view(np.int64),
        "g": (made[1] >> np.uint64(32)).astype(np.uint32).view(np.int32),
        "start": (points[words.starts[starts]] - base).astype(np.int32),
        "stop": (points[words.ends[ends - 1]] - base).astype(np.int32),
    }
    cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
    return {name: [values[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)] for name, values in columns.items()}


def _merged(spans: Column) -> Column:
    """Spans (start, stop) in order, overlapping or touching ones joined: a text's own spans at most."""
    nothing = F.array().cast("array<struct<start:int,stop:int>>")

    def add(so_far: Column, one: Column) -> Column:
        last = F.element_at(so_far, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["stop"], one["stop"]).alias("stop"))
        meets = (F.size(so_far) > 0) & (one["start"] <= last["stop"])
        return F.when(meets, F.concat(F.slice(so_far, 1, F.size(so_far) - 1), F.array(joined))).otherwise(F.concat(so_far, F.array(one)))

    return F.aggregate(F.sort_array(spans), nothing, add)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, version, first_doc_id, spans: what each document that repeats earlier spans of another, or its own, loses.

    Earlier is by id (a null id is the lowest), then by place in the text, so that of texts that share a passage the
    lowest id keeps it; first_doc_id is the one that keeps these spans, and a
    document has a row for each of them. Ids may be of any type that has an order. Places are in code points, ends exclusive.
    `version` is xxhash64 of the text: rows that repeat an id and a text are one document. A null or empty text, or one
    with too few words, has no spans. Other columns are not read.
    """
    keys = {"doc_id": F.col(id_col), "version": F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))}
    lists = cut(map_texts(docs, spans, "h array<long>, g array<int>, start array<int>, stop array<int>", keys, text_col))
    every = lists.select("doc_id", "version", F.explode(F.arrays_zip("h", "g", "start", "stop")).alias("s")).select("doc_id", "version", "s.*")
    # only counts are shuffled for all spans; a span in a third of all texts is one row per task
    again = cut(every.groupBy("h", "g").agg(F.count("*").alias("c")).filter("c > 1").select("h", "g"))
    met = cut(every.join(again, ["h", "g"]))
    first = cut(met.groupBy("h", "g").agg(F.min(F.struct("doc_id", "start", "version")).alias("first")))
    gone = met.join(first, ["h", "g"]).filter(~F.struct("doc_id", "start", "version").eqNullSafe(F.col("first")))
    by_doc = gone.groupBy("doc_id", "version", F.col("first.doc_id").alias("first_doc_id")).agg(F.collect_list(F.struct("start", "stop")).alias("found"))
    return by_doc.select("doc_id", "version", "first_doc_id", _merged(F.col("found")).alias("spans"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without repeated spans: _row, the row as it was, _text and _spans (null where nothing is lost).

    One row per row of `docs`; all columns pass through inside `_row`, so none can clash.
    """
    each = repeated_spans(docs, id_col, text_col).groupBy("doc_id", "version").agg(F.flatten(F.collect_list("spans")).alias("found"))
    gone = each.select("doc_id", "version", _merged(F.col("found")).alias("spans"))
    whole = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_version"), F.struct("*").alias("_row"))
    text = F.col("_row")[text_col]
    joined = whole.join(gone, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_version") == F.col("version")), "left")
    # what lies before each span, and what lies after the last
    parts = F.transform("spans", lambda s, i: F.substring(text, F.coalesce(F.get("spans", i - 1)["stop"], F.lit(0)) + 1, s["start"] - F.coalesce(F.get("spans", i - 1)["stop"], F.lit(0))))
    rest = F.substring(text, F.element_at("spans", -1)["stop"] + 1, F.length(text))
    return joined.select("_row", F.when(F.col("spans").isNull(), text).otherwise(F.concat(F.array_join(parts, ""), rest)).alias("_text"), F.col("spans").alias("_spans"))


_BLANK = r"[\x20\x09-\x0D]"
#: The repeated spans in SQL: for each document and the one that keeps them.
SQL = f"""
WITH d AS (SELECT doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+{_BLANK}*') AS pieces,
  len(text) - len(regexp_replace(text, '^{_BLANK}+', '')) AS lead FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, lead, unnest(pieces) AS piece, unnest(range(1, len(pieces) + 1)) AS i, len(pieces) AS n FROM d),
w AS (SELECT doc_id, i, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low, place AS start, place + len(word) AS stop,
  right(word, 1) IN ('.', '!', '?', ';') OR contains(piece, chr(10)) OR i = n AS ends, right(word, 1) IN (',', ':') AS soft
  FROM (SELECT *, regexp_replace(piece, '{_BLANK}+$', '') AS word,
    lead + coalesce(sum(len(piece)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM p)),
s AS (SELECT *, coalesce(sum(CAST(ends AS INT)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM w),
e AS (SELECT *, ends OR (soft AND count(*) OVER (PARTITION BY doc_id, s) > {LONG}) AS cut FROM s),
u AS (SELECT *, coalesce(sum(CAST(cut AS INT)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS u FROM e),
unit AS (SELECT doc_id, u, min(i) AS a, max(i) AS b, min(start) AS start, max(stop) AS stop FROM u GROUP BY doc_id, u),
reach AS (SELECT x.doc_id, x.a, x.start, min(y.u) AS u FROM unit x JOIN unit y ON x.doc_id = y.doc_id
  AND y.u BETWEEN x.u + {LEAST_SENTENCES - 1} AND x.u + {LEAST_WORDS} AND y.b - x.a + 1 >= {LEAST_WORDS} GROUP BY ALL),
words AS (SELECT doc_id, list(low ORDER BY i) AS ws FROM u GROUP BY doc_id),
span AS (SELECT doc_id, reach.start, unit.stop, array_to_string(ws[reach.a:unit.b], ' ') AS body
  FROM reach JOIN unit USING (doc_id, u) JOIN words USING (doc_id)),
gone AS (SELECT doc_id, start, stop, first FROM (SELECT *, row_number() OVER o AS nth, first_value(doc_id) OVER o AS first FROM span
  WINDOW o AS (PARTITION BY body ORDER BY doc_id, start)) WHERE nth > 1),
new AS (SELECT *, start > coalesce(max(stop) OVER (PARTITION BY doc_id, first ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS is_new FROM gone),
island AS (SELECT *, sum(CAST(is_new AS INT)) OVER (PARTITION BY doc_id, first ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS k FROM new),
merged AS (SELECT doc_id, first, min(start) AS start, max(stop) AS stop FROM island GROUP BY doc_id, first, k)
SELECT doc_id, first AS first_doc_id, CAST(count(*) AS INT) AS n_spans, CAST(sum(stop - start) AS INT) AS n_chars,
  string_agg(CAST(start AS INT) || ':' || CAST(stop AS INT), ',' ORDER BY start) AS spans
FROM merged GROUP BY doc_id, first
"""
