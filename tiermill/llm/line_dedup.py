"""Line dedup by content-defined chunks of lines.

The hash of each line, rolled over a window of that line alone, tells which boundaries it sets: in each of FAMILIES
families it belongs to one of two sets, and a chunk goes from a line to the next one of its set, both included, blank lines
aside. So boundaries move with the text and not with its place, and they are fine: three lines always hold a whole chunk of
each family, two lines hold one with a probability of 1 - 2 ** -FAMILIES. A wider window, or more sets, would lose such
short passages. Chunks whose hash occurs again are matched with the first place that has it; matches side by side become
one stretch of lines, its bytes are compared with those of the first place, and lines of equal ones go. Only DataFrame
functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm.lineage import cut, tidy

#: Families of boundary sets: of a line's MD5 the hexadecimal digit in this place (from 1) tells its set in each, by its code's parity.
FAMILIES = (1, 2, 5, 6)


def _once(value: Column, use) -> Column:
    """`use(value)` with `value` evaluated once, though lambdas in it name it again and again."""
    return F.transform(F.array(value), use)[0]


def _chunks(lines: Column) -> Column:
    """(start, n, hash) of the chunks of all families, start from 1."""

    def chain(full: Column, digit: int, odd: int) -> Column:
        """From each line of a set to the next one."""
        own = F.filter(full, lambda r: F.ascii(F.substring(r["digits"], digit, 1)) % 2 == odd)
        pair = lambda c, r, k: F.struct(r["at"].alias("start"), (F.get(c, k + 1)["at"] - r["at"] + 1).alias("n"))
        return _once(own, lambda c: F.transform(F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0))), lambda r, k: pair(c, r, k)))

    def of(rows: Column) -> Column:
        pairs = _once(F.filter(rows, lambda r: r["full"]), lambda full: F.array_distinct(F.concat(*(chain(full, d, odd) for d in FAMILIES for odd in (0, 1)))))
        hashed = lambda h: F.transform(pairs, lambda p: F.struct(p["start"].alias("start"), p["n"].alias("n"), F.xxhash64(F.slice(h, p["start"], p["n"])).alias("hash")))
        return _once(F.transform(rows, lambda r: r["hash"]), hashed)

    known = lambda x, i: F.struct((i + 1).alias("at"), F.xxhash64(x).alias("hash"), F.substring(F.md5(x), 1, max(FAMILIES)).alias("digits"), (F.trim(x) != "").alias("full"))
    return _once(F.transform(lines, known), of)


def _merged(places: Column) -> Column:
    """Places (start, n) in order as stretches (start, n): those that overlap or touch are one."""
    nothing = F.array().cast("array<struct<start:int,n:int>>")

    def add(so_far: Column, p: Column) -> Column:
        last = F.element_at(so_far, -1)
        end = lambda q: q["start"] + q["n"]
        joined = F.struct(last["start"].alias("start"), (F.greatest(end(last), end(p)) - last["start"]).alias("n"))
        meets = (F.size(so_far) > 0) & (p["start"] <= end(last))
        return F.when(meets, F.concat(F.slice(so_far, 1, F.size(so_far) - 1), F.array(joined))).otherwise(F.concat(so_far, F.array(F.struct(p["start"].alias("start"), p["n"].alias("n")))))

    return F.aggregate(places, nothing, add)


def _as_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    plain = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(plain).alias("version"), plain.alias("text"))


@tidy
def repeated_stretches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, version, places: of each text the stretches (start, n, body) of lines whose chunks an earlier place has too.

    Earlier is by id, then by place; body is what stands at the earlier place, for the comparison. Rows of the same id and
    text (version: its xxhash64) are one document.
    """
    rows = _as_rows(docs, id_col, text_col)
    chunks = cut(rows.select("id", "version", F.explode(_chunks(F.split("text", "\n", -1))).alias("c")).select("id", "version", "c.*"))
    # counts with map-side combination: a chunk in a third of all documents is one row per task
    often = chunks.groupBy("hash").agg(F.count("*").alias("c")).filter("c > 1").select("hash")
    # all sides of joins are plain scans, so that adaptive execution can split a hot hash
    met = cut(chunks.join(cut(often), "hash"))
    first = cut(met.groupBy("hash").agg(F.min(F.struct("id", "start", "version")).alias("first")))
    beside = met.join(first, "hash").filter(F.struct("id", "start", "version") != F.col("first"))
    beside = beside.select("id", "version", F.col("first.id").alias("first_id"), F.col("first.version").alias("first_version"), (F.col("first.start") - F.col("start")).alias("shift"), "start", "n")
    # chunks that lie against the same place of the same document: a text's own lines at most
    along = ["id", "version", "first_id", "first_version", "shift"]
    stretches = beside.groupBy(*along).agg(F.sort_array(F.collect_set(F.struct("start", "n"))).alias("places")).select(*along, F.explode(_merged(F.col("places"))).alias("p"))
    stretches = cut(stretches.select("id", "version", "first_id", "first_version", "p.start", "p.n", (F.col("p.start") + F.col("shift")).alias("at")))
    asked = stretches.groupBy("first_id", "first_version").agg(F.collect_set(F.struct("at", "n")).alias("asked"))
    body = lambda lines, q: F.array_join(F.slice(lines, q["at"], q["n"]), "\n")
    bodies = _once(F.split("text", "\n", -1), lambda lines: F.transform("asked", lambda q: F.struct(q["at"].alias("at"), q["n"].alias("n"), body(lines, q).alias("body"))))
    # texts are dealt out at every size, so that a run over little shows what one over much takes
    there = rows.join(asked.hint("merge"), F.col("id").eqNullSafe(F.col("first_id")) & (F.col("version") == F.col("first_version"))).select("first_id", "first_version", F.explode(bodies).alias("b"))
    keys = ["first_id", "first_version", "at", "n"]
    there = cut(there.select("first_id", "first_version", "b.*").dropDuplicates(keys).select(*(F.col(c).alias(f"_{c}") for c in keys), "body"))
    same = F.col("first_id").eqNullSafe(F.col("_first_id"))
    for c in keys[1:]:
        same = same & (F.col(c) == F.col(f"_{c}"))
    return stretches.join(there, same).groupBy("id", "version").agg(F.collect_set(F.struct("start", "n", "body")).alias("places"))


def _without(lines: Column, gone: Column) -> Column:
    """`lines` without the places (start, n) of `gone`, of which a later start has a later end."""

    def left(places: Column) -> Column:
        end = lambda k: F.coalesce(F.get(places, k)["start"] + F.get(places, k)["n"], F.lit(1))
        gaps = F.transform(places, lambda p, k: F.slice(lines, end(k - 1), F.greatest(p["start"] - end(k - 1), F.lit(0))))
        return F.flatten(F.concat(gaps, F.array(F.slice(lines, end(F.size(places) - 1), F.size(lines)))))

    return _once(F.array_sort(gone), left)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without repeated lines: columns _id, _text, _lines, _removed and `_row`, the row as it was.

    One row per row of `docs`. A line goes if it lies in a chunk that an earlier place holds too: one in a document of a
    lower id (a null id is the lowest), or before it in the same text; the places may overlap, so that of a line repeated on
    and on one is left. A null or empty text stays. Rows that repeat id and text are the same document: they lose the
    same lines. Other columns pass through inside `_row`, so none can clash.
    """
    found = repeated_stretches(docs, id_col, text_col)
    whole = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("version"), F.struct("*").alias("_row"))
    lines = F.split(F.col("_row")[text_col], "\n", -1)
    equal = lambda p: F.array_join(F.slice(lines, p["start"], p["n"]), "\n") == p["body"]
    confirmed = F.sort_array(F.transform(F.filter("places", equal), lambda p: F.struct(p["start"].alias("start"), p["n"].alias("n"))))
    joined = whole.join(found.hint("merge"), whole["id"].eqNullSafe(found["id"]) & (whole["version"] == found["version"]), "left").select(whole["id"].alias("_id"), "_row", confirmed.alias("_places"))
    joined = joined.select("_id", "_row", F.when(F.size("_places") > 0, _merged(F.col("_places"))).alias("gone"))
    done = F.when(F.col("gone").isNotNull(), _once(lines, lambda x: _once(_without(x, F.col("gone")), lambda y: F.struct(F.array_join(y, "\n").alias("text"), (F.size(x) - F.size(y)).alias("removed")))))
    return joined.select("_id", "_row", "gone", F.size(lines).alias("_n"), done.alias("_done")).select(
        "_id",
        F.when(F.col("gone").isNull(), F.col("_row")[text_col]).otherwise(F.col("_done.text")).alias("_text"),
        F.coalesce("_n", F.lit(0)).alias("_lines"),
        F.coalesce("_done.removed", F.lit(0)).alias("_removed"),
        "_row",
    )


def _sql_chunks(digit: int) -> str:
    return f"SELECT doc_id, i AS start, lead(i) OVER (PARTITION BY doc_id, ascii(substr(digits, {digit}, 1)) % 2 ORDER BY i) AS stop FROM line WHERE trim(line) <> ''"


#: The removed line counts and cleaned texts in SQL.
SQL = f"""
WITH base AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, i, line, md5(line) AS digits FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM base)),
chunk AS ({" UNION ".join(f"SELECT * FROM ({_sql_chunks(d)}) WHERE stop IS NOT NULL" for d in FAMILIES)}),
body AS (SELECT doc_id, start, stop, array_to_string(lines[start:stop], chr(10)) AS body FROM chunk JOIN base USING (doc_id)),
gone AS (SELECT doc_id, start, stop FROM (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, start) AS nth FROM body) WHERE nth > 1),
lost AS (SELECT DISTINCT doc_id, unnest(range(start, stop + 1)) AS i FROM gone),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text FROM line ANTI JOIN lost USING (doc_id, i) GROUP BY doc_id)
SELECT b.doc_id, CAST(len(b.lines) AS INT) AS n_lines, CAST(coalesce(g.n, 0) AS INT) AS n_removed_lines, md5(coalesce(k.text, '')) AS text_md5
FROM base b LEFT JOIN kept k USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM lost GROUP BY doc_id) g USING (doc_id)
"""
