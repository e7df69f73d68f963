"""MinHash near-dedup with tensored banding, verified on full shingle sets.

Two collections of ALONG band hashes each (a band is PER_BAND minhashes) make the keys of ALONG * ALONG tables: every
pair of a band of the one and a band of the other. So 2 * ALONG * PER_BAND minhashes do the work of
2 * PER_BAND * ALONG**2. At a similarity of 0.85, a pair misses all keys with a probability of 2 * (1 - 0.85**2)**8,
about 7 in 100,000. A key can be shared only where both its bands are, so bands are counted first, and keys made of
those alone that several sets have.

Links matter only for what they connect. Within a key, all sets are first compared with one, the hub. Where candidates
that hang together through keys and hubs then still belong to several components, those of different components are
compared, by what they differ in from one centre, the hub that most of them have: two sets differ in as many shingles as
their differences do, and near a centre these are small. They are ordered from rare to frequent, and only as many first
ones are joined as two sets must share one of, by their sizes, to be similar enough. So neither copies nor a group of
texts that all lie just below the limit cost pairs without end, and no pair is lost.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.components import components
from tiermill.llm.lineage import cut, tidy
from tiermill.llm.rows import map_texts
from tiermill.llm.words import LOWER, Words, mix

SHINGLE, PERCENT = 3, 85
ALONG, PER_BAND = 8, 2
#: Differences from a hub are of one kind if their sizes lie between neighbouring powers of this.
KIND = 1.25


def shingles(texts: list[str], n: int) -> list[np.ndarray]:
    """Sorted hashes of the distinct runs of n words of each text; of a shorter text, that of all its words."""
    words = Words([t.encode().translate(LOWER) for t in texts])
    hashes, at = words.windows(n)
    doc = words.doc[at] if len(at) else at
    cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        if cuts[i + 1] > cuts[i]:
            out.append(np.unique(hashes[cuts[i] : cuts[i + 1]]))
        else:
            own = words.hashes[words.first[i] : words.first[i + 1]]
            joined = np.full(min(1, len(own)), len(own), np.uint64)
            for h in own:
                joined = mix(joined * np.uint64(0x9E3779B97F4A7C15) + h)
            out.append(joined)
    return out


def signatures(texts: list[str], n: int, along: int = ALONG) -> dict[str, list]:
    """Size, two sums that stand for the whole set, and the two collections of band hashes (none of an empty set)."""
    sets = shingles(texts, n)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    full = np.flatnonzero(sizes)
    out = {"n_shingles": sizes.tolist(), "sum1": [0] * len(sets), "sum2": [0] * len(sets), "left": [[]] * len(sets), "right": [[]] * len(sets)}
    if not len(full):
        return out
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
    seeds = mix(np.arange(1, 2 * along * PER_BAND + 3, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    sums = [np.add.reduceat(mix(flat ^ s), starts).view(np.int64).tolist() for s in seeds[-2:]]
    least = [mix(np.minimum.reduceat((flat ^ s) * (s | np.uint64(1)), starts)) for s in seeds[:-2]]
    bands = []
    for b in range(2 * along):
        joined = np.zeros(len(full), np.uint64)
        for part in least[b * PER_BAND : (b + 1) * PER_BAND]:
            joined = mix(joined * np.uint64(0x9E3779B97F4A7C15) + part)
        bands.append(joined.view(np.int64))
    left, right = np.stack(bands[:along], 1).tolist(), np.stack(bands[along:], 1).tolist()
    for k, i in enumerate(full.tolist()):
        out["sum1"][i], out["sum2"][i], out["left"][i], out["right"][i] = sums[0][k], sums[1][k], left[k], right[k]
    return out


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b), those whose sets overlap enough."""
    one = sets.select(F.col("node").alias("a"), F.col("s").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("s").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    met = pairs.join(two, "b").join(one, "a").select("a", "b", both.alias("i"), (F.size("sa") + F.size("sb")).alias("t"))
    return met.filter(F.col("i") * 100 >= (F.col("t") - F.col("i")) * percent).select("a", "b")


def _keys(nodes: DataFrame, along: int) -> DataFrame:
    """node, n, key: the tables' keys of nodes (node, n, left, right), made of bands that another node has too."""
    places = F.posexplode(F.concat("left", "right")).alias("place", "band")
    bands = nodes.select("node", "n", places).select("node", "n", "place", F.xxhash64("place", "band").alias("band"))
    often = bands.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least <> most").select("band")
    held = bands.join(cut(often), "band").groupBy("node", "n").agg(F.collect_list(F.struct("place", "band")).alias("bands"))
    side = lambda first: F.filter("bands", lambda b: (b["place"] < along) == F.lit(first))
    pairs = F.flatten(F.transform(side(True), lambda x: F.transform(side(False), lambda y: F.xxhash64(x["band"], y["band"]))))
    return held.select("node", "n", F.explode(pairs).alias("key"))


@tidy
def near_dedup(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, along: int = ALONG, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable by links), kept (it is the smallest itself).

    Texts are linked if 100 * intersection >= percent * union of their shingle sets. One row per row of `docs`, and each row
    is a document of its own, also where rows share an id: of two texts under one id either may be linked without the
    other. Texts without words are linked with nothing. Rows without an id are compared with nothing: component_id is
    null, kept is true. Other columns are not read.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("version"))
    schema = "n_shingles long, sum1 long, sum2 long, left array<long>, right array<long>"
    keys = {"doc_id": F.col("doc_id"), "version": F.col("version")}
    signed = cut(map_texts(texts, lambda some: signatures(some, shingle, along), schema, keys).withColumn("row", F.monotonically_increasing_id()))
    usable = signed.filter("n_shingles > 0 and doc_id is not null")
    # equal sets are one node: the number of one of their rows
    same = ["sum1", "sum2", "n_shingles"]
    classes = cut(usable.groupBy(*same).agg(F.min("row").alias("node"), F.min("doc_id").alias("least")))
    nodes = cut(usable.join(classes.select(F.col("node").alias("row")), "row", "left_semi").select(F.col("row").alias("node"), "doc_id", "version", F.col("n_shingles").alias("n"), "left", "right"))
    keyed = cut(_keys(nodes, along))
    hubs = keyed.groupBy("key").agg(F.min(F.struct("node", "n")).alias("hub"), F.max("node").alias("last")).filter("hub.node <> last").select("key", "hub")
    met = cut(keyed.join(hubs, "key").select("node", "n", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n")).distinct())
    fits = F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * percent
    stars = met.filter((F.col("node") != F.col("hub")) & fits).select(F.col("hub").alias("a"), F.col("node").alias("b"))
    involved = nodes.join(met.select("node").distinct(), "node", "left_semi").select("node", F.col("doc_id").alias("_id"), F.col("version").alias("_version"))
    chosen = texts.join(involved, (F.col("doc_id") == F.col("_id")) & (F.col("version") == F.col("_version"))).select("node", "text").dropDuplicates(["node"])
    sets = cut(map_texts(chosen, lambda some: {"s": [x.view(np.int64) for x in shingles(some, shingle)]}, "s array<long>", {"node": F.col("node")}))
    links = cut(_similar(stars, sets, percent))
    rows = cut(_parts(met, components(links)))
    found = components(_across(met, sets, rows, percent))
    # the smallest id of each component, from those of its nodes
    whole = rows.join(found, F.col("c") == F.col("id"), "left").select(F.col("node").alias("_node"), F.coalesce("component", "c").alias("component"))
    placed = cut(classes.join(whole, F.col("node") == F.col("_node"), "left").select(*same, "least", F.coalesce("component", "node").alias("component")))
    smallest = cut(placed.groupBy("component").agg(F.min("least").alias("smallest")))
    known = placed.join(smallest, "component").select(*(F.col(c).alias(f"_{c}") for c in same), F.col("smallest").alias("least"))
    own = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    for c in same:
        own = own & (F.col(c) == F.col(f"_{c}"))
    done = signed.select("doc_id", *same).join(known, own, "left")
    component = F.coalesce("least", "doc_id")
    return done.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def _parts(met: DataFrame, part: DataFrame) -> DataFrame:
    """node, n, k (how many met it as their hub), c (its component in `part`, itself if it has none) of all that met."""
    ends = F.explode(F.array(F.struct("node", "n", F.lit(0).alias("k")), F.struct(F.col("hub").alias("node"), F.col("hub_n").alias("n"), F.lit(1).alias("k")))).alias("end")
    known = met.select(ends).select("end.*").groupBy("node").agg(F.max("n").alias("n"), F.sum("k").alias("k"))
    return known.join(part, F.col("node") == F.col("id"), "left").select("node", "n", "k", F.coalesce("component", "node").alias("c"))


def _across(met: DataFrame, sets: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components c of `rows`, by similar nodes of both, of those that hang together through keys."""
    one = rows.select("node", F.col("c").alias("a"))
    two = rows.select(F.col("node").alias("hub"), F.col("c").alias("b"))
    # a component that met no node of another one has nothing left to compare
    between = met.filter(F.col("node") != F.col("hub")).join(one, "node").join(two, "hub").filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    around = components(between).select(F.col("id").alias("c"), F.col("component").alias("group"))
    mixed = cut(rows.join(around, "c").select("node", "n", "k", "c", "group"))
    centres = cut(mixed.groupBy("group").agg(F.max(F.struct("k", "node", "n", "c")).alias("centre")).select("group", F.col("centre.node").alias("hub"), F.col("centre.n").alias("hub_n"), F.col("centre.c").alias("hub_c")))
    left = mixed.join(centres, "group").drop("group", "k")
    hub_sets = sets.select(F.col("node").alias("hub"), F.col("s").alias("h"))
    differences = F.concat(F.array_except("s", "h"), F.array_except("h", "s"))
    apart = cut(left.join(sets, "node").join(hub_sets, "hub").select("hub", "hub_n", "hub_c", "node", "n", "c", differences.alias("d")))
    # the centre's own difference is empty: the sizes of the others tell all
    near = (F.col("node") != F.col("hub")) & (F.size("d") * (100 + percent) <= (F.col("n") + F.col("hub_n")) * (100 - percent))
    direct = apart.filter(near & (F.col("c") != F.col("hub_c"))).select(F.col("hub_c").alias("a"), F.col("c").alias("b"))
    every = apart.select("hub", "node", F.explode("d").alias("e"))
    often = cut(every.groupBy("hub", "e").agg(F.count("*").alias("k")).filter("k > 1"))
    # of each difference its shared shingles, rare ones first; those of one node alone come before all of them
    ranked = every.join(often, ["hub", "e"]).groupBy("hub", "node").agg(F.sort_array(F.collect_list(F.struct("k", "e"))).alias("shared"))
    size, most = F.size("d"), F.floor(F.col("n") * (100 - percent) / percent)
    known = cut(apart.join(ranked, ["hub", "node"]).select("hub", "node", "n", "c", size.alias("size"), most.alias("most"), "shared"))
    # two sets are similar enough only if they differ in `most` shingles at most, and so do the sizes of their differences
    kind = lambda x: F.floor(F.log(KIND, F.greatest(x, F.lit(1)))).cast("int")
    # of these kinds only those that the hub has are asked for, a few numbers for each hub
    kinds = cut(known.groupBy(F.col("hub").alias("_hub")).agg(F.collect_set(kind(F.col("size"))).alias("kinds")))
    near = F.sequence(kind(F.col("size") - F.col("most")), kind(F.col("size") + F.col("most")))
    partners = F.explode(F.array_intersect(near, "kinds")).alias("other")
    least_other = F.ceil(F.pow(F.lit(KIND), "other") - 1e-6)
    # a shared shingle at a later place leaves too few behind it
    last = F.floor((F.col("size") + F.col("most") - F.col("least_other")) / 2) + 1
    alone = F.col("size") - F.size("shared")
    first = known.join(kinds, F.col("hub") == F.col("_hub")).select(*known.columns, kind(F.col("size")).alias("own"), partners).withColumn("least_other", least_other)
    heads = first.select("hub", "node", "n", "c", "size", "own", "other", alone.alias("alone"), F.posexplode(F.slice("shared", 1, F.greatest(last - alone, F.lit(0)).cast("int"))).alias("place", "x"))
    heads = cut(heads.select("hub", "node", "n", "c", "size", "own", "other", (F.col("alone") + F.col("place")).alias("before"), F.col("x.e").alias("e")))
    x = heads.select(*(F.col(c).alias(f"x_{c}") for c in heads.columns))
    y = heads.select(*(F.col(c).alias(f"y_{c}") for c in heads.columns))
    on = (F.col("x_hub") == F.col("y_hub")) & (F.col("x_e") == F.col("y_e")) & (F.col("x_own") == F.col("y_other")) & (F.col("x_other") == F.col("y_own")) & (F.col("x_c") < F.col("y_c"))
    allowed = F.floor((F.col("x_n") + F.col("y_n")) * (100 - percent) / (100 + percent))
    reach = F.least(F.col("x_size") - F.col("x_before"), F.col("y_size") - F.col("y_before"))
    enough = F.col("x_size") + F.col("y_size") - 2 * reach <= allowed
    pairs = cut(x.join(y, on).filter(enough).select(F.col("x_hub").alias("hub"), F.col("x_node").alias("a"), F.col("y_node").alias("b")).distinct())
    one = known.select("hub", F.col("node").alias("a"), F.col("c").alias("ca"), F.col("n").alias("na"), F.col("size").alias("za"), F.transform("shared", lambda v: v["e"]).alias("da"))
    two = known.select("hub", F.col("node").alias("b"), F.col("c").alias("cb"), F.col("n").alias("nb"), F.col("size").alias("zb"), F.transform("shared", lambda v: v["e"]).alias("db"))
    checked = pairs.join(two, ["hub", "b"]).join(one, ["hub", "a"])
    differ = F.col("za") + F.col("zb") - 2 * F.size(F.array_intersect("da", "db"))
    similar = differ * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent)
    return direct.union(checked.filter(similar).select(F.col("ca").alias("a"), F.col("cb").alias("b")))


#: The same in SQL, from all pairs that share a shingle.
SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {SHINGLE} THEN [array_to_string(ws, ' ')]
  ELSE list_distinct([array_to_string(ws[i:i + {SHINGLE - 1}], ' ') FOR i IN range(1, len(ws) - {SHINGLE - 2})]) END AS ss FROM w),
size AS (SELECT doc_id, len(ss) AS n FROM s),
one AS (SELECT doc_id, unnest(ss) AS x FROM s),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM one a JOIN one b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * i >= {PERCENT} * (p.n + q.n - i)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id, doc_id AS other FROM s UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON l.a = r.other)
SELECT size.doc_id, CAST(n AS BIGINT) AS n_shingles, c.component_id, c.component_id = size.doc_id AS kept
FROM size JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""
