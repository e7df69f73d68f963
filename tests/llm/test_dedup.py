"""Substring, line and near dedup against brute force over small tables of all kinds."""

import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tiermill.llm import line_dedup, lineage, near_dedup, substring_dedup
from tiermill.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


# --- spans of sentences


def spans_of(text):
    words = [(m.start(), m.end(), low(m[0])) for m in WORD.finditer(text)]
    sentences, now = [], []
    for i, word in enumerate(words):
        now.append(word)
        after = words[i + 1][0] if i + 1 < len(words) else len(text)
        if word[2][-1] in ".!?;" or "\n" in text[word[1] : after] or i + 1 == len(words):
            sentences.append(now)
            now = []
    units = []
    for sentence in sentences:
        part = []
        for word in sentence:
            part.append(word)
            if len(sentence) > 12 and word[2][-1] in ",:":
                units.append(part)
                part = []
        units += [part] if part else []
    for i in range(len(units)):
        run = []
        for j in range(i, len(units)):
            run += units[j]
            if len(run) >= 16 and j > i:
                yield tuple(w[2] for w in run), run[0][0], run[-1][1]
                break


def losses(docs):
    met = collections.defaultdict(list)
    for i, text in docs:
        for words, a, b in spans_of(text):
            met[words].append((i, a, b))
    lost = collections.defaultdict(list)
    for places in met.values():
        first, *rest = sorted(places)
        for i, a, b in rest:
            lost[i, first[0]].append((a, b))
    out = {}
    for pair, places in lost.items():
        merged = []
        for a, b in sorted(places):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        out[pair] = [tuple(m) for m in merged]
    return out


def found(df):
    return {(r.doc_id, r.first_doc_id): [(s.start, s.stop) for s in r.spans] for r in df.collect()}


def test_spans_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = losses([(r.doc_id, r.text or "") for r in docs.collect()])
    assert expected and found(substring_dedup.repeated_spans(docs)) == expected


def test_a_passage_inside_other_texts(docs_of, prose):
    passage = "One small fox ran by the river. It saw a lamp in the night, and then the rain came; all doors were shut. No key fit, so the fox sat on a stone and waited for the sun to rise."
    texts = [prose(1), f"{prose(2)} and then {passage} {prose(3)}", prose(4), f"{prose(5)}\n{passage}", f"{passage} {prose(6)}"]
    gone = found(substring_dedup.repeated_spans(docs_of(texts)))
    assert gone.keys() == {(3, 1), (4, 1), (4, 3)}
    cleaned = {r.i: r for r in substring_dedup.substring_dedup(docs_of(texts)).select(F.col("_row.doc_id").alias("i"), "_text", "_row.*").collect()}
    assert len(cleaned) == 5 and cleaned[0]._text == texts[0] and cleaned[1]._text == texts[1]
    assert "waited for the sun" in cleaned[1]._text and not any("waited for the sun" in cleaned[i]._text for i in (3, 4))
    assert prose(6)[-40:] in cleaned[4]._text and cleaned[3]._text.startswith(prose(5))


def test_ids_of_text(spark, prose):
    """Ids are carried and compared, whatever their type."""
    passage = "One small fox ran by the river. It saw a lamp in the night, and then the rain came; all doors were shut. No key fit, so the fox sat on a stone."
    rows = [("b", f"{prose(1)}\n{passage}"), ("a", f"{prose(2)}\n{passage}"), ("c", f"{prose(1)}\n{passage}"), (None, prose(3))]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    assert {(r.doc_id, r.first_doc_id) for r in substring_dedup.repeated_spans(docs).collect()} == {("b", "a"), ("c", "a"), ("c", "b")}
    assert substring_dedup.substring_dedup(docs).count() == 4
    assert {r._id: r._removed > 0 for r in line_dedup.line_dedup(docs).collect()} == {None: False, "a": False, "b": False, "c": True}
    assert {r.doc_id: r.component_id for r in near_dedup.near_dedup(docs).collect()} == {None: None, "a": "a", "b": "b", "c": "b"}


def test_span_edges(edges):
    gone = found(substring_dedup.repeated_spans(edges))
    assert gone.keys() <= {(7, 7)}
    assert substring_dedup.substring_dedup(edges).count() == 9
    assert substring_dedup.repeated_spans(edges.limit(0)).count() == 0


def test_a_span_repeated_in_its_own_text(docs_of):
    line = "The fox ran by the old river. A lamp was lit in the house, and nobody came to the door."
    gone = found(substring_dedup.repeated_spans(docs_of([f"{line}\n{line}"])))
    assert gone == {(0, 0): [(len(line) + 1, 2 * len(line) + 1)]}


# --- chunks of lines


def cleaned(docs):
    rows = line_dedup.line_dedup(docs).select("_id", "_text", "_removed", F.col("_row.text").alias("before")).collect()
    return sorted(((r._id, r._text, r._removed) for r in rows), key=str)


def test_copies_lose_their_chunks(docs_of, prose):
    texts = [prose(1, 120), prose(2, 120), prose(1, 120), "intro line\n" + prose(1, 120), prose(3, 24)]
    rows = {i: (text, n) for i, text, n in cleaned(docs_of(texts))}
    assert rows[0] == (texts[0], 0) and rows[1] == (texts[1], 0) and rows[4] == (texts[4], 0)
    # all but single lines go from the copy; after an insertion, all but what shares a chunk with it
    assert rows[2][1] >= 8 and rows[3][1] >= 4
    for i in (2, 3):
        assert len(rows[i][0].split("\n")) == len(texts[i].split("\n")) - rows[i][1] or rows[i][0] == ""


def test_line_edges(edges):
    rows = cleaned(edges)
    assert len(rows) == 9
    texts = [(i, t) for i, t, _ in rows]
    assert (1, None) in texts and (2, "") in texts
    # the repeated row is the same document and stays; the copy under another id goes
    assert texts.count((4, "same text\nagain and again")) == 2 and (5, "") in texts
    assert line_dedup.line_dedup(edges.limit(0)).count() == 0


def test_null_ids_come_first(docs_of):
    body = "first line here\nsecond line there"
    rows = cleaned(docs_of([(3, body), (None, body), (-2, body)]))
    assert sorted(rows, key=lambda r: str(r[0])) == [(-2, "", 2), (3, "", 2), (None, body, 0)]


def test_hot_chunk_beside_unique_lines(docs_of, prose):
    footer = "all rights reserved\nprinted by the old press"
    texts = [prose(i, 24) + "\n" + footer for i in range(40)] + [footer] * 60
    rows = {i: (text, n) for i, text, n in cleaned(docs_of(texts))}
    assert sum(text == footer for text, _ in rows.values()) <= 1
    assert all(prose(i, 24).split("\n")[0] in rows[i][0] for i in range(40))


def chunks_left(rows):
    """rows (id, text) with ids: what is left of each, and the number of lines that went."""
    seen, gone = set(), collections.defaultdict(set)
    lines_of = {i: text.split("\n") for i, text in rows}
    for i in sorted(lines_of):
        lines, found = lines_of[i], set()
        full = [k for k, line in enumerate(lines) if line.strip(" ")]
        digits = [hashlib.md5(line.encode()).hexdigest() for line in lines]
        for d in (0, 1, 4, 5):
            for odd in (0, 1):
                chain = [k for k in full if ord(digits[k][d]) % 2 == odd]
                found |= set(zip(chain, chain[1:]))
        for a, b in sorted(found):
            body = tuple(lines[a : b + 1])
            if body in seen:
                gone[i] |= set(range(a, b + 1))
            seen.add(body)
    return {i: ("\n".join(x for k, x in enumerate(lines) if k not in gone[i]), len(gone[i])) for i, lines in lines_of.items()}


def test_lines_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = chunks_left([(r.doc_id, r.text or "") for r in docs.collect()])
    got = {r._id: (r._text or "", r._removed) for r in line_dedup.line_dedup(docs).collect()}
    assert got == expected and sum(n for _, n in expected.values()) > 0


@pytest.mark.parametrize(("n", "least"), [(2, 0.8), (3, 1.0), (4, 1.0), (6, 1.0)])
def test_short_passages_inside_other_texts_go(docs_of, prose, n, least):
    passages = [prose(1000 + i, 12 * n) for i in range(40)]
    texts = [f"{prose(i, 36)}\n{p}\n{prose(100 + i, 36)}" for i, p in enumerate(passages)]
    texts += [f"{prose(200 + i, 24)}\n\n{p}\n\n{prose(300 + i, 24)}" for i, p in enumerate(passages)]
    rows = {i: (text, gone) for i, text, gone in cleaned(docs_of(texts))}
    assert all(rows[i] == (texts[i], 0) for i in range(40))
    assert sum(rows[40 + i][1] >= 2 for i in range(40)) >= least * 40
    assert all(prose(200 + i, 24) in rows[40 + i][0] and prose(300 + i, 24) in rows[40 + i][0] for i in range(40))


def test_of_a_line_repeated_on_and_on_one_is_left(docs_of, prose):
    block = ["the same line again"] * 50
    texts = ["\n".join([prose(1, 24), *block, prose(2, 24)]), "\n".join([prose(3, 24), *block]), "\n\n".join(block), "\n".join(block[:2])]
    rows = {i: (text, n) for i, text, n in cleaned(docs_of(texts))}
    assert rows[0] == ("\n".join([prose(1, 24), block[0], prose(2, 24)]), 49) and rows[1] == (prose(3, 24), 50)
    assert rows[2] == (block[0] + "\n", 97) and rows[3] == ("", 2)


# --- near-duplicates


def shingle_sets(texts, n):
    sets = []
    for text in texts:
        words = [low(w) for w in WORD.findall(text or "")]
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set())
    return sets


def groups(rows, n, percent):
    """rows (id, text) with ids: the smallest id reachable from each, over all pairs."""
    sets, least = shingle_sets([t for _, t in rows], n), {i: i for i, _ in rows}
    pairs = [(a, b) for x, (a, _) in enumerate(rows) for y, (b, _) in enumerate(rows[:x]) if a == b or (sets[x] & sets[y] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]))]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(least[a], least[b])
            if least[a] != m or least[b] != m:
                least[a] = least[b] = m
                changed = True
    return least, dict(zip([i for i, _ in rows], map(len, sets), strict=True))


def edited(rng, text, k):
    words = text.split(" ")
    for _ in range(k):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize(("n", "percent"), [(3, 85), (5, 80)])
def test_groups_equal_brute_force(docs_of, prose, n, percent):
    rng = random.Random(7)
    base = prose(11, 150)
    texts = [prose(i, rng.randrange(1, 90)) for i in range(30)]
    texts += [edited(rng, base, rng.randrange(0, 9)) for _ in range(60)]  # a large group, many pairs near the limit
    for i in range(10):
        step = prose(100 + i, 120)
        for _ in range(4):  # chains: each is near the one before only
            texts.append(step)
            step = edited(rng, step, 3)
    texts += [texts[3]] * 20 + ["", None, "one", "one two", "One  Two"]
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = list(zip(order, texts, strict=True))
    least, sizes = groups(rows, n, percent)
    got = {r.doc_id: r for r in near_dedup.near_dedup(docs_of(rows), n, percent, along=10).collect()}
    assert {i: r.component_id for i, r in got.items()} == least
    assert {i: r.n_shingles for i, r in got.items()} == sizes
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_near_edges(edges):
    rows = near_dedup.near_dedup(edges).collect()
    assert len(rows) == 9
    by = {r.doc_id: (r.component_id, r.kept) for r in rows}
    assert by[1] == (1, True) and by[2] == (2, True) and by[3] == (3, True)  # without words: linked with nothing
    assert by[None] == (None, True) and by[5] == (4, False) and by[4] == (4, True)
    assert near_dedup.near_dedup(edges.limit(0)).count() == 0


def test_each_text_of_an_id_is_linked_for_itself(docs_of, prose):
    rows = [(9, prose(1)), (9, prose(2)), (3, prose(1)), (5, prose(2)), (7, prose(4)), (9, prose(5))]
    got = [(r.doc_id, r.component_id, r.kept) for r in near_dedup.near_dedup(docs_of(rows)).collect()]
    assert sorted(got) == [(3, 3, True), (5, 5, True), (7, 7, True), (9, 3, False), (9, 5, False), (9, 9, True)]


def test_a_group_just_below_the_limit(docs_of):
    """Texts that differ from each other in few words: most pairs miss the limit by little, and all of them count."""
    rng = random.Random(4)
    rows = []
    for i in range(160):
        words = [f"w{k}" for k in range(100)]
        for k in rng.sample(range(100), 2):
            words[k] = f"new{rng.randrange(60)}"
        rows.append((i, " ".join(words[: rng.randrange(90, 101)])))
    least, _ = groups(rows, 3, 85)
    assert {r.doc_id: r.component_id for r in near_dedup.near_dedup(docs_of(rows)).collect()} == least
    assert 10 < len(set(least.values())) < 150


def test_nothing_written_on_the_way_stays(docs_of, prose, tmp_path, monkeypatch):
    monkeypatch.setattr(lineage, "shared_folder", lambda spark: f"file://{tmp_path}")
    done = near_dedup.near_dedup(docs_of([prose(i % 5, 40) for i in range(20)]))
    assert len(list(tmp_path.iterdir())) == 1 and done.count() == 20
    with pytest.raises(Exception):
        near_dedup.near_dedup(docs_of(["x"]), id_col="no such column")
    assert len(list(tmp_path.iterdir())) == 1


def test_components_of_random_graphs(spark):
    rng = random.Random(1)
    for n, m in ((40, 25), (60, 59), (2, 1)):
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(n, n + 30)]
        least = {x: x for p in pairs for x in p}
        for _ in range(len(least)):
            for a, b in pairs:
                least[a] = least[b] = min(least[a], least[b])
        linked = {x for a, b in pairs if a != b for x in (a, b)}
        got = components(spark.createDataFrame(pairs, "a long, b long")).collect()
        assert {r.id: r.component for r in got} == {i: c for i, c in least.items() if i in linked} and len(got) == len(linked)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("pairs,rounds", [([(5, 1), (6, 1), (7, 1), (9, 2), (8, 2)], 0), ([(5, 1), (6, 1), (1, 7), (7, 6), (8, 7), (9, 2)], 1)])
def test_components_need_no_round_to_see_that_they_are_done(spark, monkeypatch, pairs, rounds):
    """Every table that a round writes is a shuffle into all partitions: stars take the links and one count, each round three tables and a count."""
    written = []
    monkeypatch.setitem(components.__wrapped__.__globals__, "cut", lambda df: written.append(df) or lineage.cut(df))
    got = {r.id: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {1: 1, 5: 1, 6: 1, 7: 1, 8: 1 if rounds else 2, 9: 2, 2: 2}
    assert len(written) == 2 + 4 * rounds


def test_components_of_repeated_links(spark):
    pairs = [(1, 2)] * 5 + [(2, 3)] * 3 + [(3, 4)] * 4 + [(4, 5), (5, 4), (7, 9), (9, 7), (8, 9), (6, 6), (None, 1)]
    got = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert sorted((r.id, r.component) for r in got) == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (7, 7), (8, 7), (9, 7)]


def test_candidates_that_are_linked_are_not_compared_again(docs_of, prose, monkeypatch):
    """Between components that hubs leave apart there are few links; copies that hang on one hub have none."""
    seen = []
    monkeypatch.setattr(near_dedup, "components", lambda links: seen.append(links.count()) or components(links))
    rng = random.Random(3)
    base = prose(21, 150)
    rows = list(enumerate([base, *(edited(rng, base, 1) for _ in range(12))]))
    assert {r.component_id for r in near_dedup.near_dedup(docs_of(rows)).collect()} == {0}
    assert seen[0] >= 12 and seen[1:] == [0, 0]
