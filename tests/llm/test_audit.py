"""The filter audit against brute force: every order applied to every document."""

import re
from itertools import permutations

import pytest

from tiermill.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def failures(docs):
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = []
    for i, text, _ in docs:
        text = text or ""
        words = WORD.findall(text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and least[text] < i,
        }
        out.append({f for f, bad in fails.items() if bad})
    return out


def audited(docs, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    rows, fails = {}, failures(docs)
    for part in {s or "" for _, _, s in docs}:
        own = [(d[0], f) for d, f in zip(docs, fails, strict=True) if (d[2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone, before = [i for i, bad in left if f in bad], set(order[: step - 1])
                left = [(i, bad) for i, bad in left if f not in bad]
                shapley[f] += len(gone)
                rows[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in bad and bool(bad & before) for _, bad in own), sum(bad == {f} for _, bad in own), sum(i in good for i in gone), sum(i in toxic for i in gone),
                ]
        for (p, order, step), row in rows.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in rows.items()}


def run(docs, labels):
    done = filter_audit.filter_audit(docs, labels).collect()
    assert all(type(r.step) is int for r in done)
    return {(r.part, r.filter_order, r.step): (*(r[n] for n in NAMES), r.shapley) for r in done}


@pytest.fixture
def labels_of(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_the_given_table(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    expected = audited([(r.doc_id, r.text, r.source) for r in docs.collect()], [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    assert run(docs, labels) == expected


def test_all_kinds_of_rows(docs_of, labels_of, prose):
    long = prose(1, 260)
    rows = [
        (1, long, "a"), (2, long, "b"), (3, long + " $", "a"), (None, long, "a"), (None, long, None), (2, long, "b"), (1, long, "a"), (0, None, "a"), (4, "", ""), (5, "", None),
        (6, "SHOUT " * 300, "a"), (7, "word " * 40_000, "b"), (8, "x" * 120_000, "b"), (9, "no\xa0break space É", "a"), (10, "A|b", "c"), (11, "A|b", "c"), (3, "A|b", "a"), (12, "\U0001f600" * 60 + " A", "c"),
    ]
    labels = [(1, 1, 0), (1, 0, 1), (2, None, 1), (3, 1, None), (None, 1, 1), (11, 1, 1), (99, 1, 1)]
    assert run(docs_of(rows), labels_of(labels)) == audited(rows, labels)


def test_a_text_in_a_third_of_all_rows(docs_of, labels_of, prose):
    rows = [(i, "one text for many\n" * 60 if i % 3 == 0 else prose(i, 30), "web") for i in range(300)]
    assert run(docs_of(rows), labels_of([(0, 1, 1)])) == audited(rows, [(0, 1, 1)])


def test_audit_edges(docs_of, labels_of):
    assert run(docs_of([(1, "x", "a")]).limit(0), labels_of([(1, 1, 1)])) == {}
    one = [(1, "x", "a")]
    assert run(docs_of(one), labels_of([(1, 1, 1)]).limit(0)) == audited(one, [])


def test_other_filters(docs_of, labels_of):
    """Two filters of one's own: two orders with copies make six."""
    short = {"S": lambda words, text: filter_audit.F.size(words) < 3, "Z": lambda words, text: text.contains("z")}
    rows = [(1, "a z", "p"), (2, "a b c", "p"), (3, "a b c", "p"), (4, "z z z", "p")]
    done = {(r.filter_order, r.step): r.removed for r in filter_audit.filter_audit(docs_of(rows), labels_of([(1, 1, 1)]), short).collect()}
    assert len(done) == 18
    assert [done["SZE", i] for i in (1, 2, 3)] == [1, 1, 1] and [done["ZSE", i] for i in (1, 2, 3)] == [2, 0, 1]
