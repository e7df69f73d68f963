"""The whole pipeline against all five stages in plain Python, sharing no code with the operators."""

import collections
import hashlib
import random
import re

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tiermill.llm.vocab import default_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = re.compile(r"[\x20\x09-\x0D]+")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def passes_rules(text):
    words = WORD.findall(text)
    runs = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    again = {p for i in range(len(words) - 7) if runs[tuple(words[i : i + 8])] > 1 for p in range(i, i + 8)}
    return len(words) >= 20 and 100 * len(again) <= 30 * len(words)


def normal(line):
    return BLANKS.sub(" ", re.sub("[1-9]", "0", ascii_lower(line))).strip(" ")


def quality(docs):
    held = collections.defaultdict(set)
    for _, text, source in docs:
        for line in text.split("\n"):
            if len(WORD.findall(line)) >= 3:
                held[source, normal(line)].add(text)
    out = []
    for i, text, source in docs:
        lines = text.split("\n")
        common = [bool(WORD.search(x)) and len(held[source, normal(x)]) >= 10 for x in lines]
        n, lost = len(WORD.findall(text)), sum(len(WORD.findall(x)) for x, c in zip(lines, common, strict=True) if c)
        depleted = any(common) and (n - lost < 20 or 100 * (n - lost) < 30 * n)
        if passes_rules(text) and not depleted:
            out.append((i, "\n".join(x for x, c in zip(lines, common, strict=True) if not c), source))
    return out


def lines_once(docs):
    seen, out = set(), []
    for i, text, source in sorted(docs):
        lines = text.split("\n")
        gone, found = set(), set()
        for d in (0, 1, 4, 5):
            for odd in (0, 1):
                chain = [k for k, x in enumerate(lines) if x.strip(" ") and ord(hashlib.md5(x.encode()).hexdigest()[d]) % 2 == odd]
                found |= set(zip(chain, chain[1:], strict=False))
        for a, b in sorted(found):
            body = tuple(lines[a : b + 1])
            gone |= set(range(a, b + 1)) if body in seen else set()
            seen.add(body)
        left = "\n".join(x for k, x in enumerate(lines) if k not in gone)
        if not gone or len(WORD.findall(left)) >= 20:
            out.append((i, left, source))
    return out


def one_of_each_group(docs):
    sets = []
    for _, text, _ in docs:
        words = WORD.findall(ascii_lower(text))
        sets.append({tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)})
    group = list(range(len(docs)))
    changed = True
    while changed:
        changed = False
        for x in range(len(docs)):
            for y in range(x):
                if group[x] != group[y] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                    group[x] = group[y] = min(group[x], group[y])
                    changed = True
    least = {}
    for (i, _, _), g in zip(docs, group, strict=True):
        least[g] = min(i, least.get(g, i))
    return [d for d, g in zip(docs, group, strict=True) if d[0] == least[g]]


def without_leaks(docs, items):
    cut = lambda text: [w for w in re.split(r"[^\w]|_", text.lower()) if w]  # noqa: E731  the fixture's texts are letters and digits

    def leaks(words, item):
        for shift in range(-len(item) + 1, len(words)):
            flags = [0 <= j + shift < len(words) and words[j + shift] == t for j, t in enumerate(item)]
            width = min(15, len(item))
            if any(100 * sum(flags[s : s + width]) >= width * (80 if len(item) >= 8 else 100) for s in range(len(item) - width + 1)):
                return True
        return False

    cut_items = [c for c in map(cut, items) if len(c) >= 4]
    return [d for d in docs if not any(leaks(cut(d[1]), item) for item in cut_items)]


@pytest.fixture(scope="module")
def corpus(prose):
    rng = random.Random(12)
    items = [" ".join(f"item{k}x{i}" for i in range(n)) for k, n in enumerate((22, 15, 30, 6))]
    rows, passage = [], prose(900, 60)
    menu = "Home and About us and page 12 with more words"
    for i in range(24):
        rows.append((prose(i, rng.randrange(25, 90)), "web"))
    for i in range(14):  # a menu that a host's documents share; some hold little else
        rows.append((f"{menu}\n{prose(50 + i, 12 if i % 5 == 0 else 40)}", "shop"))
    for i in range(4):  # a passage of whole lines in other texts, and copies, exact and near
        rows.append((f"{prose(100 + i, 30)}\n{passage}\n{prose(120 + i, 30)}", "web"))
        rows.append((prose(2, 60) if i % 2 else prose(3, 60), "web"))
        words = prose(140, 110).replace("\n", " ").split(" ")
        words[rng.randrange(110)] = f"edit{i}"
        rows.append((" ".join(words), "press"))
    for i, item in enumerate(items):
        tokens = item.split()
        if len(tokens) >= 15:
            tokens[rng.randrange(len(tokens))] = "swapped"
        rows.append((f"{prose(160 + i, 24)}\n{' '.join(tokens)}\n{prose(180 + i, 24)}", "web"))
    rows += [("", "web"), ("short text", "web"), ("again and again and on it goes " * 30, "web"), ("x y z", None)]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(i, t, s) for i, (t, s) in zip(order, rows, strict=True)], items


def test_run_equals_plain_python(spark, corpus, tmp_path):
    docs, items = corpus
    spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    first = quality([(i, t, s or "") for i, t, s in docs])
    second = lines_once(first)
    third = one_of_each_group(second)
    left = without_leaks(third, items)
    # each stage has work to do
    assert len(docs) > len(first) > len(third) > len(left) > 30 and [d[1] for d in second] != [d[1] for d in sorted(first)]
    tokenizer = Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    expected = {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t, _ in left}
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got.keys() == expected.keys() and got == expected
