import random

import pytest
from pyspark.sql import functions as F

from stratapoint.llm import ngram_join


def _sets(texts, n=5):
    sets = []
    for text in texts:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    return sets


def brute(rows, n=5, percent=75):
    sets = _sets([text for _, text in rows], n)
    parent = {i: i for i, _ in rows if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(rows[a][0]), root(rows[b][0])
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), root(i) if i is not None and s else i) for (i, _), s in zip(rows, sets, strict=True)), key=str)


def family(rng, base, edits):
    words = list(base)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed, size=160):
    rng = random.Random(seed)
    texts = []
    for _ in range(4):
        base = [f"b{rng.randrange(10**6)}" for _ in range(rng.randint(60, 90))]
        texts += [family(rng, base, rng.randint(0, 4)) for _ in range(size // 8)]
    shared = " ".join(f"s{k}" for k in range(40))
    texts += [shared + " " + " ".join(f"x{rng.randrange(10**6)}" for _ in range(rng.randint(0, 15))) for _ in range(size // 4)]
    texts += [" ".join(f"y{rng.randrange(10**6)}" for _ in range(rng.randint(0, 20))) for _ in range(size // 4)]
    texts += [None, "", " \n", "One two", "one TWO", "a b c d e", "A B C D E", "a b c d", "é É", texts[0], texts[0], texts[5].upper()]
    rng.shuffle(texts)
    return [(rng.randrange(10**9), t) for t in texts] + [(None, texts[0]), (None, "only null"), (None, None)]


@pytest.mark.parametrize("few,block,hubs", [(64, 1024, 4), (4, 16, 1)])
def test_same_components_as_all_pairs(spark, monkeypatch, few, block, hubs):
    monkeypatch.setattr(ngram_join, "FEW", few)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "HUBS", hubs)
    rows = corpus(few)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component_id int").repartition(5)
    got = ngram_join.near_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.near_duplicates(docs).count() == 0
    assert ngram_join.drop_near_duplicates(docs).count() == 0


def test_drop_keeps_the_smallest_id(spark):
    text = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(5, text, "a"), (3, text + " more", "b"), (9, "else", "c"), (None, text, "d")], "doc_id long, text string, source string")
    assert sorted(r.source for r in ngram_join.drop_near_duplicates(docs).collect()) == ["b", "c", "d"]


def test_rows_that_repeat_an_id(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FEW", 4)
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    monkeypatch.setattr(ngram_join, "HUBS", 1)
    rng = random.Random(8)
    rows = [(rng.randrange(60), t) for _, t in corpus(8)]
    node = {}  # a text belongs to its smallest id
    for i, t in rows:
        node[t or ""] = min(i, node.get(t or "", i))
    part = {(n, size): c for (n, size, c) in brute([(n, t) for t, n in node.items()])}
    sizes = {t: s for t, s in zip(node, (len(x) for x in _sets(node)), strict=True)}
    want = sorted((i, sizes[t or ""], part[(node[t or ""], sizes[t or ""])] if sizes[t or ""] else i) for i, t in rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("gone_id", F.lit("x")).repartition(5)
    assert sorted(tuple(r) for r in ngram_join.near_duplicates(docs).collect()) == want
    kept = sorted((r.doc_id, r.text or "") for r in ngram_join.drop_near_duplicates(docs).collect())
    stays = {(i, t or "") for i, t in rows if not sizes[t or ""] or part[(node[t or ""], sizes[t or ""])] == i}
    assert kept == sorted((i, t or "") for i, t in rows if (i, t or "") in stays)


def test_a_clean_text_under_a_repeated_id_stays(spark):
    text = " ".join(f"w{k}" for k in range(60))
    other = " ".join(f"v{k}" for k in range(60))
    docs = spark.createDataFrame([(3, text), (5, text), (5, other)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in ngram_join.drop_near_duplicates(docs).collect()) == [(3, text), (5, other)]
