"""The pipeline against a plain version of its stages on a small table."""

import hashlib
import math

import numpy as np

import corpus_pipeline
from stratapoint.llm import language_id, mixing
from stratapoint.llm.queries import tokenizer_path

from .test_ngram_join import brute, corpus


def plain(rows):
    """(doc_id, text, lang, source) rows that are left for packing, as often as the mix takes them."""
    texts = [t for _, t, lang, _ in rows if t is not None and lang is not None]
    langs = [lang for _, t, lang, _ in rows if t is not None and lang is not None]
    vectors = {}
    for t, lang in zip(texts, langs, strict=True):
        code, _ = language_id._codes([t])
        vectors[lang] = vectors.get(lang, 0) + language_id.gram_vectors(code).sum(axis=0).astype(float)
    matrix = np.array([vectors[k] / max(np.linalg.norm(vectors[k]), 1e-12) for k in sorted(vectors)], np.float32)
    left = []
    for r in rows:
        cos, has = language_id.cosines([r[1] or ""], matrix)
        if has[0] and cos.max() > 0:
            left.append(r)
    last = {}
    for r in left:
        last[r[1]] = max(last.get(r[1], -1), r[0])
    left = [r for r in left if last[r[1]] == r[0]]
    component = {i: c for i, _, c in brute([(r[0], r[1]) for r in left])}
    left = [r for r in left if component[r[0]] == r[0]]
    size = {r[0]: len((r[1] or "").encode().split()) for r in left}
    total = {}
    for r in left:
        total[r[3]] = total.get(r[3], 0) + size[r[0]]
    order = sorted(s for s in total if s is not None) + [s for s in total if s is None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, free, want = {}, set(order), 1.5 * sum(total.values())
    while True:
        level = (want - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * total[s]}
        if not over:
            break
        target |= {s: 2.0 * total[s] for s in over}
        free -= over
    target |= {s: level * weight[s] for s in free}
    out = []
    for s in order:
        ratio = target[s] / total[s] if total[s] else 0.0
        whole = math.floor(ratio)
        p = ratio - whole
        ranked = []
        for r in (r for r in left if r[3] == s):
            u = (int(hashlib.md5(f"mix{r[0]}".encode()).hexdigest()[:12], 16) + 0.5) / 16**12
            ranked.append(((u / (1 - u)) / (p / (1 - p)) if p else math.inf, r))
        run = 0
        for rank, r in sorted(ranked, key=lambda a: (a[0], a[1][0])):
            run += size[r[0]]
            extra = int(p > 0 and run - size[r[0]] / 2 <= target[s] - whole * total[s])
            out += [r] * (whole + extra)
    return out


def rows_of(seed):
    rng = np.random.default_rng(seed)
    rows = {i: t for i, t in corpus(seed, 80) if i is not None}
    return [(i, t, ["en", "de", None][int(rng.integers(0, 3))], [None, "a", "b", "c", "d"][int(rng.integers(0, 5))]) for i, t in rows.items()] + [(10**9 + 1, "123 456 !!", "en", "a")]


def test_same_documents_as_the_plain_version(spark, tmp_path):
    from tokenizers import Tokenizer

    rows = rows_of(12)
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars int")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    tok = Tokenizer.from_file(tokenizer_path())
    want = []
    for r in plain(rows):
        n = len(tok.encode(r[1], add_special_tokens=False).ids) + 1
        first = (n - 1) % 1024 + 1
        want += [(r[0], 0, first)] + [(r[0], k + 1, 1024) for k in range((n - first) // 1024)]
    assert sorted(zip(got.doc_id, got.piece, got.length, strict=True)) == sorted(want)
    for _, seq in got.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert list(seq.offset) == [0, *np.cumsum(seq.length)[:-1]] and seq.length.sum() <= 1024


def test_stages_keep_columns_and_take_edges(spark):
    columns = "doc_id long, text string, lang string, source string, n_chars int"
    odd = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "some words", "en", "a", 1), (3, "some words", "en", "a", 1), (None, "other words here", "en", None, 2)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, columns)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "")
            docs.collect()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_jaccard_join", "mixing", "best_fit_packing"]
    assert mixing.MOST == 2.0


CLASHING = ["score", "lang_pred", "kept", "held_out", "id", "tie", "plan_id", "plan_tie", "copies", "copy", "key", "bucket", "chain", "text_sha256", "keep_id", "group_size", "_keep_id", "_sha", "_id", "_tie", "_copies", "_copy", "_text", "_at",
            "component_id", "n_shingles", "digest", "size", "rep", "a.b", "at", "label", "piece", "length", "rank", "own", "base", "sequence_id"]


def test_stages_bear_columns_of_any_name(spark):
    rows = [(k, f"some words of text number {k % 3} that are long enough to be known", "en", "a", 1, *([k] * len(CLASHING))) for k in range(6)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", "n_chars", *CLASHING])
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, "")
        assert got.count() > 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert got.columns == docs.columns
            assert all(r[5] == r[0] for r in got.collect())
            docs = got
