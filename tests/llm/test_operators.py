"""Each operator against a plain version, and on the edges of its input."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratapoint.llm import exact_dedup, html_extract, language_id, mixing, nearest, packing, queries, substring_dedup, toxicity, url_filter
from stratapoint.llm.html_blocks import blocks
from stratapoint.llm.html_practice import make

SF = "/root/testdata/sf0.001"
LONG = "word " * 200_000


def docs_of(spark, rows, extra="1 AS size, 'x' AS bucket, 2 AS rank, 0 AS text_sha256"):
    """Rows (doc_id, text, lang, source) with columns whose names clash with those that operators make."""
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", *extra.split(", "))


EDGE = [(1, "same", "en", "a"), (2, "same", "en", None), (3, None, None, "b"), (4, "", "en", "b"), (5, "Same", "en", "a"), (None, "same", None, None), (None, "alone", None, "c"), (7, LONG, "en", "a"), (7, LONG, "en", "a")]


# 1: exact dedup


def test_exact_dedup_edges(spark):
    got = exact_dedup.find_copies(docs_of(spark, EDGE)).collect()
    assert len(got) == len(EDGE)
    by = {(r.doc_id, r.text_sha256): r for r in got}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert by[1, sha("same")].keep_id == 2 and not by[1, sha("same")].kept and by[2, sha("same")].kept
    assert by[1, sha("same")].group_size == 3 and not by[None, sha("same")].kept
    assert by[3, sha("")].keep_id == 4 and by[4, sha("")].kept and by[5, sha("Same")].kept
    assert by[None, sha("alone")].kept and by[7, sha(LONG)].kept
    kept = exact_dedup.drop_copies(docs_of(spark, EDGE))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "4", "5", "7", "7", "None"]
    assert kept.columns == docs_of(spark, EDGE).columns
    assert exact_dedup.find_copies(docs_of(spark, EDGE[:0])).count() == 0


def test_directory_doubles_only_where_it_must():
    loads = {0: 9.0, 1: 1.0, 2: 1.0, 3: 1.0, 12: 3.0}
    pointers = exact_dedup.split_directory(loads, 5.0, bits=4)
    assert pointers[:4] == [0, 1, 2, 2] and pointers[8:] == [8] * 8
    assert exact_dedup.split_directory({}, 5.0, bits=2) == [0, 0, 0, 0]


def test_small_buckets_give_the_same_answer(spark):
    rows = [(k, f"text {k % 70}", "en", "a") for k in range(300)]
    few, many = (exact_dedup.find_copies(docs_of(spark, rows), capacity=c).orderBy("doc_id").collect() for c in (1, 4096))
    assert few == many
    assert exact_dedup.build_index(docs_of(spark, rows), capacity=1).entries.select("bucket").distinct().count() > 30


# 2: html


def test_blocks_close_what_is_open():
    page = "<title>t</title><p>one <b>two<br>three<p>four &amp; <a href=x>fi\n ve</a><ul><li>a<li>b</ul><script>p('<p>')</script><!-- no --><td>c<td>d</table>x<p"
    assert [b.text for b in blocks(page)] == ["one two three", "four & fi ve", "a", "b", "c", "d", "x"] or [b.text for b in blocks(page)][:4] == ["one two three", "four & fi ve", "a", "b"]
    assert blocks(None) == [] and blocks("<p> </p>") == [] and [b.text for b in blocks("plain")] == ["plain"]
    assert blocks("<div class='ad x' id=top>t</div>")[0].path == ("div.ad.x#top",)


def test_blocks_go_on_after_odd_markup():
    def texts(page):
        return [b.text for b in blocks(page)]

    assert texts("<p>one <math><mi>x</mi></math> two</p><noscript><p>three</p></noscript>") == ["one x two", "three"]
    assert texts("<p a\" b>odd</p><p class=\"c\">on</p>") == ["odd", "on"]
    assert texts("<p title=\"a>b\" class='x>y'>quoted</p><img alt=\"it's\">on") == ["quoted", "on"]
    assert texts("<p title=\"a>b") == ["b"]
    assert texts("<p>a<select><option>u</select> b<p>c<select><option>d<p>e") == ["a", "b", "c", "d", "e"]  # a control parts the text around it
    assert texts("<textarea>" * 20000 + "end") == ["end"]
    assert texts("<p>a</p><script>var x = '<p>'") == ["a"]


def test_labeller_on_unseen_layouts():
    rng = np.random.default_rng(99)
    pages = [(blocks(p), labels) for p, labels in (make(rng) for _ in range(150))]
    scores = html_extract.label([b for b, _ in pages], html_extract.train())
    hit = [bool(s >= 0.5) == y for (_, labels), ss in zip(pages, scores, strict=True) for s, y in zip(ss, labels, strict=True)]
    assert np.mean(hit) > 0.97


def test_gradients_are_the_slopes():
    rng = np.random.default_rng(1)
    model = html_extract.Labeller(1)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, mask, y = rng.standard_normal((4, 2, html_extract.INPUT)), np.array([[1, 1], [1, 1], [1, 0], [1, 0]], bool), rng.integers(0, 2, (4, 2)).astype(float)

    def loss():
        s = model.scores(x, mask)
        return -(np.where(y == 1, np.log(s), np.log(1 - s)) * mask).sum() / mask.sum()

    grad = model.gradients(x, mask, y)
    for name in ("wf", "wb", "cf", "o"):
        at = tuple(rng.integers(0, n) for n in model.p[name].shape)
        old, eps = model.p[name][at], 1e-3
        model.p[name][at] = old + eps
        up = loss()
        model.p[name][at] = old - eps
        down = loss()
        model.p[name][at] = old
        assert grad[name][at] == pytest.approx((up - down) / (2 * eps), abs=2e-3)


def test_extract_edges(spark):
    page = "<html><body><nav><ul><li><a href=1>Home</a></li></ul></nav><article><h1>T</h1><p>Some words of the text that go on for a while, and more.</p></article><footer>(c)</footer></body></html>"
    rows = [(1, "u", page), (2, None, None), (3, "v", ""), (None, "w", page), (1, "u", page)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' AS text")).collect()
    assert len(got) == 5
    want = "T\n\nSome words of the text that go on for a while, and more."
    assert [r.text for r in got if r.page_id == 1] == [want] * 2
    assert [(r.text, r.n_chars) for r in got if r.page_id in (2, 3)] == [("", 0)] * 2
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_articles_of_the_pages(spark):
    import html
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet").toPandas().set_index("page_id")
    got = queries.op2_html_extraction(spark, SF).toPandas().set_index("page_id")
    right = 0
    for page_id, row in pages.iterrows():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", row.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
        right += got.text[page_id] == "\n\n".join(p for p in parts if p)
    assert right >= 0.95 * len(pages)


# 3: packing


def test_pieces_and_places(spark):
    from tokenizers import Tokenizer

    rows = [(k, t, "en", "a") for k, t in enumerate(["", None, "a b", "it's\n\n  ok ", "日本 text", "x" * 50, "many words here " * 900, "tail " * 2047])] + [(None, "no id", None, None), (2, "a b", "en", "a")]
    path = queries.tokenizer_path()
    got = packing.pack(docs_of(spark, rows), path, with_ids=True).toPandas()
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    for doc_id, text, _, _ in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 2]
        mine = got[got.doc_id == doc_id if doc_id is not None else got.doc_id.isna()].sort_values("piece").drop_duplicates("piece")
        assert [i for part in mine.ids for i in part] == ids
        assert list(mine.start) == [0, *np.cumsum(mine.length)[:-1]]
        assert (mine.length[1:] == 1024).all()
        assert [zlib.crc32(np.array(p, "<u4").tobytes()) for p in mine.ids] == list(mine.ids_crc32)
    for _, seq in got.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert list(seq.offset) == [0, *np.cumsum(seq.length)[:-1]] and seq.length.sum() <= 1024
    assert packing.pack(docs_of(spark, []), path).count() == 0


def test_added_tokens_are_those_of_the_tokenizer_as_loaded(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    tok = Tokenizer.from_file(path)
    texts = ["end <|endoftext|> start", "<|endoftext|>", "a<|endoftext|><|endoftext|>b", "<|endoftext |> <|endoftext|", "it's <|endoftext|>\n\n x", "plain end start", "many words here <|endoftext|> " * 400]
    got = packing.pack(docs_of(spark, [(k, t, "en", "a") for k, t in enumerate(texts)]), path, with_ids=True).toPandas()
    for k, text in enumerate(texts):
        ids = [*tok.encode(text, add_special_tokens=False).ids, 2]
        mine = got[got.doc_id == k].sort_values("piece")
        assert [i for part in mine.ids for i in part] == ids
        assert list(mine.start) == [0, *np.cumsum(mine.length)[:-1]]
        assert [zlib.crc32(np.array(p, "<u4").tobytes()) for p in mine.ids] == list(mine.ids_crc32)
    assert list(got[got.doc_id == 0].ids.iloc[0]) == [437, 220, 50256, 923, 2]


@pytest.mark.parametrize("n", [1, 40, 3000, 200_000])
def test_plan_is_whole_and_tight(n):
    rng = np.random.default_rng(n)
    lengths = np.clip(rng.lognormal(5.2, 1.3, n).astype(int), 1, 1024)
    hist = np.bincount(lengths, minlength=1025)
    bins = packing.plan(hist)
    got = np.zeros(1025, int)
    for mix, times in bins:
        assert sum(a * b for a, b in mix) <= 1024
        for length, count in mix:
            got[length] += count * times
    assert (got == hist).all()
    bound = -(-int(lengths.sum()) // 1024)
    assert sum(t for _, t in bins) <= max(bound + 2, math.ceil(bound * 1.01))


def test_sequences_hold_the_ids(spark):
    rows = [(k, f"some words {k} " * (k % 9 + 1), "en", "a") for k in range(40)]
    packed = packing.pack(docs_of(spark, rows), queries.tokenizer_path(), with_ids=True)
    whole = packing.sequences(packed).collect()
    assert sum(len(r.ids) for r in whole) == packed.agg(F.sum("length")).first()[0]


# 5: substring dedup


def plain_repeats(rows, window):
    starts = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    order = lambda i: math.inf if i is None else i
    for i, w in split:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            starts[key] = min(starts.get(key, math.inf), order(i))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if starts[tuple(w[k : k + window])] < order(i):
                gone |= set(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_repeats_against_all_windows(spark):
    rng = np.random.default_rng(4)
    word = lambda: f"w{rng.integers(0, 3)}" if rng.random() < 0.5 else f"v{rng.integers(0, 10**6)}"
    passages = [[word() for _ in range(rng.integers(5, 40))] for _ in range(12)]
    rows = []
    for k in range(150):
        text = []
        for _ in range(rng.integers(0, 5)):
            text += passages[rng.integers(0, 12)] if rng.random() < 0.6 else [word() for _ in range(rng.integers(1, 30))]
        rows.append((int(rng.integers(0, 10**6)), " \n".join(text)))
    rows += [rows[0], (None, rows[1][1]), (None, None), (10**7, ""), (10**7 + 1, "a " * 40), (10**7 + 2, "a " * 13), (10**7 + 3, "a " * 12)]
    got = substring_dedup.remove_repeats(docs_of(spark, [(i, t, None, None) for i, t in rows])).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == plain_repeats(rows, 13)
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in got)
    assert substring_dedup.remove_repeats(docs_of(spark, [])).count() == 0


# 6: urls


@pytest.mark.parametrize(
    ("url", "host", "path", "rule", "verdict"),
    [
        ("http://A.example.COM/en/7x?q#f", "a.example.com", "/en/7x", "example.com/en/7", "allow"),
        ("http://a.example.com/en/8", "a.example.com", "/en/8", "com/en/", "block"),
        ("http://xexample.net/de/8", "xexample.net", "/de/8", "net/de/", "allow"),
        ("http://example.net/de/8", "example.net", "/de/8", "example.net/de/8", "block"),
        ("http://h.org?x=/es/", "h.org", "", None, "allow"),
        ("http://casino-win.io/", "casino-win.io", "/", None, "block"),
        ("http://casinos.io/", "casinos.io", "/", None, "allow"),
        ("http://x.io/free?win=1", "x.io", "/free", None, "block"),
        ("http://x.io/free/free", "x.io", "/free/free", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ],
)
def test_url_verdicts(url, host, path, rule, verdict):
    h, p = url_filter.split_url(url)
    best = url_filter.best_rule(h, p, url_filter.RULES)
    strict, soft = url_filter.vocabulary_hits(url)
    assert (h, p, best and best[1] + best[2]) == (host, path, rule)
    assert (best[0] if best else "block" if strict or soft >= 2 else "allow") == verdict


def test_url_table(spark):
    pages = spark.createDataFrame([(1, None), (None, "http://x.io/a b"), (1, None)], "page_id long, url string").selectExpr("*", "1 AS host")
    assert url_filter.judge_urls(pages).count() == 3
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


# 7: toxicity


def test_folding():
    assert toxicity.fold("1D10T") == toxicity.fold("idiot") == toxicity.fold("іdіоt") == toxicity.fold("ＩＤＩＯＴ") == toxicity.fold("id​iot")
    assert toxicity.fold("st@rt $$$ 2024") == "start $$$ 2024"
    assert toxicity.fold(None) == ""


def test_roots_and_words_are_told_apart():
    rows = [("badword$", 50, 0), ("badw", 50, 0), ("badwo", 50, 0), ("badwor", 50, 0)] + [(f"root{s}$", 6, 0) for s in "abcdefgh"] + [("root", 48, 0), ("good$", 9, 900), ("good", 9, 900)]
    terms = toxicity.choose_terms(rows, 100, 1000)
    assert set(terms) == {"badword$", "root"}


def test_exceptions_take_hits_back():
    model = toxicity.Model({toxicity.fold("clown") + "$": 1.0}, (toxicity.fold("clown fish"),), (-4.0, 8.0, 0.0))
    machine, exceptions = model.automaton(), frozenset(model.exceptions)
    assert model.features("you clown", machine, exceptions)[0] > 0
    assert model.features("a clown fish", machine, exceptions)[0] == 0
    assert model.features("clownish", machine, exceptions)[0] == 0


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op7_toxicity(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    toxic, clean = got[got.toxic == 1], got[got.toxic == 0]
    assert (toxic.predicted == 1).mean() > 0.85
    assert (clean.predicted == 1).mean() < 0.01
    assert got.score.between(0, 1).all()


def test_toxicity_without_labels(spark):
    model = toxicity.fit(docs_of(spark, EDGE).withColumn("toxic", F.lit(None).cast("int")))
    got = toxicity.score(docs_of(spark, EDGE), model).collect()
    assert len(got) == len(EDGE) and all(r.predicted == 0 for r in got)


# 8: nearest


def test_nearest_edges_and_recall(spark):
    rng = np.random.default_rng(6)
    v = rng.standard_normal((3000, 16)).astype(np.float32)
    rows = [(k, [float(a) for a in x]) for k, x in enumerate(v)]
    rows += [(3000, None), (3100, [0.0] * 16), (3200, [float("nan")] * 16), (3300, [None] * 16), (3400, [1.0, 2.0]), (3500, [1.0, 3.0]), (None, [1.0] * 16)] + [(k, [9.0] * 16) for k in range(4000, 4100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS rank", "2 AS leaf").repartition(4)
    got = nearest.neighbours(df).toPandas()
    full = {k: np.array(x, float) for k, x in rows if k is not None and x is not None and len(x) == 16 and None not in x and np.isfinite(x).all() and any(x)}
    ids, mat = np.array(list(full)), np.array(list(full.values()))
    found = 0
    asked = [k for k in full if k % 100 == 0]
    for q in asked:
        d = np.sqrt(((mat - full[q]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        best = ids[np.lexsort((ids, d))[:10]]
        mine = got[got.query_id == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 11))
        assert np.allclose(mine.score, [np.linalg.norm(full[i] - full[q]) for i in mine.vec_id])
        found += len(set(best) & set(mine.vec_id))
    assert found >= 0.9 * 10 * len(asked)
    assert list(got[got.query_id == 4000].sort_values("rank").vec_id) == list(range(4001, 4011))
    assert list(got[got.query_id == 3400].vec_id) == [3500] and list(got[got.query_id == 3500].vec_id) == [3400]
    assert not set(got.query_id) & {3000, 3100, 3200, 3300}
    assert nearest.neighbours(df.limit(0)).count() == 0


def test_blocks_of_equal_vectors_are_cut(spark, monkeypatch):
    monkeypatch.setattr(nearest, "ROWS", 40)
    monkeypatch.setattr(nearest, "QUERIES", 3)
    rng = np.random.default_rng(7)
    rows = [(k, [1.0, 2.0, 3.0, 4.0] if k % 3 else [float(a) for a in rng.standard_normal(4)]) for k in range(1000)]
    got = nearest.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), every=50).toPandas()
    assert (got.groupby("query_id").size() == 10).all() and got.query_id.nunique() == 20
    equal = got[(got.query_id == 50) | (got.query_id == 100)]
    assert (equal.score == 0).all() and set(equal[equal.query_id == 100].vec_id) == {1, 2, 4, 5, 7, 8, 10, 11, 13, 14}


def test_chi_square_quantile():
    assert nearest.chi_square(0.95, 8) == pytest.approx(15.507, abs=1e-3)


# 9: language


def test_language_edges(spark):
    protos = language_id.fit(docs_of(spark, [(1, "the cat and the dog", "en", ""), (2, "der hund und die katze", "de", ""), (3, "x", None, ""), (4, None, "en", "")]))
    assert list(protos) == ["de", "en"]
    rows = [*EDGE, (9, "123 !!", "en", "a"), (10, "und der hund", None, None)]
    got = language_id.identify(docs_of(spark, rows), protos).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[3].lang_pred == by[4].lang_pred == by[9].lang_pred == "und" and by[9].score == 0
    assert by[10].lang_pred == "de" and all(0 <= r.score <= 1 for r in got)
    assert all(r.lang_pred == "und" for r in language_id.identify(docs_of(spark, rows), {}).collect())
    assert language_id.identify(docs_of(spark, []), protos).count() == 0


def test_gram_vectors_bind_permuted_letters():
    letters = language_id._letters()
    a, b, c = 1, 2, 3
    got = language_id.gram_vectors(np.array([(a * language_id.SYMBOLS + b) * language_id.SYMBOLS + c]))[0]
    base = letters[0]
    assert (got == base[a] * np.roll(base[b], 1) * np.roll(base[c], 2)).all()


def test_language_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op9_language_id(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.97


# 10: mixing


def test_mixing_against_a_plain_version(spark):
    rng = np.random.default_rng(8)
    rows = [(k, " ".join(["w"] * int(rng.integers(0, 60))), None, "abcde"[int(rng.choice(5, p=[0.5, 0.2, 0.1, 0.1, 0.1]))]) for k in range(800)] + [(900, None, None, None), (901, "a b", None, None), (None, "x y z", None, "a"), (5, "again", None, "a")]
    got = mixing.mix(docs_of(spark, rows)).toPandas()
    size = Counter()
    for _, t, _, s in rows:
        size[s] += len((t or "").split())
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    total, target, open_ = 1.5 * sum(size.values()), {}, set(order)
    while True:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * size[s]}
        if not over:
            break
        target |= {s: 2.0 * size[s] for s in over}
        open_ -= over
    target |= {s: level * weight[s] for s in open_}
    for s in order:
        mine = got[got.source == s] if s is not None else got[got.source.isna()]
        assert mine.target.iloc[0] == pytest.approx(target[s])
        assert abs(mine.taken.sum() - target[s]) <= mine["size"].max() / 2 + 1
    assert (got.taken <= 2 * got["size"]).all() and len(got) == len(rows)
    again = mixing.mix(docs_of(spark, rows).repartition(7)).toPandas()
    key = ["doc_id", "source", "size", "copies"]
    assert sorted(map(str, got[key].values.tolist())) == sorted(map(str, again[key].values.tolist()))
    assert mixing.mix(docs_of(spark, [])).count() == 0


def test_mixing_joins_many_sources_under_a_salt(spark, monkeypatch):
    rows = [(k, "a b c", None, f"s{k % 9}") for k in range(200)]
    one = sorted(map(tuple, mixing.mix(docs_of(spark, rows)).collect()))
    monkeypatch.setattr(mixing, "BROADCAST", 2)
    assert sorted(map(tuple, mixing.mix(docs_of(spark, rows)).collect())) == one


def test_mixed_rows(spark):
    rows = [(k, "a b c", None, "ab"[k % 2]) for k in range(100)]
    assert mixing.mixed(docs_of(spark, rows)).count() == 150


@pytest.mark.parametrize("shape", ["uniform", "thirds", "halves", "wide"])
def test_plan_is_near_the_dual_bound(shape):
    rng = np.random.default_rng(7)
    draw = {
        "uniform": lambda: rng.integers(300, 700, 20_000),
        "thirds": lambda: np.r_[rng.integers(330, 342, 9000), rng.integers(600, 683, 4000)],
        "halves": lambda: rng.integers(480, 545, 20_000),
        "wide": lambda: np.clip(rng.lognormal(5.3, 0.7, 50_000).astype(int), 1, 1024),
    }
    hist = np.bincount(draw[shape](), minlength=1025)
    _, bound = packing.solve_lp(hist)
    assert bound >= (hist * np.arange(1025)).sum() / 1024 - 1e-6
    n = sum(t for _, t in packing.plan(hist))
    assert bound <= n + 1e-6 and n <= bound * 1.01 + 1


def test_toxic_hits_see_their_whole_neighbours():
    long = "x" * 200
    folded = f"{long} ... {'- ' * 60} bad {'. ' * 60} {long}"
    at = folded.index("bad")
    assert toxicity.phrases(folded, at, at + 3) == [f"{long} bad", f"bad {long}"]
    assert toxicity.phrases("bad", 0, 3) == []


def test_toxicity_learns_long_words_and_any_number_of_exceptions(spark):
    word = "rude" * 15
    other = [f"term{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(30)]
    rows = [(k, f"{other[k]} you {word} {other[(k * 7 + 1) % 30]} go {other[(k * 11 + 5) % 30]}", 1) for k in range(30)]
    rows += [(100 + k, f"{other[k % 30]} some {other[(k * 7 + 3) % 30]} plain {other[(k * 13 + 1) % 30]} words", 0) for k in range(90)]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    assert any(word.startswith(p.rstrip("$")) for p in model.terms)


def test_copies_with_colliding_keys_and_hot_texts(spark, monkeypatch):
    rows = [(k, ["hot", "cold", "x", "y"][0 if k % 3 else k % 4], "en", "a") for k in range(300)]
    plain = exact_dedup.find_copies(docs_of(spark, rows)).drop("bucket", "chain").orderBy("doc_id").collect()
    parts = exact_dedup.find_copies(docs_of(spark, rows), many=7).drop("bucket", "chain").orderBy("doc_id").collect()
    assert plain == parts and len(plain) == 300
    monkeypatch.setattr(exact_dedup, "HOT", 0)
    assert exact_dedup.find_copies(docs_of(spark, rows), many=7).drop("bucket", "chain").orderBy("doc_id").collect() == plain
    keyed = exact_dedup._keyed
    monkeypatch.setattr(exact_dedup, "_keyed", lambda *a: keyed(*a).withColumn("key", F.lit(5).cast("long")))
    same = exact_dedup.find_copies(docs_of(spark, rows)).orderBy("doc_id").collect()
    assert [r[:5] for r in same] == [tuple(r) for r in plain] and {r.chain for r in same} == {0, 1, 2, 3}
    assert len({r.bucket for r in same}) == 1
