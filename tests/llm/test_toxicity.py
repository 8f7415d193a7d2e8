import random
import re
from zlib import crc32

import numpy as np

from llm_helpers import SF, docs_frame, vocabulary
from weeklens.llm import toxicity
from weeklens.llm.queries import QUERIES


def brute_nearest(index, counts, k):
    """Cosines with every example, from dense vectors."""
    dense = np.zeros((len(index.ids), len(index.terms)))
    blocks = index.most.shape[1]
    for t in range(len(index.terms)):
        for b in range(blocks):
            at = slice(index.starts[t * blocks + b], index.starts[t * blocks + b + 1])
            dense[index.example[at], t] = index.weight[at]
    assert np.allclose((dense**2).sum(1), 1)
    q = np.zeros(len(index.terms))
    t, w = toxicity._vector(counts, index.idf)
    q[t] = w
    cos = dense @ q
    order = sorted((-round(float(c), 9), int(index.ids[p]), p) for p, c in enumerate(cos) if c > 1e-12)
    return [(-c, p) for c, _, p in order[:k]]


def corpus(n=240):
    rnd, words = random.Random(3), vocabulary(9, 120)
    bad = ["meanword", "nastything", "vileness", "grossstuff"]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        text = rnd.choices(words, k=rnd.randint(15, 60))
        if toxic:
            text[3:3] = rnd.choices(bad, k=4)
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def labels_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_neighbours_are_exact(spark):
    rows, labels = corpus()
    index = toxicity.fit(docs_frame(spark, rows), labels_frame(spark, labels), block=8).index
    assert len(index.ids) > 60 and index.most.shape[1] > 5
    counts = toxicity.Counts(index.terms)
    for _, text in rows[:80]:
        found = counts.of(text)[0]
        assert toxicity.nearest(index, found, 7) == brute_nearest(index, found, 7)


def test_held_out_accuracy_and_edge_rows(spark):
    rows, labels = corpus()
    told = labels_frame(spark, labels + [(None, 1, 1), (3, 1, None), (99999, 1, 1), (4, 1, 0)])
    df = docs_frame(spark, [*rows, (900, None), (901, ""), (None, "meanword nastything vileness"), (902, "x " * 100_000),
                            (903, "Meanword! NASTYTHING, vileness."), (903, "Meanword! NASTYTHING, vileness.")], extra=True)
    index = toxicity.fit(df, toxicity.training_fold(told))
    out = toxicity.score(df, index, keep=("score", "t")).collect()
    names = out[0].asDict(recursive=True)
    assert len(out) == len(rows) + 6 and names["t"] == "x"
    by = {}
    for r in out:
        by.setdefault(r[0], []).append(r[-2])
    truth = {i: t for i, _, t in labels}
    held = [i for i in truth if crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 20 and all((by[i][0] >= 0.5) == bool(truth[i]) for i in held)
    assert by[900] == by[901] and by[902][0] < 0.5 and min(by[903]) >= 0.5 and by[None][0] >= 0.5
    assert all(0 <= r[-2] <= 1 for r in out)


def test_nothing_to_learn_from(spark):
    df = docs_frame(spark, [(1, "a b"), (2, None)])
    index = toxicity.fit(df, labels_frame(spark, []))
    assert [r["score"] for r in toxicity.score(df, index).collect()] == [0.5, 0.5]
    assert toxicity.score(docs_frame(spark, []), index).collect() == []


def test_held_out_accuracy_on_the_tables(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    got = {r["doc_id"]: r for r in QUERIES["op4_toxicity"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert len(got) == docs.count()
    held = [(got[r["doc_id"]]["score"], r["toxic"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()
            if got[r["doc_id"]]["held_out"]]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
    assert auc > 0.8 and sum(s >= 0.5 for s in neg) <= 0.03 * len(neg)


def test_every_example_is_indexed_on_all_its_terms(spark):
    """Labels too few for any statistic: each example still stands in the index, and held-out texts have neighbours."""
    rows = [(i, t) for i, t in enumerate(["one lonely sentence", "vile nastything here", "plain words only", "grossstuff and more", ""])]
    index = toxicity.fit(docs_frame(spark, rows), labels_frame(spark, [(i, 1, int(i in (1, 3))) for i in range(5)])).index
    assert sorted(index.ids.tolist()) == list(range(5))
    words = {t for _, text in rows for w in text.split() for t in toxicity.word_terms(w)}
    assert set(index.terms) == words and len(index.example) == sum(
        len({t for w in text.split() for t in toxicity.word_terms(w)}) for _, text in rows)
    near = toxicity.nearest(index, toxicity.Counts(index.terms).of("a nastything")[0], 3)
    assert [int(index.ids[p]) for _, p in near] == [1]
    sf_index = toxicity.fit(*(spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))).index
    assert len(sf_index.ids) == spark.read.parquet(f"{SF}/labels.parquet").count() and len(sf_index.terms) > 1000


def test_neighbours_are_exact_over_the_whole_vocabulary(spark):
    rows, labels = corpus()
    rows = [(i, f"{text} {' '.join(vocabulary(i, 5))}") for i, text in rows]
    index = toxicity.fit(docs_frame(spark, rows), labels_frame(spark, labels), block=16).index
    assert len(index.ids) == len(rows) and 0 < index.common.shape[1] < len(index.terms)
    counts = toxicity.Counts(index.terms)
    texts = [counts.of(text)[0] for _, text in rows[::15]]
    assert toxicity.nearest_of_each(index, texts, 7) == [brute_nearest(index, c, 7) for c in texts]


def test_labels_of_one_class_and_wordless_texts(spark):
    rows = [(i, t) for i, t in enumerate(["plain words", "", None, "123 456", "more plain words here"])] + [(9, "plain")]
    for y in (0, 1):
        model = toxicity.fit(docs_frame(spark, rows), labels_frame(spark, [(i, 1, y) for i in range(5)]))
        out = {r["doc_id"]: r for r in toxicity.score(docs_frame(spark, rows), model).collect()}
        assert len(out) == 6 and all((r["score"] >= 0.5) == bool(y) for r in out.values())
        assert out[1]["evidence"] == out[3]["evidence"] == [] and len(out[9]["evidence"]) == 2


def test_idf_counts_every_document(spark):
    rows = [(0, "rare word"), (1, "word"), *((i, "word plenty") for i in range(2, 12)), (20, None)]
    index = toxicity.fit(docs_frame(spark, rows), labels_frame(spark, [(0, 1, 1), (1, 1, 0)])).index
    assert np.allclose(index.idf[[index.terms["rare"], index.terms["word"]]], np.log([1 + 13 / 1, 1 + 13 / 12]))


def test_score_is_the_calibrated_vote_of_brute_force_neighbours(spark):
    """Vectors, cosines, votes and curve values from the texts alone, without the index."""
    rows, labels = corpus(120)
    df, told = docs_frame(spark, rows), [x for x in labels if crc32(str(x[0]).encode()) % 5]
    model = toxicity.fit(df, labels_frame(spark, told))
    terms = {i: [t for w in re.findall(r"[^\W\d_]+", text.lower()) for t in (w, *(w[:n] + "*" for n in (4, 5, 6, 7) if len(w) > n))]
             for i, text in rows}
    held = {}
    for found in terms.values():
        for t in set(found):
            held[t] = held.get(t, 0) + 1
    known = {t for i, *_ in told for t in terms[i]}
    vectors = {}
    for i, found in terms.items():
        v = {t: (1 + np.log(found.count(t))) * np.log(1 + len(rows) / held[t]) for t in set(found) & known}
        norm = np.sqrt(sum(x * x for x in v.values()))
        vectors[i] = {t: x / norm for t, x in v.items()}
    truth = {i: y for i, _, y in told}
    odds = sum(y == 0 for y in truth.values()) / sum(truth.values())
    for r in toxicity.score(df, model).collect():
        q = vectors[r["doc_id"]]
        near = sorted((-sum(x * vectors[i].get(t, 0) for t, x in q.items()), i) for i in truth)[: toxicity.NEIGHBOURS]
        near = [(-c, i) for c, i in near if c < 0]
        bad, all_ = sum(c for c, i in near if truth[i]), sum(c for c, _ in near)
        little = 0.02 * near[0][0]
        vote = np.log((bad * odds + little) / (all_ - bad + little))
        z = np.dot(model.curve, (1, vote, near[0][0], vote * near[0][0]))
        assert abs(r["score"] - 1 / (1 + np.exp(-z))) < 1e-4


def test_terms_of_parts_equal_terms_of_words(monkeypatch):
    """Parts between blanks, stops and commas are looked up whole and forgotten now and then; counts are those of the words."""
    rnd, words = random.Random(5), vocabulary(3, 300)
    odd = ["ab_cd", "x1y2z", "don't", "ÉTÉ", "İstanbul", "中文字符", "²³", "a" * 200, "one.two,three", "tab\there", "\x1cend", "_", "7"]
    texts = [" ".join(rnd.choices(words + odd, k=rnd.randint(0, 80))) for _ in range(200)] + [None, "", " . , "]
    terms = {t: i for i, t in enumerate(sorted({t for w in words[::2] + ["été", "中文字符", "two"] for t in toxicity.word_terms(w)}))}
    monkeypatch.setattr(toxicity, "REMEMBERED", 150)
    counts = toxicity.Counts(terms)
    for text in texts:
        want = {}
        for word in toxicity.TERM.findall((text or "").lower()):
            for t in toxicity.word_terms(word):
                if t in terms:
                    want[terms[t]] = want.get(terms[t], 0) + 1
        term, n = counts.of(text)[0]
        assert list(zip(term.tolist(), n.tolist(), strict=True)) == sorted(want.items())
        assert counts.known(text).tolist() == sorted(want)
        assert len(counts) <= 150 + 2 * 93 and all(len(x) <= toxicity.SHORT for x in counts)


def test_workers_multiply_with_one_thread(spark):
    import os

    toxicity.fit(docs_frame(spark, [(1, "plain words")]), labels_frame(spark, [(1, 1, 0)]))
    seen = spark.range(4, numPartitions=2).mapInPandas(
        lambda parts: (p.assign(t=os.environ.get("OPENBLAS_NUM_THREADS")) for p in parts), "id long, t string").collect()
    assert {r.t for r in seen} == {"1"}


def test_terms_of_many_texts_at_once_equal_terms_of_words(monkeypatch):
    """Corpus passes tell the words of many texts apart together; no dictionary of terms is kept in a worker."""
    import pyarrow as pa

    rnd, words = random.Random(6), vocabulary(3, 300)
    odd = ["ab_cd", "x1y2z", "don't", "ÉTÉ", "İstanbul", "ΣΟΦΟΣ", "中文字符", "²³", "a" * 200, "one.two,three", "tab\there", "\x1cend",
           "wide　blank", "_", "7"]
    texts = [" ".join(rnd.choices(words + odd, k=rnd.randint(0, 80))) for _ in range(200)] + [None, "", " . , ", "end "]
    names = sorted({t for w in words[::2] + ["été", "中文字符", "two", "σοφος"] for t in toxicity.word_terms(w)})
    number = {t: i for i, t in enumerate(names)}
    monkeypatch.setattr(toxicity, "LOOKED_UP", 900)
    groups = list(toxicity._groups(pa.array(texts, pa.string())))
    assert len(groups) > 5 and [t for g in groups for t in g] == texts
    found = [c for g in groups for c in toxicity.counts_of_each(g, toxicity.vocabulary("\n".join(names)))]
    for text, (term, n) in zip(texts, found, strict=True):
        want = {}
        for word in toxicity.TERM.findall((text or "").lower()):
            for t in toxicity.word_terms(word):
                if t in number:
                    want[number[t]] = want.get(number[t], 0) + 1
        assert list(zip(term.tolist(), n.tolist(), strict=True)) == sorted(want.items())
    assert [len(t) for t, _ in toxicity.counts_of_each(["a b", None], toxicity.vocabulary(""))] == [0, 0]
    assert list(toxicity._groups(pa.array([], pa.string()))) == []


def test_index_is_built_in_place():
    """A worker takes little more memory for the index than the index has: no lists of examples, sorts or dictionaries."""
    import tracemalloc

    rnd = np.random.default_rng(4)
    n, held, width = 512, 400, 20_000
    term = np.concatenate([np.sort(rnd.choice(width, held, replace=False)) for _ in range(n)]).astype(np.int32)
    tf = rnd.integers(1, 4, len(term)).astype(np.uint16)
    examples = toxicity.Examples("\n".join(f"w{i}" for i in range(width)), np.log(1 + rnd.integers(2, 90, width)), np.arange(n),
                                 np.arange(n) % 2, np.arange(n) * 7, np.full(n, held), term, tf, 64)
    tracemalloc.start()
    index = examples.index()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 * len(term) + 64 * index.most.size
    blocks = index.most.shape[1]
    assert blocks == 8 and len(index.posting) == len(term) and sorted(index.ids.tolist()) == list(range(n))
    for t in range(0, width, 997):
        for b in range(blocks):
            at = slice(index.starts[t * blocks + b], index.starts[t * blocks + b + 1])
            places, weights = index.example[at], index.weight[at]
            assert (np.diff(places) > 0).all() and (places // 64 == b).all()
            assert index.most[t, b] == weights.max(initial=0)
            for p, w in zip(places.tolist(), weights.tolist(), strict=True):
                own = slice(index.ids[p] * held, (index.ids[p] + 1) * held)
                every = (1 + np.log(tf[own])) * index.idf[term[own]]
                assert np.isclose(w, every[term[own] == t][0] / np.sqrt((every**2).sum()))
