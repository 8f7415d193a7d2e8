import random

import numpy as np
import pytest

from llm_helpers import SF, docs_frame
from weeklens.llm import spm
from weeklens.llm.queries import QUERIES, SENTENCEPIECE_MODEL

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=SENTENCEPIECE_MODEL)


@pytest.fixture(scope="module")
def vocabulary():
    return spm.load_vocabulary(SENTENCEPIECE_MODEL)


ODD = ["", " ", "  ", "a", " a", "a ", "Hello  world\n\tfoo ", "ﬁ Å½ é 　x\xa0y", "日本語のテキスト", "<s> </s> <unk> <0x0A> ▁x", "▁▁a▁",
       "\x00\x01", "🤖🤖 𝔘𝔫𝔦", "a" * 300, " " * 77 + "x" + " " * 40, "ab" * 200 + "the" * 99, "é́"]


def random_text(rnd, n):
    pool = ["the", "ing", " ", " ", "  ", "\n", "tion", "日本", "é", "zz", "0", "==", "▁", "qx", "a", "er", "🤖", "in"]
    return "".join(rnd.choice(pool) for _ in range(n))


def test_merges_equal_the_library(sp, vocabulary):
    encoder, surfaces, rnd = spm.Encoder(vocabulary), spm.Surfaces(vocabulary.surfaces), random.Random(1)
    for t in [*ODD, *(random_text(rnd, rnd.randint(1, 120)) for _ in range(400))]:
        assert encoder.encode(t).tolist() == sp.encode(t), repr(t)
        assert surfaces.text(sp.encode(t)) == sp.decode(sp.encode(t)), repr(t)
    for unit in ("abcabc" * 9, "thethe" * 20):
        assert spm._merge_long(unit, vocabulary.scores) == spm.merge(unit[:48], vocabulary.scores) or len(unit) > 48


def by_chunks(encoder, text, size):
    s, margin, parts = spm.mark(text), encoder.v.longest + 1, []
    for at in range(0, len(s), size):
        lo, hi = max(0, at - margin), min(len(s), at + size + margin)
        parts.append((s[lo:hi], at - lo, min(len(s), at + size) - lo))
    states = spm.border_states([encoder.matrix(*p) for p in parts])
    return [i for p, st in zip(parts, states) for i in encoder.trace(*p, *st).tolist()]


@pytest.mark.parametrize("size", [20, 33, 64])
def test_chunked_scan_equals_the_library(sp, vocabulary, size):
    encoder, rnd = spm.Encoder(vocabulary), random.Random(size)
    texts = [random_text(rnd, 150) for _ in range(25)]
    texts += [random_text(rnd, 90).replace(" ", "").replace("▁", "") for _ in range(15)]  # no unit starts at all
    texts += ["a" * 200, "日本語のテキスト" * 30, " " * 150, "internationalization" * 12]
    for t in texts:
        assert by_chunks(encoder, t, size) == sp.encode(t), repr(t)


def test_the_product_is_associative():
    rnd = np.random.default_rng(0)
    a, b, c = (np.where(rnd.random(s) < 0.3, -np.inf, rnd.integers(-50, 0, s).astype(float)) for s in ((3, 5), (5, 4), (4, 6)))
    assert np.array_equal(spm.times(spm.times(a, b), c), spm.times(a, spm.times(b, c)))


def test_operator_on_edge_rows(spark, sp):
    rnd = random.Random(7)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, None), (None, "no id"), (5, "twice " * 9), (5, "twice " * 9)]
    rows += [(200, random_text(rnd, 3000)), (201, "日本語" * 1500), (201, "日本語" * 1500)]
    out = spm.encode(docs_frame(spark, rows, extra=True), SENTENCEPIECE_MODEL, chunk_chars=257, keep=("text", "t", "key")).collect()
    assert sorted(((r["doc_id"], r["token_ids"]) for r in out), key=str) == sorted(((d, sp.encode(t or "")) for d, t in rows), key=str)
    assert spm.encode(docs_frame(spark, []), SENTENCEPIECE_MODEL).collect() == []


def test_whole_query(spark, sp):
    got = {r["doc_id"]: r for r in QUERIES["op7_sentencepiece"](spark, SF).collect()}
    for d, t in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        assert got[d]["n_tokens"] == len(sp.encode(t)) and got[d]["round_trip"] and got[d]["n_chars"] == len(t)


def test_units_of_giant_texts_share_the_memory_of_words():
    """What a chunk of a giant text and other texts have in common is encoded once; runs of marks still go by units."""
    encoder = spm.Encoder(spm.load_vocabulary(SENTENCEPIECE_MODEL))
    text = "some plain words and some more, naïve ones; plain words"
    ids = encoder.encode(text).tolist()
    known = len(encoder.of_word)
    assert encoder.units(spm.mark(text)).tolist() == ids and len(encoder.of_word) == known and not encoder.of_unit
    for odd in ("", "a  b", " a", "a ", "a", "  ", spm.MARK + "x", "x" + spm.MARK):
        marked = spm.mark(odd)
        want = [i for u in spm.UNIT.findall(marked) for i in encoder.piece_ids(spm._merge_long(u, encoder.v.scores))]
        assert encoder.units(marked).tolist() == want and (not odd or encoder.encode(odd).tolist() == want)
