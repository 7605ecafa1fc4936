"""Operators on documents against brute force, with nulls, empty texts, repeats and clashing columns."""

import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from corpusmap.llm import decontaminate, language, pieces, pii, queries, simhash, substring, toxicity

SCHEMA = "doc_id bigint, text string, fp string, id string, n int, tie string, repeats string, label string"


def docs(spark, texts, ids=None):
    rows = [(i, t, "x", "y", 1, "z", "r", "l") for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, SCHEMA)


def random_texts(seed, count=60, vocabulary=8):
    rng = random.Random(seed)
    make = lambda n: [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
    shared = [make(rng.randrange(20, 50)) for _ in range(6)]
    texts = []
    for _ in range(count):
        parts = [make(rng.randrange(0, 40)), rng.choice(shared), make(rng.randrange(0, 15)), rng.choice(shared)[: rng.randrange(5, 50)]]
        texts.append(" ".join(w for p in rng.sample(parts, rng.randrange(1, 5)) for w in p))
    return texts + ["a " * 70, "a b " * 40, "", None, " \n\t ", texts[0], texts[1], "é漢 " * 30]


@pytest.mark.parametrize("vocabulary", [2, 8, 1000])
def test_substring(spark, vocabulary):
    texts = random_texts(vocabulary, vocabulary=vocabulary)
    want = substring.brute_force(texts)
    got = {r.doc_id: r.repeats for r in substring.without_repeats(docs(spark, texts).drop("repeats")).collect()}
    assert len(got) == len(texts)
    for i, w in want.iterrows():
        assert (got[i].n_words, got[i].n_removed, got[i].kept) == tuple(w), i


def test_substring_other_window(spark):
    texts = random_texts(5, 30, 3)
    want = substring.brute_force(texts, 7)
    got = {r.doc_id: r.repeats for r in substring.without_repeats(docs(spark, texts).drop("repeats"), window=7).collect()}
    assert all((got[i].n_removed, got[i].kept) == (w.n_removed, w.kept) for i, w in want.iterrows())


def test_substring_ids(spark):
    """Exact repeats of a row are one document; a null id comes last; an empty table stays empty."""
    text = " ".join(f"w{i}" for i in range(25))
    found = substring.without_repeats(docs(spark, [text, text, text, text], [None, 3, 3, 5]).drop("repeats")).collect()
    assert sorted((r.doc_id or 0, r.repeats.n_removed) for r in found) == [(0, 25), (3, 0), (3, 0), (5, 25)]
    assert substring.without_repeats(docs(spark, ["a"]).filter("false").drop("repeats")).count() == 0


def test_equal_windows_share_anchor():
    rng = np.random.default_rng(1)
    for _ in range(40):
        names = substring.mix(np.arange(1, rng.integers(3, 40)).astype("u8"))
        text = names[rng.integers(0, len(names), 300)]
        text = np.concatenate([text, text[100:150], names[rng.integers(0, len(names), 40)], text[120:160]])
        best, seen = substring.anchors(text), {}
        for i in range(len(text) - 19):
            assert best[seen.setdefault(text[i : i + 20].tobytes(), i)] == best[i]


def test_contamination(spark):
    rng = random.Random(2)
    items = [(i, " ".join(f"w{rng.randrange(9)}" for _ in range(rng.choice([3, 12, 13, 14, 30])))) for i in range(12)]
    items += [(90, None), (91, ""), (3, items[3][1]), (None, "lonely words here")]
    texts = random_texts(3, 50, 9) + [(items[0][1] + " x. ").upper() * 2, "Lonely, WORDS here!"] + [" - ".join(items[5][1].split())]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    want = decontaminate.brute_force(texts, [("" if i is None else str(i), t) for i, t in items])
    for block in (decontaminate.BLOCK_BYTES, 200):
        found = decontaminate.contamination(docs(spark, texts), table, block_bytes=block)
        got = {r.doc_id: r.benchmark_found for r in found.collect()}
        for i, w in want.iterrows():
            assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == (w.n_words, w.n_hit, w["items"]), i
    nothing = decontaminate.contamination(docs(spark, texts), table.filter("false"))
    assert nothing.filter("benchmark_found.n_hit > 0").count() == 0


def test_longest_match(spark):
    item = " ".join(f"q{i}" for i in range(30))
    text = "a b " + " ".join(f"q{i}" for i in range(5, 25)) + " c"
    found = decontaminate.contamination(docs(spark, [text]), spark.createDataFrame([(7, item)], "item_id int, text string")).first()
    m = found.benchmark_found.matches[0]
    assert (m.item_id, m.start, m.item_start, m.length) == ("7", 2, 5, 20)


def test_simhash(spark):
    rng = random.Random(4)
    base = [[f"w{rng.randrange(500)}" for _ in range(60)] for _ in range(40)]
    texts = [" ".join(b) for b in base]
    for b in base[:20]:
        for _ in range(4):
            copy = list(b)
            copy[rng.randrange(60)] = f"w{rng.randrange(500)}"
            texts.append(" ".join(copy))
    texts += ["", None, " ", texts[0], texts[0].upper(), "one", "one two"]
    want = simhash.brute_force(texts, list(range(len(texts))))
    for trees in ({}, {"leaf_rows": 4}, {"leaf_rows": 4, "block_rows": 3}, {"leaf_rows": 4, "sample": 16}):
        got = {r.doc_id: r for r in simhash.near_duplicates(docs(spark, texts), **trees).collect()}
        for w in want.itertuples():
            assert (got[w.doc_id].fp % 2**64, got[w.doc_id].component_id) == (w.fp, w.component_id), (trees, w)
    assert simhash.near_duplicates(docs(spark, texts).filter("false")).count() == 0


def test_tree_meets_all_pairs():
    rng = np.random.default_rng(5)
    values = rng.integers(0, 1 << 32, 800, dtype="u8").astype("u4")
    values = np.unique(np.concatenate([values, values[:300] ^ (np.uint32(1) << rng.integers(0, 32, 300).astype("u4"))]))
    rows, leaves = simhash.Tree(values[::3], 8, 0).route(values)
    homes = [set(leaves[rows == i]) for i in range(len(values))]
    close = np.argwhere(np.bitwise_count(values[:, None] ^ values[None, :]) <= 1)
    assert all(homes[i] & homes[j] for i, j in close)


PII_TEXT = "Mail a.b@c.de, x@y; +1 (234) 555-0199 card 4111 1111 1111 1111, 4111 1111 1111 1112; 1.2.3.4 1.2.3.999 IBAN DE89 3704 0044 0532 0130 00 ssn 123-45-6789 é@é.de"


def test_pii(spark):
    found = {s["kind"]: PII_TEXT[s["start"] : s["end"]] for s in pii.spans(PII_TEXT)}
    assert found == {
        "email": "a.b@c.de", "phone": "+1 (234) 555-0199", "card": "4111 1111 1111 1111", "ip": "1.2.3.4",
        "iban": "DE89 3704 0044 0532 0130 00", "ssn": "123-45-6789",
    }
    assert pii.spans(None) == pii.spans("") == [] and pii.spans("@" * 1000 + "1" * 5000) == []
    near, far = pii.spans("my card 4111111111111111")[0], pii.spans("4111111111111111")[0]
    assert near["score"] > far["score"]
    out = docs(spark, [PII_TEXT, None, ""]).select("doc_id", pii.mask_pii(F.col("text")).alias("t"), F.size(pii.find_pii(F.col("text"))).alias("k")).collect()
    assert "[EMAIL]" in out[0].t and "4111 1111 1111 1111," not in out[0].t and [r.k for r in out] == [6, 0, 0] and out[1].t is None


def test_emails_like_pattern():
    import re

    rng, pattern = random.Random(6), re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    for _ in range(3000):
        text = "".join(rng.choice("ab@@..-% 1") for _ in range(rng.randrange(30)))
        assert list(pii.emails(text)) == [m.span() for m in pattern.finditer(text)], text
        ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
        text = "".join(rng.choice("12.. ") for _ in range(rng.randrange(30)))
        assert [m.span() for m in pii.IP.finditer(text)] == [m.span() for m in ip.finditer(text)]


@pytest.fixture(scope="module")
def model():
    with open(queries.MODEL_FILE, "rb") as f:
        return f.read()


PIECE_TEXTS = ["hello  world", " a\n\n b \n", "▁ literal ▁▁ mark", "x" * 300, " " * 50, "漢字é ß 🙂", "representation" * 30, "a"]


def test_pieces_equal_any_chunking(spark, model):
    own = pieces.Pieces(model)
    for chunk in (1 << 16, 3, 17, 50):
        rows = pieces.encode(docs(spark, [*PIECE_TEXTS, None, ""]), model, chunk=chunk, exact_col="same").collect()
        got = {r.doc_id: r.token_ids for r in rows}
        assert all(r.same for r in rows) and got[len(PIECE_TEXTS)] is None and got[len(PIECE_TEXTS) + 1] == []
        assert [got[i] for i in range(len(PIECE_TEXTS))] == [list(own.best(" " + t)) for t in PIECE_TEXTS]


def test_pieces_score_like_library(model):
    """The library, told to read the same pieces as a unigram model, finds no better segmentation of a word."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    spec = proto.ModelProto()
    spec.ParseFromString(model)
    spec.trainer_spec.model_type = 1
    library, own = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString()), pieces.Pieces(model)
    worth = lambda ids: sum(library.get_score(i) for i in ids)
    for word in "segmentation tokens international Straße unbelievable recompression a 12345".split():
        assert worth(own.encode(word).tolist()) == worth(library.encode(word))


def test_toxicity(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        text = " ".join(rng.choice(words) for _ in range(40)) + (" vile scum" if toxic else "")
        rows.append(text)
        if i % 5 < 3:
            labels.append((i, int(toxic), "t"))
    table = docs(spark, [*rows, None, ""])
    marked = spark.createDataFrame([*labels, (None, 1, "t"), (5, None, "t")], "doc_id bigint, toxic int, text string")
    model = toxicity.train(table, marked, ~toxicity.held_out("doc_id", 5, 0))
    out = {r.doc_id: r.s for r in table.select("doc_id", toxicity.toxicity(spark, model, F.col("text")).alias("s")).collect()}
    right = [(out[i] >= 0.5) == (i % 6 == 0) for i in range(600)]
    assert np.mean(right) > 0.98 and out[600] == out[601] < 0.5
    assert toxicity.train(table, marked.filter("false"), F.lit(True)).score(b"vile scum") < 0.5


def test_language(spark):
    rng = random.Random(8)
    make = {"xx": ["kala", "talo", "maki"], "yy": ["zrost", "brzno", "krztop"], "ru": ["слово", "дело", "мир"]}
    rows = []
    for i in range(120):
        lang = ("xx", "yy", "ru")[i % 3]
        rows.append((i, " ".join(rng.choice(make[lang]) for _ in range(30)), lang))
    rows += [(200, "kala talo maki " * 10 + "krztop brzno zrost " * 8, None), (201, None, "xx"), (202, "123 !?", "xx"), (203, "", None), (None, "kala", "yy")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.train(table, ~toxicity.held_out("doc_id", 3, 1))
    out = {r.doc_id: r.f for r in table.select("doc_id", language.identify(spark, model, F.col("text")).alias("f")).collect()}
    assert all(out[i].lang == ("xx", "yy", "ru")[i % 3] for i in range(120))
    assert [(s.lang, s.first_word, s.n_words) for s in out[200].spans] == [("xx", 0, 30), ("yy", 30, 24)] and out[200].lang == "yy"
    assert [out[i].lang for i in (201, 202, 203)] == ["und"] * 3


def test_viterbi_against_brute_force():
    from itertools import product

    rng = np.random.default_rng(9)
    for _ in range(20):
        lengths = rng.integers(0, 6, 4)
        scores = rng.normal(size=(lengths.sum(), 3))
        got, at = language.viterbi(scores, lengths, 0.7), 0
        for n in lengths:
            own = scores[at : at + n]
            value = lambda p: sum(own[i, x] for i, x in enumerate(p)) - 0.7 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: B023, E731
            assert not n or tuple(got[at : at + n]) == max(product(range(3), repeat=int(n)), key=value)
            at += n


def test_numerals_are_no_letters():
    model = language.fit([("de", "^ab", 3), ("en", "^ac", 3)])
    found = language.label(model, ["½ ²³", "m²", "", None, "12 --"], language.Numbers(model), spans=True)
    assert [f["lang"] == "und" for f in found] == [True, False, True, True, True]
    assert found[0] == {"lang": "und", "score": 0.0, "spans": []}
