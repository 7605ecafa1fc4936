"""Counts of faults and the likelihood ratio against plain loops."""

import math
import random
import re
from collections import Counter
from hashlib import md5

import pytest

from corpusmap.llm import quality


def plain(texts):
    """The first five fields of each text, without any shared code."""
    out = []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
        seen, again = set(), 0
        for line in (text or "").split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                again += line in seen
                seen.add(line)
        out.append((len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(covered)))
    return out


def scores(texts, trusted):
    """Whole thousandths of the mean log-likelihood ratio of words and pairs."""
    bucket = lambda g: int(md5(g.encode()).hexdigest()[:4], 16)
    grams = []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        grams.append([bucket(g) for g in words + [f"{a} {b}" for a, b in zip(words, words[1:])]])
    raw = Counter(g for row in grams for g in row)
    target = Counter(g for row, t in zip(grams, trusted) if t for g in row)
    n, m = sum(target.values()) + 65536, sum(raw.values()) + 65536
    weight = {g: round(1000 * math.log((target[g] + 1) / n / ((raw[g] + 1) / m))) for g in raw}
    return [sum(weight[g] for g in row) // max(1, len(row)) for row in grams]


def corpus():
    rng = random.Random(5)
    texts = []
    for i in range(120):
        words = [rng.choice(["and", "the", "of", "é" * rng.randrange(1, 4), f"w{rng.randrange(60)}", "a|b", "<p>"]) for _ in range(rng.choice([0, 1, 2, 49, 50, 51, 90, 400]))]
        words = [w + "&&&" for w in words] if i % 5 == 0 else words
        texts.append("".join(w + rng.choice([" ", "\n", "\t\v", "  \n \n"]) for w in words))
    return [*texts, None, "", " \n\x0c", "x y z " * 40, "same line\nsame line\n\n\nsame line ", "\x1f\x85    a"]


def test_against_loops(spark):
    texts = corpus()
    trusted = [i % 5 != 0 and i % 3 == 0 for i in range(len(texts))]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, m string, score int").repartition(5)
    ids = spark.createDataFrame([(i,) for i, t in enumerate(trusted) if t] * 2 + [(None,)], "doc_id bigint")
    got = {r.doc_id: r for r in quality.assess(docs, ids, below=10).collect()}
    assert len(got) == len(texts)
    want, score = plain(texts), scores(texts, trusted)
    failed = [w[0] < 50 or 100 * w[4] > 50 * w[0] for w in want]
    ranked = sorted(s for s, t, f in zip(score, trusted, failed) if t and not f)
    least = ranked[len(ranked) // 10]
    for i in range(len(texts)):
        row = got[i]
        assert tuple(row)[1:6] == want[i], texts[i]
        assert row.score == score[i] and row.base_failed == failed[i]
        assert row.kept == (not failed[i] and score[i] >= least)
    assert 0 < sum(r.kept for r in got.values()) < len(texts) - sum(failed)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, "a b")], [(3, "a b"), (3, "a b"), (3, "c")]])
def test_edges(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint")
    for ids in (none, docs.select("doc_id")):
        got = quality.assess(docs, ids).collect()
        assert len(got) == len(rows) and not any(r.kept for r in got)


def test_no_trusted_keeps_what_does_not_fail(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60))), (2, "short")], "doc_id bigint, text string")
    got = {r.doc_id: r.kept for r in quality.assess(docs, spark.createDataFrame([], "doc_id bigint")).collect()}
    assert got == {1: True, 2: False}


def test_very_long(spark):
    text = " ".join(f"w{i * i % 9973}" for i in range(300_000))
    got = quality.Model(quality.ratios(quality.np.zeros(65536), quality.np.zeros(65536))).measure([text.encode(), b"a"], quality.Vocabulary())
    assert got[0].tolist() == [300_000, 1] and got[4][1] == 0
