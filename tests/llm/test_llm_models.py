"""URL filter, language identification, toxicity and top-k search."""

from __future__ import annotations

import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from ledgermap.llm import language, topk, toxicity, url_filter
from ledgermap.llm.queries import ORACLE, QUERIES
from tests.conftest import SF
from tests.llm.conftest import ODD


def compare(duck, name, rows):
    names = sorted(rows.columns)
    want = duck.sql(f"SELECT {', '.join(names)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(repr, map(tuple, rows.select(*names).collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize("name", ["op1_url_filter", "op9_top_k"])
def test_query_against_sql(spark, duck, name):
    compare(duck, name, QUERIES[name](spark, SF))


URLS = [
    (1, None),
    (2, ""),
    (3, "no scheme.org/es/"),
    (4, "HTTP://WWW.Example.ORG/es/x?y#z"),
    (5, "http://example.org/en/1"),
    (6, "http://myexample.org/en/1"),
    (7, "http://a.com/fr/x://b.org/"),
    (8, "http://a.com?x=/fr/"),
    (9, "http://com/de/1"),
    (9, "http://com/de/1"),
    (10, "x://" + "a" * 5000 + ".net/en/"),
    (11, "http://ÄB.net/\nq"),
    (None, "http://b.net/en/"),
]


def test_urls_odd(spark, duck):
    pages = spark.createDataFrame([(i, u, "h", "mine", 1) for i, u in URLS], "page_id long, url string, html string, host string, gram long")
    rows = url_filter.judge(pages).drop("score")
    duck.execute("CREATE SCHEMA IF NOT EXISTS odd")
    duck.execute("CREATE OR REPLACE TABLE odd.pages (page_id BIGINT, url VARCHAR)")
    duck.executemany("INSERT INTO odd.pages VALUES (?, ?)", URLS)
    names = sorted(rows.columns)
    sql = ORACLE["op1_url_filter"].replace("FROM pages)", "FROM odd.pages)")
    want = duck.sql(f"SELECT {', '.join(names)} FROM ({sql})").fetchall()
    assert sorted(map(repr, map(tuple, rows.select(*names).collect()))) == sorted(map(repr, want))
    got = {r["page_id"]: (r["host"], r["rule"], r["verdict"]) for r in rows.collect()}
    assert got[4] == ("www.example.org", "example.org/es/", "block")
    assert got[5][1] == "example.org/en/1" and got[6][1] == "org/" and got[7][1] == "com/fr/"
    assert got[8][1] is None and got[9] == ("com", "com/de/", "block") and got[1][0] == ""
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_query_string_decides(spark):
    """Of URLs with the same host and path the models judge by what follows them."""
    good = [f"http://site{i}.org/page/{i}?topic=gardening&ref=library{i}" for i in range(60)]
    bad = [f"http://site{i}.com/de/{i}?go=casino-jackpot-{i}" for i in range(60)]
    open_urls = ["http://same.net/go?topic=gardening&ref=library9", "http://same.net/go?go=casino-jackpot-9", "casino-jackpot", "topic=gardening&ref=library"]
    pages = spark.createDataFrame(list(enumerate(good + bad + open_urls)), "page_id long, url string")
    verdicts = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages).collect()}
    assert [verdicts[120 + i] for i in range(4)] == ["allow", "block", "block", "allow"]


def test_url_models_learn_the_rules(spark):
    """Without two of its rules the models judge as those rules would, and better than by chance."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    fewer = [r for r in url_filter.RULES if r[1:] not in (("com", "/fr/"), ("com", "/de/"))]
    judged = url_filter.judge(pages, fewer).filter("host LIKE '%.com' AND path LIKE '/es/%'").collect()
    blocked = sum(r["verdict"] == "block" for r in judged)
    assert len(judged) > 50 and blocked >= 0.9 * len(judged)


def test_language_held_out_accuracy(spark):
    rows = QUERIES["op3_language_id"](spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and 200 < len(held) < 500
    assert sum(lang[r["doc_id"]] == r["lang_pred"] for r in held) / len(held) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_odd(make_docs, docs):
    model = language.train(docs)
    got = language.identify(make_docs(*ODD, (40, "12 34 !!"), (41, "x")), model).collect()
    assert len(got) == len(ODD) + 2
    for r in got:
        assert (r["lang_pred"] == "und") == (r["doc_id"] in (1, 2, 3, 40) or (r["doc_id"] is None and r["score"] == 0))
        assert r["lang_pred"] != "und" or (r["score"] == 0 and r["rejected"])
    assert language.identify(make_docs(), model).count() == 0
    nothing = language.train(make_docs())
    assert {r["lang_pred"] for r in language.identify(make_docs(*ODD), nothing).collect()} == {"und"}


def test_language_sample_is_spread_and_bounded(spark, monkeypatch):
    """A rare language is learned beside a frequent one, and an id on many rows does not fill the sample."""
    pick = random.Random(4)
    words = {k: ["".join(pick.choices(a, k=pick.randrange(3, 8))) for _ in range(40)] for k, a in (("aa", "abcdefg"), ("bb", "hijklmn"), ("cc", "opqrstu"))}
    rows = [(i, "aa", " ".join(pick.choices(words["aa"], k=20))) for i in range(600)]
    rows += [(10_000 + i, "bb", " ".join(pick.choices(words["bb"], k=20))) for i in range(12)]
    rows += [(20_000, "cc", " ".join(pick.choices(words["cc"], k=20))) for _ in range(300)] + [(20_000, "cc", "same text")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    sizes = []
    monkeypatch.setattr(language, "_fit", lambda bags, labels, fit=language._fit: (sizes.append((len(bags), labels.count("cc"))), fit(bags, labels))[1])
    model = language.train(docs, sample=100)
    assert {"aa", "bb"} <= set(model.languages)
    assert sizes[0][0] <= 100 + 3 * language.LEAST_OF_LANGUAGE and sizes[0][1] <= 100
    rare = spark.createDataFrame([(1, " ".join(words["bb"][:10])), (2, " ".join(words["aa"][:10]))], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in language.identify(rare, model).collect()} == {1: "bb", 2: "aa"}


def plain_language(model, text):
    """The prediction with one bucket at a time, by the definition of a mean and a softmax."""
    buckets = language.subwords([text])[0].tolist()
    if not buckets:
        return "und", 0.0
    logits = [sum(float(model.weights[b, k]) for b in buckets) / len(buckets) + model.bias[k] for k in range(len(model.languages))]
    powers = [math.exp(v / model.temperature) for v in logits]
    best = max(range(len(powers)), key=powers.__getitem__)
    return model.languages[best], powers[best] / sum(powers)


def test_language_scores_equal_plain_ones(docs, texts):
    model = language.train(docs)
    for r in language.identify(docs, model).collect():
        name, score = plain_language(model, texts[r["doc_id"]])
        assert r["lang_pred"] == name and math.isclose(r["score"], score, rel_tol=1e-4)


def plain_toxicity(model, text):
    """The score from all segments of all tokens by their definition, parts and law written out."""
    words = toxicity.tokens(text)
    scores = [
        max([model.lexicon.get(f, 0.0) for f in toxicity.features(w)], default=0.0) or model.ordinary.get(w, model.gap)
        for w in words
    ]
    evidence = 0.0
    for a, b in plain_segments(scores):
        seen, less = Counter(), []
        for w, s in zip(words[a : b + 1], scores[a : b + 1]):
            seen[w] += s > 0
            less.append(s / seen[w] if s > 0 else s)
        for c, d in plain_segments(less):
            evidence += max(model.decay * sum(less[c : d + 1]) - math.log(max(model.k * len(words), 1e-12)), 0.0)
    return 1 / (1 + math.exp(-(model.slope * min(evidence, toxicity.MOST_EVIDENCE) + model.offset)))


def test_toxicity_scores_equal_plain_ones(make_docs):
    pick = random.Random(12)
    lexicon = {"bad": 2.5, "worse": 3.5, "awfu*": 2.0, "nasty": 2.2}
    model = toxicity.Model(lexicon, -0.3, 0.9, 0.02, 0.8, -3.0, {"fine": -0.45, "bath": -0.05, "bad": -0.2})
    words = ["bad", "worse", "awful", "awfully", "nasty"] + ["fine", "day", "x", "bath"] * 4
    rows = [(i, " ".join(pick.choices(words, k=pick.randrange(0, 30)))) for i in range(60)]
    for r in toxicity.score(make_docs(*rows), model).collect():
        assert math.isclose(r["score"], plain_toxicity(model, dict(rows)[r["doc_id"]]), rel_tol=1e-9)


def test_subwords_do_not_cross_texts():
    alone = [language.subwords([t])[0] for t in ("Ab cd", "", "é", "x1y")]
    bucket, owner = language.subwords(["Ab cd", "", "é", "x1y"])
    for i, want in enumerate(alone):
        assert sorted(bucket[owner == i]) == sorted(want)
    assert sorted(language.subwords(["ab  CD!"])[0]) == sorted(alone[0])


def plain_segments(scores):
    """All maximal segments by their definition: best, then left and right of it, again and again."""
    if not scores or max(scores) <= 0:
        return []
    best = max(
        ((a, b) for a in range(len(scores)) for b in range(a, len(scores))),
        key=lambda x: (round(sum(scores[x[0] : x[1] + 1]), 9), x[0] - x[1]),
    )
    a, b = best
    if sum(scores[a : b + 1]) <= 0:
        return []
    right = [(c + b + 1, d + b + 1) for c, d in plain_segments(scores[b + 1 :])]
    return plain_segments(scores[:a]) + [best] + right


def test_maximal_segments():
    pick = random.Random(2)
    for _ in range(200):
        scores = [pick.choice([-0.37, -0.37, -0.37, pick.uniform(0.1, 1.5)]) for _ in range(pick.randrange(0, 25))]
        places = [i for i, s in enumerate(scores) if s > 0]
        got = toxicity.maximal_segments(places, [scores[i] for i in places], -0.37)
        assert [(a, b) for a, b, _ in got] == plain_segments(scores)
        for a, b, total in got:
            assert math.isclose(total, sum(scores[a : b + 1]), abs_tol=1e-9)


def test_sums_between_places_equal_single_gaps():
    pick = random.Random(8)
    for _ in range(200):
        scores = [pick.choice([pick.uniform(-0.9, -0.01), pick.uniform(0.1, 1.5)]) for _ in range(pick.randrange(1, 25))]
        places, between, lost = [], [], 0.0
        for i, s in enumerate(scores):
            if s > 0:
                places.append(i)
                between.append(lost)
                lost = 0.0
            else:
                lost += s
        got = toxicity.maximal_segments(places, [scores[i] for i in places], between)
        assert [(a, b) for a, b, _ in got] == plain_segments(scores)


def test_decay_is_found_again():
    """Best scores drawn from the law itself, of texts of many lengths."""
    pick = random.Random(4)
    for decay in (0.6, 1.0, 1.8):
        lengths = [pick.randrange(50, 2000) for _ in range(4000)]
        best = [math.log(0.02 * n / -math.log(pick.random())) / decay for n in lengths]
        best = [b if b >= toxicity.LEAST_SCORE else 0.0 for b in best]
        assert abs(toxicity._decay(np.array(best), np.array(lengths)) / decay - 1) < 0.1
    assert toxicity._decay(np.zeros(50), np.full(50, 100)) == pytest.approx(1.0, abs=0.02)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op5_toxicity"](spark, sf).collect()
    label = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(r["predicted"], label[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in label]
    assert sum(p for p, t in held if t) >= 0.75 * sum(t for _, t in held)
    assert sum(p for p, t in held if not t) <= 0.01 * sum(1 - t for _, t in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_toxicity_odd(spark, make_docs):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.train(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    odd = make_docs(*ODD)
    got = toxicity.score(odd, model).collect()
    assert len(got) == len(ODD) and all(r["score"] < 0.7 for r in got if r["doc_id"] in (1, 2, 3))
    assert toxicity.keep_clean(odd, model).columns == odd.columns
    assert toxicity.score(make_docs(), model).count() == 0
    assert toxicity.passages(odd, model).count() == 0
    word = max((f for f in model.lexicon if not f.endswith("*")), key=model.lexicon.get)
    found = toxicity.passages(make_docs((1, f"a b {word} c {word}")), model).collect()
    assert [(r["first_token"], r["last_token"], r["passage"]) for r in found] == [(2, 4, f"{word} c {word}")]
    empty = toxicity.train(make_docs(), labels.limit(0))
    assert {r["predicted"] for r in toxicity.score(odd, empty).collect()} == {0}


def plain_top(rows, queries, k, scale=256):
    """Every query row against every row of another id, in Python integers."""
    whole = [(i, [math.floor(scale * Fraction(float(v))) for v in x]) for i, x in rows]
    out = []
    for q, x in whole:
        if q in queries:
            scores = sorted((-sum(a * b for a, b in zip(x, v)), i) for i, v in whole if i != q)
            out += [(q, rank, i, -s if -(2**63) <= -s < 2**63 else None) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


@pytest.fixture
def small_cells(monkeypatch):
    for name, value in (("CELL_ROWS", 7), ("CHUNK_CELLS", 2), ("QUERY_ROWS", 2), ("RING_SAMPLE", 3), ("PIVOTS", 5)):
        monkeypatch.setattr(topk, name, value)


def test_top_k_odd(spark, small_cells):
    pick = random.Random(6)
    rows = [(i, [pick.choice([-1.5, 0.0, 0.25, 0.7, 2.0]) for _ in range(4)]) for i in range(120)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(200, 260)] + [(300, [9.0] * 4), (301, [1.0]), (302, [])]
    rows += rows[:5] + [(1, [8.0, 0.0, 0.0, 1.0]), (100, [0.0, 7.0, -1.0, 0.0])]
    bad = [(400, None), (401, [1.0, None, 0.0, 0.0]), (402, [float("nan")] * 4), (403, [float("inf")] * 4), (None, [1.0] * 4)]
    frame = spark.createDataFrame([(*r, 3, 7) for r in rows + bad], "vec_id long, embedding array<float>, score int, cell int")
    got = topk.top_k(frame, frame.filter("vec_id % 50 = 0")).collect()
    exact = [(i, [float(np.float32(v)) for v in x]) for i, x in rows]
    assert sorted(map(tuple, got), key=repr) == plain_top(exact, {0, 50, 100, 200, 250, 300}, 5)
    few = topk.top_k(frame.filter("vec_id = 3 OR vec_id = 20"), frame.filter("vec_id = 20")).collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(few, key=lambda r: r["rank"])] == [(1, 3), (2, 3)]
    assert topk.top_k(frame.limit(0), frame.limit(0)).count() == 0
    assert topk.top_k(frame, frame.limit(0)).count() == 0
    longer = spark.createDataFrame([(1000, [1.0] * 9)], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, topk.top_k(frame, longer).collect()), key=repr) == sorted(
        plain_top([*exact, (1000, [1.0] * 9)], {1000}, 5), key=repr
    )


@pytest.mark.parametrize("spread", [1e5, 1e8, 8e6, 3e12])
def test_top_k_of_large_components(spark, small_cells, spread):
    pick = random.Random(int(spread))
    rows = [(i, [pick.gauss(0, spread) for _ in range(3)]) for i in range(80)]
    # scores that differ in their last digits only
    rows += [(i, [spread, i / 256, 0.0]) for i in range(200, 212)] + [(100, [spread, 1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(frame, frame.filter("vec_id % 50 = 0")).collect()
    assert sorted(map(tuple, got), key=repr) == plain_top(rows, {0, 50, 100, 200}, 5)


def test_top_k_stops_early_on_clusters(spark, small_cells):
    """Rings beyond the radius are never visited."""
    pick = random.Random(8)
    rows = [(i, [100.0 * (i % 4 == j) + pick.random() for j in range(4)]) for i in range(400)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    seen = []
    search = topk._search
    try:
        topk._search = lambda visits, *rest: (seen.append(visits.count()), search(visits, *rest))[1]
        got = topk.top_k(frame, frame.filter("vec_id % 50 = 0")).collect()
    finally:
        topk._search = search
    assert sorted(map(tuple, got), key=repr) == plain_top(rows, set(range(0, 400, 50)), 5)
    assert sum(seen) < 8 * 40
