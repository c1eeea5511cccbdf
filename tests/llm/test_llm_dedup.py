"""Exact and near duplicates, secrets and the pipeline against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline
from ledgermap.llm import near_dedup
from ledgermap.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from ledgermap.llm.near_dedup import components, drop_near_duplicates, near_duplicates
from ledgermap.llm.queries import ORACLE, QUERIES
from ledgermap.llm.secret_scan import digests, extend_ledger, find, redact, scan
from tests.conftest import SF
from tests.llm.conftest import ODD

SPACE = re.compile("[\x20\x09-\x0d]")


def plain_exact(rows):
    groups = {}
    for place, (doc, text) in enumerate(rows):
        groups.setdefault(SPACE.sub("", text or ""), []).append((-len(text or ""), doc is None, doc or 0, place))
    out = []
    for text, group in groups.items():
        _, none, keep, place = min(group)
        for _, no_id, doc, at in group:
            digest = hashlib.sha256(text.encode()).hexdigest()
            out.append((None if no_id else doc, None if none else keep, len(group), at == place, digest))
    return out


def as_set(rows):
    return sorted(map(repr, map(tuple, rows)))


def test_exact_query(spark, duck):
    rows = QUERIES["op8_exact_dedup"](spark, SF)
    names = sorted(rows.columns)
    want = duck.sql(f"SELECT {', '.join(names)} FROM ({ORACLE['op8_exact_dedup']})").fetchall()
    assert as_set(rows.select(*names).collect()) == as_set(want)


@pytest.mark.parametrize("block", [3, 4096])
def test_exact_odd(make_docs, block):
    rows = [*ODD, (20, "abcabc"), (21, "abc abc"), (22, "abcabcab"), (23, "abcab"), (19, "a b c a b c")]
    want = plain_exact(rows)
    got = exact_duplicates(make_docs(*rows), block_bytes=block).collect()
    if block == 3:  # the long text makes many levels
        assert max(len(t or "") for _, t in rows) > 3 * 2**12
    assert as_set(got) == as_set(want)
    assert exact_duplicates(make_docs()).count() == 0


def test_dropping_keeps_columns_and_one_row(make_docs):
    docs = make_docs(*ODD, (11, "o n e t w o"))
    for drop in (drop_exact_duplicates, drop_near_duplicates):
        left = drop(docs)
        assert left.columns == docs.columns
        ids = [r["doc_id"] for r in left.collect()]
        assert ids.count(5) <= 1 and ids.count(4) == 1
        assert drop(make_docs()).count() == 0
    # equal texts: the longest stays, of null and empty ones the longest white space
    assert {r["doc_id"] for r in drop_exact_duplicates(docs).collect()} == {3, 4, 6, 11, None, 7, 8, 9}


def sets_of(rows):
    sets = []
    for _, text in rows:
        words = [w for w in SPACE.split((text or "")) if w]
        words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
        size = min(5, len(words))
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set())
    return sets


def plain_near(rows):
    sets, comp = sets_of(rows), list(range(len(rows)))

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 75 * len(sets[i] | sets[j]):
            comp[max(root(i), root(j))] = min(root(i), root(j))
    low = {}
    for i, (doc, _) in enumerate(rows):
        known = [x for x in (low.get(root(i)), doc) if x is not None]
        low[root(i)] = min(known) if known else None
    return [(d, len(sets[i]), low[root(i)], d == low[root(i)]) for i, (d, _) in enumerate(rows)]


def test_near_query(spark, texts):
    rows = QUERIES["op6_near_dedup"](spark, SF).collect()
    assert as_set(rows) == as_set(plain_near(list(texts.items())))


def test_near_odd(make_docs):
    assert as_set(near_duplicates(make_docs(*ODD)).collect()) == as_set(plain_near(ODD))
    assert near_duplicates(make_docs()).count() == 0


@pytest.fixture
def crowded():
    """Copies of one text with changes, chains of changes, and a passage that different texts share."""
    pick = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    base = pick.choices(words, k=80)
    passage = pick.choices(words, k=40)
    rows = []
    for i in range(60):
        own = base.copy()
        for at in pick.sample(range(80), pick.randrange(0, 4)):
            own[at] = f"x{i}_{at}"
        rows.append((len(rows), " ".join(own)))
    chain = base.copy()
    for i in range(20):
        chain = chain[2:] + [f"c{i}", f"d{i}"]
        rows.append((len(rows), " ".join(chain)))
    for i in range(60):
        rows.append((len(rows), " ".join(passage + pick.choices(words, k=12))))
    return rows


@pytest.mark.parametrize("block", [4, 512])
def test_near_crowded(make_docs, crowded, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    assert as_set(near_duplicates(make_docs(*crowded)).collect()) == as_set(plain_near(crowded))


@pytest.mark.parametrize("common", [45, 60, 66, 72])
def test_near_crowd_below_the_threshold(make_docs, common):
    """Texts that share a passage to a similarity of 0.5 to 0.8, some of which share the rest too."""
    pick = random.Random(common)
    words = [f"w{i}" for i in range(9000)]
    passage = pick.choices(words, k=common)
    rows = []
    for i in range(70):
        own = pick.choices(words, k=80 - common)
        rows.append((len(rows), " ".join(passage + own)))
        if i % 5 == 0:
            own[pick.randrange(len(own))] = "other"
            rows.append((len(rows), " ".join(passage + own)))
    assert as_set(near_duplicates(make_docs(*rows)).collect()) == as_set(plain_near(rows))


def sketch_rows(spark, sets):
    rows = [(i, len(s), np.array(sorted(s)[: near_dedup.SKETCH], np.int64).tobytes()) for i, s in enumerate(sets)]
    return spark.createDataFrame(rows, "node long, n long, sketch binary")


def test_rarest_shared_value_lists_both(spark):
    pick = random.Random(3)
    sets = []
    for base in range(12):
        whole = set(pick.sample(range(10**9), pick.choice([1, 3, 20, 60, 64, 70, 85, 200])))
        for _ in range(8):
            own = set(x for x in whole if pick.random() > 0.08) or set(whole)
            sets.append(own | set(pick.sample(range(10**9), len(own) // 15)))
    listed = {r.node: set(r.listed) for r in near_dedup._listed(sketch_rows(spark, sets)).collect()}
    pairs = 0
    for i, j in combinations(range(len(sets)), 2):
        if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            pairs += 1
            assert listed[i] & listed[j]
    assert pairs > 50


@pytest.mark.parametrize("size", [90, 900])
def test_blocks_find_what_pairs_find(size, monkeypatch):
    monkeypatch.setattr(near_dedup, "COLUMNS", 50)
    pick = random.Random(3)
    base = sorted(pick.sample(range(10**6), size))
    held, sets = [], []
    for node in range(60):
        own = set(base) - set(pick.sample(base, pick.randrange(0, size // 3)))
        own |= set(pick.sample(range(10**6), pick.randrange(0, size // 3)))
        sketch = np.array(sorted(own)[: near_dedup.LONG_SKETCH], np.int64).astype("<u4")
        listed = [*pick.sample(range(100, 110), 2), 1, *pick.sample(range(200, 210), 2)]
        held.append((0, node, len(own), node % 7, node % 3 > 0, False, sketch.tobytes(), listed))
        sets.append(own)
    close = [
        (i, j)
        for i, j in combinations(range(60), 2)
        if i % 7 != j % 7 and (i % 3 or j % 3) and not set(held[i][7][:2]) & set(held[j][7][:2])
    ]
    similar = {p for p in close if 100 * len(sets[p[0]] & sets[p[1]]) >= 75 * len(sets[p[0]] | sets[p[1]])}
    found = set(near_dedup._compare((1, 2, 0, 0), held))
    assert similar and similar <= found <= set(close)
    if size == 90:
        assert found == similar


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 50), (50, 70), (200, 201)]
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {100: 50, 50: 50, 70: 50, 200: 200, 201: 200}
    assert got == want


def plain_spans(text):
    assign = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans = [(m.start(), 0, "assign", m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(kind, a, b) for a, _, kind, b in sorted(spans)]


SECRETS = [
    "token = \"token\"=abcdefghij",
    "PASSWORD: 'short' passwd:longenough1",
    "AKIAAKIAABCDEFGHIJ AKIAABC AKIA" + "Z" * 30,
    "api_key=" + "0123456789abcdef" * 3,
    "ſecret=notASCIIword passKord toKen=kelvin123",
    "f" * 31 + " " + "e" * 32 + "g",
    "é🙂 secret  =  aaaaaaaa",
]


def test_find():
    for text in SECRETS:
        assert find(text) == plain_spans(text), text


def test_secret_query(spark, texts):
    rows = QUERIES["op2_secret_scan"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = plain_spans(texts[r["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["spans"] == joined and r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")]


def test_secret_odd(make_docs):
    rows = [*ODD, *enumerate(SECRETS, 30), (30, SECRETS[1])]
    got = sorted((str(r["doc_id"]), r["spans"]) for r in digests(scan(make_docs(*rows))).collect())
    want = sorted((str(i), ",".join(f"{k}:{a}:{b}" for k, a, b in plain_spans(t or ""))) for i, t in rows)
    assert got == want
    assert scan(make_docs()).count() == 0


def test_ledger_scans_unseen_pairs_only(make_docs, spark):
    first = make_docs((1, SECRETS[1]), (2, "clean"), (3, SECRETS[1]))
    _, ledger = extend_ledger(first)
    assert ledger.count() == 2
    ledger = spark.createDataFrame(ledger.collect(), ledger.schema)
    # a finding that is not in the text shows that the ledger was believed
    forged = ledger.selectExpr("blob", "rules", "array(named_struct('kind', 'hex', 'start', 0, 'end', 5)) AS findings")
    _, grown = extend_ledger(make_docs((1, "clean"), (4, SECRETS[3])), forged)
    assert grown.count() == 3
    assert {r["path"]: len(r["findings"]) for r in scan(make_docs((9, "clean")), forged).collect()} == {9: 1}
    # with other rules everything is unseen again
    assert {r["path"]: len(r["findings"]) for r in scan(make_docs((9, "clean")), forged, rules="next").collect()} == {9: 0}


def test_many_texts_without_an_id_meet_their_own_blob_only(make_docs):
    rows = [(None, f"secret=abcdefgh{i}") for i in range(40)] + [(None, "clean")] * 3
    docs = make_docs(*rows)
    assert sorted(len(r["findings"]) for r in scan(docs).collect()) == [0] * 3 + [1] * 40
    _, ledger = extend_ledger(docs)
    assert ledger.count() == 41


def test_versions_of_a_path(spark):
    rows = [("a.txt", 1, "clean"), ("a.txt", 2, "secret=abcdefgh"), ("b.txt", 1, "secret=abcdefgh")]
    found = scan(spark.createDataFrame(rows, "path string, v int, body string"), None, "path", "body", "v").collect()
    assert {(r["path"], r["version"], len(r["findings"])) for r in found} == {("a.txt", "1", 0), ("a.txt", "2", 1), ("b.txt", "1", 1)}


def test_redact(make_docs):
    rows = [*ODD, *enumerate(SECRETS, 30)]
    docs = make_docs(*rows)
    left = redact(docs)
    assert left.columns == docs.columns and left.count() == docs.count()
    for r in left.collect():
        assert not find(r["text"] or "") and r["n_chars"] == len(r["text"] or "")
    kept = {r["doc_id"]: r["text"] for r in left.collect()}
    assert kept[1] is None and kept[5] == "one two"


def test_pipeline_stages(spark, docs, tmp_path):
    """Each stage against its plain version on what the stage before kept."""
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in now.collect()]
        after = stage(spark, now, SF)
        after.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            assert {r["doc_id"] for r in after.select("doc_id").collect()} == {d for d, _ in before}
            break
        assert after.columns == docs.columns
        ids = {r["doc_id"] for r in after.collect()}
        if name == "exact_dedup":
            assert ids == {r[0] for r in plain_exact(before) if r[3]}
        elif name == "near_dedup":
            assert ids == {r[0] for r in plain_near(before) if r[3]}
        elif name == "secrets":
            assert ids == {d for d, _ in before} and not any(find(r["text"]) for r in after.collect())
        else:
            assert len(ids) > 0.8 * len(before)
        now = after
    total = after.agg({"length": "sum"}).first()[0]
    assert corpus_pipeline.run(spark, SF).agg({"length": "sum"}).first()[0] == total


def test_pipeline_odd(make_docs, spark):
    docs = make_docs(*ODD)
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame((out := stage(spark, docs, SF)).collect(), out.schema)
    assert docs.count() > 0
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, make_docs(), SF).count() == 0
