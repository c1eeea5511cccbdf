"""Clustering, the Merkle manifest and personal data against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction
from math import floor

import numpy as np
import pytest

from ledgermap.llm import clustering, merkle, personal_data
from ledgermap.llm.queries import ORACLE, QUERIES
from tests.conftest import SF
from tests.llm.conftest import ODD


def as_set(rows):
    return sorted(map(repr, map(tuple, rows)))


@pytest.mark.parametrize("name", ["op11_centroid_clustering", "op12_merkle_manifest"])
def test_query_equals_sql(spark, duck, name):
    rows = QUERIES[name](spark, SF)
    names = sorted(rows.columns)
    want = duck.sql(f"SELECT {', '.join(names)} FROM ({ORACLE[name]})").fetchall()
    assert as_set(rows.select(*names).collect()) == as_set(want)


# --- clustering -------------------------------------------------------------------------------


def plain_clusters(rows, k, rounds, width):
    kept = []
    for name, x in rows:
        if x is not None and len(x) == width and all(v is not None and np.isfinite(v) for v in x):
            kept.append((name, [floor(256 * Fraction(float(v))) for v in x]))

    def key(row):
        return (row[0] is None, hashlib.sha256(f"2:{row[0]}".encode()).hexdigest() if row[0] is not None else "", row[1])

    centroids = [x for _, x in sorted(kept, key=key)[:k]]

    def nearest(x):
        found = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centroids]
        return found.index(min(found)), min(found)

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[0], []).append(x)
        for c, members in groups.items():
            centroids[c] = [sum(column) // len(members) for column in zip(*members)]
    found = [(name, *nearest(x)) for name, x in kept]
    per = Counter()
    for _, c, d in found:
        per[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    limit = (1 << 63) - 1

    def fit(v):
        return v if v <= limit else None

    total = None if any(d > limit for _, _, d in found) else fit(sum(per.values()))
    bad = {c for _, c, d in found if d > limit}
    return [(n, c, fit(d), None if c in bad else fit(per[c]), total, digest[c]) for n, c, d in found]


def random_vectors(count, width, seed, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(width)] for _ in range(6)]
    return [(i, [c + rng.gauss(0, spread / 4) for c in rng.choice(centres)]) for i in range(count)]


VECTORS = "vec_id long, embedding array<double>, cluster string, x int, n int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, x, "c", 1, 2) for i, x in rows], VECTORS)


@pytest.mark.parametrize("width,k,spread", [(64, 40, 0.2), (6, 7, 1.0), (1, 3, 5.0), (64, 5, 3e5), (4, 3, 1e9)])
def test_clusters(spark, width, k, spread):
    rows = random_vectors(150, width, width + k, spread)
    rows += [(1, rows[1][1]), (1, rows[2][1]), (None, rows[3][1]), (None, rows[3][1])]  # repeated ids, no id
    rows += [(500, [0.0] * width), (501, [0.0] * width)]
    rows += [(600, None), (601, []), (602, [1.0] * (width + 1)), (603, [None] + [1.0] * (width - 1))]
    rows += [(604, [float("nan")] * width), (605, [float("-inf")] + [0.0] * (width - 1))]
    got = clustering.cluster(vectors_of(spark, rows), k=k, width=width)
    assert as_set(got.collect()) == as_set(plain_clusters(rows, k, 5, width))


def test_clusters_of_few_or_no_vectors(spark):
    rows = random_vectors(3, 64, 1)
    got = clustering.cluster(vectors_of(spark, rows)).collect()
    assert as_set(got) == as_set(plain_clusters(rows, 40, 5, 64))
    empty = clustering.cluster(vectors_of(spark, [(1, None)]))
    assert empty.count() == 0 and len(empty.columns) == 6


def test_distance_beyond_a_long_is_null(spark):
    rows = [(i, [v] + [0.0] * 63) for i, v in enumerate([0.0, 1.0, 9e18, -9e18, 5.0, 9e18])]
    got = clustering.cluster(vectors_of(spark, rows), k=2).collect()
    want = plain_clusters(rows, 2, 5, 64)
    assert as_set(got) == as_set(want)
    assert any(r["distance"] is None for r in got)


def test_transform_keeps_distances():
    rng = np.random.default_rng(3)
    a, b = rng.integers(-300, 300, (2, 5, 16))
    x, y = clustering.transform(a), clustering.transform(b)
    assert ((x - y) ** 2).sum() == 16 * ((a - b) ** 2).sum()
    signs = clustering.transform(np.eye(16, dtype=np.int64))[clustering.sequency(16)]
    assert [int((np.diff(r) != 0).sum()) for r in signs] == list(range(16))


def test_search_prefers_the_smaller_number():
    centroids = np.array([[5, 5], [1, 0], [0, 1], [1, 0]])
    number, distance = clustering.Search(centroids).nearest(np.array([[0, 0], [1, 0], [9, 9]]))
    assert number.tolist() == [1, 1, 0] and distance.tolist() == [1, 0, 32]


# --- manifest ---------------------------------------------------------------------------------


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes):
    """The root and, per node, its siblings level by level, as (left, right)."""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(where):
            run = nodes[at - at % 3 : at - at % 3 + 3]
            paths[i].append(("".join(run[: at % 3]), "".join(run[at % 3 + 1 :])))
        nodes = [H(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
        where = [at // 3 for at in where]
    return nodes[0], paths


def plain_audit(rows):
    sources = {}
    for doc, source, lang, n, text in rows:
        leaf = H(*map(enc, (doc, source, lang, n, text)))
        changed = leaf
        if doc is not None and zlib.crc32(str(doc).encode()) % 2 == 0 and text is not None:
            changed = H(*map(enc, (doc, source, lang, n, text.replace("\n", ""))))
        sources.setdefault(source, []).append((doc is not None, doc or 0, leaf, doc, changed))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    below = {s: climb([r[2] for r in sorted(sources[s], key=lambda r: r[:3])]) for s in order}
    root, tops = climb([below[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        for (_, _, leaf, doc, changed), path in zip(sorted(sources[s], key=lambda r: r[:3]), below[s][1]):
            node = changed
            for left, right in path + top:
                node = H(left, node, right)
            proof = H("".join(a + b for a, b in path + top))
            out.append((doc, leaf, below[s][0], root, proof, node, node == root))
    return out


DOC = "doc_id long, source string, lang string, n_chars long, text string, tree string, node string, levels int, block int"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "t", "n", 1, 2) for r in rows], DOC)


def test_manifest_of_odd_rows(spark):
    rows = [(i, None if i and i % 3 == 0 else "s", "en", len(t or ""), t) for i, t in ODD]
    rows += [(20, "", None, None, None), (21, "é", "en", -5, "-"), (22, "z", "", 0, ""), (23, "Z", None, 1, "a\n\nb\n")]
    rows += [(23, "Z", None, 1, "a\n\nb\n"), (23, "Z", None, 1, "other\n"), (None, "Z", None, 1, "x\n")]
    got = merkle.audit(docs_of(spark, rows))
    assert as_set(got.collect()) == as_set(plain_audit(rows))
    assert merkle.audit(docs_of(spark, [])).count() == 0
    alone = [(1, "s", "en", 3, "a\nb")]
    assert as_set(merkle.audit(docs_of(spark, alone)).collect()) == as_set(plain_audit(alone))


@pytest.mark.parametrize("levels", [1, 2, 5])
def test_manifest_of_many_sizes(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3**levels)
    rows, doc = [], 0
    for size in [*range(1, 12), 26, 27, 28, 81, 82, 243, 244, 600]:
        for _ in range(size):
            doc += 1
            rows.append((doc * 7 % 5003, f"src{size:03}", "en", doc, "line\n" * (doc % 3) + str(doc)))
    got = merkle.audit(docs_of(spark, rows))
    assert as_set(got.collect()) == as_set(plain_audit(rows))


def test_manifest_verifies_and_rejects(spark):
    rows = [(i, f"s{i % 3}", "en", 1, f"text {i}") for i in range(60)]
    held = merkle.manifest(docs_of(spark, rows))
    assert held.filter("size(proof) = 0").count() == 0
    changed = [(*r[:4], "forged") if r[0] == 7 else r for r in rows] + [(99, "s1", "en", 1, "new")]
    verdict = {r["doc_id"]: r["verified"] for r in merkle.verify(held, docs_of(spark, changed)).collect()}
    assert {d for d, good in verdict.items() if not good} == {7, 99}


# --- personal data ----------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(map(int, digits[::-1])):
        d = d * 2 if i % 2 else d
        total += d // 10 + d % 10
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and plain_luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_plain_spans_of_random_texts():
    rng = random.Random(5)
    parts = list("0123456789") * 2 + list(".@+- ()%_a-") + ["a@b.c", "1.2.3.4", "4111111111111111", "+1 (017) 555-7713", "256.", "é", "\n"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 60)))
        assert personal_data.base_spans(text) == plain_spans(text), text


def test_plain_spans_of_documents(texts):
    found = Counter()
    for text in texts.values():
        base, more = personal_data.find(text)
        assert base == plain_spans(text)
        assert not more
        found.update(s[0] for s in base)
    assert len(found) == 4


DISGUISED = [
    ("write to john.smith [at] mail [dot] example [dot] com today", "email", "john.smith [at] mail [dot] example [dot] com"),
    ("write to john dot smith at example dot com, please", "email", "john dot smith at example dot com"),
    ("jean (arobase) exemple (point) fr", "email", "jean (arobase) exemple (point) fr"),
    ("juan arroba ejemplo punto es", "email", "juan arroba ejemplo punto es"),
    ("hans at beispiel punkt de!", "email", "hans at beispiel punkt de"),
    ("x@example[.]com", "email", "x@example[.]com"),
    ("x&#64;example&#46;com", "email", "x&#64;example&#46;com"),
    ("mail jоhn@example.com now", "email", "jоhn@example.com"),
    ("mail ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ now", "email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("mail jo​hn@exam­ple.com now", "email", "jo​hn@exam­ple.com"),
    ("host 10 dot 0 dot 0 dot 1 is up", "ip", "10 dot 0 dot 0 dot 1"),
    ("host 10[.]0[.]0[.]1 is up", "ip", "10[.]0[.]0[.]1"),
    ("host one.two.three.four is up", "ip", "one.two.three.four"),
    ("call plus one five five five one two three four five six seven please", "phone", "plus one five five five one two three four five six seven"),
    ("call +４９ 30 1234567 please", "phone", "+４９ 30 1234567"),
    ("call +49–30–1234567", "phone", "+49–30–1234567"),
    ("card four one one one 1111 one one one one 1111", "card", "four one one one 1111 one one one one 1111"),
    ("CALL PLUS ONE-FIVE-FIVE 5551234 İ", "phone", "PLUS ONE-FIVE-FIVE 5551234"),
    ("card ٤١١١ ١١١١ ١١١١ ١١١١", "card", "٤١١١ ١١١١ ١١١١ ١١١١"),
]


@pytest.mark.parametrize("text,kind,span", DISGUISED)
def test_disguised(text, kind, span):
    base, more = personal_data.find(text)
    assert (kind, text.index(span), text.index(span) + len(span)) in more
    assert base == plain_spans(text)


@pytest.mark.parametrize(
    "text",
    [
        "we met at noon and at one point in the day the dot com boom ended",
        "look at the dot com, at that point two of three were gone",
        "one two three four, then five. Six or seven",
        "from 1990–1995 and in 3 point 5 ways",
        "a naïve façade — déjà vu in São Paulo, адрес и почта",
        "ſix ſeven ſix ſeven ſix ſeven İ 1 ſix two",
        "version 1.2.3 of 10 items, 50% of 3 (at) last",
        "",
    ],
)
def test_clean_prose_has_no_disguise(text):
    assert personal_data.find(text) == ([], [])


def test_disguise_beside_plain_keeps_plain():
    text = "a@b.com and c [at] d [dot] com, +1 (017) 555-7713 one day"
    base, more = personal_data.find(text)
    assert [text[s:e] for _, s, e in base] == ["a@b.com", "+1 (017) 555-7713"]
    assert [text[s:e] for _, s, e in more] == ["c [at] d [dot] com"]


def test_edits_map_back_character_by_character():
    """Composed edits against a version that carries the source range of every character along."""
    rng = random.Random(11)
    parts = ["ｊ", "a", "​", "о", " at ", " dot ", "[at]", "(.)", "one ", "two-", "three ", "seven", "1", "@", ".", "com", " ", "+", "４", "–"]
    for _ in range(1500):
        text = "".join(rng.choices(parts, k=rng.randint(1, 25)))
        chars, now, layers = [(i, i + 1) for i in range(len(text))], text, []
        for transduce in personal_data.TRANSDUCERS:
            layer = transduce(now)
            out, at = [], 0
            for a, b, start, end in layer.ranges:
                out += chars[at:start]
                out += [(chars[start][0], chars[end - 1][1])] * (b - a)
                at = end
            chars, now = out + chars[at:], layer.text
            layers.append(layer)
        assert len(chars) == len(now)
        for _ in range(5):
            if not now:
                break
            start = rng.randrange(len(now))
            end = rng.randint(start + 1, len(now))
            a, b = start, end
            for layer in reversed(layers):
                a, b, _ = layer.source(a, b)
            assert (a, b) == (chars[start][0], chars[end - 1][1])


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 200_000, "+1" + "(" * 300_000, "a-" * 200_000 + "@", "one " * 50_000, "@" * 100_000, "[at] " * 50_000, "x at y " * 40_000):
        assert len(personal_data.find(text)) == 2


def test_personal_query(spark, texts):
    rows = QUERIES["op13_personal_data"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_spans(texts[r["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest() and r["spans"] == joined
        counts = Counter(k for k, _, _ in base)
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [counts[k] for k in personal_data.KINDS]


def test_personal_odd(make_docs):
    docs = make_docs(*ODD, (30, "x [at] y [dot] de " * 3 + "q@w.er"))
    rows = personal_data.digests(personal_data.personal_data(docs)).collect()
    assert len(rows) == len(ODD) + 1
    last = next(r for r in rows if r["doc_id"] == 30)
    assert last["n_email"] == 1 and last["n_disguised"] == 3 and last["spans"].count("email:") == 4
    assert personal_data.personal_data(make_docs()).count() == 0
