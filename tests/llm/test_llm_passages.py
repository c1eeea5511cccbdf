"""Toxic passages made of words that stood before."""

from __future__ import annotations

import math

import pytest

from ledgermap.llm import toxicity

WORDS = {"aaaa": 3.0, "bbbb": 3.0, "cccc": 3.0}
PLAIN = " x" * 3000


@pytest.fixture
def model():
    # the law takes log(0.01 * tokens) off a segment's score
    return toxicity.Model(dict(WORDS), toxicity.GAP, 1.0, 0.01, 0.8, -4.0)


def test_repeated_passages_are_found(model, make_docs):
    docs = make_docs((1, f"aaaa bbbb cccc{PLAIN} aaaa bbbb cccc"), (2, f"aaaa{PLAIN} bbbb{PLAIN} cccc{PLAIN} cccc bbbb aaaa"))
    found = sorted((r["doc_id"], r["first_token"], r["passage"]) for r in toxicity.passages(docs, model).collect())
    assert found == [(1, 0, "aaaa bbbb cccc"), (1, 3003, "aaaa bbbb cccc"), (2, 9003, "cccc bbbb aaaa")]
    assert {r["doc_id"]: r["n_passages"] for r in toxicity.score(docs, model).collect()} == {1: 2, 2: 1}


def test_passage_reaches_to_its_last_repeat(model, make_docs):
    row = toxicity.passages(make_docs((1, "y aaaa bbbb x aaaa z")), model).first()
    assert (row["first_token"], row["last_token"], row["passage"]) == (1, 4, "aaaa bbbb x aaaa")
    assert math.isclose(row["segment_score"], 9.0 + toxicity.GAP)


def test_repeats_add_evidence_and_never_take_it(model):
    def evidence(text, length=500):
        return model.evidence([s for x in model.segments(toxicity.tokens(text)) for s in x.parts], length)

    once = evidence("aaaa")
    assert once > 0
    assert evidence("aaaa aaaa aaaa") > evidence("aaaa aaaa") > once
    assert evidence("aaaa aaaa aaaa") < evidence("aaaa bbbb cccc")
    far = " x" * 140  # the gap takes nearly all that an occurrence adds
    assert evidence(f"aaaa{far} " * 30) >= once


def test_many_segments_take_linear_time():
    places = list(range(0, 20_000_000, 1000))
    assert len(toxicity.maximal_segments(places, [1.0] * len(places), -0.02)) == len(places)
