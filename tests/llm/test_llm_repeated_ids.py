"""Decisions about rows of which several share an id."""

from __future__ import annotations

from ledgermap.llm.exact_dedup import drop_exact_duplicates
from ledgermap.llm.near_dedup import drop_near_duplicates

WORDS = " ".join(f"w{i}" for i in range(100))


def left(drop, docs):
    return sorted(((r["doc_id"], r["text"]) for r in drop(docs).collect()), key=repr)


def test_copy_under_an_id_that_stays_goes(make_docs):
    docs = make_docs((1, "one  two"), (2, "one two"), (2, "else"), (2, "else"), (3, "a b"), (3, "a  b"), (None, None), (None, ""))
    assert left(drop_exact_duplicates, docs) in (
        [(1, "one  two"), (2, "else"), (3, "a  b"), (None, empty)] for empty in (None, "")
    )


def test_near_copy_under_an_id_that_stays_goes(make_docs):
    docs = make_docs((1, WORDS), (2, WORDS + " more"), (2, "something else of five words"), (2, "something else of five words"))
    assert left(drop_near_duplicates, docs) == [(1, WORDS), (2, "something else of five words")]
