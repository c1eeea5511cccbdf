"""Token counts, encoding and packing against the library of the vocabulary files."""

from __future__ import annotations

import hashlib
import json
import random
import zlib
from collections import defaultdict
from itertools import product

import numpy as np
import pytest
from tokenizers import Tokenizer, models

from ledgermap.llm.bpe_automaton import Automaton, automaton, decode, encode, round_trip
from ledgermap.llm.packing import MOST_OPEN, Encoder, Packer, pack
from ledgermap.llm.queries import BYTE_BPE, QUERIES, WORD_BPE
from ledgermap.llm.token_counts import count_words, merges, token_counts
from ledgermap.llm.words import WordStore
from tests.conftest import SF
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def word_bpe():
    return Tokenizer.from_file(WORD_BPE)


@pytest.fixture(scope="module")
def byte_bpe():
    return Tokenizer.from_file(BYTE_BPE)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def odd_words():
    pick = random.Random(5)
    for _ in range(300):
        yield "".join(pick.choice("abtheing'n1<|é") for _ in range(pick.randrange(1, 30)))
    for _ in range(200):
        codes = (range(33, 127), range(160, 0x250), range(0x300, 0x2FFF), range(0x10000, 0x1FFFF))
        yield "".join(chr(pick.choice(pick.choice(codes))) for _ in range(pick.randrange(1, 12)))


def test_words_against_the_library(word_bpe):
    compiled = automaton(WORD_BPE)
    for text in [*odd_words(), "aaaaaaa", "ΟΔΟΣ", "İstanbul", "a" * 3000, "<|endoftext|>x", "\x00\x01", "x\x1cy"]:
        want = ids_of(word_bpe, text)
        got = compiled.encode(text)
        assert got == want, text
        assert compiled.decode(np.array(got, np.int64)).decode() == word_bpe.decode(want, skip_special_tokens=False)
    words = [w for w in odd_words() if w.split() == [w]]
    assert count_words(words, merges(WORD_BPE)).tolist() == [len(ids_of(word_bpe, w)) for w in words]


def test_every_accepted_sequence_is_an_encoding():
    """The automaton's arcs agree with encoding the two tokens' text, for pairs at random."""
    compiled, pick = automaton(WORD_BPE), random.Random(3)
    plain = [(t, i) for t, i in compiled.vocab.items() if t.isascii() and t.isalpha()]
    for _ in range(2000):
        (a, left), (b, right) = pick.choice(plain), pick.choice(plain)
        joined = compiled.encode_piece(a + b + "zq")
        split = joined[:2] == [left, right]
        if split:
            assert compiled.step(left, right)


def gadgets(symbols, merges):
    """The automaton with all arcs written out, by applying each gadget to every state."""
    states, behind = [{s: 0 for s in symbols}], {s: 0 for s in symbols}
    for u, v in merges:
        if u in behind and v in behind and v in states[behind[u]]:
            q = behind[u]
            goal, copy = states[q][v], {t: to for t, to in states[q].items() if t != v}
            states.append(copy)
            for arcs in states:
                if u in arcs:
                    arcs[u + v] = goal
                    arcs[u] = len(states) - 1
            behind[u + v], behind[u] = goal, len(states) - 1
    return {t: set(states[q]) for t, q in behind.items()}


@pytest.mark.parametrize("seed", range(12))
def test_rows_equal_automata_written_out(tmp_path, seed):
    """Every arc of every state, and the encodings of all short words, for merges at random."""
    pick, symbols = random.Random(seed), ["a", "b", "c"]
    tokens, merges = list(symbols), []
    while len(merges) < 14:
        u, v = pick.choice(tokens), pick.choice(tokens)
        if u + v not in tokens:
            merges.append((u, v))
            tokens.append(u + v)
    vocab = {t: i for i, t in enumerate([*tokens, "aaaaaaaaaaaab"])}
    content = {"model": {"vocab": vocab, "merges": [f"{u} {v}" for u, v in merges], "end_of_word_suffix": None}, "added_tokens": []}
    (tmp_path / "bpe.json").write_text(json.dumps(content))
    compiled, library = Automaton(str(tmp_path / "bpe.json")), models.BPE(vocab, merges)
    arcs = gadgets(symbols, merges)
    for size in range(1, 9):
        for letters in product(symbols, repeat=size):
            want = [t.id for t in library.tokenize("".join(letters))]
            assert compiled.encode_piece("".join(letters)) == want
    assert {t for t in vocab if compiled.made[vocab[t]]} == set(arcs)
    for u, v in product(arcs, repeat=2):
        assert compiled.step(vocab[u], vocab[v]) == (v in arcs[u])


def test_token_counts_query(spark, texts, word_bpe):
    rows = QUERIES["op4_token_counts"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]]
        count = len(ids_of(word_bpe, text))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), count, count > 2048)


def test_round_trip_query(spark, texts, word_bpe):
    for r in QUERIES["op7_bpe_automaton"](spark, SF).collect():
        want = ids_of(word_bpe, texts[r["doc_id"]])
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        text = word_bpe.decode(want, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_odd_documents(make_docs, word_bpe):
    odd = make_docs(*ODD)
    want = sorted((str(i), len(ids_of(word_bpe, t)), len((t or "").encode())) for i, t in ODD)
    assert sorted((str(r[0]), r[2], r[1]) for r in token_counts(odd, WORD_BPE).collect()) == want
    assert sorted((str(r[0]), r[1]) for r in round_trip(odd, WORD_BPE).collect()) == [w[:2] for w in want]
    encoded = encode(odd, WORD_BPE)
    assert sorted((str(r[0]), r[1]) for r in encoded.collect()) == sorted((str(i), ids_of(word_bpe, t)) for i, t in ODD)
    decoded = decode(encoded, WORD_BPE).collect()
    texts = [word_bpe.decode(ids_of(word_bpe, t), skip_special_tokens=False) for _, t in ODD]
    assert sorted(r["text"] for r in decoded) == sorted(texts)
    assert decode(encoded.selectExpr("doc_id", "cast(null as array<int>) AS ids"), WORD_BPE).first()["text"] == ""
    for work in (token_counts, round_trip, encode):
        assert work(make_docs(), WORD_BPE).count() == 0


def test_encoder_equals_the_library(byte_bpe):
    pick, encode = random.Random(9), Encoder(BYTE_BPE)
    assert encode.fast
    parts = ["<|endoftext|>", "\n\n", "\n", " ", "  ", "a", "b1", "'ll", "é", "日本", "🙂", "\u3000", "\x1c", "\x85", "Σ", ".", "end", "<|", "|>"]
    cases = ["".join(pick.choices(parts, k=pick.randrange(40))) for _ in range(3000)]
    cases += ["a\n\n<|endoftext|>b", "end.\n\n<|endoftext|>\n\nstart", "<|endoftext|><|endoftext|>", " <|endoftext|> "]
    cases += ["x" + " " * 5000 + "y <|endoftext|>", "\n" * 3000, "ab" * 4000]
    for text in cases:
        assert encode(text).tolist() == ids_of(byte_bpe, text)


def test_encoder_of_another_kind_of_file_uses_the_library(word_bpe):
    encode = Encoder(WORD_BPE)
    assert encode.fast is None
    for text in ("One <|endoftext|> two", "", "Ünï\n\n"):
        assert encode(text).tolist() == ids_of(word_bpe, text)


def check_pieces(rows, documents, byte_bpe, window):
    """Every id lies in one piece, sequences have no gap, and none needs padding."""
    ids = sorted([*ids_of(byte_bpe, t), 0] for _, t in documents)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    if len(by_doc) == len(documents):
        built = [[x for r in sorted(v, key=lambda r: r["start"]) for x in r["ids"]] for v in by_doc.values()]
        assert sorted(built) == ids
    assert sum(r["length"] for r in rows) == sum(map(len, ids))
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == window or at & (at - 1) == 0


def test_packing_query(spark, docs, texts, byte_bpe):
    rows = pack(docs, BYTE_BPE).collect()
    check_pieces(rows, list(texts.items()), byte_bpe, 1024)
    digests = QUERIES["op10_packing"](spark, SF).collect()
    want = sorted((r["doc_id"], r["start"], r["doc_tokens"], zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in rows)
    assert sorted((r["doc_id"], r["start"], r["doc_tokens"], r["ids_crc32"]) for r in digests) == want


def test_packing_odd_documents(make_docs, byte_bpe):
    check_pieces(pack(make_docs(*ODD), BYTE_BPE, window=64).collect(), ODD, byte_bpe, 64)
    assert pack(make_docs(), BYTE_BPE).count() == 0


def brute_level(levels, size, window):
    """The level that the rule takes, by computing every sum; ties go to the fullest window."""
    best = None
    for level in range(window - size + 1):
        if level and not levels[level]:
            continue
        after = levels.copy()
        if level:
            after[level] -= 1
        if level + size < window:
            after[level + size] += 1
        total = int((after[1:window] ** 2).sum())
        if best is None or total <= best[0]:
            best = (total, level)
    return best[1]


def test_sum_of_squares_rule():
    pick, window, packer = random.Random(4), 16, Packer(16)
    for doc in range(600):
        size = pick.randrange(1, window)
        level = brute_level(packer.levels, size, window)
        before = packer.levels.copy()
        packer.add(doc, np.arange(size, dtype=np.uint32))
        if level:
            before[level] -= 1
        if level + size < window:
            before[level + size] += 1
        assert (packer.levels == before).all()
    packer.finish()
    assert packer.opened == 0
    assert sum(len(p[2]) for _, ps in packer.closed for p in ps) == sum(len(p[2]) for _, ps in packer.closed for p in ps)


def test_open_windows_stay_bounded():
    packer = Packer(1024)
    for doc in range(3 * MOST_OPEN):
        packer.add(doc, np.zeros(513, np.uint32))
        assert packer.opened < MOST_OPEN
    packer.finish()
    assert sum(len(p[2]) for _, ps in packer.closed for p in ps) == 3 * MOST_OPEN * 513


def test_store_starts_afresh_without_changing_results():
    store = WordStore(lambda words: [[len(w)] for w in words], most=3)
    for texts in ([["a", "bb"], ["ccc"]], [["dddd", "a"]], [["eeeee", "a", "a"]]):
        codes, counts = store.look_up(texts)
        assert store.flatten(codes)[0].tolist() == [len(w) for t in texts for w in t]
        assert counts.tolist() == [len(t) for t in texts]
