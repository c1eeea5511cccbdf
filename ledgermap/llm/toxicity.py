"""Toxic passages as maximum-scoring segments of token log-odds.

Training counts, over labelled documents, in how many toxic and clean ones a word or a word
beginning stands. Its log-odds take the counts of both classes together as an informative
Dirichlet prior, and count less a standard deviation. Words and beginnings that score well above
zero form the lexicon. Every other word has its own log-odds as well, at most slightly below zero,
so that ordinary words end a passage; words that training did not see often enough score that
slight loss. A scan over the tokens of a text, linear in its length, finds all maximal segments;
every occurrence of a word scores. Only the evidence discounts repeats: a second scan of each
segment gives the n-th occurrence of a word in it one n-th of its score.

The best scores that chance brings about in clean text follow an extreme-value law. Its decay is
fitted on labelled clean documents kept back, by maximum likelihood with what log-likelihood ratios
would give (one) as prior; its constant is then the least that no score of theirs exceeds. What the
segments of a document score beyond that law is its evidence, and a logistic curve makes it a
probability.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import repeat
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermap.llm.common import arrow_rows, drop_stored, ship, stored, training_part

#: The most labelled documents that training looks at; a fifth of them calibrates.
SAMPLE = 16_000
#: The most features of the lexicon; those with the highest standardised log-odds.
LEXICON = 50_000
PREFIXES = (4, 5, 6, 7)
#: Least documents with a feature, and least log-odds in standard deviations.
LEAST_DOCUMENTS, LEAST_Z = 3, 3.0
#: Least lower bound (log-odds less a standard deviation) of a feature of the lexicon.
LEAST_SCORE = 2.0
#: Weight of the prior in documents.
PRIOR = 10.0
THRESHOLD = 0.7
#: Score of a token of which training knows nothing; other tokens outside the lexicon score between
#: this and the floor.
GAP = -0.02
FLOOR = -1.0
#: The most words outside the lexicon with a score of their own, the most frequent ones, and the
#: least documents with one.
ORDINARY, LEAST_ORDINARY = 30_000, 10
#: Words whose score a worker keeps.
KNOWN = 1_000_000
#: Weight, in documents, of the prior of the law's decay, and the decays that are tried.
DECAY_PRIOR = 10.0
DECAYS = np.arange(0.2, 3.01, 0.02)
#: Evidence beyond this says nothing more, so that very toxic documents do not flatten the curve.
MOST_EVIDENCE = 15.0
WORD = re.compile(r"[^\W\d_]+")


def tokens(text: str) -> list[str]:
    return WORD.findall(text.lower())


def features(word: str) -> list[str]:
    """The word itself, and its beginnings, marked by a star."""
    return [word, *[word[:n] + "*" for n in PREFIXES if len(word) > n]]


def maximal_segments(
    places: Sequence[int], scores: Sequence[float], gap: float | Sequence[float]
) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, as first token, last token and score.

    ``places`` are the tokens with a positive score; those between them score ``gap`` each (below
    0), or all those before a place and behind the one before it have its total in ``gap``. Each candidate keeps the running total before and after it; a new one joins with the last one
    whose total before is lower, if its own total after is higher. Each also keeps which one that
    is, so that a search passes over every candidate once.
    """
    found: list[list[float]] = []  # first, last, total before, total after, the last with a lower total before
    total, at = 0.0, 0
    between = repeat(None) if isinstance(gap, float) else gap
    for place, score, lost in zip(places, scores, between):
        before = total + (gap * (place - at) if lost is None else lost)
        total, at = before + score, place + 1
        k = len(found) - 1
        while k >= 0 and found[k][2] >= before:
            k = found[k][4]
        segment = [place, place, before, total, k]
        while k >= 0 and found[k][3] < total:
            segment = [found[k][0], place, found[k][2], total, found[k][4]]
            del found[k:]
            k = segment[4]
        found.append(segment)
    return [(int(a), int(b), after - before) for a, b, before, after, _ in found]


class _Scores(dict):
    """Scores of words, worked out when a word first comes up."""

    def __init__(self, model: Model) -> None:
        self.model = model

    def __missing__(self, word: str) -> float:
        score = self[word] = self.model.word_score(word)
        return score


class Segment(NamedTuple):
    first: int
    last: int
    score: float
    #: Scores of the maximal segments within it when repeats are discounted.
    parts: list[float]


@dataclass
class Model:
    lexicon: dict[str, float]
    gap: float
    #: Parameters of the extreme-value law: P(S >= x) = 1 - exp(-k n exp(-decay x)).
    decay: float
    k: float
    slope: float
    offset: float

    #: Scores of words outside the lexicon.
    ordinary: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.starts = {f.rstrip("*")[:3] for f in self.lexicon}
        self.known = _Scores(self)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "known": None}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.known = _Scores(self)

    def word_score(self, word: str) -> float:
        if word[:3] in self.starts:
            score = max((self.lexicon.get(f, 0.0) for f in features(word)), default=0.0)
            if score > 0:
                return score
        return self.ordinary.get(word, self.gap)

    def segments(self, words: list[str]) -> list[Segment]:
        """All maximal segments; every occurrence of a word scores."""
        if len(self.known) > KNOWN:
            self.known.clear()
        every = np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))
        where = np.flatnonzero(every > 0)
        if not len(where):
            return []
        upto = np.concatenate([[0.0], np.cumsum(np.minimum(every, 0.0))])
        between = np.diff(upto[where], prepend=0.0).tolist()
        places, scores = where.tolist(), every[where].tolist()
        found, at = [], 0
        for first, last, score in maximal_segments(places, scores, between):
            start = bisect_left(places, first, at)
            at = bisect_right(places, last, start)
            times, less = Counter(), []
            for place, full in zip(places[start:at], scores[start:at]):
                times[words[place]] += 1
                less.append(full / times[words[place]])
            parts = [s for _, _, s in maximal_segments(places[start:at], less, between[start:at])]
            found.append(Segment(first, last, score, parts))
        return found

    def excess(self, score: float, length: int) -> float:
        """How far a segment lies above what the law expects of a text of this length."""
        return self.decay * score - math.log(max(self.k * length, 1e-12))

    def weight(self, parts: list[float], length: int) -> float:
        """What the parts score beyond the law; a segment with any is a significant passage."""
        return sum(max(self.excess(s, length), 0.0) for s in parts)

    def evidence(self, parts: list[float], length: int) -> float:
        return min(self.weight(parts, length), MOST_EVIDENCE)

    def chance(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-(self.slope * evidence + self.offset)))

    def score(self, text: str) -> float:
        words = tokens(text)
        return self.chance(self.evidence([s for x in self.segments(words) for s in x.parts], len(words)))


def _bounds(counts: dict[str, tuple[float, float]], toxic: float, clean: float) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds with an informative Dirichlet prior: less their standard deviation, and in standard deviations."""
    y = np.array(list(counts.values()), dtype=np.float64).reshape(-1, 2)
    background = (y.sum(axis=1) + 0.5) / (toxic + clean + 1)
    a1, a0 = PRIOR * background, PRIOR * background
    odds1 = np.log((y[:, 0] + a1) / (toxic + PRIOR - y[:, 0] - a1 + 1e-9))
    odds0 = np.log((y[:, 1] + a0) / (clean + PRIOR - y[:, 1] - a0 + 1e-9))
    deviation = np.sqrt(1 / (y[:, 0] + a1) + 1 / (y[:, 1] + a0))
    return odds1 - odds0 - deviation, (odds1 - odds0) / deviation


def _lexicon(counts: dict[str, tuple[float, float]], toxic: float, clean: float) -> dict[str, float]:
    """Features that score well above zero."""
    names = list(counts)
    bound, z = _bounds(counts, toxic, clean)
    often = np.array([y1 for y1, _ in counts.values()]) >= LEAST_DOCUMENTS
    good = np.flatnonzero((z >= LEAST_Z) & often & (bound >= LEAST_SCORE))
    good = sorted(good.tolist(), key=lambda i: (-z[i], names[i]))[:LEXICON]
    return {names[i]: float(bound[i]) for i in good}


def _ordinary(counts: dict[str, tuple[float, float]], toxic: float, clean: float) -> dict[str, float]:
    """Scores of all other words, which may end a passage but not begin one."""
    bound, _ = _bounds(counts, toxic, clean)
    return dict(zip(counts, np.clip(bound, FLOOR, GAP).tolist()))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton's method, with two smoothed targets against separation."""
    n1, n0 = y.sum(), (1 - y).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    w = np.array([0.5, -2.0])
    design = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ w))
        gradient = design.T @ (p - target) + 1e-3 * w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        move = np.linalg.solve(hessian, gradient)
        w -= np.clip(move, -1, 1)
        if np.abs(move).max() < 1e-6:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """Learn from at most ``sample`` labelled documents of the training part, chosen by hash.

    Rows without a label, text or id teach nothing; of several labels of one id the highest holds.
    Copies and near copies, which share their least or greatest shingle hash, count once.
    """
    known = (
        labels.filter(training_part(F.col("doc_id")) & F.col(label_col).isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("_llm_id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("_llm_label"))
        .join(docs.select(F.col(id_col).cast("long").alias("_llm_id")).distinct(), "_llm_id", "left_semi")
        .orderBy(F.xxhash64("_llm_id"), "_llm_id")
        .limit(sample)
    )
    rows = docs.filter(F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text")
    )
    rows = rows.join(F.broadcast(known), F.col("_id") == F.col("_llm_id")).select(
        F.col("_id").alias("doc_id"), F.col("_llm_label").alias("toxic"), (F.xxhash64("_id", F.lit(3)) % 5 == 0).alias("held"), "text"
    )

    def marks(columns: list, part: int) -> dict:
        least, greatest = [], []
        for text in columns[3]:
            words = tokens(text)
            hashes = [
                hashlib.blake2b(" ".join(words[i : i + 5]).encode(), digest_size=7).digest()
                for i in range(max(len(words) - 4, 1))
            ]
            least.append(min(hashes).hex())
            greatest.append(max(hashes).hex())
        return {"doc_id": columns[0], "toxic": columns[1], "held": columns[2], "least": least, "greatest": greatest, "text": columns[3]}

    marked = arrow_rows(rows, marks, "doc_id long, toxic int, held boolean, least string, greatest string, text string")
    marked = stored(marked)
    first = marked.drop("text").groupBy("least", "toxic", "greatest").agg(F.min("doc_id").alias("doc_id"))
    first = first.groupBy("least", "toxic").agg(F.min_by("greatest", "doc_id").alias("greatest"), F.min("doc_id").alias("doc_id"))
    first = stored(first.groupBy("greatest", "toxic").agg(F.min("doc_id").alias("doc_id")).select("doc_id"))
    single = marked.join(F.broadcast(first), "doc_id", "left_semi").dropDuplicates(["doc_id"])

    learn = single.filter("NOT held").select("toxic", "text")

    def count(columns: list, part: int) -> dict:
        seen = (Counter(), Counter())
        for toxic, text in zip(*columns):
            seen[1 if toxic > 0 else 0].update({f for w in set(tokens(text)) for f in features(w)})
        names = list(seen[0] | seen[1])
        return {"feature": names, "y1": [seen[1][f] for f in names], "y0": [seen[0][f] for f in names]}

    totals = learn.agg(F.sum((F.col("toxic") > 0).cast("int")), F.sum((F.col("toxic") <= 0).cast("int"))).first()
    toxic, clean = float(totals[0] or 0), float(totals[1] or 0)
    totalled = stored(
        arrow_rows(learn, count, "feature string, y1 long, y0 long")
        .groupBy("feature")
        .agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0"))
        .filter(F.col("y1") + F.col("y0") >= LEAST_DOCUMENTS)
    )
    # what can't reach the lexicon: relatively no more frequent in toxic documents than in clean ones
    often = totalled.filter(F.col("y1") >= LEAST_DOCUMENTS).filter(
        F.col("y1") * F.lit(clean + 1) > F.lit(2 * (toxic + 1)) * F.col("y0")
    )
    whole = totalled.filter(~F.col("feature").endswith("*") & (F.col("y1") + F.col("y0") >= LEAST_ORDINARY))
    whole = whole.orderBy((F.col("y1") + F.col("y0")).desc(), "feature").limit(ORDINARY)
    lexicon, ordinary = (
        make({r["feature"]: (r["y1"], r["y0"]) for r in rows.collect()}, toxic, clean)
        for make, rows in ((_lexicon, often), (_ordinary, whole))
    )
    drop_stored(totalled)
    model = Model(lexicon, GAP, 1.0, 1e-6, 1.0, -3.0, ordinary)

    held = single.filter("held").select("toxic", "text")

    def scan(columns: list, part: int) -> dict:
        lengths, best = [], []
        for text in columns[1]:
            words = tokens(text)
            lengths.append(len(words))
            best.append([float(s) for x in model.segments(words) for s in x.parts])
        return {"toxic": columns[0], "length": lengths, "scores": best}

    seen = arrow_rows(held, scan, "toxic int, length long, scores array<double>").collect()
    drop_stored(first)
    drop_stored(marked)
    return _calibrate(model, [(r["toxic"] > 0, r["length"], r["scores"]) for r in seen])


def _decay(best: np.ndarray, lengths: np.ndarray) -> float:
    """The law's decay from the best score of each clean document and its length.

    Scores below the least one of the lexicon only tell that there was none. For each decay the
    likeliest constant is known, so only the decay is searched; its prior is a gamma density with
    its top at one.
    """
    over = best >= LEAST_SCORE
    heights, n = np.where(over, best, LEAST_SCORE), lengths + 1.0
    m = int(over.sum())

    def likelihood(decay: float) -> float:
        mass = float(np.sum(n * np.exp(-decay * heights)))
        fit = m * math.log(decay * max(m, 1e-12) / mass) - decay * float(heights[over].sum()) if m else 0.0
        return fit + DECAY_PRIOR * (math.log(decay) - decay)

    return float(max(DECAYS.tolist(), key=likelihood))


def _calibrate(model: Model, seen: list[tuple[bool, int, list[float]]]) -> Model:
    """Set the extreme-value law on clean documents, and the logistic curve on all."""
    clean = [x for x in seen if not x[0]]
    if clean and model.lexicon:
        mean = sum(n for _, n, _ in clean) / len(clean) + 1
        best = np.array([max(s, default=0.0) for _, _, s in clean])
        model.decay = _decay(best, np.array([n for _, n, _ in clean]))
        # the highest constant that the clean documents ask for at any score
        for x in np.arange(LEAST_SCORE, max(model.lexicon.values()) + 1, 0.5):
            exceeding = (np.sum(best >= x) + 0.5) / (len(clean) + 1)
            model.k = max(model.k, -math.log(1 - exceeding) * math.exp(model.decay * x) / mean)
    if seen and model.lexicon:
        evidence = np.array([model.evidence(ss, n) for _, n, ss in seen])
        model.slope, model.offset = _logistic(evidence, np.array([float(t) for t, *_ in seen]))
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_passages`` of every row, from its text alone.

    A null text counts as empty; an empty one has no passage and gets the lowest score. Repeated
    rows, null ids (not held out) and further columns of any name are allowed.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(~training_part(F.col(id_col)), F.lit(False)).alias("held_out"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )

    def work(columns: list, part: int) -> dict:
        scores, passages = [], []
        for text in columns[2]:
            words = tokens(text)
            segments = model.segments(words)
            scores.append(model.chance(model.evidence([s for x in segments for s in x.parts], len(words))))
            passages.append(sum(model.weight(x.parts, len(words)) > 0 for x in segments))
        predicted = [int(s >= threshold) for s in scores]
        return {"doc_id": columns[0], "held_out": columns[1], "score": scores, "predicted": predicted, "n_passages": passages}

    return arrow_rows(rows, work, "doc_id long, held_out boolean, score double, predicted int, n_passages int")


def passages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, first_token, last_token, segment_score, excess, passage``: one row for each significant passage.

    A passage ends with its last scoring word, new or repeated. Texts that are null, empty or of no
    significant passage give no row.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def work(columns: list, part: int) -> dict:
        out: list[tuple] = []
        for doc, text in zip(*columns):
            words = tokens(text)
            for a, b, s, parts in model.segments(words):
                if (excess := model.weight(parts, len(words))) > 0:
                    out.append((doc, a, b, s, excess, " ".join(words[a : b + 1])))
        names = ("doc_id", "first_token", "last_token", "segment_score", "excess", "passage")
        return dict(zip(names, zip(*out))) if out else {n: [] for n in names}

    return arrow_rows(rows, work, "doc_id long, first_token int, last_token int, segment_score double, excess double, passage string")


def keep_clean(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows predicted toxic; all columns stay. One pass, no shuffle."""
    ship(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            keep = [model.score(t.as_py() or "") < THRESHOLD for t in texts]
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
