"""Language identification with averaged hashed subword embeddings.

Subwords are the three- and four-letter pieces of words with their borders marked, hashed into a
fixed number of buckets. A document is the average of its subwords' embeddings, over its whole
text; a linear softmax on top names the language. Both are trained by stochastic gradient descent
in numpy on a bounded sample of labelled documents. One part of the sample is kept back to set the
softmax temperature, so that scores are probabilities, and the score below which a prediction is
rejected.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermap.llm.common import arrow_rows, text_key, training_part

BUCKETS = 1 << 15
DIMENSIONS = 16
#: The labelled documents that training looks at, by the shares of their languages; the languages it
#: learns at most, and the documents that each gives at least. Together they bound the sample.
SAMPLE = 3000
LANGUAGES = 60
LEAST_OF_LANGUAGE = 50
EPOCHS = 6
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, 0 where it is no letter."""
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for code in range(sys.maxunicode + 1):
        c = chr(code)
        if c.isalpha():
            table[code] = ord(c.lower()[0])
    return table


def subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of every subword."""
    joined = "\n" + "\n".join(texts) + "\n"
    codes = _letters()[np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)]
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    owner = np.repeat(np.arange(len(texts) + 1), np.diff(np.concatenate([[0], ends, [len(codes)]])))
    # one border between words is enough
    keep = (codes > 0) | np.concatenate([[True], codes[:-1] > 0])
    codes, owner = codes[keep].astype(np.uint64), owner[keep]
    found, owners = [], []
    for size in (3, 4):
        count = len(codes) - size + 1
        if count <= 0:
            continue
        inner = codes[1 : 1 + count] > 0
        value = codes[:count] + np.uint64(size)
        for k in range(1, size):
            value = value * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + count]
            if 1 < k < size - 1:
                inner &= codes[k : k + count] > 0
        value ^= value >> np.uint64(32)
        found.append((value[inner] * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(49)).astype(np.int64))
        owners.append(owner[1 : 1 + count][inner])
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found), np.concatenate(owners)


@dataclass
class Model:
    """``weights[bucket, language]`` is an embedding times the softmax layer; ``bias`` comes on top."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        bucket, owner = subwords(texts)
        count = np.bincount(owner, minlength=len(texts))
        total = [np.bincount(owner, weights=self.weights[bucket, k], minlength=len(texts)) for k in range(len(self.languages))]
        logits = np.array(total).T / np.maximum(count, 1)[:, None] + self.bias
        chance = _softmax(logits / self.temperature)
        best = chance.argmax(axis=1)
        names = [self.languages[b] if c else UNDETERMINED for b, c in zip(best, count)]
        return names, np.where(count > 0, chance.max(axis=1), 0.0)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[str], seed: int = 7) -> Model:
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    layer = rng.normal(0, 0.1, (DIMENSIONS, len(languages)))
    bias = np.zeros(len(languages))
    y = np.array([languages.index(x) for x in labels])
    order = rng.permutation(len(bags))
    held, train = order[: len(order) // 5], order[len(order) // 5 :]
    steps, step = EPOCHS * len(train), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(train):
            rate = 2.0 * (1 - step / steps) + 0.02
            step += 1
            bucket, share = bags[i]
            mean = share @ embedding[bucket]
            error = _softmax(mean @ layer + bias)
            error[y[i]] -= 1
            back = layer @ error
            layer -= rate * np.outer(mean, error)
            bias -= 0.1 * rate * error
            embedding[bucket] -= (rate * len(bucket) ** 0.5 * share)[:, None] * back
    weights = (embedding @ layer).astype(np.float32)
    logits = np.array([share @ weights[bucket] + bias for bucket, share in (bags[i] for i in held)]).reshape(-1, len(languages))
    temperature, threshold = 1.0, 0.0
    if len(held):
        def loss(t: float) -> float:
            return -np.log(_softmax(logits / t)[np.arange(len(held)), y[held]] + 1e-12).mean()

        temperature = min((float(t) for t in np.geomspace(0.1, 10, 41)), key=loss)
        chance = _softmax(logits / temperature)
        right = chance.argmax(axis=1) == y[held]
        score = chance.max(axis=1)
        # the lowest score from which on held-back predictions are right in 95 of 100 cases
        for t in np.sort(score):
            if right[score >= t].mean() >= 0.95:
                threshold = float(t)
                break
    return Model(languages, weights, bias, float(temperature), min(threshold, 0.9))


def train(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from a bounded sample of the training part, chosen by a hash of ids and texts.

    Each of the ``LANGUAGES`` most frequent languages gives its share of ``sample``, and
    ``LEAST_OF_LANGUAGE`` documents at least, or all it has; rarer languages are not learned. Rows with
    the same id, text and language count once.
    """
    labelled = docs.filter(training_part(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    )
    often = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()}
    every = sum(often.values())
    quotas = [(lang, max(LEAST_OF_LANGUAGE, sample * n // every)) for lang, n in often.items()]
    keys = labelled.select("doc_id", "lang", text_key(F.col("text")).alias("key")).distinct()
    dealt = F.broadcast(docs.sparkSession.createDataFrame(quotas, "lang string, quota long"))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "key"), "doc_id", "key")
    most = max((q for _, q in quotas), default=0)
    # each task keeps no more rows of a language than the largest quota
    ranked = keys.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= most)
    chosen = ranked.join(dealt, "lang").filter("rank <= quota").select("doc_id", "lang", "key")
    rows = labelled.withColumn("key", text_key(F.col("text"))).join(F.broadcast(chosen), ["doc_id", "lang", "key"], "left_semi")
    rows = rows.dropDuplicates(["doc_id", "lang", "key"]).select("doc_id", "lang", "text")

    def work(columns: list, part: int) -> dict:
        bags = []
        for text in columns[2]:
            bucket, count = np.unique(subwords([text])[0], return_counts=True)
            bags.append((bucket.astype("<i4").tobytes(), count.astype("<i4").tobytes()))
        return {"doc_id": columns[0], "lang": columns[1], "bucket": [b for b, _ in bags], "n": [n for _, n in bags]}

    found = arrow_rows(rows, work, "doc_id long, lang string, bucket binary, n binary").collect()
    found = sorted((r for r in found if r["bucket"]), key=lambda r: (r["doc_id"], r["lang"], bytes(r["bucket"]), bytes(r["n"])))
    bags = []
    for r in found:
        count = np.frombuffer(r["n"], "<i4").astype(np.float64)
        bags.append((np.frombuffer(r["bucket"], "<i4"), count / count.sum()))
    return _fit(bags, [r["lang"] for r in found])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of every row.

    ``lang_pred`` is a learned language, or ``und`` with score 0 where the text is null or has no
    letter (or nothing was learned). ``rejected`` marks scores below the calibrated threshold.
    Only the text is looked at. Repeated rows and null ids are allowed; a null id is not held out.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(~training_part(F.col(id_col)), F.lit(False)).alias("held_out"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )

    def work(columns: list, part: int) -> dict:
        names, scores = model.predict(columns[2])
        rejected = (scores < model.threshold) | (np.array(names) == UNDETERMINED)
        return {"doc_id": columns[0], "held_out": columns[1], "lang_pred": names, "score": scores, "rejected": rejected}

    schema = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"
    return arrow_rows(rows, work, schema)
