"""Near duplicates by bottom-k sketches from one hash function.

A document is the set of its five-word shingles, each hashed once. Its sketch keeps the least
hashes. Two documents at the threshold hold at least ``need`` of their sketches in common (for sets
that the sketch holds whole this is certain, else it fails with a chance of about 4.6e-6). So values
that only one sketch holds are put aside, a document that is left with fewer than that has no partner,
and of the others each is listed under its rarest values only, all but ``need - 1`` of them: whatever
two sketches share, the rarest shared value is among those that both list. What many documents quote
is listed only for documents that consist of little else. Sketches of the union filter the
candidates, and the full sets verify them.

Documents with equal sets are one node. In a few rounds every list compares its members with one of
them that leads, another one each time, which joins most groups of copies without looking at their
pairs. After that only members of different components are compared, by size class and in blocks of
bounded size; no list is cut short.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermap.llm.common import _arrow, arrow_rows, drop_stored, stored, text_key
from ledgermap.llm.exact_dedup import keep_rows

WORDS = 5
#: Link when 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Hashes of a sketch.
SKETCH = 64
#: Pairs whose union sketch is below this share (4.6 standard deviations below the threshold) go.
LEAST_ESTIMATE = 0.5
#: Rounds in which each list compares its members with a leader.
ROUNDS = 2
#: Hashes of the longer sketches, of which 32 bits are kept, and the least share of them that two at
#: the threshold have in common (5.5 standard deviations below it, and below 256 - 0.25 * 341 where
#: one is a whole set). Two whole sets are compared by the threshold itself.
LONG_SKETCH = 256
LEAST_LONG_SHARE = 0.6
#: Members of a block; a task compares two blocks at a time, and looks at so many hashes at a time.
BLOCK = 512
COLUMNS = 8192

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def shingles(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    words = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    digest = xxhash.xxh3_64_intdigest
    out = []
    for own in words:
        if not own:
            out.append(np.empty(0, np.int64))
            continue
        hashes = np.fromiter(map(digest, own), np.uint64, len(own))
        size = min(WORDS, len(own))
        count = len(own) - size + 1
        value = np.full(count, size, np.uint64)
        for k in range(size):
            value = (value ^ hashes[k : k + count]) * _MIX[0]
            value ^= value >> np.uint64(29)
        value = (value ^ (value >> np.uint64(30))) * _MIX[1]
        value = (value ^ (value >> np.uint64(27))) * _MIX[2]
        out.append(np.unique((value ^ (value >> np.uint64(31))).view(np.int64)))
    return out


def _sketches(docs: DataFrame, id_col: str, text_col: str, keys: bool = False) -> DataFrame:
    """``row, doc_id, key, n, sig, sketch``; ``sig`` names the set, ``sketch`` its least hashes as bytes."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (text_key(F.col(text_col)) if keys else F.lit(None).cast("binary")).alias("key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )

    def work(columns: list, part: int) -> dict:
        sets = shingles(columns[2])
        return {
            "doc_id": columns[0],
            "key": columns[1],
            "n": [len(s) for s in sets],
            "sig": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
            "sketch": [s[:SKETCH].tobytes() for s in sets],
        }

    found = arrow_rows(rows, work, "doc_id long, key binary, n long, sig binary, sketch binary")
    return found.select(F.monotonically_increasing_id().alias("row"), "*")


def need(n):
    """How many values of its sketch a document of ``n`` shingles shares with any partner.

    The intersection holds three quarters of the greater set. A sketch that is a whole set loses
    none of it to a partner of at most so many shingles, and keeps 42 with the largest one possible
    (64 - 0.25 * 85). Of two larger sets the union sketch holds half or more.
    """
    whole = F.least(F.ceil(n * PERCENT / 100), F.lit(42))
    return F.when(n <= SKETCH, whole).otherwise(int(SKETCH * LEAST_ESTIMATE)).cast("int")


def _values(sketches: DataFrame) -> DataFrame:
    """``value, node``: every value of every sketch."""

    def work(columns: list, part: int) -> dict:
        values = [np.frombuffer(s, np.int64) for s in columns[1]]
        return {
            "value": np.concatenate(values) if values else [],
            "node": np.repeat(np.array(columns[0], np.int64), [len(v) for v in values]),
        }

    return arrow_rows(sketches.select("node", "sketch"), work, "value long, node long")


def _listed(sketches: DataFrame) -> DataFrame:
    """``sketches`` that may have a partner, with the values that list them, rarest first."""
    values = _values(sketches)
    shared = values.groupBy("value").agg(F.count("*").alias("often")).filter("often > 1")
    # a sketch bounds the values of a node
    own = values.join(shared, "value").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("often", "value"))).alias("shared"))
    found = sketches.join(own, "node").withColumn("need", need(F.col("n"))).filter(F.size("shared") >= F.col("need"))
    rarest = F.slice("shared", F.lit(1), F.size("shared") - F.col("need") + 1)
    return found.withColumn("listed", F.transform(rarest, lambda v: v["value"])).drop("shared", "need")


def _similar_size(a: str, b: str):
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _estimate(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the union's least hashes that both sketches hold."""
    merged = np.sort(np.concatenate([a, b]))
    twice = merged[1:] == merged[:-1]
    both = int(np.count_nonzero(twice))
    union = len(merged) - both
    if union > SKETCH and max(len(a), len(b)) == SKETCH:
        # the sketches know no more than so many hashes of the union
        last = int(np.searchsorted(np.cumsum(~twice), SKETCH))
        both, union = int(np.count_nonzero(twice[: last + 1])), SKETCH
    return both / union


def _passing(edges: DataFrame, sketches: DataFrame) -> DataFrame:
    """Edges ``a, b`` whose sketches let them be similar."""
    left = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"))
    right = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"))

    def work(columns: list, part: int) -> dict:
        keep = [
            (a, b)
            for a, b, x, y in zip(*columns)
            if _estimate(np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)) >= LEAST_ESTIMATE
        ]
        return {"a": [a for a, _ in keep], "b": [b for _, b in keep]}

    joined = edges.join(left, "a").join(right, "b").select("a", "b", "sketch_a", "sketch_b")
    return arrow_rows(joined, work, "a long, b long")


def _verified(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges whose full sets reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("hashes_a"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hashes_b"))

    def work(columns: list, part: int) -> dict:
        keep = []
        for a, b, x, y in zip(*columns):
            x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            if both * 100 >= PERCENT * (len(x) + len(y) - both):
                keep.append((a, b))
        return {"a": [a for a, _ in keep], "b": [b for _, b in keep]}

    joined = edges.join(left, "a").join(right, "b").select("a", "b", "hashes_a", "hashes_b")
    return arrow_rows(joined, work, "a long, b long", max_chars=8_000_000)


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` for every node with an edge; ``comp`` is the least node that can be reached.

    Each round takes the least label among the neighbours and then the label of that label; the
    labels are stored after each round.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("comp")))
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "comp"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("comp").alias("low"))
        )
        lower = labels.join(near, "node").select("node", "comp", F.least("comp", "low").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("comp").alias("further"))
        after = stored(lower.join(jump, "low").select("node", F.col("further").alias("comp"), F.col("comp").alias("before")))
        changed = after.filter("comp <> before").limit(1).count()
        drop_stored(labels)
        labels = after.drop("before")
        if not changed:
            drop_stored(both)
            return labels


def _block_pairs(lists: DataFrame, listed: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges between members of one list in different components that their longer sketches let pass.

    A list is dealt by size class (sizes within the threshold lie in one class or in two next to
    each other). In each part the members of the largest component need not meet each other: their
    blocks meet the blocks of the others, and those meet among themselves. Every group that a task
    compares holds two blocks.
    """
    band = F.floor(F.log("n") / F.log(F.lit(100.0 / PERCENT))).cast("int")
    placed = lists.select("value", "node", "n", "comp", F.explode(F.array(band, band - 1)).alias("part"), band.alias("band"))
    per_comp = placed.groupBy("value", "part", "comp").agg(
        F.count("*").alias("size"), F.max((F.col("band") == F.col("part")).cast("int")).alias("home")
    )
    sizes = (
        per_comp.groupBy("value", "part")
        .agg(
            F.max(F.struct("size", "comp")).alias("main"),
            F.sum("size").alias("all"),
            F.max("home").alias("home"),
        )
        .filter("home = 1 AND all > main.size")
        .select(
            "value",
            "part",
            F.col("main.comp").alias("main"),
            F.ceil(F.col("main.size") / BLOCK).alias("main_blocks"),
            F.ceil((F.col("all") - F.col("main.size")) / BLOCK).alias("other_blocks"),
        )
    )

    def each(count: str, make):
        return F.transform(F.sequence(F.lit(0).cast("long"), F.col(count) - 1), make)

    def group(first, second):
        return F.struct(first.cast("long").alias("first"), second.cast("long").alias("second"))

    own = F.col("own")
    dealt = (
        placed.join(sizes, ["value", "part"])
        .withColumn("is_main", F.col("comp") == F.col("main"))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("is_main"), F.col("main_blocks")).otherwise(F.col("other_blocks"))))
        # a second block below zero is one of the others beside a block of the largest component
        .withColumn(
            "groups",
            F.when(F.col("is_main"), each("other_blocks", lambda j: group(own, -1 - j))).otherwise(
                F.concat(
                    each("main_blocks", lambda i: group(i, -1 - own)),
                    each("other_blocks", lambda j: group(F.least(own, j), F.greatest(own, j))),
                )
            ),
        )
        .select("value", "part", "own", "node", "n", "comp", "is_main", (F.col("band") == F.col("part")).alias("home"), F.inline("groups"))
    )
    keys = ["value", "part", "first", "second"]
    ready = (
        dealt.join(listed.select("node", "listed").join(sets.select("node", "long"), "node"), "node")
        .repartition(*keys)
        .sortWithinPartitions(*keys)
        .select(*keys, "own", "node", "n", "comp", "home", "is_main", "long", "listed")
    )
    schema = _arrow("a long, b long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def flush() -> pa.RecordBatch:
            pairs = _compare(key, held)
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], schema=schema)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:4] != key:
                    if len(held) > 1:
                        yield flush()
                    key, held = row[:4], []
                held.append(row[4:])
        if len(held) > 1:
            yield flush()

    return ready.mapInArrow(run, "a long, b long").distinct()


def _compare(key: tuple, held: list[tuple]) -> list[tuple[int, int]]:
    value, _, first, second = key
    own, node, n, comp, home, main = (np.array(c) for c in list(zip(*held))[:6])
    wanted = comp[:, None] != comp[None, :]
    wanted &= np.minimum(n[:, None], n[None, :]) * 100 >= np.maximum(n[:, None], n[None, :]) * PERCENT
    # two of the class itself, or one of it and one of the next class
    wanted &= home[:, None] | home[None, :]
    if second < 0:
        wanted &= main[:, None] != main[None, :]
    elif first != second:
        wanted &= own[:, None] != own[None, :]
    # a pair counts in the first list that both are in
    earlier = [np.array(h[7][: h[7].index(value)], np.int64) for h in held]
    wanted &= _in_common(earlier) == 0
    wanted = np.triu(wanted, 1)
    used = np.flatnonzero(wanted.any(axis=0) | wanted.any(axis=1))
    if not len(used):
        return []
    wanted, node, n = wanted[np.ix_(used, used)], node[used], n[used]
    # shortened hashes may meet by chance, so this is never less than what the sketches share
    both = _in_common([np.unique(np.frombuffer(held[i][6], "<u4")) for i in used])
    twice = np.array([len(held[i][6]) // 4 - len(np.unique(np.frombuffer(held[i][6], "<u4"))) for i in used])
    both += np.minimum(twice[:, None], twice[None, :])
    whole = (n[:, None] <= LONG_SKETCH) & (n[None, :] <= LONG_SKETCH)
    similar = both * 100 >= PERCENT * (n[:, None] + n[None, :] - both)
    wanted &= np.where(whole, similar, both >= LEAST_LONG_SHARE * LONG_SKETCH)
    return [(int(min(node[i], node[j])), int(max(node[i], node[j]))) for i, j in zip(*np.nonzero(wanted))]


def _in_common(rows: list[np.ndarray]) -> np.ndarray:
    """How many values each two of the rows share; no row repeats a value."""
    out = np.zeros((len(rows), len(rows)), np.float32)
    sizes = np.array([len(r) for r in rows])
    if not sizes.any():
        return out
    _, place = np.unique(np.concatenate(rows), return_inverse=True)
    often = np.bincount(place) > 1
    column = np.cumsum(often) - 1
    keep = often[place]
    row, column = np.repeat(np.arange(len(rows)), sizes)[keep], column[place[keep]]
    for start in range(0, int(often.sum()), COLUMNS):
        here = (column >= start) & (column < start + COLUMNS)
        holds = np.zeros((len(rows), min(COLUMNS, int(often.sum()) - start)), np.float32)
        holds[row[here], column[here] - start] = 1
        out += holds @ holds.T
    return out


def _full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``node, hashes, long`` for the nodes of ``wanted``, from the texts of their rows."""
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.join(wanted, F.col("_id").eqNullSafe(F.col("id"))).select("node", "sig", "text")

    def work(columns: list, part: int) -> dict:
        out = []
        for node, sig, found in zip(columns[0], columns[1], shingles(columns[2])):
            # one id may stand on rows with different texts
            if hashlib.blake2b(found.tobytes(), digest_size=16).digest() == sig:
                out.append((node, found.tobytes(), found[:LONG_SKETCH].astype("<u4").tobytes()))
        return dict(zip(("node", "hashes", "long"), zip(*out))) if out else {"node": [], "hashes": [], "long": []}

    return arrow_rows(texts, work, "node long, hashes binary, long binary").dropDuplicates(["node"])


def _led_pairs(lists: DataFrame, comps: DataFrame, turn: int) -> DataFrame:
    """``a, b``: members of each list beside its leader of this turn, where they are in different components.

    In the first turn the smallest node leads, so lists of the same texts agree on it; later each list
    draws its own.
    """
    order = F.lit(0).cast("long") if turn == 0 else F.xxhash64("node", "value", F.lit(turn))
    placed = lists.join(comps, "node")
    leaders = placed.groupBy("value").agg(F.min(F.struct(order.alias("order"), "node", "n", "comp")).alias("lead"))
    pairs = placed.join(leaders, "value").filter((F.col("comp") != F.col("lead.comp")) & _similar_size("n", "lead.n"))
    return pairs.select(F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b")).distinct()


def _joined(pairs: DataFrame, comps: DataFrame, listed: DataFrame | None, sets: DataFrame) -> DataFrame:
    """``comps`` after the pairs that are links have joined theirs; ``listed`` lets sketches decide first."""
    close = pairs if listed is None else stored(_passing(pairs, listed))
    links = stored(_verified(close, sets))
    ends = links.join(comps.select(F.col("node").alias("a"), F.col("comp").alias("_a")), "a").join(
        comps.select(F.col("node").alias("b"), F.col("comp").alias("_b")), "b"
    )
    merged = components(ends.filter("_a <> _b").select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct())
    after = comps.join(merged.select(F.col("node").alias("comp"), F.col("comp").alias("_new")), "comp", "left")
    after = stored(after.select("node", F.coalesce("_new", "comp").alias("comp")))
    drop_stored(close, links, merged, comps)
    return after


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per row of ``docs``.

    Words are runs without ``[\\x20\\x09-\\x0D]``, A-Z in lower case; a text of fewer than five words
    is one shingle, a null or empty one has none and is linked with nothing. ``component_id`` is
    the smallest id that verified links reach; the row with that id is kept. Repeated rows have
    equal results. Further columns are ignored; an empty table gives no rows.
    """
    return _decided(docs, id_col, text_col).drop("key")


def _decided(docs: DataFrame, id_col: str, text_col: str, keys: bool = False) -> DataFrame:
    """The result of ``near_duplicates`` and ``key``, which is null unless asked for."""
    rows = stored(_sketches(docs, id_col, text_col, keys))
    filled = rows.filter("n > 0")
    groups = filled.groupBy("sig").agg(F.min("row").alias("node"), F.min("doc_id").alias("label"))
    members = stored(filled.select("row", "doc_id", "key", "n", "sig").join(groups, "sig"))
    nodes = members.filter("row = node").select("node", "n", "label", "sig", F.col("doc_id").alias("id"))
    sketches = stored(nodes.join(rows.select(F.col("row").alias("node"), "sketch"), "node"))

    listed = stored(_listed(sketches))
    sets = stored(_full_sets(docs, sketches.select("node", "id", "sig").join(listed.select("node"), "node"), id_col, text_col))
    lists = listed.select(F.explode("listed").alias("value"), "node", "n")
    shared = lists.groupBy("value").agg(F.count("*").alias("size")).filter("size > 1")
    lists = stored(lists.join(shared.select("value"), "value"))
    comps = stored(listed.select("node", F.col("node").alias("comp")))
    for turn in range(ROUNDS):
        comps = _joined(_led_pairs(lists, comps, turn), comps, listed, sets)
    comps = _joined(stored(_block_pairs(lists.join(comps, "node"), listed, sets)), comps, listed=None, sets=sets)
    drop_stored(lists, listed, sets)

    named = sketches.select("node", "label").join(comps, "node", "left")
    named = named.withColumn("comp", F.coalesce("comp", "node"))
    smallest = named.groupBy("comp").agg(F.min("label").alias("component_id"))
    found = members.join(named.select("node", "comp"), "node").join(smallest, "comp")
    result = found.select("doc_id", "key", F.col("n").alias("n_shingles"), "component_id").unionByName(
        rows.filter("n = 0").select("doc_id", "key", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    )
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``near_duplicates`` does not keep; all columns stay."""
    return keep_rows(docs, stored(_decided(docs, id_col, text_col, keys=True)), id_col, text_col)
