"""Merkle manifest of a dataset by concatenated-level strings.

The leaves of each source are numbered and cut into aligned blocks of ``ARITY ** LEVELS``. A block
keeps each of its levels as one string of hex digests; a parent is the hash of a substring of fixed
width, and a node's siblings are the substrings on either side of it in its run. A block's top is
one node of the next round, which cuts those nodes into blocks in the same way, until each source
has one node; the subroots go through the same rounds. Then the sibling segments come down: the
tops of a round's blocks hand theirs to all nodes of the block below.

Numbering never gathers a source in one task, a block holds a bounded number of nodes, and every
join is by source and block.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermap.llm.common import _arrow, drop_stored, ship, stored

ARITY = 3
#: Levels of a block, and its leaves.
LEVELS = 5
BLOCK = ARITY**LEVELS
#: Width of a hex digest, and of a full run.
HEX = 64
RUN = ARITY * HEX

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SEGMENTS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else length in bytes, ``:`` and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Mapping[str, Column]) -> Column:
    return digest(*[field(values[name]) for name in FIELDS])


def fold(node: Column, proof: Column) -> Column:
    """The root that a leaf and its sibling segments give."""
    return F.aggregate(proof, node, lambda so_far, s: digest(s["left"], so_far, s["right"]))


def proof_digest(proof: Column) -> Column:
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _numbered(nodes: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``nodes`` with ``index`` from 0 within ``tree`` by ``order``, and the stored rows that it reads.

    Rows are range-partitioned and numbered inside each partition; where a tree goes over a border
    its rows in earlier partitions are added. Equal rows may spread over partitions.
    """
    tied = nodes.withColumn("_tie", F.monotonically_increasing_id())
    by = [F.col(c).asc_nulls_first() for c in ("tree", *order, "_tie")]
    sorted_rows = tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sorted_rows.schema)
    schema = f"{kinds}, cell int, place long"
    arrow = _arrow(schema)
    at = sorted_rows.columns.index("tree")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cell, before, place = TaskContext.get().partitionId(), None, -1
        for batch in batches:
            places = []
            for tree in batch.column(at).to_pylist():
                place = place + 1 if tree == before else 0
                before = tree
                places.append(place)
            columns = [*batch.columns, pa.array([cell] * len(places), pa.int32()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    rows = stored(sorted_rows.mapInArrow(run, schema))
    earlier = Window.partitionBy("tree").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    # a cell holds the continuation of one tree at most: no more rows than partitions
    shifts = (
        rows.groupBy("tree", "cell")
        .agg(F.count("*").alias("n"))
        .withColumn("_before", F.sum("n").over(earlier))
        .filter("_before > 0")
        .select("tree", "cell", "_before")
    )
    index = F.col("place") + F.coalesce("_before", F.lit(0))
    return rows.join(F.broadcast(shifts), ["tree", "cell"], "left").select(*nodes.columns, index.alias("index")), rows


def _parents(level: Column) -> Column:
    """The next level of a level string: each run of digests, a substring of fixed width, hashed."""
    runs = F.expr(f"sequence(0, cast(ceil(length(_level) / {RUN}) as int) - 1)")
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substr(level, i * RUN + 1, F.lit(RUN)), 256)), "")


def _blocks(nodes: DataFrame) -> DataFrame:
    """``tree, block, depth, levels, nodes, top``; ``nodes`` keeps what stands beside each node.

    A block that is not alone in its tree has all levels, also where its last runs are short; one
    that is alone stops at its first single node. A full block looks the same either way.
    """
    beside = [c for c in nodes.columns if c not in ("tree", "index", "node")]
    row = F.struct("index", "node", *beside)
    grouped = nodes.groupBy("tree", F.expr(f"index DIV {BLOCK}").alias("block")).agg(
        F.sort_array(F.collect_list(row)).alias("nodes")
    )
    n = F.size("nodes")
    alone = sum(((n > ARITY**k).cast("int") for k in range(LEVELS)), F.lit(0))
    out = grouped.withColumn("depth", F.when((F.col("block") > 0) | (n == BLOCK), LEVELS).otherwise(alone))
    out = out.withColumn("_level", F.array_join("nodes.node", "")).withColumn("levels", F.array("_level"))
    for k in range(LEVELS):
        out = out.withColumn("_level", F.when(F.col("depth") > k, _parents(F.col("_level"))).otherwise(F.col("_level")))
        if k < LEVELS - 1:
            out = out.withColumn("levels", F.concat("levels", F.array("_level")))
    return out.withColumnRenamed("_level", "top")


def _segments(place: Column) -> Column:
    """Siblings of a block's node, level by level: the substrings that flank it in its run."""
    own = []
    for k in range(LEVELS):
        at = F.floor(place / ARITY**k).cast("int")
        within = (at % ARITY) * HEX
        start = (at - at % ARITY) * HEX
        level = F.col("levels")[k]
        left = F.substr(level, start + 1, within)
        right = F.substr(level, start + within + HEX + 1, F.lit(RUN - HEX) - within)
        own.append(F.struct(left.alias("left"), right.alias("right")))
    return F.slice(F.array(*own), F.lit(1), F.col("depth"))


def _down(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """One row per node of the blocks: what stands beside it, ``proof`` to the very root, and what ``above`` adds."""
    kinds = blocks.schema["nodes"].dataType.elementType.names
    added = [c for c in above.columns if c not in ("tree", "block", "proof")]
    each = F.transform(
        "nodes", lambda r, i: F.struct(*[r[k].alias(k) for k in kinds], _segments(i).alias("own"))
    )
    rows = blocks.join(above, ["tree", "block"]).select("tree", "proof", *added, F.inline(each))
    return rows.withColumn("proof", F.concat("own", "proof")).drop("own")


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """Blocks of every round, stored, from the leaves to one block per tree."""
    rounds = []
    while True:
        blocks = stored(_blocks(nodes))
        rounds.append(blocks)
        if not blocks.agg(F.max("block")).first()[0]:
            return rounds
        nodes = blocks.select("tree", F.col("block").alias("index"), F.col("top").alias("node"))


def _proofs(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    for blocks in rounds[:0:-1]:
        above = _down(blocks, above).withColumnRenamed("index", "block").drop("node")
    return _down(rounds[0], above)


def _build(docs: DataFrame, also: Mapping[str, Column]) -> tuple[DataFrame, list[DataFrame]]:
    ship(docs.sparkSession)
    values = {name: F.col(name) for name in FIELDS}
    leaves = docs.select(
        # null sources come first, then by bytes
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf(values).alias("node"),
        *[column.alias(name) for name, column in also.items()],
    )
    numbered, rows = _numbered(leaves, ["doc_id", "node"])
    rounds = _rounds(numbered)
    subroots = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("top").alias("node"))
    tops, top_rows = _numbered(subroots, ["name"])
    upper = _rounds(tops)
    very_top = upper[-1].select("tree", "block", F.col("top").alias("root"), F.array().cast(SEGMENTS).alias("proof"))
    sources = _proofs(upper, very_top).select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("block"), "proof", F.col("node").alias("subroot"), "root"
    )
    found = _proofs(rounds, sources).withColumnRenamed("node", "leaf")
    return found.select("doc_id", "leaf", *also, "subroot", "root", "proof"), [rows, top_rows, *rounds, *upper]


def manifest(docs: DataFrame, also: Mapping[str, Column] | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof`` of every row, with the columns ``also`` made from ``docs``.

    A leaf hashes ``FIELDS``, so a null, an empty text and a text ``-`` differ. Leaves of a source
    ascend by id (nulls first), then by digest; repeated rows are leaves of their own with equal
    digests and different proofs. Each run of three nodes has one parent, also a run of one. A
    source or dataset with a single node has that node as its root. ``proof`` holds the digests to
    the left and right of the path, level by level. An empty table gives no rows; further columns
    are ignored.
    """
    found, made = _build(docs, also or {})
    result = stored(found)
    drop_stored(*made)
    return result


def verify(held: DataFrame, docs: DataFrame) -> DataFrame:
    """``doc_id, verified`` for every row of ``docs``: whether a proof under its id leads to the root."""
    values = {name: F.col(name) for name in FIELDS}
    now = docs.select(F.col("doc_id").cast("long").alias("_id"), leaf(values).alias("_leaf"))
    proofs = held.select("doc_id", "root", "proof")
    rows = now.withColumn("_row", F.monotonically_increasing_id()).join(proofs, F.col("_id").eqNullSafe(F.col("doc_id")), "left")
    good = F.coalesce(fold(F.col("_leaf"), F.col("proof")) == F.col("root"), F.lit(False))
    return rows.groupBy("_row", "_id").agg(F.max(good).alias("verified")).select(F.col("_id").alias("doc_id"), "verified")


def audit(docs: DataFrame) -> DataFrame:
    """The manifest's digests, and whether each document passes after a tampering of half of them.

    The text loses its line breaks where two divides the checksum of the id; a null id or text
    stays as it is.
    """
    tampered = {name: F.col(name) for name in FIELDS}
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.col("text").cast("string")
    tampered["text"] = F.when(hit, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    found, made = _build(docs, {"changed": leaf(tampered)})
    folded = found.withColumn("folded_root", fold(F.col("changed"), F.col("proof")))
    result = stored(
        folded.select(
            "doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
            "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
        )
    )
    drop_stored(*made)
    return result


def expected_sql(levels: int = 13, top_levels: int = 9) -> str:
    """The same as DuckDB SQL for sources of up to ``3 ** levels`` documents."""

    def enc(value: str) -> str:
        return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR, '-')"

    def row_leaf(text: str) -> str:
        return "sha256(" + " || ".join(enc(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def step(name: str, k: int) -> str:
        return f"""
{name}{k + 1} AS MATERIALIZED (
    SELECT g, i // 3 AS i, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h,
        (any_value(n) + 2) // 3 AS n
    FROM {name}{k} GROUP BY g, i // 3
)"""

    def proof(name: str, k: int, rows: str, place: str, group: str) -> str:
        """Adds the siblings of level k to the rows' path."""
        side = "(SELECT coalesce(string_agg(h, '' ORDER BY i), '') FROM {n}{k} t WHERE t.g = r.{g} AND t.i // 3 = r.{p} // {q} AND t.i {o} r.{p} // {w})"
        cut = lambda o: side.format(n=name, k=k, g=group, p=place, q=3 ** (k + 1), w=3**k, o=o)
        return f"""
{rows}{k + 1} AS MATERIALIZED (
    SELECT *, proof || l || r AS proof, CASE WHEN n > 1 THEN sha256(l || f || r) ELSE f END AS f, (n + 2) // 3 AS n
    FROM (SELECT r.* , {cut('<')} AS l, {cut('>')} AS r FROM {rows}{k} r)
)""".replace("SELECT *, proof", "SELECT * EXCLUDE (l, r, proof, f, n), proof")

    steps = "[[ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split(doc_id::VARCHAR, '')]"
    crc = (
        f"list_reduce(list_prepend(4294967295::BIGINT, flatten({steps})), lambda c, s: "
        "CASE WHEN s >= 0 THEN xor(c, s) ELSE xor(c >> 1, (c & 1) * 3988292384) END)"
    )
    up = ",".join(step("a", k) for k in range(levels))
    top_up = ",".join(step("t", k) for k in range(top_levels))
    down = ",".join(proof("a", k, "p", "i", "g") for k in range(levels))
    top_down = ",".join(proof("t", k, "q", "j", "one") for k in range(top_levels))
    return f"""
WITH docs AS MATERIALIZED (
    SELECT doc_id, coalesce('=' || source, '') AS g, {row_leaf("text")} AS leaf,
        -- the checksum without its last inversion has the other parity
        CASE WHEN {crc} % 2 = 1 THEN {row_leaf("replace(text, chr(10), '')")} ELSE {row_leaf("text")} END AS changed
    FROM documents
),
a0 AS MATERIALIZED (
    SELECT doc_id, leaf, changed, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
        leaf AS h, count(*) OVER (PARTITION BY g) AS n
    FROM docs
),{up},
t0 AS MATERIALIZED (
    SELECT 0 AS g, row_number() OVER (ORDER BY encode(g)) - 1 AS i, g AS name, h, count(*) OVER () AS n FROM a{levels}
),{top_up},
p0 AS MATERIALIZED (SELECT doc_id, leaf, g, i, n, '' AS proof, changed AS f FROM a0),{down},
q0 AS MATERIALIZED (
    SELECT p.doc_id, p.leaf, t.h AS subroot, 0 AS one, t.i AS j, t.n AS n, p.proof, p.f
    FROM p{levels} p JOIN t0 t ON p.g = t.name
),{top_down}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = h AS verified
FROM q{top_levels}, t{top_levels}
"""
