from __future__ import annotations

from decimal import Decimal
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgermap.operators.documents import double_entry, header_detail, net_sides, pack_batches, packed_documents, with_total
from ledgermap.operators.numbering import number_lines, number_repeated_lines, rows_before
from ledgermap.plans.common import entity_lists
from ledgermap.sources.workspace import shared_root

SLOW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


@pytest.fixture
def many_cells(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("before, after", [(["a"], ["b", "id"]), (["a", "b"], ["id"]), ([], ["id"])])
def test_lines_numbered_before_they_repeat(spark, many_cells, before, after):
    df = skewed(spark)
    items = F.when(F.col("doc").isNull(), F.array(F.lit("x"))).otherwise(F.array(F.lit("p"), F.lit("q"), F.lit("r")))
    listed = df.withColumn("items", items)
    got = number_repeated_lines(listed, ["doc"], before, after, repeats="items", item="item", out="line")
    want = number_lines(listed.withColumn("item", F.explode("items")), ["doc"], [*before, "item", *after], "line")
    columns = ["doc", "a", "b", "id", "item", "line"]
    assert got.select(columns).exceptAll(want.select(columns)).isEmpty()
    assert got.count() == want.count()


def skewed(spark):
    """One document with a third of the rows, one without a key, many small ones; ties in the order."""
    doc = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("d"), (F.col("id") % 37).cast("string"))
    )
    return spark.range(3000).select(
        doc.alias("doc"), (F.col("id") % 5).alias("a"), F.when(F.col("id") % 7 > 0, F.col("id") % 11).alias("b"), "id"
    )


def by_hand(rows, order):
    def rank(v):
        return (v is not None, v if v is not None else 0)

    groups = {}
    for r in rows:
        groups.setdefault(r.doc, []).append(r)
    out = {}
    for members in groups.values():
        for n, r in enumerate(sorted(members, key=lambda r: [rank(r[c]) for c in order]), 1):
            out[r.id] = n
    return out


def test_hot_documents_are_numbered_like_ordinary_ones(spark, many_cells):
    df = skewed(spark)
    order = ["a", "b", "id"]
    got = {r.id: r.line_no for r in number_lines(df, ["doc"], order).collect()}
    assert got == by_hand(df.collect(), order)


def test_copies_of_one_row_spread_over_cells(spark, many_cells):
    copies = spark.range(2000).select(F.lit("d").alias("doc"), F.lit(1).alias("a"))
    lines = number_lines(copies, ["doc"], ["a"])
    assert sorted(r.line_no for r in lines.collect()) == list(range(1, 2001))
    frozen = max((p for p in Path(shared_root(spark), "work").glob("cells-*")), key=lambda p: p.stat().st_mtime)
    sizes = spark.read.parquet(str(frozen)).groupBy("_cell").count().collect()
    assert len(sizes) >= 8 and max(r["count"] for r in sizes) < 600


def test_ordinary_documents(spark):
    df = skewed(spark)
    order = ["b", "a", "id"]
    got = {r.id: r.line_no for r in number_lines(df, ["doc"], order).collect()}
    assert got == by_hand(df.collect(), order)


def test_plan_has_no_window_over_the_document_alone(spark, many_cells):
    plan = number_lines(skewed(spark), ["doc"], ["id"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "row_number" in line]
    assert windows and all("windowspecdefinition(_cell" in line for line in windows)


def test_header_is_kept_on_line_one_only(spark):
    df = skewed(spark).withColumn("head", F.lit("H"))
    lines = header_detail(df, ["doc"], ["a", "b", "id"], ["head"]).collect()
    for doc in {r.doc for r in lines}:
        mine = [r for r in lines if r.doc == doc]
        assert sorted(r.line_no for r in mine) == list(range(1, len(mine) + 1))
        assert [r.line_no for r in mine if r.head == "H"] == [1]
    assert all(r.head == "H" for r in header_detail(df, ["doc"], ["id"], ["head"], repeat=True).collect())


def test_net_sides(spark):
    rows = [("z", "5", "-5"), ("p", "7", "-2"), ("n", "1", "-4"), ("tiny", "0.004", "0")]
    df = spark.createDataFrame(rows, "k string, d string, c string").select(
        "k", F.col("d").cast("decimal(18,4)"), F.col("c").cast("decimal(18,4)")
    )
    got = {r.k: (r.debit, r.credit) for r in net_sides(df, ["k"], F.col("d"), F.col("c")).collect()}
    assert got == {"p": (Decimal("5.00"), Decimal("0.00")), "n": (Decimal("0.00"), Decimal("3.00"))}


amounts = st.lists(
    st.tuples(st.sampled_from("AB"), st.sampled_from("xyz"), st.integers(-500, 500)), min_size=1, max_size=20
)


@SLOW
@given(amounts)
def test_every_document_balances(spark, rows):
    df = spark.createDataFrame(rows, "doc string, code string, cents int").withColumn(
        "amount", (F.col("cents") / 100).cast("decimal(18,2)")
    )
    both = double_entry(df, ["doc", "code"], ["doc"], F.col("amount"))
    for r in both.groupBy("doc").agg(F.sum(F.col("debit") - F.col("credit")).alias("net")).collect():
        assert r.net == 0
    entries = both.filter("entry_offset = '0'").agg(F.sum(F.col("debit") - F.col("credit")).alias("v")).first().v
    assert entries == Decimal(sum(c for *_, c in rows)) / 100
    assert both.filter("entry_offset = '1' and code is not null").count() == 0


def test_double_entry_needs_coarser_offsets(spark):
    with pytest.raises(ValueError):
        double_entry(spark.range(1), ["id"], ["id"], F.col("id"))


def packed(spark, sizes, size):
    rows = [(g, i) for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i int")
    return {r.g: r.n for r in pack_batches(df, "g", size).groupBy("g").agg(F.max("batch_num").alias("n")).collect()}


def test_pack_batches(spark):
    assert packed(spark, {"a": 3, "b": 4, "c": 1, "d": 2}, 5) == {"a": 1, "b": 1, "c": 2, "d": 2}
    assert packed(spark, {"a": 5, "b": 5, "c": 1}, 5) == {"a": 1, "b": 2, "c": 3}
    assert packed(spark, {"a": 30, "b": 1}, 5) == {"a": 1, "b": 7}


@SLOW
@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=4), st.integers(1, 9), min_size=1, max_size=12))
def test_batches_keep_groups_whole_and_in_order(spark, sizes):
    rows = [(g, i) for g, n in sizes.items() for i in range(n)]
    out = pack_batches(spark.createDataFrame(rows, "g string, i int"), "g", 4).collect()
    assert len(out) == len(rows)
    batches = {}
    for r in out:
        batches.setdefault(r.g, set()).add(r.batch_num)
    assert all(len(b) == 1 for b in batches.values())
    in_order = [min(batches[g]) for g in sorted(batches)]
    assert in_order == sorted(in_order)


def test_packed_documents_equal_numbering_and_packing(spark, many_cells):
    """Documents of one line, of many cells, equal lines, and lines without a document."""
    sizes = {"a": 1, "b": 700, "c": 3, None: 150, "d": 40, "": 5, "e": 1}
    rows = [(g, i // 2) for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i int").repartition(5)
    for size in (1, 7, 64, 5000):
        plain = pack_batches(header_detail(df, ["g"], ["i"], []), "g", size)
        assert sorted(packed_documents(df, "g", ["i"], size).collect(), key=str) == sorted(plain.collect(), key=str)
    assert packed_documents(df.limit(0), "g", ["i"]).count() == 0


def test_rows_before(spark):
    df = spark.range(200).select(F.format_string("%05d", "id").alias("k"), (F.col("id") % 3).alias("n"))
    got = {r.k: r.before for r in rows_before(df, "k", "n", "before").collect()}
    total = 0
    for i in range(200):
        assert got[f"{i:05d}"] == total
        total += i % 3


def test_with_total(spark):
    df = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "k string, t string, v bigint")
    rows = {r.k: (r.t, r.v, r.is_total) for r in with_total(df, ["v"], {"k": "ALL"}).collect()}
    assert rows == {"a": ("x", 1, 0), "b": ("y", 2, 0), "ALL": ("", 3, 1)}


def test_entities_are_one_list_unless_they_differ_in_more_than_their_id(mapped):
    entity = mapped(
        "entity",
        *[{"new_entity_id": e, "pkg_npc_commit": 0} for e in ("B", None, "A")],
        *[{"data_folder_id": "F2", "new_entity_id": e, "pkg_npc_commit": n} for e, n in (("A", 0), ("B", 1))],
        *[{"data_folder_id": "F3", "new_entity_id": "A", "pkg_npc_commit": None} for _ in range(2)],
    )
    got = [(r[0], [tuple(i) for i in r[1]], r[2]) for r in entity_lists(entity, ["pkg_npc_commit"]).collect()]
    assert sorted(got, key=str) == [
        ("F1", [(None, 0), ("A", 0), ("B", 0)], None),
        ("F2", [("A", 0)], "A"),
        ("F2", [("B", 1)], "B"),
        ("F3", [("A", None)], "A"),
        ("F3", [("A", None)], "A"),
    ]
