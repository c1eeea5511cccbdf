"""Incremental secret scan with a ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content. A pair of blob and rule
version that the ledger holds is not scanned again; of the others each blob is scanned once, in
one of its versions. Findings are joined back to all paths and versions that hold the blob.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermap.llm.common import arrow_rows, stored

#: Raise this with any change of the patterns: it makes every blob unseen.
RULES_VERSION = "2"
#: Order of kinds at the same start.
KINDS = ("assign", "access", "hex")
#: The patterns of the contract. The value of an assignment is group 2.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
#: A run of at least the least length is what matching any length and dropping short ones leaves.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("passw", "secret", "token", "api")

FINDINGS = "array<struct<kind:string,start:int,end:int>>"
LEDGER = f"blob string, rules string, findings {FINDINGS}"


def find(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by start, then kind in the order of ``KINDS``."""
    found = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


def _text(text_col: str):
    return F.coalesce(F.col(text_col), F.lit(""))


def addressed(versions: DataFrame, path_col: str, text_col: str, version_col: str | None) -> DataFrame:
    """``path, version, blob`` of every row."""
    version = F.col(version_col).cast("string") if version_col else F.lit("")
    return versions.select(
        F.col(path_col).alias("path"),
        F.coalesce(version, F.lit("")).alias("version"),
        F.sha2(_text(text_col), 256).alias("blob"),
    )


def extend_ledger(
    versions: DataFrame,
    ledger: DataFrame | None = None,
    path_col: str = "doc_id",
    text_col: str = "text",
    version_col: str | None = None,
    rules: str = RULES_VERSION,
) -> tuple[DataFrame, DataFrame]:
    """The addressed versions, and ``ledger`` with the pairs that it lacked, each scanned once.

    A null text counts as an empty one. Repeated rows share their blob. The ledger has the columns
    of ``LEDGER``; blobs without a finding are in it too, so they stay scanned.
    """
    paths = stored(addressed(versions, path_col, text_col, version_col))
    unseen = paths.groupBy("blob").agg(F.min(F.struct("path", "version")).alias("at"))
    if ledger is not None:
        unseen = unseen.join(ledger.filter(F.col("rules") == rules).select("blob"), "blob", "left_anti")
    unseen = unseen.select("blob", "at.path", "at.version")
    version = F.col(version_col).cast("string") if version_col else F.lit("")
    texts = versions.select(
        F.col(path_col).alias("_path"),
        F.coalesce(version, F.lit("")).alias("_version"),
        _text(text_col).alias("text"),
        F.sha2(_text(text_col), 256).alias("_blob"),
    )
    # one path, or none, may stand on many rows with different texts; with the blob each finds its own
    same = F.col("_path").eqNullSafe(F.col("path")) & (F.col("_version") == F.col("version")) & (F.col("_blob") == F.col("blob"))
    once = texts.join(unseen, same).select("blob", "text")

    def work(columns: list, part: int) -> dict:
        blobs, texts = columns
        found = [[dict(zip(("kind", "start", "end"), f)) for f in find(t)] for t in texts]
        return {"blob": blobs, "rules": [rules] * len(blobs), "findings": found}

    scanned = stored(arrow_rows(once, work, LEDGER).dropDuplicates(["blob", "rules"]))
    return paths, scanned if ledger is None else ledger.unionByName(scanned)


def scan(
    versions: DataFrame,
    ledger: DataFrame | None = None,
    path_col: str = "doc_id",
    text_col: str = "text",
    version_col: str | None = None,
    rules: str = RULES_VERSION,
) -> DataFrame:
    """``path, version, blob, findings`` of every row; ``findings`` is empty where nothing was found.

    An empty table gives an empty result; further columns are ignored whatever their names.
    """
    paths, known = extend_ledger(versions, ledger, path_col, text_col, version_col, rules)
    with_findings = known.filter((F.col("rules") == rules) & (F.size("findings") > 0)).select("blob", "findings")
    return paths.join(with_findings, "blob", "left").withColumn(
        "findings", F.coalesce("findings", F.array().cast(FINDINGS))
    )


def digests(found: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` from the result of ``scan``.

    The ledger adds no kind of span of its own, so the spans are the base ones.
    """
    spans = F.array_join(
        F.transform("findings", lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ","
    )
    counts = [
        F.expr(f"size(filter(findings, f -> f.kind = '{kind}'))").cast("long").alias(f"n_{kind}") for kind in KINDS
    ]
    return found.select(
        F.col("path").cast("long").alias("doc_id"), *counts, F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans")
    )


def redact(docs: DataFrame, ledger: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every finding replaced by ``[secret]``; all rows and columns stay.

    Of an assignment its name goes as well. Texts without a finding, null ones among them, stay as
    they are. ``n_chars``, if there is such a column of numbers, is counted anew for changed texts.
    """
    found = scan(docs, ledger, id_col, text_col)
    hits = found.filter(F.size("findings") > 0).select(
        F.col("path").alias("_llm_id"), F.col("blob").alias("_llm_blob"), F.col("findings").alias("_llm_findings")
    )
    hits = hits.dropDuplicates(["_llm_id", "_llm_blob"])
    same = docs[id_col].eqNullSafe(F.col("_llm_id")) & (F.sha2(docs[text_col], 256) == F.col("_llm_blob"))
    joined = docs.join(hits, same, "left")
    # from the last finding to the first, so that earlier positions stay right
    text = F.aggregate(
        F.reverse(merged_spans(F.col("_llm_findings"))),
        F.col(text_col),
        lambda t, f: F.concat(F.substring(t, F.lit(1), f["start"]), F.lit("[secret]"), F.substring(t, f["end"] + 1, F.length(t))),
    )
    changed = F.col("_llm_findings").isNotNull()
    columns = []
    for name in docs.columns:
        column = F.col(f"`{name}`")
        if name == text_col:
            column = F.when(changed, text).otherwise(column).alias(name)
        elif name == "n_chars" and dict(docs.dtypes)[name] in ("int", "bigint"):
            column = F.when(changed, F.length(text).cast(dict(docs.dtypes)[name])).otherwise(column).alias(name)
        columns.append(column)
    return joined.select(*columns)


def merged_spans(findings):
    """Findings by start, with those that overlap joined into one."""
    kind = "array<struct<start:int,end:int>>"
    plain = F.transform(findings, lambda f: F.struct(f["start"].alias("start"), f["end"].alias("end")))
    return F.aggregate(
        plain,
        F.array().cast(kind),
        lambda done, f: F.when(
            (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] > f["start"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(
                    F.struct(
                        F.get(done, F.size(done) - 1)["start"].alias("start"),
                        F.greatest(F.get(done, F.size(done) - 1)["end"], f["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(f))),
    )
