"""URL filter: rules first, then the ratio of two character language models.

The models are variable-order Markov chains with Witten-Bell smoothing, one of the URLs that the
rules allow and one of those they block; a context that one of them has not seen falls back to
its shorter ending. A URL's score is the mean over its characters of the difference of log
probabilities. The threshold is calibrated on ruled URLs that the models have not seen: it lies
equally many standard deviations from the mean of either side. All of it is DataFrame functions.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermap.llm.common import drop_stored, stored

ALLOW, BLOCK = "allow", "block"
#: The contract's rules as (verdict, host, path).
RULES = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)
#: Characters of context at most; borders of the text count as characters.
CONTEXT = 4
START, END = "\x02", "\x03"
#: A character that no model has seen has one part in so many.
ALPHABET = 256
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    known = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(known, PARTS, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(known, PARTS, 2)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, as its string and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _grams(texts: DataFrame, *keep: str) -> DataFrame:
    padded = F.concat(F.lit(START * CONTEXT), F.col("text"), F.lit(END))
    places = F.sequence(F.lit(1), F.length("text") + 1)
    return texts.select(*keep, F.explode(F.transform(places, lambda i: F.substring(padded, i, F.lit(CONTEXT + 1)))).alias("gram"))


def log_ratios(texts: DataFrame) -> DataFrame:
    """``gram, ratio`` for every gram of ``texts``; ``side`` says which model learns from a text."""
    counted = stored(
        _grams(texts, "side")
        .groupBy("gram")
        .agg(
            F.count_if(F.col("side") == ALLOW).alias("a"),
            F.count_if(F.col("side") == BLOCK).alias("b"),
        )
    )
    levels = [counted]
    for _ in range(CONTEXT):
        shorter = levels[0].select(F.expr("substring(gram, 2)").alias("gram"), "a", "b")
        levels.insert(0, shorter.groupBy("gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    below = None
    for size, level in enumerate(levels):
        level = level.select(
            "gram",
            "a",
            "b",
            F.expr(f"substring(gram, 1, {size})").alias("context"),
            F.expr("substring(gram, 2)").alias("ending"),
        )
        totals = level.groupBy("context").agg(
            F.sum("a").alias("all_a"),
            F.sum("b").alias("all_b"),
            F.count_if(F.col("a") > 0).alias("kinds_a"),
            F.count_if(F.col("b") > 0).alias("kinds_b"),
        )
        joined = level.join(totals, "context")
        if below is None:
            joined = joined.withColumns({"low_a": F.lit(1.0 / ALPHABET), "low_b": F.lit(1.0 / ALPHABET)})
        else:
            joined = joined.join(below, "ending")
        below = joined.select(
            F.col("gram").alias("ending"),
            *(
                F.when(F.col(f"all_{x}") == 0, F.col(f"low_{x}"))
                .otherwise((F.col(x) + F.col(f"kinds_{x}") * F.col(f"low_{x}")) / (F.col(f"all_{x}") + F.col(f"kinds_{x}")))
                .alias(f"low_{x}")
                for x in ("a", "b")
            ),
        )
    result = stored(below.select(F.col("ending").alias("gram"), (F.log("low_a") - F.log("low_b")).alias("ratio")))
    drop_stored(counted)
    return result


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row.

    ``score`` is null where a rule decides. The models learn, calibrate and score whole URLs with
    scheme, query and fragment; host and path are for the rules and the result. A null URL counts
    as empty text; it and one without ``://`` have an empty host and path and are judged like any
    other text. Models and calibration see each URL once however many rows repeat it. Without calibration URLs of both sides the threshold is 0; a score on it
    allows. Further columns are ignored whatever their names; an empty table gives no rows.
    """
    host, path = host_and_path(F.col(url_col))
    parsed = pages.select(
        F.col(id_col).alias("page_id"),
        host.alias("host"),
        path.alias("path"),
        F.coalesce(F.col(url_col), F.lit("")).alias("text"),
    )
    name, decided = matching_rule(F.col("host"), F.col("path"), rules)
    parsed = parsed.withColumns({"rule": name, "decided": decided})
    held = F.substring(F.md5("text"), 1, 1).isin("0", "1", "2")
    texts = stored(
        parsed.select("text", "decided").distinct().select(
            F.monotonically_increasing_id().alias("id"),
            "text",
            "decided",
            F.when(held, F.lit(None)).otherwise(F.col("decided")).alias("side"),
        )
    )
    ratios = log_ratios(texts)
    scored = (
        _grams(texts.filter("side IS NULL"), "id")
        .join(ratios, "gram")
        .groupBy("id")
        .agg(F.avg("ratio").alias("score"))
    )
    scored = stored(texts.filter("side IS NULL").drop("side").join(scored, "id"))
    sides = {
        r["decided"]: (r["mean"], r["spread"])
        for r in scored.filter("decided IS NOT NULL")
        .groupBy("decided")
        .agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("spread"))
        .collect()
    }
    threshold = 0.0
    if len(sides) == 2:
        (mean_a, spread_a), (mean_b, spread_b) = sides[ALLOW], sides[BLOCK]
        both = spread_a + spread_b
        threshold = (mean_a * spread_b + mean_b * spread_a) / both if both else (mean_a + mean_b) / 2
    unruled = scored.filter("decided IS NULL").select("text", "score")
    ruled = parsed.filter("decided IS NOT NULL").select(
        "page_id", "host", "path", "rule", F.col("decided").alias("verdict"), F.lit(None).cast("double").alias("score")
    )
    judged = (
        parsed.filter("decided IS NULL")
        .join(unruled, "text")
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.when(F.col("score") >= threshold, F.lit(ALLOW)).otherwise(F.lit(BLOCK)).alias("verdict"),
            "score",
        )
    )
    result = stored(ruled.unionByName(judged))
    drop_stored(texts, ratios, scored)
    return result


def expected_sql(rules: Sequence[tuple[str, str, str]] = RULES) -> str:
    """The verdicts of ``judge`` over the table ``pages`` as DuckDB SQL."""

    def rule_case(kind: int | None) -> str:
        cases = "".join(
            f" WHEN (host = '{r[1]}' OR ends_with(host, '.{r[1]}')) AND starts_with(path, '{r[2]}')"
            f" THEN '{r[1] + r[2] if kind is None else r[kind]}'"
            for r in sorted(rules, key=lambda r: (-len(r[1]) - len(r[2]), -len(r[1])))
        )
        return f"CASE{cases} END"

    levels = ""
    for size in range(CONTEXT + 1):
        low = f"1.0::DOUBLE / {ALPHABET}" if size == 0 else "low.p"
        join = "" if size == 0 else f" JOIN p{size - 1} low ON low.side = c.side AND low.gram = substring(c.gram, 2)"
        levels += f""",
    c{size} AS (
        SELECT side, right(gram, {size + 1}) AS gram, sum(n) AS n FROM counted GROUP BY ALL),
    t{size} AS (
        SELECT side, left(gram, {size}) AS context, sum(n) AS total, count(*) FILTER (n > 0) AS kinds
        FROM c{size} GROUP BY ALL),
    p{size} AS (
        SELECT c.side, c.gram, CASE WHEN total = 0 THEN {low}
            ELSE (n + kinds * {low}) / (total + kinds) END::DOUBLE AS p
        FROM c{size} c JOIN t{size} t ON t.side = c.side AND t.context = left(c.gram, {size}){join})"""
    return rf"""
WITH parts AS (
    SELECT page_id, coalesce(url, '') AS text,
        translate(regexp_extract(coalesce(url, ''), '{PARTS}', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
        regexp_extract(coalesce(url, ''), '{PARTS}', 2) AS path
    FROM pages),
    parsed AS (SELECT *, {rule_case(None)} AS rule, {rule_case(0)} AS decided FROM parts),
    texts AS (
        SELECT DISTINCT text, decided,
            CASE WHEN left(md5(text), 1) NOT IN ('0', '1', '2') THEN decided END AS learns
        FROM parsed),
    grams AS (
        SELECT text, decided, learns,
            unnest([substring(repeat(chr(2), {CONTEXT}) || text || chr(3), i, {CONTEXT + 1})
                for i in range(1, length(text) + 2)]) AS gram
        FROM texts),
    counted AS (
        SELECT s.side, gram, count(*) FILTER (learns = s.side) AS n
        FROM grams, (VALUES ('{ALLOW}'), ('{BLOCK}')) s(side) GROUP BY ALL){levels},
    ratios AS (
        SELECT a.gram, ln(a.p) - ln(b.p) AS ratio
        FROM p{CONTEXT} a JOIN p{CONTEXT} b ON a.gram = b.gram AND a.side = '{ALLOW}' AND b.side = '{BLOCK}'),
    scored AS (
        SELECT text, decided, avg(ratio) AS score
        FROM grams JOIN ratios USING (gram) WHERE learns IS NULL GROUP BY ALL),
    sides AS (
        SELECT avg(score) FILTER (decided = '{ALLOW}') AS ma, avg(score) FILTER (decided = '{BLOCK}') AS mb,
            stddev_pop(score) FILTER (decided = '{ALLOW}') AS sa, stddev_pop(score) FILTER (decided = '{BLOCK}') AS sb
        FROM scored),
    line AS (
        SELECT coalesce(CASE WHEN sa + sb = 0 THEN (ma + mb) / 2 ELSE (ma * sb + mb * sa) / (sa + sb) END, 0) AS line
        FROM sides)
SELECT page_id, host, path, rule,
    coalesce(decided, CASE WHEN s.score >= (SELECT line FROM line) THEN '{ALLOW}' ELSE '{BLOCK}' END) AS verdict
FROM parsed p LEFT JOIN (SELECT text, score FROM scored WHERE decided IS NULL) s USING (text)
"""
