"""Mixing sources to target weights by hierarchical budgets, with DataFrame operations only.

Leaves of the tree are domain, language and source. A node's capacity is the tokens below it times ``max_epochs``. From
the root down, each node's budget is dealt to its children by weight, and a child that can't take its share passes the
rest to its siblings; only what no sibling can take was never given to their parent, so it went to the parent's
siblings. In whole tokens: a child gets its capacity, or the floor of its share.

A leaf's budget is met by full epochs and a prefix of one more: its documents in the order of a hash of seed, epoch and
doc_id, as long as the running sum of tokens stays within the rest. Running sums are two-step (buckets of the hash, then
documents inside a bucket), so that a leaf with a third of all documents isn't one task.

Null domains, languages and sources are the group 'unknown'; null texts have no tokens and are used as often as there are
full epochs. Each row is a document of its own; rows with one doc_id follow each other in an epoch, by their tokens, and
those with equally many are taken together or not at all, so that the budget holds. Rows without a doc_id are placed by
their texts. An empty table gives an empty mix. Other columns are kept.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD_PATTERN, documents

#: The default tree, from the root down; a tree is any number of level columns.
LEVELS = ("domain", "lang", "source")
SEED = 17
#: Share of all tokens that the mix holds, and how often a document may be used.
BUDGET_PERCENT, MAX_EPOCHS = 80, 2

#: Target weights of the default tree by level; a name that isn't listed weighs 1.
WEIGHTS: dict[str, dict[str, int]] = {"domain": {"domain0": 2}, "lang": {"en": 4, "de": 2, "fr": 2}, "source": {}}


def domain_of(source: Column | str = "source") -> Column:
    """A stand-in for a table of domains: the number at the end of the source's name modulo 3."""
    number = F.coalesce(F.regexp_extract(source, r"([0-9]+)$", 1).try_cast("long"), F.lit(0))
    return F.concat(F.lit("domain"), (number % 3).cast("string"))


def leaves_of(docs: DataFrame, domain: Column | None = None, row: bool = False) -> DataFrame:
    """(doc_id, key, domain, lang, source, n_words) of each row; ``row`` adds the whole row as a struct of that name.

    ``key`` gives a row its place in an epoch: the doc_id, or a hash of the text if there is none.
    """
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("unknown"))
    n_words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD_PATTERN)).cast("long")
    whole = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if row else []
    domain = domain_of() if domain is None else domain
    key = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.md5(F.col("text").cast("binary")), F.lit("none"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), F.coalesce(domain, F.lit("unknown")).alias("domain"), known("lang").alias("lang"), known("source").alias("source"), n_words.alias("n_words"), *whole)


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    found = None
    for name, weight in weights.get(level, {}).items():
        found = F.when(F.col(level) == name, weight) if found is None else found.when(F.col(level) == name, weight)
    return (F.lit(1) if found is None else found.otherwise(1)).cast("long")


def budgets(leaves: DataFrame, budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, levels: Sequence[str] = LEVELS, weights: Mapping[str, Mapping[str, int]] = WEIGHTS) -> DataFrame:
    """(*levels, tokens, budget) for each leaf with tokens; ``leaves`` has the levels and ``n_words`` for each document.

    ``weights``: whole numbers from 1 for the names of a level's nodes among their siblings.
    """
    levels = list(levels)
    nodes = {len(levels): leaves.groupBy(*levels).agg(F.sum("n_words").alias("tokens")).where("tokens > 0").withColumn("capacity", F.col("tokens") * max_epochs)}
    for depth in range(len(levels) - 1, 0, -1):
        nodes[depth] = nodes[depth + 1].groupBy(*levels[:depth]).agg(F.sum("tokens").alias("tokens"), F.sum("capacity").alias("capacity"))
    given = None
    for depth in range(1, len(levels) + 1):
        above, level = levels[: depth - 1], levels[depth - 1]
        children = nodes[depth].withColumn("w", _weight(level, weights))
        if given is None:  # the nodes below the root are few: one window over them
            top = W.partitionBy(F.lit(0))
            children = children.withColumn("all", F.sum("tokens").over(top)).withColumn("budget", F.least(F.expr(f"all * {int(budget_percent)} div 100"), F.sum("capacity").over(top)))
        else:
            children = children.join(given, above)
        # Siblings in the order in which they fill up; those that fill up below the common level get their capacity.
        siblings = W.partitionBy(*above) if above else W.partitionBy(F.lit(0))
        order = siblings.orderBy(F.col("capacity") / F.col("w"), level)
        before = order.rowsBetween(W.unboundedPreceding, -1)
        onward = order.rowsBetween(0, W.unboundedFollowing)
        children = children.withColumn("rest", F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))).withColumn("weights", F.sum("w").over(onward))
        children = children.withColumn("full", F.col("capacity") * F.col("weights") <= F.col("rest") * F.col("w"))
        first = F.min(F.when(~F.col("full"), F.struct((F.col("capacity") / F.col("w")).alias("k"), F.col(level).alias("l"), "rest", "weights"))).over(siblings)
        children = children.withColumn("first", first).withColumn("given", F.when(F.col("full"), F.col("capacity")).otherwise(F.expr("first.rest * w div first.weights")))
        given = children.select(*above, level, *(["tokens"] if depth == len(levels) else []), F.col("given").alias("budget"))
    return given


def mix(leaves: DataFrame, budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED, levels: Sequence[str] = LEVELS, weights: Mapping[str, Mapping[str, int]] = WEIGHTS) -> DataFrame:
    """``leaves`` with ``copies``, how often the mix holds each row (0: not at all).

    Rows of a leaf that agree in ``key`` and ``n_words`` can't be told apart: they are taken together or not at all.
    """
    levels = list(levels)
    plan = budgets(leaves, budget_percent, max_epochs, levels, weights)
    plan = plan.select(*levels, F.expr("budget div tokens").alias("epochs"), F.expr("budget % tokens").alias("rest"))
    rows = leaves.join(plan, levels, "left")
    rank = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("epochs", F.lit(0)).cast("string"), F.lit(":"), F.col("key")).cast("binary"))
    rows = rows.withColumn("rank", rank).withColumn("bucket", F.substring("rank", 1, 3))
    sums = rows.groupBy(*levels, "bucket").agg(F.sum("n_words").alias("in_bucket"))
    ahead = F.coalesce(F.sum("in_bucket").over(W.partitionBy(*levels).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ahead = sums.select(*levels, "bucket", ahead.alias("ahead"))
    inside = F.sum("n_words").over(W.partitionBy(*levels, "bucket").orderBy("rank", "n_words").rangeBetween(W.unboundedPreceding, 0))
    rows = rows.join(ahead, [*levels, "bucket"]).withColumn("upto", F.col("ahead") + inside)
    extra = F.when((F.col("rest") > 0) & (F.col("upto") <= F.col("rest")), 1).otherwise(0)
    return rows.select(*leaves.columns, F.coalesce(F.col("epochs") + extra, F.lit(0)).cast("long").alias("copies"))


def mixed_documents(docs: DataFrame, budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` that the mix holds, each as often as it does, with all their columns, whatever their names."""
    rows = mix(leaves_of(docs, row=True), budget_percent, max_epochs, seed).where("copies > 0")
    if max_epochs > 1:
        rows = rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return rows.select("row.*")


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(leaves_of(documents(spark, sf_dir))).select("doc_id", *LEVELS, "n_words", "copies")


def _level_sql(depth: int) -> str:
    above, level = ", ".join(LEVELS[: depth - 1]), LEVELS[depth - 1]
    weight = {"domain": "CASE WHEN domain = 'domain0' THEN 2 ELSE 1 END", "lang": "CASE WHEN lang = 'en' THEN 4 WHEN lang IN ('de', 'fr') THEN 2 ELSE 1 END", "source": "1"}[level]
    part = f"PARTITION BY {above}" if above else ""
    using = f"JOIN g{depth - 1} USING ({above})" if above else f"CROSS JOIN g{depth - 1}"
    keys = ", ".join(LEVELS[:depth])
    return f"""
c{depth} AS (SELECT {keys}, tokens, capacity, w, budget,
    budget - coalesce(sum(capacity) OVER ({part} ORDER BY capacity::DOUBLE / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(w) OVER ({part} ORDER BY capacity::DOUBLE / w, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM (SELECT *, {weight} AS w FROM n{depth}) {using}),
f{depth} AS (SELECT *, capacity * weights <= rest * w AS full_up FROM c{depth}),
g{depth} AS (SELECT {keys}, tokens, CASE WHEN full_up THEN capacity ELSE (h.r * w) // h.ws END::BIGINT AS budget
  FROM (SELECT *, min(CASE WHEN NOT full_up THEN {{'k': capacity::DOUBLE / w, 'l': {level}, 'r': rest, 'ws': weights}} END) OVER ({part or ''}) AS h FROM f{depth})),"""


SQL = f"""
WITH l AS (SELECT doc_id, concat('domain', CAST(coalesce(TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT), 0) % 3 AS VARCHAR)) AS domain,
    coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD_PATTERN}')) AS BIGINT) AS n_words FROM documents),
n3 AS (SELECT domain, lang, source, sum(n_words)::BIGINT AS tokens, sum(n_words)::BIGINT * {MAX_EPOCHS} AS capacity FROM l GROUP BY ALL HAVING sum(n_words) > 0),
n2 AS (SELECT domain, lang, sum(tokens)::BIGINT AS tokens, sum(capacity)::BIGINT AS capacity FROM n3 GROUP BY ALL),
n1 AS (SELECT domain, sum(tokens)::BIGINT AS tokens, sum(capacity)::BIGINT AS capacity FROM n2 GROUP BY ALL),
g0 AS (SELECT least(sum(tokens)::BIGINT * {BUDGET_PERCENT} // 100, sum(capacity)::BIGINT) AS budget FROM n1),
{"".join(_level_sql(d).replace("tokens, CASE", "CASE") if d < 3 else _level_sql(d) for d in (1, 2, 3)).strip().rstrip(",")},
r AS (SELECT doc_id, domain, lang, source, n_words, budget // tokens AS epochs, budget % tokens AS rest FROM l LEFT JOIN g3 USING (domain, lang, source)),
o AS (SELECT *, md5(concat('{SEED}:', CAST(coalesce(epochs, 0) AS VARCHAR), ':', CAST(doc_id AS VARCHAR))) AS rank FROM r),
u AS (SELECT *, sum(n_words) OVER (PARTITION BY domain, lang, source ORDER BY rank, n_words RANGE UNBOUNDED PRECEDING) AS upto FROM o)
SELECT doc_id, domain, lang, source, n_words, CAST(coalesce(epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END, 0) AS BIGINT) AS copies FROM u
"""
