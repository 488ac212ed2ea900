"""Mixing sources to target weights by hierarchical budgeting, in DataFrame
functions only.

The leaves of a domain - language - source tree hold documents; every node
has a weight among its siblings. The token budget goes down from the root:
the children of a node share its budget by weight, a child that cannot use
its share (its documents, ``max_epochs`` times over, are fewer) takes what it
can, and what is short goes to its siblings by weight. Only what all siblings
cannot use is left for the children of the ancestor, since a node's own
capacity is the sum of its children's. Each leaf then takes whole epochs of
its documents and of the next, in an order shuffled by the seed and the epoch
number, the prefix of documents that fits the rest.

All budgets are whole numbers: a share is rounded down to whole tokens. The
running sums inside a leaf go by ranges of the shuffle key: only the range in
which the budget runs out is ordered row by row, so a leaf with a third of all
rows is not one task's work.

Tokens are words `[^\\x20\\x09-\\x0D]+`. Defined cases: a null or empty text has no
tokens (it is in every epoch and fits while its place in the order is
reached); a null in a level column is a node of its own, named ''; equal rows
are told apart by nothing and so ranked anyhow among themselves; an empty
table gives an empty result; columns of the names that are added or used
inside are replaced; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import staged

WORD = r"[^\x20\x09-\x0D]+"
RANGE_TOKENS = 4_000_000  # at most about so many per range of the shuffle key


@dataclass(frozen=True)
class Mix:
    """Targets. Weights are whole numbers by level and node name, 1 if absent."""

    levels: tuple[str, ...] = ("domain", "lang", "source")
    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    budget_percent: int = 80  # of all tokens
    max_epochs: int = 2
    seed: int = 7


DEFAULT_MIX = Mix(weights={"domain": {"a": 4, "b": 3, "c": 2, "d": 1}, "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}})


def domain_of(source: str = "source") -> Column:
    """The tables have no domain: sources fall into four by a checksum of their name."""
    digit = F.conv(F.substring(F.md5(F.coalesce(F.col(source), F.lit(""))), 1, 1), 16, 10).cast("int")
    return F.element_at(F.array(*map(F.lit, "abcd")), digit % 4 + 1)


def token_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _weight(level: str, mix: Mix) -> Column:
    known = mix.weights.get(level)
    if not known:
        return F.lit(1).cast("long")
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in known.items() for x in kv]), F.col(level)),
                      F.lit(1)).cast("long")


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``leaves`` (levels, tokens) with the column budget. Windows go over the
    children of one node: rows of the tree, never documents."""
    total = leaves.agg(F.sum("tokens").alias("tokens")).first().tokens or 0
    above: list[str] = []
    given = None  # budgets of the nodes of the level above
    for level in mix.levels:
        nodes = leaves.groupBy(*above, level).agg((F.sum("tokens") * mix.max_epochs).alias("most")) \
            .withColumn("weight", _weight(level, mix))
        nodes = nodes.join(given, above) if above else nodes.withColumn("budget", F.lit(total * mix.budget_percent // 100).cast("long"))
        # children by how soon they are full: capacity over weight
        upto = Window.partitionBy(*above).orderBy(F.col("most") / F.col("weight"), level) \
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        family = Window.partitionBy(*above)
        nodes = nodes.withColumns({"most_upto": F.sum("most").over(upto), "weight_upto": F.sum("weight").over(upto),
                                   "weight_all": F.sum("weight").over(family)})
        # full if what it and the fuller ones hold, and the shares of the others at its filling, fit the budget
        nodes = nodes.withColumn("full", _wide("most_upto") * F.col("weight")
                                 + _wide("most") * (F.col("weight_all") - F.col("weight_upto")) <= _wide("budget") * F.col("weight"))
        nodes = nodes.withColumns({"shared": F.col("budget") - F.sum(F.when(F.col("full"), F.col("most")).otherwise(0)).over(family),
                                   "sharers": F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(family)})
        nodes = nodes.withColumn("budget", F.expr(
            "CASE WHEN full THEN most ELSE (CAST(weight AS DECIMAL(19,0)) * CAST(shared AS DECIMAL(19,0))) div sharers END"))
        above = [*above, level]
        given = nodes.select(*above, "budget")
    return leaves.join(given, above)


def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def _place(mix: Mix, id_col: str) -> Column:
    """Where a document stands in the order of an epoch: 32 bits of a checksum."""
    named = F.concat_ws(":", F.lit(mix.seed), F.col("epochs"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("long")


def mix_sources(docs: DataFrame, mix: Mix = DEFAULT_MIX, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with n_tokens and copies: how often the mix takes each document
    (0: not at all). The level columns are read as text."""
    levels = [f"_{x}" for x in mix.levels]
    docs = docs.drop("n_tokens", "copies", "epochs", "cut", "_text_hash", *levels)
    inner = Mix(tuple(levels), {f"_{k}": v for k, v in mix.weights.items()}, mix.budget_percent, mix.max_epochs, mix.seed)
    rows = docs.withColumns({f"_{x}": F.coalesce(F.col(x).cast("string"), F.lit("")) for x in mix.levels}
                            | {"n_tokens": token_count(text_col), "_text_hash": F.xxhash64(text_col)})
    keys = staged(rows.select(*levels, "n_tokens", "_text_hash", F.col(id_col).alias("_id")), "mix-keys")
    # a row per leaf; Spark broadcasts it below where its measured size allows
    leaves = staged(leaf_budgets(keys.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows")), inner).select(
        *levels, "tokens", "budget", F.expr("IF(tokens = 0, 0, budget div tokens)").cast("int").alias("epochs"),
        F.expr("IF(tokens = 0, 0, budget % tokens)").alias("rest"),
        # at least as many ranges as rows in each: neither the window over a leaf's ranges nor that over a range's rows grows large
        F.expr(f"greatest(tokens div {RANGE_TOKENS} + 1, ceil(sqrt(rows)))").alias("ranges")), "mix-leaves")
    placed = keys.join(leaves.drop("budget", "tokens"), levels).withColumn("place", _place(mix, "_id")) \
        .withColumn("range", F.shiftright(F.col("place") * F.col("ranges"), 32))
    in_range = [*levels, "range"]
    # the one range of a leaf in which the rest of its budget runs out ...
    upto = F.sum("range_tokens").over(Window.partitionBy(*levels).orderBy("range"))
    ends = placed.groupBy(*in_range).agg(F.sum("n_tokens").alias("range_tokens"), F.first("rest").alias("rest")) \
        .withColumn("before", upto - F.col("range_tokens")) \
        .filter("before <= rest AND before + range_tokens > rest").select(*in_range, "before")
    # ... is ordered row by row: the first document that does not fit ends the prefix
    row_order = Window.partitionBy(*in_range).orderBy("place", "_id", "_text_hash") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = placed.join(staged(ends, "mix-ends"), in_range).withColumn("upto", F.col("before") + F.sum("n_tokens").over(row_order)) \
        .filter("upto > rest").groupBy(*levels).agg(F.min(F.struct("place", "_id", "_text_hash")).alias("cut"))
    plan = staged(leaves.join(cut, levels, "left").select(*levels, "epochs", "cut"), "mix-plan")
    here = F.struct(_place(mix, id_col).alias("place"), F.col(id_col).alias("_id"), F.col("_text_hash"))
    begun = (F.col("epochs") < mix.max_epochs) & (F.col("cut").isNull() | (here < F.col("cut")))
    return rows.join(plan, levels).withColumn("copies", F.col("epochs") + begun.cast("int")) \
        .drop(*levels, "_text_hash", "epochs", "cut")


def _level_sql(level: str, above: str, known: dict[str, int]) -> str:
    """Oracle of one level: the same sharing, written for whole numbers in DuckDB."""
    name = level
    weight = "CASE " + level + "".join(f" WHEN '{k}' THEN {v}" for k, v in known.items()) + " ELSE 1 END" if known else "1"
    keys = f"{above}, {level}" if above else level
    part = f"PARTITION BY {above}" if above else ""
    upper = f"JOIN b_{above.split(', ')[-1]} USING ({above})" if above else \
        f"CROSS JOIN (SELECT sum(tokens)::HUGEINT * {DEFAULT_MIX.budget_percent} // 100 AS budget FROM leaves)"
    return f"""
s_{name} AS (SELECT {keys}, (sum(tokens) * {DEFAULT_MIX.max_epochs})::HUGEINT AS most, ({weight})::HUGEINT AS weight FROM leaves GROUP BY {keys}),
f_{name} AS (SELECT *, sum(most) OVER u * weight + most * (sum(weight) OVER ({part}) - sum(weight) OVER u) <= budget * weight AS is_full
  FROM s_{name} {upper} WINDOW u AS ({part} ORDER BY most / weight, {level} ROWS UNBOUNDED PRECEDING)),
b_{name} AS (SELECT {keys}, CASE WHEN is_full THEN most ELSE weight * (budget - sum(CASE WHEN is_full THEN most ELSE 0 END) OVER ({part}))
  // sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({part}) END AS budget FROM f_{name}),"""


MIX_SQL = f"""
WITH docs AS (
  SELECT doc_id, lang, source, chr(97 + ('0x' || left(md5(source), 1))::INTEGER % 4) AS domain,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM docs GROUP BY ALL),
{_level_sql('domain', '', DEFAULT_MIX.weights['domain'])}
{_level_sql('lang', 'domain', DEFAULT_MIX.weights['lang'])}
{_level_sql('source', 'domain, lang', {})}
plan AS (SELECT domain, lang, source, budget // tokens AS epochs, budget % tokens AS rest FROM leaves JOIN b_source USING (domain, lang, source)),
ordered AS (SELECT doc_id, domain, n_tokens, epochs, rest, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY
    ('0x' || left(md5('{DEFAULT_MIX.seed}:' || epochs || ':' || doc_id), 8))::BIGINT, doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM docs JOIN plan USING (domain, lang, source))
SELECT doc_id, domain, n_tokens::BIGINT AS n_tokens,
       (epochs + CASE WHEN epochs < {DEFAULT_MIX.max_epochs} AND upto <= rest THEN 1 ELSE 0 END)::INTEGER AS copies
FROM ordered
"""
