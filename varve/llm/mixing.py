"""Mixing sources to target weights by hierarchical budgets, in DataFrame functions only."""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varve.llm.common import WORD, text_of
from varve.session import materialize

LEVELS = ("domain", "lang", "source")
# Weights among siblings, by level and name; all others weigh 1.
MIX_WEIGHTS = {"lang": {"en": 4, "de": 2, "fr": 2, "es": 2}}
# Part of all tokens that the mix takes, exact as a decimal.
MIX_SHARE = 0.9
# Documents that share one range of the seeded order, on average.
RANGE_ROWS = 1000

BIG = "decimal(38,0)"
HALF = "decimal(19,0)"


def domain_of(source: str = "source", domains: int = 4) -> Column:
    """The domain of a source: the number at its end, modulo ``domains``; 0 without one."""
    digits = F.regexp_extract(F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")), r"([0-9]{1,9})$", 1)
    number = F.coalesce(digits.try_cast("long") % domains, F.lit(0))
    return F.concat(F.lit("domain"), number)


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    """Weight of a node among its siblings: a positive whole number, 1 unless told."""
    found = F.lit(1)
    for name, weight in weights.get(level, {}).items():
        found = F.when(F.col(level) == name, F.lit(int(weight))).otherwise(found)
    return found.cast(HALF)


def budgets(leaves: DataFrame, share: float, weights: dict[str, dict[str, int]], epochs: int) -> DataFrame:
    """``leaves`` (the levels, ``tokens``) with ``quota``: the tokens that each leaf is to give.

    A node can give at most ``epochs`` times its tokens. From the root down, a node's budget is
    dealt to its children by weight; children that cannot use their part are full, and the rest
    goes to their siblings by weight. So a shortage stays among siblings as long as these have
    tokens, and reaches an ancestor's siblings only when the whole subtree is full.

    The children of a node, ordered by the tokens they have for each unit of weight, become full in
    that order: a child is full if the budget covers it and all before it, and gives all later
    ones as much for their weight as it has. Whole numbers throughout; shares round down.
    """
    tree = leaves.select("all", *LEVELS, (F.col("tokens") * epochs).cast(BIG).alias("capacity"))
    node = leaves.groupBy("all").agg(F.floor(F.sum("tokens").cast(HALF) * F.lit(str(share)).cast("decimal(18,9)")).cast(BIG).alias("budget"))
    upper = ["all"]
    for level in LEVELS:
        children = tree.groupBy(*upper, level).agg(F.sum("capacity").cast(HALF).alias("capacity")).join(node, upper)
        family = Window.partitionBy(*upper)
        ordered = family.orderBy(F.col("capacity").cast("double") / F.col("weight").cast("double"), level)
        walked = (
            children.withColumn("weight", _weight(level, weights))
            .withColumn("to_here", F.sum("capacity").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("later", F.coalesce(F.sum("weight").over(ordered.rowsBetween(1, Window.unboundedFollowing)), F.lit(0)))
            .withColumn(
                "full",
                F.col("weight") * (F.col("budget") - F.col("to_here")).cast(HALF)
                >= F.col("capacity") * F.col("later").cast(HALF),
            )
            .withColumn("used", F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(family), F.lit(0)))
            .withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight"))).over(family))
        )
        part = F.expr(f"(CAST(budget - used AS {HALF}) * weight) div CAST(open AS {HALF})")
        upper = [*upper, level]
        node = walked.select(*upper, F.when(F.col("full"), F.col("capacity")).otherwise(part).cast(BIG).alias("budget"))
    return leaves.join(node, upper).withColumn("quota", F.col("budget").cast("long")).drop("budget")


def _cuts(narrow: DataFrame, plan: DataFrame, rows: int, leaf: list[str]) -> DataFrame:
    """Per leaf, the last place of the seeded order that its rest still covers.

    Tokens are summed by range of places first: the ranges below the cut are whole, and only the
    range that holds the cut is ordered place by place. Equal places (repeated rows) are one.
    """
    digits = max(1, min(12, ceil(log(max(rows, 1) / RANGE_ROWS + 1, 16))))
    open_leaves = plan.where("rest > 0").select(*leaf, "full_epochs", "rest")
    placed = narrow.join(open_leaves, leaf).select(
        *leaf, "rest", "n_tokens", F.md5(F.concat(F.col("mark"), F.col("full_epochs"), F.col("tail"))).alias("place")
    )
    placed = materialize(placed.withColumn("head", F.substring("place", 1, digits)), "places")
    by_head = Window.partitionBy(*leaf).orderBy("head")
    ranges = placed.groupBy(*leaf, "rest", "head").agg(F.sum("n_tokens").alias("tokens"))
    ranges = ranges.withColumn("to_here", F.sum("tokens").over(by_head.rowsBetween(Window.unboundedPreceding, 0)))
    # The first range that does not fit whole holds the cut.
    torn = ranges.where("to_here > rest").groupBy(*leaf, "rest").agg(F.min(F.struct("head", "to_here", "tokens")).alias("r"))
    torn = torn.select(*leaf, "rest", F.col("r.head").alias("head"), (F.col("r.to_here") - F.col("r.tokens")).alias("before"))
    places = placed.join(torn, [*leaf, "rest", "head"]).groupBy(*leaf, "rest", "before", "head", "place")
    places = places.agg(F.sum("n_tokens").alias("tokens"))
    by_place = Window.partitionBy(*leaf).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    within = places.withColumn("to_here", F.col("before") + F.sum("tokens").over(by_place)).where("to_here <= rest")
    last = within.groupBy(*leaf).agg(F.max("place").alias("last"))
    # Without a place of its own range that fits, the cut lies just below that range.
    return torn.join(last, leaf, "left").select(*leaf, F.coalesce("last", "head").alias("cut"))


def mix(
    docs: DataFrame,
    share: float,
    weights: dict[str, dict[str, int]],
    epochs: int = 2,
    seed: str = "mix",
    text: str = "text",
    id_column: str = "doc_id",
    domain: Column | None = None,
    out: tuple[str, str] = ("mix_tokens", "mix_copies"),
) -> DataFrame:
    """The chosen rows of ``docs``, with two columns more: tokens, and how often the row is taken.

    ``docs`` has the columns ``lang`` and ``source``, and ``domain`` unless that is given; a null
    there is the empty name.
    The budget is ``share`` of all tokens, which are words between ASCII white space. A leaf whose
    quota is q gives q div T whole epochs of its T tokens, and of the next epoch the longest prefix
    that fits what is left. The order of an epoch is seeded by ``seed`` and the epoch's number.

    Rows equal in id and text have one place in that order and stand or fall together. Texts
    without tokens cost nothing: they are taken as often as their place is within the prefix. A
    leaf without any tokens gives all its rows ``epochs`` times. An empty table gives none. Columns
    may have any name but those of ``out``.

    A leaf is summed in ranges of its seeded order, so no leaf, however large, is ordered in one
    task; what comes back is a filter on the place of each row.
    """
    if {c.lower() for c in out} & {c.lower() for c in docs.columns}:
        raise ValueError(f"there are columns {out} already")
    leaf = ["all", *LEVELS]
    body = text_of(text)

    def inner(df: DataFrame, *more: Column) -> DataFrame:
        given = {level: F.col(f"`{level}`") for level in LEVELS} | ({} if domain is None else {"domain": domain})
        names = [F.coalesce(given[level].cast("string"), F.lit("")).alias(level) for level in LEVELS]
        own = F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))
        return df.select(
            F.lit(0).alias("all"),
            *names,
            F.lit(f"{seed}:").alias("mark"),
            F.concat(F.lit(":"), own, F.lit(":"), F.md5(body)).alias("tail"),
            F.regexp_count(body, F.lit(WORD)).cast("long").alias("n_tokens"),
            *more,
        )

    narrow = materialize(inner(docs), "narrow")
    rows = narrow.count()
    leaves = narrow.groupBy(*leaf).agg(F.sum("n_tokens").alias("tokens"))
    quotas = budgets(leaves, share, weights, epochs)
    plan = quotas.select(
        *leaf,
        F.when(F.col("tokens") == 0, F.lit(epochs)).otherwise(F.expr("quota div nullif(tokens, 0)")).cast("long").alias("full_epochs"),
        F.when(F.col("tokens") == 0, F.lit(0)).otherwise(F.expr("quota % nullif(tokens, 0)")).cast("long").alias("rest"),
    )
    plan = materialize(plan, "plan")
    cuts = _cuts(narrow, plan, rows, leaf)
    plan = materialize(plan.join(cuts, leaf, "left"), "cuts")
    whole = inner(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    taken = whole.join(plan, leaf).withColumn(
        "place", F.md5(F.concat(F.col("mark"), F.col("full_epochs"), F.col("tail")))
    )
    # Without a cut the rest of the leaf, if any, covers no range whole and no place, or all of them.
    within = (F.col("full_epochs") < epochs) & F.when(
        F.col("cut").isNotNull(), F.col("place") <= F.col("cut")
    ).otherwise(F.col("rest") > 0)
    copies = F.col("full_epochs") + F.when(within, 1).otherwise(0)
    return (
        taken.withColumn("copies", copies)
        .where("copies > 0")
        .select(
            *[F.col(f"row.`{c}`").alias(c) for c in docs.columns],
            F.col("n_tokens").alias(out[0]),
            F.col("copies").cast("long").alias(out[1]),
        )
    )
