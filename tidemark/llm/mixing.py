"""Mixing a corpus to target shares by iterative proportional fitting.

Token weights of the cells (source x language x topic) are raked to the three margins in turn
until all of them hold. Documents are then sampled with the calibrated probability of their cell.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import fraction, stored, stored_row
from tidemark.session import inline_rows

MARGINS = ("source", "lang", "topic")
SWEEPS_PER_STEP = 4
LARGEST_BROADCAST = 100_000  # cells; with more of them Spark chooses the join by size


def occurrences(text: Column, part: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)


def token_count(text: Column) -> Column:
    """Words between white space over the whole text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def form_topic(text: Column, tokens: Column) -> Column:
    """A coarse topic from the form of the whole text: listings, shouting, symbols, or length."""
    return (F.when(text.isNull() | (tokens == 0), "empty")
            .when(occurrences(text, " | ") * 3 >= tokens, "listing")
            .when(occurrences(text, "!!") * 2 >= tokens, "shouting")
            .when((occurrences(text, "%%%") + occurrences(text, "###")) * 5 >= tokens, "marked")
            .when(tokens < 100, "brief").when(tokens < 1500, "prose").otherwise("long prose"))


def described(docs: DataFrame) -> DataFrame:
    """The columns that mixing needs: id, the three margins, tokens and a number to sample by."""
    tokens = token_count(F.col("text"))
    return docs.select(
        "doc_id", "source", "lang", form_topic(F.col("text"), tokens).alias("topic"),
        tokens.alias("tokens"), fraction(F.col("doc_id"), F.lit("mixing")).alias("draw"))


def cells_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*MARGINS).agg(F.sum("tokens").cast("double").alias("tokens"),
                                      F.count("*").alias("n_docs"))


def smoothed_targets(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Target shares that flatten the observed ones: share ** power, scaled to one."""
    own = cells.groupBy(margin).agg(F.sum("tokens").alias("t")).where("t > 0")
    total = own.agg(F.sum(F.pow("t", F.lit(power))).alias("total"))
    return own.crossJoin(F.broadcast(total)).select(  # one row
        margin, (F.pow("t", F.lit(power)) / F.col("total")).alias("share"))


def given_targets(cells: DataFrame, margin: str, shares: dict[str, float]) -> DataFrame:
    """Target shares by value; values that are not listed share the rest as observed.

    Listed values without tokens are left out and the others scaled up.
    """
    spark = cells.sparkSession
    own = cells.groupBy(margin).agg(F.sum("tokens").alias("t")).where("t > 0")
    listed = inline_rows(spark, {"value": "string", "given": "double"}, shares.items())
    joined = own.join(listed, own[margin] == listed["value"], "left")
    rest = max(1 - sum(shares.values()), 0.0)
    sums = joined.agg(F.sum("given").alias("g"),
                      F.sum(F.when(F.col("given").isNull(), F.col("t"))).alias("u"))
    raw = joined.crossJoin(F.broadcast(sums)).withColumn(  # one row
        "raw", F.coalesce("given", F.lit(rest) * F.col("t") / F.col("u")))
    total = raw.agg(F.sum("raw").alias("total"))
    return raw.crossJoin(F.broadcast(total)).select(margin, (F.col("raw") / F.col("total")).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = 1e-6,
         most_sweeps: int = 200) -> DataFrame:
    """Cells with `raked` token weights whose margins are the targets, `converged` and `sweeps`.

    Null is a value like any other. Weights keep the total. A value without a target keeps its
    observed weight. Where margins contradict each other the sweeps end after `most_sweeps` and
    `converged` is false. Cells are aggregates, so all work here is on categories, not documents.
    """
    total = stored_row(cells.agg(F.sum("tokens").alias("t"))).t or 0.0
    work = cells.withColumn("raked", F.col("tokens"))
    for margin, shares in targets.items():
        right = shares.select(F.col(margin).alias("__value"),
                              (F.col("share") * total).alias(f"__{margin}"))
        work = work.join(right, work[margin].eqNullSafe(right["__value"]), "left").drop("__value")
    work = stored(work)
    sweeps, converged = 0, False
    while not converged and sweeps < most_sweeps:
        for _ in range(SWEEPS_PER_STEP):
            for margin in targets:
                held = F.sum("raked").over(Window.partitionBy(margin))
                work = work.withColumn("raked", F.when(
                    F.col(f"__{margin}").isNull() | (held == 0), F.col("raked")).otherwise(
                        F.col("raked") * F.col(f"__{margin}") / held))
        work = stored(work)
        sweeps += SWEEPS_PER_STEP
        gaps = [work.groupBy(m).agg(F.abs(F.sum("raked") / F.first(f"__{m}") - 1).alias("gap"))
                .select("gap") for m in targets]
        worst = stored_row(reduce(DataFrame.union, gaps).agg(F.max("gap").alias("gap"))).gap
        converged = worst is None or worst <= tolerance
    return work.drop(*[f"__{m}" for m in targets]).withColumns(
        {"converged": F.lit(converged), "sweeps": F.lit(sweeps)})


def probabilities(raked: DataFrame, budget: float) -> DataFrame:
    """Cells with the probability that one of their documents is taken.

    It is min(1, rate * raked / tokens). The rate makes the expected tokens the budget share of
    the corpus; a cell that would need more than all of its documents is `saturated`, and the
    rate of the others makes up for it. Cells without tokens count as already balanced.
    """
    cells = stored(raked.withColumn(
        "factor", F.when(F.col("tokens") > 0, F.col("raked") / F.col("tokens")).otherwise(1.0)))
    wanted = budget * (stored_row(cells.agg(F.sum("tokens").alias("t"))).t or 0.0)
    rate, full = budget, -1
    while True:
        over = F.col("factor") * rate >= 1
        row = stored_row(cells.agg(
            F.count_if(over).alias("n"), F.sum(F.when(over, F.col("tokens"))).alias("held"),
            F.sum(F.when(~over, F.col("raked"))).alias("free")))
        if row.n <= full or not row.free:
            break
        full = row.n
        rate = max((wanted - (row.held or 0.0)) / row.free, rate)
    return cells.withColumns({
        "probability": F.least(F.lit(1.0), F.col("factor") * rate),
        "saturated": F.col("factor") * rate >= 1})


def with_probability(rows: DataFrame, cells: DataFrame) -> DataFrame:
    right = cells.select(*[F.col(m).alias(f"__{m}") for m in MARGINS], "probability",
                         "saturated", "converged")
    right = stored(right)
    if right.count() <= LARGEST_BROADCAST:
        right = F.broadcast(right)
    match = reduce(Column.__and__, [rows[m].eqNullSafe(right[f"__{m}"]) for m in MARGINS])
    return rows.join(right, match).drop(*[f"__{m}" for m in MARGINS])


def calibrated(rows: DataFrame, power: float, budget: float) -> DataFrame:
    """Cells of described documents, raked to smoothed margins, with probabilities."""
    cells = stored(cells_of(rows))
    targets = {m: smoothed_targets(cells, m, power) for m in MARGINS}
    return probabilities(rake(cells, targets), budget)


def mixed(docs: DataFrame, power: float = 0.7, budget: float = 0.7) -> DataFrame:
    """doc_id, margins, tokens, probability, chosen for every row of `docs`.

    The draw depends on the id alone: rows with equal ids are drawn alike, a null id counts as
    the empty text. Null margins are categories. An empty table gives an empty result. Other
    columns are not read.
    """
    rows = stored(described(docs))
    out = with_probability(rows, calibrated(rows, power, budget))
    return out.select("doc_id", *MARGINS, "tokens", "probability", "saturated", "converged",
                      (F.col("draw") < F.col("probability")).alias("chosen"))


def sampled(docs: DataFrame, power: float = 0.7, budget: float = 0.7) -> DataFrame:
    """The rows of `docs` that the calibrated sample takes, all columns as they came.

    Rows with a null or empty text have no tokens but a place in the margins, and are drawn like
    others; null sources and languages are categories. The draw depends on the id alone, so
    repeated rows stay or go together. An empty table gives an empty result. Columns of any other
    name are kept.
    """
    cells = calibrated(stored(described(docs)), power, budget)
    names = {c: f"__own_{c}" for c in docs.columns if c not in ("doc_id", "source", "lang", "text")}
    tokens = token_count(F.col("text"))
    rows = docs.withColumnsRenamed(names).withColumns({
        "topic": form_topic(F.col("text"), tokens),
        "draw": fraction(F.col("doc_id"), F.lit("mixing"))})
    out = with_probability(rows, cells).where(F.col("draw") < F.col("probability"))
    return out.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])
