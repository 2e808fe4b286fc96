"""Dates: tolerant parsing, calendar grain, period anchors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark import knowledge as K
from tidemark.functions.names import type_family

# Fixed value: quarter texts such as 2025 Q4, 2025Q4, Q4 2025, Q4/2025, Q4-2025.
QUARTER_PATTERN = r"(?:(\d{4})\s*[Qq](\d)|[Qq](\d)\s*[/\-]?\s*(\d{4}))"


# Text forms of a date, the first that reads a value wins: name, what the text
# looks like, Spark's pattern for it. Names of months may be in any case.
TEXT_FORMS = [
    ("year month", r"^\d{4}[-/]\d{1,2}$", "yyyy-M"),
    ("compact", r"^(19|20)\d{6}$", "yyyyMMdd"),
    ("year first", r"^\d{4}[/.]\d{1,2}[/.]\d{1,2}$", "yyyy-M-d"),
    ("month first", r"^\d{1,2}[-/.]\d{1,2}[-/.]\d{4}$", "M-d-yyyy"),
    ("day first", r"^\d{1,2}[-/.]\d{1,2}[-/.]\d{4}$", "d-M-yyyy"),
    ("short month first", r"^\d{1,2}[-/.]\d{1,2}[-/.]\d{2}$", "M-d-yy"),
    ("short day first", r"^\d{1,2}[-/.]\d{1,2}[-/.]\d{2}$", "d-M-yy"),
    ("day, name of month", r"^\d{1,2}[- ./][A-Za-z]{3}[- ./]\d{4}$", "d-MMM-yyyy"),
    ("day, name of month, short", r"^\d{1,2}[- ./][A-Za-z]{3}[- ./]\d{2}$", "d-MMM-yy"),
    ("day, whole name of month", r"^\d{1,2}[- ./][A-Za-z]{3,9}[- ./]\d{4}$", "d-MMMM-yyyy"),
    ("name of month, day", r"^[A-Za-z]{3}[- ./]\d{1,2}[- ./]\d{4}$", "MMM-d-yyyy"),
    ("whole name of month, day", r"^[A-Za-z]{3,9}[- ./]\d{1,2}[- ./]\d{4}$", "MMMM-d-yyyy"),
    ("name of month", r"^[A-Za-z]{3}[- ./]\d{4}$", "MMM-yyyy"),
    ("whole name of month", r"^[A-Za-z]{3,9}[- ./]\d{4}$", "MMMM-yyyy"),
]
FORMS = [name for name, _, _ in TEXT_FORMS]
NEWEST_SHORT_YEAR = 2068  # 69 to 99 are of the last century


def text_form(text: Column, name: str) -> Column:
    """A trimmed text read in one form; null where it does not look like it or is no date."""
    looks, pattern = next((a, b) for n, a, b in TEXT_FORMS if n == name)
    words = F.initcap(F.regexp_replace(F.lower(text), "[-/., ]+", " "))
    found = F.try_to_date(F.regexp_replace(words, " ", "-"), pattern)
    if pattern.endswith("-yy"):
        found = F.when(F.year(found) > NEWEST_SHORT_YEAR, F.add_months(found, -1200)).otherwise(found)
    return F.when(F.regexp_replace(text, ", ?", " ").rlike(looks), found)


def parse_date(c: Column, is_text: bool = True, forms: list[str] | None = None) -> Column:
    """A date from a date, a timestamp, an ISO text, a quarter text, a bare year or a text form.

    ``forms`` orders the text forms, which decides texts that several of them read.
    """
    if not is_text:
        return c.cast("date")
    text = F.trim(c.cast("string"))
    year = F.coalesce(F.nullif(F.regexp_extract(text, QUARTER_PATTERN, 1), F.lit("")),
                      F.nullif(F.regexp_extract(text, QUARTER_PATTERN, 4), F.lit("")))
    quarter = F.coalesce(F.nullif(F.regexp_extract(text, QUARTER_PATTERN, 2), F.lit("")),
                         F.nullif(F.regexp_extract(text, QUARTER_PATTERN, 3), F.lit("")))
    year, quarter = year.cast("int"), quarter.cast("int")
    is_quarter = quarter.between(1, 4)
    quarter_start = F.make_date(
        F.when(is_quarter, year), F.when(is_quarter, quarter * 3 - 2), F.lit(1))
    bare_year = F.when(
        text.rlike(r"^(19\d\d|20\d\d|2100)$"), F.make_date(text.try_cast("int"), F.lit(1), F.lit(1)))
    compact = text.rlike(r"^\d{5,}$")  # Spark would read a year of many digits
    return F.coalesce(
        quarter_start, bare_year, F.when(~compact, F.try_to_timestamp(text).cast("date")),
        *[text_form(text, f) for f in (FORMS if forms is None else forms)])


def date_forms(tables: dict[str, tuple[DataFrame, list[str]]]) -> dict[tuple[str, str], list[str]]:
    """(table, column) -> the text forms of its text columns, by how many values each reads.

    All values of a column vote, in one aggregate for all tables; so days before months are told
    from months before days by the whole column, equally good forms keep their listed order, and
    forms that read nothing go.
    """
    parts = []
    for name, (df, columns) in tables.items():
        texts = [c for c in columns if type_family(df.schema[c].dataType) == "string"]
        if texts:
            rows = F.array(*[F.struct(F.lit(c).alias("column"), F.trim(F.col(f"`{c}`")).alias("text"))
                             for c in texts])
            parts.append(df.select(F.lit(name).alias("table"), F.explode(rows).alias("r"))
                         .select("table", "r.*"))
    if not parts:
        return {}
    votes = reduce(DataFrame.union, parts).groupBy("table", "column").agg(
        F.array(*[F.count(text_form(F.col("text"), f)) for f in FORMS]).alias("votes")).collect()
    return {(r["table"], r["column"]): [FORMS[i] for i in sorted(
        range(len(FORMS)), key=lambda i: -r["votes"][i]) if r["votes"][i]] for r in votes}


def day_of(df: DataFrame, column: str, forms: list[str] | None = None) -> Column:
    """A column of any type as a date: dates and timestamps as they are, texts and years parsed.

    Whole numbers are read as texts, so 1997 is a year; what cannot be read is null.
    """
    c, kind = F.col(f"`{column}`"), type_family(df.schema[column].dataType)
    if kind == "date":
        return c.cast("date")
    if kind == "numeric":
        return parse_date(c.try_cast("bigint"))
    return parse_date(c, forms=forms)


def with_dates(df: DataFrame, columns: list[str],
               forms: dict[str, list[str]] | None = None) -> DataFrame:
    """The table with those columns turned into dates, once, before anything else reads them.

    ``forms`` are the columns' text forms; without them the column's values vote (`date_forms`).
    """
    odd = [c for c in columns if type_family(df.schema[c].dataType) != "date"]
    if forms is None:
        forms = {c: f for (_, c), f in date_forms({"": (df, odd)}).items()}
    return df.withColumns({c: day_of(df, c, forms.get(c)) for c in odd}) if odd else df


def with_all_dates(tables: dict[str, tuple[DataFrame, list[str]]]) -> dict[str, DataFrame]:
    """`with_dates` of many tables, after one vote for all of them."""
    voted = date_forms(tables)
    return {name: with_dates(df, columns, {c: f for (n, c), f in voted.items() if n == name})
            for name, (df, columns) in tables.items()}


def unparsed_dates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per date column: ``name, n_values, n_unparsed``."""
    rows = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").isNotNull().alias("has"),
                              day_of(df, c).isNotNull().alias("read")) for c in columns])
    return df.select(F.explode(rows).alias("r")).groupBy("r.name").agg(
        F.count_if("r.has").alias("n_values"),
        F.count_if(F.col("r.has") & ~F.col("r.read")).alias("n_unparsed"))


def grain_of(median_gap: Column) -> Column:
    """Grain name of a median gap in days; gaps between the bands have no name."""
    return (
        F.when(median_gap <= 2, "daily")
        .when(median_gap.between(5, 9), "weekly")
        .when(median_gap.between(25, 35), "monthly")
        .when(median_gap.between(80, 100), "quarterly")
    )


def median_gaps(df: DataFrame, columns: list[str]) -> DataFrame:
    """Median whole-day gap between consecutive distinct moments per date column.

    Two neighbours on one day are less than a whole day apart, so a day with n moments adds
    n-1 gaps of zero and only its first and last moment matter. All ordering is therefore on
    one row per calendar day, however many rows the table has.
    Returns ``name, n_moments, median_gap, date_grain``.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), moment_of(df, c).alias("at"))
                      for c in columns])
    return gaps_by(df.select(F.explode(pairs).alias("p")).select("p.name", "p.at"), ["name"])


def moment_of(df: DataFrame, column: str) -> Column:
    is_date = type_family(df.schema[column].dataType) == "date"
    return (F.col(f"`{column}`") if is_date else day_of(df, column)).cast("timestamp_ntz")


def gaps_by(moments: DataFrame, keys: list[str]) -> DataFrame:
    """`median_gaps` of stacked moments ``at``, per key: one plan for any number of columns."""
    moments = moments.where("at IS NOT NULL").distinct()
    days = moments.groupBy(*keys, F.to_date("at").alias("day")).agg(
        F.count("*").alias("n"), F.min("at").alias("first_at"), F.max("at").alias("last_at"))
    in_order = Window.partitionBy(*keys).orderBy("day")
    time_of_day = lambda c: F.date_format(c, "HH:mm:ss.SSSSSS")
    last_at, last_day = F.lag("last_at").over(in_order), F.lag("day").over(in_order)
    # Whole days from the last moment of one day to the first moment of the next used day.
    cut_short = (time_of_day(F.col("first_at")) < time_of_day(last_at)).cast("int")
    steps = days.withColumn("gap", F.datediff("day", last_day) - cut_short)
    gaps = (
        steps.select(*keys, F.explode(F.array(
            F.struct(F.lit(0).cast("bigint").alias("gap"), (F.col("n") - 1).alias("c")),
            F.struct(F.col("gap").cast("bigint").alias("gap"), F.lit(1).cast("bigint").alias("c")),
        )).alias("g"))
        .select(*keys, "g.gap", "g.c").where("gap IS NOT NULL AND c > 0")
        .groupBy(*keys, "gap").agg(F.sum("c").alias("c"))
    )
    by_gap = Window.partitionBy(*keys).orderBy("gap")
    whole = Window.partitionBy(*keys)
    ranked = (
        gaps.withColumn("upto", F.sum("c").over(by_gap))
        .withColumn("before", F.col("upto") - F.col("c"))
        .withColumn("n", F.sum("c").over(whole))
        .withColumn("r0", F.floor((F.col("n") - 1) / 2))
        .withColumn("r1", F.ceil((F.col("n") - 1) / 2))
    )
    at = lambda r: F.max(F.when(
        (F.col(r) >= F.col("before")) & (F.col(r) < F.col("upto")), F.col("gap")))
    medians = ranked.groupBy(*keys).agg(((at("r0") + at("r1")) / 2).alias("median_gap"))
    totals = days.groupBy(*keys).agg(F.sum("n").alias("n_moments"))
    return totals.join(medians, keys, "left").select(
        *keys, "n_moments", "median_gap", grain_of(F.col("median_gap")).alias("date_grain"))


def week_start(c: Column) -> Column:
    """The Monday of the week a date falls in."""
    return F.to_date(F.date_trunc("week", c))


def week_end_saturday(c: Column) -> Column:
    """The Saturday that closes the Sunday-to-Saturday week a date falls in."""
    return F.next_day(F.date_sub(c.cast("date"), 1), "SAT")


def hazard_of(grain: Column) -> Column:
    """Expected run length in periods for a grain."""
    pairs = [x for item in K.HAZARD_BY_GRAIN.items() for x in item]
    return F.coalesce(F.create_map(*[F.lit(x) for x in pairs])[grain], F.lit(K.DEFAULT_HAZARD))
