"""Meetings, deals, surveys and the assistant panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import iso_week_key, week_start
from ..functions.money import percent, sum_if
from ..functions.text import is_true_text
from ..session import cut_lineage
from ..operators.asof import asof_join
from ..operators.ranking import top_n

# Meeting results that count as closed.
CLOSED_RESULTS = ["Fechou negocio", "Fechou negócio", "Upgrade", "Reativacao", "Reativação"]


def deal_meetings(deals: DataFrame, meetings: DataFrame) -> DataFrame:
    """Each deal with the latest earlier meeting of its company.

    Meetings of the same instant go by owner order, then by id.
    """
    return asof_join(deals, meetings, "company_id", "close_at", "start_at", ["owner_rank", "meeting_id"])


def weekly_matrix(meetings: DataFrame, matched_deals: DataFrame) -> DataFrame:
    """Meetings and won deals per owner and week, zero where none.

    Weeks are those with any meeting or deal; deals count in the week of their
    meeting.
    """
    nil = F.lit(0).cast("long")
    held = meetings.groupBy("owner_rank", week_start(F.col("start_at")).alias("week")).agg(
        F.count("*").alias("meetings"), nil.alias("deals")
    )
    owner, met = F.col("match.owner_rank"), week_start(F.col("match.start_at"))
    won = matched_deals.filter("match is not null").groupBy(owner.alias("owner_rank"), met.alias("week")).agg(
        nil.alias("meetings"), F.count("*").alias("deals")
    )
    counts = cut_lineage(
        held.unionByName(won).groupBy("owner_rank", "week").agg(
            F.sum("meetings").alias("meetings"), F.sum("deals").alias("deals")
        )
    )
    # One entry per week, then every owner reads its weeks off one array.
    entry = F.struct("week", "meetings", "deals")
    per_owner = counts.groupBy("owner_rank").agg(F.map_from_entries(F.collect_list(F.struct("week", entry))).alias("own"))
    weeks = counts.agg(F.sort_array(F.collect_set("week"))).scalar()
    rows = per_owner.select("owner_rank", "own", F.explode(weeks).alias("week"))
    return rows.select(
        "owner_rank", "week",
        F.coalesce(F.col("own")[F.col("week")]["meetings"], nil).alias("meetings"),
        F.coalesce(F.col("own")[F.col("week")]["deals"], nil).alias("deals"),
    )


def conversion(matrix: DataFrame) -> DataFrame:
    per = matrix.groupBy("owner_rank").agg(F.sum("meetings").alias("meetings"), F.sum("deals").alias("deals"))
    return per.withColumn("conversion", percent(F.col("deals"), F.col("meetings")))


def closed_meetings(meetings: DataFrame, results: list[str] = CLOSED_RESULTS) -> DataFrame:
    """Meetings and closed ones per week and owner."""
    return meetings.groupBy("owner_rank", week_start(F.col("start_at")).alias("week")).agg(
        F.count("*").alias("meetings"), F.count_if(F.coalesce(F.col("result").isin(results), F.lit(False))).alias("closed")
    )


def csat_lines(notes: DataFrame) -> DataFrame:
    """Lines 'SCORE - BRAND (remark)' of free notes; other lines are dropped."""
    lines = notes.select("note_id", "month", F.explode(F.split("note", "\n")).alias("line"))
    text = F.trim("line")
    score = F.regexp_extract(text, "^([0-9]+(?:[.,][0-9]+)?)\\s*[-–—]\\s*(.+)$", 1)
    brand = F.trim(F.regexp_extract(text, "^([0-9]+(?:[.,][0-9]+)?)\\s*[-–—]\\s*(.+)$", 2))
    rows = lines.select("note_id", "month", score.alias("s"), brand.alias("b")).filter("s <> ''")
    with_remark = "^([^()]+?)\\s*\\((.+)\\)\\s*$"
    remark = F.regexp_extract("b", with_remark, 2)
    return rows.select(
        "note_id", "month",
        F.replace("s", F.lit(","), F.lit(".")).cast("double").alias("score"),
        F.trim(F.when(F.col("b").rlike(with_remark), F.regexp_extract("b", with_remark, 1)).otherwise(F.col("b"))).alias("brand"),
        F.trim(remark).alias("remark"),
    )


def first_number(c: Column) -> Column:
    """First number in a text, comma or dot as decimal mark."""
    return F.replace(F.regexp_extract(c, "([0-9]+(?:[.,][0-9]+)?)", 1), F.lit(","), F.lit(".")).try_cast("double")


def csat_answers(forms: DataFrame, test_words: list[str] = ()) -> DataFrame:
    """Form answers: score of the first field that has one, date from epoch ms."""
    rows = forms
    for word in test_words:
        rows = rows.filter(~F.coalesce(F.lower("brand").contains(word), F.lit(False)))
    score = F.coalesce(first_number(F.col("score_text")), first_number(F.col("second_text")))
    return rows.select(
        F.nullif(F.trim("brand"), F.lit("")).alias("brand"), score.alias("score"),
        F.to_date(F.timestamp_millis("submitted_ms")).alias("day"),
    ).filter("score is not null")


def nps_rows(answers: DataFrame) -> DataFrame:
    """Survey rows with a score; blanks are null and domains whole numbers."""
    domain = F.regexp_replace(F.trim("domain"), "\\.0$", "")
    blank = [F.nullif(F.trim(c), F.lit("")).alias(c) for c in ("name", "phone", "comment", "angel") if c in answers.columns]
    return answers.filter("score is not null").select(
        *blank, F.when(domain.rlike("^[0-9]+$"), domain.try_cast("bigint")).alias("domain_id"), "score", "filled_on"
    )


def average_of_weeks(values: DataFrame) -> DataFrame:
    """Month average of weekly averages; rows of a week are combined first."""
    weekly = values.groupBy("month", "week").agg(F.avg("value").alias("value"))
    return weekly.groupBy("month").agg(F.avg("value").alias("average"), F.count("*").alias("weeks"))


def assistant_months(orders: DataFrame, interactions: DataFrame) -> DataFrame:
    """Orders, sales, interactions and assistant share per brand and month."""
    sold = orders.groupBy("brand", F.trunc("ts", "MM").alias("month")).agg(
        F.count("*").alias("orders"), F.sum("total").alias("sales")
    )
    talked = interactions.groupBy("brand", F.trunc("ts", "MM").alias("month")).agg(
        F.sum("total").alias("interactions"), F.sum("ai").alias("ai")
    )
    nil = F.lit(0)
    both = sold.join(talked, ["brand", "month"], "full").select(
        "brand", "month", *[F.coalesce(c, nil).alias(c) for c in ("orders", "sales", "interactions", "ai")]
    )
    share = F.round(percent(F.col("ai"), F.col("interactions")).cast("decimal(18,6)"), 1)
    return both.withColumn("ai_pct", share)


def assistant_weeks(interactions: DataFrame) -> DataFrame:
    """Assistant and human interactions per brand and ISO week."""
    human = F.col("human") if "human" in interactions.columns else F.greatest(F.lit(0), F.col("total") - F.col("ai"))
    return interactions.groupBy("brand", iso_week_key(F.col("ts")).alias("week")).agg(
        F.sum("ai").alias("ai"), F.sum(human).alias("human")
    )


def sales_by_type(orders: DataFrame) -> DataFrame:
    """Count and value per brand and week: direct, influenced and other sales."""
    kind, total = F.col("sale_type"), F.col("total")
    direct, influenced = kind == "Venda Direta", kind == "Venda Influenciada"
    other = ~F.coalesce(direct | influenced, F.lit(False))
    return orders.groupBy("brand", iso_week_key(F.col("ts")).alias("week")).agg(
        F.count_if(direct).alias("direct"), F.count_if(influenced).alias("influenced"), F.count_if(other).alias("other"),
        sum_if(direct, total).alias("direct_value"), sum_if(influenced, total).alias("influenced_value"),
        sum_if(other, total).alias("other_value"),
    )


def event_weeks(events: DataFrame) -> DataFrame:
    """Events per brand, week and event name."""
    return events.groupBy(
        "brand", iso_week_key(F.col("ts")).alias("week"), F.coalesce("event", F.lit("other")).alias("event")
    ).agg(F.count("*").alias("n"))


def event_map(weeks: DataFrame) -> DataFrame:
    """The same with one map per brand and week; event names are few."""
    entry = F.struct("event", "n")
    return weeks.groupBy("brand", "week").agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("events"))


def keep_larger(new: DataFrame, old: DataFrame, key: str, measures: list[str]) -> DataFrame:
    """Measures of two runs, the larger value of each kept."""
    theirs = old.select(key, *[F.col(m).alias(f"_o_{m}") for m in measures])
    joined = new.join(theirs, key, "full")
    return joined.select(key, *[F.coalesce(F.greatest(m, f"_o_{m}"), F.lit(0)).alias(m) for m in measures])


def last_months(monthly: DataFrame, key: str, n: int = 12) -> DataFrame:
    return top_n(monthly, [key], [F.desc("month")], n)


def people(*sources: tuple[DataFrame, str]) -> DataFrame:
    """Distinct names over several sources."""
    pool = None
    for frame, column in sources:
        part = frame.select(F.nullif(F.trim(column), F.lit("")).alias("name")).filter("name is not null")
        pool = part if pool is None else pool.unionByName(part)
    return pool.distinct()


def configured(configurations: DataFrame, flags: list[str] = ()) -> DataFrame:
    """Assistant configurations with an address, their flags as booleans."""
    rows = configurations.filter("url is not null and url <> '' and company_id <> ''")
    return rows.withColumns({f: is_true_text(F.col(f)) for f in flags})
