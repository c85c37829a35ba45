"""Company registers, groups of branches and name-based matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import digits, light_normalise, normalise_name, phone_key, subject_to_brand, tax_branch, tax_root
from ..operators.components import linked_groups
from ..operators.ranking import top_n
from ..session import cut_lineage
from ..operators.skew import hot_join
from ..operators.matching import containing, prefixing, tiers, word_scored
from .cohorts import with_row_number


def active_domains(domains: DataFrame, excluded_partners: Sequence[str] = (), keep_null_partner: bool = True) -> DataFrame:
    """Selling domains that are neither trials nor tests."""
    allowed = ~F.col("partner_id").isin(list(excluded_partners))
    if keep_null_partner:
        allowed = F.col("partner_id").isNull() | allowed
    return domains.filter(F.col("modules").contains("vendas") & allowed & ~F.lower("domain_name").contains("teste"))


def company_register(
    domains: DataFrame, companies: DataFrame, angels: DataFrame, partners: DataFrame, integrations: DataFrame
) -> DataFrame:
    """Companies of active domains with names of their staff, channel and integration."""
    rows = (
        with_row_number(companies).join(domains, "domain_id")
        .join(angels, "angel_id", "left").join(partners, "partner_id", "left").join(integrations, "integration_id", "left")
    )
    branch = F.col("row_num") > 1
    company = F.nullif(F.col("company_name"), F.lit(""))
    numbered_name = F.concat("domain_name", F.lit(" - Filial "), F.col("row_num").cast("string"))
    name = F.when(branch, F.coalesce(company, numbered_name)).otherwise(F.coalesce(F.nullif("domain_name", F.lit("")), company))
    return rows.select(
        "company_id", "domain_id", "row_num", "tax_document", name.alias("name"),
        F.coalesce(company, "domain_name").alias("trade_name"),
        F.when(branch, F.col("domain_name")).otherwise("").alias("hq_name"),
        (~branch).alias("is_hq"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("angel_name", "partner_name", "integration_name")],
        "status",
    )


def register_counts(register: DataFrame, ordering: DataFrame) -> DataFrame:
    """Headquarters, branches and all companies, of domains with orders."""
    per_domain = register.groupBy("domain_id").agg(
        F.count_if(F.col("is_hq")).alias("headquarters"), F.count_if(~F.col("is_hq")).alias("branches"), F.count("*").alias("companies")
    )
    live = per_domain.join(ordering.select("domain_id").distinct(), "domain_id", "left_semi")
    return live.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("headquarters", "branches", "companies")])


def drop_idle_copies(companies: DataFrame) -> DataFrame:
    """Drop companies without orders whose tax id has orders elsewhere."""
    keyed = companies.withColumn("_doc", F.coalesce(digits(F.col("tax_document")), F.lit("")))
    busy = keyed.filter("orders > 0 and _doc <> ''").select("_doc", F.lit(True).alias("_busy")).distinct()
    return hot_join(keyed, busy, ["_doc"], unique=True).filter("orders > 0 or _busy is null").drop("_doc", "_busy")


def company_groups(companies: DataFrame, max_root: int = 20, max_domain: int = 15) -> DataFrame:
    """Groups of companies that share a tax-id root or a domain, with their HQ.

    Needs company_id, tax_document, domain_id, name and orders. The HQ is the
    branch 0001 when one root alone has it, then the company with most orders,
    the shorter name and the smaller id.
    """
    keyed = companies.withColumn("root", tax_root(F.col("tax_document")))
    groups = linked_groups(keyed, "company_id", {"root": max_root, "domain_id": max_domain})
    first = tax_branch(F.col("tax_document")) == "0001"
    joined = companies.withColumns({"_0001": first, "_root": F.substring(digits(F.col("tax_document")), 1, 8)}).join(
        groups, "company_id"
    )
    per = joined.groupBy("group_id").agg(
        F.count("*").alias("size"), F.countDistinct(F.when(F.col("_0001"), F.col("_root"))).alias("roots")
    )
    # The rank does not depend on the group, so both kinds of HQ are aggregates.
    rest = [(-F.coalesce("orders", F.lit(0))).alias("o"), F.length("name").alias("l"), F.col("company_id").alias("id")]
    heads = joined.groupBy("group_id").agg(
        F.min(F.struct((~F.col("_0001")).alias("b"), *rest))["id"].alias("by_branch"), F.min(F.struct(*rest))["id"].alias("by_orders")
    )
    hq = per.join(heads, "group_id").select(
        "group_id", "size", F.when(F.col("roots") == 1, F.col("by_branch")).otherwise(F.col("by_orders")).alias("hq_id")
    )
    return hot_join(groups, hq, ["group_id"], "inner", "size", unique=True).select(
        "company_id", "group_id", "size", "hq_id", (F.col("company_id") == F.col("hq_id")).alias("is_hq")
    )


def canonical_by_orders(companies: DataFrame) -> DataFrame:
    """Company that stands for a domain: most orders, then smallest id."""
    best = F.min(F.struct((-F.coalesce("orders", F.lit(0))).alias("o"), F.col("company_id").alias("id")))
    return companies.groupBy("domain_id").agg(best["id"].alias("canonical_id"))


def canonical_activity(links: DataFrame, clicks: DataFrame, groups: DataFrame) -> DataFrame:
    """Shared links and clicks per HQ and month; unknown companies are dropped.

    Both sources are added up per company before the look-up.
    """
    month = F.trunc("created_at", "MM").alias("month")
    shared = links.groupBy("company_id", month).agg(F.count("*").alias("links"), F.lit(0).cast("long").alias("clicks"))
    clicked = clicks.groupBy("company_id", month).agg(F.lit(0).cast("long").alias("links"), F.sum("shared_links").alias("clicks"))
    joined = shared.unionByName(clicked).join(groups.select("company_id", "hq_id"), "company_id")
    return joined.groupBy("hq_id", "month").agg(
        F.sum("links").alias("links"), F.sum("clicks").alias("clicks")
    )


def _named(rows: DataFrame, name: Column, pick: Column) -> DataFrame:
    """(name, pick): the smallest pick per non-empty name."""
    return rows.select(name.alias("name"), pick.alias("pick")).filter("name <> ''").groupBy("name").agg(F.min("pick").alias("pick"))


def plan_per_tax_id(lines: DataFrame, extra_words: Sequence[str] = ("integração", "integracao", "pacote")) -> DataFrame:
    """Main plan line of each tax id: the first that is no extra, else the first."""
    extra = F.lower("plan").rlike("|".join(extra_words))
    fields = [c for c in lines.columns if c != "tax_id"]
    main = F.min_by(F.struct(*fields), F.struct(extra.alias("e"), "line_no"))
    return lines.filter("tax_id <> ''").groupBy("tax_id").agg(main.alias("_m"), F.count("*").alias("lines")).select("tax_id", "lines", "_m.*")


def match_plans(companies: DataFrame, plans: DataFrame, min_name: int = 5) -> DataFrame:
    """Plan of each company by tax id, tax root, equal name or contained name.

    Within a tier the plan with the largest total wins, then the smaller tax id.
    """
    pick = F.struct((-F.col("total")).alias("t"), "tax_id", "plan")
    by_tax = plans.select(F.col("tax_id").alias("_tax"), pick.alias("pick"))
    # Any company of eight or more digits has a root here, not only full ids.
    root = F.when(F.length("_tax") >= 8, F.substring("_tax", 1, 8))
    by_root = by_tax.withColumn("_root", root).filter("_root is not null").groupBy("_root").agg(F.min("pick").alias("pick"))
    offered = _named(plans.filter(F.length(light_normalise(F.col("brand"))) >= 3), light_normalise(F.col("brand")), pick)
    keyed = companies.withColumns(
        {"_tax": F.regexp_replace("tax_document", "[./-]", ""), "_name": light_normalise(F.col("name"))}
    ).withColumn("_root", root)
    asked = keyed.select(F.col("_name").alias("name")).filter("name <> ''").distinct()
    near = containing(asked.join(offered, "name", "left_anti"), offered, min_name, longest=False)
    steps = [
        ("tax id", "_tax", by_tax), ("tax root", "_root", by_root),
        ("name", "_name", offered.withColumnRenamed("name", "_name")),
        ("part of name", "_name", near.withColumnRenamed("name", "_name")),
    ]
    out = tiers(keyed, steps).filter("tier is not null")
    return out.select("company_id", "tier", "pick.tax_id", "pick.plan", (-F.col("pick.t")).alias("total"))


def match_invoices(companies: DataFrame, by_domain: DataFrame, by_brand: DataFrame, min_prefix: int = 4) -> DataFrame:
    """Invoice key of each company: domain, normalised brand or brand prefix."""
    domain = by_domain.select("domain_id", F.col("domain_id").cast("string").alias("pick")).distinct()
    brand = _named(by_brand, normalise_name(F.col("brand")), normalise_name(F.col("brand")))
    keyed = companies.withColumn("_name", normalise_name(F.col("name")))
    asked = keyed.select(F.col("_name").alias("name")).filter("name <> ''").distinct()
    near = prefixing(asked.join(brand, "name", "left_anti"), brand, min_prefix)
    steps = [
        ("domain", "domain_id", domain), ("brand", "_name", brand.withColumnRenamed("name", "_name")),
        ("prefix", "_name", near.withColumnRenamed("name", "_name")),
    ]
    return tiers(keyed, steps).filter("tier is not null").select("company_id", "tier", F.col("pick").alias("invoice_key"))


def match_panels(companies: DataFrame, panels: DataFrame) -> DataFrame:
    """Panel of each company: equal lower name, configured name or contained name."""
    exact = _named(panels, F.lower("panel"), F.col("panel"))
    offered = _named(panels, normalise_name(F.col("panel")), F.col("panel"))
    config = F.trim(F.regexp_replace(F.lower("config_name"), "^(churn|chrun)\\s*-\\s*", ""))
    keyed = companies.withColumns({"_low": F.lower("name"), "_conf": config, "_name": normalise_name(F.col("name"))})
    asked = keyed.select(F.col("_name").alias("name")).filter("name <> ''").distinct()
    same = asked.join(offered, "name")
    near = same.unionByName(containing(asked.join(offered, "name", "left_anti"), offered))
    steps = [
        ("name", "_low", exact.withColumnRenamed("name", "_low")), ("config", "_conf", exact.withColumnRenamed("name", "_conf")),
        ("part of name", "_name", near.withColumnRenamed("name", "_name")),
    ]
    # Only configured companies may match by a part of the name.
    keyed = keyed.withColumn("_name", F.when(F.col("config_name").isNotNull(), F.col("_name")))
    return tiers(keyed, steps).filter("tier is not null").select("company_id", "tier", F.col("pick").alias("panel"))


def match_tickets(tickets: DataFrame, companies: DataFrame, ignored: Sequence[str] = ("eventos",), product_words: Sequence[str] = (), hot: int = 50) -> DataFrame:
    """Company of each ticket by equal name, contained name or shared words."""
    name = normalise_name(subject_to_brand(F.col("subject"), list(product_words)))
    keyed = tickets.withColumn("_name", name)
    asked = keyed.select(F.col("_name").alias("name")).filter((F.col("name") != "") & ~F.col("name").isin(list(ignored))).distinct()
    offered = _named(companies, normalise_name(F.col("name")), F.col("company_id"))
    # Both name lists are read by every tier; write them once.
    asked, offered = cut_lineage(asked), cut_lineage(offered)
    same = asked.join(offered, "name")
    left = asked.join(offered, "name", "left_anti")
    near = cut_lineage(containing(left, offered))
    scored = cut_lineage(word_scored(left.join(near, "name", "left_anti"), offered, hot=hot))
    steps = [
        ("name", "_name", same.withColumnRenamed("name", "_name")),
        ("part of name", "_name", near.withColumnRenamed("name", "_name")),
        ("words", "_name", scored.select(F.col("name").alias("_name"), "pick")),
    ]
    return tiers(keyed, steps).filter("tier is not null").select("ticket_id", "tier", F.col("pick").alias("company_id"))


def survey_brands(surveys: DataFrame, companies: DataFrame, min_prefix: int = 4) -> DataFrame:
    """Company of each survey brand where one name starts with the other."""
    offered = _named(companies, light_normalise(F.col("name")), F.col("company_id"))
    keyed = surveys.withColumn("_name", light_normalise(F.col("brand")))
    asked = keyed.select(F.col("_name").alias("name")).filter(F.length("name") >= min_prefix).distinct()
    found = asked.join(offered, "name").unionByName(prefixing(asked.join(offered, "name", "left_anti"), offered, min_prefix))
    return hot_join(keyed, found.withColumnRenamed("name", "_name"), ["_name"], "inner").select("brand", F.col("pick").alias("company_id"))


def survey_users(answers: DataFrame, users: DataFrame) -> DataFrame:
    """User of each survey answer by the last ten digits of the phone."""
    known = users.select(phone_key(F.col("phone")).alias("_phone"), "user_id", "domain_id").filter("_phone <> ''")
    first = known.groupBy("_phone").agg(F.min(F.struct("user_id", "domain_id")).alias("_u"))
    keyed = answers.withColumn("_phone", phone_key(F.col("phone")))
    return hot_join(keyed, first, ["_phone"], unique=True).select(*answers.columns, "_u.user_id", "_u.domain_id")


def labelled(rows: DataFrame, code: str, labels: DataFrame, label: str = "label") -> DataFrame:
    """Codes replaced by their label; codes without one pass through."""
    names = labels.select(F.col("code").alias(code), F.col("label").alias("_label"))
    return rows.join(names, code, "left").withColumn(label, F.coalesce("_label", code)).drop("_label")


def activity_rollup(activity: DataFrame) -> DataFrame:
    """Links and clicks per HQ and month, per HQ and per month."""
    hq, month = F.col("hq_id"), F.col("month")
    return activity.groupingSets([[hq, month], [hq], [month]], hq, month).agg(
        F.sum("links").alias("links"), F.sum("clicks").alias("clicks")
    )


def latest_tickets(matched: DataFrame) -> DataFrame:
    """Latest changed ticket of each company."""
    return top_n(matched, ["company_id"], [F.desc("modified"), F.desc("ticket_id")])


def group_heads(members: DataFrame, key: str = "domain_id") -> DataFrame:
    """The marked headquarters of each group, else its company with the lowest row number."""
    order = F.struct((~F.col("is_hq")).alias("m"), "row_num", "company_id")
    return members.groupBy(key).agg(F.min(order)["company_id"].alias("hq_id"), F.bool_or("is_hq").alias("marked"))
