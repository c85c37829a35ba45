"""The logical tables, derived from the TPC-H-like test tables.

Only `queries()` and the tests use this module; production inputs come from
`sources.readers`.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.money import money

AS_OF_ORDERS = dt.date(2001, 8, 15)
AS_OF_EVENTS = dt.date(2024, 1, 31)


class Samples:
    """Logical tables over one folder of parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @staticmethod
    def _case(c: str, values: dict, other: object = None) -> Column:
        out = None
        for key, value in values.items():
            hit = F.col(c) == key
            out = F.when(hit, value) if out is None else out.when(hit, value)
        return out.otherwise(other)

    def orders(self) -> DataFrame:
        method = self._case(
            "o_orderpriority",
            {"1-URGENT": "PIX", "2-HIGH": "PIX", "3-MEDIUM": "CREDIT_CARD", "4-NOT SPECIFIED": "CREDIT_CARD"},
            "BOLETO",
        )
        provider = self._case(
            "o_orderpriority",
            {"1-URGENT": "Jadlog", "2-HIGH": "Correios", "3-MEDIUM": "Retirada em loja", "4-NOT SPECIFIED": "Total Express"},
            "Motoboy",
        )
        value = money(F.col("o_totalprice"))
        return self.raw("orders").select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("o_orderkey").alias("order_number"),
            F.expr("cast(o_custkey div 3 as string)").alias("domain_id"),
            F.col("o_custkey").cast("string").alias("company_id"),
            F.col("o_orderdate").cast("timestamp").alias("created_at"),
            value.alias("total"),
            method.alias("payment_method"),
            self._case("o_orderstatus", {"F": "PAID", "O": "PENDING"}).alias("payment_status"),
            self._case("o_orderstatus", {"F": "DELIVERED", "O": "WAITING"}, "CANCELED").alias("order_status"),
            (F.col("o_orderstatus") == "F").alias("is_paid"),
            F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate").cast("timestamp")).alias("paid_at"),
            (F.col("o_orderstatus") == "P").alias("is_canceled"),
            (F.col("o_orderstatus") != "O").alias("is_closed"),
            value.alias("transaction_value"),
            F.expr("lpad(cast(cast(floor(o_totalprice) as bigint) % 400 as string), 11, '0')").alias("customer_doc"),
            provider.alias("delivery_provider"),
            (value / F.lit(100)).cast("decimal(18,2)").alias("quoted"),
            F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("label/"), F.col("o_orderkey"))).alias("label_url"),
        )

    def domains(self) -> DataFrame:
        per = self.raw("customer").groupBy(F.expr("c_custkey div 3").alias("domain_id")).agg(
            F.sum(money(F.col("c_acctbal"))).alias("balance"),
            F.min("c_mktsegment").alias("segment"),
            F.min("c_nationkey").alias("nation"),
        )
        name = F.concat(F.when(F.col("balance") < 0, "Loja Teste ").otherwise("Loja "), F.col("domain_id"))
        return per.select(
            "domain_id",
            name.alias("domain_name"),
            F.when(F.col("balance") < 2000, "portal").otherwise("catalogo,vendas").alias("modules"),
            F.nullif(F.col("segment"), F.lit("FURNITURE")).alias("partner_id"),
            F.col("nation").cast("string").alias("angel_id"),
            F.when(F.col("balance") > 15000, (F.col("nation") % 5).cast("string")).alias("integration_id"),
        )

    def companies(self) -> DataFrame:
        tax = "concat(lpad(cast(c_custkey div 2 as string), 8, '0'), lpad(cast(c_custkey % 2 + 1 as string), 4, '0'), '00')"
        return self.raw("customer").select(
            F.col("c_custkey").cast("string").alias("company_id"),
            F.expr("c_custkey div 3").alias("domain_id"),
            F.expr(tax).alias("tax_document"),
            F.col("c_name").alias("social_name"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("company_name"),
            F.expr("cast(date_add(date'2000-01-01', c_nationkey) as timestamp)").alias("created_at"),
            F.when(F.col("c_acctbal") < 0, 2).otherwise(1).alias("status"),
        )

    def partners(self) -> DataFrame:
        seg = self.raw("customer").select(F.col("c_mktsegment").alias("partner_id")).distinct()
        return seg.withColumn("partner_name", F.lower("partner_id"))

    def angels(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").cast("string").alias("angel_id"), F.col("n_name").alias("angel_name")
        )

    def integrations(self) -> DataFrame:
        return self.raw("region").select(
            F.col("r_regionkey").cast("string").alias("integration_id"), F.col("r_name").alias("integration_name")
        )

    def settings(self) -> DataFrame:
        """Payment settings of the suppliers that own receivables."""
        return self.raw("supplier").select(
            F.col("s_suppkey").cast("string").alias("company_id"),
            F.col("s_name").alias("company_label"),
            (F.col("s_acctbal") < 0).alias("fee_enabled"),
            F.when(F.col("s_acctbal") > 8000, 1).otherwise(0).cast("decimal(18,2)").alias("anticipation_d1"),
            F.col("s_nationkey").cast("string").alias("workspace_id"),
        )

    # Billing: a billing domain is a part.
    def billing_domains(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("domain_id"), F.col("p_name").alias("domain_name"), F.col("p_brand").alias("angel_name")
        )

    def customer_bridge(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("domain_id"), F.col("p_partkey").cast("string").alias("customer_id")
        )

    def invoices(self) -> DataFrame:
        """Invoice items; a repeated (order, line) acts as a repeated ingest."""
        status = (
            "case when l_linestatus = 'F' and l_returnflag = 'A' then 'paid'"
            " when l_linestatus = 'F' and l_returnflag = 'R' then 'externally_paid'"
            " when l_linestatus = 'F' then 'pending' when l_returnflag = 'A' then 'expired'"
            " when l_returnflag = 'R' then 'canceled' else 'paid' end"
        )
        text = (
            "case l_linenumber"
            " when 1 then concat('Mensalidade R$ 1.', lpad(cast(cast(l_quantity as int) as string), 3, '0'),"
            " ',50; Integração R$ ', cast(cast(l_quantity as int) as string), ',00; Filiais R$ 12.5; Desconto concedido - R$ 3,25')"
            " when 2 then 'Assinatura: Plano Pro' when 3 then 'Filial adicional' when 4 then 'Assistente do Vendedor'"
            " when 5 then 'Integração ERP' when 6 then 'Taxa de setup' else 'Assinatura: Starter' end"
        )
        plan = (
            "case l_linenumber when 1 then 'Plano Essencial' when 2 then 'Plano Pro' when 3 then 'Filial Atacado'"
            " when 4 then 'Assistente do Vendedor' when 5 then 'Plano_Avançado' when 6 then 'Plano Básico' else 'Starter' end"
        )
        return self.raw("lineitem").select(
            F.expr("concat(cast(l_orderkey as string), '-', cast(l_partkey as string))").alias("invoice_id"),
            F.col("l_linenumber").cast("string").alias("item_id"),
            F.col("l_partkey").cast("string").alias("customer_id"),
            F.expr(status).alias("status"),
            F.col("l_shipdate").cast("timestamp").alias("due_at"),
            F.date_sub("l_shipdate", 10).cast("timestamp").alias("created_at"),
            F.expr("cast(cast(l_extendedprice as decimal(18,2)) * 100 as bigint)").alias("total_cents"),
            F.expr("case when l_returnflag <> 'N' then cast(cast(l_extendedprice as decimal(18,2)) * 100 as bigint) end").alias("item_price_cents"),
            F.expr("cast(l_quantity as int) % 4").alias("item_quantity"),
            F.expr(text).alias("item_text"),
            F.expr(plan).alias("plan_name"),
        )

    def invoice_lines(self) -> DataFrame:
        """The same with invoice and item numbers that repeat across customers, and some lines without an item."""
        order = F.split_part("invoice_id", F.lit("-"), F.lit(1))
        item = F.when((F.col("item_id") == "3") & (F.col("item_quantity") == 0), None).otherwise(F.col("item_id"))
        return self.invoices().withColumns({"invoice_id": order, "item_id": item})

    def order_instalments(self) -> DataFrame:
        """Orders with the instalment that their own row carries; some have net 0, some no due day."""
        at = F.col("o_orderdate")
        net = "case when o_orderstatus = 'P' then cast(0 as decimal(18,2)) else cast(cast(o_totalprice as decimal(18,2)) * 0.97 as decimal(18,2)) end"
        own = self.raw("orders").select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("own-"), F.col("o_orderkey"))).otherwise("").alias("rec_id"),
            F.lit(1).alias("installment"),
            F.when(F.col("o_orderkey") % 5 != 0, F.date_add(at, 30).cast("timestamp")).alias("due_at"),
            F.when(F.col("o_orderstatus") == "F", F.date_add(at, 35).cast("timestamp")).alias("rec_paid_at"),
            F.when(F.col("o_orderstatus") == "F", "paid").otherwise("created").alias("rec_status"),
            F.expr(net).alias("net"),
            money(F.col("o_totalprice")).alias("gross"),
            F.expr("cast(cast(o_totalprice as decimal(18,2)) * 0.03 as decimal(18,2))").alias("fee"),
            F.lit(0).cast("decimal(18,2)").alias("anticipation"),
            F.when(F.col("o_custkey") % 10 == 0, "OTHER").otherwise("PAY").alias("provider"),
        )
        return self.orders().join(own, "order_id")

    def receivables(self) -> DataFrame:
        amount = "cast(l_extendedprice as decimal(18,2))"
        net = f"cast({amount} * (1 - cast(l_discount as decimal(18,2))) as decimal(18,2))"
        return self.raw("lineitem").select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_suppkey").cast("string").alias("company_id"),
            F.col("l_suppkey").cast("string").alias("domain_id"),
            F.expr("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(cast(l_extendedprice as decimal(18,2)) * 100 as bigint))").alias("rec_id"),
            F.col("l_linenumber").cast("int").alias("installment"),
            F.col("l_shipdate").cast("timestamp").alias("due_at"),
            F.expr("case when l_linestatus = 'F' then cast(date_add(l_shipdate, cast(l_quantity as int)) as timestamp) end").alias("rec_paid_at"),
            F.expr("case when l_returnflag <> 'N' then cast(date_sub(l_shipdate, l_linenumber) as timestamp) end").alias("paid_at"),
            F.expr("case when l_linestatus = 'F' then 'paid' else 'created' end").alias("rec_status"),
            F.expr(f"case when l_tax = 0 and l_discount = 0 then cast(0 as decimal(18,2)) else {net} end").alias("net"),
            F.expr(amount).alias("gross"),
            F.expr(f"cast({amount} * cast(l_tax as decimal(18,2)) as decimal(18,2))").alias("fee"),
            F.expr("case when l_returnflag = 'R' and l_discount >= 0.1 then cast(1 as decimal(18,2)) else cast(0 as decimal(18,2)) end").alias("anticipation"),
            F.expr("case when l_suppkey % 10 = 0 then 'OTHER' else 'PAY' end").alias("provider"),
        )

    def purchases(self) -> DataFrame:
        """Purchase documents with a nested instalment array, one per line."""
        status = (
            "case when l_linestatus = 'F' then 'paid' when l_returnflag = 'A' then 'created'"
            " when l_returnflag = 'N' then 'denied' else 'voided' end"
        )
        cents = "cast(cast(l_extendedprice as decimal(18,2)) * 100 as bigint)"
        amounts = f"array_repeat({cents} div l_linenumber, l_linenumber)"
        dues = "sequence(date_add(l_shipdate, 30), date_add(l_shipdate, 30 * l_linenumber), interval 30 days)"
        parcels = f"cast(arrays_zip({amounts}, {dues}) as array<struct<amount: bigint, due: date>>)"
        return self.raw("lineitem").select(
            F.expr("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(cast(l_extendedprice as decimal(18,2)) * 100 as bigint))").alias("transaction_id"),
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_suppkey").cast("string").alias("company_id"),
            F.expr("concat('Brand ', l_suppkey)").alias("brand"),
            F.expr("cast(l_suppkey % 25 as string)").alias("workspace_id"),
            F.expr("l_discount >= 0.05").alias("anticipation"),
            F.expr(status).alias("status"),
            F.expr(f"case when l_tax = 0 then 0 else {cents} end").alias("amount"),
            F.col("l_shipdate").cast("timestamp").alias("created"),
            F.expr("cast(l_shipdate as timestamp) + make_dt_interval(0, cast(l_quantity as int), l_linenumber, 0)").alias("updated"),
            F.expr(parcels).alias("installments"),
            F.expr("array(concat('company_', l_suppkey), concat('order_', l_orderkey), concat('customer_', l_partkey))").alias("tags"),
        )

    def freight_close(self) -> DataFrame:
        """Posting sheet; returned lines carry a foreign domain in their code."""
        owner = self.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.expr("o_custkey div 3").alias("own"))
        lines = self.raw("lineitem").join(owner, "l_orderkey")
        text = "concat('R$ ', cast(cast(l_extendedprice / 1000 as int) as string), ',', lpad(cast(cast(l_quantity as int) as string), 2, '0'))"
        return lines.select(
            F.expr("concat(case when l_returnflag = 'R' then l_suppkey else own end, '_', l_orderkey)").alias("volume_code"),
            F.expr(text).alias("posting_text"),
            F.col("l_returnflag").alias("operator"),
            F.expr("cast(l_shipdate as date)").alias("posted_on"),
            F.expr("case when l_linestatus = 'F' then 'ENTREGUE' else 'AGUARDANDO RETIRADA' end").alias("sheet_status"),
        )

    # Order history from three sources, at a grain where keys repeat.
    def history(self, source: str) -> DataFrame:
        base = self.raw("orders")
        if source == "quotes":
            base = base.filter("o_orderstatus <> 'P'")
        if source == "orders":
            base = base.filter("o_orderstatus <> 'F'")
        return base.select(
            F.concat(F.lit(source[:1] + "-"), F.col("o_orderkey")).alias("record_id"),
            F.expr("cast(o_custkey div 30 as string)").alias("company_id"),
            F.expr("date_format(trunc(o_orderdate, 'QUARTER'), 'yyyy-MM-dd')").alias("day"),
            F.expr("cast(floor(o_totalprice / 50000) * 50000 as decimal(18,2))").alias("value"),
            F.col("o_orderstatus").alias("code"),
            F.when((F.col("o_orderkey") % 2 == 0) & F.lit(source == "orders"), F.col("o_orderkey").cast("string")).alias("order_number"),
            F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("Cliente "), F.col("o_custkey"))).alias("customer_name"),
        )

    def brand_history(self, source: str) -> DataFrame:
        """The three sources with status and owner fields: some owners are known by domain only, some not at all."""
        rows = self.history(source).withColumn("n", F.split_part("record_id", F.lit("-"), F.lit(2)).cast("long"))
        company = F.when((F.col("n") % 4 == 0) & F.lit(source != "orders"), F.lit("none")).otherwise(F.col("company_id"))
        status = {"F": "PAID", "O": "PENDING"} if source == "orders" else {"F": "Pago", "O": "Análise"}
        return rows.select(
            "record_id", company.alias("company_id"), (F.col("company_id").cast("long") * 10).cast("string").alias("domain_id"), "day", "value",
            self._case("code", status).alias("payment_status"), F.lit(None).cast("string").alias("order_status"), (F.col("code") == "P").alias("is_canceled"),
            (F.col("n") % 4).cast("int").alias("code"), "order_number", "customer_name",
        )

    # Events: the type picks the role, the user is the company.
    def _events(self, kind: str) -> DataFrame:
        return self.raw("events").filter(F.col("event_type") == kind)

    def meetings(self) -> DataFrame:
        return self._events("view").select(
            F.col("event_id").alias("meeting_id"),
            (F.col("user_id") % 4).alias("owner_rank"),
            F.col("user_id").alias("company_id"),
            F.col("ts").alias("start_at"),
            F.expr("case when value > 60 then 'Upgrade' when value > 40 then 'Fechou negócio' else 'Sem retorno' end").alias("result"),
        )

    def deals(self) -> DataFrame:
        return self._events("purchase").select(
            F.col("event_id").alias("deal_id"), F.col("user_id").alias("company_id"), F.col("ts").alias("close_at")
        )

    def links(self) -> DataFrame:
        return self._events("signup").select(F.col("user_id").cast("string").alias("company_id"), F.col("ts").alias("created_at"))

    def clicks(self) -> DataFrame:
        return self._events("click").select(
            F.col("user_id").cast("string").alias("company_id"),
            F.col("ts").alias("created_at"),
            F.from_json("props", "k int")["k"].alias("shared_links"),
        )

    def nps_answers(self) -> DataFrame:
        return self.raw("events").select(
            F.col("user_id").alias("domain_id"), F.expr("cast(floor(value) as int) % 11").alias("score")
        )

    def ai_orders(self) -> DataFrame:
        kind = "case from_json(props, 'k int').k % 3 when 0 then 'Venda Direta' when 1 then 'Venda Influenciada' else 'Outra' end"
        return self._events("purchase").select(
            F.col("user_id").alias("brand"), F.col("ts"), money(F.col("value")).alias("total"), F.expr(kind).alias("sale_type")
        )

    def ai_interactions(self) -> DataFrame:
        return self.raw("events").filter("event_type in ('click', 'view')").select(
            F.col("user_id").alias("brand"),
            F.col("ts"),
            F.lit(100).cast("long").alias("total"),
            F.from_json("props", "k int")["k"].cast("long").alias("ai"),
        )

    def ai_events(self) -> DataFrame:
        return self.raw("events").select(F.col("user_id").alias("brand"), F.col("ts"), F.col("event_type").alias("event"))

    # Names for the matching jobs.
    def named_companies(self) -> DataFrame:
        """Registered names: '<adjective> <noun> <type>' plus supplier names."""
        parts = self.raw("part").select(
            F.format_string("p%09d", F.col("p_partkey")).alias("company_id"),
            F.expr("concat(p_name, ' ', lower(p_type))").alias("name"),
            F.expr("concat(lpad(cast(p_partkey div 2 as string), 8, '0'), lpad(cast(p_partkey % 2 + 1 as string), 4, '0'), '00')").alias("tax_document"),
            F.col("p_partkey").alias("domain_id"),
        )
        suppliers = self.raw("supplier").select(
            F.format_string("s%09d", F.col("s_suppkey")).alias("company_id"),
            F.col("s_name").alias("name"),
            F.lit("").alias("tax_document"),
            F.lit(None).cast("long").alias("domain_id"),
        )
        return parts.unionByName(suppliers)

    def plan_lines(self) -> DataFrame:
        """Billing sheet lines; larger parts have a tax id no company shares."""
        return self.raw("part").select(
            F.expr(
                "case when p_size > 40 then lpad(cast(90000000 + p_partkey as string), 14, '9')"
                " when p_size > 20 then concat(lpad(cast(p_partkey div 2 as string), 8, '0'), '000900')"
                " else concat(lpad(cast(p_partkey div 2 as string), 8, '0'), lpad(cast(p_partkey % 2 + 1 as string), 4, '0'), '00') end"
            ).alias("tax_id"),
            F.expr("case when p_size > 45 then p_name else concat(p_name, ' ', lower(p_type)) end").alias("brand"),
            F.expr("case when p_size % 3 = 0 then 'Integração' else p_type end").alias("plan"),
            F.col("p_partkey").alias("line_no"),
            money(F.col("p_retailprice")).alias("total"),
        )

    def tickets(self) -> DataFrame:
        """Tickets by customers and by part names in another word order."""
        parts = self.raw("part").select(
            F.format_string("t%09d", F.col("p_partkey")).alias("ticket_id"),
            F.expr(
                "case when p_size <= 10 then concat(p_name, ' ', p_type) when p_size <= 20 then split_part(p_name, ' ', 2)"
                " else concat(split_part(p_name, ' ', 2), ' ', substring(p_type, 1, 4), ' ', p_brand) end"
            ).alias("subject"),
        )
        buyers = self.raw("customer").select(
            F.format_string("u%09d", F.col("c_custkey")).alias("ticket_id"), F.col("c_name").alias("subject")
        )
        return parts.unionByName(buyers)

    def domain_month(self) -> DataFrame:
        per = self.orders().groupBy("domain_id", F.trunc("created_at", "MM").alias("month")).agg(
            F.count("*").alias("orders"),
            F.sum("total").alias("gmv"),
            F.count_if(F.col("payment_method") == "PIX").alias("pix"),
            F.count_if(F.col("payment_method") == "CREDIT_CARD").alias("card"),
            F.count_if(F.col("is_canceled")).alias("canceled"),
        )

        def flag(c: Column) -> Column:
            return F.when(c, "Sim").otherwise("Não")

        o, p, k, x = F.col("orders"), F.col("pix"), F.col("card"), F.col("canceled")
        return per.select(
            "domain_id", "month", "orders", "gmv",
            flag(o >= 1).alias("has_orders"), flag(o >= 2).alias("over25"), flag(o >= 3).alias("over80"),
            flag(p > 0).alias("integration_on"), flag(k > 0).alias("payment_on"),
            flag((p > 0) & (k > 0)).alias("freight_on"), flag(p > 1).alias("assistant_on"),
            flag(x > 0).alias("lost25"), flag(x > 1).alias("lost80"), flag((p > 0) & (x > 0)).alias("lost_integration"),
            flag((k > 0) & (x > 0)).alias("lost_payment"), flag(x == o).alias("lost_freight"),
        )

    def csat_notes(self) -> DataFrame:
        """Cell notes with one answer per line, some without a score."""
        text = (
            "concat(cast(p_size div 5 as string), ',5 - ', p_name, ' (', lower(p_type), ')\n',"
            " cast(p_size div 5 as string), ' - ', p_brand, '\nsem nota ', p_name)"
        )
        return self.raw("part").select(
            F.col("p_partkey").alias("note_id"),
            F.expr("date_format(add_months(date'2025-01-01', p_size % 12), 'yyyy-MM')").alias("month"),
            F.expr(text).alias("note"),
        )


def blank(spark: SparkSession, path: str, start: float, end: float) -> None:
    """Set a part of a small file's bytes, given as shares of its length, to zero: what a damaged disk leaves."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.open(path)
    raw = bytearray(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    stream.close()
    first, last = int(len(raw) * start), int(len(raw) * end)
    raw[first:last] = bytes(last - first)
    out = fs.create(path, True)
    out.write(raw)
    out.close()
