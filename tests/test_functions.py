"""Column helpers on the edge rows of the input texts."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import classify, dates, money, text


def each(spark, values, column, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", column(F.col("v")).alias("o")).orderBy("i").collect()]


def test_money_texts(spark):
    texts = ["1.234,56", "29,77", "29.77", "980.00 BRL", "R$ 10", "", None, "a combinar", "R$ -5,50"]
    want = ["1234.56", "29.77", "29.77", "980.00", "10.00", None, None, None, "-5.50"]
    assert each(spark, texts, money.money_br) == [Decimal(w) if w else None for w in want]


def test_money_format(spark):
    assert each(spark, [Decimal("1234.5"), None], money.money_text, "decimal(18,2)") == ["R$ 1.234,50", "-"]


def test_cents_null_is_zero(spark):
    assert each(spark, [12345, None, 0], money.cents, "bigint") == [Decimal("123.45"), Decimal("0.00"), Decimal("0.00")]


def test_names(spark):
    names = ["Confecções São José LTDA", "Amesa Moda", "Casa S.A.", "MÊ-Sá & me", "Élan  Collection"]
    assert each(spark, names, text.normalise_name) == ["sao jose", "amesa", "casa", "", "elan"]


def test_light_and_compare_keys(spark):
    assert each(spark, [" Ação ", None], text.light_normalise) == ["acao", None]
    assert each(spark, ["São Paulo - 1", None], text.compare_key) == ["SAOPAULO1", ""]
    assert each(spark, ["são paulo"], text.state_key) == ["SA"]


def test_phones(spark):
    phones = ["+55 (11) 99999-1234", "011 3333-4444", "5511988887777", "1234", None]
    assert each(spark, phones, text.phone_key) == ["1999991234", "1133334444", "1988887777", "1234", None]


def test_payment_keys(spark):
    keys = ["11999991234", "1133334444", "1234567890123", "12345678901234", "a@b.c", " ", None]
    want = ["+5511999991234", "+551133334444", "01234567890123", "12345678901234", "a@b.c", None, None]
    assert each(spark, keys, text.payment_key) == want


def test_tax_ids(spark):
    ids = ["12.345.678/0001-90", "123.456.789-01", "1234567890123"]
    assert each(spark, ids, text.tax_root) == ["12345678", None, None]
    assert each(spark, ids, text.tax_branch) == ["0001", "9999", "9012"]


def test_domain_ids(spark):
    assert each(spark, ["123", "123.0", " 7 ", "x", None, "1.5"], text.clean_domain_id) == [123, 123, 7, None, None, None]


def test_booleans(spark):
    assert each(spark, ["true", "True", "1", "SIM", "não", "", None], text.is_true_text) == [True, True, True, True, False, False, False]


def test_first_truthy(spark):
    df = spark.createDataFrame([(None, "", "c"), ("a", "b", "c"), (None, None, "")], "a string, b string, c string")
    got = [r[0] for r in df.select(text.first_truthy(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == ["c", "a", ""]


def test_subjects(spark):
    subjects = ["Assistente - Loja Um", "Loja Dois - assistente novo", "Loja Três - Agente 2 | fila", "Loja (matriz) Quatro", "Assistente Loja"]
    got = each(spark, subjects, lambda c: text.subject_to_brand(c, ["Assistente"]))
    assert got == ["Loja Um", "Loja Dois", "Loja Três", "Loja Quatro", "Loja"]


def test_client_name(spark):
    assert each(spark, ["Loja A = 123", "Loja B"], text.client_before_equals) == ["Loja A", "Loja B"]


def test_tags(spark):
    df = spark.createDataFrame([(["x", "order_9", "order_8"],), ([],), (None,)], "t array<string>")
    assert [r[0] for r in df.select(text.tag_value(F.col("t"), "order_")).collect()] == ["9", None, None]


def test_days(spark):
    texts = ["2024-02-29", "29/02/2024", "1/3/24", "45351", "1709164800000", "31/02/2024", "", None, "2024-02-29T10:00:00Z"]
    leap = dt.date(2024, 2, 29)
    assert each(spark, texts, dates.parse_day) == [leap, leap, dt.date(2024, 3, 1), leap, leap, None, None, None, leap]


def test_local_day_follows_the_zone(spark):
    stamps = [dt.datetime(2018, 12, 1, 1), dt.datetime(2024, 1, 1, 2, 59), dt.datetime(2024, 1, 1, 3)]
    df = spark.createDataFrame([(s.isoformat(sep=" "),) for s in stamps], "t string")
    got = [r[0] for r in df.select(F.date_format(dates.to_local(F.to_timestamp("t")), "yyyy-MM-dd HH")).collect()]
    assert got == ["2018-11-30 23", "2023-12-31 23", "2024-01-01 00"]


def test_iso_week_takes_the_iso_year(spark):
    days = [dt.date(2024, 12, 30), dt.date(2024, 12, 29), dt.date(2021, 1, 3)]
    assert each(spark, days, dates.iso_week_key, "date") == ["2025-W01", "2024-W52", "2020-W53"]


@pytest.mark.parametrize("day,want", [((2024, 3, 1), (2024, 3, 1)), ((2024, 3, 2), (2024, 3, 4)), ((2024, 3, 3), (2024, 3, 4))])
def test_business_day(spark, day, want):
    assert each(spark, [dt.date(*day)], dates.next_business_day, "date") == [dt.date(*want)]


def test_half_months(spark):
    days = [dt.date(2024, 2, 15), dt.date(2024, 2, 16)]
    assert each(spark, days, dates.half_month_start, "date") == [dt.date(2024, 2, 1), dt.date(2024, 2, 16)]
    assert each(spark, days, dates.half_month_end, "date") == [dt.date(2024, 2, 15), dt.date(2024, 2, 29)]


def test_sheet_months(spark):
    assert each(spark, ["Planos 03-2025", "Planos 032025", "Planos 0325", "x"], dates.sheet_month) == [dt.date(2025, 3, 1)] * 3 + [None]


def test_month_names(spark):
    df = spark.createDataFrame([("Março", 2025), ("dezembro", 2024), ("x", 2024)], "m string, y int")
    got = [r[0] for r in df.select(dates.month_from_name(F.col("m"), F.col("y"))).collect()]
    assert got == [dt.date(2025, 3, 1), dt.date(2024, 12, 1), None]
    assert each(spark, [dt.date(2026, 1, 5)], dates.month_label, "date") == ["jan/26"]


def test_item_classes(spark):
    value = F.lit(100).cast("decimal(18,2)")
    texts = {
        "Mensalidade R$ 1.200,00; Integração R$ 80,5; Assistente do Vendedor R$ 20; Filiais R$ 10; Desconto concedido - R$ 5,00": (1200, 80.5, 20, 10, 0, 5),
        "Mensalidade; Filiais": (100, 0, 0, 0, 0, 0),
        "Filial extra": (0, 0, 0, 100, 0, 0),
        "Assistente": (0, 0, 100, 0, 0, 0),
        "Integração ERP": (0, 100, 0, 0, 0, 0),
        "Multa de atraso": (0, 0, 0, 0, 100, 0),
        "Referente ao mês passado": (0, 0, 0, 0, 100, 0),
        "homes plano": (0, 0, 0, 0, 100, 0),  # any text that holds "mes " or "mês "
        "Plano de 12 meses": (100, 0, 0, 0, 0, 0),
        "Pago no mês": (100, 0, 0, 0, 0, 0),
        "Plano Pro": (100, 0, 0, 0, 0, 0),
        "Assinatura: Starter": None,
    }
    got = each(spark, list(texts), lambda c: classify.item_categories(c, value))
    assert [tuple(map(float, r)) if r else None for r in got] == [tuple(map(float, w)) if w else None for w in texts.values()]


def test_plan_levels(spark):
    plans = ["Plano PRO", "plano_pro", "Plano Avançado", "Filial Atacado", "Starter", None]
    assert each(spark, plans, classify.plan_level) == [2, 2, 2, 0, 1, 1]


def test_letters(spark):
    rows = [("paid", "CANCELED", True), ("", "CANCELED", False), (None, None, True), ("waiting", "", False), ("REFUSED", "", None), ("AUTHORIZED", "", False), (None, None, None)]
    df = spark.createDataFrame(rows, "p string, s string, c boolean")
    assert "".join(r[0] for r in df.select(classify.order_letter(F.col("p"), F.col("s"), F.col("c"))).collect()) == "PCCECPO"
    quotes = spark.createDataFrame([("PAGO", 3), ("cancelada", 1), ("Em análise", 1), (None, 3), ("", 1), ("x", 2)], "p string, n int")
    assert "".join(r[0] for r in quotes.select(classify.quote_letter(F.col("p"), F.col("n"))).collect()) == "PCECPO"


def test_payment_families(spark):
    got = each(spark, ["Cartão de Crédito", "CREDIT_CARD", "pix", "pix card", "boleto", None], classify.payment_family)
    assert got == ["card", "card", "pix", "card", "other", "other"]


def test_postings(spark):
    got = each(spark, ["Jadlog", "Retirada em loja X", "Excursão / Ônibus", " motoboy", "Uber", "A combinar.", "", None], classify.is_posted)
    assert got == [True] + [False] * 7
