"""Ordered rules that turn texts and codes into classes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .money import MONEY, money_br
from .text import strip_accents

CATEGORIES = ["plano", "integracao", "assistente", "filial", "outros", "desconto"]

# Labels of a structured invoice text.
LABEL_PATTERNS = {
    "plano": r"(?i)Mensalidade\s*R\$\s*([\d.,]*)",
    "integracao": r"(?i)Integra[cç][aã]o\s*R\$\s*([\d.,]*)",
    "assistente": r"(?i)Assistente\s+do\s+Vendedor\s*R\$\s*([\d.,]*)",
    "filial": r"(?i)Filiais?\s*R\$\s*([\d.,]*)",
    "desconto": r"(?i)Desconto\s+concedido\s*-\s*R\$\s*([\d.,]*)",
}

# Plain invoice texts outside the subscription classes.
OTHER_WORDS = r"catálogo|catalogo|portal|conecta|setup|juros|multa|adicional|mes |mês "
EXCLUDED_PLANS = r"(?i)(^\s*starter\b|assinatura:\s*starter\b)"

# Plan names by level. Product brands come in as a parameter.
ADDON_PLANS = ["assitente do vendedor", "assistente do vendedor", "filial atacado"]
UPPER_PLANS = ["plano pro", "plano avancado"]


def _any_of(c: Column, words: list[str]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | c.contains(word)
    return hit


def item_categories(text: Column, value: Column, excluded: str = EXCLUDED_PLANS) -> Column:
    """Split an invoice item into six money columns; null if the item is excluded."""
    d = F.trim(F.coalesce(text, F.lit("")))
    low = F.lower(d)
    nil = F.lit(0).cast(MONEY)
    parts = {
        k: F.coalesce(money_br(F.nullif(F.regexp_extract(d, p, 1), F.lit(""))), nil)
        for k, p in LABEL_PATTERNS.items()
    }
    all_nil = sum(parts.values(), nil) == 0
    structured = low.contains("mensalidade") & (
        low.contains("integra") | low.contains("filiais") | low.contains("assistente")
    )
    plain = (
        F.when(low.contains("filial") | low.contains("filiais"), "filial")
        .when(low.contains("assistente"), "assistente")
        .when(low.contains("integra"), "integracao")
        .when(low.rlike(OTHER_WORDS), "outros")
        .otherwise("plano")
    )

    def part(k: str) -> Column:
        from_text = parts.get(k, nil)
        if k == "plano":
            from_text = F.when(all_nil, value).otherwise(from_text)
        return F.when(structured, from_text).when(plain == k, value).otherwise(nil).cast(MONEY).alias(k)

    return F.when(structured | ~d.rlike(excluded), F.struct(*[part(k) for k in CATEGORIES]))


def plan_level(
    name: Column, addons: list[str] = ADDON_PLANS, uppers: list[str] = UPPER_PLANS
) -> Column:
    """0 for an add-on, 2 for an upper base plan, 1 for any other base plan."""
    n = F.trim(F.replace(F.lower(strip_accents(F.coalesce(name, F.lit("")))), F.lit("_"), F.lit(" ")))
    return F.when(_any_of(n, addons), 0).when(_any_of(n, uppers), 2).otherwise(1)


def payment_family(c: Column) -> Column:
    """card before pix; anything else is other."""
    low = strip_accents(F.lower(c))
    return F.when(low.rlike("credit|card|cartao"), "card").when(low.contains("pix"), "pix").otherwise("other")


def order_letter(payment_status: Column, order_status: Column, is_canceled: Column) -> Column:
    """P paid, C canceled, E waiting, O other."""
    pay, status = F.upper(F.coalesce(payment_status, F.lit(""))), F.upper(F.coalesce(order_status, F.lit("")))
    return (
        F.when(pay == "PAID", "P")
        .when(F.coalesce(is_canceled, F.lit(False)) | (status == "CANCELED"), "C")
        .when(pay.isin("PENDING", "WAITING") | (status == "PENDING"), "E")
        .when(pay.isin("REJECTED", "REFUSED"), "C")
        .when(pay.isin("APPROVED", "AUTHORIZED"), "P")
        .otherwise("O")
    )


def quote_letter(payment_status: Column, code: Column) -> Column:
    """The same letters for quotes, with numeric code 1 paid and 3 canceled."""
    pay = strip_accents(F.upper(F.coalesce(payment_status, F.lit(""))))
    return (
        F.when(pay.isin("PAGO", "AUTORIZADO"), "P")
        .when(pay.contains("CANCEL") | (pay == "REJEITADO"), "C")
        .when(pay.contains("ANALISE"), "E")
        .when(code == 3, "C")
        .when(code == 1, "P")
        .otherwise("O")
    )


def recurrence_class(status: Column, has_automatic: Column) -> Column:
    s = F.lower(F.coalesce(status, F.lit("")))
    return (
        F.when((s == "paid") & has_automatic, "paid_recurring")
        .when(s == "paid", "paid_single")
        .when(s == "pending", "waiting")
        .when(s.isin("canceled", "expired"), s)
        .when(s == "", "unknown")
        .otherwise(s)
    )


def company_status(code: Column) -> Column:
    return F.when(code == 1, "Ativa").when(code == 2, "Desativada").otherwise("")


# Ways of hand-over that are no postings.
NOT_POSTED = "^(retirada em loja|excurs|motoboy|uber|a combinar)"


def is_posted(provider: Column) -> Column:
    p = F.lower(F.trim(F.coalesce(provider, F.lit(""))))
    return (p != "") & ~p.rlike(NOT_POSTED)
