"""Text clean-up as Column expressions (no UDF)."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

# Trade words left out of names before matching.
TRADE_WORDS = [
    "jeans", "modas", "moda", "confeccoes", "oficial", "clothing", "collection",
    "acessorios", "tricot", "ltda", "me", "eireli", "sa",
]

# Texts read as true.
TRUE_WORDS = ["true", "1", "sim"]


def _accent_table() -> tuple[str, str]:
    """Every precomposed letter below U+2000 that decomposes to one base letter."""
    accented, plain = [], []
    for code in range(0xC0, 0x2000):
        letter = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFD", letter) if not unicodedata.combining(c))
        if len(base) == 1 and base != letter:
            accented.append(letter)
            plain.append(base)
    return "".join(accented), "".join(plain)


_ACCENTED, _PLAIN = _accent_table()


def strip_accents(c: Column) -> Column:
    return F.regexp_replace(F.translate(c, _ACCENTED, _PLAIN), "[\\u0300-\\u036f]", "")


def light_normalise(c: Column) -> Column:
    """Lower case without accents or outer blanks."""
    return F.trim(strip_accents(F.lower(c)))


def normalise_name(c: Column) -> Column:
    """Match key of a company name: no accents, trade words or punctuation."""
    plain = F.regexp_replace(strip_accents(F.lower(c)), "(^|[^a-z0-9])s\\.a\\.", " ")
    words = F.split(F.regexp_replace(plain, "[^a-z0-9]+", " "), " ")
    kept = F.filter(words, lambda w: (w != "") & ~w.isin(TRADE_WORDS))
    return F.array_join(kept, " ")


def compare_key(c: Column) -> Column:
    """Upper-case letters and digits only."""
    return F.regexp_replace(strip_accents(F.upper(F.coalesce(c, F.lit("")))), "[^A-Z0-9]", "")


def state_key(c: Column) -> Column:
    return F.left(compare_key(c), F.lit(2))


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def tax_root(c: Column) -> Column:
    """First 8 digits of a 14-digit tax id, null for shorter ones."""
    d = digits(c)
    return F.when(F.length(d) >= 14, F.substring(d, 1, 8))


def tax_branch(c: Column) -> Column:
    d = digits(c)
    return F.when(F.length(d) >= 12, F.substring(d, 9, 4)).otherwise(F.lit("9999"))


def phone_key(c: Column) -> Column:
    """Last ten digits, after the country code 55 is dropped from long numbers."""
    d = digits(c)
    local = F.when((F.length(d) > 11) & d.startswith("55"), F.substr(d, F.lit(3))).otherwise(d)
    return F.when(F.length(local) >= 10, F.right(local, F.lit(10))).otherwise(local)


def payment_key(c: Column) -> Column:
    """Payment key as registered: phones get +55, 13-digit tax ids a leading zero."""
    key = F.trim(c)
    number, n = key.rlike("^[0-9]+$"), F.length(key)
    return (
        F.when(number & n.isin(10, 11), F.concat(F.lit("+55"), key))
        .when(number & (n == 13), F.lpad(key, 14, "0"))
        .otherwise(F.nullif(key, F.lit("")))
    )


def first_truthy(*cols: Column) -> Column:
    """First column that is neither null nor empty text; '' if none is."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def is_true_text(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin(TRUE_WORDS), F.lit(False))


def subject_to_brand(c: Column, product_words: list[str] = ()) -> Column:
    """Brand in a ticket subject: product words, agent notes and remarks removed."""
    out = c
    word = "|".join(product_words)
    if word:
        out = F.regexp_replace(out, f"(?i)^({word})\\s*-\\s*", "")
        out = F.regexp_replace(out, f"(?i)\\s*-\\s*({word}).*", "")
    for rest in ("(?i)\\s*-\\s*agente.*", "\\s*\\|.*", "\\s*\\(.*\\)"):
        out = F.regexp_replace(out, rest, "")
    out = F.trim(out)
    return F.trim(F.regexp_replace(out, f"^({word}) ", "")) if word else out


def client_before_equals(c: Column) -> Column:
    return F.trim(F.split_part(c, F.lit(" = "), F.lit(1)))


def tag_value(tags: Column, prefix: str) -> Column:
    """Text after `prefix` in the first tag that starts with it."""
    hit = F.filter(tags, lambda t: t.startswith(prefix))
    return F.substr(F.try_element_at(hit, F.lit(1)), F.lit(len(prefix) + 1))


def clean_domain_id(c: Column) -> Column:
    """Whole number in a text id; '123.0' is 123 and other text is null."""
    return F.regexp_replace(F.trim(c.cast("string")), "\\.0$", "").try_cast("bigint")


def json_text(c: Column, limit: int | None = None) -> Column:
    """JSON of a list or map, cut to `limit` letters where the target column is that short."""
    out = F.to_json(c)
    return F.left(out, F.lit(limit)) if limit else out
