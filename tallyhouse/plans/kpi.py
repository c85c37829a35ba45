"""Domain KPI table: value, payment volume, NPS and recurring revenue side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .groups import active_domains


def kpi_domains(
    domains: DataFrame, settings: DataFrame, angels: DataFrame, integrations: DataFrame, excluded_partners: Sequence[str] = ()
) -> DataFrame:
    """Active domains of named partners, with staff, integration and whether payment is on.

    Payment is on for a domain with any enabled setting that allows card or pix.
    """
    ready = settings.filter("enabled and (card_enabled or pix_enabled)").select("domain_id").distinct()
    rows = active_domains(domains, excluded_partners, keep_null_partner=False)
    rows = rows.join(ready.withColumn("payment_on", F.lit(True)), "domain_id", "left")
    rows = rows.join(angels, "angel_id", "left").join(integrations, "integration_id", "left")
    return rows.select("domain_id", "angel_name", "integration_name", F.coalesce("payment_on", F.lit(False)).alias("payment_on")).distinct()


def kpi_table(domains: DataFrame, *frames: DataFrame) -> DataFrame:
    """Every domain once, with the measures each frame holds for it."""
    out = domains
    for frame in frames:
        out = out.join(frame, "domain_id", "left")
    return out
