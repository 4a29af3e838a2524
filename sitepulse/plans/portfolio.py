"""Where the sites are and who owns them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sitepulse.functions import title_case
from sitepulse.operators import frequency, share_of_total
from sitepulse.sources.writers import replace_slices


def clean_portfolio(portfolio: DataFrame) -> DataFrame:
    return portfolio.withColumn("state", title_case(portfolio["state"]))


def portfolio_shares(portfolio: DataFrame) -> dict[str, DataFrame]:
    """Sites per bank, state, state and city, customer and state, with shares; per customer."""
    clean = clean_portfolio(portfolio)
    fine = {"scale": 1.0, "digits": 4}
    return {
        "bank": share_of_total(clean, ["bank_name"]),
        "state": share_of_total(clean, ["state"]),
        "state_city": share_of_total(clean, ["state", "city"], **fine),
        "customer_state": share_of_total(clean, ["customer", "state"], **fine),
        "customer": frequency(clean, "customer"),
    }


def site_master(sites: DataFrame) -> DataFrame:
    return sites.select("bank", "site_name", "site_id")


def publish_site_master(sites: DataFrame, path: str) -> None:
    """Replace the list of every customer present in ``sites``, leave the others."""
    replace_slices(site_master(sites), path, ["bank"])
