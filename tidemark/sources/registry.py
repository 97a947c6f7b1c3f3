"""Natural keys of every dataset that can be read point in time.

One registry drives both the as-of reads and revision detection. A key is declared,
never inferred: a view without an entry can be monitored but not collapsed.
"""

from __future__ import annotations

# Dataset names and the columns that identify a row of each.
DATASET_KEYS: dict[str, tuple[str, ...]] = {
    "nse_bhavcopy": ("TradDt", "TckrSymb", "SctySrs"),
    "nse_bhavcopy_delivery": ("SYMBOL", "SERIES", "DATE1"),
    "nse_index_constituents": ("index", "Symbol"),
    "nse_participant_oi": ("trade_date", "Client Type"),
    "nse_optchain": ("symbol", "expiry_date", "strike_price", "option_type", "fetched_at_utc"),
    "nse_announcements": ("seq_id",),
    "nse_insider_trading": ("appId",),
    "nse_bulk_deals": ("BD_DT_DATE", "BD_SYMBOL", "BD_CLIENT_NAME", "BD_BUY_SELL", "BD_QTY_TRD"),
    "nse_block_deals": ("BD_DT_DATE", "BD_SYMBOL", "BD_CLIENT_NAME", "BD_BUY_SELL", "BD_QTY_TRD"),
    "nse_fii_dii": ("category", "date"),
    "bse_announcements": ("NEWSID",),
    "bse_scrip_master": ("ISIN_NUMBER",),
    "upstox_fii_activity": ("trade_date", "segment"),
    "rbi_forex_reserves": ("week_ended", "component_code"),
    "rbi_policy_rates": ("rate_name",),
    "rbi_key_indicators": ("indicator", "as_of"),
    "ibja_rates": ("rate_date", "session", "metal_purity"),
    "cme_settlements": ("product", "trade_date_requested", "month"),
    "mcx_bhavcopy": ("Symbol", "ExpiryDate", "InstrumentName", "StrikePrice", "OptionType", "trade_date"),
    "sec_us_fundamentals": ("cik", "field", "period"),
    "sec_sp500_constituents": ("cusip",),
    "crisil_rating_actions": ("pr_id",),
    "icra_rating_actions": ("rationale_id",),
    "care_rating_actions": ("file_url",),
    "portwatch_chokepoints": ("portname", "date"),
    "noaa_oni": ("season", "year"),
    "derived_india_gold_premium": ("rate_date", "session"),
    "derived_capm_beta": ("symbol", "as_of_date"),
    "derived_correlation": ("symbol_a", "symbol_b", "as_of_date"),
    "derived_pairs_candidates": ("symbol_a", "symbol_b", "as_of_date"),
    "derived_momentum_zscore": ("symbol", "as_of_date"),
    "derived_variance_ratio": ("symbol", "as_of_date", "lag"),
    "derived_option_greeks": ("symbol", "expiry_date", "strike_price", "option_type", "as_of_date"),
    "derived_insider_filing_frequency": ("symbol", "as_of_date"),
    "derived_bulk_block_anomaly": ("symbol", "as_of_date"),
    "derived_fii_dii_divergence": ("trade_date",),
    "derived_promoter_holding_change": ("symbol", "quarter_end"),
    "derived_digest": ("instrument", "as_of_date"),
    "derived_fii_source_divergence": ("trade_date", "metric"),
    "derived_multivariate_outliers": ("symbol", "as_of_date"),
    "derived_corporate_events": ("NEWSID",),
    "derived_equity_commodity_correlation": ("asset_a", "asset_b", "as_of_date"),
    "derived_equity_macro_correlation": ("equity_symbol", "macro_series", "as_of_date"),
    "derived_factor_model": ("symbol", "as_of_date"),
    "derived_low_vol_factor": ("symbol", "as_of_date"),
    "derived_size_factor": ("symbol", "as_of_date"),
    "analytics_chokepoint_zscore": ("as_of", "portname", "metric"),
    "analytics_reroute_balance": ("corridor",),
    "analytics_current_regime": ("portname", "metric"),
    "analytics_regime_breaks": ("portname", "break_date", "metric"),
    "analytics_enso_state": ("as_of_season", "as_of_year"),
    "analytics_monsoon_progress": ("region",),
    "analytics_imd_normals": ("region",),
    "analytics_monsoon_departure": ("region",),
}

# Columns that describe the fetch, not the observation.
METADATA_COLUMNS = ("knowledge_date", "_vintage_id", "_vintage", "index_fetched_at", "fetched", "source_url")


def natural_key(view: str) -> list[str]:
    """Declared key of ``view``; raises when none is declared."""
    try:
        return list(DATASET_KEYS[view])
    except KeyError:
        raise KeyError(
            f"{view} has no declared natural key; declare one in tidemark.sources.registry "
            "before reading it point in time"
        ) from None


def register(view: str, key: tuple[str, ...] | list[str]) -> None:
    """Declare the key of a further dataset."""
    DATASET_KEYS[view] = tuple(key)
