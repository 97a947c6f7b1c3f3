"""The shapes the screens read: each is a point-in-time read of one or more tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import DAY_MON_YEAR, parse
from tidemark.functions.scalar import lookup, to_double
from tidemark.operators.asof import collapse, latest_per, latest_vintage

# Books of the participant table and labels of the signal stack.
BOOKS = {
    "Future Index Long": "future_index/long",
    "Future Index Short": "future_index/short",
    "Future Stock Long": "future_stock/long",
    "Future Stock Short": "future_stock/short",
    "Total Long Contracts": "total/long",
    "Total Short Contracts": "total/short",
}
SIGNALS = (
    ("derived_capm_beta", "beta", "CAPM beta", "r_squared"),
    ("derived_momentum_zscore", "momentum_zscore", "Momentum z", "trailing_return"),
    ("derived_low_vol_factor", "low_vol_score", "Low volatility", "realized_vol"),
    ("derived_size_factor", "size_score", "Size", "market_cap_inr_cr"),
    ("derived_variance_ratio", "variance_ratio", "Variance ratio", "z_stat"),
    ("derived_factor_model", "composite_score", "Factor composite", "momentum_zscore"),
    ("derived_multivariate_outliers", "anomaly_score_raw", "Anomaly score", "is_outlier"),
)


def price_history(prices: DataFrame, delivery: DataFrame | None, symbol: str, as_of: str | date | None = None, limit: int | None = None,
                  known: str = "knowledge_date", order: Sequence[str] = ("_vintage_id",)) -> DataFrame:
    """Daily bars of one symbol with the delivered share where it is known, oldest first; of the newest ``limit`` days if wanted."""
    px = collapse(prices.where(F.col("symbol") == symbol), ["symbol", "trade_date"], as_of, known=known, order=order).drop(known, *order)
    if delivery is not None:
        d = collapse(delivery.where(F.col("symbol") == symbol), ["symbol", "trade_date"], as_of, known=known, order=order)
        px = px.join(d.select("trade_date", "delivered_qty", "delivered_pct"), "trade_date", "left")
    return newest(px, "trade_date", limit).orderBy("trade_date")


def newest(df: DataFrame, date_col: str, limit: int | None) -> DataFrame:
    return df if limit is None else df.orderBy(F.desc(date_col)).limit(limit)


def signal_stack(tables: Mapping[str, DataFrame], symbol: str | None = None, as_of: str | date | None = None,
                 signals: Sequence[tuple] = SIGNALS, known: str = "knowledge_date", order: Sequence[str] = ("_vintage_id",)) -> DataFrame:
    """Newest value of every stored signal, one row each; tables that do not exist are skipped."""
    out = None
    for view, value, label, context in signals:
        if view not in tables:
            continue
        df = tables[view] if symbol is None else tables[view].where(F.col("symbol") == symbol)
        one = latest_per(df, ["symbol", "as_of_date"], ["symbol"], as_of, known=known, order=order).select(
            "symbol", F.lit(label).alias("signal"), F.col(value).cast("double").alias("value"), F.lit(context).alias("context_name"),
            F.col(context).cast("string").alias("context_value"), "as_of_date")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("none of the signal tables exist")
    return out


def event_tape(parts: Sequence[DataFrame], limit: int | None = None, ties: Sequence[str] = ("kind", "headline", "detail")) -> DataFrame:
    """One reverse-chronological stream of (ts, kind, headline, detail). ``ts`` is parsed by
    each source before the union, since the feeds write dates differently."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.orderBy(F.desc("ts"), *ties)
    return out if limit is None else out.limit(limit)


def statement_for(facts: DataFrame, symbol, kind: str, as_of: str | date | None = None, document: str = "source_url", **kwargs) -> DataFrame:
    """Statement of one company from the newest scrape of each of its filings."""
    from tidemark.operators.statements import statement

    scrape = latest_vintage(facts.where(F.col("symbol") == symbol), [document], as_of, order=kwargs.pop("order", ("_vintage_id",)))
    return statement(kind, scrape, **kwargs)


def universe_members(prices: DataFrame, constituents: DataFrame | None) -> DataFrame:
    """Every symbol with price history, with industry and index where it is a member."""
    u = prices.select("symbol", "isin").distinct()
    return u if constituents is None else u.join(constituents.select("symbol", "industry", "index_membership"), "symbol", "left")


def watchlist_rank(factors: DataFrame, digest: DataFrame | None, limit: int | None = None) -> DataFrame:
    """Strongest composite scores first, with the digest's text where there is one."""
    df = factors if digest is None else factors.join(digest, "symbol", "left")
    df = df.orderBy(F.abs("composite_score").desc(), "symbol")
    return df if limit is None else df.limit(limit)


def macro_snapshot(policy: DataFrame | None, gold: DataFrame | None, chokepoints: DataFrame | None, stress: float = 2.0) -> DataFrame:
    """Long status strip: group, label, value, unit, as_of. Only stressed routes appear.

    Inputs are already the newest row per thing.
    """
    parts = []
    text = lambda c: F.col(c).cast("string").alias("as_of")
    if policy is not None:
        parts.append(policy.select(F.lit("policy").alias("group"), F.col("indicator").alias("label"), F.col("value").cast("double").alias("value"),
                                   F.col("unit"), text("as_of")))
    if gold is not None:
        parts.append(gold.select(F.lit("gold").alias("group"), F.concat(F.lit("India gold premium ("), "session", F.lit(")")).alias("label"),
                                 F.col("premium_pct").cast("double").alias("value"), F.lit("%").alias("unit"), text("rate_date")))
    if chokepoints is not None:
        parts.append(chokepoints.where(F.abs("zscore") >= stress).select(
            F.lit("chokepoint").alias("group"), F.concat("portname", F.lit(" ("), "metric", F.lit(")")).alias("label"),
            F.col("zscore").cast("double").alias("value"), F.lit("z").alias("unit"), text("as_of")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def participants(wide: DataFrame, client: str = "Client Type", limit: int | None = None, books: Mapping[str, str] = BOOKS) -> DataFrame:
    """Books of each client type in long form, newest first."""
    cols = list(books)
    src = wide.select("trade_date", F.col(f"`{client}`").alias("client_type"), *[F.col(f"`{c}`").cast("double").alias(c) for c in cols])
    tag = F.split(lookup(books, "column"), "/")
    long = src.unpivot(["trade_date", "client_type"], cols, "column", "contracts").select(
        "trade_date", "client_type", tag[0].alias("book"), tag[1].alias("side"), "contracts")
    return long if limit is None else long.orderBy(F.desc("trade_date"), "client_type", "book", "side").limit(limit)


def cash_flows(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """Buy, sell and net by category and date, text cells read tolerantly, newest first."""
    out = rows.select("category", parse("date", DAY_MON_YEAR).alias("date"), to_double("buyValue").alias("buy_value"),
                      to_double("sellValue").alias("sell_value"), to_double("netValue").alias("net_value"))
    return out if limit is None else out.orderBy(F.desc_nulls_last("date"), "category").limit(limit)


def latest_cash_flows(rows: DataFrame) -> DataFrame:
    w = Window.partitionBy("category").orderBy(F.desc_nulls_last("date"), F.desc_nulls_last("net_value"))
    return cash_flows(rows, None).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_divergence(divergence: DataFrame) -> DataFrame:
    """Newest comparison of each metric."""
    w = Window.partitionBy("metric").orderBy(F.desc("trade_date"))
    return divergence.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def regimes(current: DataFrame, balance: DataFrame | None) -> DataFrame:
    """Where each corridor stands and how its traffic was absorbed."""
    if balance is None:
        return current
    return current.join(balance.select(F.col("corridor").alias("portname"), "substitute", "absorbed_pct", "interpretation"), "portname", "left")


def top_breaks(breaks: DataFrame, limit: int | None = None) -> DataFrame:
    out = breaks.orderBy(F.abs("change_per_day").desc(), "portname", "break_date")
    return out if limit is None else out.limit(limit)


def transit_series(panel: DataFrame, portname: str | None = None, limit: int | None = None) -> DataFrame:
    df = panel if portname is None else panel.where(F.col("portname") == portname)
    return newest(df, "date", limit).orderBy("date", "portname")


def rating_board(feeds: Mapping[str, DataFrame], q: str | None = None, limit: int | None = None) -> DataFrame:
    """Rating actions of every agency under common column names, newest first.

    ``q`` is a literal, case-insensitive company substring.
    """
    out = None
    for agency, df in feeds.items():
        one = df.select(F.lit(agency).alias("agency"), F.col("action_id").cast("string").alias("action_id"), "company_name", "rating_date", "heading", "action_type", "category")
        if q:
            one = one.where(F.contains(F.lower("company_name"), F.lit(q.lower())))
        out = one if out is None else out.unionByName(one)
    return out if limit is None else out.orderBy(F.desc("rating_date"), "agency", "action_id").limit(limit)


def listing_split(actions: DataFrame, action: str = "action_type", status: str = "listing_status") -> DataFrame:
    return actions.groupBy(action, status).agg(F.count(F.lit(1)).alias("n"))


def company_names(prices: DataFrame, master: DataFrame) -> DataFrame:
    """Registered company of each symbol through the ISIN both sides carry."""
    return prices.select("symbol", "isin").distinct().join(master.select("isin", "name"), "isin").groupBy("symbol").agg(F.min("name").alias("name"))


def curve_of_day(settlements: DataFrame, day: str = "trade_date_requested", order: Column | str = "contract_order", limit: int | None = None) -> DataFrame:
    """Contracts of the newest date in curve order, aggregate rows left out."""
    last = settlements.agg(F.max(day).alias("m")).scalar()
    out = settlements.where((F.col(day) == last) & ~F.col("is_total"))
    return out if limit is None else out.orderBy(order).limit(limit)


def board(df: DataFrame, order_by: Sequence[str | Column], limit: int | None = None, where: str | Column | None = None) -> DataFrame:
    """Filtered top rows, the shape of the filing boards."""
    out = (df if where is None else df.where(where)).orderBy(*order_by)
    return out if limit is None else out.limit(limit)
