"""Canonical financial statements merged from two sources, kept long until the last step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import fiscal_quarter_label, fiscal_year_label
from tidemark.functions.scalar import lookup

# Canonical line, tag of the filed facts, label of the second source.
INCOME = (
    ("Revenue", "RevenueFromOperations", "Sales"),
    ("Other Income", "OtherIncome", "Other Income"),
    ("Total Expenses", "Expenses", "Expenses"),
    ("Operating Profit", None, "Operating Profit"),
    ("Depreciation", "DepreciationDepletionAndAmortisationExpense", "Depreciation"),
    ("Interest", "FinanceCosts", "Interest"),
    ("Profit Before Tax", "ProfitBeforeTax", "Profit before tax"),
    ("Tax", "TaxExpense", "Tax"),
    ("Net Profit", "ProfitLossForPeriod", "Net profit"),
    ("EPS (Basic)", "BasicEarningsLossPerShareFromContinuingAndDiscontinuedOperations", None),
)
INCOME_PER_SHARE = ("EPS (Basic)",)
BALANCE = (
    ("Equity Share Capital", "EquityShareCapital", "Equity Share Capital"),
    ("Reserves", "OtherEquity", "Reserves"),
    ("Borrowings", None, "Borrowings"),
    ("Other Liabilities", None, "Other Liabilities"),
    ("Total Equity and Liabilities", "EquityAndLiabilities", "Total Equity and Liabilities"),
    ("Net Block", "PropertyPlantAndEquipment", "Net Block"),
    ("Capital Work in Progress", "CapitalWorkInProgress", "Capital Work in Progress"),
    ("Investments", None, "Investments"),
    ("Other Assets", None, "Other Assets"),
    ("Total Assets", "Assets", "Total Assets"),
    ("Receivables", "TradeReceivablesCurrent", "Receivables"),
    ("Inventory", "Inventories", "Inventory"),
    ("Cash & Bank", "CashAndCashEquivalents", "Cash & Bank"),
)
CASH = (
    ("Cash from Operating Activity", "CashFlowsFromUsedInOperatingActivities", "Cash from Operating Activity"),
    ("Cash from Investing Activity", "CashFlowsFromUsedInInvestingActivities", "Cash from Investing Activity"),
    ("Cash from Financing Activity", "CashFlowsFromUsedInFinancingActivities", "Cash from Financing Activity"),
    ("Net Cash Flow", "IncreaseDecreaseInCashAndCashEquivalents", "Net Cash Flow"),
)
BALANCE_CHECK = "Balance check (Assets - Equity&Liab)"
CRORE = 1e7
STATEMENTS = {
    "income": (INCOME, INCOME_PER_SHARE, "income_statement", "quarterly"),
    "balance": (BALANCE, (), "balance_sheet", "annual"),
    "cash": (CASH, (), "cash_flow", "annual"),
}
# The tags each statement view of the filed facts carries.
INCOME_CONCEPTS = (
    "RevenueFromOperations", "OtherIncome", "Income", "CostOfMaterialsConsumed",
    "PurchasesOfStockInTrade", "ChangesInInventoriesOfFinishedGoodsWorkInProgressAndStockInTrade",
    "EmployeeBenefitExpense", "FinanceCosts", "DepreciationDepletionAndAmortisationExpense",
    "OtherExpenses", "Expenses", "ProfitBeforeExceptionalItemsAndTax", "ExceptionalItemsBeforeTax",
    "ProfitBeforeTax", "CurrentTax", "DeferredTax", "TaxExpense",
    "ProfitLossForPeriodFromContinuingOperations", "ProfitLossFromDiscontinuedOperationsBeforeTax",
    "ProfitLossFromDiscontinuedOperationsAfterTax", "ProfitLossForPeriod",
    "OtherComprehensiveIncomeNetOfTaxes", "ComprehensiveIncomeForThePeriod",
    "ProfitOrLossAttributableToOwnersOfParent", "ProfitOrLossAttributableToNonControllingInterests",
    "BasicEarningsLossPerShareFromContinuingAndDiscontinuedOperations",
    "DilutedEarningsLossPerShareFromContinuingAndDiscontinuedOperations",
)
BALANCE_CONCEPTS = (
    "Assets", "CurrentAssets", "NoncurrentAssets", "PropertyPlantAndEquipment",
    "CapitalWorkInProgress", "Goodwill", "OtherIntangibleAssets", "InvestmentProperty",
    "NoncurrentInvestments", "CurrentInvestments", "InvestmentsAccountedForUsingEquityMethod",
    "TradeReceivablesCurrent", "TradeReceivablesNoncurrent", "CashAndCashEquivalents",
    "BankBalanceOtherThanCashAndCashEquivalents", "Inventories", "LoansCurrent", "LoansNoncurrent",
    "OtherCurrentAssets", "OtherNoncurrentAssets", "CurrentTaxAssets", "DeferredTaxAssetsNet",
    "Equity", "EquityShareCapital", "OtherEquity", "EquityAttributableToOwnersOfParent",
    "NonControllingInterest", "Liabilities", "CurrentLiabilities", "NoncurrentLiabilities",
    "BorrowingsCurrent", "BorrowingsNoncurrent", "TradePayablesCurrent", "TradePayablesNoncurrent",
    "ProvisionsCurrent", "ProvisionsNoncurrent", "CurrentTaxLiabilities", "DeferredTaxLiabilitiesNet",
    "EquityAndLiabilities",
)
CASH_CONCEPTS = (
    "CashFlowsFromUsedInOperatingActivities", "CashFlowsFromUsedInInvestingActivities",
    "CashFlowsFromUsedInFinancingActivities", "IncreaseDecreaseInCashAndCashEquivalents",
    "IncreaseDecreaseInCashAndCashEquivalentsBeforeEffectOfExchangeRateChanges",
    "EffectOfExchangeRateChangesOnCashAndCashEquivalents", "CashAndCashEquivalentsCashFlowStatement",
)


def wide_panel(facts: DataFrame, concepts: Sequence[str], index: Sequence[str] = ("symbol", "consolidated", "period_start", "period_end", "filingDate"),
               first_by: Sequence[str] = ("context_id",)) -> DataFrame:
    """One row per filing period, one column per concept, headline facts only.

    Instants have no start date; Spark groups NULL keys, so they need no placeholder. The
    first fact in ``first_by`` order fills a cell.
    """
    keys = [c for c in index if c in facts.columns]
    order = [c for c in first_by if c in facts.columns] or ["value"]
    rows = facts.where(F.col("concept").isin(*concepts) & ~F.col("has_dimensions") & F.col("value").isNotNull())
    return rows.groupBy(*keys).pivot("concept", list(concepts)).agg(F.min_by("value", F.struct(*order)))


def canonical_facts(facts: DataFrame, lines: Sequence[tuple], per_share: Sequence[str] = (), span: str = "any", per: Sequence[str] = ("symbol",),
                    newest_by: Sequence[str] = ("filed",)) -> DataFrame:
    """(…per, period_end, item, value) from filed facts, in crore except per-share lines.

    ``span``: quarters (at most 100 days), full_year (over 200 days, or an instant in
    March), or any. A later filing of the same period and line wins.
    """
    to_item = {tag: item for item, tag, _ in lines if tag}
    rows = facts.where(F.col("concept").isin(*to_item) & ~F.col("has_dimensions") & F.col("value").isNotNull())
    days = F.date_diff("period_end", "period_start")
    if span == "quarters":
        rows = rows.where(days <= 100)
    elif span == "full_year":
        rows = rows.where((days > 200) | (F.col("period_start").isNull() & (F.month("period_end") == 3)))
    item = lookup(to_item, "concept")
    value = F.col("value") if not per_share else F.when(item.isin(*per_share), F.col("value") * CRORE).otherwise(F.col("value"))
    order = F.struct(*newest_by, "value") if newest_by else F.struct("value")
    return rows.select(*per, "period_end", item.alias("item"), value.alias("value"), *newest_by).groupBy(*per, "period_end", "item").agg(
        (F.max_by("value", order) / CRORE).alias("value"))


def canonical_screener(rows: DataFrame, lines: Sequence[tuple], statement: str, period_type: str, per: Sequence[str] = ("symbol",)) -> DataFrame:
    """(…per, period_end, item, value) from the second source, already in crore."""
    to_item = {label: item for item, _, label in lines if label}
    keep = rows.where((F.col("statement") == statement) & (F.col("period_type") == period_type) & F.col("concept").isin(*to_item) & F.col("value").isNotNull())
    return keep.groupBy(*per, "period_end", lookup(to_item, "concept").alias("item")).agg(F.max("value").alias("value"))


def merge_canonical(primary: DataFrame, secondary: DataFrame | None, lines: Sequence[tuple], label: Column | None = None,
                    per: Sequence[str] = ("symbol",)) -> DataFrame:
    """The primary source wins each (period, line); the second fills what is missing.

    Rows carry the statement position of the line and the period's rank, newest first.
    """
    key = [*per, "period_end", "item"]
    x = primary.withColumnRenamed("value", "_x")
    if secondary is None:
        df = x.withColumn("_s", F.lit(None).cast("double"))
    else:
        df = x.join(secondary.withColumnRenamed("value", "_s"), key, "full")
    position = lookup({item: i for i, (item, _, _) in enumerate(lines)}, "item")
    return df.select(*key, F.bround(F.coalesce("_x", "_s"), 2).alias("value"), position.alias("position"),
                     (label if label is not None else F.col("period_end").cast("string")).alias("period"))


def balance_check(balance: DataFrame, per: Sequence[str] = ("symbol",)) -> DataFrame:
    """The statement with assets minus equity and liabilities appended as a line."""
    keys = [*per, "period_end", "period"]
    pick = lambda name: F.max(F.when(F.col("item") == name, F.col("value")))
    check = balance.groupBy(*keys).agg((pick("Total Assets") - pick("Total Equity and Liabilities")).alias("value")).where("value IS NOT NULL")
    return balance.unionByName(check.withColumn("item", F.lit(BALANCE_CHECK)).withColumn("position", F.lit(len(BALANCE))))


def statement(kind: str, facts: DataFrame, screener: DataFrame | None = None, per: Sequence[str] = ("symbol",),
              newest_by: Sequence[str] = ("filed",), lines: Sequence[tuple] | None = None) -> DataFrame:
    """Long income, balance or cash statement with fiscal period labels."""
    default, per_share, name, period_type = STATEMENTS[kind]
    lines = lines or default
    x = canonical_facts(facts, lines, per_share, "quarters" if kind == "income" else "full_year", per, newest_by)
    s = None if screener is None else canonical_screener(screener, lines, name, period_type, per)
    label = fiscal_quarter_label("period_end") if kind == "income" else fiscal_year_label("period_end")
    out = merge_canonical(x, s, lines, label, per)
    return balance_check(out, per) if kind == "balance" else out


def statement_table(long: DataFrame, periods: Sequence[str], per: Sequence[str] = ("symbol",)) -> DataFrame:
    """Lines as rows with their unit, and the given periods as columns."""
    return long.groupBy(*per, "position", "item", unit_label(F.col("item")).alias("label")).pivot("period", list(periods)).agg(F.max("value"))


def unit_label(item: Column, per_share: Sequence[str] = INCOME_PER_SHARE) -> Column:
    return F.concat(item, F.when(item.isin(*per_share), F.lit(" (Rs/share)")).otherwise(F.lit(" (Rs Cr)")))
