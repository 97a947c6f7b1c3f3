"""Named queries over the driver's tables."""

from importlib import import_module

MODULES = ("warehouse", "prices", "cross_asset", "options", "events", "filings", "facts", "transits", "rainfall",
           "quality", "readmodels", "shapes", "textsignals", "live")


def load_all() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        try:
            import_module(f"tidemark.plans.{name}_queries")
        except ModuleNotFoundError as exc:
            if f"{name}_queries" not in str(exc):
                raise
