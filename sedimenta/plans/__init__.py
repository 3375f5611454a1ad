"""Jobs: the parliamentary configuration, and the queries over the driver's tables."""

from importlib import import_module

_MODULES = (
    "star_queries",
    "land_queries",
    "conform_queries",
    "enrich_queries",
    "quality_queries",
    "stream_queries",
    "parliament_queries",
)


def load_queries():
    """Import all query modules; they register themselves."""
    for name in _MODULES:
        import_module(f"sedimenta.plans.{name}")
    return import_module("sedimenta.plans.registry")
