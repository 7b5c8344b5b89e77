"""Registered queries, one module per operator family."""

from importlib import import_module

FAMILIES = (
    "data_checks",
    "quality",
    "comparisons",
    "labels_and_programs",
    "enrichment_and_networks",
    "graphs_and_trajectories",
    "sources_and_models",
)


def load() -> None:
    for family in FAMILIES:
        import_module(f"{__name__}.{family}")
