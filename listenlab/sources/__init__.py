from listenlab.sources.interactions import (
    INTERACTION_COLUMNS,
    interactions_from_events,
    load_fixture,
    read_interactions,
    to_contract,
)

__all__ = [
    "INTERACTION_COLUMNS",
    "interactions_from_events",
    "load_fixture",
    "read_interactions",
    "to_contract",
]
