"""Settings of the engine: one plain dict, read from YAML or given in code."""

from __future__ import annotations

import copy

# The default settings a ticket analysis starts from.
DEFAULTS = {
    "data": {
        "source": "parquet",
        "path": None,
        "key": "ticket_id",
        "text_columns": ["subject", "body"],
        "metadata_columns": {
            "priority": "priority",
            "ticket_type": "type",
            "product": "queue",
            "channel": "language",
        },
    },
    "preprocessing": {"combine_separator": " "},
    "embeddings": {
        "provider": "hashing",
        "dim": 64,
        "batch_size": 128,
        "tag_enrichment": {"enabled": True, "column": "tag_1", "weight": 0.3},
    },
    "imputation": {
        "enabled": True,
        "confidence_threshold": 0.7,
        "low_confidence_fill": "Unknown",
        "max_features": 15000,
        "ngram_range": [1, 2],
        "max_iter": 1000,
        "C": 1.0,
        "min_class_size": 5,
        "columns": {"type": {"enabled": True, "threshold": 0.7}},
    },
    "operational_features": {
        "priority_map": {"very_low": 0, "low": 1, "medium": 2, "high": 3, "critical": 4},
        "product_encoding": "frequency",
        "normalize": True,
    },
    "fusion": {"alpha": 0.7},
    "clustering": {
        "kmeans": {"k": 8, "init": "k-means++", "n_init": 10, "random_state": 42},
        "hdbscan": {"min_cluster_size": 15, "min_samples": 5, "metric": "euclidean"},
    },
    "evaluation": {"top_n_keywords": 10, "max_features": 5000, "sample_size": 5000, "seed": 42},
}


def merge(base: dict, changes: dict | None) -> dict:
    """Return ``base`` with ``changes`` laid over it, section by section."""
    out = copy.deepcopy(base)
    for key, value in (changes or {}).items():
        if isinstance(value, dict) and isinstance(out.get(key), dict) and key not in ("priority_map", "columns"):
            out[key] = merge(out[key], value)
        else:
            out[key] = copy.deepcopy(value)
    return out


def settings(changes: dict | None = None) -> dict:
    """The default settings with ``changes`` applied."""
    return merge(DEFAULTS, changes)


def load_settings(path: str) -> dict:
    """Read a YAML settings file and fill in the defaults."""
    import yaml

    with open(path, encoding="utf-8") as handle:
        return settings(yaml.safe_load(handle))


def key_column(config: dict) -> str:
    """Name of the ticket key column."""
    return config["data"].get("key", "ticket_id")
