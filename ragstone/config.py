"""Retrieval configuration: sections of known keys with defaults; anything else is refused."""

from __future__ import annotations

import hashlib
import json

import yaml

# The keys of each section and their defaults. The fingerprint of an index depends on
# those of chunking and embedding and on the seed.
DEFAULTS = {
    "corpus": {"source": "", "search_query": "", "max_pages": 300, "request_delay_seconds": 1.0, "raw_dir": "data/corpus/raw", "manifest_path": "data/corpus/manifest.json"},
    "chunking": {"splitter": "recursive", "chunk_size": 512, "chunk_overlap": 64, "separators": ["\n\n", "\n", ". ", " ", ""]},
    "embedding": {"provider": "openai", "model": "text-embedding-3-small", "dimensions": 1536, "batch_size": 64},
    "store": {"type": "flat", "path": ".index"},
    "retrieval": {"retriever": "dense", "top_k": 5, "normalize": True},
    "generation": {"provider": "openai", "model": "", "temperature": 0.0, "max_tokens": 512},
}
SEED = 42
#: Fixed value: the model providers that can grade answers.
JUDGE_PROVIDERS = ("openai", "anthropic")


def complete(raw: dict) -> dict:
    """``raw`` with the defaults filled in; an unknown section or key raises ValueError."""
    if unknown := sorted(set(raw) - set(DEFAULTS) - {"seed"}):
        raise ValueError(f"unknown sections: {unknown}")
    config: dict = {"seed": int(raw.get("seed", SEED))}
    for section, defaults in DEFAULTS.items():
        given = raw.get(section) or {}
        if unknown := sorted(set(given) - set(defaults)):
            raise ValueError(f"unknown keys in {section}: {unknown}")
        config[section] = {**defaults, **given}
    return config


def load(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return complete(yaml.safe_load(file) or {})


def fingerprint(config: dict) -> str:
    """Short hash of what an index's content depends on: neither places nor how it is searched."""
    made_by = {"chunking": config["chunking"], "embedding": {k: config["embedding"][k] for k in ("provider", "model", "dimensions")}, "seed": config["seed"]}
    return hashlib.sha256(json.dumps(made_by, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:16]


def judge_provider(generation_provider: str, override: str | None = None) -> str:
    """Who grades: ``override`` if given, else the generator's provider; one that cannot grade raises ValueError."""
    provider = override or generation_provider
    if provider not in JUDGE_PROVIDERS:
        raise ValueError(f"{provider!r} cannot grade; use one of {list(JUDGE_PROVIDERS)}")
    return provider
