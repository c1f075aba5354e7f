"""Dictionaries and curated files: small YAML configuration, read on the driver, used in expressions or as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _load(path: str):
    import yaml  # only where a YAML dictionary is used

    with open(path, encoding="utf-8") as handle:
        return yaml.safe_load(handle) or {}


def load_entities(path: str) -> tuple[list[tuple[str, str]], dict[str, str]]:
    """Aliases [(alias, key)] and the group of each key, from {group: [{key, aliases}]}."""
    aliases, groups = [], {}
    for group, entries in _load(path).items():
        for entry in entries:
            groups[entry["key"]] = group
            aliases += [(str(a), entry["key"]) for a in entry["aliases"]]
    return aliases, groups


def load_categories(path: str) -> tuple[list[tuple[str, list[str]]], dict[str, list[str]]]:
    """Categories with keywords in defined order, and prototype sentences, from {category: {keywords, prototypes}}."""
    spec = _load(path)
    words = [(c, [str(k) for k in (v or {}).get("keywords", [])]) for c, v in spec.items()]
    return words, {c: [str(p) for p in (v or {}).get("prototypes", [])] for c, v in spec.items()}


def load_glossary(path: str) -> tuple[dict[str, str], list[tuple[str, str, str]]]:
    """Surfaces {surface: term} and entries [(term, easy, example)], from {term: {easy, example, aliases} or text}."""
    surfaces, entries = {}, []
    for term, value in _load(path).items():
        value = value if isinstance(value, dict) else {"easy": value}
        entries.append((str(term), str(value.get("easy", "")), str(value.get("example") or "")))
        for surface in [term, *(value.get("aliases") or [])]:
            surfaces[str(surface)] = str(term)
    return surfaces, entries


def load_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Labelled pairs (a, b, same)."""
    rows = [(str(p["a"]), str(p["b"]), bool(p.get("same"))) for p in _load(path).get("pairs", [])]
    return spark.createDataFrame(rows, "a string, b string, same boolean")


def alias_table(spark: SparkSession, aliases: list[tuple[str, str]], groups: dict[str, str]) -> DataFrame:
    return spark.createDataFrame([(k, a, groups.get(k)) for a, k in aliases], "key string, alias string, grp string")
