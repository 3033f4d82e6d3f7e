"""The pattern dictionary: a small file that becomes a flat table and a list of literals for the plan."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from pathlib import Path
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from .. import schemas

try:
    import yaml
except ImportError:  # YAML is optional; a JSON file of the same layout works without it
    yaml = None

DICTIONARIES = Path(__file__).resolve().parent.parent / "dictionaries"

# Section of the file -> (category, strength)
SECTIONS = {
    "strong": ("pms", "strong"), "weak": ("pms", "weak"),
    "booking": ("booking", None), "forms": ("forms", None), "payments": ("payments", None),
    "all": ("other", None), "providers": ("phone", None),
    "intent_booking": ("intent_booking", None), "intent_forms": ("intent_forms", None),
    "intent_payments": ("intent_payments", None),
}


class Pattern(NamedTuple):
    prio: int
    category: str
    strength: str | None
    vendor: str | None
    regex: str


def load_patterns(*paths: str | Path, vendors: Iterable[str] | None = None) -> list[Pattern]:
    """Read dictionary files in order. ``vendors`` keeps only those software vendors."""
    wanted = None if vendors is None else set(vendors)
    out: list[Pattern] = []
    for path in paths:
        text = Path(path).read_text(encoding="utf-8")
        if str(path).endswith(".json"):
            sections = json.loads(text)
        elif yaml is not None:
            sections = yaml.safe_load(text)
        else:
            raise ImportError("reading a YAML dictionary needs PyYAML; give a .json file instead")
        for section, content in sections.items():
            category, strength = SECTIONS[section]
            groups = content.items() if isinstance(content, dict) else [(None, content)]
            for vendor, regexes in groups:
                if category == "pms" and wanted is not None and vendor not in wanted:
                    continue
                out += [Pattern(len(out) + 1 + i, category, strength, vendor, r) for i, r in enumerate(regexes)]
    return out


def production_patterns() -> list[Pattern]:
    return load_patterns(DICTIONARIES / "production.yaml")


def patterns_table(spark: SparkSession, patterns: Sequence[Pattern]) -> DataFrame:
    return spark.createDataFrame([tuple(p) for p in patterns], schemas.PATTERN)
