"""Layers as plug-ins: what a layer finds, how it repairs it, in which order, and with which settings.

A module registers its layers where it is imported; ``discover`` imports every module of a package. Layers run by ``order``,
repairs by ``fix_order``; settings of a run lie over a layer's defaults, and of several the last one counts.
"""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rewriters, rules

Settings = Mapping[str, object]


@dataclass(frozen=True)
class Layer:
    """``find(lines, settings)`` gives ``doc_id, rule, severity, line_no``; ``fix(lines, settings)`` a repaired line table."""

    code: str
    order: int
    find: Callable[[DataFrame, Settings], DataFrame]
    fix: Callable[[DataFrame, Settings], DataFrame] | None = None
    fix_order: int | None = None
    defaults: Settings = field(default_factory=dict)


class Registry:
    def __init__(self) -> None:
        self.layers: dict[str, Layer] = {}

    def register(self, layer: Layer) -> Layer:
        if layer.code in self.layers:
            raise ValueError(f"two layers have the code {layer.code}")
        if layer.fix and layer.fix_order is None:
            raise ValueError(f"layer {layer.code} repairs, but in no order")
        self.layers[layer.code] = layer
        return layer

    def discover(self, package: str) -> list[str]:
        """Imports the modules of a package, which register their layers -> the codes that are new."""
        known = set(self.layers)
        found = importlib.import_module(package)
        for module in pkgutil.iter_modules(found.__path__, f"{package}."):
            importlib.import_module(module.name)
        return sorted(set(self.layers) - known)

    def settings(self, layer: Layer, *given: Mapping[str, Settings]) -> Settings:
        """A layer's defaults under what each of ``given`` has for its code, the last one on top."""
        return reduce(lambda a, b: {**a, **b.get(layer.code, {})}, given, dict(layer.defaults))

    def found(self, lines: DataFrame, *given: Mapping[str, Settings], disabled: Iterable[str] = ()) -> DataFrame:
        """``doc_id, code, rule, severity, line_no`` of every layer that is not disabled, in their order."""
        on = sorted((x for x in self.layers.values() if x.code not in set(disabled)), key=lambda x: (x.order, x.code))
        if not on:
            raise ValueError("every layer is disabled")
        parts = [x.find(lines, self.settings(x, *given)).select("doc_id", F.lit(x.code).alias("code"), "rule", "severity", "line_no") for x in on]
        return reduce(DataFrame.unionByName, parts)

    def repaired(self, lines: DataFrame, *given: Mapping[str, Settings], disabled: Iterable[str] = ()) -> DataFrame:
        """``lines`` after the repairs of the layers that have one, by ``fix_order``."""
        on = sorted((x for x in self.layers.values() if x.fix and x.code not in set(disabled)), key=lambda x: (x.fix_order, x.code))
        return reduce(lambda now, x: x.fix(now, self.settings(x, *given)), on, lines)


#: The rewriters that repair what a code's rules find, and their order.
FIXES = {
    "H": (1, ("unwrap_struct", "unwrap_statement", "strip_unlabeled", "add_quote")), "G": (5, ("quote_blanks",)), "I": (6, ("add_separators",)), "J": (7, ("drop_dash_in_item",)),
    "K": (8, ("list_blank",)), "L": (9, ("separator_blanks_added",)), "M": (10, ("display_unquoted",)), "N": (11, ("single_empty_quote",)),
}


def structure() -> Registry:
    """The structure rules as layers, each code with its repairs."""
    from ..plans.lines import line_context

    def find(code: str) -> Callable[[DataFrame, Settings], DataFrame]:
        others = {r.code for r in rules.RULES.values()} - {code}
        return lambda lines, settings: rules.findings(line_context(lines), others).withColumn("severity", F.lit(settings["severity"]) if settings.get("severity") else F.col("severity"))

    def fix(steps: tuple[str, ...]) -> Callable[[DataFrame, Settings], DataFrame]:
        return lambda lines, settings: rewriters.repaired(lines, steps)

    out = Registry()
    for nth, code in enumerate(sorted({r.code for r in rules.RULES.values()})):
        order, steps = FIXES.get(code, (None, ()))
        out.register(Layer(code, nth, find(code), fix(steps) if steps else None, order))
    return out
