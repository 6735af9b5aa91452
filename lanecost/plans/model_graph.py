"""Named models that refer to each other, built in the order of their references.

A model is a function of the frames it names. ``build`` takes what the wanted models need,
refuses unknown names and cycles before anything runs, and calls each function once. A
model with several readers is written once as a Parquet table that all of them read, so its
chain does not run again for each; one with a single reader stays part of that reader's
plan. Incremental and per-period work is in ``incremental`` and ``period_marts``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame

from lanecost.operators import marts as M
from lanecost.operators import model as Mo
from lanecost.plans.flows import ModelConfig
from lanecost.sinks.writers import materialize

KINDS = ("auto", "table", "view")


@dataclass(frozen=True)
class Model:
    build: Callable[..., DataFrame]
    refs: Sequence[str] = ()
    kind: str = "auto"


class ModelGraph:
    def __init__(self):
        self.models: dict[str, Model] = {}

    def add(self, name: str, build: Callable[..., DataFrame], refs: Sequence[str] = (), kind: str = "auto") -> None:
        """``build`` gets the frames of ``refs`` in their order. ``table``: always written;
        ``view``: never; ``auto``: written where several models read it."""
        if name in self.models:
            raise ValueError(f"two models are called {name!r}")
        if kind not in KINDS:
            raise ValueError(f"unknown kind {kind!r}")
        self.models[name] = Model(build, tuple(refs), kind)

    def order(self, targets: Iterable[str] | None = None) -> list[str]:
        """The models ``targets`` need (all, if not given), each after those it refers to."""
        needed: dict[str, set[str]] = {}
        todo = sorted(self.models if targets is None else targets)
        while todo:
            name = todo.pop()
            if name not in self.models:
                by = [n for n, refs in needed.items() if name in refs]
                raise ValueError(f"no model {name!r}" + (f", which {by[0]!r} refers to" if by else ""))
            if name not in needed:
                needed[name] = set(self.models[name].refs)
                todo.extend(self.models[name].refs)
        try:
            return list(TopologicalSorter(needed).static_order())
        except CycleError as e:
            raise ValueError("models refer to each other in a circle: " + " -> ".join(e.args[1])) from e

    def build(self, base: str, targets: Iterable[str] | None = None) -> dict[str, DataFrame]:
        """All models of ``order``; tables go under ``base``."""
        order = self.order(targets)
        readers = {n: sum(n in self.models[m].refs for m in order) for n in order}
        out: dict[str, DataFrame] = {}
        for name in order:
            m = self.models[name]
            df = m.build(*[out[r] for r in m.refs])
            if m.kind == "table" or (m.kind == "auto" and readers[name] > 1):
                df = materialize(df, name, base)
            out[name] = df
        return out


def corridor_models(sources: Mapping[str, Callable[[], DataFrame]], cfg: ModelConfig = ModelConfig()) -> ModelGraph:
    """The graph from the sources ``clean``, ``country`` and ``currency`` to the four marts."""
    g = ModelGraph()
    for name, read in sources.items():
        g.add(name, read, kind="view")
    g.add("landing", Mo.conform_landing, ["clean"])
    g.add("staged", Mo.stage_typed, ["landing"])
    g.add("enriched", lambda s, c, u: Mo.enrich_corridor(s, c, u, cfg.remap, cfg.zones), ["staged", "country", "currency"])
    g.add("decomposed", Mo.cost_decompose, ["enriched"])
    g.add("flagged", lambda d: Mo.flag_transparency(d, cfg.tolerance), ["decomposed"])
    g.add("corridor_cost_trends", lambda f: M.corridor_cost_trends(f, cfg.approx_median, cfg.ranged_median), ["flagged"])
    g.add("provider_comparison", M.provider_comparison, ["flagged"])
    g.add("transparency_scorecard", lambda f: M.transparency_scorecard(f, cfg.min_sample), ["flagged"])
    g.add("spotlight", lambda f: M.spotlight(f, cfg.spotlight_country), ["flagged"])
    return g
