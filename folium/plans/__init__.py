"""Recipes: registered operators composed into one lazy plan, checked before anything runs."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from folium.operators.graph import toposort


@dataclass(frozen=True)
class Param:
    type: type
    default: Any = None
    required: bool = False
    choices: tuple = ()
    least: float | None = None
    most: float | None = None
    pattern: str | None = None


@dataclass(frozen=True)
class Operator:
    name: str
    run: Callable[..., DataFrame]
    needs: int
    columns_in: tuple[tuple[str, ...], ...]
    columns_out: tuple[str, ...]
    params: dict[str, Param] = field(default_factory=dict)


REGISTRY: dict[str, Operator] = {}


def operator(name: str, columns_in: list[list[str]], columns_out: list[str], **params: Param):
    """Register a function (DataFrame, ..., **params) -> DataFrame with the columns that it needs and gives."""

    def wrap(run):
        if name in REGISTRY:
            raise ValueError(f"operator {name} is there already")
        REGISTRY[name] = Operator(name, run, len(columns_in), tuple(map(tuple, columns_in)), tuple(columns_out), params)
        return run

    return wrap


@dataclass(frozen=True)
class Stage:
    id: str
    op: str
    needs: tuple[str, ...] = ()
    params: dict[str, Any] = field(default_factory=dict)


def check_params(op: Operator, given: dict[str, Any]) -> dict[str, Any]:
    """Given parameters with defaults; unknown names, wrong types and values out of bounds are errors."""
    unknown = set(given) - set(op.params)
    if unknown:
        raise ValueError(f"{op.name}: unknown parameter {sorted(unknown)[0]}")
    out = {}
    for k, p in op.params.items():
        if k not in given:
            if p.required:
                raise ValueError(f"{op.name}: parameter {k} is missing")
            out[k] = p.default
            continue
        v = given[k]
        if p.type is float and isinstance(v, int) and not isinstance(v, bool):
            v = float(v)
        if not isinstance(v, p.type) or (p.type is int and isinstance(v, bool)):
            raise ValueError(f"{op.name}: parameter {k} is no {p.type.__name__}")
        if p.choices and v not in p.choices or p.least is not None and v < p.least or p.most is not None and v > p.most or p.pattern and not re.search(p.pattern, v):
            raise ValueError(f"{op.name}: parameter {k} = {v!r} is not allowed")
        out[k] = v
    return out


class Recipe:
    """A graph of stages over named inputs."""

    def __init__(self, stages: list[Stage], registry: dict[str, Operator] | None = None):
        self.registry = REGISTRY if registry is None else registry
        self.stages = {s.id: s for s in stages}
        if len(self.stages) < len(stages):
            raise ValueError("two stages have one id")

    def order(self, inputs: set[str]) -> list[str]:
        return toposort({s.id: [n for n in s.needs if n not in inputs] for s in self.stages.values()})

    def check(self, inputs: dict[str, StructType]) -> list[str]:
        """Order of the stages, after checks of operators, parameters and columns on each edge."""
        order = self.order(set(inputs))
        have = {k: set(v.fieldNames()) for k, v in inputs.items()}
        for i in order:
            s = self.stages[i]
            op = self.registry.get(s.op)
            if op is None:
                raise ValueError(f"stage {i}: no operator {s.op}")
            if len(s.needs) != op.needs:
                raise ValueError(f"stage {i}: {s.op} takes {op.needs} inputs")
            check_params(op, s.params)
            for n, cols in zip(s.needs, op.columns_in):
                gone = set(cols) - have[n]
                if gone:
                    raise ValueError(f"stage {i}: {n} has no column {sorted(gone)[0]}")
            have[i] = set(op.columns_out)
        return order

    def plan(self, inputs: dict[str, DataFrame], start: str | None = None, end: str | None = None) -> dict[str, DataFrame]:
        """All stages' lazy results; start skips stages before it (their results must be among the inputs), end stops after one."""
        order = self.check({k: v.schema for k, v in inputs.items()})
        frames = dict(inputs)
        begun = start is None
        for i in order:
            begun = begun or i == start
            if not begun:
                if i not in frames:
                    raise ValueError(f"stage {i} is skipped, but there is no result of it")
                continue
            s = self.stages[i]
            op = self.registry[s.op]
            out = op.run(*[frames[n] for n in s.needs], **check_params(op, s.params))
            gone = set(op.columns_out) - set(out.columns)
            if gone:
                raise ValueError(f"stage {i}: {s.op} gave no column {sorted(gone)[0]}")
            frames[i] = out
            if i == end:
                break
        return frames


def stamp(df: DataFrame, schema_version: str, module_id: str, run_id: str, created_at: str) -> DataFrame:
    """Fill the envelope columns where they are missing or null; values that are there stay."""
    for name, value in (("schema_version", schema_version), ("module_id", module_id), ("run_id", run_id), ("created_at", created_at)):
        df = df.withColumn(name, F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value))
    return df


def snapshot(recipe: "Recipe", run_id: str, inputs: dict[str, str]) -> dict[str, Any]:
    """What a run is made of, as plain data: its stages in order with all parameters (defaults filled in), the operators that they use with columns and parameters, and the inputs' paths."""
    stages = recipe.stages
    order = recipe.order(set(inputs))
    used = {stages[i].op: recipe.registry[stages[i].op] for i in order}
    filled = lambda s: {k: s.params.get(k, p.default) for k, p in used[s.op].params.items()}
    return {
        "run_id": run_id, "inputs": dict(sorted(inputs.items())),
        "stages": [{"id": i, "op": stages[i].op, "needs": list(stages[i].needs), "params": filled(stages[i])} for i in order],
        "operators": {n: {"columns_in": [list(c) for c in o.columns_in], "columns_out": list(o.columns_out), "params": sorted(o.params)} for n, o in sorted(used.items())},
    }
