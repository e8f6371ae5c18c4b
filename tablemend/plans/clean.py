"""The whole cleaning job: normalise, deduplicate, enforce keys, reduce, join."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping
from dataclasses import dataclass, field
from typing import Literal

from pyspark.sql import DataFrame

from tablemend.contract import Catalog
from tablemend.operators.dedup import DedupRule, deduplicate_all
from tablemend.operators.enrich import Collisions, join_all
from tablemend.operators.hierarchy import reduce_to_deepest, reduce_to_deepest_of_all
from tablemend.operators.integrity import sweep
from tablemend.operators.normalize import normalize_all
from tablemend.plans.stages import STAGES, StageStore

# REDUCE runs only when it is asked for.
DEFAULT_STAGES = ("NORMALIZE", "DEDUP", "INTEGRITY", "JOIN")


@dataclass(frozen=True)
class ReduceRule:
    """Which table links items to the nodes of which tree.

    ``levels`` "one" looks at direct parents only; "all" at every node above,
    which takes a ``work_dir``; "closed" says that the tree lists those itself,
    as a table of paths does.
    """

    tree: str
    item: str
    node: str
    tree_node: str
    tree_parent: str
    levels: Literal["one", "all", "closed"] = "one"


@dataclass(frozen=True)
class Cleaned:
    tables: dict[str, DataFrame]
    quarantine: dict[str, DataFrame] = field(default_factory=dict)


def clean(
    catalog: Catalog,
    tables: Mapping[str, DataFrame] | None = None,
    *,
    names: Iterable[str] | None = None,
    stages: Collection[str] = DEFAULT_STAGES,
    dedup_rules: Mapping[str, DedupRule] | None = None,
    reduce_rules: Mapping[str, ReduceRule] | None = None,
    collisions: Collisions = "first",
    transitive: bool = False,
    zero_as_null: bool = False,
    store: StageStore | None = None,
    keep: Collection[str] | None = None,
    work_dir: str | None = None,
) -> Cleaned:
    """Run the chosen stages, in their fixed order, over raw tables.

    Nothing runs until the result is used, unless a ``store`` is given: then
    the output of every stage in ``keep`` (by default all), and the
    quarantine, are written and read back. Without ``tables`` a run starts from the store, from the latest
    output kept before its first stage. ``work_dir`` selects the two-pass
    integrity check and writes every checked table once, so that clean rows and
    quarantine are not worked out apart.

    Tables are checked against the catalog before anything runs: for declared
    columns, and for their types where the first stage is not the one that
    makes them.
    """
    order = [s.name for s in STAGES]
    unknown = [s for s in stages if s not in order]
    if unknown:
        raise ValueError(f"unknown stages {unknown}; stages are {order}")
    active = [s for s in order if s in stages]
    if not active:
        raise ValueError("no stage to run")
    catalog.validate()

    if tables is None:
        if store is None:
            raise ValueError("give tables, or a store to start from")
        current = store.restore(active[0], catalog.subset(names))
    else:
        current = {n: tables[n] for n in catalog.subset(names if names is not None else tables)}

    for name, df in current.items():
        catalog[name].check(df.schema, types=active[0] not in ("EXTRACT", "NORMALIZE"))
    quarantine: dict[str, DataFrame] = {}
    for stage in active:
        if stage == "NORMALIZE":
            current = normalize_all(catalog, current)
        elif stage == "DEDUP":
            current = deduplicate_all(catalog, current, dedup_rules or {}, work_dir)
        elif stage == "INTEGRITY":
            current, quarantine = sweep(
                catalog, current, transitive, zero_as_null, work_dir, write_once=work_dir is not None
            )
            if store is not None:
                quarantine = store.save_quarantine(quarantine)
        elif stage == "REDUCE":
            current = _reduce_all(current, reduce_rules or {}, work_dir)
        elif stage == "JOIN":
            current = join_all(catalog, current, collisions)
        if store is not None and (keep is None or stage in keep):
            current = store.save(stage, current)
    return Cleaned(current, quarantine)


def _reduce_all(
    tables: Mapping[str, DataFrame], rules: Mapping[str, ReduceRule], work_dir: str | None
) -> dict[str, DataFrame]:
    out = dict(tables)
    for name, rule in rules.items():
        if name not in out:
            continue
        given = (out[name], tables[rule.tree], rule.item, rule.node, rule.tree_node, rule.tree_parent)
        if rule.levels == "one":
            out[name] = reduce_to_deepest(*given, work_dir)
        elif work_dir is None:
            raise ValueError(f"{name}: reducing links over all levels needs a work_dir")
        else:
            out[name] = reduce_to_deepest_of_all(*given, work_dir, closed=rule.levels == "closed")
    return out
