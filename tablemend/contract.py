"""Table contracts: what a table looks like, how it is cleaned, what it refers to.

A contract is plain data. ``StructField.metadata`` carries the per-column facts
(key, rule, reference, limits), ``TableSpec`` the per-table ones, and
``Catalog`` is an ordered set of tables. Operators read contracts on the driver
only; metadata is never read back from a DataFrame in the middle of a job,
because computed columns lose it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql.types import DataType, StructField, StructType

CASCADE = "CASCADE"
SET_NULL = "SET_NULL"
DO_NOTHING = "DO_NOTHING"


class ContractError(ValueError):
    """A contract is incomplete, or a DataFrame does not satisfy one."""


class UnknownTableError(KeyError):
    """A table was asked for that the catalog does not declare."""

    def __init__(self, table: str):
        super().__init__(table)
        self.table = table

    def __str__(self) -> str:
        return f"table {self.table!r} is not declared in the catalog"


def column(
    name: str,
    data_type: DataType,
    *,
    key: bool = False,
    nullable: bool = True,
    rule: str | None = None,
    args: Mapping[str, Any] | None = None,
    references: str | None = None,
    on_delete: str = DO_NOTHING,
    asset: bool = False,
    max_length: int | None = None,
    min_value: Any = None,
    max_value: Any = None,
    default: Any = None,
) -> StructField:
    """Declare one column.

    ``rule``/``args`` name a value rule, ``references``/``on_delete`` a foreign
    key and its policy, ``asset`` a column of file paths. The limits and the
    default are used by the quality operators only.
    """
    facts = {
        "primary_key": key or None,
        "rule": rule,
        "args": dict(args) if args else None,
        "references": references,
        "on_delete": on_delete if references else None,
        "asset": asset or None,
        "max_length": max_length,
        "min_value": min_value,
        "max_value": max_value,
        "default": default,
    }
    metadata = {k: v for k, v in facts.items() if v is not None}
    return StructField(name, data_type, nullable, metadata)


@dataclass(frozen=True)
class ForeignKey:
    column: str
    target: str
    on_delete: str = DO_NOTHING


@dataclass(frozen=True)
class JoinInto:
    """Fold a table into ``table`` by left join.

    ``on`` names the main table's column that holds this table's key; by
    default the two tables share the main table's key name.
    """

    table: str
    on: str | None = None


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: StructType
    target_name: str | None = None
    join_to: JoinInto | None = None
    row_filter: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def primary_key(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.schema if f.metadata.get("primary_key"))

    @property
    def key_column(self) -> str:
        """The single key column that foreign keys and look-ups refer to."""
        if len(self.primary_key) != 1:
            raise ContractError(f"{self.name}: a single-column primary key is needed, got {self.primary_key}")
        return self.primary_key[0]

    @property
    def foreign_keys(self) -> tuple[ForeignKey, ...]:
        return tuple(
            ForeignKey(f.name, f.metadata["references"], f.metadata.get("on_delete", DO_NOTHING))
            for f in self.schema
            if "references" in f.metadata
        )

    @property
    def asset_columns(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.schema if f.metadata.get("asset"))

    def without(self, *names: str) -> TableSpec:
        """Drop columns from the contract; names it does not have are ignored."""
        return replace(self, schema=StructType([f for f in self.schema if f.name not in names]))

    def folded_into(self, table: str, on: str | None = None) -> TableSpec:
        return replace(self, join_to=JoinInto(table, on))

    def validate(self) -> None:
        """Check the contract itself."""
        if not self.target_name:
            raise ContractError(f"{self.name}: no target name")
        duplicates = {n for n in self.columns if self.columns.count(n) > 1}
        if duplicates:
            raise ContractError(f"{self.name}: columns declared twice: {sorted(duplicates)}")

    def check(self, schema: StructType, types: bool = True) -> None:
        """Check a DataFrame schema against the contract: columns present and, if asked, typed as declared."""
        missing = [n for n in self.columns if n not in schema.names]
        if missing:
            raise ContractError(f"{self.name}: missing columns {missing}")
        if types:
            wrong = [
                f"{f.name} is {schema[f.name].dataType.simpleString()}, declared {f.dataType.simpleString()}"
                for f in self.schema
                if schema[f.name].dataType != f.dataType
            ]
            if wrong:
                raise ContractError(f"{self.name}: " + "; ".join(wrong))


def table(
    name: str,
    columns: Iterable[StructField],
    target: str | None = None,
    join_to: JoinInto | None = None,
    row_filter: str | None = None,
) -> TableSpec:
    return TableSpec(name, StructType(list(columns)), target, join_to, row_filter)


def _ways(start: str, catalog: Catalog, among: Iterable[str]) -> Iterator[list[str]]:
    """Shortest ways of references from a table to each of some others."""
    seen, queue = {start}, [[start]]
    for way in queue:
        for fk in catalog[way[-1]].foreign_keys:
            if fk.target in among and fk.target not in seen:
                seen.add(fk.target)
                queue.append([*way, fk.target])
                yield queue[-1]


class Catalog(Mapping[str, TableSpec]):
    """An ordered set of table contracts."""

    def __init__(self, specs: Iterable[TableSpec]):
        self._specs = {spec.name: spec for spec in specs}

    def __getitem__(self, name: str) -> TableSpec:
        if name not in self._specs:
            raise UnknownTableError(name)
        return self._specs[name]

    def __contains__(self, name: object) -> bool:
        return name in self._specs

    def __iter__(self) -> Iterator[str]:
        return iter(self._specs)

    def __len__(self) -> int:
        return len(self._specs)

    def with_specs(self, *specs: TableSpec) -> Catalog:
        """Replace or add contracts, keeping the order."""
        return Catalog({**self._specs, **{s.name: s for s in specs}}.values())

    def subset(self, names: Iterable[str] | None = None) -> list[str]:
        """The tables to work on: those named, or all of them, in catalog order."""
        if names is None:
            return list(self)
        wanted = {self[n].name for n in names}
        return [n for n in self if n in wanted]

    def join_map(self) -> dict[str, list[str]]:
        """Main table -> the tables folded into it."""
        mapping: dict[str, list[str]] = {}
        for spec in self.values():
            if spec.join_to:
                mapping.setdefault(spec.join_to.table, []).append(spec.name)
        return mapping

    def asset_map(self) -> dict[str, tuple[str, ...]]:
        """Table -> its columns of file paths, for the tables that have any."""
        return {s.name: s.asset_columns for s in self.values() if s.asset_columns}

    def target_names(self) -> dict[str, str]:
        return {s.name: s.target_name for s in self.values()}

    def load_order(self, names: Iterable[str] | None = None) -> list[str]:
        """Tables ordered so that every foreign key target comes before its referrers."""
        groups = self.load_groups(names)
        for group in groups:
            if len(group) > 1:
                raise ContractError("foreign keys form a cycle: " + " -> ".join([*self._cycle(group), group[0]]))
        return [group[0] for group in groups]

    def load_groups(self, names: Iterable[str] | None = None) -> list[list[str]]:
        """Tables in groups, every foreign key target in an earlier group than its referrers or in the same.

        A group of several tables is a strongly connected part of the contract:
        each of them refers, by way of the others, to itself. Tables of a group
        are in catalog order.
        """
        names = self.subset(names)
        refers = {n: [fk.target for fk in self[n].foreign_keys if fk.target in names] for n in names}
        found: dict[str, int] = {}
        lowest: dict[str, int] = {}
        open_path: list[str] = []
        groups: list[list[str]] = []

        def visit(name: str) -> None:
            found[name] = lowest[name] = len(found)
            open_path.append(name)
            for target in refers[name]:
                if target not in found:
                    visit(target)
                    lowest[name] = min(lowest[name], lowest[target])
                elif target in open_path:
                    lowest[name] = min(lowest[name], found[target])
            if lowest[name] == found[name]:
                at = open_path.index(name)
                groups.append([n for n in names if n in open_path[at:]])
                del open_path[at:]

        for name in names:
            if name not in found:
                visit(name)
        return groups

    def _cycle(self, group: list[str]) -> list[str]:
        """A way of references from the first table of a group through the group, back to where it starts."""
        ways = _ways(group[0], self, group)
        return next(way for way in ways if any(fk.target == group[0] for fk in self[way[-1]].foreign_keys))

    def validate(self) -> None:
        """Check every contract and every reference between them."""
        for spec in self.values():
            spec.validate()
            for fk in spec.foreign_keys:
                self[fk.target].key_column
            if spec.join_to:
                self[spec.join_to.table]
