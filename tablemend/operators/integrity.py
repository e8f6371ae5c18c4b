"""Foreign keys: find rows that refer to nothing, and act on them by policy.

A foreign key is *broken* when it is set (not NULL, and not 0 for numbers) and
its value is not a key of the target table. CASCADE drops the row, SET_NULL
clears the column, any other policy keeps the row. Every key is checked against
the rows as given, and every broken key of a row goes to the quarantine, whatever
its policy and whatever other keys do to the row.

Two ways to the same result:

* **one pass**: the table is joined to the distinct keys of each target. With
  targets small enough to broadcast nothing of the table is shuffled.
* **two passes** (``work_dir`` given): the distinct values of all foreign keys,
  with their row counts, are checked first and the broken ones written out.
  One scan of the key columns makes one table of (key, value) pairs, folded
  before the shuffle and joined once to the keys of all targets. The table is
  then checked against the broken values, whose true size Spark now knows: a
  short list is broadcast and the wide rows are not shuffled at all, whatever
  the size of the targets; a long one is joined by shuffle.

Tables that refer to each other in a cycle are cleaned together, until no more
rows fall (:func:`sweep`). Each round there moves what the last one brought down.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import replace
from functools import cached_property, reduce
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructField, StructType

from tablemend.contract import CASCADE, SET_NULL, Catalog, ContractError, ForeignKey, TableSpec
from tablemend.functions.text import named, quoted
from tablemend.operators.keys import (
    check_types,
    coded,
    decoded,
    fk_value,
    is_set,
    mark,
    with_key_in,
    with_key_not_in,
)
from tablemend.sources.files import write_table, write_tables


#: A sweep of tables in a cycle lets Spark broadcast a list of up to this many rows, once more in every round that has
#: one; a longer list is joined by shuffle, so that what the rounds send to the driver does not add up to the whole table.
BROADCAST_ROWS = 100_000


class Target:
    """A table that foreign keys point at, and its key column.

    ``unique`` says that the key hardly repeats, as a primary key should; it
    saves an exchange and never changes a result.
    """

    def __init__(self, rows: DataFrame, key: str, unique: bool = False):
        self.rows = rows
        self.key = key
        self.unique = unique


def orphans(df: DataFrame, fk_column: str, target: Target) -> DataFrame:
    """Rows whose foreign key is set and refers to nothing."""
    candidates = df.where(is_set(df.schema, fk_column))
    return with_key_not_in(candidates, [fk_column], target.rows, [target.key], (), distinct=not target.unique)


def broken_keys(df: DataFrame, fk_column: str, target: Target) -> DataFrame:
    """Broken values of one foreign key with the number of rows that hold them: ``(<fk_column>, rows)``.

    Rows are counted before the shuffle, so this moves distinct values only.
    """
    counted = df.where(is_set(df.schema, fk_column)).groupBy(named(fk_column)).agg(F.count(F.lit(1)).alias("rows"))
    return with_key_not_in(counted, [fk_column], target.rows, [target.key], (), distinct=not target.unique)


def all_broken_keys(df: DataFrame, keys: Sequence[ForeignKey], targets: Mapping[str, Target]) -> DataFrame:
    """Broken values of several foreign keys of a table, from one scan of it: ``(fk, whole, text, rows)``.

    ``fk`` is the key's place in ``keys``; whole number and text stand for the
    value, see :func:`tablemend.operators.keys.coded`. The values of all keys are
    counted together and looked up together among the tagged keys of all targets.
    """
    melted, known = [], []
    for i, fk in enumerate(keys):
        target = targets[fk.target]
        my_type, key_type = df.schema[fk.column].dataType, target.rows.schema[target.key].dataType
        check_types(my_type, key_type)
        whole, text = coded(quoted(fk.column), my_type)
        melted.append(
            f"named_struct('fk', {i}, 'target', {list(targets).index(fk.target)}, "
            f"'whole', {whole}, 'text', {text}, 'filled', {is_set(df.schema, fk.column)})"
        )
    for i, (name, target) in enumerate(targets.items()):
        if any(fk.target == name for fk in keys):
            whole, text = coded(quoted(target.key), target.rows.schema[target.key].dataType)
            known.append(
                target.rows.where(f"{quoted(target.key)} IS NOT NULL").selectExpr(
                    f"{i} AS target", f"{whole} AS whole", f"{text} AS text"
                )
            )
    values = df.selectExpr(f"inline(array({', '.join(melted)}))").where("filled")
    counted = values.groupBy("fk", "target", "whole", "text").agg(F.count(F.lit(1)).alias("rows"))
    value = ["target", "whole", "text"]
    unique = all(targets[fk.target].unique for fk in keys)
    broken = with_key_not_in(counted, value, reduce(DataFrame.unionByName, known), value, (), distinct=not unique)
    return broken.select("fk", "whole", "text", "rows")


def rows_with_keys(df: DataFrame, column: str, keys: DataFrame, key_column: str) -> DataFrame:
    """The rows of a table whose key is in a key set (used to back up rows before they are dropped)."""
    return with_key_in(df, [column], keys, [key_column])


def _flag(fk: ForeignKey) -> str:
    return f"__broken_{fk.column}"


def _any(keys: Sequence[ForeignKey]) -> str:
    return " OR ".join(quoted(_flag(fk)) for fk in keys) or "false"


class Checked:
    """One table against its targets: ``clean`` rows and the ``quarantine``, each built when first used.

    With ``path`` the table is written there once, with a flag per key, and both
    are read from it.
    """

    def __init__(
        self,
        df: DataFrame,
        spec: TableSpec,
        targets: Mapping[str, Target],
        zero_as_null: bool = False,
        broken: DataFrame | None = None,
        path: str | None = None,
    ):
        self._df = df
        self._spec = spec
        self._targets = targets
        self._zero_as_null = zero_as_null
        self._broken = broken
        self._path = path
        self._keys = [fk for fk in spec.foreign_keys if fk.target in targets]

    @cached_property
    def _written(self) -> DataFrame:
        marked = self._mark(self._keys)
        write_table(marked, self._path)
        return marked.sparkSession.read.schema(marked.schema).parquet(self._path)

    def _marked(self, keys: Sequence[ForeignKey]) -> DataFrame:
        """The table with a flag per foreign key that tells whether it is broken."""
        return self._written if self._path else self._mark(keys)

    def _mark(self, keys: Sequence[ForeignKey]) -> DataFrame:
        df = self._df
        schema, spread_by = df.schema, self._spec.primary_key or None
        for fk in keys:
            value = fk_value(schema, fk.column)
            if self._broken is None:
                target = self._targets[fk.target]
                df = mark(df, fk.column, value, target.rows, target.key, _flag(fk), spread_by, missing=True)
            else:
                values = self._broken.where(F.col("fk") == self._keys.index(fk)).selectExpr(
                    f"{decoded('whole', 'text', schema[fk.column].dataType)} AS value"
                )
                df = mark(df, fk.column, value, values, "value", _flag(fk), spread_by)
        return df

    @cached_property
    def clean(self) -> DataFrame:
        # A policy that changes nothing needs no look at the target.
        acting = [fk for fk in self._keys if fk.on_delete in (CASCADE, SET_NULL)]
        cascading = [fk for fk in acting if fk.on_delete == CASCADE]
        marked = self._marked(acting)
        if cascading:
            marked = marked.where(f"NOT ({_any(cascading)})")
        schema = self._df.schema
        values = {}
        for fk in self._keys:
            value = quoted(fk.column)
            if self._zero_as_null and isinstance(schema[fk.column].dataType, NumericType):
                value = f"nullif({value}, 0)"
            if fk.on_delete == SET_NULL:
                value = f"CASE WHEN NOT {quoted(_flag(fk))} THEN {value} END"
            if value != quoted(fk.column):
                values[fk.column] = F.expr(value).alias(fk.column, metadata=schema[fk.column].metadata)
        return (marked.withColumns(values) if values else marked).drop(*map(_flag, self._keys))

    @cached_property
    def quarantine(self) -> DataFrame:
        if not self._keys:
            labels = [F.lit("").alias(c) for c in ("_table", "_fk", "_target", "_policy")]
            return self._df.where("false").select("*", *labels)
        faults = [
            F.when(
                named(_flag(fk)),
                F.struct(
                    F.lit(fk.column).alias("_fk"), F.lit(fk.target).alias("_target"), F.lit(fk.on_delete).alias("_policy")
                ),
            )
            for fk in self._keys
        ]
        return (
            self._marked(self._keys)
            .where(_any(self._keys))
            .select("*", F.lit(self._spec.name).alias("_table"), F.explode(F.array_compact(F.array(*faults))).alias("__fault"))
            .select("*", "__fault.*")
            .drop("__fault", *map(_flag, self._keys))
        )

    def fault_counts(self) -> DataFrame | None:
        """Broken rows per foreign key, ``(_table, _fk, rows)``, from the key columns alone; None without keys."""
        if not self._keys:
            return None
        broken = self._broken if self._broken is not None else all_broken_keys(self._df, self._keys, self._targets)
        names = F.element_at(F.array([F.lit(fk.column) for fk in self._keys]), F.col("fk") + 1)
        return (
            broken.groupBy("fk")
            .agg(F.sum("rows").alias("rows"))
            .select(F.lit(self._spec.name).alias("_table"), names.alias("_fk"), "rows")
        )


def enforce(
    df: DataFrame,
    spec: TableSpec,
    targets: Mapping[str, Target],
    zero_as_null: bool = False,
    work_dir: str | None = None,
    write_once: bool = False,
) -> Checked:
    """Enforce all foreign keys of one table whose target is at hand.

    ``zero_as_null`` also clears keys that hold 0 for "not set". ``work_dir``
    (a shared folder) selects the two-pass way, whose first pass runs now. With
    ``write_once`` the checked table is written there as well, so that clean
    rows and quarantine come of one look at it. Every call writes to a folder
    of its own below ``work_dir``; what it returns reads from there.
    """
    if work_dir is None:
        if write_once:
            raise ValueError("write_once needs a work_dir")
        return Checked(df, spec, targets, zero_as_null)
    run = f"{work_dir.rstrip('/')}/run-{uuid4().hex}/{spec.name}"
    broken = _written_broken_keys(df, spec, targets, f"{run}/broken")
    return Checked(df, spec, targets, zero_as_null, broken, f"{run}/checked" if write_once else None)


def _written(df: DataFrame, path: str) -> DataFrame:
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _written_broken_keys(df: DataFrame, spec: TableSpec, targets: Mapping[str, Target], path: str) -> DataFrame | None:
    keys = [fk for fk in spec.foreign_keys if fk.target in targets]
    return _written(all_broken_keys(df, keys, targets), path) if keys else None


class Quarantine(Mapping[str, DataFrame]):
    """Broken rows by table; each table's rows are planned when first asked for."""

    def __init__(self, checked: Mapping[str, Checked]):
        self._checked = checked

    def __getitem__(self, name: str) -> DataFrame:
        return self._checked[name].quarantine

    def __iter__(self) -> Iterator[str]:
        return iter(self._checked)

    def __len__(self) -> int:
        return len(self._checked)

    def counts(self) -> list[DataFrame]:
        return [c for c in (checked.fault_counts() for checked in self._checked.values()) if c is not None]


def sweep(
    catalog: Catalog,
    tables: Mapping[str, DataFrame],
    transitive: bool = False,
    zero_as_null: bool = False,
    work_dir: str | None = None,
    write_once: bool = False,
) -> tuple[dict[str, DataFrame], Quarantine]:
    """Enforce the foreign keys of every table; returns clean tables and quarantines by table.

    Targets are the tables as given, so a dropped row does not orphan the rows
    that refer to it. With ``transitive`` targets are cleaned first and it
    does. Tables that refer to each other in a cycle by cascades, or one that
    refers to itself, are then cleaned until nothing more is dropped, which
    takes a ``work_dir``. Keys whose target is not among the tables are skipped.
    """
    clean = dict(tables)
    checked: dict[str, Checked] = {}
    for group in catalog.load_groups(tables) if transitive else [[name] for name in tables]:
        source = dict(clean if transitive else tables)
        targets = {
            name: {
                fk.target: Target(source[fk.target], catalog[fk.target].key_column, unique=True)
                for fk in catalog[name].foreign_keys
                if fk.target in source
            }
            for name in group
        }
        if transitive:
            left = _left_of_group(catalog, group, tables, targets, work_dir)
            for name in group:
                targets[name] |= {target: left[target] for target in targets[name] if target in left}
        for name in group:
            if targets[name]:
                checked[name] = enforce(tables[name], catalog[name], targets[name], zero_as_null, work_dir, write_once)
                clean[name] = checked[name].clean
    return clean, Quarantine(checked)


def _left_of_group(
    catalog: Catalog,
    group: Sequence[str],
    tables: Mapping[str, DataFrame],
    targets: Mapping[str, Mapping[str, Target]],
    work_dir: str | None,
) -> dict[str, Target]:
    """What is left of the tables that refer to each other when every cascade has run its course.

    First the rows go whose cascading key is broken as the tables were given.
    Then the keys that fell are looked up among the references, the rows that
    hold one fall, and with them the keys that no row is left of; until a round
    brings down none. A round reads the key columns of what the first step left
    and moves the keys that just fell and the rows of the keys they hit. All that
    fell before is read too, but only what those rows refer to is joined to them.
    Every list is written and counted before it is joined, see ``BROADCAST_ROWS``.
    """
    specs = {name: catalog[name] for name in group}
    cascades = {
        name: [fk for fk in spec.foreign_keys if fk.on_delete == CASCADE and fk.target in tables]
        for name, spec in specs.items()
    }
    inside = {name: [fk for fk in cascades[name] if fk.target in group] for name in group}
    referred = {fk.target for spec in specs.values() for fk in spec.foreign_keys if fk.target in group}
    if not referred or not any(cascades.values()):
        return {}
    falls = {n: enforce(tables[n], _only(spec, cascades[n]), targets[n], work_dir=work_dir) for n, spec in specs.items()}
    if not any(inside.values()):
        return {name: Target(falls[name].clean, specs[name].key_column, unique=True) for name in referred}
    if work_dir is None:
        raise ContractError(f"{' and '.join(group)} refer to themselves: a transitive sweep of them needs a work_dir")

    root = f"{work_dir.rstrip('/')}/run-{uuid4().hex}"
    session = next(iter(tables.values())).sparkSession

    def written(frames: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
        write_tables(frames, f"{root}/{folder}")
        return {n: session.read.schema(f.schema).parquet(f"{root}/{folder}/{n}") for n, f in frames.items()}

    rows = written(
        {
            name: falls[name].clean.selectExpr(
                f"{quoted(spec.key_column)} AS key",
                *[f"{fk_value(tables[name].schema, fk.column)} AS ref_{i}" for i, fk in enumerate(inside[name])],
            ).distinct()
            for name, spec in specs.items()
        },
        "rows",
    )
    given = {
        name: tables[name].selectExpr(f"{quoted(spec.key_column)} AS key").where("key IS NOT NULL").distinct()
        for name, spec in specs.items()
    }
    first = {n: with_key_not_in(given[n], ["key"], _listed(rows[n], rows[n].count()), ["key"], (), distinct=False) for n in group}
    fallen = [written(first, "fallen-0")]
    lost = dict.fromkeys(group, 0)
    while True:
        new = {name: count for name, keys in fallen[-1].items() if (count := keys.count())}
        if not new:
            break
        lost = {n: lost[n] + new.get(n, 0) for n in group}
        paths = {n: [f"{root}/fallen-{i}/{n}" for i, step in enumerate(fallen) if n in step] for n in group}
        gone = {n: session.read.schema(rows[n].select("key").schema).parquet(*paths[n]) for n in group if paths[n]}
        last = {n: _listed(fallen[-1][n], count) for n, count in new.items()}
        hits = {}
        for name in group:
            hit = [
                with_key_in(rows[name], [f"ref_{i}"], last[fk.target], ["key"]).select("key")
                for i, fk in enumerate(inside[name])
                if fk.target in new
            ]
            if hit:
                hits[name] = reduce(DataFrame.unionByName, hit).distinct()
        if not hits:
            break
        hits = written(hits, f"hit-{len(fallen)}")
        held = {n: with_key_in(rows[n], ["key"], _listed(keys, keys.count()), ["key"]) for n, keys in hits.items()}
        held = written(held, f"held-{len(fallen)}")
        found = {n: _fallen(held[n], held[n].count(), inside[n], gone, gone.get(n)) for n in held}
        fallen.append(written(found, f"fallen-{len(fallen)}"))
    paths = {n: [f"{root}/fallen-{i}/{n}" for i, step in enumerate(fallen) if n in step] for n in group}
    gone = {n: _listed(session.read.schema(rows[n].select("key").schema).parquet(*paths[n]), lost[n]) for n in group}
    left = {n: with_key_not_in(rows[n].select("key").distinct(), ["key"], gone[n], ["key"], ()) for n in group}
    return {n: Target(keys, "key", unique=True) for n, keys in written(left, "left").items()}


def _only(spec: TableSpec, keys: Sequence[ForeignKey]) -> TableSpec:
    """The contract without its other foreign keys."""
    fields = [
        f if "references" not in f.metadata or any(f.name == fk.column for fk in keys) else StructField(f.name, f.dataType, f.nullable)
        for f in spec.schema
    ]
    return replace(spec, schema=StructType(fields))


def _listed(keys: DataFrame, rows: int) -> DataFrame:
    """Keys to join to: Spark may broadcast them only if they are few."""
    return keys if rows <= BROADCAST_ROWS else keys.hint("merge")


def _fallen(
    held: DataFrame, count: int, refs: Sequence[ForeignKey], gone: Mapping[str, DataFrame], before: DataFrame | None
) -> DataFrame:
    """Of the keys that were hit, those that no row is left of and that had not fallen before.

    ``held`` is all rows of those keys, ``count`` their number. What fell is
    narrowed to what they hold first: no list that is joined here is longer than they are.
    """

    def of_these(keys: DataFrame, column: str) -> DataFrame:
        return _listed(with_key_in(keys, ["key"], _listed(held, count), [column]), count)

    standing = held
    for i, fk in enumerate(refs):
        if fk.target in gone:
            standing = with_key_not_in(standing, [f"ref_{i}"], of_these(gone[fk.target], f"ref_{i}"), ["key"], distinct=False)
    new = with_key_not_in(held.select("key").distinct(), ["key"], _listed(standing, count), ["key"], ())
    return new if before is None else with_key_not_in(new, ["key"], of_these(before, "key"), ["key"], (), distinct=False)


def orphan_counts(quarantine: Mapping[str, DataFrame]) -> DataFrame | None:
    """Broken rows per table and foreign key: ``(_table, _fk, rows)``; None when no table has keys.

    A quarantine as ``sweep`` returns it is not built for that: the values of each key are counted and looked up.
    """
    if isinstance(quarantine, Quarantine):
        counts = quarantine.counts()
    else:
        counts = [q.groupBy("_table", "_fk").agg(F.count(F.lit(1)).alias("rows")) for q in quarantine.values()]
    return reduce(DataFrame.unionByName, counts) if counts else None
