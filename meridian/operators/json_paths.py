"""Flattening JSON records by a path mapping, over Spark's VARIANT type.

A mapping is a list of ``Target(column, path, type)``. It can be written out, or compiled from a path file
(``{"jsonpaths": ["$.a", "$.b.c", ...]}``, one path per target column, in the table's column order).
Paths are ``$``, ``.name``, ``['any name']`` and ``[index]`` steps. What no path names is not lost: such
attributes stay together in one variant column, under dotted names.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STEP = re.compile(r"""\.([A-Za-z_]\w*)|\['([^']*)'\]|\["([^"]*)"\]|\[(\d+)\]""")


class Target(NamedTuple):
    column: str
    path: str
    ddl: str = "string"


def parse_path(path: str) -> list[str | int]:
    """Steps of a path: names and list places. Raises on anything else."""
    if not path.startswith("$"):
        raise ValueError(f"a path starts with $: {path}")
    steps, at = [], 1
    while at < len(path):
        m = _STEP.match(path, at)
        if not m:
            raise ValueError(f"cannot read the path {path} from {path[at:]!r}")
        name = next((g for g in m.groups()[:3] if g is not None), None)
        steps.append(int(m[4]) if name is None else name)
        at = m.end()
    return steps


def compile_path(record: Column, path: str, ddl: str) -> Column:
    """The value at ``path`` as ``ddl``; NULL where the path leads nowhere or the value does not fit.

    Objects and lists become JSON text as ``string``.
    """
    text = "$"
    for step in parse_path(path):
        if isinstance(step, str) and "'" in step and '"' in step:
            raise ValueError(f"a name with both kinds of quotes: {step}")
        text += f"[{step}]" if isinstance(step, int) else (f'["{step}"]' if "'" in step else f"['{step}']")
    return F.try_variant_get(record, text, ddl)


def targets_from_file(text: str, table: T.StructType) -> list[Target]:
    """Targets of a path file for the columns of ``table``, by position."""
    paths = json.loads(text)["jsonpaths"]
    if len(paths) != len(table.fields):
        raise ValueError(f"{len(paths)} paths for {len(table.fields)} columns")
    out = [Target(f.name, p, f.dataType.simpleString()) for f, p in zip(table.fields, paths)]
    for t in out:
        parse_path(t.path)
    return out


def _leftover(record: Column, targets: Sequence[Target]) -> Column:
    """Attributes that no path names or passes through, as one variant object; NULL if there are none."""
    known: dict[tuple[str, ...], set[str]] = {(): set()}
    whole = {tuple(parse_path(t.path)) for t in targets}
    for steps in (parse_path(t.path) for t in targets):
        for i, step in enumerate(steps):
            if isinstance(step, int):
                break                                        # lists are taken whole
            known.setdefault(tuple(steps[:i]), set()).add(step)
    maps = []
    for prefix, names in sorted(known.items()):
        if any(tuple(prefix[:i]) in whole for i in range(1, len(prefix) + 1)):
            continue                                         # the object itself is a column
        path = "$" + "".join(f"['{s}']" for s in prefix)
        dotted = ".".join([*prefix, ""])
        some = F.map_filter(F.try_variant_get(record, path, "map<string,variant>"), lambda k, v: ~k.isin(*names))
        some = F.transform_keys(some, lambda k, v: F.concat(F.lit(dotted), k))
        maps.append(F.coalesce(some, F.create_map().cast("map<string,variant>")))
    rest = F.map_concat(*maps) if len(maps) > 1 else maps[0]
    return F.when(F.size(rest) > 0, F.to_variant_object(rest))


def flatten_json(lines: DataFrame, targets: Sequence[Target], *, rest: str | None = "unmapped") -> DataFrame:
    """One row per line's ``record`` (a variant): a column per target, and ``rest`` for what no path names.

    A narrow plan: each line was parsed once, and every column reads the same binary value. The leftover
    map of ``rest`` needs distinct dotted names (an attribute ``a.b`` beside an object ``a`` with an unknown ``b``
    raises Spark's duplicate-key error).
    """
    record = F.col("record")
    cols = [compile_path(record, t.path, t.ddl).alias(t.column) for t in targets]
    return lines.select(*cols, *([_leftover(record, targets).alias(rest)] if rest else []))
