"""Header resolution and key detection for one feed layout.

A layout is the ordered list of a feed's column names. Everything here is
metadata on the driver: it turns the header list into a ``LayoutPlan`` that
the enrich operator compiles into one static Catalyst plan. The distributed
twin for many layouts at once lives in :mod:`keystitch.plans.layouts`.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from ..functions.exprs import normalize_header_py
from ..spec import EnrichSpec


class NoKeyColumns(ValueError):
    """No key combination is fully present in a feed (R5): the feed fails."""


class MissingReferenceColumns(ValueError):
    """The reference lacks a key, target or tie-break column."""


def resolve_headers(columns: Sequence[str], aliases: Sequence[tuple[str, str]]) -> dict[str, str]:
    """Feed column -> canonical name.

    Aliases are tried in order; an exact header match wins, otherwise the first
    feed column whose ``lower().strip()`` equals the alias's. A feed column hit
    twice keeps its first position and takes the last canonical name (plain
    dict assignment)."""
    columns = list(columns)
    normalized = [normalize_header_py(c) for c in columns]
    mapping: dict[str, str] = {}
    for header, canonical in aliases:
        if header in columns:
            mapping[header] = canonical
            continue
        key = normalize_header_py(header)
        for col, norm in zip(columns, normalized):
            if norm == key:
                mapping[col] = canonical
                break
    return mapping


def canonical_columns(columns: Sequence[str], mapping: dict[str, str]) -> list[str]:
    """Column names after renaming mapped headers to canonical names."""
    return [mapping.get(c, c) for c in columns]


def detect_keys(columns: Sequence[str], mapping: dict[str, str],
                combinations: Sequence[Sequence[str]]) -> tuple[str, ...]:
    """First combination whose columns are all present after renaming (R5, exact case)."""
    present = set(canonical_columns(columns, mapping))
    for combo in combinations:
        if all(k in present for k in combo):
            return tuple(combo)
    raise NoKeyColumns(f"no key combination of {list(map(list, combinations))} in columns {list(columns)}")


def key_sources(keys: Sequence[str], mapping: dict[str, str], coalesce: bool = False) -> list[list[str]]:
    """For each key, the feed columns it is read from.

    Default (reference behaviour): a single column — the first mapped alias in
    mapping order, else the column literally named like the key. With
    ``coalesce`` all mapped aliases in order (the first non-empty cell wins)."""
    out = []
    for k in keys:
        aliases = [feed_col for feed_col, canon in mapping.items() if canon == k]
        if not aliases:
            out.append([k])
        elif coalesce:
            out.append(aliases)
        else:
            out.append(aliases[:1])
    return out


def missing_targets(columns: Sequence[str], targets: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """Targets whose reference name is not a feed header, in fixed order."""
    present = set(columns)
    return [(col, disp) for col, disp in targets if col not in present]


def output_names(columns: Sequence[str], missing: Sequence[tuple[str, str]], suffix: str = "__ref") -> list[str]:
    """Display names of appended columns (C7). A display name that already is a
    feed header (or an earlier appended name) gets ``suffix`` — deliberate
    deviation R16: Spark refuses duplicate column names."""
    taken = set(columns)
    names = []
    for _, disp in missing:
        name = disp
        while name in taken:
            name = name + suffix
        taken.add(name)
        names.append(name)
    return names


@dataclass(frozen=True)
class LayoutPlan:
    columns: tuple[str, ...]
    mapping: tuple[tuple[str, str], ...]
    keys: tuple[str, ...]
    sources: tuple[tuple[str, ...], ...]
    missing: tuple[tuple[str, str], ...]
    appended: tuple[str, ...]

    @property
    def passthrough(self) -> bool:
        return not self.missing


def plan_layout(columns: Sequence[str], spec: EnrichSpec) -> LayoutPlan:
    """All metadata decisions for one layout; raises :class:`NoKeyColumns`."""
    columns = list(columns)
    mapping = resolve_headers(columns, spec.aliases)
    keys = detect_keys(columns, mapping, spec.key_combinations)
    sources = key_sources(keys, mapping, spec.coalesce_aliases)
    missing = missing_targets(columns, spec.targets)
    return LayoutPlan(
        columns=tuple(columns),
        mapping=tuple(mapping.items()),
        keys=keys,
        sources=tuple(tuple(s) for s in sources),
        missing=tuple(missing),
        appended=tuple(output_names(columns, missing)),
    )


def check_reference(reference_columns: Sequence[str], keys: Sequence[str],
                    targets: Sequence[str], order_by: Sequence[str]) -> None:
    """Stricter than the reference's non-empty schema check (A11): every key,
    missing target and tie-break column must exist."""
    have = set(reference_columns)
    need = list(keys) + list(targets) + [o.lstrip("-") for o in order_by]
    absent = [n for n in need if n not in have]
    if not reference_columns:
        raise MissingReferenceColumns("reference has no columns")
    if absent:
        raise MissingReferenceColumns(f"reference lacks columns {absent}")
