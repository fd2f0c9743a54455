"""Contracts: which columns a source has and what their cells may hold."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from rowloom import fixed_values as fv
from rowloom.functions.slug import slugify


@dataclass(frozen=True)
class Rule:
    name: str
    type: str = "string"
    required: bool = False
    formats: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Contract:
    entity: str
    rules: tuple[Rule, ...]
    unique_keys: tuple[str, ...] = ()

    @property
    def required(self) -> list[Rule]:
        return [r for r in self.rules if r.required]

    def known_columns(self) -> set[str]:
        return {r.name for r in self.rules} | {slugify(r.name) for r in self.rules}


CONTRACTS = {
    entity: Contract(entity, tuple(Rule(*spec) for spec in specs), fv.UNIQUE_KEYS[entity])
    for entity, specs in fv.CONTRACTS.items()
}


def contract_for(table: str, contracts: dict[str, Contract] | None = None) -> Contract:
    """The contract of a table name: without schema, `_cur` and `_hst`."""
    base = table.split(".")[-1].replace("_cur", "").replace("_hst", "")
    entity = fv.CONTRACT_ALIASES.get(base, base).lower()
    known = CONTRACTS if contracts is None else contracts
    if entity not in known:
        raise FileNotFoundError(f"no contract for {table!r} (looked for {entity!r})")
    return known[entity]


def contract_projection(
    columns: Sequence[str],
    contract: Contract | None,
    mapping: dict[str, str] | None = None,
    pk: str | None = None,
) -> list[str]:
    """Columns to keep: those of the contract or mapped to, and the key; all if none is left.

    The key goes last when only its role as key keeps it.
    """
    if contract is None:
        return list(columns)
    known = contract.known_columns() | set((mapping or {}).values())
    kept = [c for c in columns if c in known]
    if pk in columns and pk not in kept:
        kept.append(pk)
    return kept or list(columns)
