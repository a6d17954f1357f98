"""Independent DuckDB statements for the registered queries.

Each statement is composed from named parts; only the parts it needs are put
into its WITH clause.  The parts are written for DuckDB (as-of joins, row
numbers, brute-force range joins) and share no text with the Spark plans.
"""

from __future__ import annotations

import re

from duck_oracle import facts, models, proofs, queries, raw, releases, reports, summaries
from duck_oracle.common import AS_OF

PARTS: dict[str, str] = {
    **raw.PARTS, **summaries.PARTS, **facts.PARTS, **reports.PARTS, **models.PARTS,
}

_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _needs(sql: str) -> list[str]:
    return [w for w in dict.fromkeys(_WORD.findall(sql)) if w in PARTS]


def compose(sql: str) -> str:
    """Prefix a SELECT with the parts it refers to, in dependency order."""
    order: list[str] = []

    def visit(name: str, path: tuple[str, ...]) -> None:
        if name in path:
            raise ValueError(f"circular part: {name}")
        if name in order:
            return
        for other in _needs(PARTS[name]):
            if other != name:
                visit(other, path + (name,))
        order.append(name)

    for name in _needs(sql):
        visit(name, ())
    if not order:
        return sql
    body = ",\n".join(f"{n} as ({PARTS[n]})" for n in order)
    return f"with {body}\n{sql}"


def table(name: str) -> str:
    return compose(f"select * from {name}")


def at(day: str, sql: str) -> str:
    """The same statement for another reporting date."""
    return sql.replace(AS_OF, day)


def statements() -> dict[str, str]:
    from touchline.plans.warehouse import MODELS

    out = {name: table(name) for name in MODELS if name in PARTS}
    for name in ("fct_transfer_fixed_horizon_outcomes", "fct_transfer_cohort_performance"):
        out[name + "_midway"] = at(queries.MIDWAY, out[name])
    both = queries.SQL | proofs.SQL | releases.SQL | models.SQL
    out.update({name: compose(sql) for name, sql in both.items() if not sql.lstrip().startswith("with")})
    for name, sql in both.items():
        if sql.lstrip().startswith("with"):
            out[name] = compose(f"select * from ({sql.strip()})")
    out["refresh_audit"] = proofs.audits(compose, at)
    out["check_volumes"] = proofs.volumes(out["refresh_audit"])
    out["check_declared_rules"] = compose(proofs.declared_rules(out["refresh_audit"]))
    return out
