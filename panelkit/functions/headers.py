"""Header handling for raw sheet exports.

These are schema-level steps: they look at column *names* only (a list of
strings known at plan time), never at data, and produce a rename plan that is
applied as a single ``select``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from panelkit import schemas as S


def dedupe_names(names: Sequence[str]) -> list[str]:
    """Give repeated names ``.1``, ``.2`` ... suffixes, first one kept bare."""
    seen: dict[str, int] = {}
    used = set(names)
    out = []
    for n in names:
        k = seen.get(n, 0)
        if k == 0:
            out.append(n)
        else:
            cand = f"{n}.{k}"
            while cand in used:
                k += 1
                cand = f"{n}.{k}"
            used.add(cand)
            out.append(cand)
        seen[n] = k + 1
    return out


def _matches(name: str, keys: Sequence[str]) -> bool:
    return any(k in name for k in keys)


def _pick_total(cands: list[str]) -> str | None:
    """Rightmost candidate carrying a total marker, else the last one."""
    if not cands:
        return None
    for name in reversed(cands):
        if _matches(name, S.TOTAL_HEADER_MARKS):
            return name
    return cands[-1]


def header_map(names: Sequence[str]) -> dict[str, str]:
    """Source column -> target column, following the sheet header rules.

    Identity columns are matched per column in this order: utility id, utility
    name, state.  Revenue, sales and customers each take one column: the
    rightmost total, else the last match.  Matching is case-sensitive.  A
    source named by two rules keeps the later rule's target; two sources for
    one target is an error.
    """
    mapping: dict[str, str] = {}
    for n in names:
        if _matches(n, S.ID_HEADER_KEYS):
            mapping[n] = "Utility_ID"
        elif _matches(n, S.NAME_HEADER_KEYS):
            mapping[n] = "Utility_Name"
        elif _matches(n, S.STATE_HEADER_KEYS):
            mapping[n] = "State"
    for keys, target in ((S.REVENUE_HEADER_KEYS, "Revenue_Thousands"),
                         (S.SALES_HEADER_KEYS, "Sales_MWh"),
                         (S.CUSTOMER_HEADER_KEYS, "Customers")):
        src = _pick_total([n for n in names if _matches(n, keys)])
        if src is not None:
            mapping[src] = target
    targets = list(mapping.values())
    dup = {t for t in targets if targets.count(t) > 1}
    if dup:
        raise ValueError(f"several source columns map to {sorted(dup)}: {mapping}")
    return mapping


def apply_header_map(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Keep and rename the mapped columns (one projection)."""
    mapping = header_map(df.columns) if mapping is None else mapping
    if not mapping:
        raise ValueError(f"no header rule matches any of the sheet's columns: {df.columns}")
    return df.select([F.col(f"`{src}`").alias(dst) for src, dst in mapping.items()])
