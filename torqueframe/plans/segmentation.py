"""Visit merge and customer segmentation as lazy plans (entry 1 of the
original). ``visit_merge``: clean → fill → contract join by plate or chassis →
stack → sort. ``segmentation``: flags → contract join → abandonment → join back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import clean, joins, ordered, visits as V

EXCLUDED_ACCOUNTS = (4, 6)  # fixed values
SORT_KEYS = ["customer", "slr_document_account", "registration_number"]


def contracts_clean(contracts: DataFrame) -> DataFrame:
    """Removal date overrides the end date (C6); only the contract columns stay."""
    return joins.coalesce_update(contracts, "cm_date_end", "cm_date_removal")


def visit_branch(visits: DataFrame, order: str, ranges: int = 64) -> DataFrame:
    """One extract cleaned and filled: plates without dashes, chassis of seven
    characters (H1, H2), accounts 4 and 6 left out (B6), null plates dropped and
    odd ones flagged (B8), customer and registration date filled within a plate
    in the order of ``order`` (E1)."""
    v = clean.exclude_values(clean.normalise_keys(visits), "slr_document_account", EXCLUDED_ACCOUNTS)
    v = clean.registration_flag(v)
    return ordered.fill_routed(v, ["registration_number"], [order], ["customer", "registration_date_pse"], order,
                               ranges=ranges)


def visit_merge(plate_visits: DataFrame, chassis_visits: DataFrame, plate_contracts: DataFrame,
                chassis_contracts: DataFrame, order: str) -> DataFrame:
    """Both branches with their contracts (by plate, and by chassis), stacked
    by name, key columns first, and every row's ``position`` in the order of
    the keys (nulls last; ``order`` settles ties)."""
    a = joins.left_join_drop_collisions(visit_branch(plate_visits, order), contracts_clean(plate_contracts),
                                        ["registration_number"])
    b = joins.left_join_drop_collisions(visit_branch(chassis_visits, order), chassis_contracts, ["chassis_number"])
    both = clean.move_first(a.unionByName(b, allowMissingColumns=True), SORT_KEYS)
    return ordered.sorted_positions(both, [*[F.asc_nulls_last(c) for c in SORT_KEYS], F.asc(order)])


def segmentation(visits: DataFrame, contracts: DataFrame, years: DataFrame, as_of: str,
                 keys=("customer", "registration_number"), contract_key: str = "registration_number") -> DataFrame:
    """Per visit: warranty flags (pse, vhe), contract flag and the
    abandonment flag of its (customer, vehicle) group."""
    keys = list(keys)
    v = V.warranty_flags(visits, years)
    v = joins.left_join_drop_collisions(v, contracts_clean(contracts), [contract_key])
    v = V.contract_flag(v)
    ab = V.abandoned_per_group(visits, keys, as_of)
    return joins.join_back(v, ab, keys)
