"""All registered jobs, by survey operator ID."""

from __future__ import annotations

from functools import lru_cache

from fleetscope.plans.spec import Spec


@lru_cache(maxsize=1)
def all_specs() -> dict[str, Spec]:
    from fleetscope.plans import (catalog_inventory, catalog_mask_io, catalog_perf, catalog_rules,
                                  catalog_stream, catalog_validator)
    specs: dict[str, Spec] = {}
    for mod in (catalog_perf, catalog_inventory, catalog_rules, catalog_validator, catalog_mask_io, catalog_stream):
        specs.update(mod.SPECS)
    for name, spec in specs.items():
        spec.name = name
    return specs
