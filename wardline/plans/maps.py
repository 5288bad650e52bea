"""Maps grown along the concept tree before a run."""

from __future__ import annotations

from wardline.operators import expansion
from wardline.storage import materialize
from wardline.sources.maps import Maps
from wardline.sources.readers import Sources


def grow_maps(
    maps: Maps,
    sources: Sources,
    positive_path: str | None = None,
    labs: bool = False,
    medication_root: str | None = None,
) -> Maps:
    """The maps with the rows the concept tree adds; every part is optional.

    ``positive_path`` adds positive-test codes below a path, ``labs`` the concepts below
    mapped labs, ``medication_root`` the used concepts below mapped drugs within that
    root.  Grown maps are written, so their size is known to the planner.
    """
    concepts = sources.concepts
    code_map, lab_map, med_map = maps.code_map, maps.lab_map, maps.med_map
    if positive_path:
        found = expansion.codes_under_path(concepts, positive_path, code_map)
        code_map = materialize(code_map.unionByName(found), "code_map")
    if labs:
        found = expansion.expand_lab_map(lab_map, concepts)
        lab_map = materialize(lab_map.unionByName(found), "lab_map")
    if medication_root:
        found = expansion.expand_med_map(med_map, concepts, sources.facts, medication_root)
        med_map = materialize(med_map.unionByName(found), "med_map")
    return Maps(code_map, lab_map, med_map)
