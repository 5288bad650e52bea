"""Growing mapping tables along a concept tree.

A concept lies under another when its path starts with the other's path, compared as
plain text: paths hold backslashes and underscores, which LIKE would read otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.operators.scope import lookup
from wardline.storage import fits_broadcast, materialize

SEPARATOR = "\\"


def codes_under_path(
    concepts: DataFrame, prefix: str, existing: DataFrame, code: str = "covidpos"
) -> DataFrame:
    """New code-map rows for the concepts under a path that ``existing`` does not have yet."""
    found = (
        concepts.filter(F.col("concept_path").startswith(prefix) & F.col("concept_cd").isNotNull())
        .select(F.lit(code).alias("code"), F.col("concept_cd").alias("local_code"))
        .distinct()
    )
    return found.join(existing, ["code", "local_code"], "left_anti")


def _ancestor_lengths(path: Column, odd_lengths: Column) -> Column:
    """Lengths of all prefixes of a path that can be a mapped path.

    Those are the prefixes that end in a separator, and, for mapped paths that end
    otherwise, the prefixes of their lengths.
    """
    places = F.sequence(F.lit(1), F.greatest(F.length(path), F.lit(1)))
    steps = F.filter(places, lambda at: F.substring(path, at, F.lit(1)) == SEPARATOR)
    return F.array_union(steps, F.array_intersect(places, odd_lengths))


def _descendants(mapped: DataFrame, concepts: DataFrame) -> DataFrame:
    """Mapped rows (with ``mapped_path``) joined to the codes of every concept below them.

    Each concept lists its own ancestors, which makes the prefix match an equi-join.
    """
    ends = F.substring("mapped_path", -1, 1)
    odd = mapped.filter(ends != SEPARATOR).select(F.collect_set(F.length("mapped_path"))).scalar()
    below = (
        concepts.filter(F.col("concept_cd").isNotNull() & (F.length("concept_path") > 0))
        .select(
            "concept_cd",
            "concept_path",
            F.explode(_ancestor_lengths(F.col("concept_path"), odd)).alias("length"),
        )
        .select("concept_cd", F.expr("substring(concept_path, 1, length)").alias("mapped_path"))
    )
    return lookup(below, mapped, "mapped_path", ["concept_cd"]).drop("mapped_path")


def _with_paths(rows: DataFrame, local: str, concepts: DataFrame) -> DataFrame:
    """Map rows with the paths of their local code.  Written: read twice, and of known size."""
    paths = concepts.select(
        F.col("concept_cd").alias(local), F.col("concept_path").alias("mapped_path")
    )
    found = lookup(paths, rows, local, ["mapped_path"]).drop(local).distinct()
    return materialize(found, "mapped_paths")


def expand_lab_map(lab_map: DataFrame, concepts: DataFrame) -> DataFrame:
    """New lab-map rows: concepts below a mapped lab inherit its scale, units and name."""
    mapped = _with_paths(lab_map, "local_lab_code", concepts)
    return (
        _descendants(mapped, concepts)
        .select(
            "loinc",
            F.col("concept_cd").alias("local_lab_code"),
            "scale_factor",
            "lab_units",
            "lab_name",
        )
        .distinct()
        .join(lab_map, ["loinc", "local_lab_code"], "left_anti")
    )


def used_concepts(facts: DataFrame, concepts: DataFrame) -> DataFrame:
    """The concepts that occur in the facts.

    Facts shrink to distinct codes on the map side; a small tree filters them before that.
    """
    codes = facts.select("concept_cd")
    wanted = concepts.select("concept_cd").distinct()
    if fits_broadcast(wanted):
        codes = codes.join(wanted, "concept_cd", "left_semi")
    return concepts.join(codes.distinct(), "concept_cd", "left_semi")


def expand_med_map(med_map: DataFrame, concepts: DataFrame, facts: DataFrame, root: str) -> DataFrame:
    """New med-map rows of type 'Expand' for used concepts under ``root`` below a mapped drug."""
    classes = med_map.select("med_class", "local_med_code")
    mapped = _with_paths(classes, "local_med_code", concepts)
    tree = used_concepts(facts, concepts.filter(F.col("concept_path").startswith(root)))
    return (
        _descendants(mapped, tree)
        .select(
            "med_class", F.lit("Expand").alias("code_type"), F.col("concept_cd").alias("local_med_code")
        )
        .distinct()
        .join(med_map, ["med_class", "local_med_code"], "left_anti")
        .select("med_class", "code_type", "local_med_code")
    )
