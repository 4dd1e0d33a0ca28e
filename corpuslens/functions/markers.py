"""Marker strings that generated source files carry."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MARKERS = {
    "django": [
        "enerated by Django",
    ],
    "protobuf": [
        "enerated by the protocol buffer",
        "enerated protocol buffer code",
    ],
    "microsoft": [
        "# Code generated by Microsoft",
    ],
    "generic": [
        "his file was automatically generated",
        "enerated by: https://github.com/swagger",
        "utogenerated by xml_generate script",
        "file was generated by",
        "# Automatically generated by",
        "// This file was autogenerated by",
        "// Generated by",
        "/* Generated by",
        "* This is an automatically generated file",
        "// Do not edit, all changes will be lost",
        "// This file is auto-generated",
        "// This code was generated by",
        "# This code was autogenerated by",
        "# Generated by the gRPC",
        "This file was generated by the TypeScript",
        "# This file was generated by Xcode",
        "// This file was generated using WSDL",
        "// This file was generated from a template",
        "# This file is generated by",
        "# Autogenerated by",
        "// Autogenerated by",
    ],
}


# All markers but a few hold this stem. Text without it needs one search for them, not one each.
STEM = "enerated"


def all_markers(groups: list[str] | None = None) -> list[str]:
    return [m for group in (groups or MARKERS) for m in MARKERS[group]]


def _any_of(text: Column, needles: list[str]) -> Column:
    hit = F.lit(False)
    for needle in needles:
        hit = hit | F.contains(text, F.lit(needle))
    return hit


def is_generated(text: Column, groups: list[str] | None = None) -> Column:
    """True where the text holds any marker of the given groups (all by default)."""
    wanted = all_markers(groups)
    with_stem = [m for m in wanted if STEM in m]
    others = [m for m in wanted if STEM not in m]
    hit = (F.contains(text, F.lit(STEM)) & _any_of(text, with_stem)) | _any_of(text, others)
    return F.coalesce(hit, F.lit(False))


def matching_markers(text: Column) -> Column:
    """The markers found in the text, in the order of the fixed list."""
    others = [m for m in all_markers() if STEM not in m]
    found = [F.when(F.contains(text, F.lit(m)), F.lit(m)) for m in all_markers()]
    possible = F.contains(text, F.lit(STEM)) | _any_of(text, others)
    none = F.array().cast("array<string>")
    return F.when(possible, F.array_compact(F.array(*found))).otherwise(none)


def groups_of(found: Column) -> Column:
    """Names of the groups that the markers in an array belong to."""
    names = [
        F.when(F.arrays_overlap(found, F.array(*[F.lit(m) for m in listed])), F.lit(group))
        for group, listed in MARKERS.items()
    ]
    return F.array_compact(F.array(*names))


def matching_groups(text: Column) -> Column:
    """Names of the groups with at least one marker in the text."""
    return groups_of(matching_markers(text))
