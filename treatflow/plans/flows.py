"""Flows made of the operators: each is a plan from source tables to target records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treatflow.fixed_values import (
    ACTIVITY_CONTRACT, ACTIVITY_LAYER_FIELDS, AGENCY_CONSTANTS, AGENCY_FIELD_MAPS, END_YEAR, GEOM_TYPE, KEYWORD_RULES,
    MERGED_FIELDS, MERGE_RENAMES, OLDER_FIELDS, OLDER_FILE_LABEL, ROUTES, SERVICE_LAYER_FIELDS, SINGLE_CHOICE_COLUMNS, SKIP,
    SQ_M_PER_ACRE, START_YEAR, TARGET_FIELDS,
)
from treatflow.functions.acres import clamped_acres, clamped_acres_by_unit, managed_acres
from treatflow.functions.dates import completion_date, completion_year
from treatflow.functions.geometry import acres, reproject
from treatflow.functions.lists import distinct_list
from treatflow.functions.text import clean_doc_name, objective_text, project_name
from treatflow.operators import qa
from treatflow.operators.classify import classify_treatments, route_of, split_routes
from treatflow.operators.counts import StepCounts, counted
from treatflow.operators.crosswalk import activity_to_type, crosswalk, majority_fallback, tiered_crosswalk
from treatflow.operators.filters import drop_excluded, drop_slivers, filter_year, region, repaired
from treatflow.operators.footprints import flatten
from treatflow.operators.funding import fund_names, fund_source_type
from treatflow.operators.overlay import majority_owner
from treatflow.operators.schema import (
    add_fields, copy_source_id, fill_text, final_projection, keep_fields, map_fields, number_rows, prune_to, rename, stamp_constants,
    stamp_provenance, stamp_updated, standardize,
)
from treatflow.session import broadcast_if_small, cut_lineage
from treatflow.sources.readers import merge_layers

PART_IDS = 2**31


def prepare_dates(df: DataFrame, dates: Sequence[str], min_year: int) -> DataFrame:
    columns = [F.col(d) for d in dates]
    return df.withColumns({"DATE_COMP": completion_date(columns), "YEAR_COMP": completion_year(columns, min_year)})


def to_target_projection(df: DataFrame) -> DataFrame:
    if "srid" not in df.columns:
        return df
    return df.withColumn("geom", reproject("geom", "srid")).withColumn("srid", F.lit(26913))


def single_parts(df: DataFrame) -> DataFrame:
    """One row per polygon part; the other columns repeat, and ``oid`` becomes (row, part)."""
    exploded = df.select(*[c for c in df.columns if c != "geom"], F.posexplode("geom").alias("__part", "__rings"))
    new_id = F.col("oid").cast("decimal(38,0)") * PART_IDS + F.col("__part")
    return exploded.withColumns({"oid": new_id.cast("decimal(38,0)"), "geom": F.array("__rings")}).drop("__part", "__rings")


# --- crosswalk flow -----------------------------------------------------------


def ingest_activity_layers(layers: Mapping[str, DataFrame], files: Mapping[str, str], state: str, date_text: str,
                           years: tuple[int, int] = (START_YEAR, END_YEAR), counts: StepCounts | None = None) -> DataFrame:
    """Region, repair, one set of names, merge, dates, projection, single parts.

    Without any layer that has the region's column this is an empty table of the same columns.
    """
    tables = []
    for name, layer in layers.items():
        here = region(layer, state)
        if here is None:
            continue
        tables.append(stamp_provenance(standardize(repaired(here)), files[name], date_text).withColumn("layer", F.lit(name)))
    merged = copy_source_id(add_fields(merge_layers(tables, ACTIVITY_CONTRACT), TARGET_FIELDS))
    merged = counted(merged, counts, "merged")
    dated = filter_year(prepare_dates(merged, ["DATE_COMPLETED", "DATE_AWARDED"], years[0]), "YEAR_COMP", *years)
    dated = counted(dated, counts, "in years")
    named = to_target_projection(dated).withColumn("NEPA_DOC_NAME", clean_doc_name(F.col("NEPA_DOC_NAME")))
    # parts of a repaired polygon need no second repair
    return single_parts(keep_fields(named, ACTIVITY_LAYER_FIELDS, list(TARGET_FIELDS)))


def reclassify_activities(df: DataFrame, tiers: Sequence[tuple[DataFrame, str, str, str]], funds: DataFrame) -> DataFrame:
    funded = fund_names(df, funds)
    labelled = tiered_crosswalk(funded, tiers, "activity_reclass")
    return drop_excluded(majority_fallback(labelled, "ACTIVITY", "activity_reclass"), "activity_reclass")


ACTIVITY_STATS = {
    "NBR_UNITS_ACCOMPLISHED": "max", "NEPA_DOC_NAME": "concatenate", "TREATMENT_NAME": "concatenate",
    "fileNmDate": "first", "FUND_CODE": "concatenate", "funding_update": "concatenate", "funding_type": "first",
    "ACTIVITY": "concatenate", "SourceOID": "first", "DATE_COMP": "first", "YEAR_COMP": "first",
}


def finalize_activities(df: DataFrame, run_date: str, modified_by: str,
                        years: tuple[int, int] = (START_YEAR, END_YEAR)) -> DataFrame:
    target = filter_year(add_fields(df, TARGET_FIELDS), "YEAR_COMP", *years)
    stamped = stamp_constants(target, {**AGENCY_CONSTANTS["usfs"], "MODIFY_BY": modified_by})
    mapped = map_fields(stamped, AGENCY_FIELD_MAPS["usfs"])
    measured = mapped.withColumn("ACRES_GIS", acres_of(F.col("area")))
    # labels that no tier and no majority resolved stay, and are told
    typed = activity_to_type(measured).withColumn("UNRESOLVED", F.coalesce(F.col("activity_reclass") == SKIP, F.lit(False)))
    named = typed.withColumn("PRJ_NAME", project_name(F.col("TREATMENT_NAME"), F.col("NEPA_DOC_NAME")))
    clamped = named.withColumn("ACRES_MGT", clamped_acres(F.col("NBR_UNITS_ACCOMPLISHED"), F.col("area")))
    kept = drop_slivers(clamped, "ACRES_GIS", "area", "perimeter")
    return prune_to(stamp_updated(kept, run_date), [*TARGET_FIELDS, "UNRESOLVED"])


def acres_of(area_sq_m: Column) -> Column:
    return area_sq_m / SQ_M_PER_ACRE


def crosswalk_flow(layers: Mapping[str, DataFrame], files: Mapping[str, str], state: str,
                   tiers: Sequence[tuple[DataFrame, str, str, str]], funds: DataFrame, run_date: str, modified_by: str,
                   years: tuple[int, int] = (START_YEAR, END_YEAR), tolerance: float = 100.0,
                   counts: StepCounts | None = None) -> DataFrame:
    """Ingest, reclassify, flatten and finalize activity layers; ``counts`` gets the rows of each step."""
    # the staged layer: later passes read only the columns they need of the rows that are left
    raw = cut_lineage(counted(ingest_activity_layers(layers, files, state, run_date, years, counts), counts, "single parts"))
    labelled = counted(reclassify_activities(raw, tiers, funds), counts, "reclassified")
    flat = flatten(labelled, tolerance, ["activity_reclass", "DATE_COMPLETED"], ACTIVITY_STATS)
    return counted(finalize_activities(flat, run_date, modified_by, years), counts, "final")


# --- keyword flows --------------------------------------------------------------


def keyword_flow(service: DataFrame, types: DataFrame, rules: Sequence[tuple[str, str]] = KEYWORD_RULES,
                 years: tuple[int, int] = (START_YEAR, END_YEAR), modified_by: str = "",
                 trust_crosswalk: bool = False, counts: StepCounts | None = None) -> DataFrame:
    """Feature-service records by type crosswalk and keywords; ``route`` tells the outcome.

    With ``trust_crosswalk`` a crosswalk label stands where no keyword matches.  ``counts`` gets the rows of each step.
    """
    service = counted(service, counts, "source")
    dated = prepare_dates(
        copy_source_id(add_fields(service, TARGET_FIELDS), "ID"), ["CompletionDate", "InitiationDate"], years[0]
    )
    recent = counted(filter_year(dated, "YEAR_COMP", *years), counts, "in years")
    kept = keep_fields(to_target_projection(recent), SERVICE_LAYER_FIELDS, list(TARGET_FIELDS))
    coded = crosswalk(kept, types, ["Type", "Category", "SubType"], {"reclass": "ACT_CSV"})
    classed = classify_treatments(coded, ["Name", "Notes", "ACT_CSV"], rules)
    if trust_crosswalk:
        trusted = (F.col("ActClass_1") == "UNCLASSIFIED") & (F.coalesce(F.col("ACT_CSV"), F.lit("")) != "")
        classed = classed.withColumn("ActClass_1", F.when(trusted, F.col("ACT_CSV")).otherwise(F.col("ActClass_1")))
    routed = split_routes(classed)
    if counts is not None:
        routed = counts.parts(routed, {r: F.col("route") == r for r in ROUTES})
    stamped = stamp_constants(routed, {**AGENCY_CONSTANTS["ifpers"], "MODIFY_BY": modified_by})
    mapped = map_fields(stamped, AGENCY_FIELD_MAPS["ifpers"])
    measured = mapped.withColumn("ACRES_GIS", acres("geom"))
    typed = activity_to_type(measured.withColumn("ACRES_MGT", managed_acres(F.col("ACRES_MGT"), F.col("ACRES_GIS"))))
    return prune_to(typed, [*TARGET_FIELDS, "activity_reclass", "Keyword", "route"])


def review_flow(notes: DataFrame, dates: Sequence[str], rules: Sequence[tuple[str, str]] = KEYWORD_RULES,
                years: tuple[int, int] = (START_YEAR, END_YEAR), corrected: DataFrame | None = None,
                reported: str = "BLM_ACRES", modified_by: str = "") -> DataFrame:
    """Text-classified records; reviewed rows in ``corrected`` replace theirs before finalization."""
    dated = prepare_dates(copy_source_id(add_fields(notes, TARGET_FIELDS)), dates, years[0])
    classed = classify_treatments(filter_year(dated, "YEAR_COMP", *years), ["TRTMNT_NM", "TRTMNT_COMMENTS"], rules)
    routed = split_routes(classed)
    if corrected is not None:
        routed = review_merge(routed, corrected, ["oid", "Keyword"])
    stamped = stamp_constants(routed, {**AGENCY_CONSTANTS["blm"], "MODIFY_BY": modified_by})
    mapped = map_fields(stamped, AGENCY_FIELD_MAPS["blm"])
    if "geom" in mapped.columns:
        mapped = mapped.withColumn("ACRES_GIS", acres("geom"))
    managed = mapped.withColumn("ACRES_MGT", managed_acres(F.col(reported), F.col("ACRES_GIS")))
    return prune_to(activity_to_type(managed), [*TARGET_FIELDS, "activity_reclass", "Keyword", "route"])


def review_merge(routed: DataFrame, corrected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Review rows with a correction (keys and a new ``activity_reclass``) get its label and that label's route.

    Of several corrections of a key the last one by ``line_no`` counts, or the largest label where there is
    no ``line_no``; a correction without a label changes nothing.
    """
    order = F.col("line_no") if "line_no" in corrected.columns else F.lit(0)
    last = F.max(F.struct(order.alias("n"), F.col("activity_reclass").alias("label")))["label"]
    new = corrected.filter(F.col("activity_reclass").isNotNull()).groupBy(*keys).agg(last.alias("__label"))
    joined = routed.join(broadcast_if_small(new), list(keys), "left")
    fixed = (F.col("route") == "review") & F.col("__label").isNotNull()
    changed = {
        "activity_reclass": F.when(fixed, F.col("__label")).otherwise(F.col("activity_reclass")),
        "route": F.when(fixed, route_of(F.col("__label"))).otherwise(F.col("route")),
    }
    return joined.select([changed[c].alias(c) if c in changed else F.col(c) for c in routed.columns])


# --- older record, matched at 25 m ------------------------------------------------

UNIT_STATS = {
    "COMPLETED_": "max", "UNIT_OF_ME": "first", "NAME_REDACT": "first", "ID_CODE": "first", "FUNDING_SO": "concatenate",
    "DESCRIPTION_REDACT": "concatenate", "COMMENT_REDACT": "concatenate", "Class_Combine": "concatenate",
}


def unit_flow(df: DataFrame, run_date: str, modified_by: str, min_year: int = START_YEAR,
              tolerance: float = 25.0) -> DataFrame:
    """Flatten and finalize records whose amounts carry a unit."""
    flat = flatten(df, tolerance, ["ActClass", "COMPLETED1"], UNIT_STATS)
    target = add_fields(copy_source_id(flat), OLDER_FIELDS)
    stamped = stamp_constants(target, {**AGENCY_CONSTANTS["csfs"], "MODIFY_BY": modified_by})
    gis = acres_of(F.col("area"))
    filled = stamped.withColumns(
        {
            "PRJ_NAME": F.col("NAME_REDACT"),
            "PRJ_OBJECT": objective_text(F.col("DESCRIPTION_REDACT"), F.col("COMMENT_REDACT")),
            "FUNDING": distinct_list(F.col("FUNDING_SO")),
            "ACRES_GIS": gis,
            "ACRES_MGT": clamped_acres_by_unit(F.col("UNIT_OF_ME"), F.col("COMPLETED_"), gis),
            "YEAR_COMP": completion_year([F.col("COMPLETED1")], min_year),
        }
    )
    managed = qa.activity_columns(filled, "ActClass")
    year = F.coalesce(F.col("YEAR_COMP").cast("string"), F.lit("None"))
    labelled = managed.withColumn("ORGFILE", F.format_string(OLDER_FILE_LABEL, year))
    return keep_fields(stamp_updated(labelled, run_date), list(OLDER_FIELDS))


# --- merge ------------------------------------------------------------------------


def merge_qa(layers: Sequence[DataFrame], parcels: DataFrame, owner: str, funds: DataFrame,
             cell_size: float | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Merge agency tables, set the majority owner, normalize and flag; one record of ``MERGED_FIELDS`` per row.

    Agencies number their rows on their own, so every merged row gets a new id ``ORGID``, from 1 in the order of the layers
    and their ids and the same on every replay; it is written with the rows before anything joins on it.  ``keep`` names
    further columns to carry along; ``ORGID``, ``ERROR_FLAG`` and ``qa_flags`` follow the fields, the polygon comes last.
    No layers give an empty table.
    """
    placed = [rename(layer, MERGE_RENAMES).withColumn("__layer", F.lit(i)) for i, layer in enumerate(layers)]
    contract = {"oid": "bigint", "FUNDING": "string", "geom": GEOM_TYPE, "__layer": "int"}
    merged = add_fields(merge_layers(placed, contract), MERGED_FIELDS)
    # the lists of funds and the borders of the ranges are taken from the written rows, so layers are read and repaired once
    funded = fund_source_type(cut_lineage(repaired(merged)), funds)
    staged = number_rows(funded, ["__layer", "oid"], "ORGID").drop("__layer")
    owned = majority_owner(staged, parcels, "ORGID", owner, cell_size)
    checks = {"NO MGT_TYPE": qa.no_mgt_type(F.col("__mgt"))}
    typed = owned.withColumn("__mgt", F.col("MGT_TYPE")).withColumn("MGT_TYPE", qa.normalized_mgt_type(F.col("MGT_TYPE")))
    if all(c in typed.columns for c in SINGLE_CHOICE_COLUMNS):
        typed = qa.single_activity(typed)
        checks["ACTIVITY ERROR"] = F.col("activity_error")
    checks["FUND_FLAG"] = F.col("fund_flag")
    checks["YEAR FLAG"] = qa.year_out_of_range(F.col("YEAR_COMP"))
    filled = fill_text(qa.qa_flags(typed, checks)).withColumn("ACRES_GIS", acres("geom"))
    kinds = {f.name: f.dataType.simpleString() for f in filled.schema.fields}
    carried = {c: kinds[c] for c in [*keep, "ORGID", "ERROR_FLAG", "qa_flags"]}
    return final_projection(filled, {**MERGED_FIELDS, **carried})
