"""Column operators: bringing differing layers to one record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from treatflow.fixed_values import SYSTEM_FIELDS
from treatflow.functions.lists import clean_list
from treatflow.functions.strings import blank_to_null
from treatflow.functions.text import provenance
from treatflow.session import cut_lineage

__all__ = [
    "add_fields", "prune_to", "keep_fields", "standardize", "stamp_constants", "map_fields",
    "stamp_provenance", "stamp_updated", "rename", "strip_prefix", "copy_source_id", "key_source_id", "number_rows",
    "final_projection", "fill_text",
]

def _by_lower(df: DataFrame) -> dict[str, str]:
    return {c.lower(): c for c in df.columns}


def add_fields(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Add the fields that are missing (in any letter case) as typed nulls."""
    present = _by_lower(df)
    missing = {n: F.lit(None).cast(t) for n, t in fields.items() if n.lower() not in present}
    return df.withColumns(missing) if missing else df


def prune_to(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Keep target fields (any letter case), shape columns and system columns."""
    keep = {f.lower() for f in fields} | set(SYSTEM_FIELDS)
    return df.select([c for c in df.columns if c.lower() in keep or c.lower().startswith("shape")])


def keep_fields(df: DataFrame, *lists: Sequence[str]) -> DataFrame:
    """Keep the union of the given lists and the system columns; letter case counts."""
    keep = {f for names in lists for f in names} | set(SYSTEM_FIELDS)
    return df.select([c for c in df.columns if c in keep])


def standardize(df: DataFrame) -> DataFrame:
    """One set of attribute names from the differing names of the source layers.

    The columns are chosen once per table; the value is the first one per row that is neither
    blank nor ``none``.
    """
    present = _by_lower(df)

    def value(names: Sequence[str], default: str, first_only: bool) -> Column:
        found = [present[n] for n in names if n in present]
        if first_only:
            found = found[:1]
        return F.coalesce(*[blank_to_null(F.col(c), ["none"]) for c in found], F.lit(default))

    targets = {
        "TREATMENT_NAME": value(["name", "treatment_name", "au_name", "subunit_name"], "Unknown", False),
        "NEPA_DOC_NAME": value(["nepa_doc_name", "nepa_project_name"], "", False),
        "ACTIVITY": value(["activity_name", "activity"], "", True),
        "METHOD": value(["method_desc", "method"], "", True),
        "EQUIPMENT": value(["equipment_desc", "equipment"], "", True),
        "FUND_CODE": value(["fund_codes", "fund_code"], "No Funding Code", True),
    }
    sources = {
        "name", "au_name", "subunit_name", "nepa_project_name", "activity_name",
        "method_desc", "equipment_desc", "fund_codes",
    }
    drop = sources | {t.lower() for t in targets}
    rest = [F.col(c) for c in df.columns if c.lower() not in drop]
    return df.select(*rest, *[v.alias(t) for t, v in targets.items()])


def stamp_constants(df: DataFrame, constants: Mapping[str, str]) -> DataFrame:
    """Set each field to a literal, or to a column when the value starts with ``=``."""
    return df.withColumns(
        {f: F.col(v[1:]) if v.startswith("=") else F.lit(v) for f, v in constants.items()}
    )


def map_fields(df: DataFrame, field_map: Mapping[str, str], width: int | None = None) -> DataFrame:
    """Target field = cleaned list of the source field; whole, unless a caller's target has a ``width``."""
    whole = {t: F.array_join(clean_list(F.col(s).cast("string")), "; ") for t, s in field_map.items()}
    return df.withColumns(whole if width is None else {t: F.substring(v, 1, width) for t, v in whole.items()})


def stamp_provenance(df: DataFrame, file_name: str | Column, date_text: str) -> DataFrame:
    name = F.lit(file_name) if isinstance(file_name, str) else file_name
    return df.withColumn("fileNmDate", provenance(name, date_text))


def stamp_updated(df: DataFrame, run_date: str) -> DataFrame:
    """Run date on each row; an argument, so that a replay gives the same rows."""
    return df.withColumn("UPDATED", F.lit(run_date).cast("date"))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist, where the new name is still free."""
    present = set(df.columns)
    return df.withColumnsRenamed({o: n for o, n in names.items() if o in present and n not in present})


def strip_prefix(df: DataFrame, prefixes: Sequence[str] = ("SUM_", "FIRST_", "CONCATENATE_", "MAX_")) -> DataFrame:
    names = {}
    for c in df.columns:
        for p in prefixes:
            if c.startswith(p):
                names[c] = c.replace(p, "")
    return rename(df, names)


def copy_source_id(df: DataFrame, source: str = "oid") -> DataFrame:
    return df.withColumn("SourceOID", F.col(source).cast("bigint"))


def key_source_id(df: DataFrame, natural_key: Sequence[str], name: str = "SourceOID") -> DataFrame:
    """New id from the row's natural key: the same on every replay and needs no shuffle."""
    return df.withColumn(name, F.xxhash64(*natural_key))


def number_rows(df: DataFrame, order: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Number the rows from ``start`` on in the order of the columns ``order``, nulls first, into ``name``.

    Rows that agree in them come in the order of a hash of all their columns, so a replay gives every row its number
    again.  Rows are range-partitioned, written, and numbered on top of the sizes of earlier partitions.
    """
    spread = df.withColumn("__tie", F.xxhash64(*df.columns)).repartitionByRange(*order, "__tie")
    placed = cut_lineage(spread.sortWithinPartitions(*order, "__tie").drop("__tie").withColumns(
        {"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}))
    sizes = placed.groupBy("__part").agg(F.min("__at").alias("__from"), F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition, so this window and its broadcast are small by construction
    offsets = sizes.select("__part", "__from", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    number = F.col("__at") - F.col("__from") + F.col("__before") + start
    return placed.join(F.broadcast(offsets), "__part").withColumn(name, number).drop("__part", "__at", "__from", "__before")


def final_projection(df: DataFrame, fields: Mapping[str, str], geometry: str | None = "geom") -> DataFrame:
    """Exact fields, order and types; geometry last."""
    present = _by_lower(df)
    columns = [F.col(present[n.lower()]).cast(t).alias(n) for n, t in fields.items()]
    if geometry is not None and geometry in df.columns:
        columns.append(F.col(geometry))
    return df.select(columns)


def fill_text(df: DataFrame) -> DataFrame:
    """Null gives '' in every text column."""
    text = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.fillna("", subset=text) if text else df
