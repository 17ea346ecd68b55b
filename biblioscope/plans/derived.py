"""Wide derived tables: items, instances and circulation notes flattened from their documents."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblioscope.functions.documents import flag, json_instant, text_bool, text_fields, uuid_norm
from biblioscope.operators import joins
from biblioscope.operators.lookup import with_name
from biblioscope.operators.unnest import unnest_json
from biblioscope.sources.tables import Tables

ITEM_DOCUMENT = text_fields(
    "accessionNumber",
    "chronology",
    "copyNumber",
    "volume",
    "inTransitDestinationServicePointId",
    "itemIdentifier",
    "itemLevelCallNumber",
    "itemLevelCallNumberTypeId",
    "itemDamagedStatusId",
    "numberOfPieces",
    "numberOfMissingPieces",
    "descriptionOfPieces",
    "discoverySuppress",
    effectiveCallNumberComponents=text_fields("prefix", "callNumber", "suffix", "typeId"),
    metadata=text_fields("updatedByUserId", "updatedDate"),
    status=text_fields("date", "name"),
)

INSTANCE_DOCUMENT = text_fields(
    "matchKey", "isBoundWith", metadata=text_fields("createdDate", "updatedDate", "updatedByUserId")
)

CIRCULATION_NOTE = text_fields("id", "note", "noteType", "staffOnly")

# Name column -> (id column, code table).
ITEM_NAMES = {
    "in_transit_destination_service_point_name": ("in_transit_destination_service_point_id", "service_point__t"),
    "call_number_type_name": ("call_number_type_id", "call_number_type__t"),
    "effective_call_number_type_name": ("effective_call_number_type_id", "call_number_type__t"),
    "damaged_status_name": ("damaged_status_id", "item_damaged_status__t"),
    "material_type_name": ("material_type_id", "material_type__t"),
    "permanent_loan_type_name": ("permanent_loan_type_id", "loan_type__t"),
    "temporary_loan_type_name": ("temporary_loan_type_id", "loan_type__t"),
    "permanent_location_name": ("permanent_location_id", "location__t"),
    "temporary_location_name": ("temporary_location_id", "location__t"),
    "effective_location_name": ("effective_location_id", "location__t"),
}

INSTANCE_NAMES = {
    "type_name": ("type_id", "instance_type__t"),
    "mode_of_issuance_name": ("mode_of_issuance_id", "mode_of_issuance__t"),
    "status_name": ("status_id", "instance_status__t"),
}

# Output columns in order.
ITEM_EXT = """
    item_id item_hrid accession_number barcode chronology copy_number enumeration volume
    in_transit_destination_service_point_id in_transit_destination_service_point_name
    identifier call_number call_number_type_id call_number_type_name
    effective_call_number_prefix effective_call_number effective_call_number_suffix
    effective_call_number_type_id effective_call_number_type_name
    damaged_status_id damaged_status_name material_type_id material_type_name
    number_of_pieces number_of_missing_pieces
    permanent_loan_type_id permanent_loan_type_name temporary_loan_type_id temporary_loan_type_name
    permanent_location_id permanent_location_name temporary_location_id temporary_location_name
    effective_location_id effective_location_name description_of_pieces status_date status_name
    holdings_record_id discovery_suppress created_date updated_by_user_id updated_date
""".split()

INSTANCE_EXT = """
    instance_id instance_hrid cataloged_date title index_title type_id type_name
    mode_of_issuance_id mode_of_issuance_name previously_held instance_source
    discovery_suppress staff_suppress status_id status_name status_updated_date
    record_source record_created_date updated_by_user_id updated_date match_key is_bound_with
""".split()


def _named(df: DataFrame, tables: Tables, names: dict[str, tuple[str, str]], wanted: list[str]) -> DataFrame:
    """Look up the wanted name columns; code tables nobody asked for are not joined."""
    for name in wanted:
        if name in names:
            key, codes = names[name]
            df = with_name(df, tables[codes], key, name)
    return df.select(*wanted)


def item_ext(tables: Tables, columns: Iterable[str] = ITEM_EXT, only: DataFrame | None = None) -> DataFrame:
    """Items with the fields of their documents and the names behind their ids.

    A stored ``item_ext`` relation is read instead when the tables provide one.  With
    ``columns``, only the joins and document fields those columns need take part; ``only`` holds
    the ``id`` of the items to read.
    """

    def picked(items: DataFrame) -> DataFrame:
        return items if only is None else joins.only(items, only, "id")

    wanted = list(columns)
    stored = tables.get("item_ext")
    if stored is not None:
        return picked(stored.withColumn("id", F.col("item_id"))).select(*wanted)

    flat_columns = {"item_hrid": "hrid", "barcode": "barcode", "enumeration": "enumeration"}
    items = picked(tables["item"].withColumn("doc", F.from_json("jsonb", ITEM_DOCUMENT)).drop("jsonb"))
    if flat_columns.keys() & set(wanted):
        flat = picked(tables["item__t"]).select(
            F.col("id").alias("_flat_id"), *[F.col(c).alias(f"_{c}") for c in flat_columns.values()]
        )
        items = items.join(flat, F.col("id") == F.col("_flat_id"), "left")

    number = "doc.effectiveCallNumberComponents"
    sources: dict[str, str | Column] = {
        "item_id": "id",
        "item_hrid": "_hrid",
        "accession_number": "doc.accessionNumber",
        "barcode": "_barcode",
        "chronology": "doc.chronology",
        "copy_number": "doc.copyNumber",
        "enumeration": "_enumeration",
        "volume": "doc.volume",
        "in_transit_destination_service_point_id": uuid_norm(F.col("doc.inTransitDestinationServicePointId")),
        "identifier": "doc.itemIdentifier",
        "call_number": "doc.itemLevelCallNumber",
        "call_number_type_id": uuid_norm(F.col("doc.itemLevelCallNumberTypeId")),
        "effective_call_number_prefix": f"{number}.prefix",
        "effective_call_number": f"{number}.callNumber",
        "effective_call_number_suffix": f"{number}.suffix",
        "effective_call_number_type_id": uuid_norm(F.col(f"{number}.typeId")),
        "damaged_status_id": uuid_norm(F.col("doc.itemDamagedStatusId")),
        "material_type_id": "materialtypeid",
        "number_of_pieces": "doc.numberOfPieces",
        "number_of_missing_pieces": "doc.numberOfMissingPieces",
        "permanent_loan_type_id": "permanentloantypeid",
        "temporary_loan_type_id": "temporaryloantypeid",
        "permanent_location_id": "permanentlocationid",
        "temporary_location_id": "temporarylocationid",
        "effective_location_id": "effectivelocationid",
        "description_of_pieces": "doc.descriptionOfPieces",
        "status_date": "doc.status.date",
        "status_name": "doc.status.name",
        "holdings_record_id": "holdingsrecordid",
        "discovery_suppress": text_bool(F.col("doc.discoverySuppress")),
        "created_date": "creation_date",
        "updated_by_user_id": uuid_norm(F.col("doc.metadata.updatedByUserId")),
        "updated_date": "doc.metadata.updatedDate",
    }
    return _named(_project(items, sources, wanted, ITEM_NAMES), tables, ITEM_NAMES, wanted)


def instance_ext(tables: Tables, columns: Iterable[str] = INSTANCE_EXT) -> DataFrame:
    """Instances with document metadata, default-false flags and the names behind their ids."""
    wanted = list(columns)
    stored = tables.get("instance_ext")
    if stored is not None:
        return stored.select(*wanted)

    instances = tables["instance__t"]
    if {"record_created_date", "updated_by_user_id", "updated_date", "match_key", "is_bound_with"} & set(wanted):
        raw = tables["instance"].select(
            F.col("id").alias("_raw_id"), F.from_json("jsonb", INSTANCE_DOCUMENT).alias("doc")
        )
        instances = instances.join(raw, F.col("id") == F.col("_raw_id"), "left")

    sources: dict[str, str | Column] = {
        "instance_id": "id",
        "instance_hrid": "hrid",
        "cataloged_date": F.col("cataloged_date").cast("date"),
        "title": "title",
        "index_title": "index_title",
        "type_id": "instance_type_id",
        "mode_of_issuance_id": "mode_of_issuance_id",
        "previously_held": flag(F.col("previously_held")),
        "instance_source": "source",
        "discovery_suppress": flag(F.col("discovery_suppress")),
        "staff_suppress": flag(F.col("staff_suppress")),
        "status_id": "status_id",
        "status_updated_date": "status_updated_date",
        "record_source": "source",
        "record_created_date": json_instant(F.col("doc.metadata.createdDate")),
        "updated_by_user_id": uuid_norm(F.col("doc.metadata.updatedByUserId")),
        "updated_date": json_instant(F.col("doc.metadata.updatedDate")),
        "match_key": uuid_norm(F.col("doc.matchKey")),
        "is_bound_with": flag(F.col("doc.isBoundWith")),
    }
    return _named(_project(instances, sources, wanted, INSTANCE_NAMES), tables, INSTANCE_NAMES, wanted)


def _project(
    df: DataFrame, sources: dict[str, str | Column], wanted: list[str], names: dict[str, tuple[str, str]]
) -> DataFrame:
    """The wanted columns, plus the ids their names are looked up by."""
    needed = set(wanted) | {names[name][0] for name in wanted if name in names}
    column = {k: F.col(v) if isinstance(v, str) else v for k, v in sources.items() if k in needed}
    return df.select(*[expression.alias(name) for name, expression in column.items()])


def item_circulation_notes(tables: Tables) -> DataFrame:
    """One row per circulation note of an item, numbered in document order."""
    stored = tables.get("item_circulation_notes")
    if stored is not None:
        return stored
    items = tables["item"].select(F.col("id").alias("item_id"), "jsonb")
    notes = unnest_json(items, "jsonb", "circulationNotes", CIRCULATION_NOTE, "n", "ordinality")
    return notes.select(
        "item_id",
        uuid_norm(F.col("n.id")).alias("note_id"),
        F.col("n.note").alias("note"),
        F.col("n.noteType").alias("note_type"),
        text_bool(F.col("n.staffOnly")).alias("staff_only"),
        F.col("ordinality").cast("bigint").alias("ordinality"),
    )
