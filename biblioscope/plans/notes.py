"""Reports that search item notes or list notes of one type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioscope.functions.documents import database_text, json_text, text_bool, text_fields, uuid_norm
from biblioscope.functions.text import ci_match, class_list_call_number, skip_null_concat
from biblioscope.operators.aggregates import joined_texts, text_counts
from biblioscope.operators.contract import sorted_by
from biblioscope.operators.joins import only, spread_join
from biblioscope.operators.lookup import with_name
from biblioscope.operators.unnest import unnest_json
from biblioscope.plans.derived import instance_ext, item_ext
from biblioscope.sources.staging import kept
from biblioscope.sources.tables import Tables

# Fixed value: the note type listed by the note type report.
NOTE_TYPE = "7a46e1ca-d2eb-49a3-9935-59bed639e6f1"

ITEM_NOTE = text_fields("note", "itemNoteTypeId", "staffOnly")


def class_list(tables: Tables, note_string: str | None) -> DataFrame:
    """Items with a matching note: where they stand and what the note says."""
    found = tables["item_notes"].where(F.col("item_id").isNotNull() & ci_match(F.col("note"), note_string))
    # Searched once; the ids alone then pick the items to read and flatten.
    notes = kept(found.select("item_id", "note"))
    items = item_ext(
        tables,
        [
            "item_id",
            "barcode",
            "holdings_record_id",
            "effective_location_id",
            "effective_location_name",
            "effective_call_number_prefix",
            "effective_call_number",
            "volume",
            "copy_number",
        ],
        only=notes.select(F.col("item_id").alias("id")).distinct(),
    )
    holdings = tables["holdings_ext"].select(F.col("holdings_id").alias("holdings_record_id"), "instance_id")
    locations = tables["locations_libraries"].select(
        F.col("location_id").alias("effective_location_id"), "location_code"
    )
    number = class_list_call_number(
        F.col("effective_call_number_prefix"), F.col("effective_call_number"), F.col("volume"), F.col("copy_number")
    )
    # Holdings and instances are cut to those of the found items before they are shuffled.
    shelved = kept(spread_join(notes, items, "item_id").join(locations, "effective_location_id", "left"))
    placed = kept(spread_join(shelved, only(holdings, shelved, "holdings_record_id"), "holdings_record_id", "left"))
    instances = only(instance_ext(tables, ["instance_id", "title"]), placed, "instance_id")
    rows = (
        spread_join(placed, instances, "instance_id", "left")
        .select(
            F.col("barcode").alias("item_barcode"),
            "location_code",
            F.col("effective_location_name").alias("location_name"),
            number.alias("item_call_number"),
            F.col("title").alias("instance_title"),
            F.col("note").alias("item_note"),
        )
        .distinct()
    )
    return sorted_by(rows, "location_name", "item_call_number", "item_barcode", "item_note")


def googlebooknotes(tables: Tables, note_type: str = NOTE_TYPE) -> DataFrame:
    """Notes of one type with their position in the item and the item's description."""
    items = tables["item"].select("holdingsrecordid", "effectivelocationid", "materialtypeid", "jsonb")
    notes = unnest_json(items, "jsonb", "notes", ITEM_NOTE, "n", "ordinality").where(
        uuid_norm(F.col("n.itemNoteTypeId")) == note_type.lower()
    )
    types = (
        tables["item_note_type__t"]
        .where(F.col("id") == note_type.lower())
        .select(F.col("id").alias("type_id"), F.col("name").alias("note_type_name"))
    )
    holdings = tables["holdings_record__t"].select(
        F.col("id").alias("holdingsrecordid"), F.col("hrid").alias("holdings_hrid"), "call_number", "instance_id"
    )
    instances = tables["instance__t"].select(
        F.col("id").alias("instance_id"), F.col("discovery_suppress").cast("string"), "title"
    )
    document = F.col("jsonb")
    rows = (
        notes.select(
            "holdingsrecordid",
            "effectivelocationid",
            "materialtypeid",
            uuid_norm(F.col("n.itemNoteTypeId")).alias("type_id"),
            json_text(document, "hrid").alias("item_hrid"),
            json_text(document, "barcode").alias("barcode"),
            database_text(document, "formerIds", depth=2).alias("formerids"),
            json_text(document, "effectiveShelvingOrder").alias("shelving_order"),
            F.col("n.note").alias("note"),
            text_bool(F.col("n.staffOnly")).cast("string").alias("staff_only"),
            F.col("ordinality").cast("int").alias("note_ordinality"),
        )
        .join(types, "type_id")
        .join(holdings, "holdingsrecordid", "left")
        .join(instances, "instance_id", "left")
    )
    rows = with_name(rows, tables["location__t"], "effectivelocationid", "item_location")
    rows = with_name(rows, tables["material_type__t"], "materialtypeid", "material_type")
    ordered = sorted_by(rows, "item_location", "shelving_order", "item_hrid", "note_ordinality")
    return ordered.select(
        "discovery_suppress",
        "item_hrid",
        "holdings_hrid",
        "item_location",
        "barcode",
        "formerids",
        "call_number",
        "shelving_order",
        "material_type",
        "title",
        "note_type_name",
        "note",
        "staff_only",
        "note_ordinality",
    )


def search_notes(tables: Tables, note_string: str | None) -> DataFrame:
    """Matching notes of every item, joined into one text per item and publication.

    Each note is repeated once per contributor of the instance, as the contributors take part
    in the join without being shown.  Repeats are carried as counts, never as rows: notes,
    contributors and publications meet only after each has been aggregated on its own key.
    """
    found = tables["item_notes"].where(F.col("item_id").isNotNull() & ci_match(F.col("note"), note_string))
    # Searched once; the ids alone then pick the items to describe.
    notes = kept(text_counts(found, "item_id", "note", "notes"))
    # What the items hang on is cut to the found items before it is aggregated or shuffled.
    items = kept(tables["items_holdings_instances"].join(notes.select("item_id"), "item_id", "left_semi"))
    contributors = only(tables["instance_contributors"].select("instance_id"), items, "instance_id").groupBy("instance_id").agg(F.count(F.lit(1)).alias("people"))
    publications = (
        only(tables["instance_publication"].select("instance_id", "publisher", "date_of_publication"), items, "instance_id")
        .groupBy("instance_id", "publisher", "date_of_publication")
        .agg(F.count(F.lit(1)).alias("prints"))
    )
    holdings = only(tables["holdings_ext"].select("holdings_id", "permanent_location_name", "call_number"), items, "holdings_id")
    shown = ["item_id", "barcode", "title", "publisher", "date_of_publication"]
    shown += ["permanent_location_name", "call_number"]
    described = (
        spread_join(items, contributors, "instance_id", "left")
        .join(holdings, "holdings_id", "left")
        .join(publications, "instance_id", "left")
        .groupBy(*shown)
        .agg(F.sum(F.coalesce("people", F.lit(1)) * F.coalesce("prints", F.lit(1))).alias("copies"))
    )
    comma = F.lit(", ")
    return (
        described.join(notes, "item_id")
        .select(
            F.col("item_id").alias("item_uuid"),
            F.col("barcode").alias("item_barcode"),
            skip_null_concat(
                F.col("title"), comma, F.col("publisher"), comma, F.col("date_of_publication")
            ).alias("instance_title_publisher_date"),
            skip_null_concat(F.col("permanent_location_name"), comma, F.col("call_number")).alias(
                "holdings_location_call_number"
            ),
            joined_texts("notes", "note", ", ", F.col("copies")).alias("item_notes"),
        )
        .distinct()
    )
