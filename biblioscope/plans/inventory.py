"""Inventory reports: collections by call number prefix and duplicate identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from biblioscope.functions.documents import text_fields
from biblioscope.functions.text import ci_match, record_link, skip_null_concat
from biblioscope.operators.contract import sorted_by
from biblioscope.operators.joins import only, spread_join
from biblioscope.sources.staging import kept
from biblioscope.sources.tables import Tables

# The address records are linked under; a site passes its own catalogue's.
RECORD_URL = "https://catalog.example.org/Record/"
# The label before call numbers, the identifier type that is checked for
# duplicates, and the statistical code of known duplicates (as quoted in a document).
COLLECTION_LABEL = "Curr "
IDENTIFIER_TYPE = "439bfbae-75bc-4f74-9fc7-b2a2d47ce3ef"
KNOWN_DUPLICATE = '"2125acda-b369-4388-9587-33dbc3398cbe"'

IDENTIFIERS = T.ArrayType(text_fields("identifierTypeId", "value"))


def display_inventory_curriculum_collection(
    tables: Tables, i_call_number_prefix: str, record_url: str = RECORD_URL
) -> DataFrame:
    """Items under a call number prefix with location, title, primary contributors and link.

    The call number is labelled ``Curr`` whatever the prefix.
    """
    holdings = kept(
        tables["holdings_record__t"]
        .where(F.col("call_number_prefix") == i_call_number_prefix)
        .select(F.col("id").alias("holdings_id"), "instance_id", "call_number")
    )
    # Contributors and instances of the prefix's holdings only, before anything is deduplicated.
    contributors = tables["instance_contributors"].where(F.col("contributor_is_primary")).select("instance_id", "contributor_name")
    contributors = only(contributors, holdings, "instance_id").distinct()
    instances = tables["instance__t"].select(F.col("id").alias("instance_id"), "index_title", "hrid")
    instances = only(instances, holdings, "instance_id")
    locations = tables["location__t"].select(
        F.col("id").alias("effective_location_id"), F.col("name").alias("location")
    )
    items = tables["item__t"].select(
        F.col("id").alias("item_id"),
        F.col("barcode").alias("item_barcode"),
        "volume",
        "copy_number",
        F.col("holdings_record_id").alias("holdings_id"),
        "effective_location_id",
    )
    # Contributors hang on the instance, so the holdings, fewer than items, are widened first.
    described = spread_join(holdings, contributors.join(instances, "instance_id"), "instance_id")
    return (
        items.join(described, "holdings_id")
        .join(locations, "effective_location_id", "left")
        .select(
            "location",
            "index_title",
            "contributor_name",
            skip_null_concat(F.lit(COLLECTION_LABEL), F.col("call_number")).alias("call_number"),
            "volume",
            "copy_number",
            record_link(F.col("hrid"), record_url).alias("link"),
            "item_barcode",
            "item_id",
            "holdings_id",
        )
        .distinct()
    )


def duplicate_oclc_numbers(
    tables: Tables, identifier_type: str = IDENTIFIER_TYPE, known_duplicate: str = KNOWN_DUPLICATE
) -> DataFrame:
    """Identifiers of one type held by several unsuppressed instances, most frequent first.

    Instances without any statistical code drop out: matching a missing list is neither true
    nor false.  An identifier repeated inside one instance counts once.
    """
    # json_tuple is not repeated when the filter moves down, so a document is read once.
    parts = F.json_tuple("jsonb", "staffSuppress", "statisticalCodeIds", "identifiers").alias("suppress", "codes", "identifiers")
    unsuppressed = (
        tables["instance"]
        .select("id", parts)
        .where(F.col("suppress").isNull() | (F.col("suppress") == "false"))
        .where(~ci_match(F.col("codes"), known_duplicate))
    )
    of_type = F.filter(F.from_json("identifiers", IDENTIFIERS), lambda i: i.identifierTypeId == identifier_type.lower())
    rows = (
        unsuppressed.select("id", F.explode(of_type).alias("i"))
        .groupBy(F.col("i.identifierTypeId").alias("id_type"), F.col("i.value").alias("oclc_number"))
        .agg(F.countDistinct("id").alias("dup_count"))
        .where("dup_count > 1")
        .select("dup_count", "id_type", "oclc_number")
    )
    return sorted_by(rows, "-dup_count", "oclc_number")
