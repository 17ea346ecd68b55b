"""The fourteen reports on the test relations, each with the SQL it must agree with."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioscope import Tables, run
from fixtures.oracle_text import array_text, elements, json_text, local_day

RECORDS = "https://catalog.example.org/Record/"


def _counts_as_bigint(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(n).cast("bigint").alias(n) if t == "decimal(38,0)" else F.col(n) for n, t in df.dtypes])


def _instants_as_utc(df: DataFrame) -> DataFrame:
    """Instants as UTC wall clocks, which compare alike whatever the session's time zone."""
    return df.select(
        *[
            F.convert_timezone(None, F.lit("UTC"), F.col(n).cast("timestamp_ntz")).alias(n) if t == "timestamp" else n
            for n, t in df.dtypes
        ]
    )


def _report(name: str, **arguments: object) -> Callable[[Tables], DataFrame]:
    return lambda tables: _instants_as_utc(_counts_as_bigint(run(tables, name, **arguments)))


REPORT_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "r01_circ_stats_course_reserves": _report(
        "circ_stats_course_reserves",
        circ_stat_course_name="SUPPLIER#0+[0-9]*[01]$",
        start_date="1996-01-01",
        end_date="2000-12-31",
    ),
    "r02_class_list": _report("class_list", note_string="SRC1"),
    "r03_count_circulation_history": _report(
        "count_circulation_history", barcode_to_check="B12", start_date=dt.date(2024, 1, 3), end_date=dt.date(2024, 1, 20)
    ),
    "r04_count_internal_use": _report("count_internal_use", barcode_to_check="B12"),
    "r05_course_term_circ_stats": _report("course_term_circ_stats", term_name=" America "),
    "r06_inventory_by_prefix": _report(
        "display_inventory_curriculum_collection", i_call_number_prefix="Curr", record_url=RECORDS
    ),
    "r07_duplicate_identifiers": _report(
        "duplicate_oclc_numbers", identifier_type="oclc", known_duplicate='"known-dup"'
    ),
    "r08_notes_of_type": _report("googlebooknotes", note_type="1"),
    "r09_instance_ext": _report("instance_ext"),
    "r10_item_circulation_notes": _report("item_circulation_notes"),
    "r11_item_ext": _report("item_ext"),
    "r12_perm_reserve_circ_stats": _report("perm_rsrv_curr_circ_stats", term_name="africa"),
    "r13_zero_use_items": _report(
        "zero_use_items", start_date="2024-01-05", end_date="2024-01-06", location_id="14"
    ),
    "r14_search_notes": _report("search_notes", note_string="SRC"),
}


def _term_report(version: str, match: str, head: str) -> str:
    """The term reports; ``version`` is the condition that keeps the versions they look at."""
    number = json_text("effectiveCallNumberComponents.callNumber", "i.jsonb")
    first, last = local_day("s.first_start"), local_day("s.last_end")
    return f"""with listings as (
        select l.id as clid, {json_text("name", "t.jsonb")} as course_term,
            coalesce({json_text("instructorObjects[0].name", "l.jsonb")}, '') as primary_instructor,
            {local_day("l.__start")} as opened, {local_day("l.__end")} as closed
        from {{coursereserves_courselistings__}} l join {{coursereserves_terms}} t on t.id = {json_text("termId", "l.jsonb")}
        where ({match}) and {version.format("l")}
        qualify row_number() over (partition by l.id order by l.__start desc) = 1),
    courses as (
        select l.*, c.id as course_id, {json_text("name", "c.jsonb")} as course_name,
            coalesce({json_text("courseNumber", "c.jsonb")}, '') as course_number,
            coalesce({json_text("name", "d.jsonb")}, '') as course_department
        from {{coursereserves_courses__}} c join listings l on l.clid = {json_text("courseListingId", "c.jsonb")}
        left join {{coursereserves_departments}} d on d.id = {json_text("departmentId", "c.jsonb")}
        where {version.format("c")}
        qualify row_number() over (partition by c.id order by c.__start desc) = 1),
    reserved as (
        select v.clid, {json_text("itemId", "v.jsonb")} as item_id,
            substr({json_text("copiedItem.title", "v.jsonb")}, 1, 80) as item_title,
            {json_text("copiedItem.barcode", "v.jsonb")} as item_barcode,
            if({number} is null, {json_text("copiedItem.callNumber", "v.jsonb")},
                trim(concat({json_text("effectiveCallNumberComponents.prefix", "i.jsonb")}, ' ', {number},
                    ' ' || {json_text("volume", "i.jsonb")},
                    if({json_text("copyNumber", "i.jsonb")} <> '1', ' c.' || {json_text("copyNumber", "i.jsonb")}, null)))
            ) as call_number,
            if(v.opened > {first}, v.opened, {first}) as opens, if(v.closed < {last}, v.closed, {last}) as closes
        from (select h.*, a.* from {{coursereserves_reserves__}} h
                join (select distinct clid, opened, closed from courses) a on a.clid = h.courselistingid
                where {version.format("h")}
                qualify row_number() over (partition by h.id, a.clid order by h.__start desc, h.__id desc) = 1) v
        join (select id, min(__start) as first_start,
                case when bool_and(__end is not null) then max(__end) end as last_end
                from {{coursereserves_reserves__}} h where {version.format("h")} group by id) s on s.id = v.id
        left join {{item}} i on i.id = {json_text("itemId", "v.jsonb")}),
    checkouts as (
        select r.item_id, r.item_barcode, r.clid, count(*) as loans
        from {{loan__}} n join reserved r on r.item_id = {json_text("itemId", "n.jsonb")}
            and {local_day("n.creation_date")} between r.opens and r.closes
        where lower({json_text("action", "n.jsonb")}) in
            ('checkedout', 'checkedoutthroughoverride', 'renewed', 'renewedthroughoverride')
        group by all)
    select {head}, primary_instructor, cast(coalesce(loans, 0) as bigint) as checkout_count, item_title,
        call_number, r.item_barcode, opens as course_item_start, closes as course_item_end,
        r.clid as course_listing_id, course_id, r.item_id
    from reserved r join courses c on c.clid = r.clid
    left join checkouts k on k.item_id = r.item_id and k.clid = r.clid"""


REPORT_SQL: dict[str, str] = {
    "r01_circ_stats_course_reserves": """
        select distinct t.barcode as item_barcode, n.title as instance_title, k.loans as circ_count
        from (select item_id, count(loan_id) as loans from {loans_items}
              where loan_date >= date '1996-01-01' and loan_date < date '2001-01-01' group by item_id) k
        left join {item} i on i.id = k.item_id
        left join {item__t} t on t.id = i.id
        left join {holdings_ext} h on h.holdings_id = i.holdingsrecordid
        left join {instance__t} n on n.id = h.instance_id
        where k.item_id in (
            select r.item_id from {coursereserves_reserves__t__} r
            join {coursereserves_courses__t__} c using (course_listing_id)
            where regexp_matches(c.name, '(?i)SUPPLIER#0+[0-9]*[01]$'))""",
    "r02_class_list": f"""
        select distinct t.barcode as item_barcode, b.location_code, l.name as location_name,
            trim(concat({json_text("effectiveCallNumberComponents.prefix", "i.jsonb")}, ' ',
                {json_text("effectiveCallNumberComponents.callNumber", "i.jsonb")}, ' ',
                {json_text("effectiveCallNumberComponents.callNumber", "i.jsonb")}, ' ',
                {json_text("volume", "i.jsonb")}, ' ', {json_text("copyNumber", "i.jsonb")})) as item_call_number,
            n.title as instance_title, o.note as item_note
        from {{item_notes}} o join {{item}} i on i.id = o.item_id
        left join {{item__t}} t on t.id = i.id
        left join {{location__t}} l on l.id = i.effectivelocationid
        left join {{locations_libraries}} b on b.location_id = i.effectivelocationid
        left join {{holdings_ext}} h on h.holdings_id = i.holdingsrecordid
        left join {{instance__t}} n on n.id = h.instance_id
        where regexp_matches(o.note, '(?i)SRC1')""",
    "r03_count_circulation_history": """
        select c.id as check_in_id, cast(c.occurred_date_time as date) as check_in_date
        from {check_in__t} c where c.item_status_prior_to_check_in = 'Checked out'
        and c.occurred_date_time between timestamp '2024-01-03' and timestamp '2024-01-20'
        and c.item_id in (select id from {item__t} where barcode = 'B12')""",
    "r04_count_internal_use": """
        select cast(count(*) as integer) as internal_use_count
        from {check_in__t__} c join {item__t__} i on i.id = c.item_id and i.__current and i.barcode = 'B12'
        where c.item_status_prior_to_check_in = 'Available'""",
    "r05_course_term_circ_stats": _term_report(
        "true",
        f"lower({json_text('name', 't.jsonb')}) = 'america' or t.id = 'america'",
        "course_term, course_department, course_number, course_name",
    ),
    "r06_inventory_by_prefix": f"""
        select distinct l.name as location, n.index_title, a.contributor_name,
            concat('Curr ', h.call_number) as call_number, i.volume, i.copy_number,
            concat('{RECORDS}', if(n.hrid like 'b%', substr(n.hrid, 1, 8), n.hrid)) as link,
            i.barcode as item_barcode, i.id as item_id, i.holdings_record_id as holdings_id
        from {{holdings_record__t}} h join {{item__t}} i on i.holdings_record_id = h.id
        join {{instance__t}} n on n.id = h.instance_id
        join {{instance_contributors}} a on a.instance_id = n.id and a.contributor_is_primary
        left join {{location__t}} l on l.id = i.effective_location_id
        where h.call_number_prefix = 'Curr'""",
    "r07_duplicate_identifiers": f"""
        select count(distinct id) as dup_count, {json_text("identifierTypeId", "n")} as id_type,
            {json_text("value", "n")} as oclc_number
        from {elements("instance", "identifiers", "id, jsonb")}
        where {json_text("identifierTypeId", "n")} = 'oclc'
        and coalesce({json_text("staffSuppress")}, 'false') = 'false'
        and not regexp_matches({json_text("statisticalCodeIds")}, '(?i)"known-dup"')
        group by all having count(distinct id) > 1""",
    "r08_notes_of_type": f"""
        select cast(s.discovery_suppress as varchar) as discovery_suppress, {json_text("hrid", "i.jsonb")} as item_hrid,
            h.hrid as holdings_hrid, l.name as item_location, {json_text("barcode", "i.jsonb")} as barcode,
            {array_text("formerIds", "i.jsonb")} as formerids, h.call_number,
            {json_text("effectiveShelvingOrder", "i.jsonb")} as shelving_order, m.name as material_type, s.title,
            y.name as note_type_name, {json_text("note", "i.n")} as note, {json_text("staffOnly", "i.n")} as staff_only,
            cast(i.ord as integer) as note_ordinality
        from {elements("item", "notes", "*")} i
        join {{item_note_type__t}} y on y.id = {json_text("itemNoteTypeId", "i.n")} and y.id = '1'
        left join {{holdings_record__t}} h on h.id = i.holdingsrecordid
        left join {{instance__t}} s on s.id = h.instance_id
        left join {{location__t}} l on l.id = i.effectivelocationid
        left join {{material_type__t}} m on m.id = i.materialtypeid""",
    "r09_instance_ext": f"""
        select t.id as instance_id, t.hrid as instance_hrid, cast(t.cataloged_date as date) as cataloged_date,
            t.title, t.index_title, t.instance_type_id as type_id, k.name as type_name, t.mode_of_issuance_id,
            m.name as mode_of_issuance_name, coalesce(t.previously_held, false) as previously_held,
            t.source as instance_source, coalesce(t.discovery_suppress, false) as discovery_suppress,
            coalesce(t.staff_suppress, false) as staff_suppress, t.status_id, s.name as status_name,
            t.status_updated_date, t.source as record_source,
            cast({json_text("metadata.createdDate", "r.jsonb")} as timestamptz) at time zone 'UTC' as record_created_date,
            lower({json_text("metadata.updatedByUserId", "r.jsonb")}) as updated_by_user_id,
            cast({json_text("metadata.updatedDate", "r.jsonb")} as timestamptz) at time zone 'UTC' as updated_date,
            lower({json_text("matchKey", "r.jsonb")}) as match_key,
            coalesce(cast({json_text("isBoundWith", "r.jsonb")} as boolean), false) as is_bound_with
        from {{instance__t}} t left join {{instance}} r on r.id = t.id
        left join {{instance_type__t}} k on k.id = t.instance_type_id
        left join {{mode_of_issuance__t}} m on m.id = t.mode_of_issuance_id
        left join {{instance_status__t}} s on s.id = t.status_id""",
    "r10_item_circulation_notes": f"""
        select id as item_id, lower({json_text("id", "n")}) as note_id, {json_text("note", "n")} as note,
            {json_text("noteType", "n")} as note_type, cast({json_text("staffOnly", "n")} as boolean) as staff_only,
            ord as ordinality
        from {elements("item", "circulationNotes", "id")}""",
    "r11_item_ext": f"""
        select i.id as item_id, t.hrid as item_hrid, {json_text("accessionNumber", "i.jsonb")} as accession_number, t.barcode,
            {json_text("chronology", "i.jsonb")} as chronology, {json_text("copyNumber", "i.jsonb")} as copy_number, t.enumeration,
            {json_text("volume", "i.jsonb")} as volume,
            {json_text("inTransitDestinationServicePointId", "i.jsonb")} as in_transit_destination_service_point_id,
            sp.name as in_transit_destination_service_point_name, {json_text("itemIdentifier", "i.jsonb")} as identifier,
            {json_text("itemLevelCallNumber", "i.jsonb")} as call_number,
            {json_text("itemLevelCallNumberTypeId", "i.jsonb")} as call_number_type_id, ct.name as call_number_type_name,
            {json_text("effectiveCallNumberComponents.prefix", "i.jsonb")} as effective_call_number_prefix,
            {json_text("effectiveCallNumberComponents.callNumber", "i.jsonb")} as effective_call_number,
            {json_text("effectiveCallNumberComponents.suffix", "i.jsonb")} as effective_call_number_suffix,
            {json_text("effectiveCallNumberComponents.typeId", "i.jsonb")} as effective_call_number_type_id,
            et.name as effective_call_number_type_name, {json_text("itemDamagedStatusId", "i.jsonb")} as damaged_status_id,
            ds.name as damaged_status_name, i.materialtypeid as material_type_id, mt.name as material_type_name,
            {json_text("numberOfPieces", "i.jsonb")} as number_of_pieces,
            {json_text("numberOfMissingPieces", "i.jsonb")} as number_of_missing_pieces,
            i.permanentloantypeid as permanent_loan_type_id, pt.name as permanent_loan_type_name,
            i.temporaryloantypeid as temporary_loan_type_id, tt.name as temporary_loan_type_name,
            i.permanentlocationid as permanent_location_id, pl.name as permanent_location_name,
            i.temporarylocationid as temporary_location_id, tl.name as temporary_location_name,
            i.effectivelocationid as effective_location_id, el.name as effective_location_name,
            {json_text("descriptionOfPieces", "i.jsonb")} as description_of_pieces,
            {json_text("status.date", "i.jsonb")} as status_date, {json_text("status.name", "i.jsonb")} as status_name,
            i.holdingsrecordid as holdings_record_id,
            cast({json_text("discoverySuppress", "i.jsonb")} as boolean) as discovery_suppress,
            i.creation_date as created_date, lower({json_text("metadata.updatedByUserId", "i.jsonb")}) as updated_by_user_id,
            {json_text("metadata.updatedDate", "i.jsonb")} as updated_date
        from {{item}} i left join {{item__t}} t on t.id = i.id
        left join {{service_point__t}} sp on sp.id = {json_text("inTransitDestinationServicePointId", "i.jsonb")}
        left join {{call_number_type__t}} ct on ct.id = {json_text("itemLevelCallNumberTypeId", "i.jsonb")}
        left join {{call_number_type__t}} et on et.id = {json_text("effectiveCallNumberComponents.typeId", "i.jsonb")}
        left join {{item_damaged_status__t}} ds on ds.id = {json_text("itemDamagedStatusId", "i.jsonb")}
        left join {{material_type__t}} mt on mt.id = i.materialtypeid
        left join {{loan_type__t}} pt on pt.id = i.permanentloantypeid
        left join {{loan_type__t}} tt on tt.id = i.temporaryloantypeid
        left join {{location__t}} pl on pl.id = i.permanentlocationid
        left join {{location__t}} tl on tl.id = i.temporarylocationid
        left join {{location__t}} el on el.id = i.effectivelocationid""",
    "r12_perm_reserve_circ_stats": _term_report(
        "({0}.__end is null or {0}.__end = timestamp '9999-12-31')",
        f"lower({json_text('name', 't.jsonb')}) = 'africa'",
        "course_department, course_name, course_number",
    ),
    "r13_zero_use_items": """
        select i.id as item_id, n.title
        from {item__t__} i join {holdings_record__t__} h on h.id = i.holdings_record_id
        join {instance__t__} n on n.id = h.instance_id
        where i.__current and h.permanent_location_id = '14' and i.id not in (
            select item_id from {check_in__t__}
            where occurred_date_time between timestamp '2024-01-05' and timestamp '2024-01-06')""",
    "r14_search_notes": """
        select distinct item_uuid, item_barcode, instance_title_publisher_date, holdings_location_call_number, item_notes
        from (
            select x.item_id as item_uuid, x.barcode as item_barcode,
                concat(x.title, ', ', p.publisher, ', ', p.date_of_publication) as instance_title_publisher_date,
                concat(h.permanent_location_name, ', ', h.call_number) as holdings_location_call_number,
                string_agg(o.note, ', ' order by o.note) as item_notes
            from {items_holdings_instances} x join {item_notes} o on o.item_id = x.item_id
            left join {instance_contributors} a on a.instance_id = x.instance_id
            left join {holdings_ext} h on h.holdings_id = x.holdings_id
            left join {instance_publication} p on p.instance_id = x.instance_id
            where regexp_matches(o.note, '(?i)SRC')
            group by x.item_id, x.barcode, x.title, p.publisher, p.date_of_publication,
                h.permanent_location_name, h.call_number) g""",
}
