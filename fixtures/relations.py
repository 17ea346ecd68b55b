"""Relations of a library warehouse, derived from whole tables in SQL both engines read.

The mapping follows FIXTURES.md with these changes: no row of a source table is filtered away
(keys that must stay unmatched get an ``x`` in front instead), note texts are whole documents,
contributors are a customer's orders, and listings, courses and reserves all grow with the data
(a listing per supplier, at most two courses per listing, every lineitem a reserve version).
"""

from __future__ import annotations

from collections.abc import Callable

from fixtures.dialects import Spark

SOURCES = "region nation customer supplier part orders lineitem events documents".split()
OPEN = "9999-12-31 00:00:00"
# When versions of items and instances begin: at first, and on the day of a change.
FIRST, CHANGE = "2019-01-01 00:00:00", "2020-06-01 00:00:00"


def _versions(d: Spark, relation: str, older: str, columns: str = "*", flag: bool = False) -> str:
    """A history of a current relation.  Keys in 7 changed once, of which those in 17 came then; keys in 5 had a twin that went."""
    current, gone = (", true as __current", ", false as __current") if flag else ("", "")
    return f"""select {columns}, concat(id, '-2') as __id, case when id like '%7' then {d.instant(CHANGE)} else {d.instant(FIRST)} end as __start,
            {d.instant(OPEN)} as __end{current} from {{{relation}}}
        union all select {older}, concat(id, '-1'), {d.instant(FIRST)}, {d.instant(CHANGE)}{gone} from {{{relation}}}
            where id like '%7' and id not like '%17'
        union all select {older.replace("id,", "concat('gone', id),", 1)}, concat(id, '-0'), {d.instant(FIRST)}, {d.instant(CHANGE)}{gone} from {{{relation}}}
            where id like '%5'"""


def item(d: Spark) -> str:
    t = d.text
    notes = f"""case p_size % 3
        when 1 then {d.array(d.record(note="p_name", itemNoteTypeId=t("p_size % 5"), staffOnly="'true'"))}
        when 2 then {d.array(
            d.record(note="p_name", itemNoteTypeId="'1'", staffOnly="'false'"),
            d.record(note="p_type", itemNoteTypeId=t("p_size % 7"), staffOnly="'true'"))} end"""
    circulation_notes = f"""case when p_size % 2 = 1 then {d.array(
        d.record(id=t("p_partkey"), note="p_type", noteType="'Check in'", staffOnly="'true'"),
        d.record(id=t("p_size"), note="p_name", noteType="'Check out'", staffOnly="'false'"))} end"""
    number = d.record(
        prefix="case when p_size % 2 = 0 then 'Curr' end",
        callNumber="case when p_size % 7 <> 0 then p_brand end",
        typeId=t("p_size % 27"),
    )
    document = d.document(
        hrid=f"concat('it', {t('p_partkey')})",
        barcode=f"concat('B', {t('p_partkey')})",
        accessionNumber="case when p_size > 25 then p_type end",
        formerIds=f"case when p_size % 4 = 1 then {d.array(t('p_size'), 'p_brand')} end",
        copyNumber=f"case when p_size % 5 = 0 then {t('p_size')} else '1' end",
        volume="case when p_size % 3 = 0 then p_type end",
        inTransitDestinationServicePointId=t("p_size % 12"),
        itemLevelCallNumber="case when p_size % 8 = 0 then p_brand end",
        itemLevelCallNumberTypeId=t("p_size % 26"),
        effectiveCallNumberComponents=number,
        itemDamagedStatusId=t("p_size % 4"),
        numberOfPieces=t("p_size % 3"),
        metadata=d.record(updatedDate="'2021-05-06T07:08:09Z'", updatedByUserId=f"concat('U', {t('p_size')})"),
        status=d.record(
            name="case when p_size < 10 then 'Missing' else 'Available' end", date="'2021-05-06T07:08:09Z'"
        ),
        discoverySuppress="case when p_size % 2 = 0 then 'true' when p_size % 3 = 0 then 'false' end",
        effectiveShelvingOrder="concat(p_brand, p_type)",
        notes=notes,
        circulationNotes=circulation_notes,
    )
    return f"""select {t("p_partkey")} as id, {d.instant("2020-03-08 09:30:00")} as creation_date,
        {t("p_size")} as holdingsrecordid, {t("p_size % 28")} as effectivelocationid, p_brand as materialtypeid,
        {t("p_size % 5")} as permanentloantypeid,
        case when p_size % 4 = 0 then {t("p_size % 7")} end as temporaryloantypeid,
        {t("p_size % 25")} as permanentlocationid,
        case when p_size % 6 = 0 then {t("p_size % 30")} end as temporarylocationid,
        {document} as jsonb from {{part}}"""


def item__(d: Spark) -> str:
    document = d.document(volume="'old volume'", status=d.record(name="'On order'"), circulationNotes=d.array(d.record(id="'1'", note="'old'")))
    keys = "holdingsrecordid, effectivelocationid, materialtypeid, permanentloantypeid, temporaryloantypeid, permanentlocationid, temporarylocationid"
    return _versions(d, "item", f"id, creation_date, {keys}, {document}", f"id, creation_date, {keys}, jsonb")


def instance__(d: Spark) -> str:
    document = d.document(matchKey="'OLD'", isBoundWith="'on'")
    return _versions(d, "instance", f"id, {document}", "id, jsonb")


def instance(d: Spark) -> str:
    t = d.text
    codes = d.array("case when c_custkey % 10 = 0 then 'known-dup' else 'other' end", "'c2'")
    identifiers = d.array(
        d.record(identifierTypeId="'oclc'", value=f"concat({t('c_nationkey')}, '-', {t('c_custkey % 40')})"),
        d.record(identifierTypeId="'oclc'", value=f"concat({t('c_nationkey')}, '-', {t('c_custkey % 60')})"),
        d.record(identifierTypeId="'isbn'", value="c_mktsegment"),
    )
    document = d.document(
        staffSuppress="case when c_custkey % 7 = 0 then 'true' when c_custkey % 5 <> 0 then 'false' end",
        statisticalCodeIds=f"case when c_custkey % 11 <> 0 then {codes} end",
        identifiers=identifiers,
        matchKey=f"concat('M', {t('c_custkey')})",
        isBoundWith="case when c_custkey % 3 = 0 then 'true' end",
        metadata=d.record(
            createdDate="'2020-01-02T03:04:05Z'",
            updatedDate="'2021-01-02T03:04:05+02:00'",
            updatedByUserId=t("c_nationkey"),
        ),
    )
    return f"""select case when c_custkey % 13 = 0 then concat('x', {t("c_custkey")}) else {t("c_custkey")} end as id,
        {document} as jsonb from {{customer}}"""


def coursereserves_terms(d: Spark) -> str:
    return f"select {d.text('r_regionkey')} as id, {d.document(name='r_name')} as jsonb from {{region}}"


def coursereserves_departments(d: Spark) -> str:
    t = d.text("n_nationkey")
    return f"""select case when n_nationkey < 5 then {t} else concat('x', {t}) end as id,
        {d.document(name="n_name")} as jsonb from {{nation}}"""


def coursereserves_courselistings__(d: Spark) -> str:
    """Two versions per listing; the older one of every second listing was in the next term."""
    t = d.text
    people = d.array(d.record(name="concat('Prof ', s_name)"), d.record(name="'Second'"))
    now = d.document(termId=t("s_nationkey % 5"), instructorObjects=f"case when s_suppkey % 4 <> 0 then {people} end")
    old = d.document(termId=t("(s_nationkey + s_suppkey % 2) % 5"), instructorObjects=d.array(d.record(name="'Old'")))
    return f"""select {t("s_suppkey")} as id, {t("s_suppkey * 2")} as __id, {now} as jsonb,
            {d.instant("1998-01-01 00:00:00")} as __start, {d.instant(OPEN)} as __end from {{supplier}}
        union all select {t("s_suppkey")}, {t("s_suppkey * 2 + 1")}, {old},
            {d.instant("1995-01-01 00:00:00")}, {d.instant("1998-01-01 00:00:00")} from {{supplier}}"""


def coursereserves_courses__(d: Spark) -> str:
    """A course per listing, but every fourth course shares the listing before its own."""
    t = d.text
    listing = t("case when s_suppkey % 4 = 3 then s_suppkey - 1 else s_suppkey end")

    def document(name: str) -> str:
        return d.document(
            name=name,
            courseNumber=f"case when s_suppkey % 3 <> 0 then concat('C', {t('s_suppkey')}) end",
            courseListingId=listing,
            departmentId=t("s_suppkey % 7"),
        )

    return f"""select {t("s_suppkey")} as id, 2 as __id, {document("s_name")} as jsonb,
            {d.instant("1995-01-01 00:00:00")} as __start, {d.instant(OPEN)} as __end from {{supplier}}
        union all select {t("s_suppkey")}, 1, {document("concat('Old ', s_name)")},
            {d.instant("1994-01-01 00:00:00")}, {d.instant("1995-01-01 00:00:00")} from {{supplier}}"""


def reserve_versions(d: Spark) -> str:
    order = "partition by l_orderkey, l_linenumber order by l_shipdate, l_partkey, l_suppkey"
    return f"""select {d.text("l_orderkey * 10 + l_linenumber")} as id, l_partkey, l_returnflag, l_shipdate,
        {d.text("l_suppkey")} as courselistingid, lead(l_shipdate) over ({order}) as nxt,
        cast(row_number() over ({order}) as bigint) as v from {{lineitem}}"""


def reserve_versions_on_spark(d: Spark) -> str:
    """The same rows; texts are made of numbers behind the window, so its shuffle carries none and readers of other columns share it."""
    order = "partition by l_orderkey, l_linenumber order by l_shipdate, l_partkey, l_suppkey"
    return f"""select {d.text("l_orderkey * 10 + l_linenumber")} as id, l_partkey, l_returnflag, l_shipdate,
        {d.text("l_suppkey")} as courselistingid, nxt, v from (
            select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_shipdate, lead(l_shipdate) over ({order}) as nxt,
                cast(row_number() over ({order}) as bigint) as v from {{lineitem}})"""


def coursereserves_reserves__(d: Spark) -> str:
    t = d.text
    copied = d.record(title="p_name", barcode=f"concat('B', {t('l_partkey')})", callNumber="p_type")
    return f"""select id, v as __id, courselistingid, l_shipdate as __start,
        coalesce(nxt, case when l_returnflag = 'N' then {d.instant(OPEN)} when l_returnflag = 'A'
            then l_shipdate + interval '400' day end) as __end,
        {d.document(itemId=t("l_partkey"), copiedItem=copied)} as jsonb
        from {{reserve_versions}} join {{part}} on p_partkey = l_partkey"""


def loan__(d: Spark) -> str:
    action = "case l_returnflag when 'A' then 'checkedOut' when 'N' then 'renewed' else 'checkedin' end"
    return f"""select {d.text("l_orderkey * 10 + l_linenumber")} as id,
        l_shipdate + interval '3' hour as creation_date,
        {d.document(itemId=d.text("l_partkey"), action=action)} as jsonb from {{lineitem}}"""


def item__t(d: Spark) -> str:
    t = d.text
    return f"""select case when p_partkey % 17 = 0 then concat('x', {t("p_partkey")}) else {t("p_partkey")} end as id,
        concat('it', {t("p_partkey")}) as hrid, concat('B', {t("p_partkey")}) as barcode,
        case when p_size % 9 = 0 then p_name end as enumeration, case when p_size % 3 = 0 then p_type end as volume,
        case when p_size % 5 = 0 then {t("p_size")} else '1' end as copy_number,
        {t("p_size")} as holdings_record_id, {t("p_size % 28")} as effective_location_id from {{part}}"""


def item__t__(d: Spark) -> str:
    """Every item had another barcode before; keys in 7 until the day of a change."""
    columns = "hrid, enumeration, volume, copy_number, holdings_record_id, effective_location_id"
    begin = f"case when id like '%7' then {d.instant(CHANGE)} else {d.instant(FIRST)} end"
    return f"""select id, barcode, {columns}, true as __current, {begin} as __start, {d.instant(OPEN)} as __end from {{item__t}}
        union all select id, concat('OLD', barcode), {columns}, false, {d.instant("2018-01-01 00:00:00")}, {begin} from {{item__t}}"""


def holdings_record__t(d: Spark) -> str:
    t = d.text
    return f"""select {t("s_suppkey")} as id, concat('ho', {t("s_suppkey")}) as hrid, s_name as call_number,
        case when s_nationkey % 3 = 0 then 'Curr' end as call_number_prefix, {t("s_suppkey")} as instance_id,
        {t("s_nationkey")} as permanent_location_id from {{supplier}}"""


def holdings_record__t__(d: Spark) -> str:
    """Every third holding stood somewhere else before, every sixth hung on another instance there."""
    t = d.text
    return f"""select id, instance_id, permanent_location_id, true as __current from {{holdings_record__t}}
        union all select {t("s_suppkey")}, {t("case when s_suppkey % 6 = 0 then s_suppkey + 1 else s_suppkey end")}, {t("(s_nationkey + s_suppkey % 2) % 25")}, false
            from {{supplier}} where s_suppkey % 3 = 0"""


def instance__t(d: Spark) -> str:
    t = d.text
    return f"""select {t("c_custkey")} as id,
        case when c_custkey % 2 = 0 then concat('b', c_name) else c_name end as hrid, c_name as title,
        lower(c_name) as index_title, 'MARC' as source, '2019-07-01' as cataloged_date,
        c_mktsegment as instance_type_id, {t("c_nationkey % 6")} as mode_of_issuance_id,
        case when c_custkey % 2 = 0 then true end as previously_held,
        case when c_custkey % 3 = 0 then true end as discovery_suppress,
        case when c_custkey % 5 = 0 then false end as staff_suppress, {t("c_nationkey")} as status_id,
        {d.instant("2022-02-03 04:05:06")} as status_updated_date from {{customer}}"""


def instance__t__(d: Spark) -> str:
    """All columns, with the titles of before."""
    columns = "hrid, index_title, source, cataloged_date, instance_type_id, mode_of_issuance_id, previously_held, discovery_suppress, staff_suppress, status_id, status_updated_date"
    return _versions(d, "instance__t", f"id, concat('Old ', title), {columns}", f"id, title, {columns}", flag=True)


def check_in__t__(d: Spark) -> str:
    """Every fourth check-in has an older version, which gave another status, or the same."""
    status = "case event_type when 'view' then 'Available' when 'click' then 'Checked out' when 'purchase' then 'Checked out' else 'In transit' end"
    older = f"case when event_id % 8 = 0 then 'Available' else {status} end"
    return f"""select {d.text("event_id")} as id, {d.text("user_id")} as item_id, ts as occurred_date_time,
            {status} as item_status_prior_to_check_in, true as __current from {{events}}
        union all select {d.text("event_id")}, {d.text("user_id")}, ts, {older}, false from {{events}} where event_id % 4 = 0"""


def check_in__t(d: Spark) -> str:
    return "select id, item_id, occurred_date_time, item_status_prior_to_check_in from {check_in__t__} where __current"


def loans_items(d: Spark) -> str:
    return f"""select {d.text("l_orderkey * 10 + l_linenumber")} as loan_id, {d.text("l_partkey")} as item_id,
        l_shipdate as loan_date from {{lineitem}}"""


def coursereserves_courses__t__(d: Spark) -> str:
    return f"select s_name as name, {d.text('s_suppkey')} as course_listing_id from {{supplier}}"


def coursereserves_reserves__t__(d: Spark) -> str:
    return f"select courselistingid as course_listing_id, {d.text('l_partkey')} as item_id from {{reserve_versions}}"


def item_notes(d: Spark) -> str:
    return f"""select item_id, note from (select {d.text("doc_id")} as item_id,
        {d.rows("text", "concat(lang, ' ', source)")} as note from {{documents}}) n"""


def instance_contributors(d: Spark) -> str:
    return f"""select {d.text("o_custkey")} as instance_id, concat('Author ', o_orderpriority) as contributor_name,
        o_orderstatus = 'F' as contributor_is_primary from {{orders}}"""


def instance_publication(d: Spark) -> str:
    t = d.text
    return f"""select case when c_custkey % 4 = 0 then concat('x', {t("c_custkey")}) else {t("c_custkey")} end
            as instance_id, case when c_custkey % 3 <> 0 then c_mktsegment end as publisher,
        {d.rows(t("1900 + c_nationkey"), "case when c_nationkey > 12 then '2001' else '2002' end")}
            as date_of_publication from {{customer}}"""


def locations_libraries(d: Spark) -> str:
    return f"""select {d.text("n_nationkey")} as location_id, concat('loc', {d.text("n_nationkey")}) as location_code,
        r_name as library_name from {{nation}} join {{region}} on r_regionkey = n_regionkey"""


def holdings_ext(d: Spark) -> str:
    t = d.text("s_suppkey")
    return f"""select {t} as holdings_id, {t} as instance_id, n_name as permanent_location_name,
        case when s_suppkey % 5 <> 0 then s_name end as call_number
        from {{supplier}} left join {{nation}} on n_nationkey = s_nationkey"""


def items_holdings_instances(d: Spark) -> str:
    return """select i.id as item_id, i.barcode, n.title, h.id as holdings_id, n.id as instance_id
        from {item__t} i left join {holdings_record__t} h on h.id = i.holdings_record_id
        left join {instance__t} n on n.id = h.instance_id"""


def _codes(table: str, key: str, name: str, unmatched: str = "false") -> Callable[[Spark], str]:
    def relation(d: Spark) -> str:
        key_text = d.text(key)
        return f"""select case when {unmatched} then concat('x', {key_text}) else {key_text} end as id,
            {name} as name from {{{table}}}"""

    return relation


RELATIONS: dict[str, Callable[[Spark], str]] = {
    f.__name__: f
    for f in (
        item,
        item__,
        instance,
        instance__,
        coursereserves_terms,
        coursereserves_departments,
        coursereserves_courselistings__,
        coursereserves_courses__,
        reserve_versions,
        coursereserves_reserves__,
        loan__,
        item__t,
        item__t__,
        holdings_record__t,
        holdings_record__t__,
        instance__t,
        instance__t__,
        check_in__t__,
        check_in__t,
        loans_items,
        coursereserves_courses__t__,
        coursereserves_reserves__t__,
        item_notes,
        instance_contributors,
        instance_publication,
        locations_libraries,
        holdings_ext,
        items_holdings_instances,
    )
} | {
    "location__t": _codes("nation", "n_nationkey", "n_name"),
    "material_type__t": lambda d: "select distinct p_brand as id, concat('mt ', p_brand) as name from {part}",
    "loan_type__t": _codes("region", "r_regionkey", "r_name"),
    "service_point__t": _codes("nation", "n_nationkey", "n_name", "n_nationkey >= 10"),
    "item_damaged_status__t": _codes("region", "r_regionkey", "r_name", "r_regionkey >= 3"),
    "call_number_type__t": _codes("nation", "n_nationkey", "n_name"),
    "item_note_type__t": _codes("region", "r_regionkey", "r_name"),
    "instance_type__t": lambda d: "select distinct c_mktsegment as id, lower(c_mktsegment) as name from {customer}",
    "mode_of_issuance__t": _codes("region", "r_regionkey", "r_name"),
    "instance_status__t": _codes("nation", "n_nationkey", "n_name", "n_nationkey % 3 = 0"),
}

#: Relations that Spark derives by a text of its own; the rows are those of ``RELATIONS``.
ON_SPARK: dict[str, Callable[[Spark], str]] = {"reserve_versions": reserve_versions_on_spark}
