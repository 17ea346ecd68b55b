"""Every operator on its own, on whole test relations, each with the SQL it must agree with."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioscope import Tables
from biblioscope.functions import dates, documents, text
from biblioscope.operators import aggregates, contract, history, lookup, spans, unnest
from biblioscope.plans import courses, derived, inventory, notes, upkeep
from biblioscope.sources import layout
from biblioscope.sources.staging import shared_folder
from fixtures.oracle_text import array_text as array_sql
from fixtures.oracle_text import elements as elements_sql
from fixtures.oracle_text import json_text as json_sql
from fixtures.oracle_text import local_day as day_sql
from fixtures.report_queries import REPORT_QUERIES, REPORT_SQL

c = F.col
Query = Callable[[Tables], DataFrame]
OPERATOR_QUERIES: dict[str, Query] = {}
OPERATOR_SQL: dict[str, str] = {}


def _check(name: str, sql: str) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        OPERATOR_QUERIES[name] = query
        OPERATOR_SQL[name] = sql
        return query

    return register


# --- sources and parameters -------------------------------------------------------------------


@_check("op_scan", "select * from {item__t}")
def _(t: Tables) -> DataFrame:
    return t["item__t"]


@_check("op_history_scan", "select id, courselistingid, __start as started, __end as ended from {coursereserves_reserves__}")
def _(t: Tables) -> DataFrame:
    return t["coursereserves_reserves__"].select(
        "id", "courselistingid", c("__start").alias("started"), c("__end").alias("ended")
    )


@_check("op_current_rows", "select id, barcode from {item__t__} where __current")
def _(t: Tables) -> DataFrame:
    return history.current_rows(t["item__t__"]).select("id", "barcode")


@_check(
    "op_derived_compose",
    """select i.id as item_id, x.barcode, l.name as effective_location_name, n.title
    from {item} i left join {item__t} x on x.id = i.id left join {location__t} l on l.id = i.effectivelocationid
    left join {holdings_ext} h on h.holdings_id = i.holdingsrecordid
    left join {instance__t} n on n.id = h.instance_id""",
)
def _(t: Tables) -> DataFrame:
    items = derived.item_ext(t, ["item_id", "barcode", "effective_location_name", "holdings_record_id"])
    holdings = t["holdings_ext"].select(c("holdings_id").alias("holdings_record_id"), "instance_id")
    titles = derived.instance_ext(t, ["instance_id", "title"])
    return (
        items.join(holdings, "holdings_record_id", "left")
        .join(titles, "instance_id", "left")
        .select("item_id", "barcode", "effective_location_name", "title")
    )


@_check(
    "op_as_of",
    """select id, barcode, holdings_record_id from {item__t__}
    where __start <= timestamp '2020-01-01' and __end > timestamp '2020-01-01'""",
)
def _(t: Tables) -> DataFrame:
    return t.without("item__t").as_of("2020-01-01 00:00:00")["item__t"].select("id", "barcode", "holdings_record_id")


def _refreshed(t: Tables, name: str) -> DataFrame:
    """A derived table stored as it was before a day of changes, with a code table of other names, and then refreshed."""
    root = f"{shared_folder(t.spark)}/{uuid.uuid4().hex}"
    other_name = F.when(c("id").like("%2"), F.concat(F.lit("former "), "name")).otherwise(c("name")).alias("name")
    older = t.having({code: t[code].select("id", other_name) for code in ("location__t", "instance_status__t")})
    upkeep.store_derived(older, root, as_of="2020-01-01 00:00:00")
    return upkeep.refresh_derived(t, root, "2024-01-01 00:00:00")[name]


@_check("op_derived_refresh", REPORT_SQL["r11_item_ext"])
def _(t: Tables) -> DataFrame:
    return _refreshed(t, "item_ext")


@_check("op_derived_refresh_instances", REPORT_SQL["r09_instance_ext"])
def _(t: Tables) -> DataFrame:
    return _refreshed(t, "instance_ext")


@_check(
    "op_date_range_default",
    """select item_id, count(loan_id) as loans from {loans_items}
    where cast(loan_date as date) between date '2000-01-01' and date '2099-01-01' group by item_id""",
)
def _(t: Tables) -> DataFrame:
    in_range = dates.in_day_range(c("loan_date"), dates.FIRST_DAY, dates.LAST_DAY)
    return t["loans_items"].where(in_range).groupBy("item_id").agg(F.count("loan_id").alias("loans"))


@_check(
    "op_output_contract",
    """select item_id as item, cast(count(*) as integer) as uses, cast(max(occurred_date_time) as date) as last_day,
    cast(bool_or(item_status_prior_to_check_in = 'Available') as varchar) as used_inside
    from {check_in__t__} group by item_id""",
)
def _(t: Tables) -> DataFrame:
    rows = (
        t["check_in__t__"]
        .groupBy("item_id")
        .agg(
            F.count(F.lit(1)),
            F.max("occurred_date_time"),
            F.bool_or(c("item_status_prior_to_check_in") == "Available"),
        )
    )
    return contract.conform(rows, "item string, uses int, last_day date, used_inside string")


# --- projection, filters, predicates ----------------------------------------------------------


@_check("op_project", "select id as item_id, concat(hrid, '/', barcode) as label, volume from {item__t}")
def _(t: Tables) -> DataFrame:
    return t["item__t"].select(
        c("id").alias("item_id"), F.concat("hrid", F.lit("/"), "barcode").alias("label"), "volume"
    )


@_check("op_filter_eq", "select id, item_id from {check_in__t} where item_status_prior_to_check_in = 'Checked out'")
def _(t: Tables) -> DataFrame:
    return t["check_in__t"].where(c("item_status_prior_to_check_in") == "Checked out").select("id", "item_id")


@_check("op_regex_search", "select item_id, note from {item_notes} where regexp_matches(note, '(?i)SRC1[0-5]?$')")
def _(t: Tables) -> DataFrame:
    return t["item_notes"].where(text.ci_match(c("note"), "SRC1[0-5]?$")).select("item_id", "note")


@_check(
    "op_regex_words",
    r"""select item_id, note from {item_notes}
    where regexp_matches(note, '(?i)(^|[^\p{{L}}\p{{Nd}}_])É[\p{{L}}\p{{Nd}}_]{{2}}($|[^\p{{L}}\p{{Nd}}_])')""",
)
def _(t: Tables) -> DataFrame:
    return t["item_notes"].where(text.ci_match(c("note"), r"\mÉ\w{2}\M")).select("item_id", "note")


@_check(
    "op_regex_anchored",
    f"select id, {json_sql('action')} as action from {{loan__}} where {json_sql('action')} in ('checkedOut', 'renewed')",
)
def _(t: Tables) -> DataFrame:
    action = documents.json_text(c("jsonb"), "action")
    return t["loan__"].where(text.ci_match(action, courses.CHECKOUT_ACTIONS)).select("id", action.alias("action"))


@_check(
    "op_regex_negated",
    f"""select id from {{instance}} where not contains({json_sql("statisticalCodeIds")}, '"known-dup"')""",
)
def _(t: Tables) -> DataFrame:
    codes = documents.json_text(c("jsonb"), "statisticalCodeIds")
    return t["instance"].where(~text.ci_match(codes, '"KNOWN-dup"')).select("id")


@_check("op_like_prefix", "select id, hrid from {instance__t} where hrid like 'b%'")
def _(t: Tables) -> DataFrame:
    return t["instance__t"].where(c("hrid").startswith("b")).select("id", "hrid")


@_check(
    "op_date_range",
    """select loan_id, loan_date from {loans_items}
    where cast(loan_date as date) between date '1996-01-01' and date '2000-12-31'""",
)
def _(t: Tables) -> DataFrame:
    in_range = dates.in_day_range(c("loan_date"), dt.date(1996, 1, 1), dt.date(2000, 12, 31))
    return t["loans_items"].where(in_range).select("loan_id", "loan_date")


@_check(
    "op_ts_range_midnight",
    """select id, occurred_date_time from {check_in__t}
    where occurred_date_time >= timestamp '2024-01-03' and occurred_date_time <= timestamp '2024-01-20'""",
)
def _(t: Tables) -> DataFrame:
    in_range = dates.in_midnight_range(c("occurred_date_time"), dt.date(2024, 1, 3), dt.date(2024, 1, 20))
    return t["check_in__t"].where(in_range).select("id", "occurred_date_time")


@_check(
    "op_flag_default_false",
    f"select id from {{instance}} where coalesce({json_sql('staffSuppress')}, 'false') = 'false'",
)
def _(t: Tables) -> DataFrame:
    return t["instance"].where(documents.absent_or_false(c("jsonb"), "staffSuppress")).select("id")


@_check(
    "op_null_rejecting_join",
    """select i.id as item_id, x.id as instance_id from {item__t} i
    left join {instance} x on x.id = i.holdings_record_id where x.id is not null""",
)
def _(t: Tables) -> DataFrame:
    instances = t["instance"].select(c("id").alias("instance_id"))
    return (
        t["item__t"]
        .join(instances, c("holdings_record_id") == c("instance_id"))
        .select(c("id").alias("item_id"), "instance_id")
    )


@_check("op_filter_bool", "select instance_id, contributor_name from {instance_contributors} where contributor_is_primary = true")
def _(t: Tables) -> DataFrame:
    return t["instance_contributors"].where(c("contributor_is_primary")).select("instance_id", "contributor_name")


@_check(
    "op_normalised_match",
    """select id from {instance__t} where lower(trim(concat('  ', title, ' '))) = lower(trim(index_title))
    or lower(trim(id)) = '7'""",
)
def _(t: Tables) -> DataFrame:
    typed = F.concat(F.lit("  "), "title", F.lit(" "))
    by_name = text.normalised(typed) == text.normalised(c("index_title"))
    return t["instance__t"].where(by_name | (text.normalised(c("id")) == "7")).select("id")


# --- joins ------------------------------------------------------------------------------------


@_check("op_join_inner", "select x.id, i.barcode from {check_in__t} x join {item__t} i on i.id = x.item_id")
def _(t: Tables) -> DataFrame:
    items = t["item__t"].select(c("id").alias("item_id"), "barcode")
    return t["check_in__t"].join(items, "item_id").select("id", "barcode")


@_check(
    "op_join_left_chain",
    """select i.id as item_id, l.name as location, h.call_number, n.title from {item__t} i
    left join {holdings_record__t} h on h.id = i.holdings_record_id
    left join {instance__t} n on n.id = h.instance_id left join {location__t} l on l.id = i.effective_location_id""",
)
def _(t: Tables) -> DataFrame:
    holdings = t["holdings_record__t"].select(c("id").alias("holdings_record_id"), "call_number", "instance_id")
    titles = t["instance__t"].select(c("id").alias("instance_id"), "title")
    chain = (
        t["item__t"]
        .select(c("id").alias("item_id"), "holdings_record_id", "effective_location_id")
        .join(holdings, "holdings_record_id", "left")
        .join(titles, "instance_id", "left")
    )
    named = lookup.with_name(chain, t["location__t"], "effective_location_id", "location")
    return named.select("item_id", "location", "call_number", "title")


@_check(
    "op_lookup_dims",
    """select i.id, m.name as material_type, p.name as loan_type from {item} i
    left join {material_type__t} m on m.id = i.materialtypeid
    left join {loan_type__t} p on p.id = i.temporaryloantypeid""",
)
def _(t: Tables) -> DataFrame:
    rows = lookup.with_name(t["item"], t["material_type__t"], "materialtypeid", "material_type")
    rows = lookup.with_name(rows, t["loan_type__t"], "temporaryloantypeid", "loan_type")
    return rows.select("id", "material_type", "loan_type")


@_check(
    "op_role_playing_dim",
    """select i.id, a.name as permanent, b.name as temporary, e.name as effective from {item} i
    left join {location__t} a on a.id = i.permanentlocationid left join {location__t} b on b.id = i.temporarylocationid
    left join {location__t} e on e.id = i.effectivelocationid""",
)
def _(t: Tables) -> DataFrame:
    rows = t["item"]
    for role in ("permanent", "temporary", "effective"):
        rows = lookup.with_name(rows, t["location__t"], f"{role}locationid", role)
    return rows.select("id", "permanent", "temporary", "effective")


@_check(
    "op_join_preagg",
    """select i.id as item_id, i.barcode, k.loans from {item__t} i
    join (select item_id, count(loan_id) as loans from {loans_items} group by item_id) k on k.item_id = i.id
    where k.loans >= 1""",
)
def _(t: Tables) -> DataFrame:
    loans = t["loans_items"].groupBy("item_id").agg(F.count("loan_id").alias("loans")).where("loans >= 1")
    return t["item__t"].select(c("id").alias("item_id"), "barcode").join(loans, "item_id")


@_check(
    "op_interval_join",
    f"""select r.item_id, r.clid, count(*) as loans
    from (select {json_sql("itemId")} as item_id, courselistingid as clid, {day_sql("__start")} as opens,
            {day_sql("__end")} as closes from {{coursereserves_reserves__}}) r
    join (select {json_sql("itemId")} as item_id, {day_sql("creation_date")} as day from {{loan__}}) n
        on n.item_id = r.item_id and n.day between r.opens and r.closes
    group by all""",
)
def _(t: Tables) -> DataFrame:
    loans, reserves = t["loan__"], t["coursereserves_reserves__"]
    item = documents.json_text(c("jsonb"), "itemId").alias("item_id")
    return spans.count_in_spans(
        loans.select(item, dates.local_day(loans, "creation_date").alias("day")),
        reserves.select(
            item,
            c("courselistingid").alias("clid"),
            dates.local_day(reserves, "__start").alias("opens"),
            dates.local_day(reserves, "__end").alias("closes"),
        ),
        on="item_id",
        by=["clid"],
        day="day",
        start="opens",
        end="closes",
        count="loans",
    )


@_check(
    "op_join_json_key",
    f"""select r.id, r.__id as version, i.barcode from {{coursereserves_reserves__}} r
    left join {{item__t}} i on i.id = lower({json_sql("itemId", "r.jsonb")})""",
)
def _(t: Tables) -> DataFrame:
    key = documents.uuid_norm(documents.json_text(c("jsonb"), "itemId")).alias("item_id")
    items = t["item__t"].select(c("id").alias("item_id"), "barcode")
    reserves = t["coursereserves_reserves__"].select("id", c("__id").alias("version"), key)
    return reserves.join(items, "item_id", "left").select("id", "version", "barcode")


@_check(
    "op_version_span",
    """select id, min(__start) as first_start, case when bool_and(__end is not null) then max(__end) end as last_end
    from {coursereserves_reserves__} group by id""",
)
def _(t: Tables) -> DataFrame:
    return history.version_span(t["coursereserves_reserves__"], "id")


@_check(
    "op_json_first_element",
    f"""select id, __start as started, coalesce({json_sql("instructorObjects[0].name")}, '') as instructor
    from {{coursereserves_courselistings__}}""",
)
def _(t: Tables) -> DataFrame:
    first = documents.json_text(c("jsonb"), "instructorObjects", 0, "name")
    return t["coursereserves_courselistings__"].select(
        "id", c("__start").alias("started"), F.coalesce(first, F.lit("")).alias("instructor")
    )


@_check(
    "op_unnest_ordinality",
    f"""select id, {json_sql("note", "n")} as note, {json_sql("itemNoteTypeId", "n")} as note_type,
    cast(ord as integer) as ordinality from {elements_sql("item", "notes", "id")}""",
)
def _(t: Tables) -> DataFrame:
    rows = unnest.unnest_json(t["item"].select("id", "jsonb"), "jsonb", "notes", notes.ITEM_NOTE, "n", "ordinality")
    return rows.select(
        "id", c("n.note").alias("note"), c("n.itemNoteTypeId").alias("note_type"), c("ordinality").cast("int")
    )


@_check(
    "op_anti_join",
    """select i.id from {item__t__} i where i.__current
    and not exists (select 1 from {check_in__t__} x where x.item_id = i.id)""",
)
def _(t: Tables) -> DataFrame:
    used = t["check_in__t__"].select(c("item_id").alias("id")).distinct()
    return history.current_rows(t["item__t__"]).join(used, "id", "left_anti").select("id")


# --- aggregation and distinct -----------------------------------------------------------------


@_check(
    "op_count_global",
    "select cast(count(id) as integer) as uses from {check_in__t__} where item_status_prior_to_check_in = 'Available'",
)
def _(t: Tables) -> DataFrame:
    available = t["check_in__t__"].where(c("item_status_prior_to_check_in") == "Available")
    return available.agg(F.count("id").cast("int").alias("uses"))


@_check("op_count_grouped", "select item_id, count(loan_id) as loans from {loans_items} group by item_id")
def _(t: Tables) -> DataFrame:
    return t["loans_items"].groupBy("item_id").agg(F.count("loan_id").alias("loans"))


@_check(
    "op_having",
    "select loan_id, count(item_id) as items from {loans_items} group by loan_id having count(item_id) > 1",
)
def _(t: Tables) -> DataFrame:
    return t["loans_items"].groupBy("loan_id").agg(F.count("item_id").alias("items")).where("items > 1")


@_check(
    "op_string_agg",
    """select instance_id, string_agg(contributor_name, ', ' order by contributor_name) as contributors
    from {instance_contributors} group by instance_id""",
)
def _(t: Tables) -> DataFrame:
    names = aggregates.text_counts(t["instance_contributors"], "instance_id", "contributor_name", "names")
    return names.select("instance_id", aggregates.joined_texts("names", "contributor_name", ", ").alias("contributors"))


@_check(
    "op_group_dedupe",
    """select i.barcode, x.item_status_prior_to_check_in as status from {check_in__t__} x
    left join {item__t} i on i.id = x.item_id group by i.barcode, x.item_status_prior_to_check_in""",
)
def _(t: Tables) -> DataFrame:
    items = t["item__t"].select(c("id").alias("item_id"), "barcode")
    uses = t["check_in__t__"].select("item_id", c("item_status_prior_to_check_in").alias("status")).distinct()
    return uses.join(items, "item_id", "left").select("barcode", "status").distinct()


@_check("op_distinct", "select distinct item_id, cast(loan_date as date) as day from {loans_items}")
def _(t: Tables) -> DataFrame:
    return t["loans_items"].select("item_id", F.to_date("loan_date").alias("day")).distinct()


@_check(
    "op_latest_per_key",
    """select id, courselistingid, __start as started, __id as version from {coursereserves_reserves__}
    qualify row_number() over (partition by id, courselistingid order by __start desc, __id desc) = 1""",
)
def _(t: Tables) -> DataFrame:
    versions = t["coursereserves_reserves__"].select("id", "courselistingid", "__start", "__id")
    latest = history.latest_per_key(versions, ["id", "courselistingid"])
    return latest.withColumnsRenamed({"__start": "started", "__id": "version"})


@_check("op_first_per_key", "select id, min(__start) as first_start from {coursereserves_reserves__} group by id")
def _(t: Tables) -> DataFrame:
    return history.version_span(t["coursereserves_reserves__"], "id").select("id", "first_start")


@_check(
    "op_last_end_per_key",
    """select id, __end as last_end from {coursereserves_reserves__}
    qualify row_number() over (partition by id order by __end desc nulls first, __id) = 1""",
)
def _(t: Tables) -> DataFrame:
    return history.version_span(t["coursereserves_reserves__"], "id").select("id", "last_end")


# --- sort -------------------------------------------------------------------------------------


@_check(
    "op_sort_nulls_last",
    "select publisher, date_of_publication, instance_id from {instance_publication} order by all nulls last",
)
def _(t: Tables) -> DataFrame:
    rows = t["instance_publication"].select("publisher", "date_of_publication", "instance_id")
    return contract.sorted_by(rows, "publisher", "date_of_publication", "instance_id")


@_check(
    "op_sort_mixed",
    """select publisher, instance_id, date_of_publication from {instance_publication}
    order by publisher desc nulls first, instance_id nulls last, date_of_publication nulls last""",
)
def _(t: Tables) -> DataFrame:
    rows = t["instance_publication"].select("publisher", "instance_id", "date_of_publication")
    return contract.sorted_by(rows, "-publisher", "instance_id", "date_of_publication")


# --- text -------------------------------------------------------------------------------------


@_check("op_concat_skip_null", "select id, concat(enumeration, ' ', volume, ' ', copy_number) as label from {item__t}")
def _(t: Tables) -> DataFrame:
    blank = F.lit(" ")
    label = text.skip_null_concat(c("enumeration"), blank, c("volume"), blank, c("copy_number"))
    return t["item__t"].select("id", label.alias("label"))


@_check("op_trim_lower", "select item_id, lower(trim(note)) as note from {item_notes}")
def _(t: Tables) -> DataFrame:
    return t["item_notes"].select("item_id", text.normalised(c("note")).alias("note"))


@_check("op_left", "select id, left(title, 11) as short_title from {instance__t}")
def _(t: Tables) -> DataFrame:
    return t["instance__t"].select("id", F.left("title", F.lit(11)).alias("short_title"))


@_check(
    "op_call_number",
    f"""select id, case when number is null then hrid else trim(concat(prefix, ' ', number,
        case when volume is not null then concat(' ', volume) end,
        case when copy <> '1' then concat(' c.', copy) end)) end as call_number
    from (select id, {json_sql("effectiveCallNumberComponents.prefix")} as prefix,
        {json_sql("effectiveCallNumberComponents.callNumber")} as number, {json_sql("volume")} as volume,
        {json_sql("copyNumber")} as copy, {json_sql("hrid")} as hrid from {{item}}) i""",
)
def _(t: Tables) -> DataFrame:
    schema = documents.text_fields(
        *("hrid", "volume", "copyNumber"), effectiveCallNumberComponents=documents.text_fields("prefix", "callNumber")
    )
    number = "doc.effectiveCallNumberComponents"
    shelf = text.call_number(
        c(f"{number}.prefix"), c(f"{number}.callNumber"), c("doc.volume"), c("doc.copyNumber"), c("doc.hrid")
    )
    return t["item"].withColumn("doc", F.from_json("jsonb", schema)).select("id", shelf.alias("call_number"))


@_check(
    "op_link_case",
    """select id, case when hrid like 'b%' then concat('https://catalog.example.org/Record/', left(hrid, 8))
    else concat('https://catalog.example.org/Record/', hrid) end as link from {instance__t}""",
)
def _(t: Tables) -> DataFrame:
    return t["instance__t"].select("id", text.record_link(c("hrid"), inventory.RECORD_URL).alias("link"))


# --- conditions, dates, casts -----------------------------------------------------------------


@_check(
    "op_case",
    """select id, case when volume is null then 'single' when copy_number <> '1' then 'copy' else 'set' end as kind
    from {item__t}""",
)
def _(t: Tables) -> DataFrame:
    kind = F.when(c("volume").isNull(), "single").when(c("copy_number") != "1", "copy").otherwise("set")
    return t["item__t"].select("id", kind.alias("kind"))


@_check(
    "op_clamp_dates",
    """select id, __id as version,
    case when __start > timestamp '1998-01-01' then __start else timestamp '1998-01-01' end as opens,
    case when timestamp '1999-06-30' < __end then timestamp '1999-06-30' else __end end as closes
    from {coursereserves_reserves__}""",
)
def _(t: Tables) -> DataFrame:
    opened, closed = (F.lit(d).cast("timestamp_ntz") for d in (dt.date(1998, 1, 1), dt.date(1999, 6, 30)))
    return t["coursereserves_reserves__"].select(
        "id",
        c("__id").alias("version"),
        dates.later_of(c("__start"), opened).alias("opens"),
        dates.earlier_of(closed, c("__end")).alias("closes"),
    )


@_check(
    "op_coalesce",
    """select id, coalesce(enumeration, '') as enumeration, coalesce(cast(copy_number as bigint), 0) as copies
    from {item__t}""",
)
def _(t: Tables) -> DataFrame:
    copies = F.coalesce(c("copy_number").cast("bigint"), F.lit(0))
    return t["item__t"].select(
        "id", F.coalesce("enumeration", F.lit("")).alias("enumeration"), copies.alias("copies")
    )


@_check("op_local_date", f"select id, {day_sql('creation_date')} as day from {{loan__}}")
def _(t: Tables) -> DataFrame:
    loans = t["loan__"]
    return loans.select("id", dates.local_day(loans, "creation_date").alias("day"))


@_check(
    "op_json_timestamp",
    f"""select id, cast({json_sql("metadata.updatedDate")} as timestamptz) at time zone 'UTC' as updated_date
    from {{instance}}""",
)
def _(t: Tables) -> DataFrame:
    updated = documents.json_instant(documents.json_text(c("jsonb"), "metadata", "updatedDate"))
    return t["instance"].select("id", updated.alias("updated_date"))


@_check("op_cast_date", "select id, cast(cataloged_date as date) as cataloged_date from {instance__t}")
def _(t: Tables) -> DataFrame:
    return t["instance__t"].select("id", c("cataloged_date").cast("date").alias("cataloged_date"))


@_check(
    "op_cast_bool",
    f"""select id, cast({json_sql("discoverySuppress")} as boolean) as discovery_suppress,
    coalesce(cast({json_sql("discoverySuppress")} as boolean), false) as suppressed from {{item}}""",
)
def _(t: Tables) -> DataFrame:
    value = documents.json_text(c("jsonb"), "discoverySuppress")
    return t["item"].select(
        "id",
        documents.text_bool(value).alias("discovery_suppress"),
        documents.flag(value).alias("suppressed"),
    )


@_check("op_uuid_norm", f"select id, lower({json_sql('matchKey')}) as match_key from {{instance}}")
def _(t: Tables) -> DataFrame:
    key = documents.uuid_norm(documents.json_text(c("jsonb"), "matchKey"))
    return t["instance"].select("id", key.alias("match_key"))


# --- documents --------------------------------------------------------------------------------


@_check("op_json_text", f"select id, {json_sql('volume')} as volume, {json_sql('absent')} as absent from {{item}}")
def _(t: Tables) -> DataFrame:
    return t["item"].select(
        "id", *[documents.json_text(c("jsonb"), key).alias(key) for key in ("volume", "absent")]
    )


@_check(
    "op_json_path",
    f"""select id, __id as version, {json_sql("copiedItem.title")} as title, {json_sql("copiedItem.isbn")} as isbn
    from {{coursereserves_reserves__}}""",
)
def _(t: Tables) -> DataFrame:
    return t["coursereserves_reserves__"].select(
        "id",
        c("__id").alias("version"),
        documents.json_text(c("jsonb"), "copiedItem", "title").alias("title"),
        documents.json_text(c("jsonb"), "copiedItem", "isbn").alias("isbn"),
    )


@_check(
    "op_json_wide",
    f"""select id, {json_sql("accessionNumber")} as accession_number, {json_sql("copyNumber")} as copy_number,
    {json_sql("status.name")} as status_name, {json_sql("status.date")} as status_date,
    {json_sql("metadata.updatedByUserId")} as updated_by_user_id, {json_sql("numberOfPieces")} as number_of_pieces,
    {json_sql("effectiveCallNumberComponents.prefix")} as prefix from {{item}}""",
)
def _(t: Tables) -> DataFrame:
    return (
        t["item"]
        .withColumn("doc", F.from_json("jsonb", derived.ITEM_DOCUMENT))
        .select(
            "id",
            c("doc.accessionNumber").alias("accession_number"),
            c("doc.copyNumber").alias("copy_number"),
            c("doc.status.name").alias("status_name"),
            c("doc.status.date").alias("status_date"),
            c("doc.metadata.updatedByUserId").alias("updated_by_user_id"),
            c("doc.numberOfPieces").alias("number_of_pieces"),
            c("doc.effectiveCallNumberComponents.prefix").alias("prefix"),
        )
    )


@_check(
    "op_explode_struct",
    f"""select id, {json_sql("identifierTypeId", "n")} as id_type, {json_sql("value", "n")} as value
    from {elements_sql("instance", "identifiers", "id")}""",
)
def _(t: Tables) -> DataFrame:
    element = documents.text_fields("identifierTypeId", "value")
    rows = unnest.unnest_json(t["instance"].select("id", "jsonb"), "jsonb", "identifiers", element, "i")
    return rows.select("id", c("i.identifierTypeId").alias("id_type"), c("i.value").alias("value"))


@_check("op_json_array_text", f"select id, {array_sql('statisticalCodeIds')} as codes from {{instance}}")
def _(t: Tables) -> DataFrame:
    return t["instance"].select("id", documents.database_text(c("jsonb"), "statisticalCodeIds").alias("codes"))


_IDENTIFIER = """'{{"value": ' || json_extract(e, '$.value') || ', "identifierTypeId": ' || json_extract(e, '$.identifierTypeId') || '}}'"""


@_check("op_json_document_text", f"select id, {array_sql('identifiers', each=_IDENTIFIER)} as identifiers from {{instance}}")
def _(t: Tables) -> DataFrame:
    """Objects in an array: shorter keys come first."""
    return t["instance"].select("id", documents.database_text(c("jsonb"), "identifiers", depth=2).alias("identifiers"))


@_check(
    "op_sort_collated",
    """select item_id, note from {item_notes}
    order by note collate en nulls last, item_id collate en nulls last, note nulls last, item_id nulls last""",
)
def _(t: Tables) -> DataFrame:
    with contract.collated("UNICODE"):
        return contract.sorted_by(t["item_notes"], "note", "item_id")


# --- layouts and summaries that reports read instead -------------------------------------------


@_check("op_reserves_by_bucket", REPORT_SQL["r05_course_term_circ_stats"])
def _(t: Tables) -> DataFrame:
    """The term report on histories that lie in buckets of their key."""
    schema = f"histories_{uuid.uuid4().hex}"
    t.spark.sql(f"create schema {schema} location '{shared_folder(t.spark)}/{schema}'")
    names = ["coursereserves_courselistings__", "coursereserves_courses__", "coursereserves_reserves__"]
    return REPORT_QUERIES["r05_course_term_circ_stats"](layout.store_histories(t, schema, 8, names))


_CHECKOUTS_SQL = f"""select {json_sql("itemId")} as item_id, {day_sql("creation_date")} as day, count(*) as checkouts
    from {{loan__}} where {json_sql("action")} in ('checkedOut', 'renewed') group by all"""


@_check("op_checkouts_daily", _CHECKOUTS_SQL)
def _(t: Tables) -> DataFrame:
    return courses.checkouts_daily(t)


@_check("op_loans_daily", "select item_id, cast(loan_date as date) as day, count(*) as loans from {loans_items} group by all")
def _(t: Tables) -> DataFrame:
    return courses.loans_daily(t)


@_check("op_daily_refresh", _CHECKOUTS_SQL)
def _(t: Tables) -> DataFrame:
    """Daily counts stored when the loans of some days had not come or were wrong, and those days counted anew."""
    root = f"{shared_folder(t.spark)}/{uuid.uuid4().hex}"
    days = dt.date(1995, 3, 1), dt.date(1995, 9, 30)
    inside = dates.local_day(t["loan__"], "creation_date").between(*days)
    older = t["loan__"].where(~inside).unionByName(t["loan__"].where(inside & (F.col("id").like("%1"))))
    upkeep.store_daily(t.having({"loan__": older}), root, ["checkouts_daily"])
    return upkeep.refresh_daily(t, root, *days)["checkouts_daily"]


def _from_daily(t: Tables) -> Tables:
    return t.having({name: make(t) for name, make in upkeep.DAILY.items()}).without("loan__", "loans_items")


for _name, _report in (("op_course_stats_from_daily", "r01_circ_stats_course_reserves"), ("op_term_stats_from_daily", "r05_course_term_circ_stats"), ("op_permanent_stats_from_daily", "r12_perm_reserve_circ_stats")):
    _check(_name, REPORT_SQL[_report])(lambda t, report=_report: REPORT_QUERIES[report](_from_daily(t)))
