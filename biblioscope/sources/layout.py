"""Relations stored by key: versions of a record lie together for steps by record, and rows of a key for lookups.

A history is written as a catalog table in buckets of its key, sorted by it within each.  Spark knows this from
the catalog: the span or the latest version of every record, and joins of such results, run bucket by bucket.
What a join on another key brings still moves.  The least number of buckets is a parameter, a multiple of the
cores; it is multiplied until a bucket fits a task, which sorts it.  Tables that are joined should have the same
number, so histories stored together do.  A record with very many versions makes its bucket long; latest versions
cut it to one before anything else happens, spans add it up.
"""

from __future__ import annotations

import math

from biblioscope.sources.tables import Tables

#: Rows that a bucket of the longest history holds on average, at most.
BUCKET_ROWS = 500_000

#: Relations that reports look up by a key.
LOOKUPS = {"item__t": "barcode", "item__t__": "barcode", "check_in__t": "item_id", "check_in__t__": "item_id"}

#: Histories by their key.
KEYS = {
    "coursereserves_courselistings__": "id",
    "coursereserves_courses__": "id",
    "coursereserves_reserves__": "id",
    "check_in__t__": "id",
    "holdings_record__t__": "id",
    "instance__": "id",
    "instance__t__": "id",
    "item__": "id",
    "item__t__": "id",
}


def store_histories(tables: Tables, schema: str, buckets: int, names: list[str] | None = None, most: int = BUCKET_ROWS) -> Tables:
    """Write the histories that ``tables`` have, or those named, into a schema of the catalog; the returned tables read them there.

    There are ``buckets`` of each, or the multiple of it that leaves no more than ``most`` rows of the longest in a bucket.
    A table that is there already is an error: histories are added to by whoever writes the warehouse.
    """
    spark = tables.spark
    there = [name for name in (names or KEYS) if tables.get(name) is not None]
    longest = max((tables[name].count() for name in there), default=0)
    buckets *= max(1, math.ceil(longest / (buckets * most)))
    for name in there:
        key = KEYS.get(name, "id")
        tables[name].repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).saveAsTable(f"{schema}.{name}")
    stored = Tables.catalog(spark, {name: f"{schema}.{name}" for name in there})
    return tables.having({name: stored[name] for name in there}, {name: stored.clustered(name) for name in there})


def store_lookups(tables: Tables, root: str, partitions: int | None = None, **options: str) -> Tables:
    """Write the relations that reports look up by barcode or item as Parquet below ``root``, sorted by that key and with
    Bloom filters of it; the returned tables read them there.

    A lookup then skips the row groups whose bounds, or whose Bloom filter, rule the key out.  A relation that is
    there already is an error.  ``options`` go to the Parquet writer.
    """
    frames = {}
    for name, key in LOOKUPS.items():
        frame = tables.get(name)
        if frame is None:
            continue
        # Behind the key all columns, so that the rows of one hot key may lie in several files.
        order = [key, *[c for c in frame.columns if c != key]]
        split = [partitions, *order] if partitions else order
        blooms = {f"parquet.bloom.filter.enabled#{key}": "true", **options}
        frame.repartitionByRange(*split).sortWithinPartitions(*order).write.options(**blooms).parquet(f"{root}/{name}")
        frames[name] = tables.spark.read.parquet(f"{root}/{name}")
    return tables.having(frames)
