"""Stored pages as a transport: what a paged interface once answered can be asked again, by any reader of ``remote``."""

from __future__ import annotations

import io
import json
from itertools import chain, islice

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.operators.store import cut, discard, write_text
from foliant.operators.tables import shuffle_key
from foliant.sources.remote import Response


#: Bytes of pages that share a file, about; a page of more bytes has a file of its own.
SHELF_BYTES = 1 << 20


def keep_pages(df: DataFrame, key: str, prefix: str, path: str, size: int) -> None:
    """Store rows as pages of ``size`` by ``prefix``, in an order by a hash of ``key``, and how many there are of each.

    Pages that follow each other share a file, in a folder with the number of the first of them: there are as many files as the bytes need, however small a page is.
    """
    spark, order = df.sparkSession, shuffle_key(0, "orden", F.col(key))
    rows = df.select(F.col(prefix).cast("string").alias("__prefix"), F.substring(order, 1, 4).alias("__slice"), order.alias("__order"), F.col(key).cast("string").alias("__key"), F.to_json(F.struct(*df.columns)).alias("value"))
    # a row's place in its prefix: those in the slices of the order before its own, and before it in its slice
    sizes = rows.groupBy("__prefix", "__slice").agg(F.count("*").alias("__c"), F.sum(F.octet_length("value") + 1).alias("__bytes"))
    whole = Window.partitionBy("__prefix")  # 65,536 slices at most
    before = (F.sum("__c").over(whole.orderBy("__slice")) - F.col("__c")).alias("__before")
    total, shelf = F.sum("__c").over(whole), F.greatest(F.lit(1), F.floor(SHELF_BYTES * F.sum("__c").over(whole) / (F.sum("__bytes").over(whole) * size)))
    slices = cut(sizes.select("__prefix", "__slice", before, total.alias("__total"), shelf.cast("long").alias("__shelf")), "slices")
    inside = F.row_number().over(Window.partitionBy("__prefix", "__slice").orderBy("__order", "__key")) - 1
    placed = rows.join(slices.drop("__total"), ["__prefix", "__slice"]).withColumn("__at", F.col("__before") + inside)
    shelved = placed.select(F.col("__prefix").alias("prefix"), (F.floor(F.col("__at") / (F.col("__shelf") * size)) * F.col("__shelf")).alias("page"), F.col("__at").alias("at"), "value")
    shelved.repartition("prefix", "page").sortWithinPartitions("prefix", "page", "at").select("prefix", "page", "value").write.partitionBy("prefix", "page").text(f"{path}/pages")
    prefixes = slices.select("__prefix", "__total", "__shelf").distinct().collect()  # one row per prefix
    discard(slices)
    write_text(spark, f"{path}/about.json", json.dumps({"size": size, "totals": {r["__prefix"]: r["__total"] for r in prefixes}, "shelves": {r["__prefix"]: r["__shelf"] for r in prefixes}}))


def answer(method: str, url: str, body: dict | None, headers: dict) -> Response:
    """The rows from ``start`` on of the prefix in ``mainSearch``; the url is the folder of ``keep_pages``. 404 for what isn't there, 503 while a file ``busy`` is."""
    fs, base = pafs.FileSystem.from_uri(url)
    there = lambda p: fs.get_file_info(p).type != pafs.FileType.NotFound
    if body is None or not there(f"{base}/about.json"):
        return Response(404, b"")
    if there(f"{base}/busy"):
        return Response(503, b"", {"Retry-After": "0"})
    about, prefix = json.loads(fs.open_input_stream(f"{base}/about.json").read()), body["mainSearch"]
    start, length, total, shelf = body["start"], body["length"], about["totals"].get(prefix, 0), about["shelves"].get(prefix, 1)
    rows, end, held = [], min(start + length, total), about["size"] * shelf
    for n in range(start // held, -(-end // held)):
        files = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(f"{base}/pages/prefix={prefix}/page={n * shelf}")) if f.base_name.endswith(".txt"))
        lines = chain.from_iterable(io.BufferedReader(fs.open_input_stream(f), 1 << 16) for f in files)
        rows += [line.rstrip(b"\n") for line in islice(lines, max(0, start - n * held), end - n * held)]  # nothing behind the window is read
    return Response(200, b'{"documentos":[%s],"recordsFiltered":%d}' % (b",".join(rows), total), {"Content-Type": "application/json"})
