"""Scans, writes and the streaming ingest: each job writes the given tables to the shared folder and reads them back."""

from pyspark.sql import functions as F

from tillbook.catalog.base import EVENTS, HEADS, RAW_LINES, big, query
from tillbook.operators.core import keep_one
from tillbook.session import fresh_path, stage
from tillbook.sources import inbox as ib, readers as rd, versions as vt, writers as wr
from tillbook.sources.csv_files import scan_csv_union
from tillbook.sources.keyed_appends import KeyedAppends
from tillbook.streaming.ingest import StatefulIngest, ingest_files

COLS = ["order_id", "sale_date", "ym", "store", "platform", "source", "order_amount"]
H = HEADS + ", h AS (SELECT order_id, CAST(sale_date AS VARCHAR) AS sale_date, ym, store, platform, source, order_amount FROM heads)"
C = "order_id, sale_date, ym, store, platform, source, order_amount"


def slim(t):
    return t.heads.select(*COLS)


def of(df, *sources):
    return df.where(F.col("source").isin(*sources))


def bumped(df, by=1):
    return df.withColumn("order_amount", F.col("order_amount") + by)


def bumped_amounts(df):
    return df.withColumn("amount", F.col("amount") + 1)


def write_manifest(spark, root, run, missing=False):
    """The manifest of the files under a run's folder, as the sender writes it; ``missing`` names bytes that are not there."""
    import json

    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root}/{run}").select("path", "length").collect()
    names = {r.path.split(f"/{run}/", 1)[1]: r.length + missing for r in listed}
    body = json.dumps({"run": run, "files": {f"{run}/{n}": {"rel": n, "size": size} for n, size in names.items()}})
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest_{run}.json")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(body.encode()))
    out.close()


def stored(t, df, by=()):
    path = fresh_path(t.spark, "table")
    wr.write_table(df, path, by)
    return path


def back(t, path, like):
    return wr.read_table(t.spark, path, like).select(*like.columns)


# -- scans --------------------------------------------------------------------


@query("scan_parquet_union", f"WITH {H} SELECT order_id, store, CASE WHEN source <> 'F' THEN order_amount END AS order_amount, CAST(NULL AS VARCHAR) AS memo, CASE source WHEN 'F' THEN 'old' ELSE 'new' END AS part FROM h")
def scan_parquet_union(t):
    root = fresh_path(t.spark, "union")
    wr.write_table(of(slim(t), "F").select("order_id", "store"), f"{root}/old")
    wr.write_table(of(slim(t), "O", "P").select("order_id", "store", "order_amount"), f"{root}/new")
    out = rd.scan_parquet_union(t.spark, [f"{root}/old", f"{root}/new"], ["order_id", "store", "order_amount", "memo"], "file")
    return out.withColumn("part", F.regexp_extract("file", r"/(old|new)/[^/]+$", 1)).drop("file")


def exported(header, charset):
    """Lines of an export as bytes, each file led by the header."""

    def run(batches):
        import pyarrow as pa

        yield pa.RecordBatch.from_pydict({"value": [header.encode(charset)]})
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"value": [x.encode(charset) for x in batch.column(0).to_pylist()]})

    return run


@query("scan_csv_union", f"WITH {H} SELECT order_id, CASE WHEN source = 'P' THEN '취소' ELSE '정상' END AS kind, CASE WHEN platform <> 'MACHINERY' THEN 'a ' || chr(34) || platform || chr(34) || ', ' || CASE WHEN source = 'P' THEN chr(10) ELSE ' ' END || store END AS memo, CAST(NULL AS VARCHAR) AS extra, CASE source WHEN 'F' THEN 'utf' WHEN 'O' THEN 'kr' ELSE 'utf2' END AS part FROM h")
def csv_union(t):
    # Files in two encodings, with the columns in either order; lines of one platform are short by a field, memos hold
    # quotes, commas and line feeds; one folder holds a file with a row too long, which is left out.
    root = fresh_path(t.spark, "csv")
    memo = F.when(F.col("platform") == "MACHINERY", F.lit(None)).otherwise(F.concat(F.lit('a "'), "platform", F.lit('", '), F.when(F.col("source") == "P", "\n").otherwise(" "), "store"))
    df = slim(t).select("order_id", F.when(F.col("source") == "P", "취소").otherwise("정상").alias("kind"), memo.alias("memo"), "source")
    quoted = F.concat(F.lit('"'), F.replace("memo", F.lit('"'), F.lit('""')), F.lit('"'))

    def export(source, name, fields, charset="utf-8"):
        line = F.concat_ws(",", *fields, quoted)  # without a memo a line is short
        rows = df.where(F.col("source") == source).select(line.alias("value"))
        encoded = rows.mapInArrow(exported(",".join([*fields, "memo"]), charset), "value binary")
        encoded.select(F.col("value").cast("string")).write.text(f"{root}/{name}")

    export("F", "utf", ["order_id", "kind"])
    export("O", "kr", ["kind", "order_id"], "euc-kr")
    export("P", "utf2", ["order_id", "kind"])
    odd = t.spark.createDataFrame([("order_id,kind",), ("1,a",), ("2,b,c",)], "value string")
    odd.coalesce(1).write.option("compression", "none").text(f"{root}/odd")
    out = scan_csv_union(t.spark, [f"{root}/{n}" for n in ("utf", "kr", "utf2", "odd")], ["order_id", "kind", "memo", "extra"], source_col="file", on_error="skip")
    return out.withColumn("part", F.regexp_extract("file", r"/(utf|kr|utf2|odd)/[^/]+$", 1)).drop("file")


@query("scan_partitioned", f"WITH {H} SELECT order_id, order_amount, platform, ym FROM h WHERE platform = 'BUILDING' AND ym IN ('1998-01', '1999-05')")
def scan_partitioned(t):
    path = stored(t, slim(t).select("order_id", "order_amount", "platform", "ym"), ["platform", "ym"])
    return rd.scan_partitioned(t.spark, path, platform="BUILDING", ym=["1998-01", "1999-05"])


@query("latest_file_per_name", f"WITH {H} SELECT order_id, order_amount + CASE source WHEN 'F' THEN 1 ELSE 0 END AS order_amount FROM h")
def latest_file_per_name(t):
    import time

    root = fresh_path(t.spark, "drop")
    df = slim(t).select("order_id", "order_amount", "source")
    wr.write_table(of(df, "F").drop("source"), f"{root}/sales_1")
    wr.write_table(of(df, "O", "P").drop("source"), f"{root}/other_1")
    time.sleep(1.1)  # file times have second precision on some stores
    wr.write_table(bumped(of(df, "F")).drop("source"), f"{root}/sales_2")
    name = F.regexp_extract("path", r"/([a-z]+)_\d+/[^/]+$", 1)
    return t.spark.read.parquet(*rd.latest_file_per_name(t.spark, [root], name))


@query("jdbc_table_read", f"WITH {H} SELECT order_id, store, order_amount FROM h WHERE platform = 'BUILDING' AND source IN ('F', 'P') ORDER BY order_amount DESC, order_id")
def jdbc_table_read(t):
    return rd.table_read(slim(t), ["order_id", "store", "order_amount"], {"platform": "BUILDING", "source": ["F", "P"]}, ["-order_amount", "order_id"])


@query("flow_inbox_merge", f"""WITH {HEADS}, {RAW_LINES}, {EVENTS},
  day AS (SELECT store, CAST(sale_date AS VARCHAR) AS d, source, sum(order_amount) AS amount FROM heads WHERE source IN ('F', 'O') GROUP BY ALL),
  lines AS (SELECT order_id, l_linenumber, l_partkey, qty, source, platform FROM heads JOIN raw_lines ON l_orderkey = o_orderkey WHERE source = 'F')
  SELECT 'daily' AS dataset, store || '|' || d AS id, {big('amount')} AS amount FROM day QUALIFY row_number() OVER (PARTITION BY store, d ORDER BY source DESC) = 1
  UNION ALL SELECT 'orders', order_id || '|' || l_linenumber || '|' || l_partkey, qty FROM lines
    WHERE platform <> 'BUILDING' OR l_linenumber <> 2 OR NOT EXISTS (SELECT 1 FROM lines x WHERE x.order_id = lines.order_id AND x.l_linenumber <> 2)
  UNION ALL SELECT 'changes', store || '|' || event_type || '|' || d || '|' || amount, count(DISTINCT 1) FROM ev WHERE event_type IN ('click', 'purchase') GROUP BY ALL""")
def flow_inbox_merge(t):
    """Three runs of three datasets: by key, by order and by signature. The third names a size that has not arrived, so it waits."""
    from datetime import datetime, timedelta

    root, ledger = fresh_path(t.spark, "inbox"), fresh_path(t.spark, "ledger")
    heads = t.heads.select("o_orderkey", "order_id", F.col("sale_date").cast("string").alias("d"), "ym", "store", "platform", "source", "order_amount")
    daily = heads.groupBy("store", "d", "ym", "source").agg(F.sum("order_amount").alias("amount"))
    lines = heads.join(t.raw_lines, F.col("l_orderkey") == F.col("o_orderkey")).select("order_id", "ym", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_partkey", "qty", "platform", "source")
    log = t.events.select("store", "event_type", F.col("d").cast("string").alias("d"), F.date_format("d", "yyyy-MM").alias("ym"), "amount")
    of_type = lambda *types: log.where(F.col("event_type").isin(*types))
    runs = {
        "r1": {"daily": of(daily, "F"), "orders": of(lines, "F"), "changes": of_type("click")},
        # Days of the other source, some orders again without their second line, and the clicks a second time.
        "r2": {"daily": of(daily, "O"), "orders": of(lines, "F").where("platform = 'BUILDING' AND l_linenumber <> 2"), "changes": of_type("click", "purchase")},
        "r3": {"daily": bumped_amounts(of(daily, "F")), "orders": of(lines, "P"), "changes": of_type("view", "error")},
    }
    for run, parts in runs.items():
        for name, rows in parts.items():
            wr.write_table(rows, f"{root}/{run}/{name}")
        write_manifest(t.spark, root, run, missing=run == "r3")
    tables = {name: vt.new_table(t.spark, rows.schema, ["ym"]) for name, rows in runs["r1"].items()}
    datasets = {
        "daily": ib.Dataset(tables["daily"], ib.keyed(["store", "d"], ["amount"])),
        "orders": ib.Dataset(tables["orders"], ib.units(["order_id"])),
        "changes": ib.Dataset(tables["changes"], ib.by_signature(["store", "event_type", "d", "amount"], ["ym"])),
    }
    for _ in range(2):  # a second call finds nothing to do
        ib.merge_inbox(t.spark, root, datasets, ledger, datetime.now() + timedelta(hours=1))
    text = lambda *c: F.concat_ws("|", *c)
    return (
        tables["daily"].read().select(F.lit("daily").alias("dataset"), text("store", "d").alias("id"), "amount")
        .unionByName(tables["orders"].read().select(F.lit("orders").alias("dataset"), text("order_id", "l_linenumber", "l_partkey").alias("id"), F.col("qty").alias("amount")))
        .unionByName(tables["changes"].read().select(F.lit("changes").alias("dataset"), text("store", "event_type", "d", "amount").alias("id"), F.lit(1).cast("long").alias("amount")))
    )


# -- writes -------------------------------------------------------------------


@query("append_unique", f"WITH {H} SELECT {C.replace('order_amount', "CASE WHEN source = 'P' THEN order_amount + 1 ELSE order_amount END AS order_amount")} FROM h")
def append_unique(t):
    df = slim(t)
    path = stored(t, of(df, "F", "O"))
    wr.append_unique(t.spark, path, bumped(of(df, "O", "P")), ["order_id"])
    return back(t, path, df)


@query("append_unique_counts", f"WITH {H} SELECT count(*) FILTER (source = 'P') AS inserted, count(*) FILTER (source = 'O') AS duplicated, count(*) FILTER (source <> 'F') AS total FROM h")
def append_unique_counts(t):
    df = slim(t)
    return wr.append_unique(t.spark, stored(t, of(df, "F", "O")), of(df, "O", "P"), ["order_id"])


NO_MONTH = "CASE WHEN platform = 'BUILDING' THEN NULL ELSE ym END AS ym"


@query("upsert_keep_last", f"WITH {H} SELECT {C.replace('ym', NO_MONTH).replace('order_amount', "CASE WHEN source <> 'F' THEN order_amount + 1 ELSE order_amount END AS order_amount")} FROM h")
def upsert_keep_last(t):
    # Orders of one platform have no month: their partition is the null one.
    df = slim(t).withColumn("ym", F.when(F.col("platform") != "BUILDING", F.col("ym")))
    path = stored(t, of(df, "F", "O"), ["ym"])
    new = bumped(of(df, "O", "P"))
    wr.upsert(t.spark, path, new.unionByName(bumped(of(df, "O"), -1)), ["order_id"], ["ym"], [F.col("order_amount").desc()])
    return back(t, path, df)


@query("replace_by_key", f"""WITH {H}, k AS (SELECT DISTINCT sale_date, store FROM h WHERE source = 'P') SELECT {C} FROM h WHERE source <> 'P' AND (sale_date, store) NOT IN (SELECT (sale_date, store) FROM k)
  UNION ALL SELECT {C.replace('order_amount', 'order_amount + 1')} FROM h WHERE source = 'P'""")
def replace_by_key(t):
    df = slim(t)
    path = stored(t, of(df, "F", "O"), ["ym"])
    new = bumped(of(df, "P"))
    old = wr.touched(wr.read_table(t.spark, path, df), new, ["ym"])
    wr.replace_partitions(wr.replace_by_key(old, new, ["sale_date", "store"]), path, ["ym"])
    return back(t, path, df)


@query("merge_by_row_signature", f"WITH {EVENTS} SELECT store, CAST(d AS VARCHAR) AS d, event_type, k, min(event_id) AS event_id FROM ev GROUP BY store, d, event_type, k")
def merge_by_row_signature(t):
    ev = t.events.select("event_id", "store", "d", "event_type", "k")
    path = stored(t, ev.where(F.col("event_type") != "error"))
    new = ev.where(F.col("event_type").isin("error", "signup"))
    out = wr.merge_by_signature(wr.read_table(t.spark, path, ev), new, ["store", "d", "event_type", "k"], ["event_id"])
    return back(t, stored(t, out), ev)


@query("source_aware_replace", f"""WITH {H} SELECT {C} FROM h WHERE NOT (source = 'P' AND store IN ('NATION_1', 'NATION_2')) UNION ALL SELECT {C.replace('order_amount', 'order_amount + 5')} FROM h
  WHERE source = 'P' AND store IN ('NATION_1', 'NATION_2') AND platform <> 'BUILDING'""")
def source_aware_replace(t):
    df = slim(t)
    path = stored(t, df, ["ym"])
    stores = ["NATION_1", "NATION_2"]
    new = bumped(of(df, "P").where(F.col("store").isin(stores) & (F.col("platform") != "BUILDING")), 5)
    old = wr.read_table(t.spark, path, df)
    if not wr.same_keys(of(old, "P").where(F.col("store").isin(stores)), new, "order_id"):
        # Days on which the source has nothing any more must change too, so the whole slice's partitions are rewritten.
        months = old.where((F.col("source") == "P") & F.col("store").isin(stores)).select("ym").unionByName(new.select("ym"))
        wr.replace_partitions(wr.source_aware_replace(wr.touched(old, months, ["ym"]), new, "P", "order_id", ["order_amount"], stores), path, ["ym"])
    return back(t, path, df)


@query("source_priority_override", f"""WITH {H}, k AS (SELECT DISTINCT sale_date, store, platform FROM h WHERE source = 'O') SELECT {C} FROM h WHERE (sale_date, store, platform) NOT IN (SELECT (sale_date, store, platform) FROM k)
  UNION ALL SELECT {C.replace('order_amount', 'order_amount + 7')} FROM h WHERE source = 'O'""")
def source_priority_override(t):
    df = slim(t)
    path = stored(t, df, ["ym"])
    better = bumped(of(df, "O"), 7)
    old = wr.touched(wr.read_table(t.spark, path, df), better, ["ym"])
    wr.replace_partitions(wr.source_priority_override(old, better), path, ["ym"])
    return back(t, path, df)


@query("partitioned_write", f"""WITH {H} SELECT {C.replace('order_amount', "CASE WHEN source = 'O' THEN order_amount + 1 WHEN source = 'P' THEN order_amount ELSE order_amount END AS order_amount")},
  CASE source WHEN 'O' THEN 2 WHEN 'P' THEN 1 ELSE 1 END AS collected_at FROM h""")
def partitioned_write(t):
    df = slim(t).withColumn("collected_at", F.lit(1))
    path = stored(t, df, ["platform", "ym"])
    # Orders of source O were collected again later, those of P come from an older file.
    new = bumped(of(df, "O")).withColumn("collected_at", F.lit(2)).unionByName(bumped(of(df, "P"), 9).withColumn("collected_at", F.lit(0)))
    wr.partitioned_write(t.spark, path, new, ["order_id"], ["platform", "ym"], "collected_at")
    return back(t, path, df)


@query("versioned_partition_writes", f"""WITH {H} SELECT {C.replace('order_amount', "CASE WHEN source = 'O' THEN order_amount + 1 ELSE order_amount END AS order_amount")},
  CASE WHEN source = 'O' THEN 2 ELSE 1 END AS collected_at FROM h WHERE source <> 'P' AND sale_date >= '1996-01-01'""")
def versioned_partition_writes(t):
    """Collected orders, a later collection merged, one source purged and old days pruned, each published as a version; a writer that comes second starts anew."""
    df = slim(t).withColumn("collected_at", F.lit(1))
    table = vt.new_table(t.spark, df.schema, ["ym"])
    table.replace(df)
    again = bumped(of(df, "O")).withColumn("collected_at", F.lit(2))
    latest = lambda old, new: keep_one(old.unionByName(new), ["order_id"], [F.col("collected_at").desc()])
    table.merge(again, latest)
    try:
        table.replace(bumped(df, 1000), base=1)  # made from the first version, which is no longer the last
    except vt.Conflict:
        table.rewrite(lambda rows: rows.where(F.col("source") != "P"))
    old = table.read().where(F.col("sale_date") < "1996-01-01")
    table.replace(table.read().where(F.col("sale_date") >= "1996-01-01").join(old.select("ym").distinct(), "ym", "left_semi"), emptied=old)
    return table.read().select(*df.columns)


@query("append_unique_indexed", f"WITH {H} SELECT {C.replace('order_amount', "CASE WHEN source = 'P' THEN order_amount + 1 ELSE order_amount END AS order_amount")} FROM h")
def append_unique_indexed(t):
    """Two sources, then all orders with other amounts: only those of the third source are new."""
    df = slim(t)
    table = KeyedAppends(vt.new_table(t.spark, df.schema, ["ym"]), ["order_id"])
    for part in (of(df, "F"), of(df, "O"), bumped(df)):
        table.append(part)
    return table.table.read().select(*COLS)


@query("append_unique_files_read", f"WITH {H}, d AS (SELECT count(*) AS n FROM h WHERE sale_date >= '1998-01-01'), e AS (SELECT count(*) AS n FROM h) SELECT {big('0')} AS inserted, d.n AS duplicated, d.n AS total, true AS fewer_files FROM d, e")
def append_unique_files_read(t):
    """An append of the last months again: the index leaves out the files of all others."""
    df = slim(t)
    table = KeyedAppends(vt.new_table(t.spark, df.schema, ["ym"]), ["sale_date", "order_id"])
    table.append(df)
    late = df.where(F.col("sale_date") >= "1998-01-01")
    n = table.candidates(late).count()
    every = table.table.read().select(F.col("ym")).distinct().count()
    return table.append(late).withColumn("fewer_files", F.lit(0 < n < every))


@query("repartition_by_business_date", f"WITH {H} SELECT {C} FROM h")
def repartition_by_business_date(t):
    df = slim(t)
    wrong = df.unionByName(of(df, "O")).withColumn("ym", F.lit("1900-01"))
    path, out = stored(t, wrong, ["ym"]), fresh_path(t.spark, "fixed")
    wr.repartition_by_business_date(wr.read_table(t.spark, path, df), out, "order_id", "sale_date", ["ym"], ["sale_date"])
    return back(t, out, df)


@query("purge_source", f"WITH {H} SELECT {C} FROM h WHERE source <> 'P'")
def purge_source(t):
    df = slim(t)
    path, out = stored(t, df, ["ym"]), fresh_path(t.spark, "purged")
    wr.purge_source(wr.read_table(t.spark, path, df), out, " P".strip(), ["ym"])
    return back(t, out, df)


ALIASES = "al AS (SELECT store AS old, replace(store, 'NATION_', 'TOWN_') AS new FROM stores WHERE region = 'EUROPE')"


def aliases(t):
    return t.stores.where(F.col("region") == "EUROPE").select(F.col("store").alias("old"), F.regexp_replace("store", "NATION_", "TOWN_").alias("new"))


@query("partition_key_migration", f"WITH {H}, {ALIASES} SELECT {C.replace('store', 'COALESCE(al.new, store) AS store')} FROM h LEFT JOIN al ON al.old = h.store")
def partition_key_migration(t):
    df = slim(t)
    moved = df.join(aliases(t), F.col("store") == F.col("old")).withColumn("store", F.col("new")).select(*COLS)
    path, out = stored(t, df.unionByName(of(moved, "O")), ["store"]), fresh_path(t.spark, "moved")
    wr.partition_key_migration(wr.read_table(t.spark, path, df), aliases(t), out, "order_id", ["store"], ["sale_date"])
    return back(t, out, df)


@query("legacy_partitions", f"WITH {H}, {ALIASES} SELECT store, new, count(*) AS rows FROM h JOIN al ON al.old = h.store GROUP BY store, new")
def legacy_partitions(t):
    return wr.legacy_partitions(slim(t), aliases(t))


@query("fix_partition_ym", f"WITH {HEADS}, {RAW_LINES} SELECT DISTINCT order_id, l_partkey, l_linenumber, qty, ym FROM heads JOIN raw_lines ON l_orderkey = o_orderkey")
def fix_partition_ym(t):
    rows = t.raw_lines.select(F.col("l_orderkey").cast("string").alias("order_id"), "l_partkey", "l_linenumber", "qty", F.date_format("l_shipdate", "yyyy-MM").alias("ym"))
    path, out = stored(t, rows, ["ym"]), fresh_path(t.spark, "months")
    wr.fix_partition_ym(wr.read_table(t.spark, path, rows), slim(t), out, "order_id", "sale_date", ["order_id", "l_partkey", "l_linenumber", "qty"], ["l_linenumber"])
    return back(t, out, rows)


@query("prune_pre_open", f"WITH {HEADS} SELECT order_id, CAST(sale_date AS VARCHAR) AS sale_date, ym, store, platform, source, order_amount FROM heads WHERE sale_date >= open_date")
def prune_pre_open(t):
    df = slim(t)
    path, out = stored(t, df, ["ym"]), fresh_path(t.spark, "pruned")
    wr.prune_pre_open(wr.read_table(t.spark, path, df), t.stores, out, ["ym"])
    return back(t, out, df)


# -- streaming ----------------------------------------------------------------


@query("incremental_file_ingest", f"WITH {H} SELECT {C.replace('order_amount', "order_amount + CASE WHEN source = 'O' THEN 3 ELSE 0 END AS order_amount")}, substr(md5(concat_ws('|', order_id, store, order_amount + CASE WHEN source = 'O' THEN 3 ELSE 0 END)), 1, 12) AS row_hash FROM h")
def incremental_file_ingest(t):
    from tillbook.functions.keys import row_hash

    df, root = slim(t), fresh_path(t.spark, "inbox")
    prepare = lambda s: s.withColumn("row_hash", row_hash(["order_id", "store", "order_amount"]))
    target = stored(t, prepare(df.limit(0)), ["ym"])
    checkpoint = fresh_path(t.spark, "stream")
    run = lambda: ingest_files(t.spark, root, df.schema, target, ["order_id"], ["ym"], prepare, ["order_amount"], checkpoint)
    wr.write_table(of(df, "F", "O"), f"{root}/hour1")
    run()
    # The next hour brings new orders, corrected ones, and some that were sent before.
    wr.write_table(of(df, "P").unionByName(bumped(of(df, "O"), 3)).unionByName(of(df, "F").where(F.col("platform") == "BUILDING")), f"{root}/hour2")
    run()
    return back(t, target, prepare(df))


@query("stream_dedup_ingest", f"WITH {EVENTS} SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, store, event_type, CASE WHEN event_type = 'error' THEN amount + 9 ELSE amount END AS amount, CAST(d AS VARCHAR) AS d FROM ev")
def stream_dedup_ingest(t):
    # The second hour sends equal rows again, corrects the errors, and brings the purchases weeks late.
    ev, root = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "store", "event_type", "amount", "d"), fresh_path(t.spark, "inbox")
    target, checkpoint = stored(t, ev.limit(0), ["d"]), fresh_path(t.spark, "stream")
    run = lambda: ingest_files(t.spark, root, ev.schema, target, ["event_id"], ["d"], lambda s: s, ["ts"], checkpoint)
    wr.write_table(ev.where(F.col("event_type") != "purchase"), f"{root}/a")
    run()
    fixed = ev.where(F.col("event_type") == "error").withColumn("amount", F.col("amount") + 9)
    wr.write_table(ev.where(F.col("event_type") != "error").unionByName(fixed), f"{root}/b")
    run()
    return back(t, target, ev)


@query("line_grain_ingest", f"""WITH {HEADS}, {RAW_LINES}, x AS (SELECT order_id, CAST(l_linenumber AS BIGINT) AS l_linenumber, source, strftime(sale_date, '%Y-%m') AS ym,
    source = 'O' AND bool_or(l_linenumber <> 2) OVER (PARTITION BY order_id) AS again FROM heads JOIN raw_lines ON l_orderkey = o_orderkey WHERE platform <> 'BUILDING')
  SELECT DISTINCT order_id, l_linenumber, source, ym, CASE WHEN again THEN 2 ELSE 1 END AS version FROM x WHERE NOT again OR l_linenumber <> 2""")
def line_grain_ingest(t):
    # Orders of source O arrive again without their second line; a platform's rows have an unreadable date and are left out.
    lines = t.raw_lines.join(t.heads.select("o_orderkey", "order_id", "sale_date", "platform", "source"), F.col("l_orderkey") == F.col("o_orderkey"))
    text = F.when(F.col("platform") == "BUILDING", "soon").otherwise(F.date_format("sale_date", "yyyy.MM.dd"))
    raw = lines.select("order_id", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "source", text.alias("day"))
    root, checkpoint = fresh_path(t.spark, "inbox"), fresh_path(t.spark, "stream")
    prepare = lambda s: s.withColumn("ym", F.date_format(F.try_to_timestamp("day", F.lit("yyyy.MM.dd")), "yyyy-MM")).drop("day")
    first, again = raw.withColumn("version", F.lit(1).cast("bigint")), of(raw, "O").where("l_linenumber <> 2").withColumn("version", F.lit(2).cast("bigint"))
    target = stored(t, prepare(first.limit(0)), ["ym"])
    run = lambda: ingest_files(
        t.spark, root, first.schema, target, ["order_id"], ["ym"], prepare, [], checkpoint, archive=fresh_path(t.spark, "done"),
        valid=F.col("ym").isNotNull(), whole=F.col("version"),
    )
    wr.write_table(first, f"{root}/hour1")
    run()
    wr.write_table(again, f"{root}/hour2")
    run()
    return back(t, target, prepare(first))


@query("stateful_event_ingest", f"""WITH {EVENTS}, m AS (SELECT max(d) AS newest FROM ev WHERE event_type <> 'purchase')
  SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN amount + 9 ELSE amount END AS amount, CAST(d AS VARCHAR) AS d,
    CAST(CASE WHEN event_type IN ('error', 'purchase') THEN 1 ELSE 0 END AS BIGINT) AS changed_in, event_type IN ('error', 'purchase') AND date_diff('day', d, newest) > 7 AS late FROM ev, m""")
def stateful_event_ingest(t):
    """An hour without purchases; then all rows again, the errors corrected, the purchases new. State drops what is repeated, so only changed rows get the second batch."""
    ev = t.events.select("event_id", "event_type", "amount", F.col("d").cast("string").alias("d"), F.date_format("d", "yyyy-MM").alias("ym"), F.lit(1).alias("sent"))
    root, spark = fresh_path(t.spark, "inbox"), t.spark
    kept = ev.withColumn("changed_in", F.lit(0).cast("long"))
    table, late = vt.new_table(spark, kept.schema, ["ym"]), vt.new_table(spark, kept.schema, ["changed_in"])
    days = vt.new_table(spark, spark.createDataFrame([], "newest string, changed_in long").schema, ["changed_in"])
    checkpoint = fresh_path(spark, "stream")
    run = lambda: StatefulIngest(spark, root, ev.schema, table, late, days, ["event_id"], "d", "sent", checkpoint).run()
    wr.write_table(ev.where(F.col("event_type") != "purchase"), f"{root}/a")
    run()
    fixed = ev.where(F.col("event_type") == "error").withColumn("amount", F.col("amount") + 9)
    wr.write_table(ev.where(F.col("event_type") != "error").unionByName(fixed), f"{root}/b")
    run()  # a new object: state, days and late rows come from the checkpoint and the tables
    waiting = stage(late.read().select("event_id", F.lit(True).alias("late")))
    StatefulIngest(spark, root, ev.schema, table, late, days, ["event_id"], "d", "sent", checkpoint).merge_late()
    out = table.read().join(waiting, "event_id", "left").withColumn("late", F.coalesce("late", F.lit(False)))
    return out.select("event_id", "event_type", "amount", "d", "changed_in", "late")
