"""Tables written and read back: shards, documents, manifests, states that batches refresh, and what blocks a write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.operators.lineage import shared_folder
from lakemill.operators.merge import additive_folds
from lakemill.plans.registry import query, table
from lakemill.sources import archives, documents, sinks
from lakemill.streaming import incremental


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS legislature FROM orders WHERE year(o_orderdate) IN (1996, 1998)")
def loaded_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension written in shards; only the wanted shards are read, and of them only the keys."""
    folder = shared_folder(spark, "shards")
    sinks.write_shards(table(spark, sf_dir, "orders").withColumn("legislature", F.year("o_orderdate")), folder, "legislature", ["o_orderkey"])
    return spark.read.parquet(folder).where(F.col("legislature").isin(1996, 1998)).select("o_orderkey", "legislature")


@query(
    """WITH v AS (SELECT l_suppkey AS member, count(*) AS n, count(o_orderkey) AS n_known FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderkey % 11 <> 0 WHERE l_suppkey % 4 > 0 AND l_suppkey % 5 > 0 GROUP BY 1)
 SELECT s_suppkey AS member, CASE WHEN s_suppkey % 4 = 0 THEN 'no_cache' WHEN n IS NULL THEN 'no_rows' ELSE 'rows' END AS state, CASE WHEN s_suppkey % 4 > 0 THEN coalesce(n, 0) END AS n, CASE WHEN s_suppkey % 4 > 0 THEN coalesce(n_known, 0) END AS n_known FROM supplier LEFT JOIN v ON member = s_suppkey"""
)
def looked_up_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A member's rows out of a table dealt by member, joined to the dimension; without a table is not without rows."""
    folder = shared_folder(spark, "members")
    votes = table(spark, sf_dir, "lineitem").where("l_suppkey % 4 > 0 and l_suppkey % 5 > 0").select(F.col("l_suppkey").alias("member"), F.col("l_orderkey").alias("ballot"))
    sinks.write_shards(votes.withColumn("bucket", F.pmod("member", F.lit(8))), folder, "bucket", ["member", "ballot"])
    known = table(spark, sf_dir, "orders").where("o_orderkey % 11 <> 0").select(F.col("o_orderkey").alias("ballot"), F.lit(1).alias("known"))
    counts = spark.read.parquet(folder).join(known, "ballot", "left").groupBy("member").agg(F.count("*").alias("n"), F.count("known").alias("n_known"))
    members = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("member"), (F.col("s_suppkey") % 4 > 0).alias("cached"))
    state = F.when(~F.col("cached"), "no_cache").when(F.col("n").isNull(), "no_rows").otherwise("rows")
    zero = lambda c: F.when(F.col("cached"), F.coalesce(c, F.lit(0))).cast("long").alias(c)
    return members.join(counts, "member", "left").select("member", state.alias("state"), zero("n"), zero("n_known"))


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 3 > 0 THEN c_name END AS name, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE 2 END AS n_tags FROM customer WHERE c_custkey % 10 > 0 UNION ALL SELECT NULL, 'broken', count(*) FROM customer WHERE c_custkey % 10 = 0")
def read_back_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as lines of compressed JSON, where null, empty and filled lists stay
    three things; lines that are no document are counted."""
    folder = shared_folder(spark, "documents")
    tags = F.when(F.col("c_custkey") % 4 == 1, F.array().cast("array<string>")).when(F.col("c_custkey") % 4 > 1, F.array("c_name", "c_mktsegment"))
    docs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_name")).alias("name"), tags.alias("tags"))
    sinks.write_documents(docs.where("id % 10 > 0"), folder)
    docs.where("id % 10 = 0").select(F.concat(F.lit('{"id": '), "id")).coalesce(1).write.mode("append").option("compression", "gzip").text(folder)
    schema = docs.schema
    read, broken = documents.json_lines(spark, folder, schema), documents.broken_lines(spark, folder, schema)
    found = broken.agg(F.count("*").alias("n")).select(F.lit(None).cast("long").alias("id"), F.lit("broken").alias("name"), F.col("n").cast("long").alias("n_tags"))
    return read.select("id", "name", F.size("tags").cast("long").alias("n_tags")).unionByName(found)


@query(
    """WITH n AS (SELECT o_custkey AS k, count(*) FILTER (o_orderstatus <> 'P') AS n FROM orders GROUP BY 1)
 SELECT 'c' || c_custkey || '.pivot.json' AS file, CASE WHEN c_mktsegment = 'BUILDING' THEN 'raw' WHEN c_mktsegment = 'FURNITURE' THEN 'unknown' ELSE 'pivot' END AS form, coalesce(n, 0) AS n FROM customer LEFT JOIN n ON k = c_custkey
 UNION ALL SELECT 'broken' || c_custkey || '.pivot.json', 'no JSON', NULL FROM customer WHERE c_nationkey = 3 UNION ALL SELECT 'list' || c_custkey || '.pivot.json', 'no object', NULL FROM customer WHERE c_nationkey = 4
 UNION ALL SELECT 'groups.json', 'envelope', (SELECT count(*) FROM nation)"""
)
def document_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file for each document in folders below folders, read back whatever its form:
    its kind and how many of its votes are objects; broken files and lists are told, dotted names skipped, and a list in
    an envelope is taken out."""
    folder = shared_folder(spark, "files")
    archives.register(spark)
    vote = F.when(F.col("o_orderstatus") == "P", F.parse_json(F.lit('"x"'))).otherwise(F.to_variant_object(F.struct("o_orderkey")))
    votes = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.collect_list(vote).alias("votes"))
    rows = table(spark, sf_dir, "customer").join(votes, F.col("k") == F.col("c_custkey"), "left")
    pivot, raw = F.col("c_mktsegment").isin("BUILDING", "FURNITURE"), F.col("c_mktsegment") == "BUILDING"
    doc = F.to_json(F.struct(F.when(~pivot, "1").alias("schema_version"), F.when(~pivot, F.col("c_custkey")).alias("id"), F.when(raw, F.col("c_name")).alias("slug"), "votes"))
    file = lambda kind, content: F.struct(F.concat(F.lit("n"), "c_nationkey", F.lit("/"), F.lit(kind), "c_custkey", F.lit(".pivot.json")).alias("name"), content.cast("binary").alias("content"))
    nation = F.col("c_nationkey")
    files = F.array(file("c", doc), file(".c", doc), F.when(nation == 3, file("broken", F.lit('{"id":'))), F.when(nation == 4, file("list", F.lit("[1]"))))
    rows.select(F.inline(F.array_compact(files))).write.format("lakemill_files").mode("append").save(folder)
    groups = table(spark, sf_dir, "nation").agg(F.to_json(F.struct(F.collect_list(F.struct("n_nationkey")).alias("groupes"))).cast("binary").alias("content"))
    groups.select(F.lit("config/groups.json").alias("name"), "content").write.format("lakemill_files").mode("append").save(folder)
    docs, unreadable = documents.document_files(spark, folder, "*.pivot.json")
    counts = documents.entries_of(docs, "votes").groupBy("file").agg(F.count("*").alias("n"))
    found = documents.routed(docs).join(counts, "file", "left").select("file", F.coalesce("form", F.lit("unknown")).alias("form"), F.coalesce("n", F.lit(0)).alias("n"))
    envelope = documents.entries_of(documents.document_files(spark, folder, "groups.json")[0], "groupes")
    told = envelope.groupBy("file").agg(F.count("*").alias("n")).select("file", F.lit("envelope").alias("form"), "n")
    return found.union(told).union(unreadable.select("file", F.col("reason").alias("form"), F.lit(None).cast("long").alias("n")))


@query("SELECT c_custkey FROM customer WHERE c_custkey % 3 > 0")
def resumed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a resumed run has still to do; a manifest that is written again names its keys once."""
    folder = shared_folder(spark, "manifest")
    rows = table(spark, sf_dir, "customer").select("c_custkey")
    for _ in range(2):
        sinks.append_manifest(rows.where("c_custkey % 3 = 0"), folder, "c_custkey", "run-1")
    sinks.append_manifest(rows.where("c_custkey % 3 = 1"), folder, "c_custkey", "run-0")
    return sinks.pending(rows, folder, "c_custkey", "run-1")


@query(
    """WITH g AS (SELECT o_custkey AS k, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS group_ids, count(DISTINCT o_orderpriority) AS n_groups FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
 SELECT c_custkey, coalesce(group_ids, '') AS group_ids, coalesce(n_groups, 0) AS n_groups FROM customer LEFT JOIN g ON k = c_custkey WHERE c_custkey IN (SELECT o_custkey FROM orders)"""
)
def published_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidates that have a document, each with the groups that name it as a member."""
    orders = table(spark, sf_dir, "orders")
    ids = F.array_sort(F.collect_set("o_orderpriority"))
    groups = orders.where("o_orderstatus = 'O'").groupBy(F.col("o_custkey").alias("k")).agg(ids.alias("ids"))
    there = table(spark, sf_dir, "customer").join(orders.select(F.col("o_custkey").alias("c_custkey")).distinct(), "c_custkey", "left_semi")
    rows = there.join(groups, F.col("k") == F.col("c_custkey"), "left")
    return rows.select("c_custkey", F.coalesce(F.array_join("ids", ","), F.lit("")).alias("group_ids"), F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_groups"))


@query("SELECT 'whole' AS part, count(*) AS n, '' AS refused FROM nation UNION ALL SELECT 'partial', 0, 'not ingested: 0, 7, 14, 21'")
def complete_or_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table is written only if every expected part was ingested; what was not measured is not zero."""
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), "n_name")
    out = []
    for part, ingested in (("whole", nations), ("partial", nations.where("key % 7 > 0"))):
        folder, refused = shared_folder(spark, part), ""
        try:
            sinks.write_if_complete(nations, folder, nations, ingested, "key")
            n = spark.read.parquet(folder).count()
        except sinks.Incomplete as e:
            n, refused = 0, str(e)
        out.append((part, n, refused))
    return spark.createDataFrame(out, "part string, n long, refused string")


@query(
    """WITH e AS (SELECT user_id, event_type, ts, event_id, CASE WHEN event_id % 3 > 0 THEN value END AS value, event_id % 2 AS batch FROM events),
 b AS (SELECT batch, user_id, event_type, arg_max({'value': value, 'ts': ts}, ts) AS r FROM e GROUP BY ALL), x AS (SELECT * FROM b WHERE batch = 0), y AS (SELECT * FROM b WHERE batch = 1)
 SELECT coalesce(y.user_id, x.user_id) AS user_id, coalesce(y.event_type, x.event_type) AS event_type, coalesce(y.r.value, x.r.value) AS value, coalesce(y.r.ts, x.r.ts) AS ts
 FROM x FULL JOIN y ON x.user_id = y.user_id AND x.event_type = y.event_type"""
)
def refreshed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored state that two batches refresh; the second one comes twice, as after a lost driver."""
    folder = shared_folder(spark, "state")
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", F.when(F.col("event_id") % 3 > 0, F.col("value")).alias("value"), "ts", "event_id")
    merge = incremental.refresher(folder, ["user_id", "event_type"], "ts")
    for number, half in ((0, 0), (1, 1), (1, 1)):
        merge(rows.where(F.col("event_id") % 2 == half).drop("event_id"), number)
    return incremental.current(spark, folder)


@query(
    """SELECT n_nationkey AS part, CASE WHEN n_nationkey % 2 = 0 AND n_nationkey % 5 > 0 THEN 'frozen' WHEN n_nationkey % 5 = 0 THEN 'never_built' WHEN n_nationkey % 7 = 1 THEN 'failed'
 WHEN n_nationkey % 3 = 0 THEN 'stale' ELSE 'fresh' END AS state FROM nation"""
)
def part_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of each part of a dimension: never built, failed, stale, frozen or fresh."""
    k = F.col("n_nationkey")
    synced = F.when(k % 5 > 0, F.when(k % 3 == 0, F.lit("2024-01-01 00:00:00")).otherwise(F.lit("2024-02-01 00:00:00")).cast("timestamp"))
    parts = table(spark, sf_dir, "nation").select(k.alias("part"), (k % 2 == 0).alias("frozen"), synced.alias("synced"), (k % 7 == 1).alias("failed"))
    return incremental.freshness(parts, F.lit("2024-02-05 00:00:00").cast("timestamp"), 7)


@query(
    """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL"""
)
def hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by hour and kind, by the operator that a stream uses as well."""
    found = incremental.windowed_counts(table(spark, sf_dir, "events"), "ts", "event_type", "value")
    return found.select("start", "event_type", "n", F.round("total", 2).alias("total"))


@query(
    """WITH d AS (SELECT o_orderkey % 3 AS rank, o_custkey AS k, o_orderpriority AS v, o_orderkey AS pos FROM orders),
 f AS (SELECT *, min(rank) OVER (PARTITION BY k, v) AS first_rank, row_number() OVER (PARTITION BY k, v, rank ORDER BY pos) AS rn FROM d)
 SELECT k, v, pos, rank FROM f WHERE rank = first_rank AND (rank = 0 OR rn = 1)"""
)
def folded_directories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The additive merge over several directories in order: the first is kept as it is, later ones add new keys."""
    rows = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 3).alias("rank"), F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("v"), F.col("o_orderkey").alias("pos"))
    return additive_folds(rows, ["k", "v"], "rank", "pos").select("k", "v", "pos", "rank")


@query("SELECT role AS speaker, 'conv ' || conv_id AS name, count(*) AS n FROM conversations GROUP BY ALL")
def read_back_debates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of a debate, written as XML and read at any depth, with their speaker."""
    folder = shared_folder(spark, "debates")
    speaker = F.struct(F.struct(F.col("role").alias("id"), F.concat(F.lit("conv "), "conv_id").alias("nom")).alias("orateur"))
    rows = table(spark, sf_dir, "conversations").select(speaker.alias("orateurs"), F.col("text").alias("texte"))
    rows.write.format("xml").option("rootTag", "compteRendu").option("rowTag", "paragraphe").save(folder)
    return documents.interventions(spark, folder).groupBy("speaker", "name").agg(F.count("*").alias("n"))


@query(
    """SELECT c_nationkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment || ' ' || c_custkey ELSE c_name END AS name FROM customer WHERE c_custkey % 4 > 0"""
)
def listed_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in the lists below the headings that announce them: a link's text, else the text up to a comma."""
    name = F.when(F.col("c_custkey") % 3 == 0, F.concat("c_mktsegment", F.lit(" "), "c_custkey")).otherwise(F.col("c_name"))
    item = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("<li>"), name, F.lit(", whose text goes on</li>"))).otherwise(F.concat(F.lit("<li><a href='/x'>"), name, F.lit("</a> (party)</li>")))
    rows = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.array_join(F.collect_list(F.when(F.col("c_custkey") % 4 > 0, item)), "").alias("wanted"), F.array_join(F.collect_list(F.when(F.col("c_custkey") % 4 == 0, item)), "").alias("others")
    )
    page = F.concat(F.lit("<h2>Candidats d&eacute;clar&eacute;s</h2><ul>"), "wanted", F.lit("</ul><h2>Sources</h2><ul>"), "others", F.lit("</ul>"))
    return documents.listed_names(rows.select("c_nationkey", page.alias("html"))).select("c_nationkey", F.explode("names").alias("name"))
