"""Lookup, text, aggregate, set, flow and event queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.functions import formulas as fx
from tallyseq.operators import lookup as lk
from tallyseq.operators.taxonomy import parents_by_indent
from tallyseq.plans.base import query
from tallyseq.sources import readers, writers
from tallyseq.streaming import windows as ew

S = lambda n: F.col(n).cast("string")


@query("version_fallback", "J1 E2", sql="""
WITH a AS (SELECT 'ACC' || p_partkey || '.' || (p_partkey % 3) AS acc FROM part), d AS (SELECT 'ACC' || p_partkey || '.1' AS acc, min(p_size)::BIGINT AS taxid FROM part WHERE p_size > 25 GROUP BY 1),
b AS (SELECT regexp_replace(acc, '\\.\\d+$', '') AS bare, min(taxid) AS loose FROM d GROUP BY 1)
SELECT a.acc, coalesce(d.taxid, loose) AS taxid FROM a LEFT JOIN d ON a.acc = d.acc LEFT JOIN b ON regexp_replace(a.acc, '\\.\\d+$', '') = bare""")
def version_fallback(t):
    name = lambda v: F.concat(F.lit("ACC"), S("p_partkey"), F.lit("."), v)
    dim = t.part.where("p_size > 25").select(name(F.lit("1")).alias("acc"), F.col("p_size").cast("bigint").alias("taxid"))
    return lk.with_version_fallback(t.part.select(name((F.col("p_partkey") % 3).cast("string")).alias("acc")), dim, "acc", "taxid")


@query("backfill", "J2", sql="SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN lower(replace(p_brand, '#', '_')) ELSE p_type END AS label FROM part")
def backfill(t):
    rows = t.part.select("p_partkey", F.when(F.col("p_partkey") % 4 != 0, F.col("p_type")).otherwise(F.lit(" ")).alias("label"))
    dim = t.part.select("p_partkey", F.lower(F.replace("p_brand", F.lit("#"), F.lit("_"))).alias("label"))
    return lk.backfill(rows, dim, "p_partkey", "label")


@query("match_cascade", "J3", sql="""
WITH d1 AS (SELECT n_nationkey AS k, n_name || '!' AS v FROM nation WHERE n_name < 'M'), d2 AS (SELECT r_regionkey AS r, r_name AS v FROM region WHERE r_regionkey < 3)
SELECT s_suppkey, coalesce(d1.v, d2.v) AS v, CASE WHEN d1.v IS NOT NULL THEN 0 WHEN d2.v IS NOT NULL THEN 1 END AS matched_by FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN d1 ON d1.k = s_nationkey LEFT JOIN d2 ON d2.r = n_regionkey""")
def match_cascade(t):
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("s_nationkey").alias("k"), F.col("n_regionkey").alias("r"))
    d1 = t.nation.where("n_name < 'M'").select(F.col("n_nationkey").alias("k"), F.concat("n_name", F.lit("!")).alias("v"))
    d2 = t.region.where("r_regionkey < 3").select(F.col("r_regionkey").alias("r"), F.col("r_name").alias("v"))
    return lk.cascade(rows, [(d1, ["k"]), (d2, ["r"])], "v").select("s_suppkey", "v", "matched_by")


@query("longest_prefix", "J22", sql="""
WITH d AS (SELECT DISTINCT split_part(p_type, ' ', 1) AS prefix FROM part UNION SELECT DISTINCT split_part(p_type, ' ', 1) || ' ' || split_part(p_type, ' ', 2) FROM part WHERE p_size > 45)
SELECT p.p_partkey, (SELECT arg_max(prefix, length(prefix)) FROM d WHERE p.p_type = prefix OR starts_with(p.p_type, prefix || ' ') OR starts_with(p.p_type, prefix || ',')) AS prefix FROM part p""")
def longest_prefix(t):
    word = lambda n: F.split_part("p_type", F.lit(" "), F.lit(n))
    dim = t.part.select(word(1).alias("prefix")).union(t.part.where("p_size > 45").select(F.concat(word(1), F.lit(" "), word(2)))).distinct()
    return lk.longest_prefix(t.part.select("p_partkey", "p_type"), dim, "p_type", "prefix").select("p_partkey", "prefix")


@query("cluster_expansion", "J19 S16 W6", sql="""
WITH b AS (SELECT p_brand, p_name, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS no FROM part), c AS (SELECT DISTINCT p_brand, p_brand || '-' || p_size AS member FROM part)
SELECT member AS p_brand, p_name FROM b JOIN c USING (p_brand) WHERE no = 1""")
def cluster_expansion(t):
    clusters = t.part.select(F.col("p_brand").alias("representative"), F.concat_ws("-", "p_brand", S("p_size")).alias("member")).distinct()
    return lk.expand_clusters(t.part.select("p_brand", "p_name", "p_retailprice", "p_partkey"), clusters, "p_brand", [F.desc("p_retailprice"), F.col("p_partkey")]).select("p_brand", "p_name")


@query("top_hits", "T1 W8", sql="""
WITH a AS (SELECT *, p_partkey % 97 = 0 AS f, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS p FROM part),
b AS (SELECT *, row_number() OVER (PARTITION BY p_size ORDER BY (f OR p <= 2) DESC, p_retailprice DESC, p_partkey) AS r FROM a)
SELECT p_partkey, CASE WHEN f THEN 'forced' WHEN p <= 2 THEN 'parent' ELSE 'rank' END AS reason FROM b WHERE f OR p <= 2 OR r <= 3""")
def top_hits(t):
    return lk.top_hits(t.part, F.col("p_partkey") % 97 == 0, "p_brand", "p_size", "p_retailprice", "p_partkey", 2, 3).select("p_partkey", "reason")


@query("top_percent", "T4", sql="""WITH c AS (SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n, l_partkey) AS no, count(*) OVER (PARTITION BY l_suppkey) AS k FROM c)
SELECT l_suppkey, l_partkey, n FROM r WHERE no <= greatest(2, ceil(k * 10 / 100.0))""")
def top_percent(t):
    c = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n"))
    w = Window.partitionBy("l_suppkey")
    x = c.withColumns({"no": F.row_number().over(w.orderBy("n", "l_partkey")), "k": F.count("*").over(w)})
    return x.where(F.col("no") <= F.greatest(F.lit(2), F.ceil(F.col("k") * 10 / 100))).select("l_suppkey", "l_partkey", "n")


@query("indent_parents", "W7 S7", sql="""
WITH r AS (SELECT 0 AS region, 0 AS d, NULL AS k WHERE false UNION ALL SELECT r_regionkey, 0, -1 FROM region UNION ALL SELECT n_regionkey, 1, n_nationkey FROM nation)
SELECT 'N' || n_nationkey AS line, 'R' || n_regionkey AS parent, 1 AS depth FROM nation UNION ALL SELECT 'R' || r_regionkey, NULL, 0 FROM region""")
def indent_parents(t):
    a = t.region.select(F.concat(F.lit("R"), S("r_regionkey")).alias("line"), (F.col("r_regionkey") * 1000).alias("pos"), F.col("r_name").alias("name"))
    b = t.nation.select(F.concat(F.lit("N"), S("n_nationkey")).alias("line"), (F.col("n_regionkey") * 1000 + 1 + F.col("n_nationkey")).alias("pos"), F.concat(F.lit("  "), "n_name").alias("name"))
    return parents_by_indent(a.unionByName(b), "line", "pos", "name").select("line", "parent", "depth")


@query("duplicate_suffix", "W10 S18", sql="""SELECT o_orderkey, o_orderpriority || CASE WHEN count(*) OVER (PARTITION BY o_custkey, o_orderpriority) > 1 THEN '_T' || row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) ELSE '' END AS sample FROM orders""")
def duplicate_suffix(t):
    w = Window.partitionBy("o_custkey", "o_orderpriority")
    no = F.concat(F.lit("_T"), F.row_number().over(w.orderBy("o_orderkey")))
    return t.orders.select("o_orderkey", F.concat("o_orderpriority", F.when(F.count("*").over(w) > 1, no).otherwise("")).alias("sample"))


@query("weighted_groups", "A22 A24 A29 A9", sql="""SELECT p_brand, round(sum(l_discount * l_quantity) / sum(l_quantity), 8) AS weighted, round(sum(CASE WHEN l_tax > 0.02 THEN l_discount * l_quantity END) / sum(CASE WHEN l_tax > 0.02 THEN l_quantity END), 8) AS filtered, bool_or(l_returnflag = 'R') AS any_returned, count(*) AS n
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""")
def weighted_groups(t):
    x, w = t.lineitem.join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")), F.col("l_quantity")
    ok = F.col("l_tax") > 0.02
    return x.groupBy("p_brand").agg(
        F.round(F.sum(F.col("l_discount") * w) / F.sum(w), 8).alias("weighted"), F.round(F.sum(F.when(ok, F.col("l_discount") * w)) / F.sum(F.when(ok, w)), 8).alias("filtered"),
        F.bool_or(F.col("l_returnflag") == "R").alias("any_returned"), F.count("*").alias("n"))


@query("confidence_profile", "A23 A51 S17", sql="""SELECT p_type, p_size, round(avg(p_retailprice), 4) AS mean, round(median(p_retailprice), 4) AS median, round(coalesce(stddev_samp(p_retailprice), 0), 4) AS sd, round(var_pop(p_retailprice), 6) AS var, count(*) AS n FROM part GROUP BY p_type, p_size""")
def confidence_profile(t):
    c = "p_retailprice"
    return t.part.groupBy("p_type", "p_size").agg(
        F.round(F.avg(c), 4).alias("mean"), F.round(F.median(c), 4).alias("median"), F.round(F.coalesce(F.stddev_samp(c), F.lit(0.0)), 4).alias("sd"), F.round(F.var_pop(c), 6).alias("var"), F.count("*").alias("n"))


@query("hit_summary", "A25 A26 F14 F16", sql="""
WITH h AS (SELECT l_suppkey AS taxid, l_partkey AS contig, l_discount * 1000 AS ident, p_type, row_number() OVER (PARTITION BY l_suppkey ORDER BY CAST(CAST(round(l_discount * 1000) AS INT) AS VARCHAR) DESC, l_orderkey, l_linenumber) AS no, count(*) OVER (PARTITION BY l_suppkey) AS n
 FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_discount >= 0.03 AND regexp_matches(p_type, 'STANDARD|ECONOMY|PROMO') AND NOT p_type LIKE '%PROMO%')
SELECT taxid, count(DISTINCT contig) AS contigs, count(*) AS hits, round(max(CASE WHEN no = n // 2 + 1 THEN ident END), 4) AS middle_identity, string_agg(DISTINCT p_type, ';' ORDER BY p_type) AS types FROM h GROUP BY taxid""")
def hit_summary(t):
    h = t.lineitem.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    h = h.where((F.col("l_discount") >= 0.03) & F.col("p_type").rlike("STANDARD|ECONOMY|PROMO") & ~F.col("p_type").contains("PROMO"))
    w = Window.partitionBy("l_suppkey")
    text = F.round(F.col("l_discount") * 1000).cast("int").cast("string")  # identities sort as text
    h = h.withColumns({"no": F.row_number().over(w.orderBy(text.desc(), "l_orderkey", "l_linenumber")), "n": F.count("*").over(w)})
    middle = F.max(F.when(F.col("no") == F.floor(F.col("n") / 2) + 1, F.col("l_discount") * 1000))
    return h.groupBy(F.col("l_suppkey").alias("taxid")).agg(
        F.countDistinct("l_partkey").alias("contigs"), F.count("*").alias("hits"), F.round(middle, 4).alias("middle_identity"), F.array_join(F.sort_array(F.collect_set("p_type")), ";").alias("types"))


@query("value_counts_pivot", "A27", sql="SELECT p_brand, count(*) FILTER (WHERE p_size <= 10) AS small, count(*) FILTER (WHERE p_size > 10 AND p_size <= 30) AS medium, count(*) FILTER (WHERE p_size > 30) AS large FROM part GROUP BY p_brand")
def value_counts_pivot(t):
    size = F.when(F.col("p_size") <= 10, "small").when(F.col("p_size") <= 30, "medium").otherwise("large")
    return t.part.withColumn("size", size).groupBy("p_brand").pivot("size", ["small", "medium", "large"]).agg(F.count("p_brand")).na.fill(0)


@query("feature_counts", "A28 S21", sql="SELECT p_brand, p_type, count(*) AS n, grouping(p_type)::BIGINT AS level FROM part GROUP BY GROUPING SETS ((p_brand, p_type), (p_brand))")
def feature_counts(t):
    return t.part.groupingSets([["p_brand", "p_type"], ["p_brand"]], "p_brand", "p_type").agg(F.count("*").alias("n"), F.grouping("p_type").cast("bigint").alias("level"))


@query("annotation_levels", "A53 F15", sql="""
WITH u AS (SELECT p_name AS gene, p_brand AS taxid, 0 AS lv FROM part WHERE p_size > 20 UNION ALL SELECT p_name, substr(p_brand, 1, 7), 1 FROM part WHERE p_size < 40 UNION ALL SELECT p_name, p_brand, 2 FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY gene, taxid ORDER BY lv) AS no FROM u) SELECT gene, taxid, min(lv)::INT AS level, CASE WHEN regexp_matches(gene, '(?i)(ring|t)$') THEN 'AMR' ELSE 'VF' END AS route FROM r WHERE no = 1 GROUP BY gene, taxid""")
def annotation_levels(t):
    p = t.part
    u = p.where("p_size > 20").select("p_name", "p_brand", F.lit(0)).union(p.where("p_size < 40").select("p_name", F.substring("p_brand", 1, 7), F.lit(1))).union(p.select("p_name", "p_brand", F.lit(2))).toDF("gene", "taxid", "level")
    first = u.groupBy("gene", "taxid").agg(F.min("level").alias("level"))
    return first.withColumn("route", F.when(F.col("gene").rlike("(?i)(ring|t)$"), "AMR").otherwise("VF"))


@query("merge_contigs", "A55 U1 U2", sql="SELECT l_partkey, sum(l_quantity) AS reads, max(l_extendedprice) AS depth, max(l_tax) AS coverage FROM lineitem GROUP BY l_partkey")
def merge_contigs(t):
    a, b = t.lineitem.where("l_returnflag = 'R'"), t.lineitem.where("l_returnflag <> 'R'")
    return a.unionByName(b).groupBy("l_partkey").agg(F.sum("l_quantity").alias("reads"), F.max("l_extendedprice").alias("depth"), F.max("l_tax").alias("coverage"))


@query("safety_level", "A56", sql="""WITH s AS (SELECT n_nationkey, n_regionkey, list_max(list_transform(regexp_extract_all('BSL-' || (n_nationkey % 4) || ' or BSL-' || (n_nationkey % 3), 'BSL-(\\d)', 1), lambda x: x::INT)) AS lv FROM nation WHERE n_nationkey % 2 = 0), g AS (SELECT n_regionkey, max(lv) AS lv FROM s GROUP BY n_regionkey)
SELECT n.n_nationkey, coalesce(s.lv, g.lv) AS level FROM nation n LEFT JOIN s USING (n_nationkey) LEFT JOIN g ON g.n_regionkey = n.n_regionkey""")
def safety_level(t):
    text = F.concat(F.lit("BSL-"), (F.col("n_nationkey") % 4).cast("string"), F.lit(" or BSL-"), (F.col("n_nationkey") % 3).cast("string"))
    lv = F.array_max(F.transform(F.regexp_extract_all(text, F.lit(r"BSL-(\d)"), F.lit(1)), lambda x: x.cast("int")))
    s = t.nation.withColumn("lv", F.when(F.col("n_nationkey") % 2 == 0, lv))
    return s.select("n_nationkey", F.coalesce("lv", F.max("lv").over(Window.partitionBy("n_regionkey"))).alias("level"))


@query("scalar_numbers", "E8 E12 E16 E21 E29 E30", sql="""SELECT l_orderkey, l_linenumber, round(1 - pow(10, -l_quantity / 10), 6) AS prob, round(log10(1 + l_extendedprice), 6) AS lg, CASE WHEN l_discount <= 1 THEN round(l_discount * 100, 4) ELSE l_discount END AS pct,
 round(1 - power((ln(greatest(0.001, l_tax)) - ln(0.001)) / (0 - ln(0.001)), 4), 6) AS log_weight, round(least(greatest(l_tax * 20, 0), 1), 6) AS clipped FROM lineitem""")
def scalar_numbers(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.round(fx.mapq_probability(F.col("l_quantity")), 6).alias("prob"), F.round(fx.log_transform(F.col("l_extendedprice")), 6).alias("lg"), fx.scale_percent(F.col("l_discount")).alias("pct"),
        F.round(fx.logarithmic_weight(F.col("l_tax")), 6).alias("log_weight"), F.round(fx.clip(F.col("l_tax") * 20), 6).alias("clipped"))


@query("scalar_text", "E1 E2 E3 E23 E32", sql="""WITH a AS (SELECT p_partkey, 'NC_' || p_partkey || '.2_' || p_size || '_7' AS qname, 'ref' || p_size || ':' || p_partkey || '-' || (p_partkey + 10) AS region, 'The  Côte d''Ivoire & ' || p_brand AS place FROM part)
SELECT p_partkey, split_part(qname, '_', 1) AS first, regexp_replace(qname, '_\\d+_\\d+$', '') AS truth, regexp_replace(regexp_replace(qname, '_\\d+_\\d+$', ''), '\\.\\d+$', '') AS bare, split_part(region, ':', 1) AS contig, split_part(split_part(region, ':', 2), '-', 1)::BIGINT AS lo,
 split_part(region, '-', 2)::BIGINT AS hi, trim(regexp_replace(regexp_replace(replace(translate(lower(place), 'ôé', 'oe'), '&', 'and'), '[^a-z0-9 ]', '', 'g'), '^the +', '')) AS geo, base64(encode(qname)) AS b64 FROM a""")
def scalar_text(t):
    a = t.part.select(
        "p_partkey", F.concat(F.lit("NC_"), S("p_partkey"), F.lit(".2_"), S("p_size"), F.lit("_7")).alias("qname"), F.concat(F.lit("ref"), S("p_size"), F.lit(":"), S("p_partkey"), F.lit("-"), (F.col("p_partkey") + 10).cast("string")).alias("region"),
        F.concat(F.lit("The  Côte d'Ivoire & "), "p_brand").alias("place"))
    truth = F.regexp_replace("qname", r"_\d+_\d+$", "")
    part = lambda c, d, n: F.split_part(c, F.lit(d), F.lit(n))
    geo = F.trim(F.regexp_replace(F.regexp_replace(F.replace(F.translate(F.lower("place"), "ôé", "oe"), F.lit("&"), F.lit("and")), "[^a-z0-9 ]", ""), "^the +", ""))
    return a.select(
        "p_partkey", part("qname", "_", 1).alias("first"), truth.alias("truth"), fx.strip_version(truth).alias("bare"), part("region", ":", 1).alias("contig"), part(part("region", ":", 2), "-", 1).cast("bigint").alias("lo"),
        part("region", "-", 2).cast("bigint").alias("hi"), geo.alias("geo"), F.base64(F.col("qname").cast("binary")).alias("b64"))


@query("tolerant_dates", "E26", sql="""WITH a AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 2 THEN strftime(o_orderdate, '%Y%m%d') ELSE 'unknown' END AS text FROM orders)
SELECT o_orderkey, coalesce(try_strptime(text, '%Y-%m-%d'), try_strptime(text, '%d/%m/%Y'), try_strptime(text, '%Y%m%d'))::DATE AS day FROM a""")
def tolerant_dates(t):
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    text = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "dd/MM/yyyy")).when(k == 2, F.date_format(d, "yyyyMMdd")).otherwise("unknown")
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in ("yyyy-MM-dd", "dd/MM/yyyy", "yyyyMMdd")]
    return t.orders.select("o_orderkey", F.coalesce(*tries).cast("date").alias("day"))


@query("json_props", "E24 S13 K2", sql="""SELECT event_type, count(*) AS n, count(json_extract_string(props, '$.' || json_keys(props)[1])) AS with_first FROM events GROUP BY event_type""")
def json_props(t):
    first = F.get(F.map_values(F.from_json("props", "map<string,string>")), F.lit(0))
    return t.events.groupBy("event_type").agg(F.count("*").alias("n"), F.count(first).alias("with_first"))


@query("nested_report", "K2 S13", uses="det", sql="SELECT sample, count(DISTINCT genus) AS n_genera, count(DISTINCT organism) AS n_species, count(*) AS n_strains, sum(reads)::BIGINT AS reads FROM det GROUP BY sample")
def nested_report(t):
    nested = writers.nest(t.det, "sample", "genus", "organism", ["site", "reads"])
    flat = nested.select("sample", F.size("organisms").cast("bigint").alias("n_genera"), F.explode("organisms").alias("g")).select("sample", "n_genera", F.explode("g.members").alias("s"))
    per = flat.select("sample", "n_genera", F.size("s.members").alias("k"), F.aggregate("s.members", F.lit(0).cast("bigint"), lambda a, x: a + x["reads"]).alias("r"))
    return per.groupBy("sample", "n_genera").agg(F.count("*").alias("n_species"), F.sum("k").alias("n_strains"), F.sum("r").alias("reads"))


@query("flow_operators", "J25 U1 U3 channel", sql="""
WITH a AS (SELECT o_orderkey AS id, o_custkey AS meta, o_orderpriority AS kind FROM orders WHERE o_totalprice > 100000), b AS (SELECT o_orderkey AS id, o_orderstatus AS state FROM orders WHERE o_orderstatus <> 'P'),
j AS (SELECT coalesce(a.id, b.id) AS id, meta, kind, state FROM a FULL JOIN b ON a.id = b.id)
SELECT CASE WHEN kind IS NULL THEN 'right_only' WHEN state IS NULL THEN 'left_only' WHEN kind LIKE '1%' THEN 'urgent' ELSE 'both' END AS branch, count(*) AS n, count(DISTINCT meta) AS metas, min(id) AS first_id FROM j GROUP BY 1""")
def flow_operators(t):
    a = t.orders.where("o_totalprice > 100000").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("meta"), F.col("o_orderpriority").alias("kind"))
    b = t.orders.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("state"))
    j = a.join(b, "id", "full")
    branch = F.when(F.col("kind").isNull(), "right_only").when(F.col("state").isNull(), "left_only").when(F.col("kind").startswith("1"), "urgent").otherwise("both")
    return j.groupBy(branch.alias("branch")).agg(F.count("*").alias("n"), F.countDistinct("meta").alias("metas"), F.min("id").alias("first_id"))


@query("numbered_union", "U2", sql="SELECT k, row_number() OVER (ORDER BY k, src) - 1 AS \"index\", src FROM (SELECT c_custkey AS k, 'c' AS src FROM customer UNION ALL SELECT s_suppkey, 's' FROM supplier)")
def numbered_union(t):
    u = t.customer.select(F.col("c_custkey").alias("k"), F.lit("c").alias("src")).unionByName(t.supplier.select(F.col("s_suppkey").alias("k"), F.lit("s").alias("src")))
    return readers.numbered(u, [F.col("k"), F.col("src")])


@query("event_windows", "streaming window", sql="SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def event_windows(t):
    x = ew.windowed_counts(t.events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_type"], "value", "1 hour")
    return x.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("event_sessions", "streaming session", sql="""WITH f AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL '2 hours' THEN 0 ELSE 1 END AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT user_id, ts, sum(n) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS i FROM f)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '2 hours' AS session_end, count(*) AS n FROM s GROUP BY user_id, i""")
def event_sessions(t):
    x = ew.sessions(t.events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "user_id", "2 hours")
    return x.select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), F.col("session_end").cast("timestamp_ntz").alias("session_end"), "n")
