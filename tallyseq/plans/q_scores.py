"""Score, control and fitting queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyseq.functions import formulas as fx
from tallyseq.operators import conflict as cf
from tallyseq.operators import fit
from tallyseq.operators import intervals as iv
from tallyseq.operators import score as sc
from tallyseq.operators import shared as sh
from tallyseq.operators import weights as wt
from tallyseq.plans.base import query
from tallyseq.plans.q_conflict import _PAIRS
from tallyseq.session import materialize, scratch

R6 = lambda df, keys, cols: df.select(*keys, *[F.round(c, 6).alias(c) for c in cols])
_SIG = "CASE WHEN {s} * ({v} - {m}) >= 50 THEN 1.0 WHEN {s} * ({v} - {m}) <= -50 THEN 0.0 ELSE 1 / (1 + exp(-{s} * ({v} - {m}))) END"


@query("rank_disparity", "W2 W11 X14", uses="rec", sql="""SELECT ref_id, round(CASE WHEN count(*) OVER s > 1 THEN 1 - (row_number() OVER (PARTITION BY species ORDER BY reads DESC, ref_id) - 1) * 1.0 / (count(*) OVER s - 1) ELSE 1 END, 6) AS disparity,
 round(reads * 1.0 / sum(reads) OVER s, 6) AS share, round(reads * 1.0 / max(reads) OVER s, 6) AS top_ratio FROM rec WINDOW s AS (PARTITION BY species)""")
def rank_disparity(t):
    return R6(sc.rank_disparity(t.rec.drop("share"), "species", "reads", "ref_id"), ["ref_id"], ["disparity", "share", "top_ratio"])


@query("share_in_group", "W3 T3 W8", uses="rec", sql="""SELECT genus, ref_id, share_in, no FROM (SELECT genus, ref_id, round(reads * 1.0 / sum(reads) OVER (PARTITION BY genus), 6) AS share_in, row_number() OVER (PARTITION BY genus ORDER BY reads DESC, ref_id) AS no FROM rec) WHERE no <= 5""")
def share_in_group(t):
    x = t.rec.withColumn("share_in", F.round(F.col("reads") / F.sum("reads").over(Window.partitionBy("genus")), 6))
    return x.withColumn("no", F.row_number().over(Window.partitionBy("genus").orderBy(F.desc("reads"), "ref_id"))).where("no <= 5").select("genus", "ref_id", "share_in", "no")


@query("lead_margin", "W4", uses="rec", sql="""WITH x AS (SELECT species, reads, row_number() OVER (PARTITION BY species ORDER BY reads DESC) AS no FROM rec)
SELECT species, max(reads) AS top, max(CASE WHEN no = 2 THEN reads END) AS second, round((max(reads) - coalesce(max(CASE WHEN no = 2 THEN reads END), 0)) * 1.0 / sum(reads), 6) AS margin FROM x GROUP BY species""")
def lead_margin(t):
    return sc.lead_margin(t.rec, "species", "reads").select("species", "top", "second", F.round("margin", 6).alias("margin"))


_BREADTH = _SIG.format(s="12000.0", v="breadth", m="0.01")
#: Weights of the eight parts; they sum to 1.25 and are normalised.
_WEIGHTS = {"breadth": 0.27, "minhash": 0.31, "gini": 0.42, "disparity": 0.1, "population": 0.05, "mapq": 0.05, "k2_disparity": 0.03, "protein_identity": 0.02}
# the distribution function by the series of erf with factorials, unlike the nested form of the library
_CDF = "CASE WHEN z > 6 THEN 1 WHEN z < -6 THEN 0 ELSE 0.5 + z / 2 / sqrt(pi() / 2) * exp(-z * z / 2) * list_sum(list_transform(range(0, 80), lambda i: pow(z * z, i) * pow(2.0, i) * gamma(i + 1) / gamma(2 * i + 2))) END"
_TASS = f"""
c AS (SELECT *, {_BREADTH} * pow(hmf, 0.3) AS x_breadth, CASE WHEN contigs > 1 THEN pow(contigs_covered * 1.0 / contigs, 0.3) ELSE 1 END AS c_pen,
 pow(least(1.0, breadth / (1 - exp(-least(reads * read_length / length, 5.0)))), 0.3) AS d_pen,
 least(1.0, CASE WHEN gini BETWEEN 0 AND 1 THEN least(1.0, 1.8 * sqrt(1 - gini)) ELSE 0 END * (1 + 2 * log10(greatest(1.0, least(length, 1e9) / 5e5))) * (1 + 0.5 * disp)) AS x_gini0,
 CASE WHEN reads > 0 THEN 1 / (1 + exp(-2 * (log10(greatest(share * 1e6, 0.001)) - log10(5.0)))) ELSE 0 END AS x_abundance,
 CASE WHEN count(*) OVER s > 1 THEN 1 - (row_number() OVER (PARTITION BY species ORDER BY reads DESC, ref_id) - 1) * 1.0 / (count(*) OVER s - 1) ELSE 1 END AS x_disparity,
 reads * 1.0 / max(reads) OVER (PARTITION BY genus) AS x_k2, (share - avg(share) OVER (PARTITION BY genus)) / stddev_pop(share) OVER (PARTITION BY genus) AS z,
 CASE WHEN is_plasmid THEN sqrt(breadth * gini) * least(1, 0.7 * breadth / max(breadth) OVER s + 0.3 * reads / max(reads) OVER s) ELSE 0 END AS plasmid FROM rec WINDOW s AS (PARTITION BY species)),
q AS (SELECT *, {_CDF} AS p FROM c),
x AS (SELECT *, x_gini0 * c_pen * hmf * d_pen AS x_gini, minhash * greatest(d_pen * c_pen * {_BREADTH}, 0.7 * (1 - removal) * mapq01) AS x_minhash,
 CASE WHEN z IS NULL OR isnan(z) THEN 1 - pow(1 - 0.9986501019683699, 2) WHEN z < -1 THEN p * p WHEN z <= 1 THEN p WHEN z <= 2 THEN 1 - pow(1 - p, 1.5) ELSE 1 - pow(1 - p, 2) END AS x_population FROM q)"""


def _components(t):
    b = F.col("breadth")
    one, genus = Window.partitionBy("species"), Window.partitionBy("genus")
    x = sc.rank_disparity(t.rec.withColumn("_share", F.col("share")), "species", "reads", "ref_id").withColumn("share", F.col("_share"))
    x = x.withColumns({
        "x_breadth": sc.breadth_score(b, F.col("hmf")), "c_pen": sc.contig_penalty(F.col("contigs_covered"), F.col("contigs")),
        "d_pen": sc.depth_penalty(b, F.col("reads"), F.col("read_length"), F.col("length")),
        "x_gini0": sc.gini_score(F.col("gini"), F.col("length"), F.col("disp")), "x_abundance": sc.abundance_confidence(F.col("share"), F.lit(1.0)),
        "x_disparity": F.col("disparity"), "x_k2": F.col("reads") / F.max("reads").over(genus),
        "x_population": sc.population_percentile(F.col("share"), F.avg("share").over(genus), F.stddev_pop("share").over(genus)),
        "plasmid": F.when(F.col("is_plasmid"), sc.plasmid_score(None, "species", b, F.col("gini"), "breadth", "reads")).otherwise(F.lit(0.0))})
    gate = sc.group_gate(F.col("d_pen"), F.col("c_pen"), fx.sigmoid(b, 0.01, 12_000.0), F.col("removal"), F.col("mapq01"))
    return x.withColumns({"x_gini": sc.gini_component(F.col("x_gini0"), F.col("c_pen"), F.col("hmf"), F.col("d_pen")), "x_minhash": F.col("minhash") * gate})


def _parts():
    return {"breadth": F.col("x_breadth"), "minhash": F.col("x_minhash"), "gini": F.col("x_gini"), "disparity": F.col("x_disparity"), "population": F.col("x_population"),
            "mapq": F.col("mapq01"), "k2_disparity": F.col("x_k2"), "protein_identity": 0.9 * F.col("mapq01")}


@query("tass_components", "X1 X2 X3 X4 X5 E9 E11 E14", uses="rec", sql=f"""WITH {_TASS} SELECT ref_id, round(x_breadth, 6) AS x_breadth, round(x_gini0, 6) AS x_gini0, round(x_gini, 6) AS x_gini, round(x_minhash, 6) AS x_minhash,
 round(c_pen, 6) AS c_pen, round(d_pen, 6) AS d_pen, round(x_abundance, 6) AS x_abundance FROM x""")
def tass_components(t):
    return R6(_components(t), ["ref_id"], ["x_breadth", "x_gini0", "x_gini", "x_minhash", "c_pen", "d_pen", "x_abundance"])


@query("confidence_gate", "X6 X9 E8 E10", uses="rec", sql=f"""
WITH g AS (SELECT *, {_SIG.format(s='50000.0', v='share', m='0.0001')} AS w1, {_SIG.format(s='12.0', v='breadth', m='0.3')} AS conf FROM rec)
SELECT ref_id, round(w1, 6) AS rpm_weight, round(1 - pow(10, -mapq01 * 60 / 10), 6) AS mapq_prob,
 round(greatest(conf, 0.3 * mapq01 * (1 + share)) * ((1 - 0.35 * (1 - least(1, conf + 0.2 * mapq01))) + 0.35 * (1 - least(1, conf + 0.2 * mapq01)) * w1), 6) AS gate,
 round(greatest(hmf * disp * conf, 0.7 * (1 - removal) * mapq01), 6) AS group_gate, round(hmf + (1 - hmf) * least(greatest(minhash * (1 - 1.0 / 4), 0), 1), 6) AS relief FROM g""")
def confidence_gate(t):
    w1, conf = fx.sigmoid(F.col("share"), 0.0001, 50_000.0), fx.sigmoid(F.col("breadth"), 0.3, 12.0)
    x = t.rec.withColumns({
        "rpm_weight": w1, "mapq_prob": fx.mapq_probability(F.col("mapq01") * 60), "gate": sc.record_gate(conf, F.col("mapq01"), F.col("share"), w1),
        "group_gate": sc.group_gate(F.col("hmf"), F.col("disp"), conf, F.col("removal"), F.col("mapq01")), "relief": sc.mapq_relief(F.col("hmf"), F.col("minhash"), F.lit(4))})
    return R6(x, ["ref_id"], ["rpm_weight", "mapq_prob", "gate", "group_gate", "relief"])


@query("tass_score", "X10 X12 X14 E25 E29", uses="rec", sql=f"""WITH {_TASS},
s AS (SELECT *, (x_breadth * 0.27 + x_minhash * 0.31 + x_gini * 0.42 + x_disparity * 0.1 + x_population * 0.05 + mapq01 * 0.05 + x_k2 * 0.03 + 0.9 * mapq01 * 0.02) / 1.25 + 0.05 * x_abundance + 0.1 * plasmid AS raw FROM x),
w AS (SELECT *, pow(least(greatest(raw, 0), 1), 1 - 0.3 * x_k2) AS tass FROM s)
SELECT ref_id, round(plasmid, 6) AS plasmid, round(tass, 6) AS tass, round(tass * 100, 4) AS tass_pct, round(raw * x_abundance, 6) AS gated FROM w""")
def tass_score(t):
    x, weights = _components(t), sc.normalized_weights(_WEIGHTS)
    say = dict(plasmid=F.col("plasmid"), bonus=0.1, abundance=F.col("x_abundance"), abundance_weight=0.05)
    tass = sc.additive_score(_parts(), weights, **say, power=0.7, scale=F.col("x_k2"))
    gated = sc.additive_score(_parts(), weights, **say, gate=True, power=1.0)
    x = x.withColumns({"tass": tass, "gated": gated})
    return x.select("ref_id", F.round("plasmid", 6).alias("plasmid"), F.round("tass", 6).alias("tass"), F.round(fx.scale_percent(F.col("tass")), 4).alias("tass_pct"), F.round("gated", 6).alias("gated"))


@query("tass_penalized", "X11", uses="rec", sql=f"""WITH {_TASS},
k AS (SELECT *, ((x_breadth - 0.5) * 0.27 + (x_minhash - 0.5) * 0.31 + (x_gini - 0.5) * 0.42 + (x_disparity - 0.5) * 0.1 + (x_population - 0.5) * 0.05 + (mapq01 - 0.5) * 0.05 + (x_k2 - 0.5) * 0.03 + (0.9 * mapq01 - 0.5) * 0.02) / 1.25 AS away,
 (x_breadth * 0.27 + x_minhash * 0.31 + x_gini * 0.42 + x_disparity * 0.1 + x_population * 0.05) / 1.25 AS quality FROM x)
SELECT ref_id, round(least(greatest(0.5 + away * (0.7 + 0.3 * x_abundance) + 0.1 * plasmid * CASE WHEN quality < 0.15 THEN quality / 0.15 ELSE 1 END, 0), 1), 6) AS tass FROM k""")
def tass_penalized(t):
    score = sc.penalized_score(_parts(), sc.normalized_weights(_WEIGHTS), F.col("plasmid"), 0.1, F.col("x_abundance"), 0.3)
    return _components(t).select("ref_id", F.round(score, 6).alias("tass"))


@query("winner_loser", "X8", uses="rec", sql=f"""
WITH a AS (SELECT *, least(1.0, {_SIG.format(s='12.0', v='breadth', m='0.3')} + 0.3 * mapq01) AS ceil_, count(*) OVER s AS n, row_number() OVER (PARTITION BY species ORDER BY share DESC, ref_id) AS no, share / sum(share) OVER s AS mine FROM rec WINDOW s AS (PARTITION BY species)),
b AS (SELECT *, max(CASE WHEN no = 1 THEN breadth END) OVER s AS top_breadth, max(CASE WHEN no = 1 THEN mine END) OVER s AS first_, coalesce(max(CASE WHEN no = 2 THEN mine END) OVER s, 0) AS second_ FROM a WINDOW s AS (PARTITION BY species)),
c AS (SELECT *, (0.65 * (0.2 + 0.8 * mine) + 0.35 * (0.35 + 0.65 * least(1, breadth / top_breadth))) * CASE WHEN n > 2 THEN greatest(0.35, 1 / (1 + 0.3 * (n - 2))) ELSE 1 END * greatest(0.3, 1 - 0.5 * removal * least(1, (n - 1) / 5.0)) AS k0,
 least(1, greatest(0, (mine / first_ - 0.4) / 0.4)) * least(1, greatest(0, (breadth - 0.1) / 0.15)) * CASE WHEN n > 2 THEN greatest(0.1, 2.0 / n) ELSE 1 END AS par FROM b),
d AS (SELECT *, greatest(0.2, k0 + par * greatest(0, 0.8 - k0)) AS kept, least(ceil_, minhash + greatest(0, ceil_ - minhash) * least(1, mine + 0.75 * (mine - second_))) AS won FROM c)
SELECT ref_id, round(CASE WHEN n = 1 THEN 1 ELSE mine END, 6) AS rpm_share, round(CASE WHEN n = 1 THEN 1 WHEN no = 1 THEN won / minhash ELSE kept END, 6) AS factor,
 round(CASE WHEN n = 1 THEN least(ceil_, minhash + 0.9 * greatest(0, ceil_ - minhash) * mapq01) WHEN no = 1 THEN won ELSE minhash * kept END, 6) AS minhash_shared FROM d""")
def winner_loser(t):
    x = t.rec.withColumn("n_partners", F.count("*").over(Window.partitionBy("species")) - 1)
    ceiling = F.least(F.lit(1.0), fx.sigmoid(F.col("breadth"), 0.3, 12.0) + 0.3 * F.col("mapq01"))
    x = sc.share_minhash(x, "species", "share", "ref_id", "minhash", ceiling, F.col("breadth"), F.col("mapq01"), F.col("removal"), F.col("n_partners"))
    return R6(x, ["ref_id"], ["rpm_share", "factor", "minhash_shared"])


@query("population_percentile", "X13 E18", uses="rec", sql=f"""WITH {_TASS} SELECT ref_id, round(x_population, 6) AS percentile FROM x""")
def population_percentile(t):
    pop = t.rec.groupBy("genus").agg(F.avg("share").alias("m"), F.stddev_pop("share").alias("sd"))
    return t.rec.join(F.broadcast(pop), "genus").select("ref_id", F.round(sc.population_percentile(F.col("share"), F.col("m"), F.col("sd")), 6).alias("percentile"))


_CTL = "n AS (SELECT organism, max(reads) AS neg_max FROM ctl WHERE polarity = 'negative' GROUP BY organism), p AS (SELECT organism, min(reads) AS pos_min FROM ctl WHERE polarity = 'positive' GROUP BY organism)"


@query("control_comparison", "J16 X16", uses="ctl", sql=f"""WITH {_CTL}, j AS (SELECT c.source, c.organism, neg_max, pos_min, CASE WHEN neg_max > 0 THEN c.reads / neg_max END AS fold_neg, CASE WHEN pos_min > 0 THEN c.reads / pos_min END AS fold_pos
 FROM ctl c LEFT JOIN n USING (organism) LEFT JOIN p USING (organism) WHERE polarity = 'sample')
SELECT source, organism, round(fold_neg, 6) AS fold_neg, round(fold_pos, 6) AS fold_pos, CASE WHEN neg_max IS NULL THEN 'no_control' WHEN fold_neg < 2.0 THEN 'within_negative' ELSE 'above_negative' END AS neg_flag FROM j""")
def control_comparison(t):
    part = lambda p: t.ctl.where(F.col("polarity") == p)
    x = sc.control_flags(part("sample"), part("negative").select("organism", "reads"), part("positive").select("organism", "reads"), "organism", "reads")
    return x.select("source", "organism", F.round("fold_neg", 6).alias("fold_neg"), F.round("fold_pos", 6).alias("fold_pos"), "neg_flag")


@query("missing_controls", "J17 J18 U3", uses="ctl", sql="""
SELECT 'missing' AS kind, organism, max(reads)::BIGINT AS reads FROM ctl WHERE polarity = 'positive' AND organism NOT IN (SELECT organism FROM ctl WHERE source = '3-MEDIUM' AND reads > 480) GROUP BY organism
UNION ALL SELECT 'sample_only', organism, max(reads)::BIGINT FROM ctl WHERE source = '3-MEDIUM' AND organism NOT IN (SELECT organism FROM ctl WHERE polarity = 'negative' AND reads > 480) GROUP BY organism""")
def missing_controls(t):
    own = t.ctl.where("source = '3-MEDIUM'")
    missing = sc.missing_controls(own.where("reads > 480"), t.ctl.where("polarity = 'positive'"), "organism", "reads").select(F.lit("missing").alias("kind"), "organism", "reads")
    only = own.join(t.ctl.where("polarity = 'negative' and reads > 480").select("organism"), "organism", "left_anti")
    return missing.unionByName(only.groupBy("organism").agg(F.max("reads").alias("reads")).select(F.lit("sample_only").alias("kind"), "organism", "reads"))


@query("novelty_score", "X17 A40 R15", sql="""
WITH c AS (SELECT source, count(*) AS tot, sum(CASE WHEN n_chars > 500 THEN 1 ELSE 0 END) AS placed, sum(CASE WHEN lang = 'en' THEN 1 ELSE 0 END) AS high, sum(CASE WHEN n_chars > 2000 THEN 1 ELSE 0 END) AS low FROM documents GROUP BY source),
x AS (SELECT source, greatest(0, (tot - placed) * 1.0 / tot) AS dark, high * 1.0 / tot AS high, low * 1.0 / tot AS low FROM c),
b AS (SELECT avg(dark) AS dm, stddev_pop(dark) AS ds, avg(high) AS hm, stddev_pop(high) AS hs, avg(low) AS lm, stddev_pop(low) AS ls FROM x WHERE source < 'src2'),
z AS (SELECT source, dark, CASE WHEN ds > 1e-9 THEN (dark - dm) / ds ELSE 10 * (dark - dm) END AS zd, CASE WHEN hs > 1e-9 THEN (high - hm) / hs ELSE 10 * (high - hm) END AS zh, CASE WHEN ls > 1e-9 THEN (low - lm) / ls ELSE 10 * (low - lm) END AS zl FROM x, b)
SELECT source, round(dark, 6) AS dark, round(0.5 * zd + 0.3 * zh + 0.2 * zl, 6) AS novelty, 0.5 * zd + 0.3 * zh + 0.2 * zl >= 2.0 AS flagged FROM z""")
def novelty_score(t):
    c = t.documents.groupBy("source").agg(F.count("*").alias("tot"), F.count_if(F.col("n_chars") > 500).alias("placed"), F.count_if(F.col("lang") == "en").alias("hi"), F.count_if(F.col("n_chars") > 2000).alias("lo"))
    x = sc.novelty(c, F.greatest(F.lit(0.0), (F.col("tot") - F.col("placed")) / F.col("tot")), F.col("hi") / F.col("tot"), F.col("lo") / F.col("tot"), F.col("source") < "src2")
    return x.select("source", F.round("dark", 6).alias("dark"), F.round("novelty", 6).alias("novelty"), "flagged")


@query("threshold_fallback", "X24", uses="samples", sql="""
WITH d AS (SELECT * FROM (VALUES ('BUILDING', '1', 10.0), ('BUILDING', 'all', 20.0), ('all', '2', 30.0), ('all', 'all', 40.0)) v(segment, site, cutoff))
SELECT sample, coalesce((SELECT cutoff FROM d WHERE d.segment = s.segment AND d.site = s.site::VARCHAR), (SELECT cutoff FROM d WHERE d.segment = s.segment AND d.site = 'all'),
 (SELECT cutoff FROM d WHERE d.segment = 'all' AND d.site = s.site::VARCHAR), (SELECT cutoff FROM d WHERE d.segment = 'all' AND d.site = 'all'))::DOUBLE AS cutoff FROM samples s""")
def threshold_fallback(t):
    s = t.samples.select("sample", F.col("segment").alias("seg"), F.col("site").cast("string").alias("place"))
    dim = t.samples.sparkSession.createDataFrame([("BUILDING", "1", 10.0), ("BUILDING", "all", 20.0), ("all", "2", 30.0), ("all", "all", 40.0)], "segment string, site string, cutoff double")
    keys = [[("seg", "segment"), ("place", "site")], [("seg", "segment")], [("place", "site")], []]
    return sc.first_match(s, dim, keys, "cutoff", "cutoff").select("sample", "cutoff")


@query("priority_assembly", "X22 J3 W6", sql="""WITH a AS (SELECT p_brand, p_size, p_partkey, CASE WHEN p_type LIKE '%ECONOMY%' THEN 0 WHEN p_type LIKE '%MEDIUM%' THEN 1 WHEN p_size > 25 THEN 2 ELSE 3 END AS priority FROM part)
SELECT p_brand, p_size, arg_min(p_partkey, (priority, p_partkey)) AS p_partkey, min(priority)::INT AS priority FROM a GROUP BY p_brand, p_size""")
def priority_assembly(t):
    pr = F.when(F.col("p_type").contains("ECONOMY"), 0).when(F.col("p_type").contains("MEDIUM"), 1).when(F.col("p_size") > 25, 2).otherwise(3)
    return t.part.groupBy("p_brand", "p_size").agg(F.min(F.struct(pr.alias("priority"), F.col("p_partkey"))).alias("b")).select("p_brand", "p_size", "b.p_partkey", "b.priority")


_LAB = "l AS (SELECT labels.doc_id, quality, least(100, n_chars // 40)::BIGINT AS score, source, lang FROM labels JOIN documents USING (doc_id))"


def _labelled(t):
    return t.labels.join(t.documents, "doc_id").select("doc_id", "quality", F.least(F.lit(100), F.floor(F.col("n_chars") / 40)).alias("score"), "source", "lang")


@query("confusion_matrix", "A18 A19 A20 E1", sql=f"""WITH {_LAB}, c AS (SELECT source, sum((quality = 1 AND score >= 30)::INT) AS tp, sum((quality = 0 AND score >= 30)::INT) AS fp, sum((quality = 1 AND score < 30)::INT) AS fn, sum((quality = 0 AND score < 30)::INT) AS tn FROM l GROUP BY source)
SELECT source, tp::BIGINT AS tp, fp::BIGINT AS fp, fn::BIGINT AS fn, tn::BIGINT AS tn, round(CASE WHEN tp + fp > 0 THEN tp * 1.0 / (tp + fp) ELSE 0 END, 6) AS precision, round(CASE WHEN tp + fn > 0 THEN tp * 1.0 / (tp + fn) ELSE 0 END, 6) AS recall,
 round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1 FROM c""")
def confusion_matrix(t):
    return fit.confusion(_labelled(t), ["source"], F.col("quality") == 1, F.col("score") >= 30)


@query("retention_curve", "A49", sql=f"""WITH {_LAB}, k AS (SELECT range AS cutoff FROM range(1, 100))
SELECT cutoff, (SELECT count(*) FROM l WHERE quality = 1 AND score >= cutoff) AS tp, (SELECT count(*) FROM l WHERE quality = 0 AND score >= cutoff) AS fp FROM k""")
def retention_curve(t):
    return fit.retention(_labelled(t), F.col("quality") == 1, "score", 1, 99)


@query("youden_cutoff", "W12 A38", sql=f"""WITH {_LAB}, s AS (SELECT lang, score, sum((quality = 1)::INT) AS p, sum((quality = 0)::INT) AS n FROM l GROUP BY lang, score),
c AS (SELECT lang, score, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER (PARTITION BY lang) AS pp, sum(n) OVER (PARTITION BY lang) AS nn FROM s WINDOW w AS (PARTITION BY lang ORDER BY score DESC)),
j AS (SELECT lang, score, round(tp * 1.0 / pp - fp * 1.0 / nn, 6) AS j FROM c WHERE pp > 0 AND nn > 0)
SELECT lang, arg_max(score, (j, -score)) AS cutoff, max(j) AS youden FROM j GROUP BY lang""")
def youden_cutoff(t):
    return fit.youden(_labelled(t), "lang", F.col("quality") == 1, "score")


@query("precision_levels", "A50", sql=f"""WITH {_LAB}, u AS (SELECT 'key' AS level, source || '/' || lang AS grp, * FROM l UNION ALL SELECT 'subkey', source, * FROM l UNION ALL SELECT 'toplevelkey', lang, * FROM l),
g AS (SELECT level, grp, max(quality) = 1 AS truth, max(score) >= 99 AS called FROM u GROUP BY level, grp)
SELECT level, sum((truth AND called)::INT)::BIGINT AS tp, sum((NOT truth AND called)::INT)::BIGINT AS fp, sum((truth AND NOT called)::INT)::BIGINT AS fn FROM g GROUP BY level""")
def precision_levels(t):
    u = _labelled(t)
    lev = F.explode(F.array(F.struct(F.lit("key").alias("level"), F.concat_ws("/", "source", "lang").alias("grp")), F.struct(F.lit("subkey").alias("level"), F.col("source").alias("grp")), F.struct(F.lit("toplevelkey").alias("level"), F.col("lang").alias("grp"))))
    g = u.select(lev.alias("l"), "quality", "score").groupBy("l.level", "l.grp").agg((F.max("quality") == 1).alias("truth"), (F.max("score") >= 99).alias("called"))
    return g.groupBy("level").agg(F.count_if(F.col("truth") & F.col("called")).alias("tp"), F.count_if(~F.col("truth") & F.col("called")).alias("fp"), F.count_if(F.col("truth") & ~F.col("called")).alias("fn"))


@query("weight_grid", "X19", uses="rec", sql="""
WITH w AS (SELECT a / 5.0 AS w1, b / 5.0 AS w2, (5 - a - b) / 5.0 AS w3 FROM range(0, 6) x(a), range(0, 6) y(b) WHERE a + b <= 5),
s AS (SELECT w1, w2, w3, least(greatest(w1 * breadth + w2 * minhash + w3 * gini, 1e-6), 1 - 1e-6) AS p, reads % 2 = 0 AS y FROM rec, w)
SELECT round(w1, 4) AS w1, round(w2, 4) AS w2, round(w3, 4) AS w3, round(avg(CASE WHEN y THEN -ln(p) ELSE -ln(1 - p) END) + 0.01 * any_value(w1 * w1 + w2 * w2 + w3 * w3), 6) AS loss FROM s GROUP BY w1, w2, w3""")
def weight_grid(t):
    return fit.grid_loss(t.rec, ["breadth", "minhash", "gini"], F.col("reads") % 2 == 0, 5).select(*[F.round(f"w{i}", 4).alias(f"w{i}") for i in (1, 2, 3)], F.round("loss", 6).alias("loss"))


#: Rules with every term, and candidates: five weights, bonus, power.
_RULES = wt.Rules(
    mode="hybrid", hybrid=0.6, positive=2.0, ridge=0.05, entropy=0.1, prior={"breadth": 0.4}, prior_weight=0.3, abundance=0.05, tp_target=0.9, tp_target_weight=0.5, tp_target_scope="hybrid",
    scope="hybrid", youden=0.4, youden_least=0.05, high_cutoff=0.2, fp_cutoff=0.3, fp_cutoff_weight=0.25, tp_floor_weight=0.6, fp_ceiling_weight=0.7, separation=0.15)
_CANDIDATES = [(0.2, 0.2, 0.2, 0.2, 0.2, 0.0, 1.0), (0.5, 0.1, 0.2, 0.1, 0.1, 0.1, 0.5), (0.0, 0.3, 0.3, 0.4, 0.0, 0.2, 0.3), (1.0, 0.0, 0.0, 0.0, 0.0, 0.05, 0.8)]


def _fit_rows(t):
    reads = F.col("reads")
    return _components(t).select(
        "ref_id", "species", "genus", F.col("x_breadth").alias("breadth"), F.col("x_minhash").alias("minhash"), F.col("x_gini").alias("gini"), F.col("x_disparity").alias("disparity"), F.col("x_population").alias("population"), "plasmid",
        F.col("x_abundance").alias("abundance"), F.when(F.col("ref_id") % 3 > 0, reads).otherwise(0).alias("tp"), (reads % 5).alias("fp"))


@query("weight_losses", "X19", uses="rec", sql=f"""WITH {_TASS}, f AS (SELECT x_breadth, x_minhash, x_gini, x_disparity, x_population, plasmid, x_abundance, CASE WHEN ref_id % 3 > 0 THEN reads ELSE 0 END::DOUBLE AS tp, (reads % 5)::DOUBLE AS fp FROM x),
g AS (SELECT *, (tp > 0)::INT::DOUBLE AS y, (tp = 0)::INT::DOUBLE AS z FROM f WHERE tp + fp >= 1), n AS (SELECT sum(tp) AS tp, sum(fp) AS fp, sum(y) AS y, sum(z) AS z FROM g),
cd AS (SELECT * FROM (VALUES {', '.join(f"({i}, {[float(x) for x in c[:5]]}, {c[5]}::DOUBLE, {c[6]}::DOUBLE)" for i, c in enumerate(_CANDIDATES))}) AS v(c, w, bonus, power)),
p AS (SELECT c, g.tp, g.fp, g.y, g.z, greatest(1e-6, least(1 - 1e-6, pow(least(1.0, greatest(0.0, w[1] * x_breadth + w[2] * x_minhash + w[3] * x_gini + w[4] * x_disparity + w[5] * x_population + bonus * plasmid + 0.05 * x_abundance)), power))) AS p FROM g, cd),
u AS (SELECT c, any_value(n.tp) AS nt, any_value(n.fp) AS nf, any_value(n.y) AS ny, any_value(n.z) AS nz, -sum(p.tp * ln(p)) AS rp, -sum(p.fp * ln(1 - p)) AS rn, -sum(p.y * ln(p)) AS tp_, -sum(p.z * ln(1 - p)) AS tn_, sum(p.y * p) AS my, sum(p.tp * p) AS mt,
 sum(p.y * pow(greatest(0, 0.7 - p), 2)) AS short, sum(p.z * pow(greatest(0, p - 0.15), 2)) AS above, min(floor(p * 100)) AS low, max(floor(p * 100)) AS high FROM p, n GROUP BY c),
k AS (SELECT p.c, t, 0.6 * sum((p >= t)::INT * p.y) / any_value(n.y) + 0.4 * sum((p >= t)::INT * p.tp) / any_value(n.tp) AS keep, 0.6 * sum((p >= t)::INT * p.z) / any_value(n.z) + 0.4 * sum((p >= t)::INT * p.fp) / any_value(n.fp) AS wrong FROM p, n, (SELECT unnest([0.1, 0.2, 0.3, 0.5, 0.7]) AS t) GROUP BY p.c, t),
sep AS (SELECT c, sum(pow(greatest(0, 0.95 - keep), 2) + CASE WHEN t >= 0.15 THEN pow(greatest(0, wrong - 0.05), 2) ELSE 0 END) AS shape, max(CASE WHEN t = 0.3 THEN wrong END) AS cut FROM k GROUP BY c),
j AS (SELECT p.c, s, 0.6 * sum((floor(p * 100) >= s)::INT * p.y) / any_value(n.y) + 0.4 * sum((floor(p * 100) >= s)::INT * p.tp) / any_value(n.tp) - 0.6 * sum((floor(p * 100) >= s)::INT * p.z) / any_value(n.z) - 0.4 * sum((floor(p * 100) >= s)::INT * p.fp) / any_value(n.fp) AS j FROM p, n, range(5, 100) r(s) GROUP BY p.c, s),
b AS (SELECT c, max(j) AS best FROM j GROUP BY c), a AS (SELECT j.c, min(s) AS place, any_value(best) AS best FROM j JOIN b USING (c) WHERE j.j >= best - 1e-12 GROUP BY j.c)
SELECT c AS candidate, round((2 * (0.6 * tp_ / ny + 0.4 * rp / nt) + (0.6 * tn_ / nz + 0.4 * rn / nf)) / 3 + 0.05 * list_sum(list_transform(w, lambda v: pow(v - 0.2, 2))) + 0.1 * (1 + list_sum(list_transform(w, lambda v: greatest(v, 1e-8) * ln(greatest(v, 1e-8)))) / ln(5))
 + 0.3 * pow(w[1] - 0.4, 2) + 0.5 * pow(greatest(0, 0.9 - (0.6 * my / ny + 0.4 * mt / nt)), 2) + 0.25 * cut + 0.15 * shape + 0.6 * short / ny + 0.7 * above / nz + 0.4 * (1 - best) + 0.2 * (1 - (greatest(low, least(high, place)) - low) / greatest(1, high - low)), 6) AS loss
FROM u JOIN cd USING (c) JOIN sep USING (c) JOIN a USING (c)""")
def weight_losses(t):
    rows = materialize(_fit_rows(t), "fit-rows")
    found = wt.losses(rows, np.array(_CANDIDATES), _RULES, np.full(5, 0.2))
    return t.lineitem.sparkSession.createDataFrame([(i, round(x, 6)) for i, x in enumerate(found.tolist())], "candidate int, loss double")


@query("weight_fit", "X19", uses="rec", sql=None)
def weight_fit(t):
    """Weights at three levels: the search draws at random, so no SQL."""
    levels = {"key": F.col("ref_id"), "subkey": F.col("species"), "toplevelkey": F.col("genus")}
    found = wt.fit_levels(materialize(_fit_rows(t), "fit-rows"), levels, _RULES, generations=8, population=40, finish=4)
    kind = "level string, " + ", ".join(f"{p} double" for p in wt.PARTS) + ", bonus double, power double, loss double, status string"
    return t.lineitem.sparkSession.createDataFrame([(f["level"], *[f["weights"][p] for p in wt.PARTS], f["bonus"], f["power"], f["loss"], f["status"]) for f in found], kind)


@query("sketch_sweep", "X20", uses="seqs", sql=None)
def sketch_sweep(t):
    return fit.sketch_sweep(t.seqs, "seq_id", "grp", "text", sizes=(3, 5), scaled=(16, 64), threshold=0.5)


# reads of 40 words cut from the texts, with a second alignment to the text after their own
_READS = """
v AS (SELECT seq_id, grp, CASE WHEN trim(lower(text)) = '' THEN [] ELSE string_split_regex(trim(lower(text)), '\\s+') END AS w FROM seqs),
r AS (SELECT seq_id || '_' || s || '_1' AS read_id, seq_id AS truth, seq_id + d AS ref_id, s, s + 40 AS e, CASE WHEN d = 0 THEN 20 + (seq_id + s) % 30 ELSE (7 * seq_id + s) % 45 END AS mapq FROM (SELECT seq_id, unnest(range(0, len(w) - 39, 40)) AS s FROM v), (SELECT unnest([0, 1]) AS d))"""


def _text_reads(t):
    n = F.size(F.filter(F.split(F.trim(F.lower(F.coalesce("text", F.lit("")))), r"\s+"), lambda w: w != ""))
    s = t.seqs.select("seq_id", n.alias("n")).where("n >= 40").select("seq_id", F.explode(F.sequence(F.lit(0).cast("bigint"), (F.col("n") - 40).cast("bigint"), F.lit(40).cast("bigint"))).alias("s"))
    both = s.withColumn("d", F.explode(F.array(F.lit(0), F.lit(1))))
    return both.select(
        F.concat_ws("_", F.col("seq_id").cast("string"), F.col("s").cast("string"), F.lit("1")).alias("read_id"), F.col("seq_id").alias("truth"), (F.col("seq_id") + F.col("d")).alias("ref_id"), "s", (F.col("s") + 40).alias("e"),
        F.when(F.col("d") == 0, 20 + (F.col("seq_id") + F.col("s")) % 30).otherwise((7 * F.col("seq_id") + F.col("s")) % 45).alias("mapq"))


_POSITIONED = "('0x' || substr(md5(array_to_string(w[i + 1:i + k], ' ')), 1, 15))::BIGINT"


@query("sketch_settings", "X20", uses="seqs", sql=f"""WITH {_READS},
t AS (SELECT row_number() OVER (ORDER BY k, sc, wi, st) AS no, * FROM (SELECT unnest([3, 5]) AS k), (SELECT unnest([4, 16]) AS sc), (SELECT unnest([40, 80]) AS wi), (SELECT unnest([20, 40]) AS st)),
h AS (SELECT seq_id, len(w) AS n, k, i, {_POSITIONED} AS hash FROM (SELECT seq_id, w, k, unnest(range(0, len(w) - k + 1)) AS i FROM v, (SELECT unnest([3, 5]) AS k) WHERE len(w) >= k)),
f AS (SELECT * FROM h WHERE hash < 1152921504606846976 // 4),
m AS (SELECT DISTINCT no, seq_id, a AS w0, hash FROM (SELECT no, seq_id, hash, i, wi, unnest(range(0, n - wi + 1, st)) AS a FROM f JOIN t ON t.k = f.k AND hash < 1152921504606846976 // sc WHERE n >= wi) WHERE i >= a AND i < a + wi),
z AS (SELECT no, seq_id, w0, count(*) AS n FROM m GROUP BY ALL),
p AS (SELECT a.no, a.seq_id AS q, a.w0 AS qw, b.seq_id AS c, b.w0 AS cw, count(*) AS shared FROM m a JOIN m b ON a.no = b.no AND a.hash = b.hash AND a.seq_id <> b.seq_id GROUP BY ALL),
j AS (SELECT p.*, shared * 1.0 / (x.n + y.n - shared) AS jac FROM p JOIN z x ON x.no = p.no AND x.seq_id = q AND x.w0 = qw JOIN z y ON y.no = p.no AND y.seq_id = c AND y.w0 = cw),
kk AS (SELECT no, greatest(40, ceil(0.1::DOUBLE * count(DISTINCT seq_id))) AS top FROM z GROUP BY no),
s AS (SELECT j.* FROM j JOIN kk USING (no) WHERE jac >= 0.5 QUALIFY row_number() OVER (PARTITION BY j.no, q, qw ORDER BY jac DESC, c, cw) <= any_value(top) OVER (PARTITION BY j.no)),
g AS (SELECT s.no, read_id, ref_id, r.s AS rs, count(DISTINCT c) AS alt FROM s JOIN t USING (no) JOIN r ON ref_id = q AND r.s < qw + wi AND r.e > qw GROUP BY ALL),
o AS (SELECT t.no, r.read_id, r.ref_id, r.truth, r.mapq - 23.0 * coalesce(alt, 0) AS sc FROM t CROSS JOIN r LEFT JOIN g ON g.no = t.no AND g.read_id = r.read_id AND g.ref_id = r.ref_id AND g.rs = r.s),
b AS (SELECT *, max(sc) OVER (PARTITION BY no, read_id) AS top, max(sc) OVER (PARTITION BY no, read_id, ref_id) AS own FROM o),
e AS (SELECT no, sum((truth = ref_id)::INT) AS total_tp, sum((truth <> ref_id)::INT) AS total_fp, sum((truth = ref_id AND own < top)::INT) AS tp_removed, sum((truth <> ref_id AND own < top)::INT) AS fp_removed FROM b GROUP BY no),
u AS (SELECT no, count(*) AS n_shared FROM s GROUP BY no),
y AS (SELECT e.*, t.*, coalesce(n_shared, 0) AS n_shared, total_fp - fp_removed AS fr, tp_removed * 1.0 / total_tp AS lost, total_fp - fp_removed + tp_removed AS score FROM e JOIN t ON t.no = e.no LEFT JOIN u ON u.no = e.no)
SELECT k AS size, sc::BIGINT AS scaled, wi::BIGINT AS window, st::BIGINT AS step, total_tp::BIGINT AS total_tp, total_fp::BIGINT AS total_fp, tp_removed::BIGINT AS tp_removed, fp_removed::BIGINT AS fp_removed, n_shared::BIGINT AS n_shared, fr::BIGINT AS fp_remaining, round(lost, 6) AS tp_loss, score::DOUBLE AS score,
 row_number() OVER (ORDER BY score, no) = 1 AS best, row_number() OVER (ORDER BY score, no) = 1 AND fr = 0 AND lost <= 0.01 AS success FROM y""")
def sketch_settings(t):
    grid = {"size": [3, 5], "scaled": [4, 16], "window": [40, 80], "step": [20, 40]}
    out = sh.sketch_sweep(t.seqs.select("seq_id", "text"), "seq_id", "text", _text_reads(t), "read_id", "ref_id", F.col("mapq"), F.col("truth"), grid, threshold=0.5)
    return out.withColumns({"tp_loss": F.round("tp_loss", 6), "score": F.col("score").cast("double")})


@query("synthetic_abundance", "X21", sql="""
WITH u AS (SELECT s_suppkey, s_nationkey, -ln((('0x' || substr(md5('7:' || s_suppkey), 1, 8))::BIGINT + 1) / 4294967297.0) AS g FROM supplier)
SELECT s_suppkey, round(g / sum(g) OVER (PARTITION BY s_nationkey), 6) AS weight FROM u""")
def synthetic_abundance(t):
    return fit.dirichlet(t.supplier, "s_suppkey", "s_nationkey", 7).select("s_suppkey", F.round("weight", 6).alias("weight"))


_REPORT = f"""RECURSIVE {_PAIRS},
e AS MATERIALIZED (SELECT ref1 AS u, ref2 AS v FROM j UNION SELECT ref2, ref1 FROM j), r AS (SELECT u AS node, u AS root FROM e UNION SELECT e.v, r.root FROM r JOIN e ON e.u = r.node),
comp AS (SELECT node AS ref_id, min(root) AS grp FROM r GROUP BY node), c0 AS (SELECT ref_id, count(DISTINCT read_id) AS n FROM aln GROUP BY ref_id), m AS (SELECT grp, c0.ref_id, c0.n FROM c0 JOIN comp USING (ref_id)),
x AS (SELECT *, min(n) OVER g AS lo, max(n) OVER g AS hi, row_number() OVER (PARTITION BY grp ORDER BY n DESC, ref_id) AS k, count(*) OVER g AS c FROM m WINDOW g AS (PARTITION BY grp)),
y AS (SELECT *, max(CASE WHEN k = 2 THEN n END) OVER (PARTITION BY grp) AS nd FROM x), z AS (SELECT *, CASE WHEN k = 1 THEN lo * (1 - least(greatest((hi * 1.0 / nd - 1) / 2, 0), 1)) ELSE lo END AS base FROM y WHERE c > 1),
bud AS (SELECT ref_id, least(n, floor(base + 1e-9) + floor((1 - n * 1.0 / hi) * greatest(0, n - base) + 1e-9))::BIGINT AS budget FROM z),
q AS (SELECT DISTINCT ref_id, read_id FROM aln), o AS (SELECT q.ref_id, read_id, budget, row_number() OVER (PARTITION BY q.ref_id ORDER BY md5('1:' || q.ref_id || ':' || read_id), read_id) AS no FROM q JOIN bud USING (ref_id)),
rm AS (SELECT ref_id, read_id FROM o WHERE no <= budget), kept AS (SELECT * FROM aln WHERE NOT EXISTS (SELECT 1 FROM rm WHERE rm.ref_id = aln.ref_id AND rm.read_id = aln.read_id)),
v AS (SELECT 0 AS after, ref_id, s, e FROM aln UNION ALL SELECT 1, ref_id, s, e FROM kept),
i1 AS (SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY after, ref_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 1 ELSE 0 END AS f FROM v), i2 AS (SELECT *, sum(f) OVER (PARTITION BY after, ref_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS no FROM i1),
i3 AS (SELECT after, ref_id, max(e) - min(s) AS bp FROM i2 GROUP BY after, ref_id, no), cov AS (SELECT ref_id, sum(CASE WHEN after = 0 THEN bp ELSE 0 END) AS bp0, sum(CASE WHEN after = 1 THEN bp ELSE 0 END) AS bp1 FROM i3 GROUP BY ref_id),
c1 AS (SELECT ref_id, count(DISTINCT read_id) AS n1 FROM kept GROUP BY ref_id),
one AS (SELECT rec.ref_id, rec.species, rec.genus, rec.length, rec.hmf, rec.gini, rec.disp, c0.n AS n0, coalesce(n1, 0) AS n1, bp0, bp1 FROM rec JOIN c0 USING (ref_id) JOIN cov USING (ref_id) LEFT JOIN c1 USING (ref_id)),
lv AS (SELECT 'strain' AS level, ref_id::BIGINT AS grp, species::BIGINT AS parent, * FROM one UNION ALL SELECT 'species', species, genus, * FROM one UNION ALL SELECT 'genus', genus, -1, * FROM one),
ag AS (SELECT level, grp, parent, sum(n0) AS n0, sum(n1) AS n1, sum(bp0) * 1.0 / sum(length) AS b0, sum(bp1) * 1.0 / sum(length) AS b1, sum(length) AS length, sum(hmf * n0) / sum(n0) AS hmf, sum(gini * n0) / sum(n0) AS gini, sum(disp * n0) / sum(n0) AS disp FROM lv GROUP BY level, grp, parent),
sc AS (SELECT *, {_SIG.format(s='12000.0', v='b1', m='0.01')} * pow(hmf, 0.3) AS xb, least(1.0, 0.3 * least(1.0, b1 / b0) + 0.7 * n1 / n0) AS xm,
 least(1.0, least(1.0, 1.8 * sqrt(1 - gini)) * (1 + 2 * log10(greatest(1.0, least(length, 1e9) / 5e5))) * (1 + 0.5 * disp)) * hmf AS xg, n0 * 1.0 / max(n0) OVER (PARTITION BY level, parent) AS dom FROM ag)
SELECT level, grp, n0::BIGINT AS reads_before, n1::BIGINT AS reads_after, round(b0, 6) AS breadth_before, round(b1, 6) AS breadth_after, round(pow(least(1, 0.27 * xb + 0.31 * xm + 0.42 * xg), 1 - 0.3 * dom), 6) AS tass FROM sc"""


@query("sample_report", "A4 A5 A7 A11 A12 K4 X1 X2 X7 X10", uses="aln rec", sql="WITH " + _REPORT)
def sample_report(t):
    """Alignments to scores: conflict groups, removal, coverage before and after, totals at three levels."""
    with scratch(t.aln.sparkSession) as keep:
        n = t.aln.groupBy("ref_id").agg(F.countDistinct("read_id").alias("n"))
        groups = cf.read_clusters(t.aln).select(F.col("node").alias("ref_id"), F.col("component").alias("grp"))
        budget = cf.removal_budget(n.join(groups, "ref_id"), "grp", "ref_id", "n")
        kept = keep(materialize(cf.drop_removed(t.aln, cf.removed_reads(t.aln, budget, "read_id", "ref_id"), "read_id", "ref_id").select("ref_id", "read_id", "s", "e"), "report-kept"))
    both = t.aln.select(F.lit("before").alias("variant"), "ref_id", "s", "e").unionByName(kept.select(F.lit("after").alias("variant"), "ref_id", "s", "e"))
    cov = iv.covered_length(both, ["variant", "ref_id"]).groupBy("ref_id").pivot("variant", ["before", "after"]).agg(F.sum("covered"))
    one = t.rec.join(n, "ref_id").join(cov, "ref_id").join(kept.groupBy("ref_id").agg(F.countDistinct("read_id").alias("n1")), "ref_id", "left")
    lev = lambda name, c, up: F.struct(F.lit(name).alias("level"), F.col(c).cast("bigint").alias("grp"), up.cast("bigint").alias("parent"))
    levels = F.inline(F.array(lev("strain", "ref_id", F.col("species")), lev("species", "species", F.col("genus")), lev("genus", "genus", F.lit(-1))))
    mean = lambda c: (F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(c)
    total = lambda c: F.sum(F.coalesce(c, F.lit(0)))
    a = one.select("*", levels).groupBy("level", "grp", "parent").agg(
        F.sum("n").alias("reads_before"), total("n1").alias("reads_after"), (F.sum("before") / F.sum("length")).alias("b0"), (total("after") / F.sum("length")).alias("b1"), F.sum("length").alias("length"), mean("hmf"), mean("gini"), mean("disp"))
    kept_share = F.least(F.lit(1.0), 0.3 * F.least(F.lit(1.0), F.col("b1") / F.col("b0")) + 0.7 * F.col("reads_after") / F.col("reads_before"))
    even = sc.gini_component(sc.gini_score(F.col("gini"), F.col("length"), F.col("disp")), F.lit(1.0), F.col("hmf"), F.lit(1.0))
    parts = {"breadth": sc.breadth_score(F.col("b1"), F.col("hmf")), "minhash": kept_share, "gini": even}
    top = F.col("reads_before") / F.max("reads_before").over(Window.partitionBy("level", "parent"))
    a = a.withColumn("top", top)
    tass = sc.additive_score(parts, {"breadth": 0.27, "minhash": 0.31, "gini": 0.42}, F.lit(0.0), scale=F.col("top"))
    return a.select("level", "grp", "reads_before", "reads_after", F.round("b0", 6).alias("breadth_before"), F.round("b1", 6).alias("breadth_after"), F.round(tass, 6).alias("tass"))
