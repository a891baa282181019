"""Removal at four levels in one sweep, truth from read names and what both give at every level."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyseq.functions import formulas as fx
from tallyseq.operators import intervals as iv
from tallyseq.operators import truth as tr
from tallyseq.plans.base import STAND_INS, query
from tallyseq.session import materialize

# alignments of reads that are named after the reference they were taken from, in five ways; the truth is the
# reference of the read's first line, which other lines of the order are aligned past
STAND_INS["named"] = f"""
WITH a AS ({STAND_INS['aln']}), r AS ({STAND_INS['refs']}), o AS (SELECT read_id, min(ref_id) AS truth_id FROM a GROUP BY read_id),
n AS (SELECT read_id, concat('NC_', right(concat('000000', CAST(truth_id AS STRING)), 6), '.1') AS acc FROM o)
SELECT CASE a.read_id % 5 WHEN 0 THEN concat(acc, '_', CAST(a.read_id AS STRING), '_4') WHEN 1 THEN concat('@', acc, '_', CAST(a.read_id AS STRING), '_7') WHEN 2 THEN concat(acc, '|some virus ', CAST(a.read_id AS STRING))
  WHEN 3 THEN concat(replace(replace(acc, '_', '-'), '.1', ''), '_', CAST(a.read_id AS STRING), '_9') ELSE concat('plain', CAST(a.read_id AS STRING)) END AS read_id,
  concat('NC_', right(concat('000000', CAST(a.ref_id AS STRING)), 6), '.1') AS ref, a.ref_id, s, e, mapq, score, is_secondary, species, genus, length
FROM a JOIN r ON r.ref_id = a.ref_id JOIN n ON n.read_id = a.read_id"""

_KEPT = """
k AS (SELECT *, mapq + score AS sc FROM named), m AS (SELECT *, max(sc) OVER (PARTITION BY read_id) AS top, max(sc) OVER (PARTITION BY read_id, ref_id) AS t1, max(sc) OVER (PARTITION BY read_id, species) AS t2, max(sc) OVER (PARTITION BY read_id, genus) AS t3 FROM k),
v AS (SELECT 0 AS v, * FROM m UNION ALL SELECT 1, * FROM m WHERE t1 = top UNION ALL SELECT 2, * FROM m WHERE t2 = top UNION ALL SELECT 3, * FROM m WHERE t3 = top),
f AS (SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY v, ref_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 1 ELSE 0 END AS f FROM v WHERE s < e),
g AS (SELECT *, sum(f) OVER (PARTITION BY v, ref_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS i FROM f), i AS (SELECT v, ref_id, max(e) - min(s) AS bp FROM g GROUP BY v, ref_id, i),
b AS (SELECT ref_id, sum(bp) FILTER (v = 0) AS bp0, coalesce(sum(bp) FILTER (v = 1), 0) AS bp1, coalesce(sum(bp) FILTER (v = 2), 0) AS bp2, coalesce(sum(bp) FILTER (v = 3), 0) AS bp3 FROM i GROUP BY ref_id),
p AS (SELECT *, len(string_split(read_id, '_')) AS np, string_split(read_id, '_') AS parts FROM m), u AS (SELECT *, CASE WHEN np >= 3 THEN array_to_string(parts[1:np - 2], '_') END AS gt FROM p),
c AS (SELECT ref, ref_id, species, genus, length, count(*) AS n, sum((t1 = top)::INT) AS n1, sum((t2 = top)::INT) AS n2, sum((t3 = top)::INT) AS n3,
 sum((gt = ref)::INT) AS tp0, sum((gt <> ref)::INT) AS fp0, sum((gt = ref AND t1 = top)::INT) AS tp1, sum((gt <> ref AND t1 = top)::INT) AS fp1, sum((gt = ref AND t1 < top)::INT) AS fn1 FROM u GROUP BY ALL),
z AS (SELECT c.* REPLACE (coalesce(tp0, 0) AS tp0, coalesce(fp0, 0) AS fp0, coalesce(tp1, 0) AS tp1, coalesce(fp1, 0) AS fp1, coalesce(fn1, 0) AS fn1), bp0, bp1, bp2, bp3 FROM c JOIN b USING (ref_id))"""


def _levels(t, how="inner"):
    """Per reference: alignments, what stays at three levels, bases covered by each, and truth before and after.
    References without a covered base go, unless `how` is left."""
    masked = materialize(tr.keep_masks(t.named, "read_id", "ref_id", ["ref_id", "species", "genus"], F.col("mapq") + F.col("score")), "masked")
    kept = lambda i: F.col("mask").bitwiseAND(F.lit(1 << i)) != 0
    right = F.col("_gt") == F.col("ref")
    n = masked.withColumn("_gt", tr.truth_of(F.col("read_id"), "parts")).groupBy("ref", "ref_id", "species", "genus", "length").agg(
        F.count("*").alias("n"), F.sum("mapq").alias("mapq"), *[F.count_if(kept(i)).alias(f"n{i}") for i in (1, 2, 3)], F.count_if(right).alias("tp0"), F.count_if(~right).alias("fp0"),
        F.count_if(right & kept(1)).alias("tp1"), F.count_if(~right & kept(1)).alias("fp1"), F.count_if(right & ~kept(1)).alias("fn1"))
    return n.join(iv.masked_coverage(masked, "ref_id", "mask", 4), "ref_id", how)


_SHARES = "round(tp0 * 1.0 / n, 6) AS proportion, round(CASE WHEN tp0 + fp0 > 0 THEN tp0 * 1.0 / (tp0 + fp0) ELSE 0 END, 6) AS precision, round(CASE WHEN tp0 > 0 THEN 2 * (tp0 * 1.0 / (tp0 + fp0)) * (tp0 * 1.0 / n) / (tp0 * 1.0 / (tp0 + fp0) + tp0 * 1.0 / n) ELSE 0 END, 6) AS f1"


def _shares() -> list:
    """Right alignments among all and among those with a truth; recall here is the share of all."""
    share, known = F.col("tp0") / F.col("n"), F.col("tp0") + F.col("fp0")
    precision = F.when(known > 0, F.col("tp0") / known).otherwise(0.0)
    f1 = F.when(F.col("tp0") > 0, 2 * precision * share / (precision + share)).otherwise(0.0)
    return [fx.round_scaled(share, 6).alias("proportion"), fx.round_scaled(precision, 6).alias("precision"), fx.round_scaled(f1, 6).alias("f1")]


@query("removal_levels", "A4 A5 A16", uses="named", sql=f"""WITH {_KEPT}
SELECT ref, n, n1::BIGINT AS n1, n2::BIGINT AS n2, n3::BIGINT AS n3, bp0::BIGINT AS bp0, bp1::BIGINT AS bp1, bp2::BIGINT AS bp2, bp3::BIGINT AS bp3, round(100.0 * bp0 / length, 6) AS breadth0, round(100.0 * bp1 / length, 6) AS breadth1, round(100.0 * bp2 / length, 6) AS breadth2,
 round(100.0 * bp3 / length, 6) AS breadth3, tp0::BIGINT AS tp0, fp0::BIGINT AS fp0, tp1::BIGINT AS tp1, fp1::BIGINT AS fp1, fn1::BIGINT AS fn1, {_SHARES} FROM z""")
def removal_levels(t):
    counts = [f"{x}{i}" for x, at in (("n", (1, 2, 3)), ("bp", (0, 1, 2, 3)), ("tp", (0, 1)), ("fp", (0, 1)), ("fn", (1,))) for i in at]
    return _levels(t).select("ref", "n", *counts, *[fx.round_scaled(100.0 * F.col(f"bp{i}") / F.col("length"), 6).alias(f"breadth{i}") for i in range(4)], *_shares())


@query("taxon_rollup", "A6 A7 A8", uses="named", sql=f"""WITH {_KEPT},
x AS (SELECT species, string_agg(ref, '; ' ORDER BY ref) AS accessions, sum(length) AS length, sum(n) AS n, sum(n1) AS n1, sum(tp0) AS tp0, sum(fp0) AS fp0, sum(tp1) AS tp1, sum(fp1) AS fp1, sum(fn1) AS fn1,
 sum(100.0 * bp0 / length * length) / sum(length) AS b0, sum(100.0 * bp1 / length * length) / sum(length) AS b1, least(1, sum(bp2) * 1.0 / sum(length)) AS union_breadth, sum(n2) * 1.0 / sum(n) AS retention FROM z GROUP BY species),
w AS (SELECT species, sum(mapq) * 1.0 / count(*) AS mapq FROM named GROUP BY species)
SELECT species::VARCHAR AS taxon, accessions, length::BIGINT AS length, n::BIGINT AS n, n1::BIGINT AS n1, (n - n1)::BIGINT AS removed, tp0::BIGINT AS tp0, fp0::BIGINT AS fp0, tp1::BIGINT AS tp1, fp1::BIGINT AS fp1, fn1::BIGINT AS fn1, round(100.0 * (n - n1) / n, 6) AS removed_pct,
 round(b0, 6) AS breadth_before, round(b1, 6) AS breadth_after, round(b1 / b0, 6) AS breadth_ratio, round(union_breadth, 6) AS union_breadth, round(retention, 6) AS retention, round(mapq, 6) AS mapq, {_SHARES} FROM x JOIN w USING (species)
UNION ALL SELECT 'Total', '', sum(length)::BIGINT, sum(n)::BIGINT, sum(n1)::BIGINT, sum(n - n1)::BIGINT, sum(tp0)::BIGINT, sum(fp0)::BIGINT, sum(tp1)::BIGINT, sum(fp1)::BIGINT, sum(fn1)::BIGINT, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM z""")
def taxon_rollup(t):
    every = materialize(_levels(t, "left"), "levels")
    z = every.where("bp0 is not null")
    counts = ["length", "n", "n1", "tp0", "fp0", "tp1", "fp1", "fn1"]
    total = z.agg(*[F.sum(c).alias(c) for c in counts]).select(F.lit("Total").alias("taxon"), F.lit("").alias("accessions"), *counts)
    x = z.groupBy(F.col("species").cast("string").alias("taxon")).agg(
        F.array_join(F.sort_array(F.collect_list("ref")), "; ").alias("accessions"), *[F.sum(c).alias(c) for c in counts],
        *[(F.sum(100.0 * F.col(f"bp{i}") / F.col("length") * F.col("length")) / F.sum("length")).alias(f"b{i}") for i in (0, 1)],
        F.least(F.lit(1.0), F.sum("bp2") / F.sum("length")).alias("union"), (F.sum("n2") / F.sum("n")).alias("kept"))
    mapq = every.groupBy(F.col("species").cast("string").alias("taxon")).agg((F.sum("mapq") / F.sum("n")).alias("mapq"))  # weighted by reads
    six = lambda c, name: fx.round_scaled(c, 6).alias(name)
    removed = (F.col("n") - F.col("n1")).alias("removed")
    rows = x.join(mapq, "taxon").select(
        "taxon", "accessions", *counts, removed, six(100.0 * (F.col("n") - F.col("n1")) / F.col("n"), "removed_pct"), six(F.col("b0"), "breadth_before"), six(F.col("b1"), "breadth_after"),
        six(F.when(F.col("b0") > 0, F.col("b1") / F.col("b0")).otherwise(0.0), "breadth_ratio"), six(F.col("union"), "union_breadth"), six(F.col("kept"), "retention"), six(F.col("mapq"), "mapq"), *_shares())
    return rows.unionByName(total.withColumn("removed", F.col("n") - F.col("n1")), allowMissingColumns=True)


_CANONICAL = r"""CASE WHEN regexp_extract({0}, '([A-Z]{{1,4}}_[A-Z0-9]{{3,}}|[A-Z]{{1,4}}[0-9]{{5,}})\.\d+', 1) <> '' THEN regexp_extract({0}, '([A-Z]{{1,4}}_[A-Z0-9]{{3,}}|[A-Z]{{1,4}}[0-9]{{5,}})\.\d+', 1)
 WHEN regexp_extract({0}, '([A-Z]{{1,4}}-[A-Z0-9]{{3,}}|[A-Z]{{1,4}}[0-9]{{5,}})_\d+', 1) <> '' THEN replace(regexp_extract({0}, '([A-Z]{{1,4}}-[A-Z0-9]{{3,}}|[A-Z]{{1,4}}[0-9]{{5,}})_\d+', 1), '-', '_') ELSE split_part(ltrim({0}, '@'), '_', 1) END"""
_TAXA = "acc AS (SELECT 'NC_' || right('000000' || s_suppkey, 6) AS accession, s_nationkey AS species, n_regionkey AS genus, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 11 > 0)"


def _taxa(t):
    """Accessions with their species and genus; one in eleven isn't in the map."""
    acc = F.concat(F.lit("NC_"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0"))
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).where("s_suppkey % 11 > 0").select(acc.alias("accession"), F.col("s_nationkey").alias("species"), F.col("n_regionkey").alias("genus"), "s_suppkey")


@query("read_name_truth", "E1", uses="named", sql=rf"""
WITH d AS (SELECT DISTINCT read_id AS q FROM named), p AS (SELECT q, string_split(q, '_') AS x FROM d)
SELECT q, split_part(q, '_', 1) AS first, trim(regexp_replace(q, '^(.*)_\d+_\d+$', '\1')) AS appended, CASE WHEN len(x) >= 3 THEN array_to_string(x[1:len(x) - 2], '_') END AS parts, {_CANONICAL.format('q')} AS canonical FROM p""")
def read_name_truth(t):
    q = F.col("q")
    return t.named.select(F.col("read_id").alias("q")).distinct().select("q", *[tr.truth_of(q, rule).alias(rule) for rule in ("first", "appended", "parts", "canonical")])


@query("taxon_truth", "A18 E1", uses="named", sql=f"""
WITH {_TAXA}, c AS (SELECT {_CANONICAL.format('read_id')} AS t, {_CANONICAL.format('ref')} AS a FROM named WHERE NOT is_secondary)
SELECT x.species AS taxon, sum((coalesce(y.species = x.species, false))::INT)::BIGINT AS tp, sum((NOT coalesce(y.species = x.species, false))::INT)::BIGINT AS fp FROM c JOIN acc x ON x.accession = a LEFT JOIN acc y ON y.accession = t GROUP BY x.species""")
def taxon_truth(t):
    rows = t.named.where("not is_secondary")
    return tr.taxon_counts(rows, tr.canonical_accession(F.col("read_id")), tr.canonical_accession(F.col("ref")), _taxa(t).select("accession", F.col("species").alias("taxon")))


_CASES = r"""q AS (SELECT DISTINCT read_id FROM named), kept AS (SELECT DISTINCT read_id, ref FROM named WHERE NOT is_secondary AND mapq >= 10),
c AS (SELECT read_id, trim(regexp_replace(read_id, '^(.*)_\d+_\d+$', '\1')) AS truth, count(ref) AS n_refs, coalesce(bool_or(ref = trim(regexp_replace(read_id, '^(.*)_\d+_\d+$', '\1'))), false) AS ok FROM q LEFT JOIN kept USING (read_id) GROUP BY read_id)"""
_RATIOS = "round(CASE WHEN tp + fp > 0 THEN tp * 1.0 / (tp + fp) ELSE 0 END, 6) AS precision, round(CASE WHEN tp + fn > 0 THEN tp * 1.0 / (tp + fn) ELSE 0 END, 6) AS recall, round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1"


def _cases(t):
    kept = t.named.where("not is_secondary and mapq >= 10")
    return tr.read_cases(t.named, kept, "read_id", "ref", tr.truth_of(F.col("_r"), "appended")), kept


@query("global_confusion", "A20", uses="named", sql=f"WITH {_CASES}, s AS (SELECT sum(ok::INT) AS tp, sum((NOT ok AND n_refs > 0)::INT) AS fp, sum((n_refs = 0)::INT) AS fn FROM c) SELECT tp::BIGINT AS tp, fp::BIGINT AS fp, fn::BIGINT AS fn, {_RATIOS} FROM s")
def global_confusion(t):
    return tr.global_confusion(_cases(t)[0]).select("tp", "fp", "fn", *[F.round(x, 6).alias(x) for x in ("precision", "recall", "f1")])


@query("reference_confusion", "A19", uses="named", sql=f"""WITH {_CASES}, r AS (SELECT truth AS ref FROM c UNION SELECT ref FROM kept),
a AS (SELECT truth AS ref, count(*) AS ts, sum(ok::INT) AS tp FROM c GROUP BY truth), b AS (SELECT ref, count(*) AS ps FROM kept GROUP BY ref),
z AS (SELECT r.ref, coalesce(ts, 0)::BIGINT AS truth_support, coalesce(ps, 0)::BIGINT AS pred_support, coalesce(tp, 0)::BIGINT AS tp, coalesce(ps, 0)::BIGINT - coalesce(tp, 0)::BIGINT AS fp, coalesce(ts, 0)::BIGINT - coalesce(tp, 0)::BIGINT AS fn FROM r LEFT JOIN a USING (ref) LEFT JOIN b USING (ref))
SELECT *, (SELECT count(*) FROM c) - tp - fp - fn AS tn, {_RATIOS} FROM z""")
def reference_confusion(t):
    cases, kept = _cases(t)
    out = tr.reference_confusion(materialize(cases, "read-cases"), kept, "read_id", "ref")
    return out.withColumns({x: F.round(x, 6) for x in ("precision", "recall", "f1")})


@query("group_precision", "A50", uses="named", sql=f"""
WITH {_TAXA}, c AS (SELECT {_CANONICAL.format('read_id')} AS t, {_CANONICAL.format('ref')} AS a FROM named WHERE NOT is_secondary),
k AS (SELECT x.accession AS xa, x.species AS xs, x.genus AS xg, y.accession AS ya, y.species AS ys, y.genus AS yg FROM c JOIN acc x ON x.accession = a LEFT JOIN acc y ON y.accession = t),
n AS (SELECT 'key' AS level, xa AS grp, coalesce(xa = ya, false) AS ok FROM k UNION ALL SELECT 'subkey', xs::VARCHAR, coalesce(xs = ys, false) FROM k UNION ALL SELECT 'toplevelkey', xg::VARCHAR, coalesce(xg = yg, false) FROM k),
s AS (SELECT level, grp, sum(ok::INT) AS tp, sum((NOT ok)::INT) AS fp FROM n GROUP BY level, grp), m AS (SELECT * FROM acc WHERE s_suppkey % 3 <> 1 AND genus <> 2),
h AS (SELECT DISTINCT 'key' AS level, accession AS grp FROM m UNION SELECT 'subkey', species::VARCHAR FROM m UNION SELECT 'toplevelkey', genus::VARCHAR FROM m),
z AS (SELECT s.level, sum((h.grp IS NOT NULL AND tp > 0)::INT)::BIGINT AS t, sum((h.grp IS NOT NULL AND tp = 0)::INT)::BIGINT AS f, sum((h.grp IS NULL AND tp > 0)::INT)::BIGINT AS m, coalesce(sum(tp) FILTER (h.grp IS NOT NULL), 0)::BIGINT AS tp_reads, coalesce(sum(fp) FILTER (h.grp IS NOT NULL), 0)::BIGINT AS fp_reads
 FROM s LEFT JOIN h ON h.level = s.level AND h.grp = s.grp GROUP BY s.level), y AS (SELECT level, t AS tp, f AS fp, m AS fn, tp_reads, fp_reads FROM z)
SELECT *, {_RATIOS} FROM y""")
def group_precision(t):
    rows, taxa = t.named.where("not is_secondary"), _taxa(t)
    read, ref = tr.canonical_accession(F.col("read_id")), tr.canonical_accession(F.col("ref"))
    counts = members = None
    for level, column in (("key", "accession"), ("subkey", "species"), ("toplevelkey", "genus")):
        own = taxa.select("accession", F.col(column).cast("string").alias("taxon"))
        c = tr.taxon_counts(rows, read, ref, own).select(F.lit(level).alias("level"), F.col("taxon").alias("grp"), "tp", "fp")
        m = taxa.where("s_suppkey % 3 <> 1 and genus <> 2").select(F.lit(level).alias("level"), F.col(column).cast("string").alias("grp"))
        counts, members = (c, m) if counts is None else (counts.unionByName(c), members.unionByName(m))
    return tr.level_metrics(members, counts, "level", "grp").withColumns({x: F.round(x, 6) for x in ("precision", "recall", "f1")})
