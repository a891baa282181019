"""Query registry and the input tables that stand in for alignment, taxonomy and cohort data.

A stand-in is one SQL text that Spark and DuckDB both read, so that twins differ only in the operators. Records
for scoring are the exception: only the twins read their text, and Spark makes them by the library's own
coverage operators.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyseq.operators.records import reference_records

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_POS = "((l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 31) % 100000)"
STAND_INS = {
    # one row per alignment of a read to a reference; intervals are half open
    "aln": f"""SELECT l_orderkey AS read_id, l_suppkey AS ref_id, l_partkey AS part_id, {_POS} AS s, {_POS} + 3 * CAST(l_quantity AS BIGINT) AS e,
        CAST(round(l_discount * 600) AS INT) AS mapq, l_linenumber > 1 AS is_secondary, l_returnflag = 'R' AS is_reverse,
        CAST(round(l_tax * 500) AS INT) AS baseq, CAST(l_quantity AS BIGINT) AS score FROM lineitem""",
    # references with their species and genus
    "refs": """SELECT s_suppkey AS ref_id, CAST(100000 + s_suppkey * 1000 AS BIGINT) AS length, s_nationkey AS species, n_regionkey AS genus,
        s_suppkey % 3 = 0 AS is_plasmid FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    # taxonomy as parent links: strain 10000+, species 1000+, genus 100+, root 1
    "nodes": """SELECT 10000 + s_suppkey AS taxid, CAST(1000 + s_nationkey AS BIGINT) AS parent, 'strain' AS rank FROM supplier
        UNION ALL SELECT CAST(1000 + n_nationkey AS BIGINT), CAST(100 + n_regionkey AS BIGINT), 'species' FROM nation
        UNION ALL SELECT CAST(100 + r_regionkey AS BIGINT), CAST(1 AS BIGINT), 'genus' FROM region""",
    # detections: organism by sample; tass and coverage in percent
    "det": """SELECT concat(c_mktsegment, '-', CAST(c_nationkey AS STRING)) AS sample, c_mktsegment AS segment, c_nationkey AS site, p_brand AS organism,
        substr(p_brand, 1, 7) AS genus, SUM(CAST(l_quantity AS BIGINT)) AS reads, round(AVG(l_discount) * 1000, 4) AS tass, round(AVG(l_tax) * 1000, 4) AS coverage,
        round(AVG(l_discount) * 600, 4) AS mapq, COUNT(*) AS n_aln, MAX(l_quantity) >= 48 AS high_consequence
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
        GROUP BY c_mktsegment, c_nationkey, p_brand""",
    # samples with coordinates and metadata
    "samples": """SELECT DISTINCT concat(c_mktsegment, '-', CAST(c_nationkey AS STRING)) AS sample, c_mktsegment AS segment, c_nationkey AS site, n_name AS country, r_name AS continent,
        CAST(c_nationkey * 7 - 80 AS DOUBLE) AS lat, CAST(c_nationkey * 14 - 170 AS DOUBLE) AS lon FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    # organism records with three levels for controls: priority plays the sample's role
    "ctl": """SELECT o_orderpriority AS source, CASE WHEN o_orderpriority = '1-URGENT' THEN 'negative' WHEN o_orderpriority = '2-HIGH' THEN 'positive' ELSE 'sample' END AS polarity,
        p_brand AS organism, SUM(CASE WHEN o_orderpriority = '1-URGENT' AND p_brand LIKE '%3' AND l_quantity > 15 THEN 0 ELSE 1 END) AS reads, round(AVG(l_discount) * 1000, 4) AS tass FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        GROUP BY o_orderpriority, p_brand""",
    # documents as sequences, grouped by source
    "seqs": "SELECT doc_id AS seq_id, source AS grp, text FROM documents",
}
# per-reference records for scoring, all from the alignments: reads, mapping quality, breadth before and after
# ambiguous reads go, evenness and spread of depth, contigs (stretches of 5000 bases) with reads
STAND_INS["rec"] = f"""
WITH a AS ({STAND_INS['aln']}), f AS ({STAND_INS['refs']}),
k AS (SELECT ref_id, read_id, s, e, mapq, mapq + score = max(mapq + score) OVER (PARTITION BY read_id) AS best FROM a),
v AS (SELECT 0 AS after, ref_id, s, e FROM k UNION ALL SELECT 1 AS after, ref_id, s, e FROM k WHERE best),
m AS (SELECT after, ref_id, s, e, CASE WHEN s > max(e) OVER (PARTITION BY after, ref_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 1 ELSE 0 END AS gap FROM v),
g AS (SELECT after, ref_id, s, e, sum(gap) OVER (PARTITION BY after, ref_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS no FROM m),
i AS (SELECT after, ref_id, min(s) AS s, max(e) AS e FROM g GROUP BY after, ref_id, no),
b AS (SELECT ref_id, CAST(sum(CASE WHEN after = 0 THEN e - s ELSE 0 END) AS DOUBLE) AS bp, CAST(sum(CASE WHEN after = 1 THEN e - s ELSE 0 END) AS DOUBLE) AS bp_new FROM i GROUP BY ref_id),
n AS (SELECT ref_id, count(DISTINCT read_id) AS reads, count(DISTINCT CASE WHEN best THEN read_id END) AS reads_kept, CAST(avg(mapq) AS DOUBLE) AS mapq,
 CAST(sum(CASE WHEN mapq >= 20 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS hmf, CAST(avg(e - s) AS DOUBLE) AS read_length, count(DISTINCT floor(s / 5000)) AS contigs_covered FROM k GROUP BY ref_id),
ev AS (SELECT ref_id, s AS pos, 1 AS d FROM a UNION ALL SELECT ref_id, e, -1 FROM a), st AS (SELECT ref_id, pos, sum(d) AS d FROM ev GROUP BY ref_id, pos),
ru AS (SELECT ref_id, CAST(pos AS DOUBLE) AS pos, CAST(sum(d) OVER (PARTITION BY ref_id ORDER BY pos) AS DOUBLE) AS depth, CAST(lead(pos) OVER (PARTITION BY ref_id ORDER BY pos) - pos AS DOUBLE) AS w FROM st),
ds AS (SELECT ref_id, var_pop(pos + w / 2) AS spread FROM ru WHERE depth > 0 AND w > 0 GROUP BY ref_id),
h AS (SELECT ref_id, depth, sum(w) AS w FROM ru WHERE depth > 0 AND w > 0 GROUP BY ref_id, depth),
u AS (SELECT ref_id, depth, w FROM h UNION ALL SELECT h.ref_id, CAST(0 AS DOUBLE), CAST(length AS DOUBLE) - sum(w) FROM h JOIN f ON f.ref_id = h.ref_id GROUP BY h.ref_id, length),
c AS (SELECT ref_id, w, log10(1 + depth) * w AS x, sum(log10(1 + depth) * w) OVER (PARTITION BY ref_id ORDER BY depth) AS cx, sum(log10(1 + depth) * w) OVER (PARTITION BY ref_id) AS tx, sum(w) OVER (PARTITION BY ref_id) AS tw FROM u),
gi AS (SELECT ref_id, 1 - 2 * sum(w / tw * (2 * cx - x) / (2 * tx)) AS gini FROM c GROUP BY ref_id)
SELECT f.ref_id, species, genus, length, is_plasmid, reads, CAST(reads AS DOUBLE) / SUM(reads) OVER () AS share, mapq / 60 AS mapq01, bp / length AS breadth, bp_new / length AS breadth_new,
 gini, sqrt(spread / (CAST(length AS DOUBLE) * length / 12)) AS disp, hmf, CAST(reads_kept AS DOUBLE) / reads AS retention, 1 - CAST(reads_kept AS DOUBLE) / reads AS removal,
 CAST(least(1, CAST(3 AS DOUBLE) / 10 * (bp_new / bp) + CAST(7 AS DOUBLE) / 10 * (CAST(reads_kept AS DOUBLE) / reads)) AS DOUBLE) AS minhash, read_length, contigs_covered, 25 AS contigs
FROM f JOIN n ON n.ref_id = f.ref_id JOIN b ON b.ref_id = f.ref_id JOIN ds ON ds.ref_id = f.ref_id JOIN gi ON gi.ref_id = f.ref_id"""
# detections with what a view filters by
STAND_INS["view"] = f"""SELECT sample, segment, site, organism, genus, reads, tass, coverage, high_consequence,
 CASE site % 5 WHEN 0 THEN 'Primary' WHEN 1 THEN 'Opportunistic' WHEN 2 THEN 'Potential' WHEN 3 THEN 'Commensal' END AS category,
 CASE site % 4 WHEN 0 THEN 'Bacteria' WHEN 1 THEN 'Virus' WHEN 2 THEN 'Eukaryota' ELSE '' END AS domain,
 CASE site % 5 WHEN 0 THEN 'Fungi' WHEN 1 THEN 'Viridiplantae' WHEN 2 THEN 'Bacteriati' WHEN 3 THEN 'Metazoa' ELSE 'Unnamed' END AS kingdom,
 CASE site % 3 WHEN 0 THEN 'DNA' WHEN 1 THEN 'rna' END AS mol_type FROM ({STAND_INS['det']}) d"""
QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, str] = {}


class Inputs:
    """Tables and stand-ins of one data folder, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name == "rec":  # the twins' text says it in SQL
            self.rec = reference_records(self.aln, self.refs)
            return self.rec
        if name in TABLES:
            return self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        if name not in STAND_INS:
            raise AttributeError(name)
        text = STAND_INS[name]
        used = {t: getattr(self, t) for t in TABLES if re.search(rf"\b{t}\b", text)}
        # frames are passed as arguments, so no session-wide view is left behind
        for t in used:
            text = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", text)
        return self._spark.sql(text, **used)


def query(name: str, covers: str, sql: str | None = None, uses: str = ""):
    """Register f(inputs) as a query; sql is its twin, with the stand-ins in `uses` as named subqueries."""

    def add(f: Callable[[Inputs], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: f(Inputs(spark, sf_dir))
        COVERS[name] = covers
        if sql:
            ctes = [f"{u} AS ({STAND_INS[u]})" for u in uses.split()]
            body = sql.strip()
            if ctes:
                recursive = body.upper().startswith("WITH RECURSIVE")
                own = re.sub(r"(?i)^with(\s+recursive)?\s", "", body)
                body = f"WITH {'RECURSIVE ' if recursive else ''}" + ", ".join(ctes) + (", " + own if own != body else " " + body)
            ORACLES[name] = body
        return f

    return add
