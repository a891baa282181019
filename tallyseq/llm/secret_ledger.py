"""Secret scanning with an incremental ledger of content-addressed blobs.

Every historical version of every path is a blob named by its SHA-256. The ledger is two tables:
`versions` says which path held which blob at which version, `findings` what each scanned (blob, rule
version) pair gave. A run scans only pairs it doesn't know yet, each distinct blob once, appends to both
tables, and joins findings back to all paths that ever held the blob. Both are read without duplicates,
so a run that is repeated, or two at once, change nothing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyseq.session import delete, materialize, shared_path

#: Kind, pattern, group that is measured, least length of it.
RULES = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
#: Without one of these a text has no span; it spares most texts the exact search.
MARKER = r"AKIA[A-Z0-9]{14}|[0-9a-f]{16}|(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"
RULE_VERSION = "base-1"
#: A blob that more than this share of all paths held is hot: 1 / HOT_SHARE rows of findings at most.
HOT_SHARE, HOT_LEAST = 1 / 2_000, 100


def _spans(text: Column, no: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """Array of (start, no, kind, end) of one rule: leftmost non-overlapping matches, then failing ones dropped.

    The pieces between the matches and the matches alternate, so positions are running sums of their
    lengths in code points. Runs of one character class that are too short can't hide a longer one, so
    their least length stands in the pattern; the assign rule is measured after matching, as a failing
    match still uses up its text.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda v: F.char_length(v) >= least)
    pairs = F.arrays_zip(found.alias("m"), F.transform(F.slice(gaps, F.lit(1), F.size(found)), lambda g: F.char_length(g)).alias("gap"), sizes.alias("ok"))

    def add(s: Column, x: Column) -> Column:
        start = s["at"] + x["gap"]
        end = start + F.char_length(x["m"])
        span = F.struct(start.alias("start"), F.lit(no).alias("no"), F.lit(kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(x["ok"], F.concat(s["out"], F.array(span))).otherwise(s["out"]).alias("out"))

    none = F.array().cast("array<struct<start:int,no:int,kind:string,end:int>>")
    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), add, lambda s: s["out"])


def find_secrets(text: Column) -> Column:
    """Array of (start, no, kind, end) over all rules, sorted by start, then by rule."""
    return F.array_sort(F.concat(*[_spans(text, i, *r) for i, r in enumerate(RULES)]))


NO_SPANS = "array<struct<start:int,no:int,kind:string,end:int>>"


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def findings(spark: SparkSession, ledger: str, rule_version: str = RULE_VERSION) -> DataFrame:
    """(path, version, blob_id, spans) of every version that the ledger knows, by the rule version's scans.

    A blob that this rule version hasn't scanned has null spans. `versions` counts equal rows of a run, and
    the largest count of any run holds, so rows repeated within a run stay and repeated runs add none.
    """
    rows = spark.read.parquet(f"{ledger}/versions").groupBy("path", "version", "blob_id").agg(F.max("n").alias("n"))
    known = spark.read.parquet(f"{ledger}/findings").where(F.col("rule_version") == rule_version)
    known = known.groupBy("blob_id").agg(F.max("spans").alias("spans"))
    # a blob that very many paths held joins by broadcast, so its paths needn't meet in one task
    held = rows.groupBy("blob_id").agg(F.count("*").alias("held"))
    least = max(HOT_LEAST, int((held.agg(F.sum("held")).first()[0] or 0) * HOT_SHARE))
    hot = F.broadcast(held.where(F.col("held") > least).join(known, "blob_id").select("blob_id", F.struct("spans").alias("hot")))
    tagged = rows.join(hot, "blob_id", "left")
    rest = tagged.where("hot is null").drop("hot").join(known, "blob_id", "left")
    out = rest.unionByName(tagged.where("hot is not null").select("path", "version", "blob_id", "n", "hot.spans"))
    return out.select("path", "version", "blob_id", "spans", F.explode(F.array_repeat(F.lit(0), F.col("n").cast("int")))).drop("col")


def scan_versions(
    versions: DataFrame, path: str = "path", text: str = "text", version: str | None = None, ledger: str | None = None, rule_version: str = RULE_VERSION,
) -> DataFrame:
    """Scan what is new, and return (path, version, blob_id, spans) over the ledger's whole history.

    spans is array<(start, no, kind, end)>, in code points, end exclusive. A null text is the empty blob,
    null paths and versions stay null, repeated rows stay. Without a version column the version is null,
    so a path that changes its text has a row for each text it ever had. `ledger` names the folder to
    extend; None starts an empty one in the shared folder. Extra columns are not read. An empty table
    adds nothing. Long texts are scanned whole.

    Texts are read and hashed once. Those without any marker can't have findings and aren't carried on:
    only blobs with a marker are gathered by content, each once, with copies merged before the shuffle.
    """
    spark = versions.sparkSession
    ledger = ledger or shared_path(spark, "secret-ledger")
    rows = versions.select(
        F.col(path).alias("path"), (F.col(version) if version else F.lit(None).cast("string")).alias("version"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.select("path", "version", F.sha2("t", 256).alias("blob_id"), F.when(F.col("t").rlike(MARKER), F.col("t")).alias("t"))
    rows = materialize(rows, "secret-rows")
    seen = _table(spark, f"{ledger}/findings")
    blobs = rows.groupBy("blob_id").agg(F.first("t").alias("t"))
    if seen is not None:  # a row for each blob on either side, so copies of one text don't meet here
        blobs = blobs.join(seen.where(F.col("rule_version") == rule_version).select("blob_id").distinct(), "blob_id", "left_anti")
    none = F.array().cast(NO_SPANS)
    scanned = blobs.select("blob_id", F.lit(rule_version).alias("rule_version"), F.when(F.col("t").isNotNull(), find_secrets(F.col("t"))).otherwise(none).alias("spans"))
    # findings first: a run that is lost between the two writes leaves no path without its scan
    scanned.write.mode("append").parquet(f"{ledger}/findings")
    rows.groupBy("path", "version", "blob_id").agg(F.count("*").alias("n")).write.mode("append").parquet(f"{ledger}/versions")
    delete(spark, rows.shared_path)
    return findings(spark, ledger, rule_version).withColumnRenamed("path", path)
