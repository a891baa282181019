"""Sinks: delimited tables, nested JSON, tables per sheet, FASTA windows and files per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.csv(path, sep="\t", header=True)


def write_removals(df: DataFrame, path: str, ref: str, read: str) -> None:
    df.select(ref, read).write.csv(path, sep="\t", header=False)


def nest(strains: DataFrame, sample: str, genus: str, species: str, columns: list[str]) -> DataFrame:
    """One row per sample with organisms nested genus, species, strain; lists sorted by name."""
    s = strains.groupBy(sample, genus, species).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("members"))
    g = s.groupBy(sample, genus).agg(F.sort_array(F.collect_list(F.struct(F.col(species).alias("subkey"), "members"))).alias("members"))
    return g.groupBy(sample).agg(F.sort_array(F.collect_list(F.struct(F.col(genus).alias("toplevelkey"), "members"))).alias("organisms"))


def write_nested_json(strains: DataFrame, path: str, sample: str, genus: str, species: str, columns: list[str]) -> None:
    nest(strains, sample, genus, species, columns).write.json(path)


def write_sheets(sheets: dict[str, DataFrame], path: str) -> None:
    """A workbook's sheets as one Parquet table each."""
    for name, df in sheets.items():
        df.write.parquet(f"{path}/{name}")


def write_fasta(df: DataFrame, path: str, name: str, sequence: str, width: int = 80) -> None:
    lines = F.array_join(F.regexp_extract_all(F.col(sequence), F.lit(f".{{1,{width}}}"), F.lit(0)), "\n")
    df.select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), lines).alias("value")).write.text(path)


def write_by_key(df: DataFrame, path: str, key: str, kind: str = "parquet") -> None:
    """A folder of files per key, in ranges of (key, hash of the row): a task writes to the folders of few
    neighbouring keys, and a key of many rows takes as many tasks as it needs."""
    row = F.xxhash64(*[c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind])
    df.repartitionByRange(F.col(key), row).write.partitionBy(key).format(kind).save(path)


def write_sorted(df: DataFrame, path: str, ref: str = "ref_id", start: str = "s") -> None:
    """Parquet in ranges of (reference, start), sorted inside, so that a region's row groups are few. A long
    reference takes as many ranges as it needs."""
    df.repartitionByRange(ref, start).sortWithinPartitions(ref, start).write.parquet(path)
