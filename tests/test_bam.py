"""Binary alignment files: round trips, splits at blocks, and pruning by the index."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, LessThan, Not

from tallyseq.sources import bam

REFS = [("r1", 300_000), ("r2", 90_000), ("empty", 5), ("r3", 700_000)]
KIND = "read_id string, ref_id string, s long, mapq int, flag int, cigar string, sequence string, quality string, score int, mismatches int"


def alignments(n=6_000, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        ref, length = rng.choice([REFS[0], REFS[1], REFS[3], REFS[3]])
        cigar = rng.choice(["50M", "10S30M5D20M", "20M3I27M1000N10M", "5H40=2X", "100M"])
        bases = rng.choice([0, 7, 50])
        seq = "".join(rng.choices("ACGTN", k=bases))
        rows.append((f"q{i}", ref, rng.randrange(length - 2_000), rng.randrange(61), rng.choice([0, 16, 256, 2048]), cigar, seq, "".join(rng.choices("!5I~", k=bases)) if i % 3 else None, rng.choice([None, -3, 70_000]), rng.choice([None, 4])))
    return rows + [(f"u{i}", None, None, 0, 4, None, "ACG", "III", None, None) for i in range(1_500)] + [("long", "r2", 100, 60, 0, "90000M", "A" * 90_000, "I" * 90_000, 5, 0)]


def length(cigar):
    import re

    return sum(int(n) for n, c in re.findall(r"(\d+)([A-Z=])", cigar or "") if c in "MDN=X")


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bam") / "folder")
    rows = alignments()
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    bam.write_bam(spark.createDataFrame(rows, KIND).repartition(5), path, REFS)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    return path, rows


def expected(rows):
    return sorted((r[0], r[1], -1 if r[1] is None else r[2], -1 if r[1] is None else r[2] + length(r[5]), r[3], r[4], r[8], r[9]) for r in rows)


def got(df):
    return sorted(tuple(r) for r in df.select("read_id", "ref_id", "s", "e", "mapq", "flag", "score", "mismatches").collect())


@pytest.mark.parametrize("split", [bam.SPLIT, 60_000, 9_000])
def test_round_trip_in_splits(spark, written, split):
    path, rows = written
    df = bam.read_bam(spark, path, split_bytes=split)
    assert got(df) == expected(rows)
    parts = bam.BamReader({"path": path, "splitBytes": str(split)}).partitions()
    assert len(parts) > (10 if split < 10_000 else 1)


@pytest.mark.parametrize("split", [bam.SPLIT, 9_000])
def test_without_index_records_are_found_at_blocks(spark, written, tmp_path, split):
    path, rows = written
    for f in bam.files_of(path):
        os.link(f.removeprefix("file://"), tmp_path / os.path.basename(f))
    df = bam.read_bam(spark, str(tmp_path), split_bytes=split)
    assert got(df) == expected(rows)
    assert any(not p.exact for p in bam.BamReader({"path": str(tmp_path), "splitBytes": "9000"}).partitions())


def test_sequences(spark, written):
    path, rows = written
    out = bam.read_bam(spark, path, sequences=True).select("read_id", "cigar", "sequence", "quality").collect()
    assert {tuple(r) for r in out} == {(r[0], r[5] or "*", r[6], r[7] if r[6] and r[7] else None) for r in rows}


def size(parts):
    return sum((p.end >> 16) - (p.begin >> 16) + 1 for p in parts)


def test_filters_skip_blocks(spark, written):
    path, rows = written
    whole = size(bam.BamReader({"path": path}).partitions())

    def pruned(*filters):
        reader = bam.BamReader({"path": path})
        assert list(reader.pushFilters(filters)) == list(filters)
        return size(reader.partitions())

    assert pruned(EqualTo(("ref_id",), "r2")) < 0.6 * whole
    assert pruned(EqualTo(("ref_id",), "r3"), LessThan(("s",), 60_000), GreaterThan(("e",), 40_000)) < 0.3 * whole
    assert pruned(Not(EqualTo(("is_unmapped",), True))) < whole
    assert pruned(EqualTo(("ref_id",), "empty")) <= 1 and pruned(EqualTo(("ref_id",), "nowhere")) <= 1
    df = bam.read_bam(spark, path)
    mine = expected(rows)
    near = df.where((F.col("ref_id") == "r3") & (F.col("s") < 60_000) & (F.col("e") > 40_000))
    assert got(near) == [r for r in mine if r[1] == "r3" and r[2] < 60_000 and r[3] > 40_000]
    assert got(df.where("ref_id in ('r1', 'r2') and s >= 80000")) == [r for r in mine if r[1] in ("r1", "r2") and r[2] >= 80_000]
    assert got(df.where("not is_unmapped")) == [r for r in mine if r[1]]
    assert got(df.where("is_unmapped")) == [r for r in mine if not r[1]]
    assert got(df.where("s > 250000")) == [r for r in mine if r[2] > 250_000]


def test_every_region_is_whole(spark, written):
    """The index against all records, for regions at the borders of bins and windows."""
    path, rows = written
    files = bam.files_of(path)
    rng = random.Random(4)
    for _ in range(40):
        a = rng.choice([0, 16_383, 16_384, 131_072, rng.randrange(700_000)])
        b = a + rng.choice([1, 2, 16_384, 50_000])
        found = set()
        for f in files:
            header, index = bam.Header.read(f), bam.Index.read(f)
            for begin, end in index.chunks(3, a, b):
                for data, starts in bam.records(f, bam.Part(f, begin, end, True), header.lengths):
                    found |= {r["read_id"] for r in bam.decode(data, starts, header.names, False).to_pylist() if r["ref_id"] == "r3" and r["s"] < b and r["e"] > a}
        assert found == {r[0] for r in rows if r[1] == "r3" and r[2] < b and r[2] + length(r[5]) > a}


def test_empty_files_and_folders(spark, tmp_path):
    path = str(tmp_path / "none")
    bam.write_bam(spark.createDataFrame([], KIND), path, REFS)
    assert bam.read_bam(spark, path).count() == 0
    bam.write_bam(spark.createDataFrame([("a", "elsewhere", 5, 1, 0, "3M", "ACG", None, None, None)], KIND), path, [])
    assert [tuple(r) for r in bam.read_bam(spark, path).select("read_id", "ref_id", "s").collect()] == [("a", None, -1)]


def test_unsorted_rows_are_refused(tmp_path):
    import pyarrow as pa

    writer = bam.BamWriter({"path": str(tmp_path), "references": "r1:10"})
    rows = [{"read_id": "a", "ref_id": "r1", "s": s, "mapq": 1, "flag": 0} for s in (5, 4)]
    with pytest.raises(ValueError, match="sorted"):
        writer.write(iter([pa.RecordBatch.from_pylist(rows)]))


def test_many_references(spark, tmp_path):
    """Numbering, header and index of a folder whose files hold few of very many references."""
    import time

    refs = [(f"r{i}", 1_000) for i in range(20_000)]
    rows = [(f"q{i}", f"r{i * 37 % 20_100}", i % 900, 9, 0, "10M" if i * 37 % 20_100 < 20_000 else None, None, None, None, i) for i in range(3_000)]
    began, path = time.time(), str(tmp_path / "many")
    bam.write_bam(spark.createDataFrame(rows, KIND), path, refs)
    known = [r if int(r[1][1:]) < 20_000 else (r[0], None, None, *r[3:]) for r in rows]
    assert got(bam.read_bam(spark, path)) == expected(known)
    first, *others = bam.files_of(path)
    header = bam.Header.read(first)
    assert header.names == [n for n, _ in refs] and all(bam.Header.read(f, header) is header for f in others)
    index = bam.Index(300_000)
    for ref in (5, 299_998):
        index.add(ref, 10, 20, 100 << 16, 100 << 16 | 50)
    assert len(index.pack()) == 8 + 8 * 300_000 + 2 * 32 + 8
    (tmp_path / "x.bai").write_bytes(index.pack())
    back = bam.Index.read(str(tmp_path / "x"))
    assert (back.n, back.bins, back.linear) == (index.n, index.bins, index.linear)
    assert time.time() - began < 60
