"""Faceted search against one query a facet; dialects of maps."""

import random

import pytest
from pyspark.sql import functions as F

from tallyseq.functions import formulas as fx
from tallyseq.operators import facets
from tallyseq.sources import readers


def plain(rows, names, selected, terms, searched):
    """Counts of each facet by a filter of its own."""
    def values(r, name):
        v = r[name]
        return [x or "" for x in v] if isinstance(v, list) else ["" if v is None else str(v).lower() if isinstance(v, bool) else str(v)]

    out = {}
    for name in names:
        for r in rows:
            text = " ".join(", ".join(values(r, c)) for c in searched).lower()
            if all(t in text for t in terms.lower().split()) and all(set(values(r, k)) & set(v) for k, v in selected.items() if k != name and v):
                for v in values(r, name):
                    if v:
                        out[name, v] = out.get((name, v), 0) + 1
    return out


@pytest.mark.parametrize("selected", [{}, {"a": ["x"]}, {"a": ["x", "y"], "tags": ["t1"]}, {"a": ["x"], "b": ["true"], "tags": ["t2", "t3"]}, {"a": ["nothing"], "b": []}])
@pytest.mark.parametrize("terms", ["", "WORD t1"])
def test_counts(spark, selected, terms):
    rng = random.Random(7)
    rows = [{"a": rng.choice(["x", "y", "z", "", None]), "b": rng.choice([True, False, None]), "tags": rng.choice([None, [], ["t1"], ["t1", "t2"], ["t3", "t3", None]]), "text": rng.choice(["a Word", "other", None])} for _ in range(300)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "a string, b boolean, tags array<string>, text string")
    names, searched = ["a", "b", "tags"], ["text", "tags"]
    got = facets.facet_counts(df, names, selected, terms, searched).collect()
    assert {(r.facet, r.value): r.n for r in got} == plain(rows, names, selected, terms, searched)
    assert all(r.selected == (r.value in selected.get(r.facet, [])) for r in got)
    for name in names:
        own = sorted((r.place, -r.n, r.value) for r in got if r.facet == name)
        assert [x[0] for x in own] == list(range(1, len(own) + 1)) and [x[1:] for x in own] == sorted(x[1:] for x in own)
    left = facets.matches(df, names, selected, terms, searched)
    assert left.columns == df.columns
    assert facets.facet_counts(df.limit(0), names, selected).count() == 0


def test_dialects(spark, tmp_path):
    files = {
        "a.csv": 'RefSeq,x,"Organism",species_taxid\nA.1,1,"Aus, bus",7\nA.2,2,,8\n,1,no accession,9\nA.3,1\n\nA.1,1,again,70\n',
        "b.tsv": "B.1\tx,y\tname b\tq\t5\r\nB.2\tx\tshort\n",
        "c.csv": "id,b,c,d,e\nC.1,b,name c,d,6\n",
        "d.csv": "d 1,staxids, Accession.Version \nz,11,D.1\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    rows = lambda **k: sorted((r.file.rsplit("/", 1)[1], r.accession, r.taxid, r.name) for r in readers.read_accession_maps(spark, str(tmp_path), **k).collect())
    base = [("a.csv", "A.1", "7", "Aus, bus"), ("a.csv", "A.1", "70", "again"), ("a.csv", "A.2", "8", None), ("c.csv", "C.1", "6", "name c"), ("d.csv", "D.1", "11", "D.1")]
    assert rows() == base  # a first line that names nothing is skipped, as the caller says that there is one
    assert rows(has_header=False) == sorted([*base, ("b.tsv", "B.1", "5", "name b"), ("c.csv", "id", "e", "c")])
    assert [r[1:] for r in rows(has_header=False, columns=(0, 1, 2)) if r[0] == "b.tsv"] == [("B.1", "x,y", "name b"), ("B.2", "x", "short")]
    every = readers.read_accession_maps(spark, str(tmp_path))
    assert [(r.accession, r.taxids) for r in readers.map_conflicts(every).collect()] == [("A.1", ["7", "70"])]
    accessions, names = readers.resolved_map(every)
    assert {r.accession: r.taxid for r in accessions.collect()}["A.1"] == "70"
    assert {r.taxid: r.name for r in names.collect()}["8"] == ""


def test_resistance(spark):
    rows = [(None, None, None, None, False), ("Drug Target", "", " ", "VFDB", False), ("multidrug RESISTant", None, None, None, True), (None, "lactam", None, None, True), (None, None, "x", None, True), (None, None, None, "ncbiAMR-2", True)]
    df = spark.createDataFrame(rows, "p string, c string, d string, s string, want boolean")
    assert df.where(fx.is_resistance(F.col("p"), F.col("c"), F.col("d"), F.col("s")) != F.col("want")).count() == 0
