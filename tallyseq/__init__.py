"""tallyseq: evidence analytics over alignment-style tables, as Spark DataFrame operators."""
