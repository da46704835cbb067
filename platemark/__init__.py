"""platemark: record matching, curation and integrity checks as Spark plans."""
