"""Multi-source entity resolution on Spark: normalise, block, compare, score, assemble, validate, evaluate."""
