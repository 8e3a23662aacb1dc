"""What __spark_entry__ registers for this subpackage."""

import corpus_pipeline
from tidemark.llm import queries

QUERIES = queries.QUERIES | {"pipeline": corpus_pipeline.run}
ORACLES = queries.ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
