"""One query an operator, and the pipeline, in the driver's contract."""

import re

import __spark_entry__ as contract
import corpus_pipeline


def test_every_operator_has_its_query():
    numbers = sorted(int(m[1]) for name in contract.queries() if (m := re.match(r"op(\d+)_", name)))
    assert numbers == list(range(1, 14)) and "pipeline" in contract.queries()
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "sentencepiece"]
