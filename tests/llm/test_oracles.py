"""Every query with SQL is compared by tests/test_oracle.py; here: the registry, and queries without SQL run whole."""

import __spark_entry__ as contract
import corpus_pipeline


def test_thirteen_operators_and_the_pipeline_are_registered():
    names = set(contract.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_copies", "repeated_passages", "decontamination", "packing",
    ]
