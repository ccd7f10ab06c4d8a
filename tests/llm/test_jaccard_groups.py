from playstats.llm import jaccard_join as module
from playstats.llm.jaccard_join import jaccard_components


def test_prefix_groups_are_no_windows(table, monkeypatch):
    """A window holds all classes of a token in one task."""
    plans, store = {}, module.cut_lineage

    def stored(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return store(df, name)

    monkeypatch.setattr(module, "cut_lineage", stored)
    common = " ".join(f"w{i}" for i in range(40))
    pairs = [(i, f"{common} x{i}") for i in range(30)] + [(99, "one of its own kind and no copy at all")]
    found = {r["doc_id"]: r["component_id"] for r in jaccard_components(table(pairs)).collect()}
    assert found == {i: 0 for i in range(30)} | {99: 99}
    assert "Window" not in plans["jaccard-groups"]
