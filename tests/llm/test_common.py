"""What the text operators share."""

from salesmart.llm import common


def test_a_written_step_deletes_its_shuffles(spark, monkeypatch):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    seen, before = [], spark.conf.get(setting, None)
    monkeypatch.setattr(common, "materialize", lambda df: seen.append(spark.conf.get(setting)) or df)
    common.written(spark.range(1))
    assert seen == ["true"] and spark.conf.get(setting, None) == before


def test_rounds_of_few_edges_are_written_by_few_tasks(spark, monkeypatch):
    setting, steps, write = "spark.sql.adaptive.coalescePartitions.enabled", [], common.materialize
    before = spark.conf.get(setting)

    def kept(df):
        steps.append(write(df))
        return steps[-1]

    monkeypatch.setattr(common, "materialize", kept)
    monkeypatch.setattr(common, "EDGES_EACH", 40)
    edges = spark.createDataFrame([(i, i + 3) for i in range(90)] + [(500, 501), (7, 7)], "a long, b long")
    spark.conf.set(setting, "false")  # else so few rows are one task anyway
    try:
        found = {r.node: r.component for r in common.components(edges).collect()}
    finally:
        spark.conf.set(setting, before)
    assert found == {**{i: i % 3 for i in range(93)}, 500: 500, 501: 500}
    assert len(steps) > 4 and all(len(step.inputFiles()) <= 3 for step in steps[2:])
