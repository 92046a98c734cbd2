"""Tasks that render pages grow in number with the tables."""


def test_more_steps_are_rendered_by_more_tasks(spark, sf_small, monkeypatch):
    """A task holds the texts of its pages: it must not get more of them with
    a larger table. A table of unknown size takes the session's number."""
    from mailstream.plans import atom_fixture
    from mailstream.sources.tables import table
    steps = table(spark, sf_small, "lineitem")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert atom_fixture.page_partitions(steps) == n
    assert atom_fixture.page_partitions(spark.createDataFrame([(1,)], "l_orderkey long")) == n
    monkeypatch.setattr(atom_fixture, "TASK_BYTES", 2000)
    assert atom_fixture.page_partitions(steps) > 4 * n
