"""The registered tree ensembles run with the production settings and the final features."""

from breachline.plans.model_queries import FINAL, _forest

SF = "/root/testdata/sf0.001"


def test_forest_has_production_settings(spark):
    df, pipeline = _forest(spark, SF)
    forest = pipeline.stages[-1]
    assert (forest.getNumTrees, forest.getOrDefault("maxDepth")) == (200, 20)
    assert len(FINAL) == 28 and set(FINAL) <= set(df.columns)
    assert df.count() == df.select("request_key").distinct().count()
