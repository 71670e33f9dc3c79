"""The check report goes over feeds as they are derived; none is landed as files for it."""

from tieout.plans.checks import spark_models
from tieout.plans.ledger import Ledger, seed_frames
from tieout.sources.schemas import DATA_FEEDS


def test_report_lands_no_feed(spark):
    def landed(table):
        raise AssertionError(f"{table} was landed")

    frame = spark.range(1)
    models = spark_models(Ledger(spark, landed, seed_frames(spark), derived=lambda t: frame))
    assert all(models[t]() is frame for t in [*DATA_FEEDS, "dim_entity", "dim_account", "fx_rate"])
