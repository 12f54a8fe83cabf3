"""Plan-shape checks for the scale design."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from core_help import SF_SMALL
from personalens.operators import mapping, ranking
from personalens.plans.warehouse import Warehouse


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_fast_mapping_has_no_window(spark):
    wh = Warehouse.from_driver_tables(spark, SF_SMALL)
    fast = mapping.cross_account_persona_mapping(wh.ad_persona_attributes,
                                                 wh.review_persona_attributes, wh.seed)
    assert "Window" not in _plan(fast)
    plain = mapping.cross_account_persona_mapping_windows(wh.ad_persona_attributes,
                                                          wh.review_persona_attributes, wh.seed)
    assert "Window" in _plan(plain)


def test_global_rank_has_no_single_partition_window_over_data(spark):
    df = spark.range(200).withColumn("v", F.col("id") % 7)
    out = ranking.global_row_number(df, [F.col("v").desc(), F.col("id").asc()], "rn", 4)
    tree = _plan(out).split("\n\n")[0]
    # the data is a scan of the written rows joined to broadcast offsets;
    # the only window runs over the per-partition counts, under the broadcast
    assert "Scan parquet" in tree
    assert tree.count("Window") == 1
    assert tree.index("BroadcastExchange") < tree.index("Window")
    assert sorted(r.rn for r in out.collect()) == list(range(1, 201))


def test_checkpoint_dir_comes_from_session(spark):
    from personalens.session import checkpoint_dir
    d = checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()
