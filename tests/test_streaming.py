"""The stream path gives the batch result."""

from playlab.operators import features as FE
from playlab.operators import models as M
from playlab.operators.clean import blank_to
from playlab.plans.prepare import cleaned, prepare
from playlab.session import shared_dir
from playlab.sources.plays import plays, write_partitioned
from playlab.streaming import clean_stream, read_plays_stream, score_stream, start_scoring

from conftest import SF001

CATS = ["season_type", "posteam", "roof", "surface"]
NUMS = ["quarter_seconds_remaining", "ydstogo", "ep", "wind", "temp"]


def test_stream_scoring_matches_batch(spark):
    df = plays(spark, SF001)
    src = shared_dir(spark, "stream-src")
    write_partitioned(df, src)
    train = blank_to(prepare(df).train, "surface")
    model = M.fit(train, FE.feature_pipeline(CATS, NUMS, kind="maxabs", handle_invalid="keep"),
                  M.classifier("lr", maxIter=10))
    scored = score_stream(model, clean_stream(read_plays_stream(spark, src)))
    sink = shared_dir(spark, "stream-sink")
    progress = shared_dir(spark, "stream-progress")
    start_scoring(scored, sink, progress).awaitTermination(300)
    start_scoring(scored, sink, progress).awaitTermination(300)  # a restart appends nothing again
    got = spark.read.parquet(sink)
    batch = score_stream(model, blank_to(cleaned(df), "surface"))
    assert got.count() == batch.count()
    assert got.exceptAll(batch.select(*got.columns)).count() == 0
