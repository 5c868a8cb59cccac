import os

from kilowatch.session import drop_scratch, scratch_made, stored


def test_scratch_is_dropped(spark):
    before = scratch_made()
    kept = stored(spark.range(5).toDF("id"), "kept")
    gone = stored(spark.range(5).toDF("id"), "gone")
    made = [p for p in scratch_made() if p not in before]
    assert len(made) == 2 and gone.count() == 5
    drop_scratch(spark, made[1:])
    assert os.path.exists(made[0].removeprefix("file:")) and not os.path.exists(made[1].removeprefix("file:"))
    assert kept.count() == 5 and made[1] not in scratch_made()
    drop_scratch(spark, made)  # what is gone already does no harm
