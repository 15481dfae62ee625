from healthmart.operators.keys import scratch_path
from healthmart.streaming.arrival import enrich_on_arrival, run_arrivals

from .conftest import rows


def test_arrival_batch_equals_stream(spark):
    # arrival fixture: unknown indication, supplied medicine_id that must be replaced
    arriving = spark.createDataFrame([(1, 1, 10, 999), (2, 1, 11, None), (3, 2, 99, 5)],
                                     "outcome_id long, person_id long, indication_id long, medicine_id long")
    indication = spark.createDataFrame([(10, 100), (11, 110)], "indication_id long, medicine_id long")
    batch = enrich_on_arrival(arriving, indication, ("indication_id", "indication_id"), ["medicine_id"])
    assert rows(batch) == [(1, 1, 10, 100), (2, 1, 11, 110), (3, 2, 99, None)]
    assert batch.columns == arriving.columns
    src = scratch_path(spark, "arrivals-src")
    arriving.repartition(3).write.parquet(src)
    stream = run_arrivals(spark, src, arriving.schema, indication, ("indication_id", "indication_id"),
                          ["medicine_id"], max_files_per_trigger=1)
    assert rows(stream) == rows(batch)
