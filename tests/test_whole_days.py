"""The daily dashboard keeps every day: closed, still open and late."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ticketgrain import schemas
from ticketgrain.operators import workflow as wf
from ticketgrain.streaming import intake as streams


def test_all_days_hold_every_ticket(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    start = datetime(2024, 5, 1)
    arriving = [start, start + timedelta(days=1), start + timedelta(days=5), start + timedelta(hours=3), None, start + timedelta(days=6)]
    for i, ts in enumerate(arriving):
        spark.createDataFrame([(i, "a", "bug", ts)], schemas.SUBMISSIONS).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schemas.SUBMISSIONS).option("maxFilesPerTrigger", 1).parquet(source)
    streams.start_daily_dashboard(wf.intake(stream), f"{base}/t", f"{base}/c", late="1 day").awaitTermination()
    days = streams.read_all_days(spark, f"{base}/t").filter("dimension = 'type'")
    found = {r.day and (r.day - start).days: r.n for r in days.select(F.col("day"), "n").collect()}
    assert found == {0: 2, 1: 1, 5: 1, 6: 1, None: 1}
