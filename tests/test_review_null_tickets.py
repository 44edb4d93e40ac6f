"""Actions without a ticket leave the tickets of others as they are."""

from datetime import datetime, timedelta

from ticketgrain import schemas
from ticketgrain.streaming import review

START = datetime(2024, 5, 1)


def test_null_ticket_ids(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    acts = [(None if i % 3 == 0 else i, i, START + timedelta(minutes=i), "reject" if i % 3 == 0 else "approve", f"text {i}", None) for i in range(60)]
    spark.createDataFrame(acts, schemas.ACTIONS).repartition(3).write.parquet(source)
    stream = spark.readStream.schema(schemas.ACTIONS).parquet(source)
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        review.start_review(stream, f"{base}/t", f"{base}/c").awaitTermination()
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    found = {r.ticket_id: (r.status, r.final_text) for r in review.read_reviews(spark, f"{base}/t").collect()}
    assert found == {**{i: ("approved", f"text {i}") for i in range(60) if i % 3}, None: ("rejected", None)}
