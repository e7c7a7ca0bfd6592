"""Streams give what their batch twins give."""

import tempfile

from attestra.fixtures import view
from attestra.streaming import rounds as ST


def test_status_stream(spark, sf):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    src = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    log = view(spark, sf, "run_log").selectExpr("run_id", "cast(ts as timestamp) AS ts", "event_id", "line")
    log.coalesce(1).write.mode("overwrite").parquet(src)
    stream = ST.status_stream(spark.readStream.schema(log.schema).parquet(src))
    q = stream.writeStream.format("memory").queryName("status_out").outputMode("append").option("checkpointLocation", tempfile.mkdtemp(prefix="spark-", dir="/tmp")).trigger(availableNow=True).start()
    q.awaitTermination(100)
    got = {(r.run_id, r.event_id, r.status) for r in spark.table("status_out").collect()}
    assert got == {(r.run_id, r.event_id, r.status) for r in ST.status_changes(log).collect()}
