import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tablens.operators import outliers as O
from tablens.streaming import scoring as ST


def test_stream_flags_equal_batch_flags(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    bounds = O.fit_bounds(ev, ["value"], "iqr", "event_type")
    batch = {r["event_id"] for r in O.flag_rows(ev, bounds, "event_id", "event_type").collect()}

    stream = spark.readStream.schema(ev.schema).option("pathGlobFilter", "events.parquet").parquet(SF_SMALL)
    flags = ST.flag_stream(stream, bounds, "event_id", "event_type", keep=["ts"])
    out = tempfile.mkdtemp(prefix="tablens-stream-")
    q = ST.start_to_parquet(flags, "flags_test_" + out.rsplit("-", 1)[-1], f"{out}/flags")
    q.awaitTermination(120)
    got = {r["event_id"] for r in spark.read.parquet(f"{out}/flags").collect()}
    assert got == batch and len(got) > 0

    counts = ST.windowed_flag_counts(flags, "ts", "1 day", "1 hour", "event_type")
    q2 = ST.start_to_parquet(counts, "counts_test_" + out.rsplit("-", 1)[-1], f"{out}/counts")
    q2.awaitTermination(120)
    # appended windows are final ones (closed by the watermark); all counted rows are flags
    total = spark.read.parquet(f"{out}/counts").agg(F.sum("flags")).first()[0] or 0
    assert total <= len(batch)
