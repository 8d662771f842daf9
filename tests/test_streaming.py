import os
import tempfile

from lumen.plans import roles as R
from lumen.sources import tables as S
from lumen.streaming import stream_csv_to_table
from conftest import SMALL


def test_stream_ingest_matches_batch(spark):
    base = tempfile.mkdtemp(prefix="lumen-test-stream-")
    src, dst, ck = (os.path.join(base, x) for x in ("in", "out", "ck"))
    u = R.usarrests(spark, SMALL).withColumnRenamed("Murder", "Murder.Rate")
    S.write_csv(u, src)
    schema = "state string, `Murder.Rate` double, Assault int, UrbanPop long"
    q = stream_csv_to_table(spark, src, schema, dst, checkpoint=ck)
    q.awaitTermination(120)
    out = spark.read.parquet(dst)
    assert out.columns == ["state", "Murder_Rate", "Assault", "UrbanPop"]
    assert out.count() == u.count()
