import os
import tempfile

from pyspark.sql import functions as F

from paths import SF
from riskframe.operators import encode as E
from riskframe.operators import models as J
from riskframe.plans import tables as T
from riskframe.streaming.scoring import score_stream


def test_stream_scoring_matches_batch(spark):
    app = T.application(spark, SF).select("c_custkey", "TARGET", "c_nationkey", "n_regionkey")
    feats = ["c_nationkey", "n_regionkey"]
    train = app.where("TARGET IS NOT NULL").withColumns({c: F.col(c).cast("double") for c in feats})
    imp = E.MedianImputer(feats).fit(train)
    model, _ = J.fit("logistic", J.assemble(train, feats).withColumnRenamed("TARGET", "y"), "y")
    scratch = tempfile.mkdtemp(prefix="rf-stream-", dir="/tmp")
    src, sink = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    app.where("TARGET IS NULL").drop("TARGET").write.parquet(src)
    schema = spark.read.parquet(src).schema
    q = score_stream(spark, model, imp, feats, schema, src, sink, "c_custkey", 0.3,
                     checkpoint=os.path.join(scratch, "ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(sink)
    assert got.count() == app.where("TARGET IS NULL").count()
    batch = J.scoring_table(model, J.assemble(imp.transform(spark.read.parquet(src))
                                              .withColumns({c: F.col(c).cast("double") for c in feats}), feats),
                            "c_custkey", 0.3)
    assert sorted(got.collect()) == sorted(batch.collect())
