from lettermill.operators.annotate import annotation_counts
from lettermill.operators.kmers import kmer_rows
from lettermill.streaming.counts import start_counts


def test_stream_counts_like_the_batch(spark, tmp_path):
    kinds = "accession string, sequence string"
    rows = [("a", "MAKES"), ("b", "MAMA"), ("c", "KKKK"), ("a", "SSVV")]
    for i in range(2):
        spark.createDataFrame(rows[2 * i : 2 * i + 2], kinds).write.mode("append").parquet(str(tmp_path / "in"))
    known = spark.createDataFrame([("a", "A"), ("b", "B")], "id string, annotation string")
    stream = spark.readStream.schema(kinds).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    start_counts(stream, known, 2, "hydro", str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    last = sorted((tmp_path / "out").iterdir())[-1]
    batch = spark.createDataFrame(rows, kinds).selectExpr("accession AS seq_id", "accession", "sequence").join(known.withColumnRenamed("id", "accession"), "accession")
    want = annotation_counts(kmer_rows(batch, 2, "hydro", ("annotation",)))
    assert sorted(map(tuple, spark.read.parquet(str(last)).select("annotation", "kmer", "cnt").collect())) == sorted(map(tuple, want.collect()))
