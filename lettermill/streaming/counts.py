"""Annotation counts that grow with arriving sequences: the batch merge of counts with a base, kept up by a stream."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lettermill.operators.kmers import kmer_rows


def running_counts(sequences: DataFrame, annotations: DataFrame, k: int, alphabet="hydro") -> DataFrame:
    """annotation, kmer, cnt over all sequences (accession, sequence) that a stream has brought; annotations (id, annotation) is a static table.

    State is one count per annotation and k-mer, as in the batch table.
    """
    known = sequences.join(annotations, F.col("accession") == F.col("id"))
    return kmer_rows(known, k, alphabet, ("annotation",)).groupBy("annotation", "kmer").agg(F.count("*").alias("cnt"))


def start_counts(sequences: DataFrame, annotations: DataFrame, k: int, alphabet, path: str, checkpoint: str) -> StreamingQuery:
    """Writes the counts after each batch of files below path, a folder per batch; the last one holds all. Restarts go on from the checkpoint."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number:08}")

    counts = running_counts(sequences, annotations, k, alphabet)
    return counts.writeStream.outputMode("complete").foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
