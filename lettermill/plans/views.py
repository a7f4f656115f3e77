"""The given tables as sequences, annotations and background, in Spark and in SQL; always whole tables and whole texts."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.functions.alphabets import get_alphabet, key_pattern

#: Settings of the queries: learning and scoring; pairs and clusters.
LEARN, PAIRS = ("solvacc", 8), ("standard", 12)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def letters(text: Column) -> Column:
    return F.upper(F.regexp_replace(F.coalesce(text, F.lit("")), "[^A-Za-z]", ""))


def dealt(df: DataFrame, key: str) -> DataFrame:
    """df by hash of key if it is so small that its files may be fewer than the cores; a large table stays as it is read."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(key) if size < 32_000_000 * df.sparkSession.sparkContext.defaultParallelism else df


def seqs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = dealt(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"), "doc_id")
    return d.select(
        F.concat(F.lit("tr|D"), "doc_id", F.lit("|"), "source").alias("seq_id"), F.concat(F.lit("D"), "doc_id").alias("accession"),
        F.concat("source", F.lit(".fasta")).alias("filename"), F.col("lang").alias("label"), letters(F.col("text")).alias("sequence"),
    )


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    return rows.select(F.concat(F.lit("D"), "doc_id").alias("id"), F.concat("lang", F.lit("_q"), "quality", F.lit("t"), "toxic").alias("annotation"))


def background(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.concat(F.lit("bg|B"), "item_id", F.lit("|benchmark")).alias("seq_id"), F.concat(F.lit("B"), "item_id").alias("accession"), F.lit("benchmark.fasta").alias("filename"), F.lit("background").alias("label"), letters(F.col("text")).alias("sequence"))


SEQS = "seqs AS (SELECT 'tr|D' || doc_id || '|' || source AS seq_id, 'D' || doc_id AS accession, source || '.fasta' AS filename, lang AS label, upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')) AS sequence FROM documents)"
BACKGROUND = "background AS (SELECT 'bg|B' || item_id || '|benchmark' AS seq_id, 'B' || item_id AS accession, 'benchmark.fasta' AS filename, 'background' AS label, upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')) AS sequence FROM benchmark)"
ANN = "ann AS (SELECT 'D' || doc_id AS id, lang || '_q' || quality || 't' || toxic AS annotation FROM labels JOIN documents USING (doc_id))"


def reduced_sql(alphabet: str, column: str = "sequence") -> str:
    m = get_alphabet(alphabet)
    return f"translate({column}, '{''.join(m)}', '{''.join(m.values())}')"


def windows_sql(alphabet: str, k: int, source: str = "seqs", name: str = "w") -> str:
    """A CTE of all valid windows: seq_id, accession, filename, label, kmer."""
    cut = f"unnest(list_transform(range(1, length(r) - {k - 2}), lambda i: substr(r, i, {k})))"
    return f"{name} AS (SELECT * FROM (SELECT seq_id, accession, filename, label, {cut} AS kmer FROM (SELECT *, {reduced_sql(alphabet)} AS r FROM {source})) WHERE regexp_full_match(kmer, '{key_pattern(alphabet)}{{{k}}}'))"


KC = "kc AS (SELECT seq_id, kmer, count(*) AS cnt FROM w GROUP BY seq_id, kmer)"
KP = "kp AS (SELECT DISTINCT seq_id, kmer FROM w)"
W = windows_sql(*LEARN)
AK = "ak AS (SELECT annotation, kmer, count(*) AS cnt FROM w JOIN ann ON accession = id GROUP BY annotation, kmer)"
COS = """cos AS (SELECT kc.seq_id, ak.annotation, sum(kc.cnt * ak.cnt) / (sqrt(max(s.q)) * sqrt(max(a.q))) AS score
  FROM kc JOIN ak ON kc.kmer = ak.kmer JOIN (SELECT seq_id, sum(cnt * cnt) AS q FROM kc GROUP BY seq_id) s ON s.seq_id = kc.seq_id
  JOIN (SELECT annotation, sum(cnt * cnt) AS q FROM ak GROUP BY annotation) a ON a.annotation = ak.annotation GROUP BY kc.seq_id, ak.annotation)"""
RANKED = "ranked AS (SELECT *, row_number() OVER (PARTITION BY seq_id ORDER BY score DESC, annotation) AS rank FROM cos)"
PRED = """pred AS (SELECT s.seq_id, b.prediction, b.top, b.second, CAST(round_even((b.top - b.second) * 100, 0) AS INTEGER) AS bin, a.annotation AS actual, a.annotation IS NOT NULL AS known,
  CASE WHEN a.annotation IS NOT NULL THEN a.annotation = b.prediction END AS correct
  FROM seqs s LEFT JOIN ann a ON a.id = s.accession LEFT JOIN (SELECT seq_id, max(CASE WHEN rank = 1 THEN annotation END) AS prediction, max(CASE WHEN rank = 1 THEN score END) AS top, max(CASE WHEN rank = 2 THEN score END) AS second
  FROM ranked WHERE rank <= 2 GROUP BY seq_id) b ON b.seq_id = s.seq_id)"""
TF = """tf AS (SELECT g.prediction, g.bin, count(CASE WHEN p.correct THEN 1 END) AS n_true, count(CASE WHEN NOT p.correct THEN 1 END) AS n_false
  FROM (SELECT prediction, CAST(unnest(range(0, 101)) AS INTEGER) AS bin FROM (SELECT DISTINCT prediction FROM pred WHERE known AND prediction IS NOT NULL)) g
  LEFT JOIN (SELECT * FROM pred WHERE known) p ON p.prediction = g.prediction AND p.bin = g.bin GROUP BY g.prediction, g.bin)"""
GLOBAL_RAW = """graw AS (SELECT bin, n AS sum, CAST(sum(n) OVER () AS BIGINT) AS weight, CASE WHEN n > 0 THEN t / n END AS ratio
  FROM (SELECT bin, CAST(sum(n_true) AS BIGINT) AS t, CAST(sum(n_true + n_false) AS BIGINT) AS n FROM tf GROUP BY bin))"""


def fill_sql(source: str, value: str, keys: str, ends: bool) -> str:
    """Interpolated `value` along bin as an expression over `source`."""
    own = f"{'PARTITION BY ' + keys if keys else ''} ORDER BY bin"
    back, ahead = f"OVER ({own} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)", f"OVER ({own} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    y0, x0 = f"last_value({value} IGNORE NULLS) {back}", f"last_value(CASE WHEN {value} IS NOT NULL THEN bin END IGNORE NULLS) {back}"
    y1, x1 = f"first_value({value} IGNORE NULLS) {ahead}", f"first_value(CASE WHEN {value} IS NOT NULL THEN bin END IGNORE NULLS) {ahead}"
    return f"coalesce({value}, {y0} + ({y1} - {y0}) * (bin - {x0}) / ({x1} - {x0}), {y0}{', ' + y1 if ends else ''})"


def learn_sql(*more: str) -> str:
    return "WITH " + ", ".join([SEQS, ANN, W, KC, AK, COS, RANKED, PRED, TF, GLOBAL_RAW, *more])
