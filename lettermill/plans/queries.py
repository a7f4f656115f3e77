"""The registered queries of the sequence operators and their SQL. Each name has the same columns on both sides."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.functions import names
from lettermill.functions.alphabets import ALPHABETS, NUMBERED, alphabet_keys, reduce_sequence
from lettermill.operators import annotate as A
from lettermill.operators import clustering as G
from lettermill.operators import kmers as K
from lettermill.operators import models as M
from lettermill.operators import motif as H
from lettermill.operators import scoring as E
from lettermill.operators import sequences as P
from lettermill.operators import similarity as D
from lettermill.operators import spectral as C
from lettermill.operators import svm as S
from lettermill.operators.packed import sequence_sets
from lettermill.operators.store import folder, written
from lettermill.plans import views as V
from lettermill.sources import fasta, tables

QUERIES: dict = {}
SQL: dict[str, str] = {}
ALPHABET, SIZE = V.LEARN


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def unsigned(c: str, digits: int):
    """Rounded, and 0 where rounding leaves a negative zero."""
    return (F.round(c, digits) + F.lit(0.0)).alias(c)


# names and sequences


@query(f"WITH {V.SEQS} " + " UNION ALL ".join(f"SELECT seq_id, '{a}' AS alphabet, md5({V.reduced_sql(a)}) AS reduced_md5, length(sequence) AS length FROM seqs" for a in list(ALPHABETS)[:NUMBERED]))
def reduce_all_alphabets(spark: SparkSession, d: str) -> DataFrame:
    kinds = F.array(*[F.struct(F.lit(a).alias("alphabet"), reduce_sequence(F.col("sequence"), a).alias("r")) for a in list(ALPHABETS)[:NUMBERED]])
    return V.seqs(spark, d).select("seq_id", F.explode(kinds).alias("x")).select("seq_id", "x.alphabet", F.md5("x.r").alias("reduced_md5"), F.char_length("x.r").cast("long").alias("length"))


NAME = "regexp_extract(url, '([^/]*)$', 1)"
STEM = f"regexp_replace(CASE WHEN contains({NAME}, '.') THEN regexp_replace({NAME}, '\\.[^.]*$', '') ELSE {NAME} END, '[. -]', '_', 'g')"


@query(f"SELECT page_id, CASE WHEN regexp_extract({STEM}, '[a-z]{{3}}[0-9]', 0) <> '' THEN regexp_extract({STEM}, '[a-z]{{3}}[0-9]', 0) ELSE regexp_extract({NAME}, '^[^.]*', 0) END AS family, len(regexp_extract_all({STEM}, '[a-z]+')) AS n_matches FROM pages")
def family_from_filename(spark, d):
    url = F.col("url")
    return V.table(spark, d, "pages").select("page_id", names.family_from_filename(url, "[a-z]{3}[0-9]").alias("family"), F.size(names.families_from_filename(url, "[a-z]+")).cast("long").alias("n_matches"))


@query(f"SELECT page_id, CASE WHEN contains(n, '.') THEN regexp_replace(n, '\\.[^.]*$', '') ELSE n END AS stem, CASE WHEN contains(n, '.') THEN regexp_extract(n, '\\.([^.]*)$', 1) ELSE '' END AS ext FROM (SELECT page_id, regexp_replace({NAME}, '\\.gz$', '') AS n FROM pages)")
def split_file_ext(spark, d):
    stem, ext = names.split_file_ext(F.col("url"))
    return V.table(spark, d, "pages").select("page_id", stem.alias("stem"), ext.alias("ext"))


@query(f"WITH {V.SEQS} SELECT seq_id, 'D' || split_part(substr(seq_id, 5), '|', 1) AS accession FROM seqs")
def accession(spark, d):
    return V.seqs(spark, d).select("seq_id", names.accession(F.col("seq_id")).alias("accession"))


@query(f"WITH {V.SEQS} SELECT filename, count(*) AS n_sequences, sum(length(sequence))::BIGINT AS n_residues FROM seqs WHERE filename IN (SELECT filename FROM seqs GROUP BY filename HAVING count(*) >= 5) GROUP BY filename")
def count_sequences(spark, d):
    kept = P.filter_min_sequences(V.seqs(spark, d), 5)
    sizes = kept.groupBy("filename").agg(F.sum(F.char_length("sequence")).alias("n_residues"))
    return P.count_sequences(kept).join(sizes, "filename")


@query(f"WITH {V.SEQS}, {V.BACKGROUND} SELECT seq_id, filename = 'benchmark.fasta' AS background FROM (SELECT * FROM seqs UNION ALL SELECT * FROM background)")
def background_flag(spark, d):
    return P.flag_background(V.seqs(spark, d).unionByName(V.background(spark, d)), V.background(spark, d).select("filename")).select("seq_id", "background")


@query(f"WITH {V.SEQS} SELECT seq_id, label, length FROM (SELECT seq_id, label, length(sequence) AS length, row_number() OVER (PARTITION BY label, sequence ORDER BY CAST(substr(accession, 2) AS BIGINT) DESC) AS r FROM seqs) WHERE r = 1")
def dedupe_last(spark, d):
    rows = V.seqs(spark, d).withColumn("key", F.sha2("sequence", 256))
    last = P.dedupe_last(rows.select("seq_id", "label", "key", F.char_length("sequence").cast("long").alias("length"), "accession"), ["label", "key"], F.substring("accession", 2, 20).cast("long"))
    return last.select("seq_id", "label", "length")


def fragments_sql(size: str, at: str, least: int) -> str:
    return f"WITH {V.SEQS} SELECT seq_id, md5(substr(sequence, CAST({at} AS BIGINT) + 1, CAST(size AS BIGINT))) AS fragment_md5, CAST(size AS BIGINT) AS length FROM (SELECT *, {size} AS size FROM seqs) WHERE length(sequence) - size + 1 > 0 AND size >= {least}"


def fragments(spark, d, *args):
    return P.fragment(V.seqs(spark, d), *args).select("seq_id", F.md5("sequence").alias("fragment_md5"), F.char_length("sequence").cast("long").alias("length"))


@query(fragments_sql("300", "length(sequence) - size", 50))
def fragment_absolute(spark, d):
    return fragments(spark, d, "absolute", 300, "end", 50)


@query(fragments_sql("floor(length(sequence) * 50 / 100)", "0", 50))
def fragment_percent(spark, d):
    return fragments(spark, d, "percent", 50, "start", 50)


@query(fragments_sql("floor(length(sequence) * 50 / 100)", "CAST('0x' || substr(md5('3:' || seq_id), 1, 8) AS BIGINT) % CAST(length(sequence) - size + 1 AS BIGINT)", 50))
def fragment_random(spark, d):
    return fragments(spark, d, "percent", 50, "random", 50, 3)


@query(f"WITH {V.SEQS} SELECT seq_id, CASE WHEN label = 'en' THEN 1 ELSE 0 END AS in_family FROM seqs")
def binary_label(spark, d):
    return P.binary_label(V.seqs(spark, d), "en").select("seq_id", "in_family")


# k-mers


@query(f"WITH {V.SEQS}, {V.W} SELECT seq_id, kmer, count(*) AS cnt FROM w GROUP BY seq_id, kmer")
def kmer_counts(spark, d):
    return K.kmer_counts(V.seqs(spark, d), SIZE, ALPHABET)


@query(f"WITH {V.SEQS}, {V.W} SELECT filename, kmer, count(*) AS cnt FROM w GROUP BY filename, kmer HAVING count(*) > 2")
def kmer_basis(spark, d):
    return K.kmer_basis(V.seqs(spark, d), SIZE, ALPHABET, 2)


@query(f"WITH {V.SEQS}, {V.W} SELECT DISTINCT seq_id, kmer FROM w")
def kmer_presence(spark, d):
    return K.presence(V.seqs(spark, d), SIZE, ALPHABET)


@query(f"WITH {V.SEQS}, {V.W} SELECT kmer, count(*) AS total FROM w GROUP BY kmer")
def kmer_totals(spark, d):
    return K.kmer_totals(K.kmer_counts(V.seqs(spark, d), SIZE, ALPHABET))


@query(f"WITH {V.SEQS}, {V.W} SELECT DISTINCT seq_id, kmer FROM w WHERE kmer IN (SELECT kmer FROM w GROUP BY kmer HAVING count(*) > 50)")
def feature_matrix(spark, d):
    return K.feature_matrix(V.seqs(spark, d), SIZE, ALPHABET, 50)


KEYS = ", ".join(f"('{c}')" for c in alphabet_keys(ALPHABET))


@query(f"WITH {V.SEQS}, {V.W}, c(c) AS (VALUES {KEYS}) SELECT " + " || ".join(f"c{i}.c" for i in range(SIZE)) + " AS kmer, coalesce(t.n, 0) AS total FROM " + ", ".join(f"c c{i}" for i in range(SIZE)) + " LEFT JOIN (SELECT kmer, count(*) AS n FROM w GROUP BY kmer) t ON t.kmer = " + " || ".join(f"c{i}.c" for i in range(SIZE)))
def kmer_space(spark, d):
    totals = K.kmer_totals(K.kmer_counts(V.seqs(spark, d), SIZE, ALPHABET))
    return K.kmer_space(spark, ALPHABET, SIZE).join(totals, "kmer", "left").select("kmer", F.coalesce("total", F.lit(0)).alias("total"))


BW = V.windows_sql(*V.LEARN, "background", "bw")


@query(f"WITH {V.SEQS}, {V.BACKGROUND}, {V.W}, {BW} SELECT seq_id, kmer, count(*) AS cnt FROM w WHERE kmer IN (SELECT kmer FROM bw) GROUP BY seq_id, kmer")
def harmonize(spark, d):
    return K.kmer_counts(V.seqs(spark, d), SIZE, ALPHABET, K.kmer_basis(V.background(spark, d), SIZE, ALPHABET))


@query(f"WITH {V.SEQS}, {V.BACKGROUND}, {V.W}, {BW} SELECT kmer FROM w UNION SELECT kmer FROM bw")
def common_basis(spark, d):
    return K.common_basis(K.kmer_basis(V.seqs(spark, d), SIZE, ALPHABET), K.kmer_basis(V.background(spark, d), SIZE, ALPHABET))


@query(f"WITH {V.SEQS}, {V.W}, {V.KP} SELECT seq_id, kmer FROM kp WHERE kmer IN (SELECT kmer FROM kp GROUP BY kmer HAVING count(*) > 5 AND count(*) < 50)")
def rep_filter(spark, d):
    return K.filter_by_rep(K.presence(V.seqs(spark, d), SIZE, ALPHABET), 5, 50)


@query(f"WITH {V.SEQS}, {V.W}, {V.KC} SELECT seq_id, kmer, cnt, cnt / length(sequence) AS value FROM kc JOIN seqs USING (seq_id)")
def normalized_features(spark, d):
    s = V.seqs(spark, d)
    return K.normalize_features(K.kmer_counts(s, SIZE, ALPHABET), s.select("seq_id", F.char_length("sequence").alias("length")))


def chars_sql(w: str) -> str:
    return f"(SELECT string_agg(c, '' ORDER BY c) FROM (SELECT DISTINCT unnest(string_split(kmer, '')) AS c FROM (SELECT DISTINCT kmer FROM {w})))"


@query(f"WITH {V.SEQS}, {V.BACKGROUND}, {V.W}, {BW} SELECT (SELECT max(length(kmer)) FROM w)::INTEGER AS k_a, (SELECT max(length(kmer)) FROM bw)::INTEGER AS k_b, {chars_sql('w')} AS chars_a, {chars_sql('bw')} AS chars_b, {chars_sql('w')} = {chars_sql('bw')} AS compatible")
def compat_check(spark, d):
    return K.compatibility(K.presence(V.seqs(spark, d), SIZE, ALPHABET), K.presence(V.background(spark, d), SIZE, ALPHABET))


CELLS = f"list_transform(range(1, length(r) - {SIZE - 2}), lambda i: {{'pos': i - 1, 'kmer': substr(r, i, {SIZE})}})"


@query(f"WITH {V.SEQS} SELECT kmer, count(*) AS n, CAST(min(pos) AS INTEGER) AS first_pos, CAST(max(pos) AS INTEGER) AS last_pos FROM (SELECT unnest({CELLS}, recursive := true) FROM (SELECT {V.reduced_sql(ALPHABET)} AS r FROM seqs)) WHERE regexp_full_match(kmer, '{K.key_pattern(ALPHABET)}{{{SIZE}}}') GROUP BY kmer")
def kmer_positions(spark, d):
    return K.kmers(V.seqs(spark, d), SIZE, ALPHABET).groupBy("kmer").agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))


@query(f"WITH {V.SEQS}, x AS (SELECT seq_id, list_transform(range(1, length(sequence) - {SIZE - 2}), lambda i: substr(sequence, i, {SIZE})) AS a FROM seqs) SELECT seq_id, CAST(len(a) AS INTEGER) AS n_windows, CAST(len(list_distinct(a)) AS INTEGER) AS n_distinct FROM x")
def raw_windows(spark, d):
    rows = V.seqs(spark, d).select("seq_id", K.kmer_windows(F.col("sequence"), SIZE).alias("a"))
    return rows.select("seq_id", F.size("a").alias("n_windows"), F.size(F.array_distinct("a")).alias("n_distinct"))


SHORT = V.windows_sql(ALPHABET, 4)


@query(f"WITH {V.SEQS}, {SHORT}, b AS (SELECT kmer, row_number() OVER (ORDER BY kmer) - 1 AS i FROM (SELECT DISTINCT kmer FROM w)) SELECT seq_id, CAST(i AS INTEGER) AS idx, CAST(count(*) AS DOUBLE) AS value FROM w JOIN b USING (kmer) GROUP BY seq_id, i")
def vector_cells(spark, d):
    from pyspark.ml.functions import vector_to_array

    counts = written(K.kmer_counts(V.seqs(spark, d), 4, ALPHABET))
    vectors = K.to_vectors(counts, written(K.indexed(counts)))
    return vectors.select("seq_id", F.posexplode(vector_to_array("features")).alias("idx", "value")).where("value <> 0")


@query(SQL["vector_cells"])
def vectors_json_round_trip(spark, d):
    path = folder(spark)
    counts = written(K.kmer_counts(V.seqs(spark, d), 4, ALPHABET))
    tables.write_vectors_json(K.harmonize_dense(counts, written(K.indexed(counts))).withColumnRenamed("values", "vector"), path, 300)
    return tables.read_vectors_json(spark, path).select("seq_id", F.posexplode("vector").alias("idx", "value")).where("value <> 0")


# pairs


PW = ", ".join([V.SEQS, V.windows_sql(*V.PAIRS), V.KP, "sz AS (SELECT seq_id, count(*) AS n FROM kp GROUP BY seq_id)", """jac AS (SELECT a, b, x.n AS n_a, y.n AS n_b, common, 1 - common / (x.n + y.n - common) AS distance
  FROM (SELECT p.seq_id AS a, q.seq_id AS b, count(*) AS common FROM kp p JOIN kp q ON p.kmer = q.kmer AND p.seq_id < q.seq_id GROUP BY p.seq_id, q.seq_id) JOIN sz x ON x.seq_id = a JOIN sz y ON y.seq_id = b),
  near AS (SELECT * FROM jac WHERE distance <= 0.5)"""])


def pair_rows(spark, d):
    return sequence_sets(V.seqs(spark, d), V.PAIRS[1], V.PAIRS[0])


def near_pairs(spark, d):
    return D.jaccard_pairs(pair_rows(spark, d), 0.5)


@query(f"WITH {PW} SELECT a, b, distance FROM near")
def jaccard_pairs(spark, d):
    return near_pairs(spark, d)


@query(f"WITH {PW} SELECT a, b, 1 - (n_a + n_b - 2 * common) / (SELECT count(DISTINCT kmer) FROM kp) AS similarity FROM near")
def hamming_pairs(spark, d):
    return D.near_hamming(pair_rows(spark, d), 0.5)


METRIC = f"""WITH {PW}, {V.KC}, sums AS (SELECT seq_id, sum(cnt) AS s, sum(cnt * cnt) AS q FROM kc GROUP BY seq_id),
  m AS (SELECT a, b, sum(p.cnt * q.cnt) AS dot, sum(least(p.cnt, q.cnt)) AS low FROM near JOIN kc p ON p.seq_id = a JOIN kc q ON q.seq_id = b AND q.kmer = p.kmer GROUP BY a, b)
  SELECT a, b, {{}} AS distance FROM m JOIN sums x ON x.seq_id = a JOIN sums y ON y.seq_id = b"""


def metric(spark, d, name):
    return D.near_distance(pair_rows(spark, d), 0.5, name)


@query(METRIC.replace("{}", "1 - dot / (sqrt(x.q) * sqrt(y.q))"))
def cosine_pairs(spark, d):
    return metric(spark, d, "cosine")


@query(METRIC.replace("{}", "sqrt(x.q + y.q - 2 * dot)"))
def euclid_pairs(spark, d):
    return metric(spark, d, "euclidean")


@query(METRIC.replace("{}", "CAST(x.s + y.s - 2 * low AS DOUBLE)"))
def manhattan_pairs(spark, d):
    return metric(spark, d, "manhattan")


@query(f"WITH {PW} SELECT a, b, distance FROM near")
def distance_export(spark, d):
    path = folder(spark)
    D.write_distances(near_pairs(spark, d), path)
    return spark.read.parquet(path)


# learn and apply


def profile_counts(spark, d):
    """annotation, kmer, cnt of annotated sequences."""
    known = A.join_annotations(V.seqs(spark, d), V.annotations(spark, d))
    return A.annotation_counts(K.kmer_rows(known, SIZE, ALPHABET, ("annotation",)))


def scores(spark, d):
    return D.cosine_scores(K.kmer_counts(V.seqs(spark, d), SIZE, ALPHABET), profile_counts(spark, d))


def predicted(spark, d, found=None):
    return A.predictions(scores(spark, d) if found is None else found, A.tag_known(V.seqs(spark, d).drop("accession"), V.annotations(spark, d)))


def crosstab(spark, d, found=None):
    return A.tf_crosstab(written(predicted(spark, d, found)))


LEARNT = V.learn_sql()


@query(f"{LEARNT} SELECT annotation, kmer, cnt FROM ak")
def annotation_counts(spark, d):
    return profile_counts(spark, d)


@query(f"{LEARNT} SELECT annotation, kmer, cnt FROM ak UNION ALL SELECT 'Totals', kmer, count(*) FROM w GROUP BY kmer")
def counts_with_totals(spark, d):
    return A.with_totals(profile_counts(spark, d), K.kmer_rows(V.seqs(spark, d), SIZE, ALPHABET, ()).groupBy("kmer").agg(F.count("*").alias("total")))


@query(f"{LEARNT} SELECT ann.annotation, count(DISTINCT seqs.seq_id) AS n_seqs, coalesce(max(t.n), 0)::BIGINT AS n_kmers FROM seqs JOIN ann ON accession = id LEFT JOIN (SELECT annotation, sum(cnt) AS n FROM ak GROUP BY annotation) t ON t.annotation = ann.annotation GROUP BY ann.annotation")
def annotation_sizes(spark, d):
    return A.annotation_sizes(A.join_annotations(V.seqs(spark, d), V.annotations(spark, d)), profile_counts(spark, d))


def sizes_and_totals(spark, d, size):
    """Rows of all windows, counts of annotated ones, and sizes with the row of all."""
    s, known = V.seqs(spark, d), A.join_annotations(V.seqs(spark, d), V.annotations(spark, d))
    totals = written(K.kmer_rows(s, size, ALPHABET, ()).groupBy("kmer").agg(F.count("*").alias("total")))
    counts = written(A.annotation_counts(K.kmer_rows(known, size, ALPHABET, ("annotation",))))
    return A.with_totals(counts, totals), A.sizes_with_totals(A.annotation_sizes(known, counts), s, totals)


SIZES = "SELECT ann.annotation, count(DISTINCT seqs.seq_id) AS n_seqs, coalesce(max(t.n), 0)::BIGINT AS n_kmers FROM seqs JOIN ann ON accession = id LEFT JOIN (SELECT annotation, sum(cnt) AS n FROM ak GROUP BY annotation) t ON t.annotation = ann.annotation GROUP BY ann.annotation UNION ALL SELECT 'Totals', (SELECT count(*) FROM seqs), (SELECT count(*) FROM w)"


@query(f"{LEARNT} {SIZES}")
def sizes_with_totals(spark, d):
    return sizes_and_totals(spark, d, SIZE)[1]


@query(f"{LEARNT} SELECT annotation, kmer, 2 * cnt AS cnt FROM ak")
def merge_counts(spark, d):
    own = profile_counts(spark, d)
    return A.merge_counts(own, own)


@query(f"WITH {V.SEQS}, {V.ANN}, {V.BACKGROUND}, {V.W}, {BW}, {V.AK} SELECT annotation, kmer, sum(cnt)::BIGINT AS cnt FROM (SELECT * FROM ak UNION ALL SELECT 'background', kmer, count(*) FROM bw GROUP BY kmer) GROUP BY annotation, kmer")
def merge_with_base(spark, d):
    base = A.annotation_counts(K.kmer_rows(V.background(spark, d), SIZE, ALPHABET, ("label",)).withColumnRenamed("label", "annotation"))
    return A.merge_with_base(profile_counts(spark, d), base)


@query(f"{LEARNT} SELECT seq_id, annotation, score FROM cos")
def cosine_scores(spark, d):
    return scores(spark, d)


ASSOC = ", nseq AS (SELECT annotation, count(*) AS n FROM seqs JOIN ann ON accession = id GROUP BY annotation), assoc AS (SELECT ak.annotation, kmer, cnt / n AS association FROM ak JOIN nseq ON nseq.annotation = ak.annotation)"


def assoc(spark, d):
    n = A.join_annotations(V.seqs(spark, d), V.annotations(spark, d)).groupBy("annotation").agg(F.count("*").alias("n_seqs"))
    return D.associations(profile_counts(spark, d), n)


@query(f"{LEARNT}{ASSOC} SELECT * FROM assoc")
def associations(spark, d):
    return assoc(spark, d)


@query(f"{LEARNT}{ASSOC}, {V.KP} SELECT seq_id, annotation, round(sum(association), 6) AS score FROM kp JOIN assoc USING (kmer) GROUP BY seq_id, annotation")
def association_scores(spark, d):
    return D.association_scores(K.presence(V.seqs(spark, d), SIZE, ALPHABET), assoc(spark, d)).withColumn("score", F.round("score", 6))


@query(f"{LEARNT}{ASSOC}, {V.KP}, m AS (SELECT annotation, avg(association) AS m FROM assoc GROUP BY annotation), n AS (SELECT seq_id, count(*) AS n FROM kp WHERE kmer IN (SELECT kmer FROM assoc) GROUP BY seq_id), h AS (SELECT seq_id, annotation, sum(association) AS s, count(*) AS hit FROM kp JOIN assoc USING (kmer) GROUP BY seq_id, annotation) SELECT seq_id, annotation, round(s - m * (n - hit), 6) AS score FROM h JOIN n USING (seq_id) JOIN m USING (annotation)")
def enhanced_scores(spark, d):
    return D.enhanced_scores(K.presence(V.seqs(spark, d), SIZE, ALPHABET), assoc(spark, d)).withColumn("score", F.round("score", 6))


@query(f"WITH {V.SEQS}, {V.ANN} SELECT seq_id, annotation AS actual, annotation IS NOT NULL AS known FROM seqs LEFT JOIN ann ON accession = id")
def known_unknown(spark, d):
    return A.tag_known(V.seqs(spark, d).drop("accession"), V.annotations(spark, d)).select("seq_id", "actual", "known")


@query(f"{LEARNT} SELECT seq_id, annotation, score, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 2")
def top_two(spark, d):
    return A.top_two(scores(spark, d))


@query(f"{LEARNT} SELECT seq_id, " + ", ".join(f"max(CASE WHEN rank = {i} THEN annotation || ',' || format('{{:.6f}}', score) END) AS top{i}" for i in (1, 2, 3)) + " FROM ranked GROUP BY seq_id")
def top_n_summary(spark, d):
    return A.top_n_summary(scores(spark, d), 3)


@query(f"{LEARNT} SELECT * FROM pred")
def predictions(spark, d):
    return predicted(spark, d)


@query(f"{LEARNT} SELECT seq_id, prediction, actual, CASE WHEN known THEN contains(actual, prediction) END AS correct FROM pred")
def predictions_by_part(spark, d):
    tagged = A.tag_known(V.seqs(spark, d).drop("accession"), V.annotations(spark, d))
    return A.predictions(scores(spark, d), tagged, substring=True).select("seq_id", "prediction", "actual", "correct")


@query(f"{LEARNT} SELECT * FROM tf")
def tf_crosstab(spark, d):
    return crosstab(spark, d)


@query(f"{LEARNT} SELECT prediction, bin, 2 * n_true AS n_true, 2 * n_false AS n_false FROM tf")
def merge_crosstabs(spark, d):
    own = crosstab(spark, d)
    return A.merge_crosstabs(own, own)


@query(f"{LEARNT} SELECT *, CASE WHEN n_true + n_false > 0 THEN n_true / (n_true + n_false) END AS ratio FROM tf")
def confidence_matrix(spark, d):
    return A.confidence_matrix(crosstab(spark, d))


CONF = f"conf AS (SELECT bin, {V.fill_sql('graw', 'ratio', '', False)} AS confidence, weight, sum FROM graw)"
LEARNT_CONF = V.learn_sql(CONF)


@query(f"{LEARNT_CONF} SELECT bin, round(confidence, 9) AS confidence, weight, sum FROM conf")
def global_confidence(spark, d):
    return A.global_confidence(crosstab(spark, d)).withColumn("confidence", F.round("confidence", 9))


@query(f"{LEARNT} SELECT bin, coalesce(ratio, 1.0) AS confidence, weight, sum FROM graw")
def global_confidence_one(spark, d):
    return A.global_confidence(crosstab(spark, d), "one")


@query(f"{V.learn_sql('cm AS (SELECT *, CASE WHEN n_true + n_false > 0 THEN n_true / (n_true + n_false) END AS ratio FROM tf)')} SELECT prediction, bin, round(ratio, 9) AS ratio FROM (SELECT prediction, bin, {V.fill_sql('cm', 'ratio', 'prediction', True)} AS ratio FROM cm) WHERE ratio IS NOT NULL")
def imputed_confidence(spark, d):
    return A.impute_confidence(A.confidence_matrix(crosstab(spark, d))).withColumn("ratio", F.round("ratio", 9))


# the current table is that of the documents, the prior one that of their first halves: bins have different counts on the two sides
def merge_side(name: str, tf: str) -> str:
    return f"{name} AS (SELECT bin, n AS sum, CAST(sum(n) OVER () AS BIGINT) AS weight, CASE WHEN n > 0 THEN t / n ELSE 1.0 END AS confidence FROM (SELECT bin, CAST(sum(n_true) AS BIGINT) AS t, CAST(sum(n_true + n_false) AS BIGINT) AS n FROM {tf} GROUP BY bin))"


FRAG = f"fseqs AS (SELECT seq_id, accession, filename, label, substr(sequence, 1, CAST(floor(length(sequence) * 50 / 100) AS BIGINT)) AS sequence FROM seqs WHERE floor(length(sequence) * 50 / 100) >= 50), {V.windows_sql(*V.LEARN, 'fseqs', 'fw')}"
SECOND = [("FROM w ", "FROM fw "), ("kc.", "fkc."), ("FROM kc ", "FROM fkc "), ("kc AS", "fkc AS"), ("FROM cos", "FROM fcos"), ("cos AS", "fcos AS"), ("FROM ranked", "FROM franked"), ("ranked AS", "franked AS"), ("FROM pred ", "FROM fpred "), ("pred AS", "fpred AS"), ("tf AS", "ftf AS"), ("FROM seqs s", "FROM fseqs s")]


def second(cte: str) -> str:
    """A common table of the chain from counts to crosstab, over the first halves."""
    for old, new in SECOND:
        cte = cte.replace(old, new)
    return cte


HALVES = [FRAG, *map(second, (V.KC, V.COS, V.RANKED, V.PRED, V.TF))]
MERGED = f"{V.learn_sql(CONF, *HALVES, merge_side('prior', 'ftf'))} SELECT c.bin, round((p.confidence * p.weight + c.confidence * r.w) / (p.weight + r.w), 9) AS confidence, c.weight + p.weight AS weight, c.sum + p.sum AS sum FROM conf c JOIN prior p ON p.bin = c.bin JOIN (SELECT c.bin, c.weight * (1 + 20 * c.weight / (c.weight + p.weight)) AS w FROM conf c JOIN prior p ON p.bin = c.bin) r ON r.bin = c.bin"


@query(MERGED)
def merge_confidence(spark, d):
    return A.merge_confidence(A.global_confidence(crosstab(spark, d)), A.global_confidence(fragment_evaluation(spark, d), "one"), 20).withColumn("confidence", F.round("confidence", 9))


@query(f"{LEARNT} SELECT actual, avg(CASE WHEN actual = prediction THEN 1.0 ELSE 0.0 END) AS accuracy FROM pred WHERE known GROUP BY actual")
def annotation_accuracy(spark, d):
    return M.accuracy(predicted(spark, d).where("known"), ("actual",))


LABELS = [f"{lang}_q{q}t{t}" for lang in ("de", "en", "es", "fr") for q in (0, 1) for t in (0, 1)]


@query(f"{LEARNT} SELECT seq_id, " + ", ".join(f"round(coalesce(max(CASE WHEN annotation = '{x}' THEN score END), 0), 9) AS {x}" for x in LABELS) + " FROM cos GROUP BY seq_id")
def score_matrix(spark, d):
    return A.score_matrix(scores(spark, d), LABELS).select("seq_id", *[F.round(x, 9).alias(x) for x in LABELS])


APPLY = "SELECT seq_id, prediction, coalesce(top, 0) AS score, p.bin / 100 AS delta, round(confidence, 9) AS confidence FROM pred p LEFT JOIN conf ON conf.bin = p.bin"


@query(f"{LEARNT_CONF} {APPLY}")
def apply_annotations(spark, d):
    # scored once, for the confidence and for the predictions
    cosines = written(scores(spark, d))
    found = A.apply_scores(V.seqs(spark, d), cosines, A.global_confidence(crosstab(spark, d, cosines)))
    return found.withColumn("confidence", F.round("confidence", 9))


@query(f"{V.learn_sql(*HALVES)} SELECT * FROM ftf")
def fragment_evaluation(spark, d):
    part = P.fragment(V.seqs(spark, d), "percent", 50, "start", 50)
    found = D.cosine_scores(K.kmer_counts(part, SIZE, ALPHABET), profile_counts(spark, d))
    return A.tf_crosstab(A.predictions(found, A.tag_known(part.drop("accession"), V.annotations(spark, d))))


# family scores


def labelled(spark, d):
    s = V.seqs(spark, d)
    return written(K.presence(s, SIZE, ALPHABET)), s.select("seq_id", "label")


PROB = f"""{V.SEQS}, {V.W}, {V.KP}, lab AS (SELECT seq_id, label FROM seqs), nl AS (SELECT label, count(*) AS n FROM lab GROUP BY label),
  pr AS (SELECT label, kmer, count(*) AS count, count(*) / max(n) AS probability FROM kp JOIN lab USING (seq_id) JOIN nl USING (label) GROUP BY label, kmer)"""
SCORE = f"""{PROB}, sc AS (SELECT g.label, g.kmer, coalesce(pr.count, 0) AS count, coalesce(probability, 0) AS probability, coalesce(probability, 0) - 1 / ((SELECT count(*) FROM nl) - 1) * (g.s - coalesce(probability, 0)) AS score
  FROM (SELECT label, kmer, s FROM nl, (SELECT kmer, sum(probability) AS s FROM pr GROUP BY kmer)) g LEFT JOIN pr ON pr.label = g.label AND pr.kmer = g.kmer)"""
TOP = f"{SCORE}, tops AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY probability DESC, kmer) - 1 AS index, floor(count(*) OVER (PARTITION BY label) * 0.25) AS lim FROM sc)"
TOTAL = f"""{TOP}, tot AS (SELECT nl.label, lab.seq_id, coalesce(t, 0) AS total FROM lab CROSS JOIN nl LEFT JOIN (SELECT tops.label, seq_id, sum(score) AS t FROM kp JOIN tops USING (kmer) WHERE index < lim GROUP BY tops.label, seq_id) h ON h.label = nl.label AND h.seq_id = lab.seq_id),
  nrm AS (SELECT label, greatest(max(total), 1) AS norm FROM tot GROUP BY label)"""


@query(f"WITH {PROB} SELECT label, kmer, count, probability FROM pr")
def class_probabilities(spark, d):
    return E.class_probabilities(*labelled(spark, d))


@query(f"WITH {SCORE} SELECT label, kmer, count, probability, round(score, 9) AS score FROM sc")
def class_scores(spark, d):
    pairs, labels = labelled(spark, d)
    return E.class_scores(E.class_probabilities(pairs, labels), labels).withColumn("score", F.round("score", 9))


@query(f"WITH {SCORE} SELECT label, kmer, round(score - probability, 9) + 0 AS score FROM sc")
def negative_scores(spark, d):
    pairs, labels = labelled(spark, d)
    return E.class_scores(E.class_probabilities(pairs, labels), labels, neg_only=True).select("label", "kmer", unsigned("score", 9))


@query(f"WITH {TOP} SELECT DISTINCT seq_id, kmer FROM kp WHERE kmer IN (SELECT kmer FROM tops WHERE index < lim)")
def selected_kmers(spark, d):
    pairs, labels = labelled(spark, d)
    return E.select_kmers(pairs, E.top_kmers(E.class_scores(E.class_probabilities(pairs, labels), labels), 0.25, order="probability"))


@query(f"WITH {TOP} SELECT label, kmer, CAST(index AS INTEGER) AS index, probability FROM tops WHERE index < lim")
def top_kmers(spark, d):
    pairs, labels = labelled(spark, d)
    return E.top_kmers(E.class_scores(E.class_probabilities(pairs, labels), labels), 0.25, order="probability").select("label", "kmer", "index", "probability")


@query(f"WITH {TOTAL} SELECT label, seq_id, round(total / norm, 6) AS score FROM tot JOIN nrm USING (label)")
def sequence_scores(spark, d):
    return E.fit_family_scores(*labelled(spark, d))[1].select("label", "seq_id", F.round("score", 6).alias("score"))


@query(f"WITH {TOTAL} SELECT label, round(min(s), 6) AS min, round(quantile_cont(s, 0.25), 6) AS q1, round(median(s), 6) AS median, round(quantile_cont(s, 0.75), 6) AS q3, round(max(s), 6) AS max, count(*) AS n FROM (SELECT label, total / norm AS s FROM tot JOIN nrm USING (label)) GROUP BY label")
def score_distribution(spark, d):
    rows = E.score_distribution(E.fit_family_scores(*labelled(spark, d))[1])
    return rows.select("label", "n", *[F.round(c, 6).alias(c) for c in ("min", "q1", "median", "q3", "max")])


@query(f"""WITH {TOTAL}, {V.BACKGROUND}, {BW}, bp AS (SELECT DISTINCT seq_id, kmer FROM bw),
  h AS (SELECT label, seq_id, sum(score) AS t FROM bp JOIN sc USING (kmer) GROUP BY label, seq_id)
  SELECT nl.label, b.seq_id, round(coalesce(t, 0) / norm, 6) AS score FROM background b CROSS JOIN nl JOIN nrm ON nrm.label = nl.label LEFT JOIN h ON h.label = nl.label AND h.seq_id = b.seq_id""")
def search_scores(spark, d):
    weights, scored = E.fit_family_scores(*labelled(spark, d))
    new = V.background(spark, d)
    return E.score_new(K.presence(new, SIZE, ALPHABET), weights, scored, new).withColumn("score", F.round("score", 6))


BGP = f"""{SCORE}, {V.BACKGROUND}, {BW}, bp AS (SELECT kmer, count(DISTINCT seq_id) / (SELECT count(*) FROM background) AS bg FROM bw GROUP BY kmer)"""


@query(f"WITH {BGP} SELECT label, kmer, round(probability - coalesce(bg, 0), 9) AS bg_only, round(score - coalesce(bg, 0), 9) AS both FROM sc LEFT JOIN bp USING (kmer)")
def method_scores(spark, d):
    pairs, labels = labelled(spark, d)
    sample = E.class_scores(E.class_probabilities(pairs, labels), labels)
    b = V.background(spark, d)
    bg = E.class_probabilities(K.presence(b, SIZE, ALPHABET), b.select("seq_id", "label"))
    one, two = (E.method_scores(sample, bg, m).select("label", "kmer", F.round("score", 9).alias(m)) for m in ("bg_only", "both"))
    return one.join(two, ["label", "kmer"])


# background: the files whose name ends in 9, of the same labels as the others
def sample_and_background(spark, d):
    rows = V.seqs(spark, d).select("seq_id", "label", "filename")
    files = P.flag_background(rows, rows.where(F.col("filename").endswith("9.fasta")).select("filename"))
    side = lambda back: files.where(F.col("background") == back).select("seq_id", "label")
    return K.presence(V.seqs(spark, d), SIZE, ALPHABET), side(False), side(True)


def sided(name: str, back: bool) -> str:
    """pr, nl and sc of PROB and SCORE over one side of the files."""
    ctes = SCORE.split("lab AS", 1)[1]
    for c in ("lab", "nl", "pr", "sc"):
        for old, new in ((f" {c} ", f" {name}{c} "), (f" {c},", f" {name}{c},"), (f" {c})", f" {name}{c})"), (f"{c}.", f"{name}{c}."), (f"({c} ", f"({name}{c} ")):
            ctes = ctes.replace(old, new)
    return f"{name}lab AS" + ctes.replace("FROM seqs)", f"FROM seqs WHERE {'' if back else 'NOT '}filename LIKE '%9.fasta')")


BACK = f"""{V.SEQS}, {V.W}, {V.KP}, {sided('s', False)}, {sided('b', True)},
  chosen AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY probability DESC, kmer) - 1 AS index, floor(count(*) OVER (PARTITION BY label) * 0.25) AS lim FROM ssc) WHERE index < lim),
  bt AS (SELECT x.label, x.background_label, seqs.seq_id, coalesce(t, 0) AS total FROM seqs CROSS JOIN (SELECT DISTINCT chosen.label, bsc.label AS background_label FROM chosen JOIN bsc USING (kmer)) x
    LEFT JOIN (SELECT chosen.label, bsc.label AS background_label, seq_id, sum(bsc.score) AS t FROM kp JOIN chosen USING (kmer) JOIN bsc USING (kmer) GROUP BY chosen.label, bsc.label, seq_id) h ON h.label = x.label AND h.background_label = x.background_label AND h.seq_id = seqs.seq_id),
  bs AS (SELECT label, background_label, seq_id, total, norm, CASE WHEN norm <> 0 THEN total / norm ELSE 0 END AS score FROM bt JOIN (SELECT label, background_label, max(total) AS norm FROM bt GROUP BY label, background_label) USING (label, background_label)),
  st AS (SELECT l.label, seqs.seq_id, coalesce(t, 0) AS total FROM seqs CROSS JOIN snl l LEFT JOIN (SELECT chosen.label, seq_id, sum(score) AS t FROM kp JOIN chosen USING (kmer) GROUP BY chosen.label, seq_id) h ON h.label = l.label AND h.seq_id = seqs.seq_id),
  ss AS (SELECT label, seq_id, total / norm AS score FROM st JOIN (SELECT label, greatest(max(total), 1) AS norm FROM st GROUP BY label) USING (label))"""


@query(f"WITH {BACK} SELECT label, background_label, seq_id, round(score, 6) AS score FROM bs")
def background_scores(spark, d):
    _, sample, background = sample_and_background(spark, d)
    found = E.background_sums(sequence_sets(V.seqs(spark, d), SIZE, ALPHABET), SIZE, ALPHABET, sample, background)[1]
    return found.select("label", "background_label", "seq_id", F.round("score", 6).alias("score"))


@query(f"WITH {BACK} SELECT label, seq_id, round(ss.score, 6) + 0 AS score, round(ss.score * (1 - bs.score), 6) + 0 AS weighted, round(ss.score - bs.score, 6) + 0 AS subtracted FROM ss JOIN bs USING (label, seq_id) WHERE label = background_label")
def combined_scores(spark, d):
    _, sample, background = sample_and_background(spark, d)
    rows = E.combine_background(*E.background_sums(sequence_sets(V.seqs(spark, d), SIZE, ALPHABET), SIZE, ALPHABET, sample, background, matched=True))
    return rows.select("label", "seq_id", *[unsigned(c, 6) for c in ("score", "weighted", "subtracted")])


@query(f"WITH {BACK} SELECT label, kmer, round(coalesce(ssc.score, 0), 9) + 0 AS sample, round(coalesce(bsc.score, 0), 9) + 0 AS background FROM ssc FULL JOIN bsc USING (label, kmer)")
def family_weights(spark, d):
    pairs, sample, background = sample_and_background(spark, d)
    own, other = (E.class_scores(E.class_probabilities(pairs, x), x) for x in (sample, background))
    return E.family_weights(own, other).select("label", "kmer", *[unsigned(c, 9) for c in ("sample", "background")])


# cross-validation


FOLD = "fold AS (SELECT seq_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY md5('0:' || seq_id), seq_id) - 1) % 5 + 1 AS INTEGER) AS own FROM seqs)"


@query(f"WITH {V.SEQS}, {FOLD} SELECT seq_id, label, own AS fold FROM fold")
def stratified_folds(spark, d):
    return E.stratified_folds(V.seqs(spark, d).select("seq_id", "label"), "label", 5)


@query(f"WITH {V.SEQS}, {FOLD} SELECT seq_id, label, own AS fold, " + ", ".join(f'own <> {i} AS "train_cv-0{i}"' for i in range(1, 6)) + " FROM fold")
def fold_flags(spark, d):
    return E.fold_flags(E.stratified_folds(V.seqs(spark, d).select("seq_id", "label"), "label", 5), 5)


@query(f"WITH {V.SEQS} SELECT seq_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('0:' || seq_id), seq_id) - 1 >= round(count(*) OVER (PARTITION BY label) * 0.25) AS train FROM seqs")
def stratified_split(spark, d):
    return E.stratified_split(V.seqs(spark, d).select("seq_id", "label"), "label")


CV = f"""{V.SEQS}, {V.W}, {V.KP}, {FOLD}, fr AS (SELECT f, seq_id, label, own <> f AS train FROM fold, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS f)),
  nl AS (SELECT f, label, count(*) AS n FROM fr WHERE train GROUP BY f, label),
  pr AS (SELECT fr.f, fr.label, kmer, count(*) / max(n) AS probability FROM kp JOIN fr USING (seq_id) JOIN nl ON nl.f = fr.f AND nl.label = fr.label WHERE train GROUP BY fr.f, fr.label, kmer),
  sc AS (SELECT g.f, g.label, g.kmer, coalesce(probability, 0) AS probability, coalesce(probability, 0) - 1 / (g.l - 1) * (g.s - coalesce(probability, 0)) AS score
    FROM (SELECT x.f, label, kmer, s, l FROM (SELECT *, count(*) OVER (PARTITION BY f) AS l FROM nl) x JOIN (SELECT f, kmer, sum(probability) AS s FROM pr GROUP BY f, kmer) y ON x.f = y.f) g LEFT JOIN pr ON pr.f = g.f AND pr.label = g.label AND pr.kmer = g.kmer),
  tops AS (SELECT *, row_number() OVER (PARTITION BY f, label ORDER BY probability DESC, kmer) - 1 AS index, floor(count(*) OVER (PARTITION BY f, label) * 0.25) AS lim FROM sc),
  hit AS (SELECT tops.f, tops.label, kp.seq_id, sum(score) AS t FROM kp JOIN tops ON tops.kmer = kp.kmer JOIN fr ON fr.f = tops.f AND fr.seq_id = kp.seq_id WHERE NOT train OR index < lim GROUP BY tops.f, tops.label, kp.seq_id),
  tot AS (SELECT nl.f, nl.label, fr.seq_id, train, fr.label = nl.label AS own, coalesce(t, 0) AS total FROM fr JOIN nl ON nl.f = fr.f LEFT JOIN hit ON hit.f = fr.f AND hit.label = nl.label AND hit.seq_id = fr.seq_id),
  cv AS (SELECT tot.f AS fold, tot.label, seq_id, tot.train, CAST(own AS INTEGER) AS in_family, round(total / norm, 6) AS score FROM tot JOIN (SELECT f, label, greatest(max(total), 1) AS norm FROM tot WHERE train GROUP BY f, label) n ON n.f = tot.f AND n.label = tot.label)"""


def cv(spark, d):
    pairs, labels = labelled(spark, d)
    return written(E.cv_scores(pairs, labels, 5).withColumn("score", F.round("score", 6)))


@query(f"WITH {CV} SELECT * FROM cv")
def cv_scores(spark, d):
    return cv(spark, d)


TH = f"""{CV}, th AS (SELECT *, sum(pos) OVER (PARTITION BY label, fold ORDER BY score DESC) AS tp, sum(neg) OVER (PARTITION BY label, fold ORDER BY score DESC) AS fp, sum(pos) OVER (PARTITION BY label, fold) AS p, sum(neg) OVER (PARTITION BY label, fold) AS n
  FROM (SELECT label, fold, score, sum(in_family) AS pos, sum(1 - in_family) AS neg FROM cv WHERE NOT train GROUP BY label, fold, score))"""


@query(f"WITH {TH} SELECT label, fold, sum(pos * (2 * (n - fp) + neg)) / (2 * max(p) * max(n)) AS auc FROM th GROUP BY label, fold")
def roc_auc(spark, d):
    return M.roc_auc(cv(spark, d).where("NOT train"))


@query(f"WITH {TH} SELECT label, fold, round(sum(pos * tp / (tp + fp)) / max(p), 9) AS average_precision FROM th GROUP BY label, fold")
def average_precision(spark, d):
    return M.average_precision(cv(spark, d).where("NOT train")).withColumn("average_precision", F.round("average_precision", 9))


@query(f"""WITH {TH}, seg AS (SELECT label, fold, fp / n AS x1, tp / p AS y1, lag(fp / n, 1, 0) OVER (PARTITION BY label, fold ORDER BY score DESC) AS x0, lag(tp / p, 1, 0) OVER (PARTITION BY label, fold ORDER BY score DESC) AS y0 FROM th),
  grid AS (SELECT unnest(range(0, 100)) AS i)
  SELECT label, fold, i, i / 99 AS fpr, round(CASE WHEN i = 0 THEN 0 ELSE y0 + (y1 - y0) * (i / 99 - x0) / (x1 - x0) END, 9) AS tpr FROM seg JOIN grid ON i >= ceil(x0 * 99 - 1e-9) AND (i < ceil(x1 * 99 - 1e-9) OR x1 = 1) WHERE x1 > x0""")
def roc_curve(spark, d):
    return M.roc_curve(cv(spark, d).where("NOT train")).withColumn("tpr", F.round("tpr", 9))


@query(f"SELECT label, i, fpr, round(tpr, 6) AS tpr, round(greatest(tpr - sd, 0), 6) AS low, round(least(tpr + sd, 1), 6) AS high FROM (SELECT label, i, fpr, avg(tpr) AS tpr, stddev_pop(tpr) AS sd FROM ({SQL['roc_curve']}) GROUP BY label, i, fpr)")
def mean_roc(spark, d):
    rows = M.mean_roc(M.roc_curve(cv(spark, d).where("NOT train")))
    return rows.select("label", "i", "fpr", *[F.round(c, 6).alias(c) for c in ("tpr", "low", "high")])


@query(f"""WITH {CV}, th AS (SELECT *, sum(pos) OVER (PARTITION BY label ORDER BY score DESC) AS tp, sum(neg) OVER (PARTITION BY label ORDER BY score DESC) AS fp, sum(pos) OVER (PARTITION BY label) AS p
  FROM (SELECT label, score, sum(in_family) AS pos, sum(1 - in_family) AS neg FROM cv WHERE NOT train GROUP BY label, score)) SELECT label, score, tp / p AS recall, tp / (tp + fp) AS precision FROM th""")
def pr_curve(spark, d):
    return M.pr_curve(cv(spark, d).where("NOT train"))


@query(f"WITH {TH} SELECT label, '{ALPHABET}' AS alphabet_name, CAST({SIZE} AS INTEGER) AS k, scoring, round(score, 9) AS score, fold AS cv_split FROM (SELECT label, fold, 'auc_roc' AS scoring, sum(pos * (2 * (n - fp) + neg)) / (2 * max(p) * max(n)) AS score FROM th GROUP BY label, fold UNION ALL SELECT label, fold, 'pr_auc', sum(pos * tp / (tp + fp)) / max(p) FROM th GROUP BY label, fold)")
def cv_results(spark, d):
    return M.cv_results(cv(spark, d).where("NOT train"), ALPHABET, SIZE).withColumn("score", F.round("score", 9))


# classifiers


def own_scores(spark, d):
    pairs, labels = labelled(spark, d)
    scored = E.fit_family_scores(pairs, labels)[1]
    return scored.join(labels.withColumnRenamed("label", "own"), "seq_id").select("label", "seq_id", "score", (F.col("own") == F.col("label")).cast("int").alias("in_family"))


NEWTON = f"""WITH RECURSIVE {TOTAL}, rows_ AS MATERIALIZED (SELECT tot.label, tot.seq_id, total / norm AS x, CASE WHEN lab.label = tot.label THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y FROM tot JOIN nrm USING (label) JOIN lab USING (seq_id)),
  newton(i, label, w, b) AS (SELECT 0, label, 0.0::DOUBLE, 0.0::DOUBLE FROM nl UNION ALL
    SELECT i + 1, label, w - (bb * gw - wb * gb) / (ww * bb - wb * wb), b - (ww * gb - wb * gw) / (ww * bb - wb * wb)
    FROM (SELECT i, label, w, b, w + sum((p - y) * x) AS gw, sum(p - y) AS gb, 1 + sum(p * (1 - p) * x * x) AS ww, sum(p * (1 - p) * x) AS wb, sum(p * (1 - p)) AS bb
      FROM (SELECT n.i, n.label, n.w, n.b, x, y, 1 / (1 + exp(-(n.w * x + n.b))) AS p FROM newton n JOIN rows_ ON rows_.label = n.label WHERE n.i < 30) GROUP BY i, label, w, b)),
  models AS (SELECT label, w, b FROM newton WHERE i = 30)"""


@query(f"{NEWTON} SELECT label, round(w, 6) AS w, round(b, 6) AS b FROM models")
def family_classifier(spark, d):
    return M.fit_family_models(own_scores(spark, d)).select("label", F.round("w", 6).alias("w"), F.round("b", 6).alias("b"))


@query(f"""{NEWTON}, {V.BACKGROUND}, {BW}, bp AS (SELECT DISTINCT seq_id, kmer FROM bw), h AS (SELECT label, seq_id, sum(score) AS t FROM bp JOIN sc USING (kmer) GROUP BY label, seq_id),
  found AS (SELECT nl.label, b.seq_id, b.filename, coalesce(t, 0) / norm AS score FROM background b CROSS JOIN nl JOIN nrm ON nrm.label = nl.label LEFT JOIN h ON h.label = nl.label AND h.seq_id = b.seq_id)
  SELECT filename, seq_id, models.label AS model, round(score, 6) AS score, 1 / (1 + exp(-(w * score + b))) > 0.5 AS in_family, round(1 / (1 + exp(-(w * score + b))), 6) AS probability FROM found JOIN models ON models.label = found.label""")
def search_predictions(spark, d):
    """The families' models on sequences that none of them was fitted on."""
    pairs, labels = labelled(spark, d)
    weights, scored = E.fit_family_scores(pairs, labels)
    scored = written(scored)
    own = scored.join(labels.withColumnRenamed("label", "own"), "seq_id").select("label", "score", (F.col("own") == F.col("label")).cast("int").alias("in_family"))
    new = V.background(spark, d)
    rows = E.score_new(K.presence(new, SIZE, ALPHABET), weights, scored, new).join(new.select("seq_id", "filename"), "seq_id")
    found = M.predict_families(rows, M.fit_family_models(own))
    return found.select("filename", "seq_id", F.col("label").alias("model"), F.round("score", 6).alias("score"), "in_family", F.round("probability", 6).alias("probability"))


def embedded(spark, d):
    from pyspark.ml.functions import array_to_vector

    return V.table(spark, d, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"), "label")


def family_features(spark, d):
    """Scores of the family `en` with the library's folds."""
    from pyspark.ml.functions import array_to_vector

    return cv(spark, d).where("label = 'en'").select("fold", "seq_id", "train", "in_family", array_to_vector(F.array("score")).alias("features"))


@query()
def classifier_zoo(spark, d):
    return M.held_out_accuracy(family_features(spark, d), svc={"regParam": 0.01, "maxIter": 30}).withColumn("accuracy", F.round("accuracy", 9))


@query()
def grid_search(spark, d):
    """Each row in the fold that it does not train, with the score that it has there."""
    rows = family_features(spark, d).where("NOT train").select("seq_id", "features", F.col("in_family").cast("double").alias("label"), (F.col("fold") - 1).alias("own"))
    ordered = written(rows.repartitionByRange("seq_id").sortWithinPartitions("seq_id"))
    return M.search_results(M.grid_search(ordered, depths=(2, 4), leaves=(1, 5), folds=5, fold_col="own"), spark)


# clusters


@query()
def kmeans(spark, d):
    return G.cluster_kmeans(embedded(spark, d), 10).select("vec_id", "label", "cluster")


@query()
def pca_explained(spark, d):
    return G.pca_explained(spark, embedded(spark, d), 8)


def lloyd_sql(k: int, steps: int) -> str:
    """CTEs at0 .. at{steps}: the clusters of all sequences after so many Lloyd steps from k sets of k-mers, in whole numbers up to the last division."""
    out = f"""sets AS (SELECT seq_id, md5(string_agg(kmer, '' ORDER BY kmer)) AS h FROM kp GROUP BY seq_id),
  seeds AS MATERIALIZED (SELECT rep, row_number() OVER (ORDER BY md5(rep), rep) - 1 AS cluster FROM (SELECT min(seq_id) AS rep FROM sets GROUP BY h) ORDER BY md5(rep), rep LIMIT {k}),
  m0 AS MATERIALIZED (SELECT cluster, kmer, 1 AS m FROM seeds JOIN kp ON seq_id = rep), n0 AS MATERIALIZED (SELECT cluster, 1 AS n FROM seeds)"""
    for i in range(steps + 1):
        out += f""", at{i} AS MATERIALIZED (SELECT seq_id, CAST(arg_min(cluster, (d, cluster)) AS INTEGER) AS cluster FROM (
    SELECT s.seq_id, c.cluster, CAST(c.q AS DOUBLE) / (c.n * c.n) - CAST(2 * coalesce(h.m, 0) AS DOUBLE) / c.n AS d FROM seqs s CROSS JOIN (SELECT cluster, n, sum(m * m) AS q FROM m{i} JOIN n{i} USING (cluster) GROUP BY cluster, n) c
    LEFT JOIN (SELECT seq_id, cluster, sum(m) AS m FROM kp JOIN m{i} USING (kmer) GROUP BY seq_id, cluster) h ON h.seq_id = s.seq_id AND h.cluster = c.cluster) GROUP BY seq_id),
  f{i} AS MATERIALIZED (SELECT cluster, count(*) AS n FROM at{i} GROUP BY cluster),
  n{i + 1} AS MATERIALIZED (SELECT cluster, coalesce(f{i}.n, n{i}.n) AS n FROM n{i} LEFT JOIN f{i} USING (cluster)),
  m{i + 1} AS MATERIALIZED (SELECT cluster, kmer, count(*) AS m FROM at{i} JOIN kp USING (seq_id) GROUP BY cluster, kmer UNION ALL SELECT cluster, kmer, m FROM m{i} WHERE cluster NOT IN (SELECT cluster FROM f{i}))"""
    return out


@query(f"WITH {V.SEQS}, {V.W}, {V.KP}, {lloyd_sql(8, 10)} SELECT seq_id, cluster FROM at10")
def sequence_kmeans(spark, d):
    """Eight clusters of k-mer presence after at most ten of Lloyd's steps."""
    return C.cluster_presence(K.presence(V.seqs(spark, d), SIZE, ALPHABET), ids(spark, d), 8, passes=10)


def principal(spark, d):
    """Presence of the library's default motif k-mers and its eight components."""
    cells = written(K.presence(V.seqs(spark, d), 3, "standard").withColumn("value", F.lit(1.0)))
    return cells, C.kmer_components(cells, ids(spark, d), 8)


@query()
def sequence_pca_explained(spark, d):
    return principal(spark, d)[1][0]


@query()
def sequence_pca_scores(spark, d):
    return principal(spark, d)[1][2]


VARIED = f"WITH {V.SEQS}, {V.windows_sql('standard', 3)}, {V.KP}, varied AS (SELECT kmer FROM kp GROUP BY kmer HAVING count(*) < (SELECT count(*) FROM seqs))"


@query(f"{VARIED} SELECT CAST(component AS INTEGER) AS component, kmer, CAST(0 AS DOUBLE) AS residual FROM varied, range(1, 9) r(component)")
def sequence_pca_residuals(spark, d):
    """Each component is an eigenvector: to three digits the covariance leaves its loadings as they are."""
    cells, (explained, loadings, _) = principal(spark, d)
    return C.component_residuals(cells, ids(spark, d), explained, loadings).select("component", "kmer", unsigned("residual", 3))


@query(f"WITH {V.SEQS} SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS covariance, (SELECT count(*) FROM seqs) AS n FROM range(1, 9) x(i), range(1, 9) y(j) WHERE i <= j")
def sequence_pca_covariances(spark, d):
    """Scores have mean 0, the variances that are explained, and no correlation."""
    cells, (explained, loadings, scores) = principal(spark, d)
    varied = written(loadings.where("loading <> 0").agg(F.countDistinct("kmer").alias("varied")))
    scaled = written(scores.join(explained, "component").select("seq_id", "component", (F.col("score") / F.sqrt(F.col("explained") * varied.scalar())).alias("z")))
    met = scaled.withColumnsRenamed({"component": "i", "z": "y"}).join(scaled.withColumnRenamed("component", "j"), "seq_id").where("i <= j")
    return met.groupBy("i", "j").agg(F.avg(F.col("y") * F.col("z")).alias("covariance"), F.count("*").alias("n")).select("i", "j", unsigned("covariance", 3), "n")


REACH = f"""WITH RECURSIVE {PW}, both_ AS (SELECT a, b FROM near UNION SELECT b, a FROM near),
  reach AS (SELECT seq_id AS s, seq_id AS t FROM seqs UNION SELECT s, b FROM reach JOIN both_ ON a = t), comp AS (SELECT s AS seq_id, min(t) AS component FROM reach GROUP BY s)"""


def ids(spark, d):
    return V.seqs(spark, d).select("seq_id")


@query(f"{REACH} SELECT seq_id, component FROM comp")
def components(spark, d):
    return G.connected_components(ids(spark, d), D.jaccard_links(pair_rows(spark, d), 0.5))


@query(f"{REACH.replace('distance <= 0.5', 'distance < 0.5')} SELECT seq_id, component FROM comp")
def agglomerative_jaccard(spark, d):
    return G.cluster_agglomerative_jaccard(pair_rows(spark, d), ids(spark, d), 0.5, "single")


#: One-by-one average linkage of each component: the matrix of distances, row after row, is updated after each merge; 9 stands for a pair that is gone.
MERGED_MEAN = "(size[i + 1] * d[i * n + {k} + 1] + size[j + 1] * d[j * n + {k} + 1]) / (size[i + 1] + size[j + 1])"
LINKAGE = f"""{REACH.replace('distance <= 0.5', 'distance < 0.5')}, mm AS (SELECT component, seq_id, row_number() OVER (PARTITION BY component ORDER BY seq_id) - 1 AS i, count(*) OVER (PARTITION BY component) AS n FROM comp),
  mat AS (SELECT x.component, x.n, list(CASE WHEN x.i = y.i THEN 9.0::DOUBLE ELSE coalesce(jac.distance, 1.0::DOUBLE) END ORDER BY x.i, y.i) AS d
    FROM mm x JOIN mm y ON x.component = y.component LEFT JOIN jac ON jac.a = least(x.seq_id, y.seq_id) AND jac.b = greatest(x.seq_id, y.seq_id) WHERE x.n > 1 GROUP BY x.component, x.n),
  step(component, n, d, size, label, k) AS (SELECT component, n, d, list_transform(range(n), lambda x: 1.0::DOUBLE), range(n), 0 FROM mat UNION ALL
    SELECT component, n, list_transform(range(n * n), lambda p: CASE WHEN p // n = j OR p % n = j OR p = i * n + i THEN 9.0::DOUBLE WHEN p // n = i THEN {MERGED_MEAN.format(k='p % n')} WHEN p % n = i THEN {MERGED_MEAN.format(k='p // n')} ELSE d[p + 1] END),
      list_transform(range(n), lambda x: CASE WHEN x = i THEN size[i + 1] + size[j + 1] ELSE size[x + 1] END), list_transform(label, lambda x: CASE WHEN x = j THEN i ELSE x END), k + 1
    FROM (SELECT *, place // n AS i, place % n AS j FROM (SELECT *, list_position(d, list_min(d)) - 1 AS place FROM step WHERE list_min(d) < 0.5))),
  labels_ AS (SELECT component, arg_max(label, k) AS label FROM step GROUP BY component)"""


@query(f"{LINKAGE} SELECT m.seq_id, coalesce(c.seq_id, m.seq_id) AS component FROM mm m LEFT JOIN labels_ l ON l.component = m.component LEFT JOIN mm c ON c.component = m.component AND c.i = l.label[m.i + 1]")
def agglomerative_average(spark, d):
    return G.cluster_agglomerative_jaccard(pair_rows(spark, d), ids(spark, d), 0.5, "average")


@query(f"{LINKAGE.replace(MERGED_MEAN.format(k='p % n'), 'greatest(d[i * n + p % n + 1], d[j * n + p % n + 1])').replace(MERGED_MEAN.format(k='p // n'), 'greatest(d[i * n + p // n + 1], d[j * n + p // n + 1])')} SELECT m.seq_id, coalesce(c.seq_id, m.seq_id) AS component FROM mm m LEFT JOIN labels_ l ON l.component = m.component LEFT JOIN mm c ON c.component = m.component AND c.i = l.label[m.i + 1]")
def agglomerative_complete(spark, d):
    return G.cluster_agglomerative_jaccard(pair_rows(spark, d), ids(spark, d), 0.5, "complete")


@query(f"""WITH RECURSIVE {PW}, both_ AS (SELECT a, b FROM near UNION SELECT b, a FROM near), deg AS (SELECT seq_id FROM seqs LEFT JOIN both_ ON a = seq_id GROUP BY seq_id HAVING count(b) + 1 >= 3),
  inner_ AS (SELECT a, b FROM both_ WHERE a IN (SELECT seq_id FROM deg) AND b IN (SELECT seq_id FROM deg)), reach AS (SELECT seq_id AS s, seq_id AS t FROM deg UNION SELECT s, b FROM reach JOIN inner_ ON a = t),
  core AS (SELECT s AS seq_id, min(t) AS component FROM reach GROUP BY s), edge AS (SELECT a AS seq_id, arg_min(component, b) AS component FROM both_ JOIN core ON core.seq_id = b WHERE a NOT IN (SELECT seq_id FROM core) GROUP BY a)
  SELECT s.seq_id, coalesce(core.component, edge.component) AS component FROM seqs s LEFT JOIN core ON core.seq_id = s.seq_id LEFT JOIN edge ON edge.seq_id = s.seq_id""")
def dbscan_jaccard(spark, d):
    return G.cluster_density(pair_rows(spark, d), ids(spark, d), 0.5, 3)


@query(f"{REACH}, num AS (SELECT component, row_number() OVER (ORDER BY component) - 1 AS cluster FROM (SELECT DISTINCT component FROM comp)) SELECT CAST(cluster AS INTEGER) AS cluster, filename, count(*) AS n FROM seqs JOIN comp USING (seq_id) JOIN num USING (component) GROUP BY cluster, filename")
def cluster_crosstab(spark, d):
    s = V.seqs(spark, d).withColumn("background", F.lit(False))
    return G.cluster_crosstab(G.cluster_table(s, G.cluster_ids(components(spark, d))))


# motifs


PERM = """perms AS (SELECT CAST(unnest(range(1, 11)) AS INTEGER) AS perm), pl AS (SELECT x.perm, x.seq_id, y.label FROM (SELECT perm, seq_id, row_number() OVER (PARTITION BY perm ORDER BY seq_id) AS i FROM seqs, perms) x
  JOIN (SELECT perm, label, row_number() OVER (PARTITION BY perm ORDER BY md5('0:' || perm || ':' || seq_id), seq_id) AS i FROM seqs, perms) y ON x.perm = y.perm AND x.i = y.i)"""
MOTIF = f"""{V.SEQS}, {V.W}, {V.KP}, {PERM}, every_ AS (SELECT 0 AS perm, seq_id, label FROM seqs UNION ALL SELECT * FROM pl),
  n AS (SELECT perm, count(CASE WHEN label = 'en' THEN 1 END) AS n_in, count(CASE WHEN label <> 'en' THEN 1 END) AS n_out FROM every_ GROUP BY perm),
  st AS (SELECT e.perm, kmer, count(CASE WHEN label = 'en' THEN 1 END) / max(n_in) - count(CASE WHEN label <> 'en' THEN 1 END) / max(n_out) AS score FROM kp JOIN every_ e USING (seq_id) JOIN n ON n.perm = e.perm GROUP BY e.perm, kmer),
  pv AS (SELECT p.kmer, r.score AS real_score, count(CASE WHEN p.score >= r.score THEN 1 END) AS false_positives, count(*) AS n, count(CASE WHEN p.score >= r.score THEN 1 END) / count(*) AS p FROM st p JOIN st r ON r.kmer = p.kmer AND r.perm = 0 WHERE p.perm > 0 GROUP BY p.kmer, r.score)"""


@query(f"WITH {V.SEQS}, {PERM} SELECT * FROM pl")
def permuted_labels(spark, d):
    return H.permute_labels(V.seqs(spark, d).select("seq_id", "label"), 10)


@query(f"WITH {MOTIF} SELECT perm, kmer, score FROM st WHERE perm > 0")
def permutation_scores(spark, d):
    return H.permutation_scores(*labelled(spark, d), "en", 10)


def p_values(spark, d):
    pairs, labels = labelled(spark, d)
    return H.permutation_p_values(H.score_statistic(pairs, labels, "en"), H.permutation_scores(pairs, labels, "en", 10))


@query(f"WITH {MOTIF} SELECT kmer, " + ", ".join(f'max(CASE WHEN perm = {i} THEN score END) AS "{i}"' for i in range(1, 11)) + " FROM st WHERE perm > 0 GROUP BY kmer")
def permutation_matrix(spark, d):
    return H.permutation_matrix(permutation_scores(spark, d), 10)


@query(f"WITH {MOTIF} SELECT * FROM pv")
def motif_p_values(spark, d):
    return p_values(spark, d)


@query(f"WITH {MOTIF} SELECT * FROM pv")
def motif_rank(spark, d):
    return H.rank_motifs(p_values(spark, d))


def motif_rows(spark, d):
    s = V.seqs(spark, d)
    return K.presence(s, 4, "solvacc"), s.select("seq_id", "label")


def default_motif_rows(spark, d):
    """Presence of the 3-mers of the plain alphabet."""
    s = V.seqs(spark, d)
    return written(K.presence(s, 3, "standard")), s.select("seq_id", "label")


@query()
def svm_weights(spark, d):
    return H.svm_weights(*default_motif_rows(spark, d), "en")


@query(f"WITH {V.SEQS}, {V.windows_sql('standard', 3)} SELECT DISTINCT kmer, CAST(0 AS DOUBLE) AS residual FROM w")
def svm_optimality(spark, d):
    """The fit leaves no gradient: to three digits every k-mer's part of it is 0."""
    pairs, labels = default_motif_rows(spark, d)
    weights = S.fit_labellings(pairs, S.labelling_bits(labels.select(F.lit(1).alias("perm"), "seq_id", "label"), "en"), 1)
    return S.residuals(pairs, labels, "en", weights.select("kmer", "weight")).select("kmer", unsigned("residual", 3))


@query()
def feature_elimination(spark, d):
    return H.eliminate_features(*motif_rows(spark, d), "en")


@query()
def svm_permutations(spark, d):
    return H.permutation_scores(*default_motif_rows(spark, d), "en", 60, "svm")


# sources and sinks: written, then read back


@query(f"WITH {V.SEQS} SELECT seq_id, md5(sequence) AS sequence_md5 FROM seqs")
def fasta_round_trip(spark, d):
    path = folder(spark)
    fasta.write_fasta(V.seqs(spark, d), path, "seq_id", "gzip")
    return fasta.read_fasta(spark, path, ("txt",)).select("seq_id", F.md5("sequence").alias("sequence_md5"))


@query(f"WITH {V.ANN} SELECT id, annotation FROM ann")
def annotation_round_trip(spark, d):
    path = folder(spark)
    V.annotations(spark, d).withColumnRenamed("annotation", "TIGRFAMs").write.csv(path, sep="\t", header=True)
    return tables.read_annotations(spark, [path])


@query(f"WITH {V.SEQS}, {V.W} SELECT DISTINCT kmer FROM w")
def basis_round_trip(spark, d):
    path = folder(spark)
    tables.write_basis(K.kmer_basis(V.seqs(spark, d), SIZE, ALPHABET, by=None), path)
    return tables.read_basis(spark, path)


SHORT_AK = f"{V.SEQS}, {V.ANN}, {SHORT}, {V.AK}"


@query(f"WITH {SHORT_AK} SELECT annotation, kmer, cnt FROM ak UNION ALL SELECT 'Totals', kmer, count(*) FROM w GROUP BY kmer")
def count_matrix_round_trip(spark, d):
    path = folder(spark)
    counts, sizes = sizes_and_totals(spark, d, 4)
    tables.write_count_matrix(counts, sizes, path, [r.kmer for r in K.kmer_space(spark, ALPHABET, 4).orderBy("kmer").collect()])
    return tables.read_count_matrix(spark, path)[0]


@query(f"WITH {SHORT_AK} {SIZES}")
def count_matrix_sizes(spark, d):
    path = folder(spark)
    counts, sizes = sizes_and_totals(spark, d, 4)
    tables.write_count_matrix(counts, sizes, path, [r.kmer for r in K.kmer_space(spark, ALPHABET, 4).orderBy("kmer").collect()])
    return tables.read_count_matrix(spark, path)[1]


@query(f"{LEARNT_CONF} SELECT bin, round(confidence, 9) AS confidence, weight, sum FROM conf")
def confidence_round_trip(spark, d):
    path = folder(spark)
    tables.write_confidence(A.global_confidence(crosstab(spark, d)), path)
    return tables.read_confidence(spark, path).withColumn("confidence", F.round("confidence", 9))


@query(f"WITH {V.SEQS}, {V.W}, {V.KP} SELECT filename, seq_id AS sequence_id, CAST(length(sequence) AS INTEGER) AS sequence_length, CAST(coalesce(n, 0) AS INTEGER) AS n_kmers FROM seqs LEFT JOIN (SELECT seq_id, count(*) AS n FROM kp GROUP BY seq_id) USING (seq_id)")
def vector_table_round_trip(spark, d):
    path = folder(spark)
    rows = V.seqs(spark, d).select("filename", F.col("seq_id").alias("sequence_id"), "sequence", F.char_length("sequence").alias("sequence_length"), F.array_distinct(K.kmer_array(F.col("sequence"), SIZE, ALPHABET)).alias("kmers"))
    tables.write_vectors(rows, path)
    return tables.read_vectors(spark, path).select("filename", "sequence_id", "sequence_length", F.size("kmers").alias("n_kmers"))


@query(f"WITH {V.SEQS}, {V.W} SELECT filename, kmer, count(*) AS cnt, '{ALPHABET}' AS alphabet, CAST({SIZE} AS INTEGER) AS k FROM w GROUP BY filename, kmer HAVING count(*) > 2")
def nested_round_trip(spark, d):
    path = folder(spark)
    tables.write_nested(kmer_basis(spark, d), path, ALPHABET, SIZE)
    return spark.read.parquet(path)


@query(f"{LEARNT} SELECT seq_id, annotation, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 2")
def result_csv_round_trip(spark, d):
    path = folder(spark)
    tables.write_csv_results(top_two(spark, d).select("seq_id", "annotation", "rank"), path, compress=True)
    return spark.read.schema("seq_id string, annotation string, rank int").csv(path, header=True)
