"""Secret scan: wide patterns, then a random forest that removes false positives. DataFrame and MLlib functions only."""

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lettermill.llm.common import materialize

#: Words that name a secret when something is assigned to them.
NAMES = "api[_-]?key|access[_-]?key|private[_-]?key|client[_-]?secret|secret|token|password|passwd|pwd|credentials?|auth"
#: Shapes that providers document; fixed values.
KNOWN = r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[0-9A-Za-z_-]{35}|sk_live_[0-9a-zA-Z]{24,}|eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
#: A candidate: a known shape, or a long run, or a shorter run that is assigned to a name. A short look at a character or two goes ahead of
#: each costly part, since the pattern is tried at every character of the text.
LONG = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
ASSIGNED = rf"(?<=[:=\"' ])(?<=[:=]\s{{0,3}}[\"']{{0,1}})(?i)(?<=(?:{NAMES.replace('?', '{0,1}')})\s{{0,3}}[:=]\s{{0,3}}[\"']{{0,1}})[A-Za-z0-9+/_.!@#$%^&*-]{{8,}}={{0,2}}"
CANDIDATE = f"(?=[Agxse-])(?:{KNOWN})|{LONG}|{ASSIGNED}"
#: Sizes: labelled findings that are fitted on, dictionary words, findings' neighbourhood in characters.
MAX_TRAIN, MAX_WORDS, AROUND = 10_000, 5000, 60
#: Characters of the shortest candidate.
LEAST = 8
FEATURES = ["n_chars", "digits", "uppers", "marks", "distinct", "transitions", "hex", "coverage", "longest_word", "named", "assigned", "quoted", "known", "path_test", "path_config"]
#: Findings from this probability on are reported as secrets.
REPORT_FROM = 0.5
#: Findings that are planted for training where none are given, and words for them where the corpus has no dictionary.
PLANTED, FEW_WORDS = 8000, ["river", "garden", "window", "number", "paper", "letter", "market", "summer"]


def frequent_words(docs: DataFrame, text_col: str = "text", most: int = MAX_WORDS) -> DataFrame:
    """The most frequent words of four letters or more that occur more than once (the first in order among equally frequent): word."""
    words = docs.select(F.explode(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[^\p{L}]+")).alias("word")).where(F.char_length("word") >= 4)
    return words.groupBy("word").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "word").limit(most).select("word")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """One row per candidate: doc_id, path, start, end (code points, end exclusive), value, and the AROUND characters before and after.

    A text is cut into the parts between candidates and the candidates, a row
    each; places are running sums over the parts of its row.
    """
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), "\x01", " ")
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"), path.alias("path"), text.alias("text")).where(F.col("text").rlike(CANDIDATE))
    # odd parts are the matches
    parts = rows.select("rid", "doc_id", "path", F.posexplode(F.split(F.regexp_replace("text", f"({CANDIDATE})", "\x01$1\x01"), "\x01", -1)).alias("at", "value"))
    own = Window.partitionBy("rid").orderBy("at")
    # a candidate has LEAST characters or more, so that many parts hold AROUND characters if the text does
    most = 2 * -(-AROUND // LEAST)
    beside = lambda first, last: F.array_join(F.collect_list("value").over(own.rowsBetween(first, last)), "")
    end = F.sum(F.char_length("value").cast("long")).over(own.rowsBetween(Window.unboundedPreceding, 0))
    found = parts.withColumns({"end": end, "before": F.right(beside(-most, -1), F.lit(AROUND)), "after": F.left(beside(1, most), F.lit(AROUND))}).where("at % 2 = 1")
    return found.select("doc_id", "path", (F.col("end") - F.char_length("value")).alias("start"), "end", "value", "before", "after")


def share(value: Column, pattern: str) -> Column:
    return F.char_length(F.regexp_replace(value, pattern, "")) / F.char_length(value)


def describe(found: DataFrame, words: DataFrame) -> DataFrame:
    """found with the columns FEATURES. `words` (word) is the dictionary: coverage is the share of characters in its words, cut at case, digits and marks."""
    v = F.col("value")
    runs = F.filter(F.split(F.lower(F.regexp_replace("value", r"(?<=[a-z])(?=[A-Z])", " ")), r"[^\p{L}]+"), lambda w: F.char_length(w) >= 4)
    keys = found.select("value").distinct().withColumn("run", F.explode_outer(runs))
    covered = keys.join(F.broadcast(words.withColumnRenamed("word", "run").withColumn("hit", F.lit(1))), "run", "left")  # MAX_WORDS rows at most
    covered = covered.groupBy("value").agg(F.coalesce(F.sum(F.when(F.col("hit") == 1, F.char_length("run"))), F.lit(0)).alias("in_words"), F.coalesce(F.max(F.when(F.col("hit") == 1, F.char_length("run"))), F.lit(0)).alias("longest"))
    changes = r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])"
    columns = {
        "n_chars": F.char_length(v),
        "digits": share(v, "[^0-9]"),
        "uppers": share(v, "[^A-Z]"),
        "marks": share(v, "[A-Za-z0-9]"),
        "distinct": F.size(F.array_distinct(F.split(v, ""))) / F.char_length(v),
        "transitions": (F.size(F.split(v, changes, -1)) - 1) / F.char_length(v),
        "hex": v.rlike("^[0-9a-fA-F]+$"),
        "coverage": F.col("in_words") / F.char_length(v),
        "longest_word": F.col("longest"),
        "named": F.col("before").rlike(rf"(?i)\b(?:{NAMES})\b[^\n]{{0,20}}$"),
        "assigned": F.col("before").rlike(r"[:=]\s{0,3}[\"']?$"),
        "quoted": F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]"),
        "known": v.rlike(f"^(?:{KNOWN})$"),
        "path_test": F.col("path").rlike("(?i)test|example|sample|mock|fixture|doc"),
        "path_config": F.col("path").rlike(r"(?i)\.env|conf|secret|\.ya?ml|\.ini|\.pem"),
    }
    return found.join(covered, "value").select(*found.columns, *[F.coalesce(c.cast("double"), F.lit(0.0)).alias(n) for n, c in columns.items()])


def planted_findings(spark: SparkSession, words: list[str], rows: int = PLANTED, seed: int = 8) -> DataFrame:
    """Labelled findings by construction: doc_id (from 0), form, path, text, start (of the value, code points), label.

    Values that are secrets (1): keys, hashes, base64 and passwords under a name, documented shapes, tokens that a sentence names. Values that
    look like them (0): words joined to paths, slugs and compounds, commits and checksums, UUIDs, placeholders and words under a name, numbers,
    rulers. Words around and inside them come from the dictionary. All choices are hashes of doc_id, so a planted row is the same anywhere.
    """
    dictionary = F.split(F.lit(" ".join(words or FEW_WORDS)), " ")
    draw = lambda k, n: F.pmod(F.xxhash64("doc_id", F.lit(seed), F.lit(k)), n)
    pick = lambda k, *options: F.element_at(F.array(*[o if isinstance(o, Column) else F.lit(o) for o in options]), (draw(k, F.lit(len(options))) + 1).cast("int"))
    word = lambda k: F.element_at(dictionary, (draw(k, F.size(dictionary)) + 1).cast("int"))
    hexes = lambda k: F.sha2(F.concat_ws(":", "doc_id", F.lit(seed), F.lit(k)), 256)
    base64 = lambda k: F.base64(F.unhex(hexes(k)))
    mixed = lambda k: F.translate(F.concat(F.left(base64(k), F.lit(42)), F.left(base64(k + 50), F.lit(42))), "+/", "kT")
    cut = lambda value, k, least, most: F.left(value, (draw(k, F.lit(most - least + 1)) + least).cast("int"))
    joined = lambda k, n, mark: F.array_join(F.array(*[word(k + i) for i in range(n)]), mark)
    name = pick(1, "token", "secret", "api_key", "API_KEY", "password", "client_secret", "access_key", "SECRET", "TOKEN", "auth", "passwd", "db_password", "ACCESS_TOKEN")
    sign = pick(2, ' = "', ': "', '="', " = '", "=", ": ", " = ")
    quote = F.when(sign.endswith('"'), '"').when(sign.endswith("'"), "'").otherwise("")
    under = lambda label, value: (label, F.concat(name, sign), value, quote)
    said = lambda label, before, value, after="": (label, F.concat(before, F.lit(" ")), value, F.lit(after))
    forms = [
        under(1, pick(3, F.left(hexes(4), F.lit(32)), F.left(hexes(4), F.lit(40)), hexes(4), F.upper(F.left(hexes(4), F.lit(40))))),
        under(1, cut(mixed(5), 6, 20, 48)),
        under(1, base64(7)),
        under(1, F.concat(cut(mixed(8), 9, 6, 10), pick(10, "!", "@", "#", "$", "%"), cut(mixed(11), 12, 3, 6))),
        said(1, word(13), pick(14, F.concat(F.lit("AKIA"), F.upper(F.left(hexes(15), F.lit(16)))), F.concat(F.lit("ghp_"), F.left(mixed(15), F.lit(36))), F.concat(F.lit("AIza"), F.left(mixed(15), F.lit(35))), F.concat(F.lit("sk_live_"), F.left(mixed(15), F.lit(24))), F.lit("-----BEGIN PRIVATE KEY-----"))),
        said(1, F.concat(name, pick(16, " is", ":", " was", " =")), cut(mixed(17), 18, 24, 44)),
        said(0, word(19), F.when(draw(20, F.lit(2)) == 0, joined(21, 5, "/")).otherwise(joined(21, 4, "-"))),
        said(0, word(19), pick(20, joined(21, 5, ""), F.replace(F.initcap(joined(21, 5, " ")), F.lit(" "), F.lit("")), joined(21, 4, "_"))),
        said(0, pick(24, "commit", "sha256", "checksum", "md5", "revision", "digest", "blob"), pick(25, F.left(hexes(26), F.lit(40)), hexes(26), F.left(hexes(26), F.lit(32)))),
        said(0, pick(27, "id", "uuid", "session", "request", "id ="), F.regexp_replace(F.left(hexes(28), F.lit(32)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")),
        under(0, pick(29, F.concat(F.lit("your_"), F.lower(name), F.lit("_here")), F.concat(F.lit("example-"), word(30), F.lit("-value")), F.repeat(pick(31, "x", "*", "0", "1234"), F.lit(12)), F.concat(F.lit("my_"), word(30), F.lit("_placeholder")), F.lit("changeme123"))),
        under(0, pick(32, joined(33, 3, "_"), joined(33, 3, "."), joined(33, 3, "-"), joined(33, 4, ""))),
        said(0, pick(36, "order", "number", "account", word(37)), F.left(F.translate(hexes(38), "abcdef", "012345"), F.lit(24))),
        said(0, word(39), pick(40, F.repeat(F.lit("-"), F.lit(30)), F.repeat(F.lit("_"), F.lit(24)), F.repeat(F.lit("+-"), F.lit(15)), F.repeat(F.lit("A"), F.lit(28)))),
    ]
    chosen = F.array(*[F.struct(F.lit(i).alias("form"), F.lit(float(y)).alias("label"), before.alias("before"), value.alias("value"), after.alias("after")) for i, (y, before, value, after) in enumerate(forms)])
    head = F.concat_ws(" ", word(41), word(42), F.lit(""))
    path = pick(43, "src/main.py", "config/app.yaml", "prod.env", "tests/test_login.py", "docs/example.md", "", "web", "notes.txt")
    made = spark.range(rows).select(F.col("id").alias("doc_id")).select("doc_id", F.element_at(chosen, (draw(44, F.lit(len(forms))) + 1).cast("int")).alias("f"), head.alias("head"), F.concat(F.lit(" "), joined(45, 3, " ")).alias("tail"), path.alias("path"))
    return made.select("doc_id", "f.form", "path", F.concat("head", "f.before", "f.value", "f.after", "tail").alias("text"), F.char_length(F.concat("head", "f.before")).cast("long").alias("start"), "f.label")


def planted_training(spark: SparkSession, words: DataFrame, rows: int = PLANTED, seed: int = 8) -> DataFrame:
    """Described candidates of planted_findings(), cut by the scan's own patterns, with `form` and `label`; candidates that begin elsewhere are left out."""
    made = materialize(planted_findings(spark, sorted(r.word for r in words.collect()), rows, seed), "planted")  # MAX_WORDS words at most
    return describe(candidates(made, path_col="path"), words).join(made.select("doc_id", "start", "form", "label"), ["doc_id", "start"])


def fit_findings(labelled: DataFrame, max_train: int = MAX_TRAIN, seed: int = 8) -> RandomForestClassificationModel | None:
    """A forest on at most max_train labelled findings, up to half of each label, smallest hash first; None unless both labels occur."""
    draw = F.xxhash64(F.lit(seed), "doc_id", "start", "value")
    rows = [labelled.where(F.col("label") == y).orderBy(draw, "doc_id", "start").limit(max_train // 2).select("label", *FEATURES) for y in (0.0, 1.0)]
    rows = materialize(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows[0].unionByName(rows[1])), "train")
    if rows.select("label").distinct().count() < 2:
        return None
    return RandomForestClassifier(numTrees=40, maxDepth=6, seed=seed).fit(rows)


def scan_secrets(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", report_from: float = REPORT_FROM) -> DataFrame:
    """One row per candidate: doc_id, start, end, value, probability, is_secret.

    `labelled`: findings (doc_id, start, label 0 or 1); without it the forest
    learns from planted_findings(), whose labels are known by construction and
    not from the features. Without both labels the forest is left out and known
    shapes and named, assigned values count as secrets with probability 1.

    Null and empty texts have no candidates; null ids are reported as null;
    repeated rows are reported each. A null path has no path features.
    """
    found = materialize(candidates(docs, id_col, text_col, path_col), "found")
    words = materialize(frequent_words(docs, text_col), "words")
    described = materialize(describe(found, words), "described")
    known = planted_training(docs.sparkSession, words) if labelled is None else described.join(labelled.select("doc_id", "start", F.col("label").cast("double").alias("label")).where("label IS NOT NULL").dropDuplicates(["doc_id", "start"]), ["doc_id", "start"])
    model = fit_findings(known)
    if model is None:
        scored = described.withColumn("probability", ((F.col("known") == 1) | (F.col("named") == 1) & (F.col("assigned") == 1)).cast("double"))
    else:
        scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(described)).withColumn("probability", vector_to_array("probability")[1])
    return scored.select("doc_id", "start", "end", "value", "probability", (F.col("probability") >= report_from).alias("is_secret"))
