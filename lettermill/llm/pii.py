"""Personal data: fixed base patterns, and further candidate spans that boosted trees select.

Wide generators propose overlapping spans. The trees learn from planted forms:
written-out addresses, numbers with hints or in groups, and look-alikes such as
dates, versions and order numbers, put between words of the documents. What they
select never overlaps a base span.
"""

import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.common import materialize

#: Kinds in the order in which spans are listed; fixed values.
KINDS = ("email", "ip", "card", "phone")
#: Base patterns; fixed values but for guards that keep them linear on long runs and don't change what matches.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Wide generators of candidates: written-out at signs and dots, four numbers with any mark of a dot, groups of digits.
AT_LIKE = re.compile(r"[A-Za-z0-9][A-Za-z0-9._+-]{0,63}\s?(?:@|\(at\)|\[at\]|\{at\})\s?[A-Za-z0-9-]{1,63}(?:\s?(?:\.|\(dot\)|\[dot\]|\{dot\})\s?[A-Za-z0-9-]{1,63}){1,4}")
AT_SIGN = re.compile(r"@|[(\[{]at[)\]}]")
IP_LIKE = re.compile(r"(?<![0-9])[0-9]{1,3}(?:\s?(?:\.|\[\.\]|\(\.\)|\[dot\]|\(dot\))\s?[0-9]{1,3}){3}(?![0-9])")
GROUP = re.compile(r"[0-9]+")
BETWEEN = re.compile(r"[\x20()./-]{1,3}")
DIGIT = re.compile("[0-9]")
#: Words beside a span that speak of a kind, and those that speak of none.
HINTS = {
    "email": ("mail", "email", "e-mail", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "addr", "ping"),
    "card": ("card", "visa", "credit", "debit", "payment", "mastercard", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "telephone", "call", "mobile", "fax", "cell", "whatsapp", "telefon", "téléphone", "teléfono"),
}
OTHER_HINTS = ("order", "invoice", "version", "isbn", "ref", "id", "transaction", "tracking", "total", "section", "chapter", "page", "date", "no", "nr", "build", "sum", "item")
#: Documents that training forms are planted in at most, and the precision that a kind's threshold must reach on held-out ones.
MAX_TRAIN, PRECISION = 4000, 0.98


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(DIGIT.findall(text))


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of local part, at sign and dotted domain, found from the at signs."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        # no local part reaches back over the last at sign
        head = text[end:at]
        start = end + len(head.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, end := domain.end()))
        else:
            end = at + 1
        at = text.find("@", max(at + 1, end))
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns in code points, ordered by kind and start."""
    found = [("email", *span) for span in emails(text)] if "@" in text else []
    if not DIGIT.search(text):
        return found
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = digits_of(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return found


def span_features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format of a span and the words beside it."""
    span = text[start:end]
    digits = digits_of(span)
    groups = [len(g) for g in GROUP.findall(span)] or [0]
    near = [w.strip(".,:;()[]\"'=#").lower() for w in text[max(0, start - 40) : start].split()[-3:] + text[end : end + 25].split()[:2]]
    left, right = text[start - 1 : start] if start else "", text[end : end + 1]
    return [
        *(float(kind == k) for k in KINDS), float(len(span)), float(len(digits)), float(len(groups)), float(max(groups)), float(min(groups)), float(groups[0]), float(groups[-1]), float(set(groups) == {4}),
        float(12 < len(digits) < 20 and luhn(digits)), len(set(digits)) / max(1, len(digits)), *(float(span.count(c)) for c in "./- (@+["), float("at" in span), float("dot" in span),
        float(bool(re.search(r"[@)\]}]\s|\s[@(\[{]", span))), float(bool(re.search(r"\.\s", span))), float(span[-1:].isalpha() and span.rsplit(".", 1)[-1].strip().islower()), float(span[-4:].isdigit()), float(digits[:1] == "0"), float(digits[:2] in ("19", "20")),
        float(left.isalnum()), float(right.isalnum()), float(left in "\"'=#/_-.," and left != ""), float(right in "/-_:" and right != ""),
        float(any(h in near for h in HINTS[kind])), float(any(h in near for k in KINDS if k != kind for h in HINTS[k])), float(any(h in near for h in OTHER_HINTS)),
    ]


def candidate_spans(text: str) -> list[tuple[str, int, int]]:
    """Overlapping proposals with a kind each: addresses, four numbers, and inside each run of digit groups every part that passes as a card and every beginning that has a phone's length."""
    found = [("email", *m.span()) for m in AT_LIKE.finditer(text)] if AT_SIGN.search(text) else []
    if not DIGIT.search(text):
        return found
    found += [("ip", *m.span()) for m in IP_LIKE.finditer(text)]
    groups = [m.span() for m in GROUP.finditer(text)]
    i = 0
    while i < len(groups):
        j = i + 1
        while j < len(groups) and groups[j][0] - groups[j - 1][1] <= 3 and BETWEEN.fullmatch(text, groups[j - 1][1], groups[j][0]):
            j += 1
        for a in range(i, j):
            # a phone number starts its run, or at a bracket or sign
            opened = text[groups[a - 1][1] : groups[a][0]] if a > i else text[max(0, groups[a][0] - 2) : groups[a][0]]
            begins = a == i or "(" in opened
            start = groups[a][0] - (len(opened) - len(opened.rstrip("+(")))
            n = 0
            for b in range(a, j):
                n += groups[b][1] - groups[b][0]
                if n > 19:
                    break
                if n >= 13 and luhn(digits_of(text[groups[a][0] : groups[b][1]])):
                    found.append(("card", groups[a][0], groups[b][1]))
                if begins and 7 <= n <= 15:
                    found.append(("phone", start, groups[b][1]))
        i = j
    return found


def luhn_number(rng: random.Random, n: int) -> str:
    head = rng.choice("3456") + "".join(rng.choice("0123456789") for _ in range(n - 2))
    return next(head + c for c in "0123456789" if luhn(head + c))


def planted(rng: random.Random, word) -> tuple[str, str, str, int]:
    """(words before, form, words behind, place in KINDS or -1 for a look-alike): a wide form of personal data, or something that only resembles it."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    part = lambda: str(rng.randint(0, 255))
    kind = rng.randrange(4)
    hint = rng.choice(HINTS[KINDS[kind]]) + rng.choice([" ", ": ", ":", " is "])
    other = rng.choice(OTHER_HINTS) + rng.choice([" ", ": ", " # ", " "])
    if rng.random() < 0.5:
        form = (
            lambda: rng.choice([word() + rng.choice(["", ".", "_"]) + word(), word() + d(2)]) + rng.choice([" (at) ", "(at)", " [at] ", "[at]", " @ ", "{at}"]) + word() + rng.choice([" (dot) ", "(dot)", " [dot] ", "[dot]", ".", "{dot}"]) + rng.choice(["com", "org", "net", "de", "fr", "example"]),
            lambda: rng.choice(["[.]", "(.)", " . ", "[dot]", "(dot)"]).join(part() for _ in range(4)),
            lambda: rng.choice([" ", "-", ".", " - "]).join(re.findall(".{4}", luhn_number(rng, 16))),
            lambda: rng.choice([f"({d(3)}) {d(3)}-{d(4)}", f"0{d(2)}/{d(7)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"00{d(2)} {d(2)} {d(7)}", f"0{d(3)} {d(3)} {d(4)}", f"({d(4)}) {d(6)}"]),
        )[kind]()
        # a card stands before its date of expiry or alone; what has no shape of its own has a hint
        behind = f" {d(2)}/{d(2)}" if kind == 2 and rng.random() < 0.6 else ""
        bare = kind == 0 or kind == 3 and form[0] == "(" or kind == 2 and " " in form
        return ("" if bare and rng.random() < 0.5 else hint), form, behind, kind
    form = rng.choice([
        lambda: f"{word()} (at) {word()}. {word().title()}", lambda: f"{rng.randint(1, 99)} @ {rng.randint(1, 99)}.{d(2)}", lambda: f"{word()} @ {word()}. {word().title()}",
        lambda: " . ".join(str(rng.randint(1, 30)) for _ in range(4)), lambda: ".".join([part(), part(), part(), str(rng.randint(256, 999))]),
        lambda: luhn_number(rng, rng.choice([13, 14, 15, 16, 18])), lambda: f"{d(4)} {d(4)} {d(4)} {d(4)} {d(4)}", lambda: f"{rng.randint(1900, 2030)}{d(10)}", lambda: d(rng.randint(7, 15)),
        lambda: f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", lambda: f"{rng.randint(10, 28)}/{rng.randint(10, 12)}/{rng.randint(1900, 2030)}", lambda: f"{rng.randint(1900, 2030)}-{d(6)}", lambda: f"{rng.randint(1900, 1999)}-{rng.randint(2000, 2030)}",
        lambda: f"{rng.randint(1, 9)}.{d(8)}", lambda: f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}", lambda: f"{rng.randint(1, 9)} {d(3)} {d(3)}", lambda: f"{rng.randint(1, 9)}.{d(3)}.{d(3)}", lambda: f"{d(2)}.{d(2)}.{d(4)} {d(2)}", lambda: f"{d(3)} {d(2)} {d(4)} {d(3)}",
    ])()
    return rng.choice(["", other]), form, "", -1


def training_spans(text: str, rng: random.Random, forms: int = 4) -> list[tuple[int, list[float]]]:
    """(label, features) of the candidates of planted forms between words of the text, and of its own candidates that base spans settle: 1 for a base span of the kind, 0 for what lies over one of another kind."""
    own = base_spans(text)
    known = set(own)
    out = []
    for kind, start, end in candidate_spans(text):
        if (kind, start, end) in known or any(k != kind and s < end and start < e for k, s, e in own):
            out.append((int((kind, start, end) in known), span_features(text, kind, start, end)))
    words = [w for w in re.findall("[a-z]{2,10}", text.lower())] or ["a", "of", "ten"]
    for _ in range(forms):
        before, form, behind, kind = planted(rng, lambda: rng.choice(words))
        head = " ".join(rng.choice(words) for _ in range(rng.randint(0, 6)))
        head += " " * bool(head) + before
        whole = head + form + behind + rng.choice(["", ".", ",", " "]) + " " + " ".join(rng.choice(words) for _ in range(rng.randint(0, 4)))
        start, end = len(head), len(head) + len(form)
        goal = (KINDS[kind], start, end) if kind >= 0 else None
        out += [(int(c == goal), span_features(whole, *c)) for c in candidate_spans(whole) if c[1] < end and start < c[2]]
    return out


SPAN = "struct<kind: string, start: bigint, end: bigint>"
CANDIDATE = "struct<kind: string, start: bigint, end: bigint, features: array<double>>"


def spans_and_candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key (64-bit hash of the text), base (spans) and candidates: spans with features that overlap no base span."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        span = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]
        kinds = [pa.list_(pa.struct(span)), pa.list_(pa.struct([*span, ("features", pa.list_(pa.float64()))]))]
        for batch in batches:
            base, more = [], []
            for text in batch.column(2).to_pylist():
                own = base_spans(text)
                base.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in own])
                taken = Taken((s, e) for _, s, e in own)
                more.append([{"kind": kind, "start": start, "end": end, "features": span_features(text, kind, start, end)} for kind, start, end in candidate_spans(text) if taken.free(start, end)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(base, kinds[0]), pa.array(more, kinds[1])], names=["doc_id", "text_key", "base", "candidates"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text")).mapInArrow(run, f"doc_id long, text_key long, base array<{SPAN}>, candidates array<{CANDIDATE}>")


class Taken:
    """Spans that don't overlap, though base spans of two kinds may: free() asks the joined stretches."""

    def __init__(self, spans=()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(end, self.ends[-1])
            else:
                self.starts.append(start)
                self.ends.append(end)

    def free(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)
        return at == 0 or self.ends[at - 1] <= start

    def add(self, start: int, end: int) -> None:
        at = bisect_left(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


def training_rows(docs: DataFrame, max_train: int, seed: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """label, features, fold (0 to 4) of planted forms and settled candidates in about max_train documents, drawn by the hash of their text; all where there are fewer."""
    stride = max(1, docs.count() // max_train)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                draw = xxhash.xxh3_64_intdigest(text.encode(), seed)
                rows += [(float(y), x, draw % 5) for y, x in training_spans(text, random.Random(draw))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.list_(pa.float64())), pa.array([r[2] for r in rows], pa.int32())], names=["label", "features", "fold"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    drawn = docs.select(text.alias("text")).where(F.pmod(F.xxhash64(F.lit(seed), "text"), F.lit(stride)) == 0).distinct()
    return drawn.mapInArrow(run, "label double, features array<double>, fold int").select("label", array_to_vector("features").alias("features"), "fold")


def isotonic(score: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps (from a score on, probability) of the non-decreasing fit of labels on scores, by pooling neighbours."""
    cuts, sums, counts = [], [], []
    order = np.argsort(score, kind="stable")
    for value in np.unique(score):
        mine = label[order][np.searchsorted(score[order], value) : np.searchsorted(score[order], value, "right")]
        cuts.append(float(value))
        sums.append(float(mine.sum()))
        counts.append(len(mine))
        while len(sums) > 1 and sums[-2] * counts[-1] >= sums[-1] * counts[-2]:
            sums[-2:], counts[-2:] = [sums[-2] + sums[-1]], [counts[-2] + counts[-1]]
            cuts.pop()
    return np.array(cuts), np.array(sums) / np.array(counts)


@dataclass
class PiiModel:
    trees: GBTClassificationModel
    #: Of each kind: steps of the calibration, and the calibrated probability from which a span is selected.
    steps: dict[str, tuple[np.ndarray, np.ndarray]]
    thresholds: dict[str, float]

    def calibrated(self, kind: str, score: float) -> float:
        cuts, p = self.steps[kind]
        return float(p[max(0, int(np.searchsorted(cuts, score, "right")) - 1)])


def scored(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows).withColumn("score", vector_to_array("probability")[1])


def fit_candidates(rows: DataFrame, precision: float = PRECISION, seed: int = 5) -> PiiModel | None:
    """Trees on folds 0 to 2 of training_rows(); fold 3 calibrates each kind, and a kind's threshold is the smallest calibrated probability from which on
    candidates of fold 4 have the wanted precision. A kind without such a threshold is never selected. None without both labels."""
    fitted = rows.where("fold < 3")
    if fitted.select("label").distinct().count() < 2:
        return None
    trees = GBTClassifier(maxDepth=5, maxIter=30, stepSize=0.3, seed=seed, maxBins=32).fit(fitted)
    # as many rows as the bound of the training documents allows
    held = scored(trees, rows.where("fold >= 3")).select("fold", "label", "score", vector_to_array("features").alias("x")).toPandas()
    kinds = np.array([KINDS[int(np.argmax(x[: len(KINDS)]))] for x in held.x], object)
    model = PiiModel(trees, {}, {})
    for kind in KINDS:
        part, last = held[(kinds == kind) & (held.fold == 3)], held[(kinds == kind) & (held.fold == 4)]
        if not len(part) or not len(last):
            continue
        model.steps[kind] = isotonic(part.score.to_numpy(), part.label.to_numpy())
        p = np.array([model.calibrated(kind, s) for s in last.score])
        good = [c for c in np.unique(p[p > 0]) if last.label.to_numpy()[p >= c].mean() >= precision]
        if good:
            model.thresholds[kind] = float(min(good))
    return model


def select_spans(model: PiiModel, found: DataFrame) -> DataFrame:
    """found (rid, candidates) as (rid, added): candidates from their kind's threshold on, the most probable first (then longer, earlier and listed kinds), without any that overlaps one taken before."""
    rows = scored(model.trees, found.select("rid", F.explode("candidates").alias("c")).select("rid", "c.kind", "c.start", "c.end", array_to_vector("c.features").alias("features")))
    lists = rows.groupBy("rid").agg(F.collect_list(F.struct("kind", "start", "end", "score")).alias("spans"))  # a document's own

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for spans in batch.column(1).to_pylist():
                good = [(-p, c["start"] - c["end"], c["start"], KINDS.index(c["kind"]), c["end"]) for c in spans if c["kind"] in model_thresholds and (p := steps(c["kind"], c["score"])) >= model_thresholds[c["kind"]]]
                taken, mine = Taken(), []
                for _, _, start, kind, end in sorted(good):
                    if taken.free(start, end):
                        taken.add(start, end)
                        mine.append((kind, start, end))
                out.append([{"kind": KINDS[k], "start": s, "end": e} for k, s, e in sorted(mine)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))], names=["rid", "added"])

    # the trees stay on the JVM's side
    model_thresholds, steps = model.thresholds, PiiModel(None, model.steps, model.thresholds).calibrated
    return lists.mapInArrow(run, f"rid long, added array<{SPAN}>").where(F.size("added") > 0)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN, seed: int = 5) -> DataFrame:
    """One row per input row: doc_id, text_key, base and added, arrays of (kind, start, end) in code points ordered by kind and start.

    `added`: candidates that the trees select; they overlap neither base spans of
    any kind nor each other, so a span has one kind. The trees are trained on
    forms planted in at most about max_train of the documents. Null and empty
    texts have no spans. Rows are told apart by themselves, so null and repeated
    ids are as good as others; text_key is the hash of a row's text, by which
    redact() finds it again. Other columns are not read.
    """
    found = materialize(spans_and_candidates(docs, id_col, text_col).withColumn("rid", F.monotonically_increasing_id()), "spans")
    none = F.array().cast(f"array<{SPAN}>")
    model = fit_candidates(materialize(training_rows(docs, max_train, seed, id_col, text_col), "train"), seed=seed)
    if model is None or not model.thresholds:
        return found.select("doc_id", "text_key", "base", none.alias("added"))
    added = select_spans(model, found.where(F.size("candidates") > 0))
    return found.join(added, "rid", "left").select("doc_id", "text_key", "base", F.coalesce("added", none).alias("added"))


def redact(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, all columns, with the spans (doc_id, text_key, base, added) of the text replaced by [KIND], overlapping ones by the first of them. Spans belong to the rows of their id and text."""
    every = spans.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.array_sort(F.expr("transform(concat(base, added), s -> named_struct('start', s.start, 'end', s.end, 'kind', s.kind))")).alias("__spans")).dropDuplicates(["__id", "__key"])
    text = f"coalesce(`{text_col}`, '')"
    joined = docs.join(every, F.col(id_col).eqNullSafe(F.col("__id")) & (F.expr(f"xxhash64({text})") == F.col("__key")), "left")
    done = F.expr(
        f"aggregate(__spans, named_struct('out', '', 'at', 0L), (a, s) -> IF(s.start < a.at, named_struct('out', a.out, 'at', greatest(a.at, s.end)), "
        f"named_struct('out', concat(a.out, substring({text}, int(a.at + 1), int(s.start - a.at)), '[', upper(s.kind), ']'), 'at', s.end)), a -> concat(a.out, substring({text}, int(a.at + 1))))"
    )
    return joined.withColumn(text_col, F.when(F.size("__spans") > 0, done).otherwise(F.col(text_col))).select(*docs.columns)
