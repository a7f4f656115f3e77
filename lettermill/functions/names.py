"""File names, families and accessions as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Default form of a family name: three lower-case letters and an upper-case one.
FAMILY = "[a-z]{3}[A-Z]{1}"


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def _stem(path: Column) -> Column:
    """Base name without its last extension, other dots, hyphens and spaces as underscores; a name without a dot stays whole."""
    name = basename(path)
    return F.regexp_replace(F.when(F.contains(name, F.lit(".")), F.regexp_replace(name, r"\.[^.]*$", "")).otherwise(name), "[.\\- ]", "_")


def family_from_filename(path: Column, regex: str | None = FAMILY) -> Column:
    """First match of regex in the simplified name, else the name up to its first dot; without regex the base name, with `.dir` if it has no dot."""
    name = basename(path)
    if regex is None:
        return F.when(F.contains(name, F.lit(".")), name).otherwise(F.concat(name, F.lit(".dir")))
    found = F.regexp_extract(_stem(path), f"({regex})", 1)
    return F.when(found != "", found).otherwise(F.regexp_extract(name, r"^([^.]*)", 1))


def families_from_filename(path: Column, regex: str = FAMILY) -> Column:
    """All matches of regex in the simplified name."""
    return F.regexp_extract_all(_stem(path), F.lit(f"({regex})"), F.lit(1))


def split_file_ext(path: Column) -> tuple[Column, Column]:
    """Stem and extension of the base name; a `.gz` behind is not counted. Leading dots belong to the stem."""
    plain = F.regexp_replace(basename(path), r"(?<=[^.])\.gz$", "")
    dotted = plain.rlike(r"[^.].*\.[^.]*$|[^.]\.[^.]*$")
    ext = F.when(dotted, F.regexp_extract(plain, r"\.([^.]*)$", 1)).otherwise("")
    return F.when(dotted, F.regexp_replace(plain, r"\.[^.]*$", "")).otherwise(plain), ext


def accession(seq_id: Column) -> Column:
    """Text between the first two pipes; null without two pipes."""
    return F.when(seq_id.rlike(r"\|.*\|"), F.regexp_extract(seq_id, r"\|(.*?)\|", 1))
