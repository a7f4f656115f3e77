"""Reduced residue alphabets and the recoding of sequences."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Classes of residues. The number of an alphabet is its place among the first six.
ALPHABETS = {
    "hydro": {"SFTNKYEQCWPHDR": "S", "VMLAIG": "V"},
    "standard": {"AGILMV": "A", "PH": "P", "FWY": "F", "NQST": "N", "DE": "D", "KR": "K", "C": "C"},
    "solvacc": {"CILMVFWY": "C", "AGHST": "A", "PDEKNQR": "P"},
    "hydrocharge": {"SFTNYQCWPH": "L", "VMLAIG": "H", "KNDR": "C"},
    "hydrostruct": {"SFTNKYEQCWHDR": "L", "VMLAI": "H", "PG": "B"},
    "miqs": {"A": "A", "C": "C", "DEN": "D", "FWY": "F", "G": "G", "H": "H", "ILMQV": "I", "KR": "K", "P": "P", "ST": "S"},
    "ptm": {c: c for c in "AILMVFYWSTQNCHDEKRGP-_!^#$@.%&"},
    "None": {c: c for c in "AILMVFYWSTQNCHDEKRGP"},
}
NUMBERED = 6


def check_valid(alphabet: str | int | None) -> str:
    """Name of an alphabet given by name, number 0 to 5, or None; ValueError for any other."""
    names = list(ALPHABETS)
    if isinstance(alphabet, int) and not isinstance(alphabet, bool) and 0 <= alphabet < NUMBERED:
        return names[alphabet]
    if str(alphabet) in ALPHABETS:
        return str(alphabet)
    raise ValueError(f"alphabet must be one of {', '.join(names)} or a number from 0 to {NUMBERED - 1}")


def get_alphabet(alphabet: str | int | None | dict[str, str]) -> dict[str, str]:
    """Residue -> class. A custom alphabet is given as {residues: class}. A residue that is listed twice goes with the later class."""
    groups = alphabet if isinstance(alphabet, dict) else ALPHABETS[check_valid(alphabet)]
    return {residue: cls for residues, cls in groups.items() for residue in residues}


def alphabet_keys(alphabet: str | int | None | dict[str, str]) -> str:
    """The distinct classes, sorted."""
    return "".join(sorted(set(get_alphabet(alphabet).values())))


def key_pattern(alphabet: str | int | None | dict[str, str]) -> str:
    """Regular expression for one class character."""
    return "[" + "".join(f"\\{c}" if not c.isalnum() else c for c in alphabet_keys(alphabet)) + "]"


def alphabet_table(spark: SparkSession) -> DataFrame:
    """alphabet, alphabet_id (RED0 to RED5 or null), residue, class."""
    rows = [(name, f"RED{i}" if i < NUMBERED else None, residue, cls) for i, name in enumerate(ALPHABETS) for residue, cls in get_alphabet(name).items()]
    return spark.createDataFrame(rows, "alphabet string, alphabet_id string, residue string, class string")


def reduce_sequence(sequence: Column, alphabet: str | int | None | dict[str, str]) -> Column:
    """Without trailing `*`, each mapped residue replaced by its class; others stay."""
    mapping = get_alphabet(alphabet)
    return F.translate(F.regexp_replace(sequence, r"\*+$", ""), "".join(mapping), "".join(mapping.values()))
