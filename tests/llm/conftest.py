import pytest


@pytest.fixture(scope="session")
def small_dir(tmp_path_factory, spark):
    """A table of documents with nulls, empty and very long texts, repeated rows and a column of a clashing name."""
    folder = tmp_path_factory.mktemp("tables")
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), "x") for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string").write.parquet(str(folder / "documents.parquet"))
    return str(folder)


LINE = "the quick brown fox jumps over the lazy dog near the river bank while the sun goes down behind the hills"
TEXTS = [
    None, "", "   \n\t ", "Same Text here", "same text HERE", "a", "a b", LINE, LINE.replace("lazy", "sleepy"), LINE.upper(), f"{LINE} {LINE[::-1]}",
    "word " * 60_000, "x" * 200_000, f"{LINE}\n{LINE}\nother line of a different kind altogether", 'token = "1a6c4f7bcf8c070fc75a8f6f8ed4b9a36b13d44c" and mail a.b@c.de, 10.0.0.1 or +1 (664) 555-5990',
]
