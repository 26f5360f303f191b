import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, cell long, kept string, `a b` int"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Texts (or (id, text) or (id, text, source)) -> a documents table with clashing extra columns."""

    def make(rows):
        full = []
        for k, r in enumerate(rows):
            i, text, *source = r if isinstance(r, tuple) else (k, r)
            full.append((i, text, "en", source[0] if source else f"s{k % 3}", len(text or ""), 7, "x", 1))
        return spark.createDataFrame(full, SCHEMA)

    return make


#: Texts with every odd case: null, empty, white space, ties, repeats, very long.
ODD = [None, "", " \n\t ", "one", "one two three", "a b c d e f g h i j", "a b c d e f g h i j",
       "x " * 30_000, "y" * 50_000, "é ü ß z 🙂   end", "line\nline\nline\n\n", None]
